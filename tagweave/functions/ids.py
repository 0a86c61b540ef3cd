"""Identifier composition: reference recode (P2), concatenated ids (I1),
zero-padded verse ids (I2) and widening word ids (I3)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import col, fail_with

INT32_MAX = 2147483647


def _int_prefix(s: Column) -> Column:
    # Go's ParseInt with a dropped error: a non-numeric prefix reads as 0.
    return F.when(s.rlike(r"^[+-]?[0-9]+$"), s.try_cast("int")).otherwise(F.lit(0))


def recode_ref(ref: str | Column, offset: int = 39) -> Column:
    """``BBCCVV`` -> ``str(int(BB) + offset) || CC || VV``."""
    r = col(ref)
    book = _int_prefix(F.substring(r, 1, 2)) + F.lit(offset)
    return F.concat(book.cast("string"), F.substring(r, 3, 2), F.substring(r, 5, 2))


def concat_id(verse: str | Column, ordinal: str | Column, strict32: bool = False) -> Column:
    """``int(verse || ordinal)`` as bigint, no padding.

    ``strict32`` reproduces the 32-bit parse of the tagged-line corpus: a
    value above 2^31-1 fails the job instead of being stored.
    """
    text = F.concat(col(verse), col(ordinal).cast("string"))
    value = text.try_cast("bigint")
    bad = F.concat(F.lit("invalid id "), text)
    limit = F.lit(INT32_MAX) if strict32 else F.lit(9223372036854775807)
    return F.when(value.isNull() & text.isNotNull(), fail_with(bad).cast("bigint")).when(
        value > limit, fail_with(F.concat(F.lit("id out of 32-bit range "), text)).cast("bigint")
    ).otherwise(value)


def _pad(c: Column, width: int) -> Column:
    """``%0<width>d`` without ``format_string``: ``lpad`` cuts values wider
    than the slot, so those (and negatives) keep their full text."""
    text = c.cast("bigint").cast("string")
    return F.when((c >= 0) & (F.length(text) < width), F.lpad(text, width, "0")).when(
        c >= 0, text
    ).otherwise(F.format_string(f"%0{width}d", c.cast("bigint")))


def padded_id(*parts: str | Column, widths: tuple[int, ...] = (2, 3, 3)) -> Column:
    """Zero-padded concatenation, e.g. ``%02d%03d%03d`` -> ``'31001001'``.

    A value wider than its slot widens the text, as ``printf`` does.
    """
    if len(parts) != len(widths):
        raise ValueError("one width per part")
    return F.concat(*[_pad(col(p), w) for p, w in zip(parts, widths)])


def sequence_id(book: str | Column, chapter: str | Column, verse: str | Column, ordinal: str | Column) -> Column:
    """Word id ``int('%02d%03d%03d%03d')``: a book-global ordinal past 999
    widens the last slot, so ids are not numerically ordered inside a book.
    Overflow of bigint fails the job."""
    text = padded_id(book, chapter, verse, ordinal, widths=(2, 3, 3, 3))
    value = text.try_cast("bigint")
    return F.when(value.isNull() & text.isNotNull(), fail_with(F.concat(F.lit("invalid id "), text)).cast("bigint")).otherwise(value)
