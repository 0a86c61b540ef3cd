"""Code -> label lookups: part-of-speech labels (P3) and the language
discriminator (P4)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables
from ._util import col, fail_with, map_literal


def label(c: str | Column, mapping: dict[str, str], strict: bool = True, what: str = "part") -> Column:
    """Map a code to its label.  ``strict``: an unknown code fails the job
    with ``invalid <what> <code>``; otherwise it gives null.  Null stays null."""
    x = col(c)
    found = map_literal(mapping)[x]
    if not strict:
        return found
    return F.when(x.isNull(), F.lit(None).cast("string")).otherwise(
        F.coalesce(found, fail_with(F.concat(F.lit(f"invalid {what} "), x)))
    )


def greek_part(c: str | Column, strict: bool = True) -> Column:
    return label(c, tables.GREEK_PART, strict=strict, what="part")


def language(tag: str | Column) -> Column:
    """First letter of a tree-shaped tag: H -> Hebrew, A -> Aramaic, else ''."""
    return F.coalesce(map_literal(tables.LANGUAGE)[F.substring(col(tag), 1, 1)], F.lit(""))
