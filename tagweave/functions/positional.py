"""Positional tag decode (D1): character i of the code is looked up in the
i-th table; a miss, a '-' or a missing character gives null (absent)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import tables
from ._util import col, map_literal
from .labels import greek_part


def decode_positional(
    code: str | Column,
    part: str | Column | None = None,
    positions: list[tuple[str, dict[str, str]]] | None = None,
    strict_part: bool = True,
) -> Column:
    """``struct<part?, person, tense, voice, mood, case, number, gender, degree>``.

    Characters after the last position are ignored.  With ``part`` the
    struct starts with the part-of-speech label (unknown part fails when
    ``strict_part``)."""
    positions = positions or tables.GREEK_POSITIONS
    c = col(code)
    fields = []
    if part is not None:
        fields.append(greek_part(part, strict=strict_part).alias("part"))
    for i, (name, lookup) in enumerate(positions):
        fields.append(map_literal(lookup)[F.substring(c, i + 1, 1)].alias(name))
    return F.struct(*fields)
