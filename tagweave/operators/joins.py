"""Joins with small dimensions, and even input splits."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def join_small(
    big: DataFrame,
    small: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    known_small: bool = False,
) -> DataFrame:
    """Join ``big`` with ``small``.  Only a fixed literal table
    (``known_small``) is broadcast by hint; for any other one adaptive
    execution chooses by the bytes it measures."""
    return big.join(F.broadcast(small) if known_small else small, on, how)


def spread(df: DataFrame) -> DataFrame:
    """Even out the input before heavy per-row work (an explode multiplies
    rows a hundredfold): adaptive execution splits large partitions and merges
    small ones by measured bytes.  Always the same plan; leave it out where
    the source's splits are known to be even."""
    return df.hint("rebalance")
