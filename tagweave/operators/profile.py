"""Payload-size profile (K6): serialised record size per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.serialize import record_json


def payload_profile(df: DataFrame, by: Sequence[str], columns: Sequence[str] | None = None, key_order: str = "declared") -> DataFrame:
    """``(by..., records, min_bytes, max_bytes, avg_bytes, total_bytes)`` of
    the compact JSON form of each record (UTF-8 bytes)."""
    size = F.octet_length(record_json(df, columns, key_order=key_order))
    return (
        df.select(*by, size.alias("__b"))
        .groupBy(*by)
        .agg(
            F.count(F.lit(1)).alias("records"),
            F.min("__b").cast("bigint").alias("min_bytes"),
            F.max("__b").cast("bigint").alias("max_bytes"),
            F.round(F.avg("__b"), 4).alias("avg_bytes"),
            F.sum("__b").cast("bigint").alias("total_bytes"),
        )
    )
