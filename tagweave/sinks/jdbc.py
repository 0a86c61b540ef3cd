"""Relational bulk load of JSON documents (K2, K8) through Spark's JDBC
writer.  The table is created with the given column types when absent and
appended to otherwise; each Spark task commits its own rows in statement
batches of ``batchsize``.  The computed JSON columns of the store (J5) are
``functions.serialize.json_columns`` applied on read."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame


def write_jdbc_json(
    df: DataFrame,
    url: str,
    table: str,
    id_col: str = "id",
    content_col: str = "content",
    batchsize: int = 1000,
    properties: Mapping[str, str] | None = None,
    content_type: str = "CLOB",
) -> None:
    """Append ``(id, content)`` rows to ``table``; only the JSON text is the
    payload, the id is kept as a plain column for lookups."""
    if batchsize <= 0:
        raise ValueError("batchsize must be positive")
    props = dict(properties or {})
    props.setdefault("batchsize", str(batchsize))
    (
        df.select(id_col, content_col)
        .write.mode("append")
        .option("createTableColumnTypes", f"{content_col} {content_type}")
        .jdbc(url, table, properties=props)
    )
