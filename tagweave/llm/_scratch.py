"""Files in the shared folder: tables written once to cut lineage, and raw
files written by tasks."""

from __future__ import annotations

import uuid

from pyarrow import fs
from pyspark.sql import DataFrame

from ..session import scratch_path


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared folder and read again: the rows
    survive a lost executor and later steps do not compute them anew."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def filesystem(root: str) -> tuple[fs.FileSystem, str]:
    """The filesystem of a shared folder's URI and the path in it."""
    return fs.FileSystem.from_uri(root if "://" in root or root.startswith("/") else root.replace("file:", "", 1))


def commit(filesystem_: fs.FileSystem, path: str):
    """``(stream, finish)``: write under a name of this attempt; `finish` puts
    the whole file in place, so a retried task replaces it and readers never
    see part of one."""
    part = f"{path}.{uuid.uuid4().hex}.part"
    stream = filesystem_.open_output_stream(part)

    def finish() -> None:
        stream.close()
        filesystem_.move(part, path)

    return stream, finish
