"""File sources (S1-S6): tagged-line text files, nested JSON books, variant
folders, manifest checks and keys taken from file names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions._util import col, fail_with
from ..operators.joins import join_small

# Schema of a nested book: chapter -> verse -> word -> strings.
NESTED4 = "array<array<array<array<string>>>>"

from ..functions.tables import (  # noqa: E402  fixed default paths and tables
    DEFAULT_NESTED_PATH,
    DEFAULT_NESTED_TABLE,
    DEFAULT_TAGGED_PATH,
    DEFAULT_TAGGED_TABLE,
)


def read_tagged_lines(
    spark: SparkSession,
    path: str,
    glob: str = "*.txt",
    sep: str = " ",
    min_fields: int = 7,
    min_first_len: int = 6,
    on_error: str = "fail",
) -> DataFrame:
    """Lines of every matching file in ``path`` (not recursive), split on
    ``sep``.  Columns: ``file, file_name, block, seq, line, fields``.

    ``(file, block, seq)`` is the file order of a line: ``block`` is the
    split start inside the file and ``seq`` grows along each split, so
    ordering by it restores file order however the file was split.
    Lines end at ``\\n`` only; one trailing ``\\r`` is removed.  Repeated
    separators give empty fields.  A line with fewer than ``min_fields``
    fields or a first field shorter than ``min_first_len`` fails the job
    (``on_error='fail'``), is kept as is (``'keep'``) or is kept with a
    ``bad`` flag (``'quarantine'``) for ``split_quarantine``.
    """
    if on_error == "flag":
        on_error = "quarantine"
    if on_error not in ("fail", "keep", "quarantine"):
        raise ValueError("on_error must be 'fail', 'keep' or 'quarantine'")
    raw = (
        spark.read.option("lineSep", "\n")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "false")
        .text(path)
    )
    df = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    ).withColumn("fields", F.split("line", _regex_literal(sep), -1))
    bad = (F.size("fields") < min_fields) | (F.length(F.col("fields")[0]) < min_first_len)
    if on_error == "fail":
        df = df.withColumn(
            "fields",
            F.when(bad, F.raise_error(F.concat(F.lit("malformed line in "), F.col("file"), F.lit(": "), F.col("line"))).cast("array<string>")).otherwise(F.col("fields")),
        )
    elif on_error == "quarantine":
        df = df.withColumn("bad", bad)
    return df


def split_quarantine(df: DataFrame, flag: str = "bad") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of a flagged DataFrame; write ``bad`` aside and
    go on with ``good`` (both without the flag column)."""
    return df.where(~F.col(flag)).drop(flag), df.where(F.col(flag)).drop(flag)


def route_lines(df: DataFrame, out: str, flag: str = "bad") -> tuple[DataFrame, DataFrame]:
    """``(good, bad)`` rows of a flagged DataFrame from one pass over it: the
    rows are written once, routed by the flag to a folder each (``out`` must be
    new), and both parts are read back from there.  The order keys ``(file,
    block, seq)`` are columns, so file order is not lost."""
    spark = df.sparkSession
    df.write.partitionBy(flag).parquet(out)
    rest = df.drop(flag).schema
    routed = spark.read.schema(df.schema).parquet(out)
    return tuple(routed.where(F.col(flag) == value).select(*rest.names) for value in (False, True))


def _regex_literal(s: str) -> str:
    import re

    return re.escape(s)


def read_nested_books(
    spark: SparkSession,
    path: str,
    glob: str = "*.json",
    schema: str = NESTED4,
    on_error: str = "fail",
    layout: str = "files",
) -> DataFrame:
    """``(file, file_name, book_key, book)``.

    ``layout='files'``: one book per file, parsed whole with ``schema``;
    ``book_key`` is the file name without extension, and a file is one task's
    work.  ``layout='lines'``: files of any size with one
    ``{"book_key": ..., "book": ...}`` object per line, which split like any
    text.  A book that does not parse fails the job (``on_error='fail'``) or is
    null (``'null'``)."""
    if layout == "lines":
        return _read_book_lines(spark, path, glob, schema, on_error)
    if layout != "files":
        raise ValueError("layout must be 'files' or 'lines'")
    raw = spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
    parsed = F.from_json("value", schema)
    df = raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1).alias("book_key"),
        parsed.alias("book"),
    )
    if on_error == "fail":
        df = df.withColumn(
            "book",
            F.when(F.col("book").isNull(), F.raise_error(F.concat(F.lit("not a nested book: "), F.col("file"))).cast(schema)).otherwise(F.col("book")),
        )
    elif on_error != "null":
        raise ValueError("on_error must be 'fail' or 'null'")
    return df


def _read_book_lines(spark: SparkSession, path: str, glob: str, schema: str, on_error: str) -> DataFrame:
    raw = spark.read.option("lineSep", "\n").option("pathGlobFilter", glob).text(path)
    parsed = F.from_json("value", f"book_key string, book {schema}")
    df = raw.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_name").alias("file_name"), parsed.alias("line"))
    book = F.col("line.book")
    if on_error == "fail":
        message = F.concat(F.lit("not a nested book in "), F.col("file"))
        book = F.when(book.isNull() | F.col("line.book_key").isNull(), F.raise_error(message).cast(schema)).otherwise(book)
    elif on_error != "null":
        raise ValueError("on_error must be 'fail' or 'null'")
    return df.select("file", "file_name", F.col("line.book_key").alias("book_key"), book.alias("book"))


def list_books(spark: SparkSession, path: str, glob: str = "*.json") -> DataFrame:
    """``(file, book_key)`` of the files in a folder from a listing alone: no
    content is read."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return listed.select(F.col("path").alias("file"), F.regexp_extract(name, r"^(.*)\.[^.]*$", 1).alias("book_key"))


def variant_path(root: str, variant: str | None = "hebrew") -> str:
    """Folder of a numbering variant: ``'english'`` -> ``remapped``,
    anything else -> ``hebrew`` (S3)."""
    sub = "remapped" if variant == "english" else "hebrew"
    return f"{root.rstrip('/')}/{sub}"


def check_manifest(
    present: DataFrame,
    manifest: DataFrame,
    key: str,
    allow_missing: bool = False,
) -> DataFrame:
    """Manifest rows whose ``key`` is absent from ``present``.

    With ``allow_missing=False`` any missing row raises before the data is
    used (at most one row is fetched to the driver for the message)."""
    missing = manifest.join(present.select(key).distinct(), key, "left_anti")
    if not allow_missing:
        first = missing.select(key).take(1)
        if first:
            raise FileNotFoundError(f"manifest entry missing: {first[0][0]}")
    return missing


class ManifestCheck:
    """A manifest check (S4) that rides on the job that reads the books.

    `watch` observes which manifest keys the rows have, a set no larger than
    the manifest, as an action runs; `missing` and `verify` look at it when the
    action has ended.  So the check needs no scan of its own, and nothing runs
    while the plan is built.  A plan that stops early (``limit``) sees less."""

    def __init__(self, keys: Sequence[str]):
        self.keys = list(keys)
        self.observation = Observation()

    def watch(self, df: DataFrame, key: str) -> DataFrame:
        known = F.when(F.col(key).isin(self.keys), F.col(key))
        return df.observe(self.observation, F.collect_set(known).alias("seen"))

    def missing(self) -> list[str]:
        """Manifest keys without a row; waits for the first action's end."""
        seen = set(self.observation.get["seen"])
        return [k for k in self.keys if k not in seen]

    def verify(self) -> None:
        for k in self.missing():
            raise FileNotFoundError(f"manifest entry missing: {k}")


def key_from_name(name: str | Column, pattern: str, group: int = 1) -> Column:
    """Integer captured by ``pattern`` (unanchored) in ``name``; null when the
    pattern does not match."""
    n = col(name)
    captured = F.regexp_extract(n, pattern, group)
    return F.when(captured == "", F.lit(None).cast("int")).otherwise(captured.try_cast("int"))


def with_key_from_name(
    df: DataFrame,
    name: str | Column,
    pattern: str,
    dim: DataFrame,
    dim_key: str,
    dim_name: str,
    out_key: str = "book_number",
    out_name: str = "book_name",
    group: int = 1,
    on_no_match: str = "fail",
    dim_is_small: bool = True,
) -> DataFrame:
    """Key from a name column by regex, then the dimension's name for it
    (S5).  An unknown key gets ``''``; a name the pattern does not match
    fails the job (``on_no_match='fail'``) or keeps a null key (``'null'``).
    The dimension is broadcast when ``dim_is_small`` (fixed tables) or when
    its size check passes."""
    k = key_from_name(name, pattern, group)
    if on_no_match == "fail":
        k = F.when(k.isNull(), fail_with(F.concat(F.lit("invalid name "), col(name))).cast("int")).otherwise(k)
    elif on_no_match != "null":
        raise ValueError("on_no_match must be 'fail' or 'null'")
    keyed = df.withColumn(out_key, k)
    d = dim.select(F.col(dim_key).alias(out_key), F.col(dim_name).alias(out_name))
    joined = join_small(keyed, d, out_key, how="left", known_small=dim_is_small)
    return joined.withColumn(out_name, F.coalesce(F.col(out_name), F.lit("")))
