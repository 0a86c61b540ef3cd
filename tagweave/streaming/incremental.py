"""Incremental arrival of corpus files with Structured Streaming.

New book files dropped in a landing folder are picked up by the file
stream source, turned into word rows with the same plan as the batch read
and handed to a sink function per micro-batch (``foreachBatch``).  The
stream checkpoint records which files were processed, so a re-run never
writes a file twice — unlike appending the whole folder again.  Stateless:
no watermark is needed because a file is never split across batches.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.gnt import words_from_lines
from ..plans.wlc import words_from_books
from ..session import scratch_path
from ..sources.files import NESTED4

Sink = Callable[[DataFrame, int], None]


def _nested_stream(spark: SparkSession, landing: str, glob: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text").option("wholetext", "true").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.load(landing)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.regexp_extract(F.col("_metadata.file_name"), r"^(.*)\.[^.]*$", 1).alias("book_key"),
        F.from_json("value", NESTED4).alias("book"),
    )


def _tagged_stream(spark: SparkSession, landing: str, glob: str, max_files: int | None) -> DataFrame:
    reader = spark.readStream.format("text").option("lineSep", "\n").option("pathGlobFilter", glob)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", str(max_files))
    raw = reader.load(landing)
    return raw.select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"),
        F.regexp_replace("value", "\r$", "").alias("line"),
    )


def _tagged_words(batch: DataFrame) -> DataFrame:
    # the order key is taken on the static micro-batch, where rows of a
    # file split arrive in file order
    lines = batch.withColumn("seq", F.monotonically_increasing_id()).withColumn("fields", F.split("line", " ", -1))
    return words_from_lines(lines)


def stream_corpus_files(
    spark: SparkSession,
    landing: str,
    sink: Sink,
    kind: str = "nested",
    checkpoint: str | None = None,
    available_now: bool = True,
    max_files_per_trigger: int | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a stream over ``landing`` that calls ``sink(words, epoch_id)``
    for each micro-batch of new files.  ``kind``: ``'nested'`` (JSON books,
    ``*.json``) or ``'tagged'`` (tagged lines, ``*.txt``).  The checkpoint
    defaults to a fresh folder under ``spark.checkpoint.dir``; pass the same
    folder again to resume where the last run stopped."""
    if kind == "nested":
        stream = _nested_stream(spark, landing, "*.json", max_files_per_trigger)
        to_words = lambda df: words_from_books(df, dictionary=False)
    elif kind == "tagged":
        stream = _tagged_stream(spark, landing, "*.txt", max_files_per_trigger)
        to_words = _tagged_words
    else:
        raise ValueError("kind must be 'nested' or 'tagged'")
    checkpoint = checkpoint or scratch_path(spark, "stream")

    def each(batch: DataFrame, epoch_id: int) -> None:
        sink(to_words(batch), epoch_id)

    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()


def epoch_writer(to_rows: Callable[[DataFrame], DataFrame], out_path: str) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that writes each micro-batch into a folder
    of its own, ``epoch=<id>``, replacing what an earlier attempt of the same
    batch left: a batch that runs again adds no row."""

    def each(batch: DataFrame, epoch_id: int) -> None:
        to_rows(batch).write.mode("overwrite").parquet(f"{out_path.rstrip('/')}/epoch={epoch_id}")

    return each


def stream_files_to_table(
    spark: SparkSession,
    path: str,
    to_rows: Callable[[DataFrame], DataFrame],
    out_path: str,
    fmt: str = "parquet",
    glob: str | None = None,
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """Process the files in ``path`` incrementally (``availableNow``) with
    ``to_rows`` per micro-batch, each into its own ``epoch`` folder of a parquet
    table at ``out_path``; returns that table.  Re-running with the same checkpoint
    processes only files that arrived since."""
    sample = spark.read.format(fmt)
    if glob:
        sample = sample.option("pathGlobFilter", glob)
    schema = sample.load(path).schema
    reader = spark.readStream.format(fmt).schema(schema)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.load(path)
    checkpoint = checkpoint or scratch_path(spark, "stream")

    each = epoch_writer(to_rows, out_path)

    q = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.option("basePath", out_path).parquet(out_path).drop("epoch")
