"""Corpus pipeline: quality rules, near-duplicates, decontamination, mixing,
token shards.  Every stage works on all rows its predecessor kept and is
written as Parquet before the next one reads it.

All stages but the last return the columns of ``documents``.  Null and empty
texts fail the quality rules and end there; an empty table passes through."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagweave.llm._text import small_batches
from tagweave.llm.decontam import decontaminate
from tagweave.llm.mixing import mix_documents, plan_mix
from tagweave.llm.queries import vocabulary
from tagweave.llm.rules import apply_policy
from tagweave.llm.simhash import keep_one
from tagweave.llm.tokens import lookup, read_manifest, with_crc32, write_shards
from tagweave.session import scratch_path


def _recount(docs: DataFrame) -> DataFrame:
    """``n_chars`` of texts that a stage has changed."""
    return docs.withColumn("n_chars", F.length("text").cast("bigint"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule policy rejects go."""
    small_batches(spark)
    return apply_policy(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays, the one with the smallest id."""
    small_batches(spark)
    return keep_one(docs, shingle=3, max_bits=3)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark passages are cut out; a text that is mostly passages goes."""
    small_batches(spark)
    return _recount(decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts become the words that the mix takes of them; those of which it
    takes none go."""
    small_batches(spark)
    return _recount(mix_documents(docs, plan_mix(docs)))


def token_output(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards; the rows are read back from them by document id."""
    small_batches(spark)
    root = scratch_path(spark, "pipeline-shards")
    write_shards(docs, root, vocabulary("word_bpe_49k.json"), end_id=1)
    return with_crc32(lookup(docs, root), read_manifest(root)["width"])


STAGES = [
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("token_output", token_output),
]

# Fingerprints, permutations and token ids are beyond SQL: tests compare each
# stage with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        out = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(out)
        docs = spark.read.parquet(out)
    return docs
