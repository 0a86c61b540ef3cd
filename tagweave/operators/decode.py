"""DataFrame-level tag decode: wide attribute columns, dictionary decode
(D3) and the lookup dimensions (D4)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import tables
from ..functions.labels import language
from ..functions.serialize import tag_string
from ..functions.tree import decode_tree, tree_error
from .joins import join_small


def decode_tree_columns(
    df: DataFrame,
    tag: str | Column,
    attrs: Sequence[str] = tuple(tables.TREE_ATTRIBUTES),
    segment: str = "segment",
    pronoun_person: bool = False,
    on_error: str = "fail",
) -> DataFrame:
    """One row per tag segment with one column per attribute (absent ->
    null).  Unlike the map form, unused attribute columns are pruned."""
    # decoded in a projection first, then exploded (a SQL function may not
    # sit inside a generator)
    decoded = df.withColumn("__segments", decode_tree(tag, pronoun_person=pronoun_person, on_error=on_error))
    exploded = decoded.select("*", F.posexplode("__segments").alias("__seg", "__m"))
    return exploded.select(
        *[c for c in df.columns],
        (F.col("__seg") + 1).alias(segment),
        *[F.col("__m")[a].alias(a) for a in attrs],
    )


def tag_dictionary(df: DataFrame, tag: str, pronoun_person: bool = False, on_error: str = "fail") -> DataFrame:
    """Decode every *distinct* tag once: ``(tag, language, morphology,
    morphology_string)``.  The distinct runs map-side first (partial
    aggregation), so only distinct tags per task cross the network."""
    tags = df.select(F.col(tag).alias("__tag")).where(F.col("__tag").isNotNull()).distinct()
    decoded = decode_tree("__tag", pronoun_person=pronoun_person, on_error=on_error)
    cols = [F.col("__tag"), language("__tag").alias("language"), decoded.alias("morphology")]
    if on_error == "null":
        cols.append(tree_error("__tag", pronoun_person=pronoun_person).alias("decode_error"))
    return tags.select(*cols).withColumn("morphology_string", tag_string("morphology"))


def decode_by_dictionary(
    df: DataFrame,
    tag: str,
    pronoun_person: bool = False,
    on_error: str = "fail",
    known_small: bool = False,
) -> DataFrame:
    """Same result as decoding row by row, but each distinct tag is decoded
    once and joined back (D3), in one lazy plan: the distinct tags combine on
    the map side, and adaptive execution broadcasts the dictionary when its
    measured size allows (``known_small``: it is broadcast, and the rows are not
    shuffled by tag to find out).  Adds ``language``, ``morphology``,
    ``morphology_string`` (and ``decode_error`` with ``on_error='null'``)."""
    keyed = df.withColumn("__tag", F.col(tag))
    return join_small(keyed, tag_dictionary(df, tag, pronoun_person, on_error), "__tag", how="left", known_small=known_small).drop("__tag")


def lookup_table(spark: SparkSession, scheme: str | None = None) -> DataFrame:
    """Lookup dimensions as a table ``(scheme, lookup, code, label)``."""
    rows = tables.lookup_rows()
    if scheme:
        rows = [r for r in rows if r[0] == scheme]
    return spark.createDataFrame(rows, "scheme string, lookup string, code string, label string")


def book_dimension(spark: SparkSession, corpus: str) -> DataFrame:
    """Book dimension: ``hebrew`` -> (ordinal, name, file_stem);
    ``greek`` -> (ordinal, file_number, name)."""
    if corpus == "hebrew":
        return spark.createDataFrame(tables.hebrew_book_rows(), "ordinal int, name string, file_stem string")
    if corpus == "greek":
        return spark.createDataFrame(tables.greek_book_rows(), "ordinal int, file_number int, name string")
    raise ValueError("corpus must be 'hebrew' or 'greek'")
