"""Connected components of a link table, as rounds of Spark jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import stored


def components(links: DataFrame, max_rounds: int = 100) -> DataFrame:
    """``(node, component)`` for every node of ``links`` (two bigint columns
    ``a, b``, any order, repeats allowed), ``component`` being the smallest
    node reachable.

    Alternating star contraction: each round links the larger neighbours of a
    node to its smallest one, then the smaller ones, until nothing changes;
    the number of rounds is logarithmic in practice.  Every round is written to
    the shared folder, so no lineage builds up, and only its row counts and a
    checksum come to the driver.  The sums that decide a node's smallest
    neighbour combine on the map side, so a hub of any degree is no hot group."""
    edges = links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct()
    edges = stored(edges, "links")
    before = None
    for _ in range(max_rounds):
        # large star: every larger neighbour of a node goes to its smallest neighbour (or itself)
        both = edges.select("u", "v").unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # small star: every smaller neighbour goes to the smallest one
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(low, "u").select(F.col("v").alias("a"), "m").unionAll(low.select(F.col("u").alias("a"), "m"))
        edges = stored(small.where("a <> m").select(F.col("a").alias("u"), F.col("m").alias("v")).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError("components did not settle")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(
        edges.select(F.col("v").alias("node"), F.col("v").alias("component"))
    ).distinct()
