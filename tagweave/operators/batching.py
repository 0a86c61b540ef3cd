"""Fixed-size batches (B1), batch progress (B2) and last-write-wins per
key (K7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .sequence import sequence_within


def group_totals(df: DataFrame, by: Sequence[str]) -> DataFrame:
    """``(by..., __total)`` row counts per group, partially aggregated."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("__total"))


def assign_batches(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    size: int,
    chunk: Column,
    out: str = "batch_no",
    seq: str = "seq",
) -> DataFrame:
    """Number rows inside each ``by`` group and cut them into half-open
    batches ``[i*size, (i+1)*size)``; the last one may be partial.
    ``chunk`` is monotone in ``order`` (see ``sequence``).
    ``size <= 0`` is an error (it would silently write nothing)."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    numbered = sequence_within(df, by, order, chunk, out=seq)
    return numbered.withColumn(out, F.expr(f"(`{seq}` - 1) div {int(size)}"))


def exact_batches(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    size: int,
    chunk: Column,
    partitions: int | None = None,
) -> DataFrame:
    """Rows laid out for a writer so that each batch is exactly the group's
    rows ``[i*size, (i+1)*size)`` in ``order`` and never spans groups.

    Rows are numbered chunk by chunk, hash-partitioned by
    ``(by..., batch_no)`` — every key holds at most ``size`` rows, so a hot
    group spreads over all tasks — and sorted inside each partition.  Pass
    ``group_by=",".join([*by, "batch_no"])`` to the ``kvbatch`` writer."""
    numbered = assign_batches(df, by, order, size, chunk)
    keys = [*by, "batch_no"]
    spread = numbered.repartition(partitions, *keys) if partitions else numbered.repartition(*keys)
    return spread.sortWithinPartitions(*keys, "seq")


def order_for_batches(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    partitions: int | None = None,
) -> DataFrame:
    """Cheaper layout when batch alignment does not matter: range-partition
    on ``(by..., order...)`` (a hot group is split over several tasks) and
    sort inside partitions; the writer's ``group_by`` keeps batches inside
    one group."""
    cols = [*by, *order]
    ranged = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return ranged.sortWithinPartitions(*cols)


def batch_ranges(total: int, size: int) -> list[tuple[int, int]]:
    """Driver-side helper for a known count: the ``[lo, hi)`` ranges."""
    if size <= 0:
        raise ValueError("batch size must be positive")
    return [(lo, min(lo + size, total)) for lo in range(0, total, size)]


def batch_report(
    df: DataFrame,
    by: Sequence[str],
    size: int,
    batch: str = "batch_no",
    totals: DataFrame | None = None,
) -> DataFrame:
    """One row per batch: ``(by..., batch_no, lo, hi, pct)`` where ``pct`` is
    ``min(100, (batch_no+1)*size/total*100)`` to two decimals.  Counts are
    partially aggregated map-side, so a hot group costs no more than any
    other.  ``totals`` (``by..., __total``) may be given, e.g. counted on the
    source table, so the batch numbering is not run a second time for them.
    Spark picks the join by the totals' measured size."""
    by = list(by)
    per_batch = df.groupBy(*by, batch).agg(F.count(F.lit(1)).alias("__n"))
    if totals is None:
        totals = per_batch.groupBy(*by).agg(F.sum("__n").alias("__total"))
    # null-safe: a null group is reported like any other
    t = totals.select(*[F.col(k).alias(f"__t_{k}") for k in by], "__total")
    cond = None
    for k in by:
        c = per_batch[k].eqNullSafe(t[f"__t_{k}"])
        cond = c if cond is None else cond & c
    return (
        per_batch.join(t, cond, "inner")
        .select(
            *by,
            F.col(batch),
            (F.col(batch) * F.lit(size)).cast("bigint").alias("lo"),
            (F.col(batch) * F.lit(size) + F.col("__n")).cast("bigint").alias("hi"),
            F.round(
                F.least(F.lit(100.0), ((F.col(batch) + 1) * F.lit(float(size)) / F.col("__total")) * F.lit(100.0)), 2
            ).alias("pct"),
        )
    )


def latest_by_key(df: DataFrame, keys: Sequence[str], seq: Sequence[str]) -> DataFrame:
    """Keep, per key, the row with the greatest ``seq`` (last write wins).
    ``max_by`` aggregates partially on the map side, so a hot key is
    combined before the shuffle.  ``keys`` may be several columns (a store's
    hash and range key).

    Rows of equal ``seq`` are told apart by a hash of their other columns, so
    reruns agree; nulls come first, and a null key is a key."""
    keys, seq = list(keys), list(seq)
    rest = [c for c in df.columns if c not in keys]
    types = {f.name: f.dataType for f in df.schema.fields}
    tie = F.xxhash64(*[c for c in rest if not _has_map(types[c])])
    best = F.max_by(F.struct(*rest), F.struct(*seq, tie)).alias("__row")
    return df.groupBy(*keys).agg(best).select(*keys, *[F.col("__row")[c].alias(c) for c in rest])


def _has_map(t: T.DataType) -> bool:
    if isinstance(t, T.MapType):
        return True
    if isinstance(t, T.ArrayType):
        return _has_map(t.elementType)
    return isinstance(t, T.StructType) and any(_has_map(f.dataType) for f in t.fields)
