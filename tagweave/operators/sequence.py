"""Ordinals over already-exploded rows: numbering within a group (O1, B1)
and run-reset ordinals (O2).

Rows are numbered inside ``(group, chunk)`` — ``chunk`` must be monotone in
the order, e.g. a chapter, a time bucket, a key range or a file split — and a
summary with one row per chunk carries offsets, or run lengths, across chunk
boundaries.  No task holds more than one chunk's rows, whatever the size of a
group, and building the plan runs no job.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions._util import col

_CK = "__chunk"


def _as_list(x: str | Column | Sequence[str | Column]) -> list[str | Column]:
    return [x] if isinstance(x, (str, Column)) else list(x)


def _join_back(rows: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Null-safe equi-join of per-chunk values back onto the rows: a null
    group or chunk is a group like any other (the window form keeps it),
    and no ``IS NOT NULL`` filter is inferred into one branch only, so both
    branches stay identical and their shuffle can be reused.  Keys that are never
    null are compared as they are: rows dealt by them are not shuffled again."""
    renamed = small.select(*[F.col(c).alias(f"__r{c}" if c in keys else c) for c in small.columns])
    cond = None
    never = {f.name for f in rows.schema.fields if not f.nullable} & {f.name[3:] for f in renamed.schema.fields if not f.nullable}
    for k in keys:
        c = rows[k] == renamed[f"__r{k}"] if k in never else rows[k].eqNullSafe(renamed[f"__r{k}"])
        cond = c if cond is None else cond & c
    return rows.join(renamed, cond, "inner").drop(*[f"__r{k}" for k in keys])


def sequence_within(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    chunk: Column,
    out: str = "seq",
) -> DataFrame:
    """1-based row number (bigint) of each row inside its ``by`` group, in
    ``order``."""
    by = list(by)
    order = _as_list(order)
    d = df.withColumn(_CK, chunk)
    local = d.withColumn("__local", F.row_number().over(Window.partitionBy(*by, _CK).orderBy(*order)))
    # counts straight from the input: a partial count per task, no second sort
    counts = d.groupBy(*by, _CK).agg(F.count(F.lit(1)).alias("__n"))
    running = Window.partitionBy(*by).orderBy(_CK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*by, _CK, F.coalesce(F.sum("__n").over(running), F.lit(0)).alias("__off"))
    return (
        _join_back(local, offsets, [*by, _CK])
        .withColumn(out, F.col("__local") + F.col("__off"))
        .drop(_CK, "__local", "__off")
    )


def global_ordinal(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    chunk: Column,
    out: str = "ordinal",
) -> DataFrame:
    """Book-global ordinal (O1) for rows that are already exploded: never
    resets at chapter or verse.  ``chunk``: any column monotone in ``order``,
    e.g. ``F.col('chapter')``."""
    return sequence_within(df, by, order, chunk, out=out)


def run_ordinal(
    df: DataFrame,
    by: Sequence[str],
    order: Sequence[str | Column],
    value: str | Column,
    chunk: Column,
    out: str = "ord",
) -> DataFrame:
    """Run-reset ordinal (O2, bigint): restarts at 1 whenever ``value`` differs
    from the previous row's in ``order``; a value that reappears later restarts
    again (gaps and islands, not a group-by).

    Runs are found inside each chunk; a run that fills whole chunks is carried
    along the summary, and the rows of a chunk's first run get its length so
    far added."""
    by = list(by)
    order = _as_list(order)
    v = col(value)
    # Chunked: runs inside (group, chunk), then carry runs across chunks.
    # A named value column is used as is, so the summary branch prunes to
    # the same columns as the row branch and their shuffle is shared.
    d = df.withColumn(_CK, chunk)
    vname = value if isinstance(value, str) else "__v"
    if vname == "__v":
        d = d.withColumn("__v", v)
    wl = Window.partitionBy(*by, _CK).orderBy(*order)
    upto = wl.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    local = (
        d.withColumn("__rn", F.row_number().over(wl))
        .withColumn("__isstart", (F.col("__rn") == 1) | ~F.lag(vname).over(wl).eqNullSafe(F.col(vname)))
        .withColumn("__start", F.last(F.when(F.col("__isstart"), F.col("__rn")), ignorenulls=True).over(upto))
        .withColumn("__lord", F.col("__rn") - F.col("__start") + 1)
    )
    summary = local.groupBy(*by, _CK).agg(
        F.min_by(vname, "__rn").alias("__first"),
        F.max_by(vname, "__rn").alias("__last"),
        F.max_by("__lord", "__rn").alias("__lastlen"),
        F.sum(F.col("__isstart").cast("int")).alias("__nruns"),
    )
    carries = _carries(summary, by)
    return (
        _join_back(local, carries, [*by, _CK])
        .withColumn(out, F.col("__lord") + F.when(F.col("__start") == 1, F.col("__carry")).otherwise(F.lit(0).cast("bigint")))
        .drop(_CK, "__rn", "__isstart", "__start", "__lord", "__carry", *(["__v"] if vname == "__v" else []))
    )


def _carries(summary: DataFrame, by: list[str]) -> DataFrame:
    """``(by, chunk, __carry)``: the length that a chunk's first run has
    before it.  ``summary`` has a row for each chunk: its first and last value,
    the length of its last run and how many runs it has."""
    wc = Window.partitionBy(*by).orderBy(_CK)
    s = (
        summary.withColumn("__hasprev", F.lag(F.lit(True)).over(wc).isNotNull())
        .withColumn("__connected", F.col("__hasprev") & F.lag("__last").over(wc).eqNullSafe(F.col("__first")))
        # a chain restarts at every chunk that is not one run joined to its predecessor
        .withColumn("__break", F.when(F.col("__connected") & (F.col("__nruns") == 1), 0).otherwise(1))
        .withColumn("__chain", F.sum("__break").over(wc.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    )
    wchain = Window.partitionBy(*by, "__chain").orderBy(_CK).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    s = s.withColumn("__cum", F.sum("__lastlen").over(wchain))
    return s.select(
        *by, _CK, F.when(F.col("__connected"), F.lag("__cum").over(wc)).otherwise(F.lit(0)).alias("__carry")
    )


def _changes(values: list[pa.Array], before: list | None) -> np.ndarray:
    """True where a row's values differ from those of the row before it; nulls
    are equal.  ``before``: the values of the row before the first one."""
    n = len(values[0])
    out = np.zeros(n, bool)
    for k, v in enumerate(values):
        if n > 1:
            same = pc.fill_null(pc.equal(v[1:], v[:-1]), False)
            both = pc.and_(pc.is_null(v[1:]), pc.is_null(v[:-1]))
            out[1:] |= ~pc.or_(same, both).to_numpy(zero_copy_only=False)
        out[0] |= before is None or v[0].as_py() != before[k]
    return out


class _Runs:
    """Runs of equal values along the chunks that stream by."""

    def __init__(self, n_keys: int):
        self.n_keys = n_keys
        self.last: list | None = None  # keys and value of the row before
        self.length = self.runs = 0  # of the run that is open; runs in its chunk

    def add(self, keys: list[pa.Array], value: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(ordinal in the run, run number in the chunk, starts a chunk)``."""
        n = len(value)
        chunk = _changes(keys, self.last[: self.n_keys] if self.last else None)
        start = chunk | _changes([value], self.last[self.n_keys :] if self.last else None)
        at = np.arange(n)
        begin = np.maximum.accumulate(np.where(start, at, -1))
        ordinal = np.where(begin >= 0, at - begin + 1, at + 1 + self.length)
        count = np.cumsum(start)
        first = np.maximum.accumulate(np.where(chunk, at, -1))  # of the chunk, in this batch
        run = np.where(first >= 0, count - count[np.maximum(first, 0)] + 1, count + self.runs)
        self.last = [k[n - 1].as_py() for k in keys] + [value[n - 1].as_py()]
        self.length, self.runs = int(ordinal[-1]), int(run[-1])
        return ordinal, run, chunk


def run_ordinal_in_order(
    df: DataFrame, by: Sequence[str], chunk: str, value: str, out: str = "ord"
) -> DataFrame:
    """`run_ordinal` for rows that a scan gives in order: the rows of a
    ``(by, chunk)`` follow each other in one partition, as the lines of a file
    split do, and ``chunk`` orders the chunks of a group.

    One pass gives each chunk's state (first and last value, length of the last
    run, number of runs), read from the key and value columns alone; the states,
    one small row a chunk, are merged by a window.  The other pass numbers the
    rows where they are and adds what the state before brings to the first run
    of a chunk.  The rows are neither shuffled nor sorted."""
    by = list(by)
    keys = [*by, chunk]
    types = {f.name: f.dataType for f in df.schema.fields}
    spark_type = lambda c: types[c].simpleString()

    slim = df.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keys)], F.col(value).alias("v"))
    n_keys = len(keys)

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs, first = _Runs(n_keys), None
        schema: pa.Schema | None = None

        def row() -> pa.RecordBatch:
            values = [*runs.last[:n_keys], first, runs.last[n_keys], runs.length, runs.runs]
            kinds = [*[schema.field(i).type for i in range(n_keys)], *[schema.field(n_keys).type] * 2, pa.int64(), pa.int64()]
            names = [*[f"k{i}" for i in range(n_keys)], "first", "last", "lastlen", "nruns"]
            return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, kinds, strict=True)], names=names)

        for batch in batches:
            schema = batch.schema
            cols = [batch.column(i) for i in range(n_keys + 1)]
            if not batch.num_rows:
                continue
            new = _changes(cols[:n_keys], runs.last[:n_keys] if runs.last else None)
            edges = sorted({0, batch.num_rows, *np.flatnonzero(new).tolist()})
            for a, b in zip(edges, edges[1:]):
                if new[a]:
                    if runs.last:
                        yield row()
                    first = cols[n_keys][a].as_py()
                runs.add([c.slice(a, b - a) for c in cols[:n_keys]], cols[n_keys].slice(a, b - a))
        if runs.last:
            yield row()

    kinds = ", ".join(f"k{i} {spark_type(c)}" for i, c in enumerate(keys))
    v = spark_type(value)
    summary = slim.mapInArrow(states, f"{kinds}, first {v}, last {v}, lastlen bigint, nruns bigint").select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(by)], F.col(f"k{n_keys - 1}").alias(_CK),
        *[F.col(c).alias(f"__{c}") for c in ("first", "last", "lastlen", "nruns")],
    )
    carries = _carries(summary, by).where("__carry > 0").withColumnRenamed(_CK, chunk)

    at = {c: i for i, c in enumerate(df.columns)}

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        runs = _Runs(n_keys)
        for batch in batches:
            if batch.num_rows:
                ordinal, run, _ = runs.add([batch.column(at[c]) for c in keys], batch.column(at[value]))
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(ordinal.astype(np.int64)), pa.array(run == 1)], names=[*batch.schema.names, "__lord", "__open"]
                )

    schema = ", ".join(f"`{c}` {spark_type(c)}" for c in df.columns)
    rows = df.mapInArrow(number, f"{schema}, __lord bigint, __open boolean")
    # broadcast, or the rows are shuffled to find out how small it is: a row for
    # each chunk that goes on with a run, less than the scheduler holds of a split
    small = F.broadcast(carries.select(*[F.col(c).alias(f"__r{c}") for c in keys], "__carry"))
    cond = None
    for c in keys:
        same = rows[c].eqNullSafe(small[f"__r{c}"])
        cond = same if cond is None else cond & same
    carried = rows.join(small, cond, "left")
    ordinal = F.col("__lord") + F.when(F.col("__open"), F.coalesce("__carry", F.lit(0))).otherwise(F.lit(0))
    return carried.select(*[rows[c] for c in df.columns], ordinal.alias(out))
