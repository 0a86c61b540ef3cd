"""Hard-negative mining: for each anchor its best rows of the same label
(positives), and for each of those the best rows of other labels whose score
lies in a window under the positive's score.

Scores are exact integer inner products.  Components are quantised to integers
and multiplied modulo several small primes, one float32 matrix product each:
residues lie around zero and the inner dimension is cut so that no partial sum
leaves the 24 bits that float32 holds exactly.  As many primes are taken as the
largest possible score of the two blocks needs, and Chinese remaindering (mixed
radix) gives the signed scores back.

Anchors are a stated set of queries and every row is a candidate.  Anchors are
written once to the shared folder.  Tasks over the rows read them a block at a
time against a block of rows, so a task holds two blocks and their scores
whatever the sizes of the tables.  Each pair of blocks keeps the first few rows
of an anchor, and a ranked window with a limit before its shuffle merges those.
There are two passes over the rows: positives first, then the windows under
their scores.

Edge cases.  Rows with a null label, a null vector, or a null or non-finite
component take no part.  A row without an id is a candidate, after all others
at ties, and no anchor unless ``anchors`` says so.  Vectors of unequal length
count as filled up with zeros, an empty one scores 0.  Rows repeated under one
id are rows of their own, also as anchors; of equal rows one is the anchor
itself.  An anchor without a positive, and a positive without a row in its
window, have no result rows.  Very long vectors only make the blocks shorter in
rows.  Blocks whose scores may pass 62 bits raise an error.  An empty table
gives an empty result.  Other columns, whatever their names, are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from ._scratch import filesystem

ANCHOR_ROWS = 512  # of a block
BLOCK_VALUES = 1 << 20  # components of a block of rows
BLOCK_ROWS = 1 << 14
INNER = 256  # components multiplied at once
_EXACT = 1 << 24  # float32 holds all integers up to this


def _primes(inner: int = INNER) -> list[int]:
    """Primes whose balanced residues can be multiplied and summed ``inner``
    times inside float32's exact range, largest first."""
    top = int(2 * (_EXACT / inner) ** 0.5)
    sieve = np.ones(top + 1, bool)
    sieve[:2] = False
    for p in range(2, int(top**0.5) + 1):
        sieve[p * p :: p] &= not sieve[p]
    return [p for p in np.flatnonzero(sieve).tolist()[::-1] if p > 2 and inner * ((p - 1) // 2) ** 2 < _EXACT]


PRIMES = _primes()


def _balanced(x: np.ndarray, p: int) -> np.ndarray:
    """Residues of whole numbers held as doubles, around zero."""
    r = np.fmod(x, p)
    return (r - p * np.round(r / p)).astype(np.float32)


def scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of the rows of two matrices of whole numbers
    (doubles), as 64-bit integers."""
    width = max(a.shape[1], b.shape[1], 1)
    a = np.pad(a, ((0, 0), (0, width - a.shape[1])))
    b = np.pad(b, ((0, 0), (0, width - b.shape[1])))
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    # no score exceeds the product of the longest two vectors
    longest = [float(np.sqrt(np.max(np.einsum("ij,ij->i", m, m)))) for m in (a, b)]
    bound = longest[0] * longest[1] * (1 + 1e-9) + 1
    if not bound < 1 << 62:
        raise ValueError("scores may pass 62 bits")
    used, product = [], 1
    while product <= 2 * int(bound) + 1:
        used.append(PRIMES[len(used)])
        product *= used[-1]
    value = np.zeros((len(a), len(b)), np.int64)
    base = 1  # product of the primes so far; value is right modulo base
    for p in used:
        x, y = _balanced(a, p), _balanced(b, p)
        rest = np.zeros(value.shape, np.int64)
        for k in range(0, width, INNER):
            rest += (x[:, k : k + INNER] @ y[:, k : k + INNER].T).astype(np.int64)
        digit = (rest - value) % p * pow(base, -1, p) % p
        # digits around zero keep the sum signed and inside 64 bits
        digit -= p * (digit > p // 2)
        value += digit * base
        base *= p
    return value


def _ints(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(values, is null)`` of a bigint column."""
    null = column.is_null().to_numpy(zero_copy_only=False)
    return column.fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64), null


def _matrix(column: pa.Array) -> np.ndarray:
    """A list column of doubles as a matrix, short rows filled with zeros."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    size = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    width = int(size.max()) if len(size) else 0
    out = np.zeros((len(size), width))
    out[np.arange(width) < size[:, None]] = flat
    return out


class _Rows:
    """A block of rows in order of id (no id last)."""

    def __init__(self, batches: list[pa.RecordBatch]):
        table = pa.Table.from_batches(batches).combine_chunks()
        ids, null = _ints(table.column("id").combine_chunks())
        order = np.lexsort([ids, null])
        self.id, self.null = ids[order], null[order]
        self.label = _ints(table.column("label").combine_chunks())[0][order]
        self.vec = _matrix(table.column("vec"))[order]


def _row_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[_Rows]:
    """Batches put together, or cut, to blocks of a bounded size."""
    held: list[pa.RecordBatch] = []
    rows = values = 0
    for batch in batches:
        widest = max(int(np.diff(batch.column(2).offsets.to_numpy()).max()), 1) if batch.num_rows else 1
        step = max(1, min(BLOCK_ROWS, BLOCK_VALUES // widest))
        for i in range(0, batch.num_rows, step):
            part = batch.slice(i, step)
            held.append(part)
            rows, values = rows + part.num_rows, values + part.num_rows * widest
            if rows >= BLOCK_ROWS or values >= BLOCK_VALUES:
                yield _Rows(held)
                held, rows, values = [], 0, 0
    if held:
        yield _Rows(held)


def _anchor_blocks(root: str) -> Iterator[pa.Table]:
    """The stored anchors, a bounded block at a time."""
    fs, path = filesystem(root)
    from pyarrow import fs as pafs

    for info in sorted(fs.get_file_info(pafs.FileSelector(path)), key=lambda f: f.path):
        if info.path.endswith(".parquet"):
            with fs.open_input_file(info.path) as f:
                for batch in pq.ParquetFile(f).iter_batches(ANCHOR_ROWS):
                    yield pa.Table.from_batches([batch])


def _first(score: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``k`` allowed columns of each row by score, ties by column."""
    low = np.iinfo(np.int64).min
    s = np.where(allowed, score, low)
    if s.shape[1] > k:
        least = np.partition(s, s.shape[1] - k, axis=1)[:, s.shape[1] - k]
        allowed = allowed & (s >= least[:, None])
    r, c = np.nonzero(allowed)
    order = np.lexsort([c, -s[r, c], r])
    r, c = r[order], c[order]
    rank = np.arange(len(r)) - np.searchsorted(r, r)
    return r[rank < k], c[rank < k]


def _write(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def _merged(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first ``k`` of what the blocks found; the limit on the rank goes
    before the shuffle, so a group is never brought together whole."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(
    rows: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | Column = "label",
    positives: int = 5,
    negatives: int = 5,
    scale: int = 256,
    window: tuple[int, int] = (80, 100),
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score)``; see the module.

    ``anchors`` says which rows are anchors.  A component ``x`` counts as
    ``floor(scale * x)``.  With ``window = (low, high)`` in hundredths a
    negative's score ``n`` passes for a positive's score ``p`` if ``low * p <=
    100 * n <= high * p``."""
    label = F.col(label_col) if isinstance(label_col, str) else label_col
    vec = F.transform(F.col(vector_col), lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("double"))
    # floor() of a double is a bigint; doubles beyond it stay whole numbers without it
    big = F.transform(F.col(vector_col), lambda x: x.cast("double") * F.lit(float(scale)))
    fits = F.forall(big, lambda x: F.abs(x) < F.lit(float(1 << 62)))
    usable = F.forall(
        F.col(vector_col), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < F.lit(float("inf")))
    )
    table = rows.where(label.isNotNull() & F.col(vector_col).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("bigint").alias("id"), label.cast("bigint").alias("label"),
        F.when(fits, vec).otherwise(big).alias("vec"), F.coalesce(anchors, F.lit(False)).alias("is_anchor"),
    )
    candidates = table.select("id", "label", "vec")
    asked = _write(table.where("is_anchor").select(F.monotonically_increasing_id().alias("a"), "id", "label", "vec"), "anchors")
    spark = rows.sparkSession

    def same_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _row_blocks(batches):
            for at in _anchor_blocks(asked):
                ids, null = _ints(at.column("id").combine_chunks())
                vec = _matrix(at.column("vec"))
                label = _ints(at.column("label").combine_chunks())[0]
                s = scores(vec, block.vec)
                r, c = _first(s, label[:, None] == block.label[None, :], positives + 1)
                # a row equal to the anchor: one of these is the anchor itself
                twin = (ids[r] == block.id[c]) & (null[r] == block.null[c])
                k = np.flatnonzero(twin)
                w = max(vec.shape[1], block.vec.shape[1])
                pad = lambda m: np.pad(m, ((0, 0), (0, w - m.shape[1])))
                twin[k] = (pad(vec[r[k]]) == pad(block.vec[c[k]])).all(axis=1)
                yield pa.RecordBatch.from_arrays(
                    [at.column("a").combine_chunks().take(pa.array(r)), pa.array(block.id[c], mask=block.null[c]), pa.array(s[r, c]), pa.array(twin)],
                    names=["a", "id", "score", "twin"],
                )

    found = candidates.mapInArrow(same_label, "a bigint, id bigint, score bigint, twin boolean")
    near = _merged(found, ["a"], positives + 1)
    twins = Window.partitionBy("a").orderBy(F.desc("twin"), F.asc("rank"))
    near = near.withColumn("self", F.col("twin") & (F.row_number().over(twins) == 1)).where("NOT self")
    near = near.withColumn("p", F.row_number().over(Window.partitionBy("a").orderBy("rank"))).where(F.col("p") <= positives)
    near = spark.read.parquet(_write(near.select("a", "p", F.col("id").alias("positive_id"), F.col("score").alias("positive_score")), "positives"))
    # each anchor with the scores of its positives; equal scores have one window
    tops = near.groupBy("a").agg(F.sort_array(F.collect_set("positive_score")).alias("tops"))
    asked2 = _write(spark.read.parquet(asked).join(tops, "a").select("a", "id", "label", "vec", "tops"), "anchors")
    low, high = window

    def other_label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in _row_blocks(batches):
            for at in _anchor_blocks(asked2):
                label = _ints(at.column("label").combine_chunks())[0]
                a = at.column("a").combine_chunks()
                s = scores(_matrix(at.column("vec")), block.vec)
                other = label[:, None] != block.label[None, :]
                lists = at.column("tops").to_pylist()
                for k in range(max(map(len, lists), default=0)):
                    top = [t[k] if k < len(t) else None for t in lists]
                    # the window in whole scores; none for a missing positive
                    lo = np.array([1 if t is None else -(-low * t // 100) for t in top], np.int64)
                    hi = np.array([0 if t is None else high * t // 100 for t in top], np.int64)
                    r, c = _first(s, other & (s >= lo[:, None]) & (s <= hi[:, None]), negatives)
                    yield pa.RecordBatch.from_arrays(
                        [a.take(pa.array(r)), pa.array(np.array([t or 0 for t in top], np.int64)[r]), pa.array(block.id[c], mask=block.null[c]), pa.array(s[r, c])],
                        names=["a", "top", "id", "score"],
                    )

    found = candidates.mapInArrow(other_label, "a bigint, top bigint, id bigint, score bigint")
    hard = _merged(found, ["a", "top"], negatives).withColumnRenamed("id", "negative_id")
    names = spark.read.parquet(asked).select("a", F.col("id").alias("anchor_id"))
    out = near.join(hard, (near["a"] == hard["a"]) & (near["positive_score"] == hard["top"])).drop(hard["a"]).join(names, "a")
    return out.select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", F.col("score").alias("negative_score"),
        F.col("p").cast("int").alias("positive_rank"),
    )
