"""Quality classifier by importance resampling: hashed n-gram models of the
target text and of the raw text, the log of their ratio as a document's
weight, and a sample without replacement by Gumbel top-k.

The target is learned from the labelled good documents (a bounded sample of
them, about ``MAX_LABELS``, taken by the hash of the id, so that their ids can
be broadcast), the raw model from every document.  A model is ``N_BUCKETS``
counts, whatever the corpus.  The weight is the mean log ratio over a document's
n-grams, so that a long text is not certain to win or lose by its length.

A few words can make a document unwanted, and a mean drowns them.  Where labels
name an unwanted class, a third model is learned from it (the same bound), and
every n-gram whose log ratio of that model to the target is over ``MARGIN``
takes ``PENALTY`` times the excess off the weight: a sum, not a mean.  Keys are
the weight times ``SHARPNESS`` plus Gumbel noise.

The k-th largest key is found by counting in bins of the key's bits, a few
rounds of one small aggregation each; nothing is sorted and no row is
collected.

Edge cases: null and empty texts have no n-grams, weight the worst, and are
never sampled; a null id counts as the empty text where ids are hashed; rows
that repeat an id share their noise, so equal rows tie, and a tie at the
threshold goes to smaller ids, then keeps all equal rows; no good labels give
every document weight 0; extra columns are ignored; an empty table gives no
rows.  A very long text's n-grams are all counted."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import LOWER, blocks, find_words, mix64, row_of, word_hashes

N_BUCKETS = 1 << 18
MAX_LABELS = 200_000
SHARPNESS = 200.0
MARGIN = 2.0
PENALTY = 0.02
SEED = 20240607
_PAIR = np.uint64(0x9E3779B97F4A7C15)

# words and the marks between them: runs of letters and digits, and each other
# printable character, so that a text's punctuation counts too
_ALNUM = np.zeros(256, dtype=bool)
_ALNUM[0x30:0x3A] = True
_ALNUM[0x41:0x5B] = True
_ALNUM[0x61:0x7B] = True
_ALNUM[0x80:] = True
_MARK = np.zeros(256, dtype=bool)
_MARK[0x21:0x7F] = True
_MARK &= ~_ALNUM


def ngrams(data: np.ndarray, offsets: np.ndarray, n_buckets: int = N_BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """``(text, bucket)`` of every token and neighbouring pair: case and, by
    shape, capitals stay visible through one token for each fully upper-case
    word."""
    low = LOWER[data]
    start, end, first = find_words(low, offsets, _ALNUM)
    h = word_hashes(low, start, end, seed=21)
    at, row = start, row_of(first)
    marks = np.flatnonzero(_MARK[data])
    at = np.concatenate([at, marks])
    row = np.concatenate([row, np.searchsorted(offsets, marks, side="right") - 1])
    h = np.concatenate([h, mix64(data[marks].astype(np.uint64) + np.uint64(0xABCDEF))])
    order = np.argsort(at, kind="stable")
    h, row = h[order], row[order]
    with np.errstate(over="ignore"):
        pair = mix64(h[:-1] + mix64(h[1:] * _PAIR))
    same = row[1:] == row[:-1]
    # words in capitals (two letters or more, all upper case)
    upper = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum((data >= 65) & (data <= 90), out=upper[1:])
    caps = np.flatnonzero((end - start > 1) & (upper[end] - upper[start] == end - start))
    keys = np.concatenate([h, pair[same], np.full(len(caps), 0x51ED270B, np.uint64)])
    rows = np.concatenate([row, row[1:][same], row_of(first)[caps]])
    return rows, (mix64(keys) % np.uint64(n_buckets)).astype(np.int64)


def bucket_counts(docs: DataFrame, classes: Sequence[np.ndarray], n_buckets: int = N_BUCKETS) -> list[np.ndarray]:
    """N-gram counts of each class of texts, those whose ``mark`` is in its
    sorted array, and at the end of all texts (columns ``mark, text``), in one
    pass: no text is shuffled, one row per bucket and task is, and one row per
    bucket reaches the driver."""
    marks = docs.sparkSession.sparkContext.broadcast(list(classes))
    names = [f"n{k}" for k in range(len(classes) + 1)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), n_buckets), dtype=np.int64)
        for batch in batches:
            mark = batch.column(0).to_numpy()
            chosen = [np.isin(mark, m) for m in marks.value]
            for i, j, data, offsets in blocks(batch.column(1)):
                rows, bucket = ngrams(data, offsets, n_buckets)
                for k, c in enumerate(chosen):
                    total[k] += np.bincount(bucket[c[i:j][rows]], minlength=n_buckets)
                total[-1] += np.bincount(bucket, minlength=n_buckets)
        used = np.flatnonzero(total[-1])
        for a in range(0, len(used), 1 << 16):
            part = used[a : a + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(part), *[pa.array(t[part]) for t in total]], names=["bucket", *names])

    out = [np.zeros(n_buckets) for _ in names]
    rows = docs.select("mark", "text").mapInArrow(run, "bucket bigint, " + ", ".join(f"{n} bigint" for n in names))
    found = rows.groupBy("bucket").agg(*[F.sum(n).alias(n) for n in names]).toArrow()
    at = found.column("bucket").to_numpy()
    for k, n in enumerate(names):
        out[k][at] = found.column(n).to_numpy()
    return out


def log_ratio(target: np.ndarray, raw: np.ndarray) -> np.ndarray:
    """Log of the models' ratio by bucket, add-one smoothed."""
    if not target.sum():
        return np.zeros(len(raw))
    n = len(raw)
    return np.log((target + 1) / (target.sum() + n)) - np.log((raw + 1) / (raw.sum() + n))


def penalties(unwanted: np.ndarray, target: np.ndarray) -> np.ndarray:
    """What each bucket takes off a weight."""
    return PENALTY * np.maximum(log_ratio(unwanted, target) - MARGIN, 0)


def weights(docs: DataFrame, ratio: np.ndarray, penalty: np.ndarray, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_grams, log_weight)``: the mean log ratio less the summed
    penalties (null without n-grams)."""
    table = docs.sparkSession.sparkContext.broadcast((ratio, penalty))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                ratios, off = table.value
                rows, bucket = ngrams(data, offsets, len(ratios))
                n = np.bincount(rows, minlength=j - i)
                total = np.bincount(rows, weights=ratios[bucket], minlength=j - i)
                mean = np.divide(total, n, out=np.zeros(j - i), where=n > 0)
                mean -= np.bincount(rows, weights=off[bucket], minlength=j - i)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(n, pa.int64()), pa.array(mean, mask=n == 0)], names=["id", "n_grams", "log_weight"]
                )

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"id {kind}, n_grams bigint, log_weight double")


def top_k(keyed: DataFrame, k: int, key: str = "key", tie: str = "id", bins: int = 1 << 12) -> DataFrame:
    """Adds ``selected``: the ``k`` rows of largest ``key`` (nulls never), ties
    by smaller ``tie``, equal rows together.  The threshold is narrowed by
    counting in bins, so the driver holds ``bins`` counts at a time."""
    span = keyed.agg(F.min(key), F.max(key), F.count(key)).first()
    lo, hi, n = span
    if n <= k or k <= 0:
        return keyed.withColumn("selected", F.lit(k > 0) & F.col(key).isNotNull())
    need = k  # wanted among the rows in [lo, hi]
    while hi > lo:
        width = (hi - lo) / bins
        if lo + width <= lo or hi - width >= hi:
            break
        b = F.least(F.floor((F.col(key) - lo) / width), F.lit(bins - 1))
        inside = keyed.where(F.col(key).between(lo, hi)).groupBy(b.alias("b"))
        found = {r["b"]: r for r in inside.agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("lo"), F.max(key).alias("hi")).collect()}
        at = max(found)
        while found[at]["n"] < need:
            need -= found[at]["n"]
            at = max(x for x in found if x < at)
        same = (lo, hi) == (found[at]["lo"], found[at]["hi"])
        lo, hi = found[at]["lo"], found[at]["hi"]
        if found[at]["n"] == need or same:
            break
    # rows above hi are in; the last ones by tie among [lo, hi]
    edge = keyed.where(F.col(key).between(lo, hi))
    total = edge.count()
    if total <= need:
        return keyed.withColumn("selected", F.coalesce(F.col(key) >= lo, F.lit(False)))
    return _by_tie(keyed, key, tie, lo, hi, need, bins)


def _by_tie(keyed: DataFrame, key: str, tie: str, lo: float, hi: float, need: int, bins: int) -> DataFrame:
    """Among rows of (nearly) equal key: the smallest ids, by binary search
    over the id's range."""
    edge = keyed.where(F.col(key).between(lo, hi))
    a, b = edge.agg(F.min(tie), F.max(tie)).first()
    if a is None:
        return keyed.withColumn("selected", F.coalesce(F.col(key) >= lo, F.lit(False)))
    while a < b:
        mid = (a + b) // 2
        if edge.where(F.col(tie) <= mid).count() >= need:
            b = mid
        else:
            a = mid + 1
    return keyed.withColumn("selected", F.coalesce((F.col(key) > hi) | (F.col(key).between(lo, hi) & (F.col(tie) <= a)), F.lit(False)))


def resample(
    docs: DataFrame,
    labels: DataFrame,
    share: float | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    good: str = "quality = 1",
    unwanted: str | None = None,
    sharpness: float = SHARPNESS,
    seed: int = SEED,
) -> DataFrame:
    """``(id, n_grams, log_weight, key, selected)``, one row per input row;
    ``share`` of the documents are sampled (by default the share of good ones
    among the labelled).  ``good`` and ``unwanted`` are conditions on the label
    columns."""
    d = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    no = F.coalesce(F.expr(unwanted), F.lit(False)) if unwanted else F.lit(False)
    marked = labels.select(F.col(id_col).alias("id"), F.expr(good).alias("good"), no.alias("unwanted")).where("id IS NOT NULL")
    count = lambda c: F.coalesce(F.sum(F.col(c).cast("bigint")), F.lit(0))
    n_lab, n_good, n_unwanted = marked.agg(F.count(F.lit(1)), count("good"), count("unwanted")).first()
    if share is None:
        share = n_good / n_lab if n_lab else 0.5
    mark = F.xxhash64("id")

    def sample(label: str, n: int) -> np.ndarray:
        """Ids a model is fitted on: those of a label, MAX_LABELS of them at most."""
        picked = marked.where(label).select(mark.alias("mark")).distinct()
        if n > MAX_LABELS:
            picked = picked.where(F.pmod("mark", F.lit(1 << 20)) < int((1 << 20) * MAX_LABELS / n))
        return np.sort(picked.toPandas()["mark"].to_numpy(dtype=np.int64))

    counts = bucket_counts(d.select(mark.alias("mark"), "text"), [sample("good", n_good), sample("unwanted", n_unwanted)])
    target, bad, raw = counts
    off = penalties(bad, target) if n_unwanted and n_good else np.zeros(len(raw))
    w = weights(d, log_ratio(target, raw), off, "id", "text")
    # Gumbel noise from the id and the seed: reruns and retries draw the same
    u = (F.pmod(F.xxhash64(F.lit(seed), F.coalesce(F.col("id").cast("string"), F.lit(""))), F.lit(1 << 52)) + 0.5) / F.lit(float(1 << 52))
    keyed = stored(w.withColumn("key", F.col("log_weight") * sharpness - F.log(-F.log(u))), "resample")
    n = keyed.count()
    return top_k(keyed, round(share * n)).withColumnRenamed("id", id_col)
