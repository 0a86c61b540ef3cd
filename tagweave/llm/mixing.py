"""Mixing sources to target weights.

Each source's words are packed end to end, in id order, into blocks of
``block_words`` words (the last one may be short).  The mix is a sequence of
slots cut into output shards.  Every shard draws its source counts from a
multinomial; the draws are tied to the total of each source (a multivariate
hypergeometric, which is a multinomial given its sums), so shards vary freely
while each source ends exactly at its target, to a block.  The slots of a
source are numbered through all shards and mapped to blocks by a pseudorandom
permutation of the block indices, one permutation for each pass over the
source; blocks join slots by index.

Targets: sources by code point, null last, weigh ``weights`` in turn and share
all words; a target stops at ``max_passes`` times its source, the excess is
shared out again by weight until none is above.  No block is drawn more than
``max_passes`` times, so no document is.

Edge cases: a null or empty text has size 0 and is never taken; a null source
is a source of its own; a null id sorts first; rows that repeat an id are
told apart by their text, and equal rows share what is taken evenly in order;
sources without words get target 0; extra columns are kept out of the plan;
an empty table gives an empty mix; a very long text is many blocks and is taken
in part like any other.  Draws depend on the seed, the source
totals and the ids only, so reruns agree."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import blocks, find_words, mix64

WEIGHTS = (5.0, 2.0, 1.0)
MAX_PASSES = 3
BLOCK_WORDS = 64
SHARD_SLOTS = 1 << 14
SEED = 20240607
GROUP_SLOTS = 1 << 24  # slots of a group of shards, which one task draws
MAX_PARTS = 20_000  # partitions of a shuffle
_CHUNK_DOCS = 1 << 13


def targets(sizes: Sequence[int], weights: Sequence[float] = WEIGHTS, max_passes: int = MAX_PASSES) -> list[float]:
    """Target words of each source, in source order."""
    total = float(sum(sizes))
    w = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    full: set[int] = set()
    while total > 0 and len(full) < len(sizes):
        left = total - sum(max_passes * sizes[i] for i in full)
        share = sum(w[i] for i in range(len(sizes)) if i not in full)
        over = [i for i in range(len(sizes)) if i not in full and left * w[i] / share > max_passes * sizes[i]]
        if not over:
            for i in range(len(sizes)):
                out[i] = float(max_passes * sizes[i]) if i in full else left * w[i] / share
            break
        full.update(over)
    return out


def _feistel(index: np.ndarray, n: int, key: int) -> np.ndarray:
    """Pseudorandom permutation of ``0..n-1``: four Feistel rounds over the
    smallest even number of bits, walking the cycle back into range."""
    if n <= 1:
        return index.copy()
    half = max(1, ((n - 1).bit_length() + 1) // 2)
    mask = np.uint64((1 << half) - 1)
    out = index.astype(np.uint64)
    todo = np.arange(len(out))
    with np.errstate(over="ignore"):
        while len(todo):
            left, right = out[todo] >> np.uint64(half), out[todo] & mask
            for r in range(4):
                left, right = right, left ^ (mix64(right + np.uint64((key + r * 0x9E3779B97F4A7C15) % (1 << 64))) & mask)
            out[todo] = (left << np.uint64(half)) | right
            todo = todo[out[todo] >= n]
    return out.astype(np.int64)


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for i, j, data, offsets in blocks(batch.column(batch.num_columns - 1)):
            _, _, first = find_words(data, offsets)
            cols = [batch.column(k).slice(i, j - i) for k in range(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(np.diff(first), pa.int64())], names=[*batch.schema.names[:-1], "size"])


def sizes(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``(id, source, tie, size)``: the number of words of each whole text.
    ``tie`` (a hash of the text) tells rows that repeat an id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"), F.col(source_col).cast("string").alias("source"), F.xxhash64(text).alias("tie"), text.alias("text")
    ).mapInArrow(_count_words, "id bigint, source string, tie bigint, size bigint")


class Mix:
    """The plan of a mix.

    ``docs``: ``(id, source, tie, size, no, at)``, one row per input row, with
    the source's number and the row's first word in the source's sequence.
    ``slots``: ``(shard, slot, no, pass, block)``.
    ``counts``: ``(no, block, taken)``, how often a block is taken.
    ``sources``: ``(no, source, source_size, target, n_blocks)``."""

    def __init__(self, docs: DataFrame, sources: DataFrame, slots: DataFrame, block_words: int):
        self.docs, self.sources, self.slots, self.block_words = docs, sources, slots, block_words
        self.counts = slots.groupBy("no", "block").agg(F.count(F.lit(1)).alias("taken"))

    def pieces(self) -> DataFrame:
        """``(id, source, tie, size, at, no, block, lo, hi, taken)``: the words
        ``[lo, hi)`` of a document that lie in a block that is taken."""
        b = F.lit(self.block_words)
        d = self.docs.where("size > 0").select(
            "id", "source", "tie", "size", "at", "no",
            F.explode(F.sequence(F.expr(f"at div {self.block_words}"), F.expr(f"(at + size - 1) div {self.block_words}"))).alias("block"),
        )
        lo = F.greatest(F.col("block") * b - F.col("at"), F.lit(0))
        hi = F.least((F.col("block") + 1) * b - F.col("at"), F.col("size"))
        return d.join(self.counts, ["no", "block"]).withColumn("lo", lo).withColumn("hi", hi)


def _positions(sized: DataFrame) -> DataFrame:
    """First word of each row in its source's sequence, ordered by id.  A
    source is cut into chunks of ids and texts' hashes, each summed by its own
    task; a window over the chunk totals carries the offsets."""
    n = sized.count()
    parts = max(1, min(MAX_PARTS, -(-n // _CHUNK_DOCS)))
    order = [F.col("id").asc_nulls_first(), F.col("tie"), F.col("size")]
    ranged = sized.repartitionByRange(parts, "no", *order)
    chunked = stored(ranged.withColumn("chunk", F.spark_partition_id()), "mix-sizes")
    within = Window.partitionBy("no", "chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    local = chunked.withColumn("at", F.coalesce(F.sum("size").over(within), F.lit(0)))
    totals = chunked.groupBy("no", "chunk").agg(F.sum("size").alias("words"))
    before = Window.partitionBy("no").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("no", "chunk", F.coalesce(F.sum("words").over(before), F.lit(0)).alias("base"))
    return local.join(offsets, ["no", "chunk"]).withColumn("at", F.col("at") + F.col("base")).drop("chunk", "base")


def deal_shards(spark: SparkSession, n_slots: Sequence[int], shard_slots: int = SHARD_SLOTS, seed: int = SEED) -> tuple[DataFrame, int]:
    """``(shard, no, first, n)`` and the number of shards: how many slots of
    each source a shard has, and the first of them in the source's sequence.

    The slots are cut into groups of ``GROUP_SLOTS``, each with every source in
    proportion to a slot (the k-th of g groups has the slots from ``n k / g`` to
    ``n (k + 1) / g``), and a task draws the shards of its group.  So no draw
    is over more slots than the generator takes, whatever the corpus, and the
    driver holds the sources' totals only."""
    total = sum(n_slots)
    n_groups = max(1, -(-total // GROUP_SLOTS))
    # a group may have a slot more of each source than its share
    per_group = -(-(-(-total // n_groups) + len(n_slots)) // shard_slots) if n_groups > 1 else max(1, -(-total // shard_slots))
    sources = spark.createDataFrame([(i, int(n)) for i, n in enumerate(n_slots)], "no bigint, slots bigint")
    edge = lambda k: f"cast(cast(slots AS decimal(38,0)) * ({k}) div {n_groups} AS bigint)"
    groups = sources.select("no", "slots", F.explode(F.sequence(F.lit(0), F.lit(n_groups - 1))).alias("g"))
    groups = groups.select("g", "no", F.expr(edge("g")).alias("first"), F.expr(f"{edge('g + 1')} - {edge('g')}").alias("n"))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: dict[int, list[tuple[int, int, int]]] = {}
        for batch in batches:
            for g, i, first, n in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                rows.setdefault(g, []).append((i, first, n))
        for g, parts in rows.items():
            no, first, n = (np.array(x, dtype=np.int64) for x in zip(*sorted(parts), strict=True))
            draws = np.random.Generator(np.random.PCG64([seed, g]))
            shard = g * per_group
            while n.sum():
                draw = draws.multivariate_hypergeometric(n, int(min(shard_slots, n.sum())), method="marginals")
                at = np.flatnonzero(draw)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(at), shard), pa.int64()), *[pa.array(x[at]) for x in (no, first, draw)]], names=["shard", "no", "first", "n"]
                )
                first, n, shard = first + draw, n - draw, shard + 1

    dealt = groups.where("n > 0").repartition(min(n_groups, MAX_PARTS), "g")
    return dealt.mapInArrow(deal, "shard bigint, no bigint, first bigint, n bigint"), n_groups * per_group


def plan_mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: Sequence[float] = WEIGHTS,
    max_passes: int = MAX_PASSES,
    block_words: int = BLOCK_WORDS,
    shard_slots: int = SHARD_SLOTS,
    seed: int = SEED,
) -> Mix:
    """Plan a mix of all of ``docs``.

    What the driver holds is one row per source; everything that grows with
    the documents stays in tables."""
    spark = docs.sparkSession
    sized = stored(sizes(docs, id_col, source_col, text_col), "mix-words")
    per_source = sized.groupBy("source").agg(F.sum("size").alias("n")).collect()
    ordered = sorted(per_source, key=lambda r: (r["source"] is None, [ord(c) for c in r["source"] or ""]))
    total = [r["n"] for r in ordered]
    goal = targets(total, weights, max_passes)
    n_blocks = [-(-n // block_words) for n in total]
    n_slots = []
    for n, g, k in zip(total, goal, n_blocks, strict=True):
        passes = int(math.floor(g / n + 1e-9)) if n else 0
        rest = g - passes * n
        n_slots.append(passes * k + (min(k, round(rest / block_words)) if passes < max_passes else 0))
    sources = spark.createDataFrame(
        [(i, r["source"], n, float(g), k) for i, (r, n, g, k) in enumerate(zip(ordered, total, goal, n_blocks, strict=True))],
        "no int, source string, source_size bigint, target double, n_blocks bigint",
    )
    numbered = sized.join(F.broadcast(sources.select("no", F.col("source").alias("__s"))), F.col("source").eqNullSafe(F.col("__s"))).drop("__s")

    plan, n_shards = deal_shards(sources.sparkSession, n_slots, shard_slots, seed)
    plan = plan.repartition(max(1, min(n_shards, MAX_PARTS)), "shard")
    rng = np.random.Generator(np.random.PCG64(seed))
    keys = [int(x) for x in rng.integers(0, 1 << 62, size=len(total))]

    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            shard_of = np.asarray(rows["shard"])
            for s in np.unique(shard_of).tolist():
                mine = np.flatnonzero(shard_of == s)
                no = np.repeat([rows["no"][k] for k in mine], [rows["n"][k] for k in mine])
                j = np.concatenate([np.arange(rows["first"][k], rows["first"][k] + rows["n"][k]) for k in mine])
                block, pas = np.zeros_like(j), np.zeros_like(j)
                for i in np.unique(no).tolist():
                    at = np.flatnonzero(no == i)
                    pas[at] = j[at] // n_blocks[i]
                    for p in np.unique(pas[at]).tolist():
                        here = at[pas[at] == p]
                        block[here] = _feistel(j[here] % n_blocks[i], n_blocks[i], (keys[i] + 7919 * p) % (1 << 62))
                slot = np.argsort(mix64(np.arange(len(j), dtype=np.uint64) + np.uint64(seed + s)), kind="stable")
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(j), s), pa.int64()), pa.array(np.arange(len(j)), pa.int64()), *[pa.array(x[slot].astype(np.int64)) for x in (no, pas, block)]],
                    names=["shard", "slot", "no", "pass", "block"],
                )

    slots = plan.sortWithinPartitions("shard", "no").mapInArrow(fill, "shard bigint, slot bigint, no bigint, pass bigint, block bigint")
    # written, so that joins are planned by its real size (it grows with the corpus)
    slots = stored(slots.withColumn("no", F.col("no").cast("int")), "mix-slots")
    return Mix(_positions(numbered), sources, slots, block_words)


def taken(mix: Mix) -> DataFrame:
    """``(id, source, tie, size, taken)``, one row per input row: the words
    the mix takes from it, repeats counted."""
    words = mix.pieces().groupBy("no", "at").agg(F.sum((F.col("hi") - F.col("lo")) * F.col("taken")).alias("taken"))
    d = mix.docs
    # rows without words share a position with the next one; they take nothing
    full = d.where("size > 0").join(words, ["no", "at"], "left")
    empty = d.where("size = 0").withColumn("taken", F.lit(0).cast("bigint"))
    out = full.unionByName(empty, allowMissingColumns=True)
    return out.withColumn("taken", F.coalesce("taken", F.lit(0)))


def _take_words(raw: bytes, start: np.ndarray, end: np.ndarray, lo: np.ndarray, hi: np.ndarray, times: np.ndarray) -> bytes:
    """The words ``[lo, hi)`` of each span (in order), pass by pass, with the
    text's own white space inside a run; passes are set apart by a line end.
    ``start`` and ``end`` are the bounds of the text's words."""
    out = []
    for p in range(int(times.max())):
        a, b = lo[times > p], hi[times > p]
        first = np.ones(len(a), bool)
        first[1:] = a[1:] != b[:-1]
        at = np.flatnonzero(first)
        x, y = a[at], b[np.append(at[1:], len(a)) - 1]
        begin, stop = np.where(x == 0, 0, start[x]), np.where(y == len(start), len(raw), end[y - 1])
        out.append(b" ".join([raw[i:j] for i, j in zip(begin.tolist(), stop.tolist(), strict=True)]))
    return b"\n".join(out)


def mix_documents(docs: DataFrame, mix: Mix, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text") -> DataFrame:
    """``docs`` as the mix takes them: one row per document with any word
    taken, its text made of the taken words of each pass (a document taken
    whole twice holds its text twice); other columns unchanged.

    Texts are shuffled once, by id, source and text hash; equal rows take the
    spans of their own places, the n-th of them the n-th place."""
    i, s, t = (docs.columns.index(c) for c in (id_col, source_col, text_col))
    names = [f"c{k}" for k in range(len(docs.columns))]
    keys = ["__id", "__no_id", "__source", "__no_source", "__tie"]

    def key_columns(id_, source, tie):
        return [F.coalesce(id_, F.lit(0)).alias("__id"), id_.isNull().alias("__no_id"), F.coalesce(source, F.lit("")).alias("__source"),
                source.isNull().alias("__no_source"), tie.alias("__tie")]

    d = docs.toDF(*names)
    text = F.col(f"c{t}").cast("string")
    d = d.select(*names, *key_columns(F.col(f"c{i}").cast("bigint"), F.col(f"c{s}").cast("string"), F.xxhash64(text)))
    d = d.withColumn("__nth", F.row_number().over(Window.partitionBy(*keys).orderBy(F.lit(1))))
    spans = mix.pieces().groupBy("no", "at").agg(
        F.first("id").alias("id"), F.first("source").alias("source"), F.first("tie").alias("tie"),
        F.array_sort(F.collect_list(F.struct("lo", "hi", "taken"))).alias("spans"),
    )
    places = spans.select("at", "spans", *key_columns(F.col("id"), F.col("source"), F.col("tie"))).groupBy(*keys).agg(
        F.array_sort(F.collect_list(F.struct("at", "spans"))).alias("places")
    )
    mine = F.get("places", F.col("__nth") - 1)["spans"]
    joined = d.join(places, keys).withColumn("__s", mine).where("__s IS NOT NULL")
    joined = joined.select(*names, *[F.col("__s")[c].alias(f"__{c}") for c in ("lo", "hi", "taken")])
    kinds = ", ".join(f"{n} {'string' if n == f'c{t}' else f.dataType.simpleString()}" for n, f in zip(names, docs.schema, strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i_, j_, data, offsets in blocks(batch.column(t)):
                raw, part = data.tobytes(), batch.slice(i_, j_ - i_)
                start, end, first = find_words(data, offsets)
                spans = [part.column(len(names) + k) for k in range(3)]
                cut = np.append(0, np.cumsum(spans[0].value_lengths().to_numpy()))
                lo, hi, times = (x.flatten().to_numpy() for x in spans)
                out = []
                for r in range(j_ - i_):
                    base, words, mine = offsets[r], slice(first[r], first[r + 1]), slice(cut[r], cut[r + 1])
                    out.append(_take_words(raw[base : offsets[r + 1]], start[words] - base, end[words] - base, lo[mine], hi[mine], times[mine]).decode())
                cols = [part.column(k) for k in range(len(names))]
                cols[t] = pa.array(out, pa.string())
                yield pa.RecordBatch.from_arrays(cols, names=names)

    plain = joined.withColumn(f"c{t}", F.col(f"c{t}").cast("string"))
    return plain.mapInArrow(run, kinds).select(*[F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True)])


def with_sources(df: DataFrame, mix: Mix, no: str = "no") -> DataFrame:
    """Adds ``source_size`` and ``target`` (one row per source, collected once
    by `plan_mix`)."""
    s = mix.sources.select(F.col("no").alias("__no"), "source_size", "target")
    return df.join(F.broadcast(s), F.col(no) == F.col("__no")).drop("__no")


