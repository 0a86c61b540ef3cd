"""Near-duplicates by shared shingles: documents whose sets of word shingles
have a Jaccard similarity at or over a limit are linked, through an LSH forest.

Equal sets are one node from the start.  A node's MinHash signature has
``TREES * DEPTH`` values, and a tree is one order to read them in: it begins at
its own ``DEPTH`` values and goes on round the signature.  Sorted by that order,
nodes that agree in their first ``DEPTH`` values stand together: they form a
region, and all of a region are each other's candidates.  At a similarity of
0.85 two nodes share a region in at least one of the 10 trees with probability
1 - (1 - 0.85^3)^10 = 0.99993.

Candidates are compared in bounded units of nodes, inside a task, on the full
sets; a unit gives only the links that join its nodes up, never all its pairs.

1. First tree.  A region that fits a unit is one.  A larger one is read deeper
   (twice, four times, ... the depth) until its parts fit: in dense regions the
   longest common prefixes come first.  What still agrees in the whole
   signature is dealt to units at random, each with the region's first node.
2. All trees, with what is linked by now.  Regions that are one component, or
   that were compared whole, are done.  The others are compared whole: a region
   over a unit's size is cut into blocks and every pair of blocks is a unit,
   but for pairs inside the region's largest component.  So nothing is lost by
   the cuts of the first step, whatever the size of a region.

Shingles are 64-bit hashes of a mix of their words' 64-bit hashes; equal sets
meet by 128 bits.

Edge cases.  A text of fewer words than a shingle is one shingle; one without
words (null, empty, white space) has an empty set and no links.  Texts of any
length are read whole; one longer than a unit is a unit's block alone.  Rows
that share an id are rows of their own, equal rows have equal results.  A null
id is no candidate for ``component_id``, which is null where no linked row has
one.  An empty table gives an empty result.  Other columns are not read."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import blocks, find_words, mix64, row_of, word_hashes
from .components import components

SHINGLE = 5
TREES, DEPTH = 10, 3
UNIT = 256  # nodes of a unit's block
UNIT_SHINGLES = 1 << 19  # shingles of a unit's block, if it has more than one node
_FREQUENT = 16


def shingles(data: np.ndarray, offsets: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """``(sets, bounds)``: each text's distinct shingles, sorted, in a row."""
    start, end, first = find_words(data, offsets)
    h = word_hashes(data, start, end, lower=True)
    n_words = np.diff(first)
    with np.errstate(over="ignore"):
        joined = np.zeros(max(len(h) - size + 1, 0), np.uint64)
        for k in range(size):
            joined = mix64(joined + h[k : len(h) - size + 1 + k] * np.uint64(2 * k + 3)) if len(joined) else joined
        out = []
        for i, n in enumerate(n_words.tolist()):
            a = int(first[i])
            if n >= size:
                out.append(np.unique(joined[a : a + n - size + 1]))
            elif n:
                short = np.uint64(n)
                for k in range(n):
                    short = mix64(np.array([short + h[a + k] * np.uint64(2 * k + 3)]))[0]
                out.append(np.array([short ^ np.uint64(0x5BD1E995)]))
            else:
                out.append(np.zeros(0, np.uint64))
    bounds = np.zeros(len(out) + 1, np.int64)
    np.cumsum([len(x) for x in out], out=bounds[1:])
    return np.concatenate(out) if out else np.zeros(0, np.uint64), bounds


def signatures(sets: np.ndarray, bounds: np.ndarray, count: int) -> np.ndarray:
    """MinHash values, the upper 32 bits of the least, of each set that has one."""
    some = np.flatnonzero(np.diff(bounds))
    out = np.zeros((len(bounds) - 1, count), np.uint32)
    if not len(some):
        return out
    salt = mix64(np.arange(1, 2 * count + 1, dtype=np.uint64))
    at = bounds[some]
    with np.errstate(over="ignore"):
        for k in range(count):
            h = (sets ^ salt[k]) * (salt[count + k] | np.uint64(1))
            out[some, k] = np.minimum.reduceat(h, at) >> np.uint64(32)
    return out


_SIGS = "id bigint, tie bigint, n bigint, digest binary, sig array<int>"


def _signed(docs: DataFrame, shingle: int, id_col: str, text_col: str) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(2)):
                sets, bounds = shingles(data, offsets, shingle)
                sig = signatures(sets, bounds, TREES * DEPTH).view(np.int32)
                n = np.diff(bounds)
                digest = [xxhash.xxh3_128_digest(sets[a:b].tobytes()) if b > a else None for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
                lists = pa.ListArray.from_arrays(pa.array(np.arange(j - i + 1, dtype=np.int32) * sig.shape[1]), pa.array(sig.reshape(-1)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(n), pa.array(digest, pa.binary()), lists],
                    names=["id", "tie", "n", "digest", "sig"],
                )

    return _texts(docs, id_col, text_col).mapInArrow(run, _SIGS)


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.col(text_col).cast("string")
    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))


# comparing a unit

def shared_counts(sets: list[np.ndarray]) -> np.ndarray:
    """How many values each two sorted sets share (above the diagonal)."""
    m = len(sets)
    of = np.repeat(np.arange(m), [len(s) for s in sets])
    values = np.concatenate(sets)
    order = np.argsort(values, kind="stable")
    values, of = values[order], of[order]
    new = np.ones(len(values), bool)
    new[1:] = values[1:] != values[:-1]
    group = np.cumsum(new) - 1
    size = np.diff(np.append(np.flatnonzero(new), len(values)))[group] if len(values) else group
    out = np.zeros((m, m), np.int64)
    # values of few sets: pairs at each distance in their group
    few = (size > 1) & (size < _FREQUENT)
    g, o = group[few], of[few]
    for d in range(1, _FREQUENT - 1):
        hit = np.flatnonzero(g[d:] == g[:-d]) if len(g) > d else g[:0]
        if not len(hit):
            break
        out += np.bincount(o[hit] * m + o[hit + d], minlength=m * m).reshape(m, m)
    # values of many sets: products of membership matrices, some values at a time
    many = size >= _FREQUENT
    if many.any():
        column, o = group[many], of[many]
        column = np.cumsum(np.append(0, np.diff(column) != 0))
        total, step = int(column[-1]) + 1, 1 << 12
        edge = np.searchsorted(column, np.arange(0, total + step, step))
        for k, (a, b) in enumerate(zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True)):
            x = np.zeros((m, min(step, total - k * step)), np.float32)
            x[o[a:b], column[a:b] - k * step] = 1
            out += np.triu((x @ x.T).astype(np.int64), 1)
    return out


def links_of(sets: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join up all sets linked at ``percent``, at most one less than
    there are sets."""
    n = np.array([len(s) for s in sets], np.int64)
    inter = shared_counts(sets)
    a, b = np.nonzero(np.triu(100 * inter >= percent * (n[:, None] + n[None, :] - inter), 1))
    root = list(range(len(sets)))

    def find(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        p, q = find(x), find(y)
        if p != q:
            root[max(p, q)] = min(p, q)
            out.append((x, y))
    return out


def _compared(members: DataFrame, texts: DataFrame, shingle: int, percent: int) -> DataFrame:
    """Links ``(a, b)`` between the nodes of each unit of ``(unit, node)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, nodes, sets = None, [], []
        a, b = [], []

        def close() -> None:
            seen = {node: k for k, node in reversed(list(enumerate(nodes)))}  # a first node may be dealt twice
            keep = sorted(seen.values())
            for x, y in links_of([sets[k] for k in keep], percent) if len(keep) > 1 else []:
                a.append(nodes[keep[x]])
                b.append(nodes[keep[y]])

        for batch in batches:
            unit, node = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, j, data, offsets in blocks(batch.column(2)):
                flat, bounds = shingles(data, offsets, shingle)
                for k in range(i, j):
                    if unit[k] != now:
                        close()
                        now, nodes, sets = unit[k], [], []
                    nodes.append(node[k])
                    sets.append(flat[bounds[k - i] : bounds[k - i + 1]].copy())
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])
            a, b = [], []
        close()
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])

    rows = members.join(texts, "node").select("unit", "node", "text").repartition("unit").sortWithinPartitions("unit")
    return rows.mapInArrow(run, "a bigint, b bigint")


def _key(tree, depth: int):
    """Region of a tree at a depth: the first values in the tree's order."""
    twice = F.concat("sig", "sig")
    return F.xxhash64(F.lit(depth), tree, F.slice(twice, tree * DEPTH + 1, F.lit(depth)))


def _fits():
    return (F.col("c") <= UNIT) & (F.col("w") <= UNIT_SHINGLES)


def _first_tree(nodes: DataFrame) -> DataFrame:
    """``(unit, node, whole)`` of the first tree; ``whole`` says that the unit
    is a region of the least depth."""
    units, rest, depth, last = [], nodes.select("node", "n", "sig"), DEPTH, TREES * DEPTH
    while True:
        keyed = rest.withColumn("unit", _key(F.lit(0), depth))
        sizes = keyed.groupBy("unit").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.min("node").alias("pivot")).where("c > 1")
        met = stored(keyed.join(sizes, "unit"), "forest")
        units.append(met.where(_fits()).select("unit", "node", F.lit(depth == DEPTH).alias("whole")))
        rest = met.where(~_fits())
        if depth == last or rest.isEmpty():
            break
        rest, depth = rest.select("node", "n", "sig"), min(2 * depth, last)
    if depth == last:
        n = _n_blocks(F.col("c"), F.col("w"))
        dealt = rest.select(F.xxhash64("unit", F.pmod(F.xxhash64("node"), n)).alias("unit"), "node", F.lit(False).alias("whole"))
        pivots = rest.select("unit", "pivot", n.alias("k")).distinct()
        pivots = pivots.select("unit", F.col("pivot").alias("node"), F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("k") - 1)).alias("k"))
        units += [dealt, pivots.select(F.xxhash64("unit", "k").alias("unit"), "node", F.lit(False).alias("whole"))]
    out = units[0]
    for u in units[1:]:
        out = out.unionByName(u)
    return out


def _n_blocks(c, w):
    return F.greatest(F.ceil(c / F.lit(UNIT)), F.ceil(w / F.lit(UNIT_SHINGLES))).cast("bigint")


def _all_trees(nodes: DataFrame, known: DataFrame) -> DataFrame:
    """``(unit, node)`` of what the first step has not settled.  ``known``:
    ``(node, component, whole)``, the last the region that was compared whole."""
    trees = F.explode(F.array(*[F.lit(t) for t in range(TREES)]))
    keyed = nodes.join(known, "node", "left").select(
        "node", "n", F.coalesce("component", "node").alias("component"), F.coalesce("whole", F.col("node")).alias("whole"), "sig", trees.alias("tree")
    ).select("node", "n", "component", "whole", _key(F.col("tree"), DEPTH).alias("region"))
    # regions of the same nodes in several trees are one
    size = keyed.groupBy("region").agg(
        F.count(F.lit(1)).alias("c"), F.sum("n").alias("w"), F.min("component").alias("lo"), F.max("component").alias("hi"),
        F.min("whole").alias("wlo"), F.max("whole").alias("whi"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64("node") % (1 << 20)).alias("y"),
    ).where("c > 1 AND lo <> hi AND wlo <> whi")
    open_ = stored(size.groupBy("c", "w", "x", "y").agg(F.min("region").alias("region")), "regions")
    rows = stored(keyed.select("node", "n", "component", "region").join(open_.select("region", "c", "w"), "region"), "open")
    single = rows.where(_fits()).select(F.col("region").alias("unit"), "node")
    # blocks: the largest component's come first, and no pair lies inside it
    large = rows.where(~_fits())
    parts = large.groupBy("region", "component").agg(F.count(F.lit(1)).alias("c1"), F.sum("n").alias("w1"))
    most = parts.groupBy("region").agg(F.max(F.struct("c1", "component")).alias("m"), F.sum("c1").alias("c2"), F.sum("w1").alias("w2"))
    most = most.select("region", F.col("m.component").alias("big"), F.col("m.c1").alias("c1"), "c2", "w2")
    most = most.join(parts.select("region", F.col("component").alias("big"), "w1"), ["region", "big"])
    most = most.select(
        "region", "big", _n_blocks(F.col("c1"), F.col("w1")).alias("inner"),
        _n_blocks(F.col("c2") - F.col("c1"), F.col("w2") - F.col("w1")).alias("outer"),
    )
    dealt = large.select("region", "node", "component").join(most, "region")
    is_big = F.col("component") == F.col("big")
    dealt = dealt.withColumn("block", F.when(is_big, F.pmod(F.xxhash64("node"), F.col("inner"))).otherwise(F.col("inner") + F.pmod(F.xxhash64("node"), F.col("outer"))))
    others = F.when(F.col("block") < F.col("inner"), F.sequence(F.col("inner"), F.col("inner") + F.col("outer") - 1)).otherwise(
        F.sequence(F.lit(0).cast("bigint"), F.col("inner") + F.col("outer") - 1)
    )
    pairs = dealt.select("region", "node", "block", F.explode(others).alias("other"))
    return single.unionByName(pairs.select(F.xxhash64("region", F.least("block", "other"), F.greatest("block", "other")).alias("unit"), "node"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, percent: int = 85, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_shingles, component_id)`` for every row; see the module."""
    sigs = stored(_signed(docs, shingle, id_col, text_col), "signatures")
    nodes = sigs.where("n > 0").groupBy("digest").agg(
        F.min("id").alias("low"), F.min(F.struct("id", "tie")).alias("at"), F.first("n").alias("n"), F.first("sig").alias("sig")
    )
    nodes = stored(nodes.withColumn("node", F.monotonically_increasing_id()), "nodes")
    # texts of the nodes that have a neighbour in some tree
    trees = F.explode(F.array(*[F.lit(t) for t in range(TREES)]))
    keyed = nodes.select("node", "sig", trees.alias("tree")).select("node", _key(F.col("tree"), DEPTH).alias("region"))
    alone = keyed.groupBy("region").agg(F.min("node").alias("lo"), F.max("node").alias("hi")).where("lo <> hi").select("region")
    alive = keyed.join(alone, "region").select("node").distinct().join(nodes.select("node", "at"), "node")
    # one shuffle of the texts: the key is a struct, never null, of the same type on both sides
    at = F.struct("id", "tie").cast(nodes.schema["at"].dataType)
    texts = _texts(docs, id_col, text_col).select(at.alias("at"), "text").dropDuplicates(["at"])
    texts = stored(texts.join(alive.select("node", "at"), "at").select("node", "text"), "texts")

    units = stored(_first_tree(nodes), "units")
    links = stored(_compared(units.select("unit", "node"), texts, shingle, percent), "near")
    known = components(links)
    whole = units.where("whole").select("node", F.col("unit").alias("whole"))
    known = whole.join(known, "node", "full").select("node", "component", "whole")
    more = _compared(_all_trees(nodes, known), texts, shingle, percent)
    linked = components(links.unionByName(more))

    of = nodes.select("digest", "node", "low").join(linked, "node", "left").withColumn("component", F.coalesce("component", "node"))
    low = of.groupBy("component").agg(F.min("low").alias("component_id"))
    of = of.join(low, "component").select("digest", "component_id")
    out = sigs.select("id", "n", "digest").join(of, "digest", "left")
    return out.select("id", F.col("n").alias("n_shingles"), F.when(F.col("n") == 0, F.col("id")).otherwise(F.col("component_id")).alias("component_id"))
