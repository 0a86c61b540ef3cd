"""SimHash near-duplicates by deletion-variant signatures.

A text's fingerprint has the bits that are set in over half of its shingles'
XXH64 values.  Two fingerprints link at ``max_bits`` or fewer differing bits.
The 64 bits are cut into ``max_bits // 2 + 1`` segments: among that many, one
differs by at most one bit.  Each segment is indexed under its one-wildcard
variants (the segment with one bit deleted, for each bit), and two segments
within one bit of each other share the variant that deletes that bit, so an
equality join on the variants meets every link; whole fingerprints are then
compared.

Only distinct fingerprints are indexed.  A variant's fingerprints are compared
inside their group without emitting pairs: a group gives at most one link per
member.  All of a group agree on their segment but for its wildcard, so one
larger than ``MAX_GROUP`` is cut by the same idea applied to the other bits
only (some half of them is also within one bit), and again, until the bits
that are left bound its size.  Pairs that agree on the wildcard bit too meet
under every wildcard of the segment: only the first one's groups hold them,
and a large group of another wildcard is cut only if both values occur.

Edge cases: null and empty texts have no words and fingerprint zero, which
links like any other; a text shorter than a shingle is one shingle; a null id
is kept, and counts as larger than any id; rows that repeat an id are all
returned; extra columns are ignored; an empty table gives no rows.  A very long
text is a block of its own, all its shingles counted."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import LOWER, WORD_BYTES, blocks, eight_bytes, find_words, mapped, mix64, ragged
from .components import components

SHINGLE = 3
MAX_BITS = 3
MAX_GROUP = 2048
_SEED = 42  # fixed value: the seed of the shingle hash


_RUN = 255  # bits that a byte can sum


def _sum_bits(h: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per run of hashes, how many have each of the 64 bits: the bits are
    spread over bytes, summed as bytes in runs of at most `_RUN`, and the runs'
    sums are added up."""
    n = len(first) - 1
    out = np.zeros((n, 64), dtype=np.int64)
    size = np.diff(first)
    some = np.flatnonzero(size)
    for lo in range(0, len(some), 256):
        rows = some[lo : lo + 256]
        a, b = first[rows[0]], first[rows[-1] + 1]
        bits = np.unpackbits(h[a:b].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        pieces = -(-size[rows] // _RUN)
        start = np.cumsum(pieces) - pieces
        at = np.repeat(first[rows] - a, pieces) + (np.arange(int(pieces.sum())) - np.repeat(start, pieces)) * _RUN
        out[rows] = np.add.reduceat(np.add.reduceat(bits, at, axis=0, dtype=np.uint8), start, axis=0, dtype=np.int64)
    return out


_P1, _P2, _P3, _P4, _P5 = (
    np.uint64(p) for p in (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)
)
_LONG = 512  # bytes; longer ranges go one by one through the library
_SOME = 1 << 14  # ranges hashed at a time, so that what is computed stays in the cache


def _rotl(x: np.ndarray, n: int) -> np.ndarray:
    return (x << np.uint64(n)) | (x >> np.uint64(64 - n))


def _round(acc: np.ndarray, lane: np.ndarray) -> np.ndarray:
    return _rotl(acc + lane * _P2, 31) * _P1


def _xxh64(at: np.ndarray, start: np.ndarray, size: np.ndarray, seed: int) -> np.ndarray:
    """XXH64 of byte ranges of at most `_LONG` bytes; ``at`` is `eight_bytes`."""
    zero, salt = np.uint64(0), np.uint64(seed)
    h = np.full(len(start), salt + _P5)
    pos, left = start.copy(), size.copy()
    todo = np.flatnonzero(size >= 32)
    if len(todo):
        p, n = start[todo], size[todo]
        v = [np.full(len(todo), x) for x in (salt + _P1 + _P2, salt + _P2, salt + zero, salt - _P1)]
        on = np.arange(len(todo))
        while len(on):
            for k in range(4):
                v[k][on] = _round(v[k][on], at[p[on] + 8 * k])
            p[on] += 32
            n[on] -= 32
            on = on[n[on] >= 32]
        acc = _rotl(v[0], 1) + _rotl(v[1], 7) + _rotl(v[2], 12) + _rotl(v[3], 18)
        for x in v:
            acc = (acc ^ _round(np.full(len(x), zero), x)) * _P1 + _P4
        h[todo], pos[todo], left[todo] = acc, p, n
    h += size.astype(np.uint64)
    for _ in range(3):  # at most 31 bytes are left
        on = np.flatnonzero(left >= 8)
        if not len(on):
            break
        h[on] = _rotl(h[on] ^ _round(np.full(len(on), zero), at[pos[on]]), 27) * _P1 + _P4
        pos[on] += 8
        left[on] -= 8
    on = np.flatnonzero(left >= 4)
    h[on] = _rotl(h[on] ^ ((at[pos[on]] & np.uint64(0xFFFFFFFF)) * _P1), 23) * _P2 + _P3
    pos[on] += 4
    left[on] -= 4
    for _ in range(3):
        on = np.flatnonzero(left)
        if not len(on):
            break
        h[on] = _rotl(h[on] ^ ((at[pos[on]] & np.uint64(0xFF)) * _P5), 11) * _P1
        pos[on] += 1
        left[on] -= 1
    h = (h ^ (h >> np.uint64(33))) * _P2
    h = (h ^ (h >> np.uint64(29))) * _P3
    return h ^ (h >> np.uint64(32))


def xxh64(data: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = _SEED) -> np.ndarray:
    """XXH64 of each byte range, many ranges at a time."""
    at, size = eight_bytes(data), end - start
    out = np.empty(len(start), np.uint64)
    long = np.flatnonzero(size > _LONG)
    with np.errstate(over="ignore"):
        for a in range(0, len(start), _SOME):
            some = slice(a, a + _SOME)
            out[some] = _xxh64(at, start[some], np.minimum(size[some], _LONG), seed)
    for k in long.tolist():
        out[k] = xxhash.xxh64_intdigest(data[start[k] : end[k]], seed)
    return out


def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints of a block of texts."""
    data = mapped(data, LOWER)
    start, end, first = find_words(data, offsets)
    n_words = np.diff(first)
    # words one space apart in one buffer, so that every shingle is a slice of it
    size = end - start
    flat = np.full(int(size.sum()) + len(size), 0x20, np.uint8)
    at = np.cumsum(size + 1) - (size + 1)
    inside = np.ones(len(flat), bool)
    inside[at + size] = False
    flat[inside] = data[mapped(data, WORD_BYTES)]
    n_sh = np.where(n_words > 0, np.maximum(n_words - shingle + 1, 1), 0)
    begin = ragged(first[:-1], n_sh)
    row = np.repeat(np.arange(len(n_words)), n_sh)
    last = np.minimum(begin + shingle, first[1:][row]) - 1
    h = xxh64(flat, at[begin], at[last] + size[last])
    bounds = np.concatenate([[0], np.cumsum(n_sh)])
    over = _sum_bits(h, bounds) * 2 > n_sh[:, None]
    return np.packbits(over, axis=1, bitorder="little").view("<u8").reshape(-1)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, tie, fp)``: a hash of the text that tells rows of one id apart,
    and the fingerprint as a signed bigint; no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(2)):
                fp = fingerprints_of(data, offsets, shingle)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(fp.view(np.int64))], names=["id", "tie", "fp"]
                )

    text = F.col(text_col).cast("string")
    rows = docs.select(F.col(id_col).cast("bigint").alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
    return rows.mapInArrow(run, "id bigint, tie bigint, fp bigint")


_KEY = 42  # bits of a key below its path and wildcard
_PATHS = 1 << 16


def _levels(max_bits: int, max_group: int) -> list[list[tuple[list[int], list[int]]]]:
    """For each level of cutting, ``(bits of the segment, bits left)`` by path:
    path ``p`` goes on into the paths ``p * n + k`` of the next level, which cut
    the bits it leaves into ``n`` segments.  The last level's groups are bounded
    by the bits left and the wildcards above them."""
    n = max_bits // 2 + 1
    levels, left = [], [list(range(64))]
    while True:
        cuts = [(bits, [len(bits) * k // n for k in range(n + 1)]) for bits in left]
        levels.append([(bits[c[k] : c[k + 1]], bits[: c[k]] + bits[c[k + 1] :]) for bits, c in cuts for k in range(n)])
        left = [rest for _, rest in levels[-1]]
        free = max(map(len, left)) + len(levels)
        if 1 << free <= max_group or min(map(len, left)) < 2 * n or len(left) * n > _PATHS:
            return levels


def _variants(fp: np.ndarray, segments: list[tuple[int, list[int]]], parent: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """``(keys, which fingerprint)``: all one-wildcard variants of the segments
    ``(path, bits)``; a key holds the path, the wildcard and the other bits
    (hashed, where they are many or come with the key of the group being cut)."""
    keys = []
    for path, bits in segments:
        mask = sum(1 << b for b in bits)
        for w, bit in enumerate(bits):
            rest = fp & np.uint64(mask & ~(1 << bit))
            if parent is not None:
                with np.errstate(over="ignore"):
                    rest = mix64(rest + mix64(parent)) >> np.uint64(64 - _KEY)
            elif len(bits) <= _KEY:
                rest = rest >> np.uint64(bits[0])
            else:
                rest = mix64(rest) >> np.uint64(64 - _KEY)
            keys.append(rest | np.uint64((path << 6 | w) << _KEY))
    which = np.tile(np.arange(len(fp)), len(keys))
    return np.concatenate(keys) if keys else fp, which


def _link(fp: np.ndarray, max_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what is joined among distinct ``fp``, at most one for
    each: ``(member, first member linked to it directly or not)``.  Compared a
    slice at a time."""
    n = len(fp)
    label = np.arange(n)
    while True:
        new = label.copy()
        for lo in range(0, n, 512):
            near = np.bitwise_count(fp[lo : lo + 512, None] ^ fp[None, :]) <= max_bits
            new[lo : lo + 512] = np.where(near, label[None, :], n).min(axis=1)
        new = new[new]
        if (new == label).all():
            break
        label = new
    at = np.flatnonzero(label != np.arange(n))
    return fp[at], fp[label[at]]


class _Groups:
    """Cuts sorted ``(key, fp)`` batches into groups of equal key, the last one
    of a batch going on into the next.  Groups of up to ``limit`` are linked;
    of larger ones each part is given out as it comes, so no more than
    ``limit`` and a batch are held, and at the end their key, if they are to be
    cut.  ``segments`` are the bits of each path."""

    def __init__(self, max_bits: int, limit: int | None, segments: list[list[int]]):
        self.max_bits, self.limit, self.segments = max_bits, limit, segments
        self.key, self.fp, self.over = None, np.zeros(0, np.uint64), False
        self.some, self.all, self.cut = 0, -1, []

    def feed(self, key: np.ndarray, fp: np.ndarray, last: bool = False):
        """``(links a, links b, [(key, members of an oversize group)], [key to cut])``"""
        a, b, large, self.cut = [], [], [], []
        cut = np.flatnonzero(key[1:] != key[:-1]) + 1
        lo = np.concatenate([[0], cut]).astype(np.int64) if len(key) else np.zeros(0, np.int64)
        hi = np.concatenate([cut, [len(key)]]).astype(np.int64) if len(key) else lo
        todo = range(len(lo))
        if len(lo) and (self.key is None or key[0] == self.key):
            self.key = key[0]
            self._add(fp[: hi[0]], large)
            todo = todo[1:]
        if len(lo) and len(todo) and self.key is not None or last:
            self._close(a, b)
        if len(todo):
            whole = todo[:-1]  # the last group may go on
            size = hi - lo
            two = np.array([k for k in whole if size[k] == 2], dtype=np.int64)
            if len(two):
                x, y = fp[lo[two]], fp[lo[two] + 1]
                ok = np.bitwise_count(x ^ y) <= self.max_bits
                a.append(y[ok])
                b.append(x[ok])
            for k in whole:
                if size[k] > 2:
                    self.key = key[lo[k]]
                    self._add(fp[lo[k] : hi[k]], large)
                    self._close(a, b)
            k = todo[-1]
            self.key = key[lo[k]]
            self._add(fp[lo[k] : hi[k]], large)
        none = np.zeros(0, np.uint64)
        return np.concatenate([*a, none]), np.concatenate([*b, none]), large, self.cut

    def _add(self, fp: np.ndarray, large: list) -> None:
        self.fp = np.concatenate([self.fp, fp])
        if self.limit is not None and (self.over or len(self.fp) > self.limit):
            large.append((self.key, self.fp))
            self.some |= int(np.bitwise_or.reduce(self.fp))
            self.all &= int(np.bitwise_and.reduce(self.fp))
            self.over, self.fp = True, np.zeros(0, np.uint64)

    def _close(self, a: list, b: list) -> None:
        if self.over:
            path, w = divmod(int(self.key) >> _KEY, 64)
            if w == 0 or (self.some ^ self.all) >> self.segments[path][w] & 1:
                self.cut.append(self.key)
        elif len(self.fp) > 1:
            u, v = _link(self.fp, self.max_bits)
            a.append(u)
            b.append(v)
        self.key, self.fp, self.over = None, np.zeros(0, np.uint64), False
        self.some, self.all = 0, -1


_ROWS = "key bigint, fp bigint"
_LINKS = "kind int, a bigint, b bigint"


def _batch(kind: int, a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(a), kind), pa.int32()), pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["kind", "a", "b"]
    )


def _pairs(key: np.ndarray, fp: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(fp.view(np.int64))], names=["key", "fp"])


def _spread(level: list):
    """Fingerprints to the variants of the first level."""
    segments = [(path, bits) for path, (bits, _) in enumerate(level)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column(0).to_numpy().view(np.uint64)
            for lo in range(0, len(fp), 2000):
                part = fp[lo : lo + 2000]
                key, which = _variants(part, segments)
                yield _pairs(key, part[which])

    return run


def _spread_again(level: list, n: int):
    """Members ``(key, fp)`` of groups being cut to the variants, inside their
    group, of the bits that its path has left."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, fps = (batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))
            for lo in range(0, len(fps), 2000):
                key, fp = keys[lo : lo + 2000], fps[lo : lo + 2000]
                paths = key >> np.uint64(_KEY + 6)
                for p in np.unique(paths).tolist():
                    at = paths == p
                    sub, which = _variants(fp[at], [(q, level[q][0]) for q in range(p * n, p * n + n)], key[at])
                    yield _pairs(sub, fp[at][which])

    return run


def _group(max_bits: int, limit: int | None, level: list):
    """Sorted ``(key, fp)`` rows to links (kind 0), members of oversize groups
    (kind 1: key, fp) and the keys of those to cut (kind 2)."""
    segments = [bits for bits, _ in level]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        g = _Groups(max_bits, limit, segments)
        for batch in batches:
            yield from out(g.feed(*(batch.column(k).to_numpy().view(np.uint64) for k in (0, 1))))
        yield from out(g.feed(np.zeros(0, np.uint64), np.zeros(0, np.uint64), last=True))

    def out(found) -> Iterator[pa.RecordBatch]:
        a, b, large, cut = found
        if len(a):
            yield _batch(0, a, b)
        for key, fp in large:
            yield _batch(1, np.full(len(fp), key, np.uint64), fp)
        if cut:
            key = np.array(cut, np.uint64)
            yield _batch(2, key, key)

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, max_group: int = MAX_GROUP) -> DataFrame:
    """``(a, b)``: enough of the links among distinct fingerprints (column
    ``fp``) to connect all that are connected."""
    levels = _levels(max_bits, max_group)
    rows = distinct.select("fp").mapInArrow(_spread(levels[0]), _ROWS)
    found = []
    for depth in range(len(levels)):
        last = depth == len(levels) - 1
        grouped = rows.repartition("key").sortWithinPartitions("key").mapInArrow(
            _group(max_bits, None if last else max_group, levels[depth]), _LINKS
        )
        if last:
            found.append(grouped.select("a", "b"))
            break
        out = stored(grouped, "simhash-links")
        found.append(out.where("kind = 0").select("a", "b"))
        cut = out.where("kind = 2").select("a")
        if cut.isEmpty():
            break
        large = out.where("kind = 1").select("a", "b").join(cut, "a", "left_semi")
        rows = large.select("a", "b").mapInArrow(_spread_again(levels[depth + 1], max_bits // 2 + 1), _ROWS)
    return reduce(DataFrame.unionAll, found)


def near_duplicates(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id, tie, fp, component_id, component)``, one row per input row: the
    fingerprint as a signed bigint, the smallest id reachable over links, and
    the component's own number."""
    fps = stored(fingerprints(docs, shingle, id_col, text_col), "simhash")
    distinct = fps.groupBy("fp").agg(F.min("id").alias("low"))
    roots = components(links(distinct, max_bits))
    labelled = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("component", F.coalesce("component", "fp"))
    labelled = stored(labelled, "simhash-roots")
    least = labelled.groupBy("component").agg(F.min("low").alias("component_id"))
    of_fp = labelled.join(least, "component").select("fp", "component_id", "component")
    return fps.join(of_fp, "fp").select("id", "tie", "fp", "component_id", "component")


def keep_one(
    docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one with the
    smallest id (a null one only where there is no other; of rows that share
    it, the one whose text's hash is smallest; of equal rows, one)."""
    keys = ["__id", "__null", "__tie"]
    group = near_duplicates(docs, shingle, max_bits, id_col, text_col).groupBy("component")
    best = group.agg(F.min(F.struct(F.col("id").isNull().alias("n"), "id", "tie")).alias("k"))
    best = best.select(F.coalesce("k.id", F.lit(0)).alias("__id"), F.col("k.n").alias("__null"), F.col("k.tie").alias("__tie"))
    names = [f"c{i}" for i in range(len(docs.columns))]
    given = F.col(f"c{docs.columns.index(id_col)}").cast("bigint")
    rows = docs.toDF(*names).select(
        *names, F.coalesce(given, F.lit(0)).alias("__id"), given.isNull().alias("__null"),
        F.xxhash64(F.col(f"c{docs.columns.index(text_col)}").cast("string")).alias("__tie"),
    )
    kept = rows.join(best, keys, "left_semi").groupBy(*keys).agg(F.first(F.struct(*names)).alias("row"))
    return kept.select(*[F.col("row")[n].alias(c) for n, c in zip(names, docs.columns, strict=True)])
