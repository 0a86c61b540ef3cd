"""Substring dedup over bytes by hash-compared suffix sorting.

Every repeat of ``window`` bytes shares its sparse suffixes: those that begin
at anchors, the positions where the hash of the next ``GRAM`` bytes is least
within a window.  Each block of texts sorts its anchored suffixes by mergesort.
Two suffixes are compared by their longest common extension, which binary
search finds with a few prefix polynomial hashes, so a comparison costs the
logarithm of its length.  Neighbours in the order that agree over the whole
context of their windows, to the left as well, are one class; their bytes are
compared, and a collision stops the job.  One member of each class leaves the
block.  Spark's sort merges the blocks' runs by the suffixes' hashes (see
`_repeats`); where contexts agree in part only, their windows are compared by
two independent hashes.  A class's key is the hash of the anchor's bytes with
half a window beside it (before it, where the window ends too soon after).

A byte is removed if a window over it also starts earlier: in a document with a
smaller id, or earlier in the same one.

Edge cases: null and empty texts have no bytes; texts shorter than a window
lose nothing; a null id counts as smaller than any other; rows that share an id
do not remove each other's bytes; extra columns are ignored.  Very long texts are
handled a segment of windows at a time.  An empty table gives no rows."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import NULL_ID, Cutter, keyed, repeat_spans, unpack
from ._text import blocks, byte_table, eight_bytes, mix64, mul_mod, prefix_hash, ragged, range_hash, sub_mod

WINDOW = 100
GRAM = 16
SEGMENT = 1 << 20
_PLACE = np.uint64((1 << 24) - 1)


def _grams(data: np.ndarray, g: int) -> np.ndarray:
    """A rank for the ``g`` bytes from every place on.  It only chooses the
    anchors, so equal ranks of unlike bytes do no harm."""
    at, m = eight_bytes(data), len(data) - g + 1
    rank = np.zeros(m, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, g, 8):
            part = at[k : k + m] if g - k >= 8 else at[k : k + m] & np.uint64((1 << 8 * (g - k)) - 1)
            rank += part * np.uint64(pow(0x9E3779B97F4A7C15, k // 8 + 1, 1 << 64))
    return mix64(rank)


def _least(a: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    have = 1
    while have * 2 <= width:
        a = np.minimum(a[:-have], a[have:])
        have *= 2
    return np.minimum(a[: len(a) - (width - have)], a[width - have :]) if have < width else a


class SuffixOrder:
    """Mergesort of suffixes of one byte array, compared through prefix hashes."""

    def __init__(self, data: np.ndarray, prefix: np.ndarray, inv: np.ndarray, at: np.ndarray, size: np.ndarray):
        """Suffixes begin at ``at`` and end after ``size`` bytes."""
        self.data, self.prefix, self.inv, self.at, self.size = data, prefix, inv, at, size

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Longest common extension of suffix pairs, by binary search."""
        pa_, pb = self.at[a], self.at[b]
        lo, hi = np.zeros(len(a), np.int64), np.minimum(self.size[a], self.size[b])
        ia, ib = self.inv[pa_], self.inv[pb]
        base_a, base_b = self.prefix[pa_], self.prefix[pb]
        while (lo < hi).any():
            mid = (lo + hi + 1) >> 1
            same = mul_mod(sub_mod(self.prefix[pa_ + mid], base_a), ia) == mul_mod(sub_mod(self.prefix[pb + mid], base_b), ib)
            lo, hi = np.where(same, mid, lo), np.where(same, hi, mid - 1)
        return lo

    def before(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """True where suffix ``a`` sorts strictly before suffix ``b``."""
        n = self.common(a, b)
        end = n == np.minimum(self.size[a], self.size[b])
        top = len(self.data) - 1
        x, y = self.data[np.minimum(self.at[a] + n, top)], self.data[np.minimum(self.at[b] + n, top)]
        return np.where(end, self.size[a] < self.size[b], x < y)

    def sort(self, items: np.ndarray, group: np.ndarray) -> np.ndarray:
        """``items`` (suffix numbers, rows of a group adjacent) sorted inside
        each group.  All groups' runs of one length are merged at once: the
        place of a suffix is its own place in its run plus how many of the
        other run go before it."""
        n = len(items)
        begin = np.ones(n, bool)
        begin[1:] = group[1:] != group[:-1]
        first = np.flatnonzero(begin)
        of = np.cumsum(begin) - 1
        size = np.diff(np.append(first, n))[of]
        base = first[of]
        r = np.arange(n) - base
        cur, width = items.copy(), 1
        while n and width < size.max():
            run = r // width
            other = (run ^ 1) * width
            lo, hi = np.minimum(other, size), np.minimum(other + width, size)
            from_ = lo.copy()
            left = run % 2 == 0
            while True:
                act = np.flatnonzero(lo < hi)
                if not len(act):
                    break
                mid = (lo[act] + hi[act]) >> 1
                x, y = cur[act], cur[base[act] + mid]
                in_left = left[act]
                less = self.before(np.where(in_left, y, x), np.where(in_left, x, y))
                goes = np.where(in_left, less, ~less)  # the other one goes before
                lo[act] = np.where(goes, mid + 1, lo[act])
                hi[act] = np.where(goes, hi[act], mid)
            place = base + (run >> 1) * 2 * width + (r - run * width) + (lo - from_)
            nxt = np.empty_like(cur)
            nxt[place] = cur
            cur, width = nxt, width * 2
        return cur


class _Entries:
    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        self.data = self.units = data
        self.first = offsets
        self.row = self.start = self.n = self.pos = np.zeros(0, np.int64)
        self.key = self.code = np.zeros(0, np.uint64)
        self.prefix = self.inv = None


class SuffixSort(Cutter):
    earlier_in_text = True
    unit = np.dtype("u1")

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, gram

    def spell(self, units: np.ndarray, seed: int) -> np.ndarray:
        return byte_table(seed + 100)[units]

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> _Entries:
        e = _Entries(data, offsets)
        parts = [self._segment(e, a, min(a + SEGMENT, len(data)), a == 0 and len(data) <= 2 * SEGMENT) for a in self._cuts(len(data))]
        parts = [p for p in parts if p is not None]
        if parts:
            e.row, e.start, e.n, e.pos, e.key, e.code = (np.concatenate(x) for x in zip(*parts, strict=True))
        return e

    def _cuts(self, n: int) -> list[int]:
        return [0] if n <= 2 * SEGMENT else list(range(0, n, SEGMENT))

    def _segment(self, e: _Entries, a: int, b: int, whole: bool):
        """Entries of the windows that start in ``[a, b)`` (all, if ``whole``)."""
        w, g = self.window, self.gram
        if whole:
            b = len(e.data)
        size = np.diff(e.first)
        n = np.maximum(size - w + 1, 0)
        lo = np.clip(a - e.first[:-1], 0, n)
        hi = np.clip(b - e.first[:-1], 0, n)
        starts = ragged(e.first[:-1] + lo, hi - lo) - a
        if not len(starts):
            return None
        row = np.repeat(np.arange(len(n)), hi - lo)
        data = e.data[a : b + w - 1]
        prefix, inv = prefix_hash(byte_table(1)[data])
        if whole:
            e.prefix, e.inv = prefix, inv
        m = len(data) - g + 1
        gram = _grams(data, g)
        place = np.arange(m, dtype=np.uint64)
        low = _least((gram & ~_PLACE) | place, w - g + 1)
        pos = (low[starts] & _PLACE).astype(np.int64)
        # windows with the anchor in their second part take the bytes before it
        half = (w - g) // 2
        late = pos - starts > half
        new = np.ones(len(pos), bool)
        new[1:] = (pos[1:] != pos[:-1]) | (late[1:] != late[:-1])
        head = np.flatnonzero(new)
        s, k, p, late = starts[head], np.diff(np.append(head, len(pos))), pos[head], late[head]
        beside = np.where(late, p - half, p)
        key = mix64(range_hash(prefix, inv, beside, beside + g + half) + late.astype(np.uint64))
        code = mix64(range_hash(prefix, inv, s, s + k - 1 + w) + mix64((p - s).astype(np.uint64) + np.uint64(17)))
        return row[head], s + a, k, p + a, key, code

    def classes(self, e: _Entries) -> np.ndarray:
        """Classes of equal context, by sorting the suffixes of equal key."""
        if e.prefix is None:  # a text of several segments
            return super().classes(e)
        order = np.argsort(e.key, kind="stable")
        k = e.key[order]
        tied = np.zeros(len(k), bool)
        tied[1:] = k[1:] == k[:-1]
        tied[:-1] |= tied[1:]
        out = np.arange(len(k))
        items = order[tied]
        if not len(items):
            return out
        end = e.start + e.n - 1 + self.window
        suffixes = SuffixOrder(e.data, e.prefix, e.inv, e.pos, end - e.pos)
        items = suffixes.sort(items, e.key[items])
        a, b = items[:-1], items[1:]
        full = (e.key[a] == e.key[b]) & (suffixes.size[a] == suffixes.size[b])
        same = np.zeros(len(a), bool)
        same[full] = suffixes.common(a[full], b[full]) == suffixes.size[a[full]]
        run = np.concatenate([[0], np.cumsum(~same)])
        # of equal suffixes, those whose contexts also agree before the anchor
        left = e.pos[items] - e.start[items]
        before = range_hash(e.prefix, e.inv, e.start[items], e.pos[items])
        again = np.lexsort((items, before, left, run))
        run, left, before, items = run[again], left[again], before[again], items[again]
        eq = (run[1:] == run[:-1]) & (left[1:] == left[:-1]) & (before[1:] == before[:-1])
        x, y = items[:-1][eq], items[1:][eq]
        size = end[x] - e.start[x]
        if len(x) and not (e.data[ragged(e.start[x], size)] == e.data[ragged(e.start[y], size)]).all():
            raise RuntimeError("two different contexts have the same hash: choose another byte table")
        out[items] = len(out) + np.concatenate([[0], np.cumsum(~eq)])
        return out


def remove_repeated_bytes(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_bytes, n_removed, n_spans, kept)``, one row per input row:
    ``kept`` holds the bytes left (which may cut a character)."""
    rows = keyed(docs, id_col, text_col)
    spans = repeat_spans(rows, SuffixSort(window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                raw = data.tobytes()
                kept, removed, count = [], [], []
                for r in range(j - i):
                    at, end = int(offsets[r]), int(offsets[r + 1])
                    span = batch.column(2)[i + r]
                    parts, gone, n = [], 0, 0
                    if span.is_valid:
                        base = at
                        for s, t in unpack(span.as_py()).tolist():
                            parts.append(raw[at : base + s])
                            at, gone, n = base + t, gone + t - s, n + 1
                    parts.append(raw[at:end])
                    kept.append(b"".join(parts))
                    removed.append(gone)
                    count.append(n)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(offsets), pa.int64()), pa.array(removed, pa.int64()), pa.array(count, pa.int64()), pa.array(kept, pa.binary())],
                    names=["id", "n_bytes", "n_removed", "n_spans", "kept"],
                )

    joined = rows.join(spans, ["id", "tie"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "n_bytes", "n_removed", "n_spans", "kept")
