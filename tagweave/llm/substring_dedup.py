"""Substring dedup over words by recompression.

A text is a sequence of word names.  In each round, runs of one name become one
symbol (named by the name and the run's length), then neighbouring pairs whose
first is a left and whose second a right name (a bit of the name, drawn anew
each round) become one.  A symbol's name is a 64-bit digest of what it stands
for, so all tasks give equal content equal names without a dictionary passing
between rounds, and equal substrings get equal symbols except near their ends.
What is certain inside a window depends on the window alone: a run at its edge
may go on outside and is dropped, and so is an edge symbol that may pair with a
neighbour outside.

The interior symbol of the highest round that leaves one, smallest name first,
is the window's anchor; its name with the half window of words beside it (to
the right, or to the left where the window ends too soon) is the key.  Two
Spark rounds follow (see `_repeats`): keys that occur
in several documents reveal repeats, the names of whole contexts and then of
single windows (a second, independent digest beside the first) verify them.

A word is removed if a window over it also starts in a document with a smaller
id.

Edge cases: null and empty texts have no words; texts shorter than a window
lose nothing; a null id counts as smaller than any other; rows that share an
id do not remove each other's words; extra columns are ignored; an empty table
gives no rows.  A very long text is a block of its own, cut as a whole."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._repeats import NULL_ID, Cutter, keyed, repeat_spans, unpack
from ._text import blocks, find_words, mix64, prefix_hash, range_hash, row_of, word_hashes

WINDOW = 13
# A 13-word window is sure of some six symbols after one round and of one to
# four after two.  One round leaves fewer entries (0.29 a word against 0.45) and
# as few contexts that agree in part only (2 % of the windows).
ROUNDS = 1


class _Entries:
    def __init__(self, words: np.ndarray, first: np.ndarray):
        self.units, self.first = words, first
        self.row = self.start = self.n = np.zeros(0, np.int64)
        self.key = self.code = np.zeros(0, np.uint64)


def _next_round(sym: np.ndarray, lo: np.ndarray, hi: np.ndarray, begin: np.ndarray, seed: int):
    """One round over a block's symbols.  ``[lo, hi)``: the certain symbols of
    each window; ``begin``: each symbol's first word.  Text ends need no care:
    a symbol over two texts is inside no window."""
    with np.errstate(over="ignore"):
        # runs
        new = np.ones(len(sym), bool)
        new[1:] = sym[1:] != sym[:-1]
        at = np.flatnonzero(new)
        length = np.diff(np.append(at, len(sym)))
        run = np.cumsum(new) - 1
        name = np.where(length > 1, mix64(sym[at] + mix64(length.astype(np.uint64) + np.uint64(seed))), sym[at])
        begin = begin[at]
        empty = lo >= hi
        lo, hi = run[np.minimum(lo, len(run) - 1)] + 1, run[np.maximum(hi - 1, 0)]
        # pairs
        right = (mix64(name + np.uint64(0x9E3779B97F4A7C15 * seed % (1 << 64))) >> np.uint64(63)).astype(bool)
        second = np.zeros(len(name), bool)
        second[1:] = right[1:] & ~right[:-1]
        empty |= lo >= hi
        safe = np.minimum(lo, len(name) - 1)
        lo = lo + right[safe]  # may end a pair that begins outside
        safe = np.maximum(hi - 1, 0)
        hi = hi - ~right[safe]  # may begin a pair that ends outside
        empty |= lo >= hi
        paired = np.append(second[1:], False)
        joined = np.where(paired, mix64(name + mix64(np.append(name[1:], np.uint64(0)) + np.uint64(2 * seed + 1))), name)
        keep = ~second
        at = np.cumsum(keep) - 1
        lo, hi = at[np.minimum(lo, len(at) - 1)], at[np.maximum(hi - 1, 0)] + 1
        hi = np.where(empty, lo, hi)
        return joined[keep], lo, hi, begin[keep]


class Recompression(Cutter):
    earlier_in_text = False
    unit = np.dtype("<u8")

    def __init__(self, window: int = WINDOW, rounds: int = ROUNDS):
        self.window, self.rounds = window, rounds

    def spell(self, units: np.ndarray, seed: int) -> np.ndarray:
        return mix64(units ^ np.uint64(0x5851F42D4C957F2D * seed % (1 << 64)))

    def cut(self, data: np.ndarray, offsets: np.ndarray) -> _Entries:
        start, end, first = find_words(data, offsets)
        words = word_hashes(data, start, end)
        e = _Entries(words, first)
        prefix, inv = prefix_hash(words)
        row = row_of(first)
        j = np.arange(len(words))
        ok = j + self.window <= first[1:][row]
        j, row = j[ok], row[ok]
        if not len(j):
            return e
        # the key's symbol: of the highest round with a certain one, by name
        sym, lo, hi, begin = words, j, j + self.window, np.arange(len(words))
        key = np.zeros(len(j), np.uint64)
        at = np.full(len(j), -1)
        todo = [(0, sym, lo, hi, begin)]
        for r in range(1, self.rounds + 1):
            sym, lo, hi, begin = _next_round(sym, lo, hi, begin, r)
            todo.append((r, sym, lo, hi, begin))
        for r, sym, lo, hi, begin in reversed(todo):
            need = np.flatnonzero((at < 0) & (lo < hi))
            if not len(need):
                continue
            rank = mix64(sym + np.uint64(r))
            best = lo[need].copy()
            low = rank[best]
            for d in range(1, int((hi - lo)[need].max())):
                k = lo[need] + d
                k_in = np.minimum(k, hi[need] - 1)
                better = (k < hi[need]) & (rank[k_in] < low)
                best = np.where(better, k_in, best)
                low = np.where(better, rank[k_in], low)
            key[need] = low
            at[need] = begin[best] * (self.rounds + 1) + r
        # windows with the anchor in their second half take the words before it
        place = at // (self.rounds + 1)
        half = self.window // 2
        late = place - j >= half
        new = np.ones(len(j), bool)
        new[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1]) | (late[1:] != late[:-1])
        head = np.flatnonzero(new)
        e.row, e.start, e.n = row[head], j[head], np.diff(np.append(head, len(j)))
        place, late = place[head], late[head]
        beside = np.where(late, place - half, place)
        with np.errstate(over="ignore"):
            e.key = mix64(key[head] + range_hash(prefix, inv, beside, beside + half + 1) + late.astype(np.uint64))
            inside = (place - e.start).astype(np.uint64)
            e.code = mix64(range_hash(prefix, inv, e.start, e.start + e.n - 1 + self.window) + mix64(inside + np.uint64(17)))
        return e


def remove_repeats(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, n_words, n_removed, kept)``, one row per input row: the words
    left, one space between."""
    rows = keyed(docs, id_col, text_col)
    spans = repeat_spans(rows, Recompression(window))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                start, end, first = find_words(data, offsets)
                raw = data.tobytes()
                kept, removed = [], []
                for r in range(j - i):
                    a, b = int(first[r]), int(first[r + 1])
                    keep = np.ones(b - a, bool)
                    span = batch.column(2)[i + r]
                    if span.is_valid:
                        for s, t in unpack(span.as_py()).tolist():
                            keep[s:t] = False
                    at = np.flatnonzero(keep) + a
                    kept.append(b" ".join([raw[x:y] for x, y in zip(start[at].tolist(), end[at].tolist(), strict=True)]).decode())
                    removed.append(b - a - len(at))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array(np.diff(first), pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())],
                    names=["id", "n_words", "n_removed", "kept"],
                )

    joined = rows.join(spans, ["id", "tie"], "left").select("id", "text", "spans")
    out = joined.mapInArrow(run, "id bigint, n_words bigint, n_removed bigint, kept string")
    return out.select(F.when(F.col("id") != NULL_ID, F.col("id")).alias(id_col), "n_words", "n_removed", "kept")
