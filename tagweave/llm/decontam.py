"""Benchmark decontamination with a generalised suffix automaton of the
normalised test items.

The automaton accepts every run of words of every item.  Training words are
streamed through it; the state and the matched length after each word give the
longest item run that ends there.  A window (``window`` consecutive words of an
item, or a whole shorter item) occurs where the matched length reaches it; the
words inside are hit, and spans are removed when they exceed the length or
coverage limits.

A text is first reduced to the runs of words whose neighbouring pairs all occur
in the items: no match can leave such a run, and only they are walked.

Items are dealt to tasks and cut into blocks of at most ``MAX_BLOCK_WORDS``
words, one automaton each, written to the shared folder; a batch of texts
streams past one automaton after the other.  Neither the driver nor a task holds
the test set.

Edge cases: null texts and items have no words; items without words are
ignored; equal items each count; a null document id is kept, and every input
row gives one output row; extra columns are ignored; with no items nothing is
hit, an empty table of documents gives no rows.  A very long text is scanned
whole, as a block of its own; a very long item is an automaton of its own."""

from __future__ import annotations

import pickle
import uuid
from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from ._scratch import commit, filesystem
from ._text import LOWER, blocks, find_words, mix64, per_text, word_hashes

WINDOW = 10
MAX_BLOCK_WORDS = 1 << 18

# [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing A-Z
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = True
_WORD[0x61:0x7B] = True
_WORD[0x80:] = True
_WORD_ANY_CASE = _WORD[LOWER]


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(a + mix64(b * np.uint64(3)))


def _member(sorted_values: np.ndarray, x: np.ndarray) -> np.ndarray:
    if not len(sorted_values):
        return np.zeros(len(x), bool)
    at = np.minimum(np.searchsorted(sorted_values, x), len(sorted_values) - 1)
    return sorted_values[at] == x


class SuffixAutomaton:
    """Generalised suffix automaton over word sequences, with the items whose
    windows each state stands for."""

    def __init__(self, items: Sequence[Sequence[int]], window: int):
        self.window = window
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        for seq in items:
            last = 0
            for w in seq:
                last = self._extend(last, w)
        # the states that hold a window: found by walking each item once
        self.items_at: dict[int, list[tuple[int, int]]] = {}  # state -> (window length, item)
        for k, seq in enumerate(items):
            size = min(window, len(seq))
            for s in {s for s, n in self._walk(seq, size) if n == size}:
                self.items_at.setdefault(s, []).append((size, k))
        self.items_of: dict[int, dict[int, list[int]]] = {}  # state -> window length -> items
        for s, pairs in self.items_at.items():
            by = self.items_of.setdefault(s, {})
            for size, k in pairs:
                by.setdefault(size, []).append(k)
        # nearest state on the way to the root, itself included, that holds windows
        self.holder = [-1] * len(self.link)
        for s in sorted(range(len(self.link)), key=self.length.__getitem__):
            self.holder[s] = s if s in self.items_at else (self.holder[self.link[s]] if self.link[s] >= 0 else -1)

    def _extend(self, last: int, w: int) -> int:
        nxt, link, length = self.next, self.link, self.length
        if w in nxt[last]:
            q = nxt[last][w]
            if length[q] == length[last] + 1:
                return q
            return self._split(last, w, q)
        cur = len(nxt)
        nxt.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p != -1 and w not in nxt[p]:
            nxt[p][w] = cur
            p = link[p]
        if p != -1:
            q = nxt[p][w]
            link[cur] = q if length[q] == length[p] + 1 else self._split(p, w, q)
        return cur

    def _split(self, p: int, w: int, q: int) -> int:
        """The part of ``q`` that ends the shorter run of ``p`` and ``w``."""
        nxt = self.next
        clone = len(nxt)
        nxt.append(dict(nxt[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        while p != -1 and nxt[p].get(w) == q:
            nxt[p][w] = clone
            p = self.link[p]
        self.link[q] = clone
        return clone

    def _walk(self, words: Sequence[int], cap: int | None = None) -> Iterator[tuple[int, int]]:
        """``(state, matched length)`` after each word.  With ``cap`` the match
        is cut to its last ``cap`` words, so the state is that of the window."""
        nxt, link, length = self.next, self.link, self.length
        s, n = 0, 0
        for w in words:
            t = nxt[s].get(w)
            while t is None and s:
                s = link[s]
                n = length[s]
                t = nxt[s].get(w)
            if t is None:
                n = 0
            else:
                s, n = t, n + 1
            if cap is not None and n > cap:
                n = cap
            if cap is not None:
                while s and length[link[s]] >= n:
                    s = link[s]
            yield s, n

    def windows(self, words: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """``(last word, window length, state)`` of every window occurrence;
        `items_of` has the items whose windows of that length a state ends."""
        for j, (s, n) in enumerate(self._walk(words, self.window)):
            h = self.holder[s]
            while h != -1:
                for size in self.items_of[h]:
                    if size <= n:
                        yield j, size, h
                up = self.link[h]
                h = self.holder[up] if up >= 0 else -1


class ItemBlock:
    """The automaton of a block of items, and what finds the runs to walk."""

    def __init__(self, ids: list[str], hashes: list[np.ndarray], window: int):
        self.ids = ids
        self.words = np.unique(np.concatenate(hashes)) if hashes else np.zeros(0, np.uint64)
        # which leading bits the words' hashes have: most other words are told apart by them
        bits = (8 * len(self.words)).bit_length()
        self.shift, self.near = np.uint64(64 - bits), np.zeros(1 << bits, bool)
        self.near[self.words >> self.shift] = True
        self.pairs = np.unique(np.concatenate([_pair(h[:-1], h[1:]) for h in hashes])) if hashes else self.words
        self.shortest = min([window, *[len(h) for h in hashes]])
        self.automaton = SuffixAutomaton([np.searchsorted(self.words, h).tolist() for h in hashes], window)

    def scan(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, dict[int, set[int]]]:
        """Hit flag of each word of a block of texts; items found per text."""
        n = len(words)
        hit = np.zeros(n, dtype=bool)
        found: dict[int, set[int]] = {}
        if not n or not len(self.words):
            return hit, found
        known = self.near[words >> self.shift]
        at = np.flatnonzero(known)
        known[at] = _member(self.words, words[at])
        joined = np.zeros(n, dtype=bool)  # this word and the next one are neighbours in an item
        joined[:-1] = known[:-1] & known[1:]
        edge = first[1:-1]
        joined[edge[(edge > 0) & (edge <= n)] - 1] = False
        at = np.flatnonzero(joined)
        joined[at] = _member(self.pairs, _pair(words[at], words[at + 1]))
        start = known.copy()
        start[1:] &= ~joined[:-1]
        start = np.flatnonzero(start)
        end = np.flatnonzero(known & ~joined) + 1
        long = end - start >= self.shortest
        start, end = start[long], end[long]
        row = np.searchsorted(first, start, side="right") - 1
        seen: dict[int, set[tuple[int, int]]] = {}
        for a, b, r in zip(start.tolist(), end.tolist(), row.tolist(), strict=True):
            states = seen.setdefault(r, set())
            for j, size, state in self.automaton.windows(np.searchsorted(self.words, words[a:b]).tolist()):
                hit[a + j - size + 1 : a + j + 1] = True
                states.add((state, size))
        # a window's items are listed once a text, however often it occurs
        for r, states in seen.items():
            found[r] = {k for state, size in states for k in self.automaton.items_of[state][size]}
        return hit, found


def item_blocks(rows: Iterator[tuple[str | None, pa.Array]], window: int = WINDOW, max_words: int = MAX_BLOCK_WORDS) -> Iterator[ItemBlock]:
    """Automata of items, a bounded block at a time (an item of more words
    stands alone).  ``rows``: item ids and their texts, an array of each."""
    ids: list[str] = []
    hashes: list[np.ndarray] = []
    total = 0
    for items, texts in rows:
        for i, j, data, offsets in blocks(texts):
            start, end, first = find_words(data, offsets, _WORD_ANY_CASE)
            h = word_hashes(data, start, end, lower=True)
            for k in range(j - i):
                mine = h[first[k] : first[k + 1]]
                if not len(mine):
                    continue
                if total and total + len(mine) > max_words:
                    yield ItemBlock(ids, hashes, window)
                    ids, hashes, total = [], [], 0
                ids.append(items[i + k].as_py())
                hashes.append(mine)
                total += len(mine)
    if ids:
        yield ItemBlock(ids, hashes, window)


def write_blocks(items: DataFrame, id_col: str = "item_id", text_col: str = "text", window: int = WINDOW, max_words: int = MAX_BLOCK_WORDS) -> list[str]:
    """Automata of all items, built by tasks and written to the shared folder:
    their files' names.  The items are dealt by a hash, one task for about
    ``max_words`` words, so neither a task nor the driver holds the test set;
    a lost task's files are written anew under other names."""
    root = scratch_path(items.sparkSession, "automata")
    rows = items.select(F.col(id_col).cast("string").alias("item"), F.col(text_col).cast("string").alias("text"))
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    parts = max(1, -(-size // (8 * max_words)))

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = filesystem(root)
        files.create_dir(where, recursive=True)
        for block in item_blocks(((b.column(0), b.column(1)) for b in batches), window, max_words):
            name = f"block-{uuid.uuid4().hex}"
            stream, finish = commit(files, f"{where}/{name}")
            pickle.dump(block, stream, protocol=pickle.HIGHEST_PROTOCOL)
            finish()
            yield pa.RecordBatch.from_arrays([pa.array([name])], names=["name"])

    dealt = rows.repartitionById(parts, F.pmod(F.xxhash64("item", "text"), F.lit(parts)).cast("int"))
    names = dealt.sortWithinPartitions("item", "text").mapInArrow(build, "name string").collect()
    return sorted(f"{root}/{r.name}" for r in names)


@lru_cache(maxsize=1)
def _load(path: str) -> ItemBlock:
    """A block's automaton; a worker keeps the last one, the only one where the
    test set is small."""
    files, where = filesystem(path)
    with files.open_input_file(where) as f:
        return pickle.loads(f.read())


def _runs(hit: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(text, first word, last word + 1)`` of maximal hit runs inside texts."""
    n = len(hit)
    begin, stop = hit.copy(), hit.copy()
    begin[1:] &= ~hit[:-1]
    stop[:-1] &= ~hit[1:]
    cut = first[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    begin[cut] = hit[cut]
    stop[cut - 1] = hit[cut - 1]
    a, b = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    return np.searchsorted(first, a, side="right") - 1, a, b


def scan(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    max_span: int = 0,
    max_coverage: float = 0.5,
    max_block_words: int = MAX_BLOCK_WORDS,
) -> DataFrame:
    """All columns of ``docs`` plus ``__n_words, __n_hit, __items`` (sorted
    distinct item ids), ``__clean`` (the text without its hit spans longer
    than ``max_span`` words) and ``__drop`` (more than ``max_coverage`` of the
    words are hit).  A removed span runs from its first word's first byte to
    its last word's last byte.

    Map-only: texts are never shuffled; each task holds one batch of texts and
    one automaton, read from the shared folder."""
    automata = write_blocks(items, window=window, max_words=max_block_words)
    names = [f"c{i}" for i in range(len(docs.columns))]
    plain, at_text = docs.toDF(*names), docs.columns.index(text_col)
    if docs.schema[at_text].dataType.simpleString() != "string":  # else sent to Python once
        plain, at_text = plain.withColumn("text", F.col(f"c{at_text}").cast("string")), len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # one automaton after the other over the batch's texts
            cuts, hits, items_of = [], [], []
            for path in automata or [None]:
                automaton = _load(path) if path else ItemBlock([], [], window)
                for n, (i, j, data, offsets) in enumerate(blocks(batch.column(at_text))):
                    start, end, first = find_words(data, offsets, _WORD_ANY_CASE)
                    h, f = automaton.scan(word_hashes(data, start, end, lower=True), first)
                    if n == len(cuts):
                        cuts.append((i, j, data, offsets, first))
                        hits.append(h)
                        items_of.append([set() for _ in range(j - i)])
                    else:
                        hits[n] |= h
                    for r, ks in f.items():
                        items_of[n][r].update(str(automaton.ids[k]) for k in ks)
            for (i, j, data, offsets, first), hit, found in zip(cuts, hits, items_of, strict=True):
                n_words, n_hit = np.diff(first), per_text(hit, first)
                clean: list[str | None] = [None] * (j - i)
                if hit.any():
                    start, end, _ = find_words(data, offsets, _WORD_ANY_CASE)
                    text, lo, hi = _runs(hit, first)
                    cut = hi - lo > max_span
                    text, lo, hi = text[cut], lo[cut], hi[cut]
                    raw = data.tobytes()
                    for r in np.unique(text).tolist():
                        parts, at = [], int(offsets[r])
                        for a, b in zip(lo[text == r].tolist(), hi[text == r].tolist(), strict=True):
                            parts.append(raw[at : start[a]])
                            at = end[b - 1]
                        clean[r] = b"".join([*parts, raw[at : offsets[r + 1]]]).decode("utf-8")
                yield pa.RecordBatch.from_arrays(
                    [
                        *[batch.column(k).slice(i, j - i) for k in range(len(names))],
                        pa.array(n_words, pa.int64()),
                        pa.array(n_hit, pa.int64()),
                        pa.array([sorted(x) for x in found], pa.list_(pa.string())),
                        pa.array(clean, pa.string()),
                        pa.array(n_hit > max_coverage * np.maximum(n_words, 1)),
                    ],
                    names=[*names, "__n_words", "__n_hit", "__items", "__clean", "__drop"],
                )

    types = ", ".join(f"{c} {f.dataType.simpleString()}" for c, f in zip(names, docs.schema, strict=True))
    out = plain.mapInArrow(run, f"{types}, __n_words bigint, __n_hit bigint, __items array<string>, __clean string, __drop boolean")
    return out.select(*[F.col(c).alias(d) for c, d in zip(names, docs.columns, strict=True)], "__n_words", "__n_hit", "__items", "__clean", "__drop")


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", **limits) -> DataFrame:
    """``docs`` without the spans (and, beyond the coverage limit, without the
    documents) that occur in ``items``; columns as before."""
    found = scan(docs, items, text_col=text_col, **limits).where(~F.col("__drop"))
    return found.withColumn(text_col, F.coalesce("__clean", text_col)).select(*docs.columns)

