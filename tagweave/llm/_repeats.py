"""Repeated windows across documents, found through content-defined anchors.

A method (a `Cutter`) assigns every window of a text to one anchor inside it,
by the window's own content, so equal windows have equal anchors at equal
places.  Consecutive windows of one anchor form an entry: the anchor's key, and
the code of the whole context that its windows cover.

1. Entries ``(key, code, id)`` meet by key.  Entries of equal key and code are
   equal contexts: all windows of those with a larger id are repeats.  The
   first of each code stays; where a key has several codes, contexts agree in
   part only and are open.
2. Open contexts meet by key, and their windows are compared by two independent
   hashes.  Those of a key with more codes than a task should hold (a passage
   that very many documents share, at its ends) do not: each of their windows
   goes its own way, by its hashes.

What is equal inside a block of texts is combined before anything is shuffled,
so a group of copies of any size sends a key once per block, and what a task
keeps between batches has a fixed bound whatever a key's count."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import blocks, mix64, prefix_hash, ragged, range_hash

MAX_CODES = 512  # codes of one key whose contexts are compared in one task
NULL_ID = -(1 << 63)  # stands for a null id, before every other
DUP, OPEN, OWN, WIDE = 0, 1, 2, 3
_LOW_BITS = np.uint64(3)  # of a key: 0 an entry, 1 one that repeats inside its block, 3 one that repeats inside its text


class Cutter:
    """What a method supplies.  `cut` returns an object with the arrays

    ``row, start, n, key, code``: one entry each, by text and position, with
    ``start`` the first window's unit in the block and ``n`` its windows;
    ``first``: each text's first unit (one more than texts); ``units``: the
    block's units.  ``spell`` gives the 64-bit values of units that window
    hashes are made of.  ``earlier_in_text`` says whether a window repeated
    inside its own text counts."""

    window: int
    earlier_in_text: bool
    unit: np.dtype
    block_bytes: int = 1 << 19

    def cut(self, data: np.ndarray, offsets: np.ndarray):
        raise NotImplementedError

    def spell(self, units: np.ndarray, seed: int) -> np.ndarray:
        raise NotImplementedError

    def classes(self, entries) -> np.ndarray:
        """Numbers that are equal where an entry's key and context are."""
        order = np.lexsort((entries.code, entries.key))
        k, c = entries.key[order], entries.code[order]
        new = np.ones(len(k), np.int64)
        new[1:] = (k[1:] != k[:-1]) | (c[1:] != c[:-1])
        out = np.empty(len(k), np.int64)
        out[order] = np.cumsum(new)
        return out


def _combine(cls: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of entries in classes: those to send on (one for each class, of its
    smallest id), and those known to repeat (one for each class and id)."""
    order = np.lexsort((ids, cls))
    c, i = cls[order], ids[order]
    new = np.ones(len(c), bool)
    new[1:] = c[1:] != c[:-1]
    step = new.copy()
    step[1:] |= i[1:] != i[:-1]
    return order[new], order[step & ~new]


def _entry_rows(key: np.ndarray, code: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(key.view(np.int64)), pa.array(code.view(np.int64)), pa.array(ids)], names=["key", "code", "id"]
    )


def _send(cls: np.ndarray, key: np.ndarray, code: np.ndarray, ids: np.ndarray, own: np.ndarray | None = None) -> pa.RecordBatch:
    """Rows for the shuffle by key.  The lowest bits of a key tell an entry
    from what is known already, which goes through any key to its document.
    ``own``: entries that repeat inside their own text."""
    first, again = _combine(cls, ids)
    own = np.zeros(0, np.int64) if own is None else own
    said = np.concatenate([again, own])
    with np.errstate(over="ignore"):
        any_key = mix64(code[said] + ids[said].view(np.uint64)) & ~_LOW_BITS
    any_key[: len(again)] |= np.uint64(1)
    any_key[len(again) :] |= np.uint64(3)
    return _entry_rows(np.concatenate([key[first] & ~_LOW_BITS, any_key]), np.concatenate([code[first], code[said]]), np.concatenate([ids[first], ids[said]]))


def entries(docs: DataFrame, cutter: Cutter) -> DataFrame:
    """``(key, code, id)`` of all texts (columns ``id, text``)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy()
            for i, j, data, offsets in blocks(batch.column(1), cutter.block_bytes):
                e = cutter.cut(data, offsets)
                if len(e.row):
                    cls, own = cutter.classes(e), None
                    if cutter.earlier_in_text:  # one row tells a text to look at itself
                        own = np.flatnonzero(~_first_in_text(e.row, mix64(e.code + e.key)))
                        own = own[np.unique(e.row[own], return_index=True)[1]]
                    yield _send(cls, e.key, e.code, ids[i:j][e.row], own)

    return docs.select("id", "text").mapInArrow(run, "key bigint, code bigint, id bigint")


def meet(rows: DataFrame, max_codes: int = MAX_CODES) -> DataFrame:
    """``(id, code, kind)``: which entries repeat one of a smaller id (DUP) or
    of their own text (OWN); also the first of each code where its key has
    several (OPEN), or more than ``max_codes`` (WIDE).  Rows stream in order of
    (key, code, id); what is kept between batches is the last row and at most
    ``max_codes`` codes of its key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = code = low = None  # of the last row, and the smallest id of its code
        held: list[tuple[np.ndarray, np.ndarray]] = []  # first ids and codes of the last key, not yet told
        wide = False

        def told(kind: int | None = None) -> list[tuple[np.ndarray, np.ndarray, int]]:
            n = sum(len(i) for i, _ in held)
            kind = kind if kind is not None else WIDE if wide else OPEN if n > 1 else None
            out = [(i, c, kind) for i, c in held] if kind is not None else []
            held.clear()
            return out

        def batch_of(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray | int]]) -> pa.RecordBatch:
            none = np.zeros(0, np.int64)
            cols = zip(*[(i, c, np.full(len(i), k) if np.isscalar(k) else k) for i, c, k in [(none, none, 0), *parts]], strict=True)
            i, c, k = (np.concatenate(x) for x in cols)
            return pa.RecordBatch.from_arrays([pa.array(i), pa.array(c), pa.array(k.astype(np.int8))], names=["id", "code", "kind"])

        for batch in batches:
            k, c, i = (batch.column(x).to_numpy() for x in range(3))
            local = (k & 1) == 1
            parts = [(i[local], c[local], np.where(k[local] & 2, OWN, DUP))]
            k, c, i = k[~local], c[~local], i[~local]
            if len(k):
                if key is not None and k[0] != key:
                    parts += told()
                    wide = False
                same = np.ones(len(k), bool)
                same[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
                same[0] = key is not None and k[0] == key and c[0] == code
                head = np.flatnonzero(~same)  # first row of each code
                lows = np.concatenate([[low if low is not None else 0], i[head]])
                of = np.cumsum(~same)
                dup = same & (i > lows[of])
                parts.append((i[dup], c[dup], DUP))
                if len(head):
                    hk = k[head]
                    cut = np.concatenate([[0], np.flatnonzero(hk[1:] != hk[:-1]) + 1, [len(hk)]])
                    size = np.diff(cut)
                    g = 0
                    if key is not None and hk[0] == key:
                        held.append((i[head[: cut[1]]], c[head[: cut[1]]]))
                        g = 1
                        if len(size) > 1:
                            parts += told()
                            wide = False
                    if g < len(size):
                        inner = np.repeat(size, size)
                        at = np.arange(len(head))
                        tell = head[(at >= cut[g]) & (at < cut[-2]) & (inner > 1)]
                        kinds = np.where(inner[(at >= cut[g]) & (at < cut[-2]) & (inner > 1)] > max_codes, WIDE, OPEN)
                        parts.append((i[tell], c[tell], kinds))
                        last = head[cut[-2] :]
                        held.append((i[last], c[last]))
                    if wide or sum(len(x) for x, _ in held) > max_codes:
                        parts += told(WIDE)
                        wide = True
                key, code, low = k[-1], c[-1], lows[of[-1]]
            yield batch_of(parts)
        yield batch_of(told())

    return rows.repartition("key").sortWithinPartitions("key", "code", "id").mapInArrow(run, "id bigint, code bigint, kind tinyint")


def _by_doc(messages: DataFrame) -> DataFrame:
    """One row per id: its repeated, its open and its wide codes."""
    pick = lambda kind: F.collect_list(F.when(F.col("kind") == kind, F.col("code")))
    return messages.groupBy("id").agg(pick(DUP).alias("dup"), pick(OPEN).alias("open"), pick(WIDE).alias("wide"))


def _lists(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """``(values, offsets)`` of a list<bigint> column."""
    off = column.offsets.to_numpy()
    return column.values.to_numpy()[off[0] : off[-1]] if len(off) else np.zeros(0, np.int64), off - (off[0] if len(off) else 0)


def _known(row: np.ndarray, code: np.ndarray, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """True where (row, code) is among the rows' lists."""
    if not len(values) or not len(row):
        return np.zeros(len(row), bool)
    r = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    with np.errstate(over="ignore"):
        want = np.sort(mix64(values.view(np.uint64) + mix64(r.astype(np.uint64))))
        have = mix64(code + mix64(row.astype(np.uint64)))
    return want[np.minimum(np.searchsorted(want, have), len(want) - 1)] == have


def _first_in_text(row: np.ndarray, code: np.ndarray) -> np.ndarray:
    """True at the first entry (they come by position) of each (row, code)."""
    order = np.lexsort((np.arange(len(row)), code, row))
    r, c = row[order], code[order]
    new = np.ones(len(r), bool)
    new[1:] = (r[1:] != r[:-1]) | (c[1:] != c[:-1])
    out = np.zeros(len(r), bool)
    out[order[new]] = True
    return out


def merge(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Union of ``[start, end)`` ranges; touching ranges become one."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    s, e = start[order], np.maximum.accumulate(end[order])
    new = np.ones(len(s), bool)
    new[1:] = s[1:] > e[:-1]
    at = np.flatnonzero(new)
    return s[at], e[np.append(at[1:], len(s)) - 1]


def _pack(*cols: np.ndarray) -> bytes:
    return np.stack([c.astype(np.int64) for c in cols], axis=1).tobytes() if len(cols[0]) else b""


def unpack(raw: bytes) -> np.ndarray:
    """Spans as rows of (start, end)."""
    return np.frombuffer(raw, np.int64).reshape(-1, 2)


def _window_hashes(cutter: Cutter, units: np.ndarray, base: np.ndarray, n: np.ndarray, seeds: tuple[int, ...]):
    """All windows of contexts that lie in ``units`` from ``base`` on: the
    context's number, the window's place in it, and its hashes."""
    row = np.repeat(np.arange(len(n)), n)
    d = ragged(np.zeros(len(n), np.int64), n)
    at = base[row] + d
    out = []
    for seed in seeds:
        prefix, inv = prefix_hash(cutter.spell(units, seed), seed)
        out.append(range_hash(prefix, inv, at, at + cutter.window))
    return row, d, out


_SEEN = "kind tinyint, id bigint, tie bigint, spans binary, key bigint, start bigint, n bigint, context binary, code bigint"


def _open_contexts(e, cutter: Cutter, at: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(entries, their contexts' units in a row, sizes)``, some at a time."""
    for lo in range(0, len(at), 5000):
        u = at[lo : lo + 5000]
        size = e.n[u] - 1 + cutter.window
        yield u, e.units[ragged(e.start[u], size)].astype(cutter.unit), size


def _seen_rows(kind: int, ids: np.ndarray, ties: np.ndarray, **cols) -> pa.RecordBatch:
    n = len(ids)
    types = {"spans": pa.binary(), "key": pa.int64(), "start": pa.int64(), "n": pa.int64(), "context": pa.binary(), "code": pa.int64()}
    rest = [cols[c] if c in cols else pa.nulls(n, t) for c, t in types.items()]
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), pa.array(ids), pa.array(ties), *rest], names=["kind", "id", "tie", *types])


def _look_again(docs: DataFrame, cutter: Cutter) -> DataFrame:
    """Texts with their messages.  ``kind`` 0: ``spans`` (unit ranges that
    repeat for sure) of a text; 1: an open entry with its context; 2: a window
    of a wide key, with its hashes as ``key`` and ``code``."""

    def windows(e, at: np.ndarray, seeds: tuple[int, ...]):
        """All windows of entries: text, unit, hashes."""
        row, start, hashes = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros((len(seeds), 0), np.uint64)]
        for u, units, size in _open_contexts(e, cutter, at):
            of, d, h = _window_hashes(cutter, units, np.cumsum(size) - size, e.n[u], seeds)
            row.append(e.row[u][of])
            start.append(e.start[u][of] + d)
            hashes.append(np.stack(h))
        return np.concatenate(row), np.concatenate(start), *np.concatenate(hashes, axis=1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            for i, j, data, offsets in blocks(batch.column(2), cutter.block_bytes):
                e = cutter.cut(data, offsets)
                m, own, tie = j - i, ids[i:j], ties[i:j]
                dup, unsure, wide = (_known(e.row, e.code, *_lists(batch.column(x).slice(i, m))) for x in (3, 4, 5))
                unsure &= ~dup
                wide &= ~dup
                s, n, row = [e.start[dup]], [e.n[dup]], [e.row[dup]]
                if cutter.earlier_in_text:
                    again = ~_first_in_text(e.row, mix64(e.code + e.key)) & ~unsure & ~wide & ~dup
                    # compared windows that the text itself has before
                    wr, ws, wh = windows(e, np.flatnonzero(unsure | wide), (1,))
                    later = ~_first_in_text(wr, wh)
                    s += [e.start[again], ws[later]]
                    n += [e.n[again], np.ones(later.sum(), np.int64)]
                    row += [e.row[again], wr[later]]
                wr, ws, w1, w2 = windows(e, np.flatnonzero(wide), (1, 2))
                if len(wr):
                    # the smallest id of a window goes on; a larger one in this block repeats for sure
                    order = np.lexsort((own[wr], w2, w1))
                    new = np.ones(len(order), bool)
                    new[1:] = (w1[order][1:] != w1[order][:-1]) | (w2[order][1:] != w2[order][:-1])
                    lowest = own[wr[order]][new][np.cumsum(new) - 1]
                    more = order[own[wr[order]] > lowest]
                    s.append(ws[more])
                    n.append(np.ones(len(more), np.int64))
                    row.append(wr[more])
                    go = order[own[wr[order]] == lowest]
                    yield _seen_rows(
                        2, own[wr[go]], tie[wr[go]], key=pa.array(w1[go].view(np.int64)), start=pa.array(ws[go] - e.first[wr[go]]), code=pa.array(w2[go].view(np.int64))
                    )
                s, n, row = np.concatenate(s), np.concatenate(n), np.concatenate(row)
                order = np.argsort(row, kind="stable")
                s, n, row = s[order], n[order], row[order]
                cut = np.searchsorted(row, np.arange(m + 1))
                some = np.flatnonzero(np.diff(cut))
                spans = []
                for r in some.tolist():
                    a, k = s[cut[r] : cut[r + 1]] - e.first[r], n[cut[r] : cut[r + 1]]
                    spans.append(_pack(*merge(a, a + k - 1 + cutter.window)))
                if len(some):
                    yield _seen_rows(0, own[some], tie[some], spans=pa.array(spans, pa.binary()))
                for u, units, size in _open_contexts(e, cutter, np.flatnonzero(unsure)):
                    end = np.cumsum(size) * cutter.unit.itemsize
                    context = pa.BinaryArray.from_buffers(
                        pa.binary(), len(u), [None, pa.py_buffer(np.concatenate([[0], end]).astype(np.int32)), pa.py_buffer(units)]
                    )
                    yield _seen_rows(
                        1, own[e.row[u]], tie[e.row[u]], key=pa.array(e.key[u].view(np.int64)), start=pa.array(e.start[u] - e.first[e.row[u]]),
                        n=pa.array(e.n[u]), context=context,
                    )

    return docs.mapInArrow(run, _SEEN)


_SPANS = "id bigint, tie bigint, start bigint, n bigint"


def _span_rows(*cols: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.asarray(c, dtype=np.int64)) for c in cols], names=["id", "tie", "start", "n"])


def _runs(ids, ties, start, flag) -> tuple[np.ndarray, ...]:
    """Flagged windows as ``(id, tie, start, n)`` of consecutive ones."""
    at = np.flatnonzero(flag)
    i, t, s = ids[at], ties[at], start[at]
    new = np.ones(len(at), bool)
    new[1:] = (s[1:] != s[:-1] + 1) | (i[1:] != i[:-1]) | (t[1:] != t[:-1])
    head = np.flatnonzero(new)
    return i[head], t[head], s[head], np.diff(np.append(head, len(at)))


def _compare(cutter: Cutter):
    """Windows of open contexts, which come in order of (key, id): one repeats
    if a row of a smaller id has it under the same key.  What is kept between
    batches is the windows of the last key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        none = np.zeros(0, np.uint64)
        key, seen1, seen2, seen_id = None, none, none, none.view(np.int64)
        for batch in batches:
            k, ids, ties, start, n = (batch.column(x).to_numpy() for x in range(5))
            if not len(k):
                continue
            raw = batch.column(5)
            off = np.frombuffer(raw.buffers()[1], np.int32)[raw.offset : raw.offset + len(raw) + 1].astype(np.int64)
            units = np.frombuffer(raw.buffers()[2], np.uint8)[off[0] : off[-1]].view(cutter.unit)
            base = (off[:-1] - off[0]) // cutter.unit.itemsize
            row, d, (w1, w2) = _window_hashes(cutter, units, base, n, (1, 2))
            if k[0] != key:
                seen1, seen2, seen_id = none, none, none.view(np.int64)
            old = len(seen1)
            a1, a2, ai = np.concatenate([seen1, w1]), np.concatenate([seen2, w2]), np.concatenate([seen_id, ids[row]])
            ak = np.concatenate([np.full(old, k[0]), k[row]])
            order = np.lexsort((np.arange(len(a1)), a2, a1, ak))
            new = np.ones(len(order), bool)
            new[1:] = (ak[order][1:] != ak[order][:-1]) | (a1[order][1:] != a1[order][:-1]) | (a2[order][1:] != a2[order][:-1])
            first = np.empty(len(order), np.int64)
            first[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]]
            yield _span_rows(*_runs(ids[row], ties[row], start[row] + d, ai[first[old:]] < ids[row]))
            keep = np.flatnonzero((first == np.arange(len(first))) & (ak == k[-1]))
            key, seen1, seen2, seen_id = k[-1], a1[keep], a2[keep], ai[keep]

    return run


def _settle(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows that come in order of (key, code, id): those of a larger id than
    the first of their code repeat."""
    key = code = low = None
    for batch in batches:
        k, c, ids, ties, start = (batch.column(x).to_numpy() for x in range(5))
        if not len(k):
            continue
        same = np.ones(len(k), bool)
        same[1:] = (k[1:] == k[:-1]) & (c[1:] == c[:-1])
        same[0] = key is not None and k[0] == key and c[0] == code
        lows = np.concatenate([[low if low is not None else 0], ids[~same]])
        first = lows[np.cumsum(~same)]
        at = np.flatnonzero(same & (ids > first))
        yield _span_rows(ids[at], ties[at], start[at], np.ones(len(at)))
        key, code, low = k[-1], c[-1], first[-1]


def _merge_spans(window: int):
    """One row per text from its packed spans and its runs of windows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for sure, starts, counts in zip(batch.column(2), batch.column(3), batch.column(4), strict=True):
                s = [unpack(x.as_py()) for x in sure.values]
                a, n = starts.values.to_numpy(), counts.values.to_numpy()
                x, y = merge(np.concatenate([*[p[:, 0] for p in s], a]), np.concatenate([*[p[:, 1] for p in s], a + n - 1 + window]))
                out.append(_pack(x, y))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.binary())], names=["id", "tie", "spans"])

    return run


def repeat_spans(docs: DataFrame, cutter: Cutter, max_codes: int = MAX_CODES) -> DataFrame:
    """``(id, tie, spans)`` of every text (columns ``id, tie, text``, id not
    null) with a repeat: 64-bit unit ranges, start and end by turns."""
    messages = _by_doc(meet(entries(docs, cutter), max_codes))
    told = docs.join(messages, "id").select("id", "tie", "text", "dup", "open", "wide")
    seen = stored(_look_again(told, cutter), "repeats")
    opened = seen.where("kind = 1").select("key", "id", "tie", "start", "n", "context")
    compared = opened.repartition("key").sortWithinPartitions("key", "id").mapInArrow(_compare(cutter), _SPANS)
    rest = seen.where("kind = 2").select("key", "code", "id", "tie", "start")
    settled = rest.repartition("key").sortWithinPartitions("key", "code", "id").mapInArrow(_settle, _SPANS)
    runs = compared.unionAll(settled).select("id", "tie", F.lit(None).cast("binary").alias("spans"), "start", "n")
    sure = seen.where("kind = 0").select("id", "tie", "spans", F.lit(None).cast("bigint").alias("start"), F.lit(None).cast("bigint").alias("n"))
    by_text = sure.unionAll(runs).groupBy("id", "tie").agg(
        F.collect_list("spans").alias("sure"), F.collect_list("start").alias("starts"), F.collect_list("n").alias("counts")
    )
    return by_text.mapInArrow(_merge_spans(cutter.window), "id bigint, tie bigint, spans binary")


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, tie, text)``: the id with null as the smallest, and a hash of the
    text that tells rows of one id apart."""
    text = F.col(text_col).cast("string")
    return docs.select(F.coalesce(F.col(id_col).cast("bigint"), F.lit(NULL_ID)).alias("id"), F.xxhash64(text).alias("tie"), text.alias("text"))
