"""Repair of conversation structure: the cheapest edits (keep, rerole, delete,
insert) that give a conversation the role order ``(s?(ua)+)?``.

Every turn becomes a symbol of its role and fault.  The symbol sequences of all
conversations, each different one once, are compressed by Re-Pair: a round
counts all neighbouring pairs in Spark, the most frequent ones become symbols
of their own, and the sequences are rewritten.  A symbol is a min-plus transfer
matrix over the four states of the role pattern, with the cheapest cost and its
audit (the edits' initials) as a rope; a rule's matrix is the product of its
two symbols' matrices, made once, bottom-up, and shared by all conversations.
A conversation is then a product of few matrices, taken from its end.

Of audits of one cost the least in ASCII order wins.  That goes with products:
two audits of the same turns have one letter that is not I a turn, so if one
were a beginning of the other, the other would have inserts more and cost more.

Turns are sorted by turn (null first), then role and the SHA-256 of role and
text.  The sort, the faults and the grammar deal turns by range, by digest and
by sequence, so a conversation of any length is many tasks there; only its
audit, and then its texts in order, pass through one task as a stream, since
the audit is one value.  A sequence is cut every ``SEGMENT`` turns.  The rules
are bounded (``RULES`` a round, ``ROUNDS`` rounds): pairs beyond them stay
apart and only cost more products.

Edge cases.  Null roles and texts count as one space, also for faults.  Rows of
one turn, role and text are told apart by nothing and count one after another;
all but the first are duplicates.  A null conversation is one of its own.  Very
long texts are read a row at a time.  A role that begins with none of s, u, a
(also an empty one) can only be reroled or deleted.  A conversation all of
whose turns go keeps an empty audit's result.  An empty table gives an empty
result.  Other columns, whatever their names, are not read."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import stored

SEGMENT = 4096  # turns
ROUNDS = 8
RULES = 512  # of a round

REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

# Turns that must go, then by initial: whole, and truncated.
SYMBOLS = "xsuaoSUAO"
_SPACE = " \t\n\x0b\f\r"
# States: nothing yet, after s, after u, after a.
_NONE, _S, _U, _A = range(4)
_STEP = {(_NONE, "s"): _S, (_NONE, "u"): _U, (_S, "u"): _U, (_U, "a"): _A, (_A, "u"): _U}


# ropes: a string, or a pair of ropes

def _leaves(rope) -> Iterator[str]:
    todo = [rope]
    while todo:
        r = todo.pop()
        if isinstance(r, str):
            if r:
                yield r
        else:
            todo += (r[1], r[0])


def text_of(rope) -> str:
    return "".join(_leaves(rope))


def _less(a, b) -> bool:
    """``a`` before ``b`` in ASCII order, read as far as they agree."""
    x, y, s, t = _leaves(a), _leaves(b), "", ""
    while True:
        s, t = s or next(x, ""), t or next(y, "")
        if not s or not t:
            return not s and bool(t)
        n = min(len(s), len(t))
        if s[:n] != t[:n]:
            return s[:n] < t[:n]
        s, t = s[n:], t[n:]


def _better(new, old) -> bool:
    if old is None or new[0] != old[0]:
        return old is None or new[0] < old[0]
    return _less(new[1], old[1])


def _join(a, b):
    return (a[0] + b[0], b[1] if a[1] == "" else a[1] if b[1] == "" else (a[1], b[1]))


def product(a: list, b: list) -> list:
    """Min-plus product of two 4 x 4 matrices of ``(cost, rope)`` or None."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        for r in range(4):
            if a[p][r] is None:
                continue
            for q in range(4):
                if b[r][q] is not None:
                    new = _join(a[p][r], b[r][q])
                    if _better(new, out[p][q]):
                        out[p][q] = new
    return out


def _inserts() -> list:
    """Any number of inserted turns."""
    out = [[None] * 4 for _ in range(4)]
    for p in range(4):
        q, n = p, 0
        while out[p][q] is None:
            out[p][q] = (n * INSERT, "I" * n)
            q, n = _STEP[q, "a" if q == _U else "u"], n + 1
    return out


def _turn(symbol: str) -> list:
    """The matrix of a turn: inserts, then keep, rerole or delete it."""
    out = [[None] * 4 for _ in range(4)]
    more = TRUNCATED if symbol.isupper() else 0
    for p in range(4):
        out[p][p] = (DELETE, "D")
        if symbol == "x":
            continue
        moves = [(REROLE, "R", r) for r in "ua"] + [(0, "K", symbol.lower())]
        for cost, letter, role in moves:
            q = _STEP.get((p, role))
            if q is not None and _better((cost + more, letter), out[p][q]):
                out[p][q] = (cost + more, letter)
    return product(_inserts(), out)


def end_vector() -> list:
    """Cheapest way from each state to an accepted end."""
    return [min(x for x in (row[_NONE], row[_A]) if x is not None) for row in _inserts()]


def before(matrix: list, rest: list) -> list:
    """The vector of what remains, with one more symbol in front."""
    out = []
    for row in matrix:
        best = None
        for step, tail in zip(row, rest, strict=True):
            if step is not None:
                new = _join(step, tail)
                if _better(new, best):
                    best = new
        out.append(best)
    return out


def matrices(rules: list[tuple[int, int]]) -> list[list]:
    """The matrix of every symbol, bottom-up."""
    out = [_turn(s) for s in SYMBOLS]
    for left, right in rules:
        out.append(product(out[left], out[right]))
    return out


# the grammar

def _flat(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy().astype(np.int64)
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), offsets - offsets[0]


def _pairs(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``left << 32 | right`` of every place, -1 at the end of a sequence."""
    key = np.full(len(codes), -1, np.int64)
    key[:-1] = codes[:-1] << 32 | codes[1:]
    last = offsets[1:][np.diff(offsets) > 0] - 1
    key[last] = -1
    return key


def _even_in_run(key: np.ndarray) -> np.ndarray:
    """Every other place of a run of equal keys, from its first one on."""
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    start = np.flatnonzero(new)
    return (np.arange(len(key)) - start[np.cumsum(new) - 1]) % 2 == 0


def count_pairs(codes: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs and how often each stands without overlapping itself."""
    key = _pairs(codes, offsets)
    return np.unique(key[(key >= 0) & _even_in_run(key)], return_counts=True)


def replace_pairs(codes: np.ndarray, offsets: np.ndarray, keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sequences with rules' pairs replaced where no neighbour's rule comes
    first; ``ids`` grow with falling priority, ``keys`` are sorted."""
    if not len(codes) or not len(keys):
        return codes, offsets
    key = _pairs(codes, offsets)
    slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    none = np.iinfo(np.int64).max
    rank = np.where(keys[slot] == key, ids[slot], none)
    prev, nxt = np.append(none, rank[:-1]), np.append(rank[1:], none)
    take = (rank < none) & _even_in_run(key) & (prev >= rank) & (nxt >= rank)
    new = np.where(take, rank, codes)
    keep = np.ones(len(codes), bool)
    keep[np.flatnonzero(take) + 1] = False
    kept = np.append(0, np.cumsum(keep))
    return new[keep], kept[offsets]


def _lists(codes: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(codes.astype(np.int32), pa.int32()))


def repair_grammar(sequences: DataFrame, rounds: int = ROUNDS, per_round: int = RULES) -> tuple[DataFrame, list[tuple[int, int]]]:
    """``(syms, codes)`` of each different ``syms`` and the rules, in rounds
    over all of them.  Only the most frequent pairs of a round come to the
    driver, and the rules go to the tasks: both at most ``per_round`` a round."""
    spark = sequences.sparkSession
    place = {s: k for k, s in enumerate(SYMBOLS)}

    def spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = [[place[s] for s in t] for t in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(codes, pa.list_(pa.int32()))], names=["syms", "codes"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, n = count_pairs(*_flat(batch.column(0)))
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n.astype(np.int64))], names=["pair", "n"])

    table = stored(sequences.select("syms").distinct().mapInArrow(spell, "syms string, codes array<int>"), "sequences")
    rules: list[tuple[int, int]] = []
    for _ in range(rounds):
        counts = table.select("codes").mapInArrow(count, "pair bigint, n bigint").groupBy("pair").agg(F.sum("n").alias("n"))
        top = counts.where("n > 1").orderBy(F.desc("n"), "pair").limit(per_round).collect()
        if not top:
            break
        pairs = np.array([r.pair for r in top], np.int64)
        order = np.argsort(pairs)
        keys, ids = pairs[order], order + len(SYMBOLS) + len(rules)
        rules += [(int(p >> 32), int(p & 0xFFFFFFFF)) for p in pairs]

        def rewrite(batches: Iterator[pa.RecordBatch], keys=keys, ids=ids) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                codes = _lists(*replace_pairs(*_flat(batch.column(1)), keys, ids))
                yield pa.RecordBatch.from_arrays([batch.column(0), codes], names=["syms", "codes"])

        table = stored(table.mapInArrow(rewrite, "syms string, codes array<int>"), "sequences")
    return table, rules


# turns and their faults

def _ready(turns: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    role_, text_ = (F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (role, text))
    return turns.select(
        F.col(conv).cast("string").alias("c"), F.col(turn).cast("bigint").alias("turn"), role_.alias("role"), text_.alias("text"),
        F.unhex(F.sha2(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_), 256)).alias("digest"),
    )


def _trimmed(text: Column) -> Column:
    return F.rtrim(text, F.lit(_SPACE))


def faults(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(c, turn, role, digest, rid, initial, fault)`` of every turn: its first
    fault, ``blank``, ``duplicate`` or ``truncated``, or null.

    A duplicate is found by its digest: the first turn of each repeated (role,
    text) comes from sums that combine on the map side."""
    rows = _ready(turns, conv, turn, role, text)
    last = F.substring(_trimmed(F.col("text")), -1, 1)
    slim = stored(
        rows.select(
            "c", "turn", "role", "digest", F.monotonically_increasing_id().alias("rid"), F.substring("role", 1, 1).alias("initial"),
            F.when(_trimmed(F.col("text")) == "", "blank").when(~last.isin(".", "!", "?"), "truncated").alias("own"),
        ),
        "turns",
    )
    first = slim.groupBy(F.col("c").alias("c2"), F.col("digest").alias("d2")).agg(
        F.min(F.struct("turn", "rid")).alias("first"), F.count(F.lit(1)).alias("n")
    ).where("n > 1")
    found = slim.join(first, slim["c"].eqNullSafe(first["c2"]) & (slim["digest"] == first["d2"]), "left")
    again = F.col("first.rid").isNotNull() & (F.col("first.rid") != F.col("rid"))
    fault = F.when(F.col("own") == "blank", "blank").when(again, "duplicate").otherwise(F.col("own"))
    return found.select("c", "turn", "role", "digest", "rid", "initial", fault.alias("fault"))


_SEGMENTS = "c string, part int, k int, syms string, first string, last string, blank bigint, duplicate bigint, truncated bigint, illegal bigint"
_LEGAL = {"su", "ua", "au"}


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted turns as segments of one conversation each."""
    part, k = TaskContext.get().partitionId(), 0
    out: list[tuple] = []
    now, syms, initials, n = None, [], [], {}

    def close() -> None:
        nonlocal k, syms, initials, n
        if syms:
            illegal = sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:]))
            out.append((now[0], part, k, "".join(syms), initials[0], initials[-1], n.get("blank", 0), n.get("duplicate", 0), n.get("truncated", 0), illegal))
            k += 1
        syms, initials, n = [], [], {}

    for batch in batches:
        for c, initial, fault in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
            if now != (c,) or len(syms) == SEGMENT:
                close()
                now = (c,)
            kind = initial if initial in ("s", "u", "a") else "o"
            syms.append("x" if fault in ("blank", "duplicate") else kind.upper() if fault else kind)
            initials.append(initial)
            if fault:
                n[fault] = n.get(fault, 0) + 1
        yield from _rows(out, _SEGMENTS)
        out = []
    close()
    yield from _rows(out, _SEGMENTS)


_TYPES = {"string": pa.string(), "int": pa.int32(), "bigint": pa.int64()}


def _rows(rows: list[tuple], schema: str) -> Iterator[pa.RecordBatch]:
    if rows:
        names, types = zip(*(x.split() for x in schema.split(", ")), strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(v, _TYPES[t]) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=list(names))


def _order() -> list:
    return [F.asc_nulls_first(x) for x in ("c", "turn", "role", "digest")]


_PLANS = "c string, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def repair_plans(found: DataFrame) -> DataFrame:
    """For each conversation of ``faults()``: how many of each fault, illegal
    neighbours, the least cost and the audit."""
    ordered = found.repartitionByRange(*_order(), "rid").sortWithinPartitions(*_order(), "rid")
    segments = stored(ordered.select("c", "initial", "fault").mapInArrow(_cut, _SEGMENTS), "segments")
    coded, rules = repair_grammar(segments)
    table = found.sparkSession.sparkContext.broadcast(matrices(rules))

    def solve(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Segments of a conversation, the last one first."""
        symbols, end = table.value, end_vector()
        now, rest, n, after = None, end, [0] * 4, None
        out: list[tuple] = []

        def close() -> None:
            if now is not None:
                cost, rope = rest[_NONE]
                out.append((now[0], *n, cost, text_of(rope)))

        for batch in batches:
            for row in batch.to_pylist():
                if now != (row["c"],):
                    close()
                    now, rest, n, after = (row["c"],), end, [0] * 4, None
                for code in reversed(row["codes"]):
                    rest = before(symbols[code], rest)
                n = [x + row[f] for x, f in zip(n, ("blank", "duplicate", "truncated", "illegal"), strict=True)]
                n[3] += after is not None and row["last"] + after not in _LEGAL
                after = row["first"]
            yield from _rows(out, _PLANS)
            out = []
        close()
        yield from _rows(out, _PLANS)

    chained = segments.join(coded, "syms").drop("syms")
    chained = chained.repartition("c").sortWithinPartitions("c", F.desc("part"), F.desc("k"))
    return chained.mapInArrow(solve, _PLANS)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """``(c, edit, turn, role, text)`` of the repaired turns in order; rows come
    sorted, each conversation's audit first.  ``edit`` None ends one."""
    now, audit, at, place = None, "", 0, 0

    def kept() -> str:
        # an odd number of turns begins with the system's
        j = place - odd
        return "user" if j % 2 == 0 else "assistant"

    odd = 0
    for batch in batches:
        for c, a, turn, role, text in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if a is not None:
                if now is not None:
                    while at < len(audit):
                        yield now[0], "I", None, kept(), ""
                        at, place = at + 1, place + 1
                    yield now[0], None, None, None, None
                now, audit, at, place = (c,), a, 0, 0
                odd = (len(a) - a.count("D")) % 2
                continue
            while audit[at] == "I":
                yield c, "I", None, kept(), ""
                at, place = at + 1, place + 1
            if audit[at] != "D":
                yield c, audit[at], turn, role if audit[at] == "K" else kept(), text
                place += 1
            at += 1
    if now is not None:
        while at < len(audit):
            yield now[0], "I", None, kept(), ""
            at, place = at + 1, place + 1
        yield now[0], None, None, None, None


def _with_texts(turns: DataFrame, plans: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    rows = _ready(turns, conv, turn, role, text).withColumn("audit", F.lit(None).cast("string"))
    heads = plans.select("c", F.lit(None).cast("bigint").alias("turn"), F.lit("").alias("role"), F.lit("").alias("text"), F.lit(None).cast("binary").alias("digest"), "audit")
    both = rows.unionByName(heads).repartition("c")
    return both.sortWithinPartitions(F.asc_nulls_first("c"), F.asc_nulls_last("audit"), *_order()[1:]).select("c", "audit", "turn", "role", "text")


def repaired_turns(turns: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations, ``(c, place, edit, turn, role, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema, out, size, place = "c string, place bigint, edit string, turn bigint, role string, text string", [], 0, 0
        for c, edit, t, r, x in _walk(batches):
            if edit is None:
                place = 0
                continue
            out.append((c, place, edit, t, r, x))
            place, size = place + 1, size + len(x)
            if size > 1 << 20 or len(out) == 1 << 12:
                yield from _rows(out, schema)
                out, size = [], 0
        yield from _rows(out, schema)

    return _with_texts(turns, plans, conv, turn, role, text).mapInArrow(run, "c string, place bigint, edit string, turn bigint, role string, text string")


def repaired_digests(turns: DataFrame, plans: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(c, sha256)`` over the repaired turns' ``role:text`` joined by line
    ends, read as a stream."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        h, start, out = hashlib.sha256(), True, []
        for c, edit, _, r, x in _walk(batches):
            if edit is None:
                out.append((c, h.hexdigest()))
                h, start = hashlib.sha256(), True
                if len(out) == 1 << 12:
                    yield from _rows(out, "c string, sha256 string")
                    out = []
            else:
                h.update(f"{'' if start else chr(10)}{r}:{x}".encode("utf-8", "surrogatepass"))
                start = False
        yield from _rows(out, "c string, sha256 string")

    return _with_texts(turns, plans, conv, turn, role, text).mapInArrow(run, "c string, sha256 string")


def repair(
    conversations: DataFrame, turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row for every conversation of ``conversations``, of which ``turns``
    are the rows to repair: gaps in its turn numbers, faults, illegal
    neighbours, cost, audit and the digest of the repaired conversation."""
    found = stored(faults(turns, conv, turn, role, text), "faults")
    plans = stored(repair_plans(found), "plans")
    missing = F.max("turn") - F.min("turn") + 1 - F.count_distinct("turn")
    gaps = found.groupBy(F.col("c").alias("c1")).agg(F.coalesce(missing, F.lit(0)).cast("bigint").alias("gaps"))
    digests = repaired_digests(turns, plans, conv, turn, role, text).withColumnRenamed("c", "c3")
    out = conversations.select(F.col(conv).alias("conv_id")).distinct()
    key = F.col("conv_id").cast("string")
    out = out.join(gaps, key.eqNullSafe(gaps["c1"]), "left").join(plans, key.eqNullSafe(plans["c"]), "left").join(digests, key.eqNullSafe(digests["c3"]), "left")
    number = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint").alias(c)
    return out.select(
        "conv_id", *[number(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.lit(hashlib.sha256().hexdigest())).alias("repaired_sha256"),
    )


def damaged(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``(conv_id, turn, role, text)`` with faults planted by a checksum of
    conversation and turn: of 20 rows one dropped, one emptied, one without
    sentence ends, one repeated and one given to the user."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(blank(conv), F.lit(":"), blank(turn)).cast("binary")) % 20
    out = rows.select(F.col(conv).alias("conv_id"), F.col(turn).alias("turn"), blank(role).alias("role"), blank(text).alias("text"), kind.alias("kind"))
    out = out.where("kind <> 0").withColumns({
        "text": F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
        "role": F.when(F.col("kind") == 4, "user").otherwise(F.col("role")),
        "copy": F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))),
    })
    return out.select("conv_id", "turn", "role", "text")
