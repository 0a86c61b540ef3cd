"""Conversation repair against all edit scripts of short conversations and a
plain dynamic program over long ones."""

import hashlib
import itertools
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave.llm import conversations as C

GOOD = re.compile(r"(s?(ua)+)?")
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def faults_of(rows):
    seen, out = set(), []
    for role, text in rows:
        body = text.rstrip(" \t\n\x0b\f\r")
        out.append("blank" if not body else "duplicate" if (role, text) in seen else "" if body[-1] in ".!?" else "truncated")
        seen.add((role, text))
    return out


def apply(rows, audit):
    """Repaired rows, or None if the audit leads nowhere."""
    n, out, at = len(audit) - audit.count("D"), [], 0
    for letter in audit:
        role = ("user", "assistant")[(len(out) - n % 2) % 2]
        if letter == "I":
            out.append((role, ""))
            continue
        if letter != "D":
            out.append((rows[at][0] if letter == "K" else role, rows[at][1]))
            if letter == "R" and n % 2 and len(out) == 1:
                return None  # nothing is made a system turn
        at += 1
    if n % 2 and audit.lstrip("D")[:1] == "I":
        return None
    return out if GOOD.fullmatch("".join(r[:1] or "-" for r, _ in out)) else None


def brute(rows):
    fault, best = faults_of(rows), None
    letters = ["D" if f in ("blank", "duplicate") else "KRD" for f in fault]
    for ops in itertools.product(*letters):
        for gaps in itertools.product(range(3), repeat=len(rows) + 1):
            audit = "I" * gaps[0] + "".join(o + "I" * g for o, g in zip(ops, gaps[1:]))
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[x] for x in audit) + sum(3 for o, f in zip(ops, fault) if o != "D" and f == "truncated")
            if (best is None or (cost, audit) < best[:2]) and apply(rows, audit) is not None:
                best = cost, audit, apply(rows, audit)
    return best


def plain(rows):
    """Front to back, with whole strings."""
    live = {"": (0, "")}
    for (role, _), f in zip([*rows, ("", "")], [*faults_of(rows), None]):
        for _ in range(3):  # inserts
            for (p, x), q in NEXT.items():
                if x != "s" and p in live:
                    new = live[p][0] + 3, live[p][1] + "I"
                    live[q] = min(live.get(q, new), new)
        if f is None:
            break
        after = {}
        for p, (cost, audit) in live.items():
            moves = [(4, "D", p)]
            if f in ("", "truncated"):
                more = 3 if f else 0
                moves += [(3 + more, "R", NEXT.get((p, x))) for x in "ua"] + [(more, "K", NEXT.get((p, role[:1])))]
            for c, letter, q in moves:
                if q is not None:
                    new = cost + c, audit + letter
                    after[q] = min(after.get(q, new), new)
        live = after
    cost, audit = min(x for x in (live.get(""), live.get("a")) if x)
    return cost, audit, apply(rows, audit)


def expected(rows, solve):
    """``rows`` of one conversation: (turn, role, text), in order."""
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [(r, x) for _, r, x in rows]
    cost, audit, out = solve(pairs) if rows else (0, "", [])
    fault = faults_of(pairs)
    initials = [r[:1] for r, _ in pairs]
    return (
        max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(fault.count(f) for f in ("blank", "duplicate", "truncated")),
        sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
        hashlib.sha256("\n".join(f"{r}:{x}" for r, x in out).encode()).hexdigest(),
    )


def by_digest(row):
    _, role, text = row
    return row[0] is not None, row[0] or 0, role.encode(), hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()


def conversations(rows):
    """conv -> rows in the operator's order, nulls as one space."""
    out = {}
    for c, t, r, x in rows:
        out.setdefault(c, []).append((t, " " if r is None else r, " " if x is None else x))
    return {c: sorted(v, key=by_digest) for c, v in out.items()}


def got(df, turns=None):
    return {r.conv_id: tuple(r)[1:] for r in C.repair(df, df if turns is None else turns).collect()}


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")


def made(seed, n_convs, longest):
    rnd = random.Random(seed)
    texts = ["Yes.", "No!", "why", " ", "", "So? \n", "ok"]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", None]
    rows = []
    for c in range(n_convs):
        for t in range(rnd.randint(1, longest)):
            text = rnd.choice(texts) if rnd.random() < 0.6 else f"{t} is new."
            rows.append((c, rnd.choice([t, t + 1, t * 2]) if rnd.random() < 0.9 else None, rnd.choice(roles), text))
    return rows


def test_the_plain_program_is_right():
    rnd = random.Random(5)
    for _ in range(60):
        rows = [(rnd.choice(["user", "assistant", "system", "tool"]), rnd.choice(["a.", "b!", "c", "", "d."])) for _ in range(rnd.randint(0, 4))]
        assert plain(rows) == brute(rows), rows


def test_short_conversations(spark):
    rows = made(1, 60, 4)
    want = {c: expected(v, brute) for c, v in conversations(rows).items()}
    assert got(frame(spark, rows).repartition(3)) == want


@pytest.mark.parametrize("segment,rules", [(4096, 512), (5, 2)])
def test_long_conversations(spark, monkeypatch, segment, rules):
    monkeypatch.setattr(C, "SEGMENT", segment)
    monkeypatch.setattr(C, "RULES", rules)
    rows = made(2, 40, 60) + [(99, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(3000)] + [(98, t, "user", f"{t}.") for t in range(700)]
    want = {c: expected(v, plain) for c, v in conversations(rows).items()}
    assert got(frame(spark, rows).repartition(4)) == want


def test_grammar_gives_the_sequences_back(spark):
    rnd = random.Random(3)
    seqs = ["".join(rnd.choice("suaUx") for _ in range(rnd.randint(1, 50))) for _ in range(40)] + ["u" * k for k in range(1, 40)] + ["ua" * 100]
    table, rules = C.repair_grammar(spark.createDataFrame([(s,) for s in seqs * 2], "syms string"), per_round=6)

    def spell(code):
        return C.SYMBOLS[code] if code < len(C.SYMBOLS) else "".join(map(spell, rules[code - len(C.SYMBOLS)]))

    rows = table.collect()
    assert sorted(r.syms for r in rows) == sorted(set(seqs)) and all("".join(map(spell, r.codes)) == r.syms for r in rows)
    assert sum(len(r.codes) for r in rows) * 2 < sum(len(r.syms) for r in rows)


def test_pairs_in_runs():
    codes, offsets = np.array([1, 1, 1, 1, 1, 2, 1, 1]), np.array([0, 5, 5, 8])
    keys, n = C.count_pairs(codes, offsets)
    assert dict(zip(keys.tolist(), n.tolist())) == {1 << 32 | 1: 3, 2 << 32 | 1: 1}
    new, at = C.replace_pairs(codes, offsets, np.array([1 << 32 | 1]), np.array([9]))
    assert new.tolist() == [9, 9, 1, 2, 9] and at.tolist() == [0, 3, 3, 5]


def test_ropes():
    a, b = (("ab", ""), ("c", ("d", "e"))), ("a", "bcdf")
    assert C.text_of(a) == "abcde" and C._less(a, b) and not C._less(b, a) and not C._less(a, a)
    assert C._less("ab", a) and not C._less(a, "ab")


def test_odd_rows(spark):
    rows = [
        (1, 0, "user", "Hi."), (1, 0, "user", "Hi."), (1, None, None, None), (None, 3, "assistant", "x"), (None, None, "user", "y."),
        (2, None, None, None), (3, 1, "", "."), (4, 1, "system", "S."), (5, 10**12, "user", "a."), (5, -5, "User", "b."),
        (6, 1, "user", "word " * 200_000 + "end."), (6, 2, "assistant", " . \x0b"), (7, 1, "ünser", "é "),
    ]
    df = frame(spark, rows)
    extra = df.select(F.lit(1).alias("c"), F.lit("z").alias("audit"), "*", F.lit(2).alias("rid"), F.lit("q").alias("digest"), F.lit(0).alias("kind"))
    want = {c: expected(v, brute) for c, v in conversations(rows).items()}
    assert got(extra.repartition(3)) == want
    assert got(df.where("1 = 0")) == {}
    none = got(df, df.where("conv_id = 4"))
    empty = hashlib.sha256().hexdigest()
    assert none[5] == (0, 0, 0, 0, 0, 0, "", empty) and none[4] == want[4] and None in none


def test_repaired_turns(spark):
    rows = [(1, 0, "system", "S."), (1, 1, "user", "q?"), (1, 2, "user", "more"), (1, 3, "assistant", ""), (2, 0, "assistant", "a.")]
    df = frame(spark, rows)
    plans = C.repair_plans(C.faults(df))
    out = C.repaired_turns(df, plans).orderBy("c", "place").collect()
    for c, v in conversations(rows).items():
        pairs = [(r, x) for _, r, x in v]
        assert [(r.role, r.text) for r in out if r.c == str(c)] == brute(pairs)[2]


def test_query(spark):
    from tagweave.llm.queries import op13_conversation_repair

    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    left = []
    for c, t, r, x in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        r, x = " " if r is None else r, " " if x is None else x
        if k:
            x = "" if k == 1 else re.sub("[.!?]", "", x) if k == 2 else x
            left += [(c, t, "user" if k == 4 else r, x)] * (2 if k == 3 else 1)
    kept = conversations(left)
    want = {c: expected(kept.get(c, []), plain) for c in {r[0] for r in rows}}
    found = op13_conversation_repair(spark, sf)
    assert found.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    assert {r.conv_id: tuple(r)[1:] for r in found.collect()} == want
