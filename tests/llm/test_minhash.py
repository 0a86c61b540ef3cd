"""The LSH forest against the comparison of all pairs."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import minhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def set_of(text, n=5):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set()


def brute(rows, percent=85):
    sets = [set_of(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted(((i, len(sets[k]), low.get(find(k)) if sets[k] else i) for k, (i, _) in enumerate(rows)), key=str)


def got(df):
    return sorted((tuple(r) for r in minhash.near_duplicates(df).collect()), key=str)


def family(rnd, base, copies, edits):
    out = []
    for _ in range(copies):
        w = list(base)
        for _ in range(rnd.randint(0, edits)):
            w[rnd.randrange(len(w))] = f"n{rnd.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def made(seed, copies=40, edits=6):
    rnd = random.Random(seed)
    word = lambda: f"w{rnd.randrange(400)}"
    texts = [" ".join(word() for _ in range(rnd.randint(1, 80))) for _ in range(60)]
    for _ in range(4):
        texts += family(rnd, [word() for _ in range(120)], copies, edits)
    texts += [texts[3]] * 30 + [texts[70].upper()]
    rnd.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string")


@pytest.mark.parametrize("unit", [256, 6])
def test_like_all_pairs(spark, monkeypatch, unit):
    monkeypatch.setattr(minhash, "UNIT", unit)
    rows = made(4)
    want = brute(rows)
    assert len({c for _, _, c in want}) > 60
    assert got(frame(spark, rows).repartition(4)) == want


def test_a_dense_family_in_small_blocks(spark, monkeypatch):
    monkeypatch.setattr(minhash, "UNIT", 16)
    rnd = random.Random(9)
    rows = list(enumerate(family(rnd, [f"b{k}" for k in range(146)], 250, 8)))
    assert got(frame(spark, rows).repartition(4)) == brute(rows)


def test_odd_rows(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got(odd) == brute(rows)
    assert got(empty) == []
    short = [(1, "a b"), (2, "A  B"), (3, "a b c"), (None, "a b"), (5, "\x0b"), (None, "x y z q r s"), (7, "a b c d e"), (8, "A b c d E")]
    assert got(frame(spark, short)) == brute(short)


def test_limits_are_exact(spark):
    # 85 of 100 shingles shared, and one less
    base = [f"k{i}" for i in range(89 + 4)]
    rows = [(1, " ".join(base))]
    for k, cut in enumerate(range(60, 93)):
        rows.append((10 + k, " ".join(base[:cut])))
    assert got(frame(spark, rows)) == brute(rows)


def test_long_text_is_alone_in_its_block(spark, monkeypatch):
    monkeypatch.setattr(minhash, "UNIT_SHINGLES", 500)
    long = " ".join(f"w{k}" for k in range(5000))
    rows = [(1, long), (2, long + " end"), (3, "front " + long), (4, long[: len(long) // 2]), (5, "w1 w2 w3 w4 w5 w6")]
    assert got(frame(spark, rows)) == brute(rows)


def test_shared_counts():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 300, rng.integers(0, 200)).astype(np.uint64)) for _ in range(40)]
    want = [[len(np.intersect1d(a, b)) if i < j else 0 for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    assert minhash.shared_counts(sets).tolist() == want


def test_query(spark):
    from tagweave.llm.queries import op12_minhash_near_dedup

    sf = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()]
    found = op12_minhash_near_dedup(spark, sf)
    assert found.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(((i, n, c, i == c) for i, n, c in brute(rows)), key=str)
    assert found.where(F.col("kept")).count() == len({c for _, _, c in brute(rows)})
