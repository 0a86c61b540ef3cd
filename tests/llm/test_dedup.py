"""Substring dedup and SimHash against brute force."""

import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import tagweave.llm._repeats as repeats
from tagweave.llm import simhash, substring_dedup, suffix_dedup
from tagweave.llm.components import components

WORDS = re.compile(r"[^\x20\x09-\x0D]+")


def brute_words(rows, w=13):
    low, split = {}, [(-1 << 63 if i is None else i, i, WORDS.findall(t or "")) for i, t in rows]
    for k, _, x in split:
        for p in range(len(x) - w + 1):
            q = tuple(x[p:p + w])
            low[q] = min(low.get(q, k), k)
    out = []
    for k, i, x in split:
        keep = [True] * len(x)
        for p in range(len(x) - w + 1):
            if low[tuple(x[p:p + w])] < k:
                keep[p:p + w] = [False] * w
        out.append((i, len(x), len(x) - sum(keep), " ".join(a for a, b in zip(x, keep) if b)))
    return sorted(out, key=str)


def brute_bytes(rows, w=100):
    low, texts = {}, [(-1 << 63 if i is None else i, i, (t or "").encode()) for i, t in rows]
    for k, _, x in texts:
        for p in range(len(x) - w + 1):
            low[x[p:p + w]] = min(low.get(x[p:p + w], k), k)
    out = []
    for k, i, x in texts:
        gone, seen = bytearray(len(x)), set()
        for p in range(len(x) - w + 1):
            q = x[p:p + w]
            if low[q] < k or q in seen:
                gone[p:p + w] = b"\1" * w
            seen.add(q)
        kept = bytes(a for a, b in zip(x, gone) if not b)
        out.append((i, len(x), sum(gone), len(re.findall(b"\1+", bytes(gone))), kept))
    return sorted(out, key=str)


def got_words(df, **kw):
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept) for r in substring_dedup.remove_repeats(df, **kw).collect()), key=str)


def got_bytes(df):
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in suffix_dedup.remove_repeated_bytes(df).collect()), key=str)


def mutated(seed, alphabet, count=90):
    rnd = random.Random(seed)
    base = [" ".join(rnd.choice(alphabet) for _ in range(rnd.randint(5, 90))) for _ in range(15)]
    rows = []
    for k in range(count):
        t = rnd.choice(base)
        if rnd.random() < 0.6:
            x = t.split()
            x[rnd.randrange(len(x))] = "Ω"
            t = " ".join(x) + "\n" + rnd.choice(base)
        rows.append((rnd.choice([None, k // 2, k]), rnd.choice([t, t, t, None, "", "q " * rnd.randint(1, 90)])))
    return rows


def test_word_windows(spark):
    rows = mutated(3, ["a", "b"])
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got_words(df) == brute_words(rows)


def test_byte_windows(spark):
    rows = mutated(4, ["ab", "é", "cdcd"])
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got_bytes(df) == brute_bytes(rows)


def test_common_passage_passes_the_code_bound(spark, monkeypatch):
    """A key with more codes than a task holds goes window by window."""
    monkeypatch.setattr(repeats.repeat_spans, "__defaults__", (15,))
    rnd = random.Random(5)
    passage = [rnd.choice(["aa", "bb", "cc", "dd"]) for _ in range(40)]
    rows = []
    for k in range(120):
        side = [" ".join(rnd.choice("xyzw") for _ in range(rnd.randint(0, 20))) for _ in range(2)]
        rows.append((k, " ".join([side[0], *passage[: rnd.randint(8, 40)], side[1]])))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got_words(df) == brute_words(rows)
    rows = [(k, t * 3) for k, t in rows]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got_bytes(df) == brute_bytes(rows)


def test_long_text_in_segments():
    from tagweave.llm._text import blocks
    import pyarrow as pa

    rnd = random.Random(1)
    text = "".join(rnd.choice("abcdef ") for _ in range(9000))
    old = suffix_dedup.SEGMENT
    suffix_dedup.SEGMENT = 1000
    try:
        ((_, _, data, offsets),) = blocks(pa.array([text]))
        e = suffix_dedup.SuffixSort().cut(data, offsets)
    finally:
        suffix_dedup.SEGMENT = old
    covered = np.concatenate([np.arange(s, s + n) for s, n in zip(e.start, e.n)])
    assert (covered == np.arange(len(text) - 99)).all()


def test_suffix_mergesort_orders_like_bytes():
    from tagweave.llm._text import byte_table, prefix_hash

    rnd = random.Random(2)
    data = np.frombuffer("".join(rnd.choice("ab") for _ in range(400)).encode(), np.uint8)
    prefix, inv = prefix_hash(byte_table(1)[data])
    at = np.arange(380)
    size = np.minimum(60, len(data) - at)
    order = suffix_dedup.SuffixOrder(data, prefix, inv, at, size).sort(at.copy(), np.zeros(len(at), np.int64))
    raw = data.tobytes()
    assert [raw[i:i + size[i]] for i in order] == sorted(raw[i:i + size[i]] for i in at)


def test_collision_stops(monkeypatch):
    from tagweave.llm._text import blocks
    import pyarrow as pa

    monkeypatch.setattr(suffix_dedup, "byte_table", lambda seed: np.ones(256, np.uint64))  # every range of a length collides
    ((_, _, data, offsets),) = blocks(pa.array(["a" * 120 + "bcd", "x" * 123]))
    cutter = suffix_dedup.SuffixSort()
    with pytest.raises(RuntimeError, match="same hash"):
        cutter.classes(cutter.cut(data, offsets))


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got_words(odd) == brute_words(rows)
    assert got_bytes(odd) == brute_bytes(rows)
    assert got_words(empty) == [] and got_bytes(empty) == []
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).columns == empty.columns


def brute_simhash(rows, max_bits=3):
    fps = []
    for _, t in rows:
        w = WORDS.findall((t or "").translate({c: c + 32 for c in range(65, 91)}))
        sh = [" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = [xxhash.xxh64_intdigest(x.encode(), 42) for x in sh]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    label = closed(np.array(fps, np.uint64), max_bits)
    out = []
    for k, (i, _) in enumerate(rows):
        ids = [rows[j][0] for j in range(len(rows)) if label[j] == label[k] and rows[j][0] is not None]
        out.append((i, "%016x" % fps[k], min(ids) if ids else None))
    return sorted(out, key=str)


def closed(fp, max_bits):
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= max_bits
    label = np.arange(len(fp))
    while True:
        new = np.where(near, label[None, :], len(fp)).min(1)
        new = new[new]
        if (new == label).all():
            return label
        label = new


def got_simhash(df):
    found = simhash.near_duplicates(df)
    hexed = F.lpad(F.lower(F.hex("fp")), 16, "0")
    return sorted((tuple(r) for r in found.select("id", hexed, "component_id").collect()), key=str)


def test_simhash_rows(spark, odd):
    rows = mutated(9, ["red", "green", "blue", "grey"], 60)
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert got_simhash(df) == brute_simhash(rows)
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    assert got_simhash(odd) == brute_simhash(rows)


@pytest.mark.parametrize("limit", [8, 2048])
def test_simhash_dense_cluster(spark, limit):
    """Fingerprints a few bits apart: groups larger than the limit are cut again."""
    rnd = random.Random(1)
    base, fp = rnd.getrandbits(64), set()
    for _ in range(250):
        x = base
        for _ in range(rnd.randint(0, 9)):
            x ^= 1 << rnd.randrange(24)
        fp.add(x)
    fp = np.array(sorted(fp), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint").repartition(3)
    root = dict(tuple(r) for r in components(simhash.links(df, 3, max_group=limit)).collect())
    label, groups = closed(fp, 3), {}
    for k, x in enumerate(fp.view(np.int64).tolist()):
        groups.setdefault(label[k], set()).add(root.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_simhash_hot_family_is_cut(spark, monkeypatch):
    """Near copies that share a whole segment: cutting leaves groups within what
    the bits left bound, and the links stay whole."""
    rnd = random.Random(6)
    base = rnd.getrandbits(64)
    fp = {base ^ sum(1 << b for b in rnd.sample(range(32, 64), rnd.randint(0, 4))) for _ in range(1500)}
    fp = np.array(sorted(fp), np.uint64)
    df = spark.createDataFrame([(int(x),) for x in fp.view(np.int64)], "fp bigint").repartition(3)
    dealt, repartition = [], type(df).repartition

    def spy(self, *cols):
        if cols == ("key",):
            dealt.append(self)
        return repartition(self, *cols)

    monkeypatch.setattr(type(df), "repartition", spy)
    root = dict(tuple(r) for r in components(simhash.links(df, 3, max_group=64)).collect())
    label, groups = closed(fp, 3), {}
    for k, x in enumerate(fp.view(np.int64).tolist()):
        groups.setdefault(label[k], set()).add(root.get(x, x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    largest = [rows.groupBy("key").count().agg(F.max("count")).first()[0] for rows in dealt]
    assert largest[0] == len(fp) and largest[1] < len(fp) and largest[-1] <= 128, largest


def test_simhash_levels_bound_the_groups():
    levels = simhash._levels(simhash.MAX_BITS, simhash.MAX_GROUP)
    assert all(1 << len(left) + len(levels) <= simhash.MAX_GROUP for _, left in levels[-1])
    fp = np.random.default_rng(3).integers(0, 1 << 63, 50).astype(np.uint64)
    for bits in range(6):  # pairs up to `bits` apart meet at every level
        n = bits // 2 + 1
        for x in fp:
            y = x ^ np.uint64(sum(1 << b for b in random.Random(int(x)).sample(range(64), bits)))
            keys = [(None, p) for p in range(n)]
            for level in simhash._levels(bits, 64):
                met = []
                for parent, p in keys:
                    up = None if parent is None else np.array([parent], np.uint64)
                    u, v = (simhash._variants(np.array([z], np.uint64), [(p, level[p][0])], up)[0] for z in (x, y))
                    met += [(int(k), p) for k in np.intersect1d(u, v)[:1]]
                assert met, bits
                keys = [(k, p * n + j) for k, p in met for j in range(n)]


def test_keep_one_row_of_each_group(spark, odd):
    kept = simhash.keep_one(odd)
    groups = simhash.near_duplicates(odd).select("component").distinct().count()
    assert kept.count() == groups and kept.columns == odd.columns


def test_components_long_chain_and_star(spark):
    chain = [(i, i + 1) for i in range(300)]
    star = [(1000, x) for x in range(1001, 1200)]
    got = dict(tuple(r) for r in components(spark.createDataFrame(chain + star, "a bigint, b bigint")).collect())
    assert {got[i] for i in range(301)} == {0} and {got[i] for i in range(1000, 1200)} == {1000}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_hash_of_kept_text(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id bigint, text string")
    assert hashlib.sha256(b"a b").hexdigest() == substring_dedup.remove_repeats(df).select(F.sha2("kept", 256)).first()[0]
