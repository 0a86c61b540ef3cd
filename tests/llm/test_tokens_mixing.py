"""Token shards and mixing: exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tagweave.llm import mixing, tokens
from tagweave.llm._encode import WordEncoder
from tagweave.llm._text import blocks
from tagweave.session import scratch_path

HARD = ["", None, "a\x01b \x01", "<|endoftext|> x<|startoftext|>y", "Don't we'LL 'S 12 3½ ² ª", "été é x İI Σας ὈΔΥΣΣΕΎΣ",
        "日本語 テスト　x y\u0085z", "a" * 300, " x​y", "THE.,!! \tfoo\nbar\x0bq\x0cr\x1cs\x1ft", "ﬁ ſt ǅ", "#*$%&|<>@@ <|x|>"]


def reference(path, texts):
    tk = Tokenizer.from_file(path)
    return [tk.encode(t or "", add_special_tokens=False).ids + [1] for t in texts]


def test_block_encoder_equals_the_library(vocab):
    path = vocab("word_bpe_49k.json")
    rnd = random.Random(0)
    texts = HARD + ["".join(rnd.choice("abcXYZ'!.19 é\n") for _ in range(rnd.randint(0, 200))) for _ in range(200)]
    enc, want = WordEncoder(path), reference(path, texts)
    for i, j, data, offsets in blocks(pa.array(texts, pa.string()), 2000):
        ids, at = enc.block(data, offsets, 1)
        for k in range(i, j):
            assert ids[at[k - i]:at[k - i + 1]].tolist() == want[k], texts[k]


def test_encoder_without_the_quick_way(vocab):
    path = vocab("word_bpe_49k.json")
    enc = WordEncoder(path)
    enc.quick = False
    for i, j, data, offsets in blocks(pa.array(HARD, pa.string())):
        ids, at = enc.block(data, offsets, 1)
        assert [ids[at[k]:at[k + 1]].tolist() for k in range(j - i)] == reference(path, HARD)


def test_cache_forgets(vocab, monkeypatch):
    import tagweave.llm._encode as e

    monkeypatch.setattr(e, "WORD_CACHE", 10)
    monkeypatch.setattr(e, "PIECE_CACHE", 10)
    path = vocab("word_bpe_49k.json")
    enc = WordEncoder(path)
    texts = [" ".join(f"w{i % 7} u{i}" for i in range(k, k + 30)) for k in range(0, 300, 30)]
    for _ in range(2):
        for t, want in zip(texts, reference(path, texts), strict=True):
            ((_, _, data, offsets),) = blocks(pa.array([t]))
            assert enc.block(data, offsets, 1)[0].tolist() == want


def test_perfect_hash():
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.random.default_rng(n).permutation((np.arange(n) - n // 2) * 7919)
        null = np.zeros(n, bool)
        h = tokens._hash(keys, null)
        mph = tokens.PerfectHash.build(h)
        assert sorted(mph.slots(h).tolist()) == list(range(n))
        index = tokens.ShardIndex(tokens.build_index(np.sort(keys), null, np.ones(n, np.int64)))
        row, count = index.find(np.sort(keys), null)
        assert row.tolist() == list(range(n)) and (count == 1).all()
        strange = np.arange(1000) * 7919 + 1
        assert (index.find(strange, np.zeros(1000, bool))[1] == 0).all()


def round_trip(spark, df, vocab, monkeypatch=None):
    path = vocab("word_bpe_49k.json")
    root = scratch_path(spark, "test-shards")
    manifest = tokens.write_shards(df, root, path, end_id=1)
    found = tokens.lookup(df, root)
    got = sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in tokens.with_crc32(found, tokens.read_manifest(root)["width"]).collect()), key=lambda x: x[1])
    rows = [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]
    ids = reference(path, [t for _, t in rows])
    packed = sorted(((i is not None, i or 0, np.array(x, "<u2").tobytes()) for (i, _), x in zip(rows, ids, strict=True)))
    want, start = [], 0
    for known, i, raw in packed:
        x = np.frombuffer(raw, "<u2").astype("<u4")
        want.append((i if known else None, start, len(x), zlib.crc32(x.tobytes())))
        start += len(x)
    assert got == want
    return manifest


def test_shards_round_trip(spark, odd, empty, vocab):
    assert len(round_trip(spark, odd, vocab)) == 1
    assert round_trip(spark, empty, vocab) == []


def test_many_shards_in_ascending_order(spark, vocab, monkeypatch):
    monkeypatch.setattr(tokens, "SHARD_BYTES", 2000)
    rnd = random.Random(4)
    rows = [(rnd.randrange(-500, 500), " ".join(rnd.choice(["alpha", "beta", "gamma"]) for _ in range(rnd.randint(0, 20)))) for _ in range(400)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert len(round_trip(spark, df, vocab)) > 5


def test_unknown_keys_give_no_row(spark, vocab):
    df = spark.createDataFrame([(1, "a"), (5, "b")], "doc_id bigint, text string")
    root = scratch_path(spark, "test-shards")
    tokens.write_shards(df, root, vocab("word_bpe_49k.json"))
    keys = spark.createDataFrame([(1,), (2,), (None,), (99,)], "doc_id bigint")
    assert [r.doc_id for r in tokens.lookup(keys, root).collect()] == [1]


def test_targets():
    assert mixing.targets([10, 10, 10], (1.0,), 3) == [10.0, 10.0, 10.0]
    t = mixing.targets([1, 100, 100], (5.0, 2.0, 1.0), 3)
    assert t[0] == 3.0 and abs(sum(t) - 201) < 1e-9 and abs(t[1] / t[2] - 2) < 1e-9
    assert mixing.targets([0, 0]) == [0.0, 0.0] and mixing.targets([]) == []
    assert mixing.targets([0, 10]) == [0.0, 10.0]


def test_feistel_is_a_permutation():
    for n in (1, 2, 3, 7, 64, 1000):
        assert sorted(mixing._feistel(np.arange(n), n, 12345).tolist()) == list(range(n))


def mixed(df, **kw):
    mix = mixing.plan_mix(df, **kw)
    return mix, mixing.with_sources(mixing.taken(mix), mix).select("id", "source", "size", "source_size", "target", "taken").collect()


def test_mix_meets_targets_and_reruns_agree(spark):
    rnd = random.Random(2)
    rows = [(k, " ".join(["w"] * rnd.randint(0, 80)), rnd.choice(["a", "a", "a", "b", "c", None])) for k in range(600)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(3)
    mix, out = mixed(df, block_words=16)
    assert len(out) == len(rows) and all(0 <= r.taken <= 3 * r.size for r in out)
    took, goal = defaultdict(int), {}
    for r in out:
        took[r.source] += r.taken
        goal[r.source] = r.target
    assert all(abs(took[s] - goal[s]) <= 16 for s in goal)
    assert sorted(map(str, out)) == sorted(map(str, mixed(df.repartition(5), block_words=16)[1]))
    # slots and blocks: every slot once, no block more often than the passes
    slots = mix.slots.collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots)
    assert mix.counts.agg(F.max("taken")).first()[0] <= 3
    texts = mixing.mix_documents(df, mix)
    taken = {r.id: r.taken for r in out}
    assert {r.doc_id: len(r.text.split()) for r in texts.collect()} == {k: v for k, v in taken.items() if v}
    assert texts.columns == df.columns


def test_mix_of_odd_rows(odd, empty):
    mix, out = mixed(odd, block_words=8)
    assert len(out) == odd.count() and all(r.taken <= 3 * r.size for r in out)
    texts = mixing.mix_documents(odd, mix)
    assert texts.columns == odd.columns
    assert sum(len((r.text or "").split()) for r in texts.collect()) >= 0.9 * sum(r.taken for r in out)
    mix, out = mixed(empty)
    assert out == [] and mixing.mix_documents(empty, mix).count() == 0


def test_shards_of_a_trillion_words(spark):
    n_slots = [9_000_000_011, 6_500_000_000, 0, 124_999_989, 1]  # 64 words each
    plan, n_shards = mixing.deal_shards(spark, n_slots, shard_slots=1 << 22)
    assert n_shards * (1 << 22) >= sum(n_slots)
    rows = plan.groupBy("no").agg(F.sum("n").alias("n"), F.count_distinct("first").alias("k"), F.count(F.lit(1)).alias("c")).collect()
    assert {r.no: r.n for r in rows} == {i: n for i, n in enumerate(n_slots) if n} and all(r.k == r.c for r in rows)
    sizes = plan.groupBy("shard").agg(F.sum("n").alias("n"))
    assert sizes.where(f"n > {1 << 22} OR shard >= {n_shards}").count() == 0
    # the ranges of a source follow each other without a gap
    for r in plan.where("no = 0").selectExpr("first", "first + n AS next").groupBy().agg(F.min("first"), F.max("next"), F.sum(F.expr("next - first"))).collect():
        assert tuple(r) == (0, n_slots[0], n_slots[0])


def test_taken_is_what_the_slots_take(spark, odd):
    rnd = random.Random(4)
    rows = [(k if rnd.random() < 0.9 else None, rnd.choice("abc") if rnd.random() < 0.9 else None, "w " * rnd.randint(0, 300)) for k in range(150)]
    docs = spark.createDataFrame(rows, "doc_id bigint, source string, text string")
    for df in (docs, odd):
        mix = mixing.plan_mix(df, block_words=16, shard_slots=64)
        block = defaultdict(int)
        for r in mix.slots.collect():
            block[r.no, r.block] += 1
        want = defaultdict(int)
        for d in mix.docs.collect():
            for w in range(d["size"]):
                want[d.no, d["at"], d["size"]] += block[d.no, (d["at"] + w) // 16]
        got = {(r.no, r["at"], r["size"]): r.taken for r in mixing.taken(mix).collect()}
        assert got == {k: want[k] for k in got} and sum(want.values()) == sum(v for v in got.values())
        # places follow each other by id in each source
        for no in {d.no for d in mix.docs.collect()}:
            mine = sorted((d["at"], d["size"]) for d in mix.docs.collect() if d.no == no)
            assert [a for a, _ in mine] == [sum(s for _, s in mine[:k]) for k in range(len(mine))]


def test_one_key_of_many_is_a_few_reads():
    import time

    keys = np.arange(0, 2_000_000, 2)
    index = tokens.ShardIndex(tokens.build_index(keys, np.zeros(len(keys), bool), np.full(len(keys), 3)))
    one, no = np.array([777_776]), np.array([False])
    index.find(one, no)
    began = time.perf_counter()
    for _ in range(100):
        row, n = index.find(one, no)
    assert (row[0], n[0]) == (388_888, 1) and (time.perf_counter() - began) / 100 < 2e-3


def test_neighbours_are_read_together():
    class Payload:
        def __init__(self, raw):
            self.raw, self.reads = raw, 0

        def read_at(self, n, at):
            self.reads += 1
            return self.raw[at:at + n]

    at = np.array([0, 2, 2, 5, 9, 10])
    payload = Payload(bytes(range(20)))
    rows = np.array([0, 1, 2, 4, 4, 3])
    got = list(tokens.read_rows(payload, at, rows, 2))
    assert got == [bytes(range(at[r] * 2, at[r + 1] * 2)) for r in rows] and payload.reads == 4
