"""Kernels of the pipeline's stages: hashes of many ranges, cached words, texts
that go to Python once."""

import numpy as np
import xxhash
from pyspark.sql import functions as F

from tagweave.llm import _encode, decontam, rules, simhash
from tagweave.llm._text import WORD_BYTES, find_words, mapped


def test_xxh64_of_many_ranges_equals_the_library():
    rnd = np.random.default_rng(4)
    data = rnd.integers(0, 256, 9000).astype(np.uint8)
    size = np.concatenate([np.arange(300), [511, 512, 513, 700, 0], rnd.integers(0, 70, 3000)])
    start = rnd.integers(0, len(data) - 700, len(size))
    start[-1], size[-1] = len(data) - 3, 3  # ends with the data
    for seed in (0, 42, (1 << 64) - 5):
        want = [xxhash.xxh64_intdigest(data[a : a + n], seed) for a, n in zip(start.tolist(), size.tolist(), strict=True)]
        assert simhash.xxh64(data, start, start + size, seed).tolist() == want
    assert len(simhash.xxh64(data, start[:0], start[:0])) == 0


def test_bits_are_summed_over_long_runs():
    h = np.random.default_rng(1).integers(0, 1 << 63, 3000).astype(np.uint64) | np.uint64(1)
    first = np.array([0, 0, 1, 255, 511, 511, 2900, 3000])
    bits = (h[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    want = [bits[a:b].sum(axis=0).tolist() for a, b in zip(first[:-1], first[1:], strict=True)]
    assert simhash._sum_bits(h, first).tolist() == want


def test_slots_keep_every_key():
    rnd = np.random.default_rng(2)
    keys = np.unique(rnd.integers(0, 1 << 63, 700).astype(np.uint64))
    keys[0] = 0  # a key like any other
    slots = _encode._Slots(10)
    assert (slots.find(keys) == -1).all()
    a, b = slots.add(keys[:300]), slots.add(keys[300:])
    assert len(set(a) | set(b)) == len(keys) == slots.n
    assert (slots.find(keys) == np.concatenate([a, b])).all()
    assert (slots.find(keys[1:] ^ np.uint64(1 << 40)) == -1).sum() >= len(keys) - 2


def test_mapped_is_the_table_of_each_byte():
    data = np.arange(256, dtype=np.uint8).repeat(3)[5:]
    assert (mapped(data, WORD_BYTES) == WORD_BYTES[data]).all()
    assert find_words(np.frombuffer(b"ab c", np.uint8), np.array([0, 1, 4]))[0].tolist() == [0, 1, 3]


def test_texts_go_to_python_once(spark):
    docs = spark.createDataFrame([(1, "w " * 60 + "x")], "doc_id bigint, text string")
    items = spark.createDataFrame([("i", "no such words")], "item_id string, text string")
    for out in (rules.apply_policy(docs), decontam.decontaminate(docs, items)):
        plan = out._jdf.queryExecution().executedPlan().toString()
        (line,) = [x for x in plan.split("\n") if "MapInArrow" in x]
        assert line.split("(", 1)[1].split(")")[0].count("#") == 2, line
    # a text of another type is cast, and comes back as it was
    raw = docs.withColumn("text", F.col("text").cast("binary"))
    assert rules.apply_policy(raw).schema == raw.schema and decontam.scan(raw, items).first()["__n_words"] == 61
