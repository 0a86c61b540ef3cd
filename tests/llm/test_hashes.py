"""Hashes of words and byte ranges, on words made to collide modulo 2^64."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tagweave.llm import _text as T
from tagweave.llm import decontam, lm, rules
from tagweave.llm._encode import WordEncoder
from tagweave.llm.substring_dedup import remove_repeats


def doubled(n):
    """The Thue-Morse word of ``n`` letters and its swap."""
    x = "a"
    while len(x) < n:
        x += x.translate({97: "b", 98: "a"})
    return x, x.translate({97: "b", 98: "a"})


def test_arithmetic_of_the_prime():
    rnd = random.Random(1)
    a = [rnd.randrange(T._PRIME) for _ in range(500)] + [T._PRIME - 1, 0, 1]
    b = [rnd.randrange(T._PRIME) for _ in range(500)] + [T._PRIME - 1, 5, T._PRIME - 1]
    x, y = np.array(a, np.uint64), np.array(b, np.uint64)
    assert T.mul_mod(x, y).tolist() == [i * j % T._PRIME for i, j in zip(a, b)]
    assert T.sub_mod(x, y).tolist() == [(i - j) % T._PRIME for i, j in zip(a, b)]


def test_prefix_hash_over_several_chunks(monkeypatch):
    monkeypatch.setattr(T, "_CHUNK", 64)
    rnd = random.Random(2)
    v = [rnd.randrange(1 << 64) for _ in range(500)]
    prefix, inv = T.prefix_hash(np.array(v, np.uint64), 3)
    base, p = T._base(3), T._PRIME
    for s, e in [(0, 500), (63, 65), (10, 10), (200, 450)]:
        want = sum(x * pow(base, i, p) for i, x in enumerate(v[s:e])) % p
        assert T.range_raw(prefix, inv, np.array([s]), np.array([e])).tolist() == [want]


@pytest.mark.parametrize("n", [64, 1024, 2048, 4096])
def test_doubled_words_differ(n):
    x, y = doubled(n)
    data = np.frombuffer(f"{x} {y} {x}".encode(), np.uint8)
    start, end, _ = T.find_words(data, np.array([0, len(data)]))
    h = T.word_hashes(data, start, end)
    assert h[0] == h[2] != h[1]
    prefix, inv = T.prefix_hash(T.byte_table(1)[data])
    h = T.range_hash(prefix, inv, start, end)
    assert h[0] == h[2] != h[1]


def test_word_hash_is_of_the_word_alone():
    words = ["a" * k + "é" for k in range(1, 90)] + ["a", "a\0", "a\0\0", "ab"]
    data = np.frombuffer(" ".join(words * 2).encode(), np.uint8)
    start, end, _ = T.find_words(data, np.array([0, len(data)]))
    h = T.word_hashes(data, start, end)
    assert (h[: len(words)] == h[len(words):]).all() and len(set(h.tolist())) == len(words)
    upper = np.frombuffer(" ".join(words).upper().replace("É", "é").encode(), np.uint8)
    start, end, _ = T.find_words(upper, np.array([0, len(upper)]))
    assert T.word_hashes(upper, start, end, lower=True).tolist() == h[: len(words)].tolist()


def test_operators_tell_doubled_words_apart(spark, vocab):
    x, y = doubled(1024)
    head = "one two three four five six seven eight nine ten eleven twelve"
    docs = spark.createDataFrame([(1, f"{head} {x}"), (2, f"{head} {y}"), (3, f"{head} {x}")], "doc_id bigint, text string")
    removed = {r.doc_id: r.n_removed for r in remove_repeats(docs).collect()}
    assert removed == {1: 0, 2: 0, 3: 13}

    items = spark.createDataFrame([("i", x)], "item_id string, text string")
    hits = {r.doc_id: r["__n_hit"] for r in decontam.scan(docs, items).collect()}
    assert hits == {1: 1, 2: 0, 3: 1}

    twice = spark.createDataFrame([(1, f"{x} u v {y} u v"), (2, f"{x} u v {x} u v")], "doc_id bigint, text string")
    repeats = {r.doc_id: r.n_repeat_words for r in rules.ledger(twice).collect()}
    assert repeats[1] == 0 and repeats[2] == 6

    enc = WordEncoder(vocab("word_bpe_49k.json"))
    ((_, _, data, offsets),) = T.blocks(pa.array([x, y]))
    ids, at = enc.block(data, offsets)
    assert ids[at[0]:at[1]].tolist() == enc.full.encode(x, add_special_tokens=False).ids
    assert ids[at[1]:at[2]].tolist() == enc.full.encode(y, add_special_tokens=False).ids


def test_model_counts_doubled_words_apart(spark, vocab):
    x, y = doubled(1024)
    train = [(i, x) for i in range(40)]
    docs = spark.createDataFrame([*train, (100, x), (101, y)], "doc_id bigint, text string")
    found = {r.doc_id: r for r in lm.score(docs, vocab("piece_bpe_32k.model")).collect()}
    import zlib

    learned = {w for i, w in [*train, (100, x), (101, y)] if zlib.crc32(str(i).encode()) % 10}
    assert found[101].n_known == 1 + (y in learned)
