"""Hard negatives against exact brute force."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tagweave.llm import hard_negatives
from tagweave.llm.hard_negatives import mine, scores


def brute(rows, positives=5, negatives=5, scale=256):
    use = []
    for i, vec, label in rows:
        if label is None or vec is None or any(x is None or not math.isfinite(x) for x in vec):
            continue
        use.append((i, [math.floor(scale * x) for x in vec], label))
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    by = lambda c: (-c[0], c[1] is None, c[1] or 0)
    out = []
    for k, (i, v, label) in enumerate(use):
        if i is None or i % 100:
            continue
        others = [(dot(v, w), j, m) for n, (j, w, m) in enumerate(use) if n != k]
        for ps, j, _ in sorted((c for c in others if c[2] == label), key=by)[:positives]:
            neg = sorted((c for c in others if c[2] != label and 80 * ps <= 100 * c[0] <= 100 * ps), key=by)[:negatives]
            out += [(i, j, r, c[1], ps, c[0]) for r, c in enumerate(neg, 1)]
    return sorted(out, key=str)


def got(df, **kw):
    cols = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted((tuple(r) for r in mine(df, anchors=F.col("vec_id") % 100 == 0, **kw).select(cols).collect()), key=str)


@pytest.mark.parametrize("width,top", [(1, 3), (64, 200), (300, 9), (700, 2e4), (5, 2e8), (64, 1e8)])
def test_scores_are_exact(width, top):
    rng = np.random.default_rng(width)
    a, b = (np.floor(rng.uniform(-top, top, (n, width))) for n in (7, 9))
    a[0], b[0] = top, top  # the largest score there can be
    a[1] = -top
    want = [[sum(int(x) * int(y) for x, y in zip(u, v)) for v in b] for u in a]
    assert scores(a, b).tolist() == want


def test_scores_of_unequal_widths_and_of_nothing():
    assert scores(np.array([[2.0, 3.0]]), np.array([[5.0]])).tolist() == [[10]]
    assert scores(np.zeros((0, 4)), np.ones((2, 4))).shape == (0, 2)
    assert scores(np.zeros((1, 0)), np.zeros((2, 0))).tolist() == [[0, 0]]
    with pytest.raises(ValueError, match="62 bits"):
        scores(np.full((1, 2), 1e12), np.full((1, 2), 1e12))


def make(seed, n, width=6, labels=4):
    rnd = random.Random(seed)
    near = [[rnd.uniform(-0.5, 0.5) for _ in range(width)] for _ in range(5)]
    rows = []
    for k in range(n):
        v = [x + rnd.choice([0, 0, 0.01, 0.1]) for x in rnd.choice(near)]
        rows.append((k * 20 if rnd.random() < 0.9 else rnd.choice([0, 100, 200]), v, rnd.randrange(labels)))
    return rows


@pytest.mark.parametrize("block", [(512, 1 << 14), (3, 7)])
def test_like_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(hard_negatives, "ANCHOR_ROWS", block[0])
    monkeypatch.setattr(hard_negatives, "BLOCK_ROWS", block[1])
    rows = make(3, 150)  # many ties, ids that repeat
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(4)
    as_float = [(i, [float(np.float32(x)) for x in v], m) for i, v, m in rows]
    want = brute(as_float)
    assert want and got(df) == want


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    v = [0.5, 0.25]
    rows = [
        (100, v, 1), (100, v, 1), (100, v, 2), (None, v, 1), (None, v, 2), (1, None, 1), (2, v, None), (3, [0.5, None], 1), (4, [nan, 0.5], 1),
        (5, [0.5, inf], 2), (6, [], 1), (7, [], 2), (8, [0.5], 2), (9, [0.5, 0.25, 0.75], 2), (200, [], 1), (300, [-0.5, -0.25], 3), (10, [0.5, 0.2], 2),
    ]
    schema = "vec_id bigint, embedding array<double>, label int"
    df = spark.createDataFrame(rows, schema)
    extra = df.select(F.lit(1).alias("id"), F.lit("x").alias("vec"), "*", F.lit(0).alias("a"), F.lit(0).alias("score"), F.lit(1).alias("is_anchor"))
    assert got(extra.repartition(3)) == brute(rows)
    assert got(df.where("1 = 0")) == []
    assert got(df.where("label = 3")) == []  # an anchor alone
    assert len(got(df, positives=1, negatives=1)) == len(brute(rows, 1, 1))


def test_one_block_group_of_equal_vectors(spark):
    rows = [(k, [0.5, 0.5], k % 3) for k in range(400)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int").repartition(5)
    assert got(df) == brute(rows)


def test_query(spark):
    from tagweave.llm.queries import op11_hard_negatives

    sf = "/root/testdata/sf0.001"
    rows = [
        (r.vec_id, list(r.embedding), (r.label + 1) % 10 if r.vec_id % 7 == 0 else r.label)
        for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()
    ]
    assert sorted((tuple(r) for r in op11_hard_negatives(spark, sf).collect()), key=str) == brute(rows)
