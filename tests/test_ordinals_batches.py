"""Explode, ordinals (simple and chunked), batches and last-write-wins."""

import random

import pytest
from pyspark.sql import functions as F

from tagweave.operators import (
    assign_batches, batch_ranges, batch_report, explode_nested, global_ordinal, latest_by_key, run_ordinal,
    sequence_within, split_nested,
)


def test_explode_nested_coordinates(spark):
    df = spark.createDataFrame([(1, "a b. c\nd")], "id int, text string")
    n = df.select("id", split_nested("text", ["\n", r"\. ", " "]).alias("n"))
    rows = explode_nested(n, "n", keep=["id"]).collect()
    assert [(r.chapter, r.verse, r.word, r.ordinal, r.value) for r in rows] == [
        (1, 1, 1, 1, "a"), (1, 1, 2, 2, "b"), (1, 2, 1, 3, "c"), (2, 1, 1, 4, "d")]


def _runs_reference(values):
    out, prev, k = [], object(), 0
    for v in values:
        k = k + 1 if v == prev else 1
        prev = v
        out.append(k)
    return out


def test_run_ordinal_chunked_equals_simple(spark):
    rng = random.Random(3)
    rows = []
    for user in range(5):
        vals = []
        for t in range(400):
            # long runs that cross chunk boundaries, including whole chunks of one value
            if not vals or rng.random() < 0.08:
                vals.append(rng.choice("abc"))
            else:
                vals.append(vals[-1])
        rows += [(user, t, v) for t, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "u int, t int, v string")
    simple = {(r.u, r.t): r.ord for r in run_ordinal(df, ["u"], ["t"], "v", chunk=F.lit(0)).collect()}
    for width in (1, 7, 25, 1000):
        chunked = {(r.u, r.t): r.ord for r in run_ordinal(df, ["u"], ["t"], "v", chunk=F.floor(F.col("t") / width)).collect()}
        assert chunked == simple, width
    for user in range(5):
        vals = [v for (u, t, v) in rows if u == user]
        assert [simple[(user, t)] for t in range(400)] == _runs_reference(vals)


def test_run_ordinal_reappearing_value_restarts(spark):
    df = spark.createDataFrame([(0, "010101"), (1, "010101"), (2, "010102"), (3, "010101")], "t int, r string")
    got = [r.ord for r in run_ordinal(df.withColumn("f", F.lit(1)), ["f"], ["t"], "r", chunk=F.col("t") % 100).orderBy("t").collect()]
    assert got == [1, 2, 1, 1]


def test_sequence_and_global_ordinal_chunked(spark):
    rows = [(b, c, v, w) for b in (1, 2) for c in range(1, 4) for v in range(1, 4) for w in range(1, 5)]
    df = spark.createDataFrame(rows, "b int, c int, v int, w int")
    simple = {tuple(r[:4]): r.o for r in global_ordinal(df, ["b"], ["c", "v", "w"], out="o", chunk=F.lit(0)).collect()}
    chunked = {tuple(r[:4]): r.o for r in global_ordinal(df, ["b"], ["c", "v", "w"], out="o", chunk=F.col("c")).collect()}
    assert simple == chunked
    assert sorted(v for k, v in simple.items() if k[0] == 1) == list(range(1, 37))


def test_batches_and_report(spark):
    df = spark.createDataFrame([("a", i) for i in range(250)] + [("b", i) for i in range(200)], "g string, k int")
    b = assign_batches(df, ["g"], ["k"], 100, chunk=F.floor(F.col("k") / 64))
    rep = {(r.g, r.batch_no): (r.lo, r.hi, r.pct) for r in batch_report(b, ["g"], 100).collect()}
    assert rep == {("a", 0): (0, 100, 40.0), ("a", 1): (100, 200, 80.0), ("a", 2): (200, 250, 100.0),
                   ("b", 0): (0, 100, 50.0), ("b", 1): (100, 200, 100.0)}
    assert batch_ranges(250, 100) == [(0, 100), (100, 200), (200, 250)]
    assert batch_ranges(0, 100) == []
    with pytest.raises(ValueError):
        assign_batches(df, ["g"], ["k"], 0, chunk=F.col("k"))
    with pytest.raises(ValueError):
        batch_ranges(5, 0)


def test_latest_by_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, "c"), (1, 2, "b"), (2, 5, "z")], "k int, s int, v string")
    got = {r.k: (r.s, r.v) for r in latest_by_key(df, ["k"], ["s"]).collect()}
    assert got == {1: (3, "c"), 2: (5, "z")}


def test_latest_by_two_keys(spark):
    df = spark.createDataFrame([("p", "1", 1, "a"), ("p", "1", 2, "b"), ("q", "1", 1, "c")], "p string, r string, s int, v string")
    got = {(r.p, r.r): r.v for r in latest_by_key(df, ["p", "r"], ["s"]).collect()}
    assert got == {("p", "1"): "b", ("q", "1"): "c"}


def test_plans_have_no_bare_group_exchange_of_rows(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("g"), F.col("id").alias("k"))
    types = dict(assign_batches(df, ["g"], ["k"], 10, chunk=F.col("k") / 8).dtypes)
    assert types["seq"] == "bigint" and types["batch_no"] == "bigint"


def test_chunked_paths_keep_null_keys(spark):
    df = spark.createDataFrame([(None, 1, "a"), (None, 2, "a"), (1, 1, "b"), (1, None, "b")], "g int, t int, v string")
    seq = sequence_within(df, ["g"], ["t"], out="s", chunk=F.col("t"))
    assert seq.count() == 4
    runs = run_ordinal(df, ["g"], ["t"], "v", chunk=F.col("t"))
    assert runs.count() == 4
    assert sorted((r.g, r.t, r.ord) for r in runs.collect() if r.g is None) == [(None, 1, 1), (None, 2, 2)]


def test_batch_report_keeps_null_group(spark):
    df = spark.createDataFrame([(None, i) for i in range(150)] + [("a", 1)], "g string, k int")
    rep = {(r.g, r.batch_no): (r.lo, r.hi, r.pct) for r in batch_report(assign_batches(df, ["g"], ["k"], 100, chunk=F.floor(F.col("k") / 64)), ["g"], 100).collect()}
    assert rep == {(None, 0): (0, 100, 66.67), (None, 1): (100, 150, 100.0), ("a", 0): (0, 1, 100.0)}


def test_explode_text_equals_explode_nested(spark):
    from tagweave.operators import explode_text

    df = spark.createDataFrame([(1, "a b. c\nd\n\ne. f g. "), (2, ""), (3, None)], "id int, text string")
    seps = ["\n", r"\. ", " "]
    nested = explode_nested(df.select("id", split_nested("text", seps).alias("n")), "n", keep=["id"])
    direct = explode_text(df, "text", seps, keep=["id"])
    assert sorted(map(tuple, nested.collect())) == sorted(map(tuple, direct.collect()))
