"""Nested books cut at chapter ends, and the two-level explode."""

import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave.operators import explode_chapters, explode_levels, explode_nested
from tagweave.sources import chapters as C
from tagweave.sources import read_nested_books, read_nested_chapters


def book(seed, chapters=30):
    rnd = random.Random(seed)
    hard = ["a", "[", "]", '"', "\\", '\\"[', "],[", "é", "日本", "", " ", '"]]]', "x\\\\", "\n\t[", "a,b"]
    word = lambda: [rnd.choice(hard) for _ in range(rnd.randint(0, 3))]
    verse = lambda: [word() for _ in range(rnd.randint(0, 4))]
    return [None if rnd.random() < 0.1 else [None if rnd.random() < 0.1 else verse() for _ in range(rnd.randint(0, 4))] for _ in range(chapters)]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "300")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def write_books(root):
    texts = {
        "plain": json.dumps(book(1)), "pretty": json.dumps(book(2), indent=3, ensure_ascii=False), "tight": json.dumps(book(3), separators=(",", ":")),
        "none": "[]", "nulls": " [ null , null ] \n", "one": "[[[[\"a\"]]]]", "deep": "\n\n" + json.dumps(book(4, 80), indent=1) + "\n",
    }
    for name, text in texts.items():
        (root / f"{name}.json").write_text(text)
    (root / "empty.json").write_text("")
    (root / "other.txt").write_text("[[[")
    return {k: json.loads(v) for k, v in texts.items()}


def test_chapters_equal_the_whole_books(spark, tmp_path, small_splits):
    books = write_books(tmp_path)
    got = read_nested_chapters(spark, str(tmp_path))
    assert spark.read.option("lineSep", "[").text(str(tmp_path / "deep.json")).rdd.getNumPartitions() >= 8
    found = {}
    for r in got.collect():
        assert r.file_name == f"{r.book_key}.json" and r.file.endswith(r.file_name)
        assert (r.book_key, r.chapter) not in found
        found[r.book_key, r.chapter] = json.loads(json.dumps(r.content, default=list))
    assert found == {(k, c): v for k, b in books.items() for c, v in enumerate(b, 1) if v is not None}


def test_words_equal_those_of_whole_books(spark, tmp_path, small_splits):
    write_books(tmp_path)
    (tmp_path / "empty.json").unlink()
    whole = explode_nested(read_nested_books(spark, str(tmp_path)), "book", keep=["book_key"])
    cut = explode_chapters(read_nested_chapters(spark, str(tmp_path)), by=["file"], keep=["book_key"])
    names = ["book_key", "chapter", "verse", "word", "ordinal", "value"]
    rows = lambda df: sorted(map(str, df.select(names).collect()))
    assert rows(whole) == rows(cut) and len(rows(cut)) > 100


@pytest.mark.parametrize("text", ['[[[["a"]]]', '[[[["a"]]]]]', '[[[["a]]]]', "{}", "words", '[[[["a"]]], [[[1, ]]]]', '[[[["a" "b"]]]]'])
def test_broken_books(spark, tmp_path, text):
    (tmp_path / "b.json").write_text(text)
    with pytest.raises(Exception, match="not a nested book"):
        read_nested_chapters(spark, str(tmp_path)).collect()
    assert any(r.content is None for r in read_nested_chapters(spark, str(tmp_path), on_error="null").collect())


def test_every_cut_of_a_text():
    """The two passes over all places where a split may start."""
    text = json.dumps(book(5, 6), separators=(", ", ":"))
    want = [json.dumps(c, separators=(", ", ":")) for c in json.loads(text) if c is not None]
    marks = [k for k, ch in enumerate(text) if ch == "["][1:]

    def batch(parts, extra=()):
        rows = [(7, at, piece, *x) for (at, chunk), x in zip(parts, extra or [()] * len(parts)) for piece in chunk.split("[")[at > 0:]]
        names = ["f", "block", "value", "inside", "depth", "chapter", "balanced"]
        return pa.RecordBatch.from_arrays([pa.array(v) for v in zip(*rows)], names=names[: len(rows[0])])

    for k in marks:
        parts = [(0, text[:k]), (k, text[k:])]
        sums = {r["block"]: r for b in C._summaries(iter([batch(parts)])) for r in b.to_pylist()}
        inside = sums[0]["quotes"] % 2
        depth = sums[0]["d0"]
        commas = sums[0]["h0"][1 + C._DEEP]
        assert depth + sums[k][f"d{inside}"] == 0 and (sums[0]["quotes"] + sums[k]["quotes"]) % 2 == 0
        extra = [(0, 0, 1, True), (inside, depth, commas + 1, True)]
        out = {}
        for b in C._parts(iter([batch(parts, extra)])):
            for r in b.to_pylist():
                if r["chapter"]:
                    out.setdefault(r["chapter"], []).append((r["block"], r["part"], r["text"]))
        assert ["".join(t for _, _, t in sorted(v)) for _, v in sorted(out.items())] == want


def test_levels_equal_nested(spark):
    rows = [(1, book(6)), (2, book(7, 60)), (3, []), (4, None), (None, book(8, 3))]
    df = spark.createDataFrame(rows, "id int, book array<array<array<array<string>>>>")
    a = explode_nested(df, "book")
    for n in (None, 5):
        b = explode_levels(df, "book", by=["id"], partitions=n)
        assert b.columns == a.columns
        assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert explode_levels(df, "book", by=["id"], ordinal=None).columns == ["id", "chapter", "verse", "word", "value"]


def test_one_book_is_many_tasks(spark):
    one = spark.range(1).select("id", F.transform(F.sequence(F.lit(1), F.lit(400)), lambda c: F.transform(
        F.sequence(F.lit(1), F.lit(50)), lambda v: F.transform(F.sequence(F.lit(1), F.lit(25)), lambda w: c * 10000 + v * 100 + w))).alias("book"))
    w = explode_levels(one, "book", by=["id"], partitions=16).withColumn("task", F.spark_partition_id())
    tasks = w.groupBy("task").count().collect()
    assert len(tasks) >= 8 and sum(r["count"] for r in tasks) == 500_000
    assert w.agg(F.count_distinct("ordinal"), F.min("ordinal"), F.max("ordinal")).first()[:] == (500_000, 1, 500_000)
