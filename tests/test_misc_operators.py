"""Lookup dimensions, key from name, payload profile, size-checked joins."""

import json

from pyspark.sql import functions as F

from tagweave.functions import tables
from tagweave.operators import book_dimension, join_small, lookup_table, payload_profile
from tagweave.sources import key_from_name, with_key_from_name


def test_lookup_table_counts(spark):
    counts = {r.lookup: r.n for r in lookup_table(spark, "tree").groupBy("lookup").agg(F.count("*").alias("n")).collect()}
    assert counts == {"hebrew_stem": 27, "aramaic_stem": 26, "conjugation": 11, "adjective_type": 4, "noun_type": 3,
                      "pronoun_type": 5, "preposition": 1, "suffix_type": 4, "particle_type": 9, "person": 3,
                      "gender": 4, "number": 3, "state": 3}
    assert lookup_table(spark, "positional").where("lookup = 'part'").count() == 13
    assert book_dimension(spark, "hebrew").count() == 39 and book_dimension(spark, "greek").count() == 27
    assert book_dimension(spark, "hebrew").where("name = 'Song of Solomon'").first().file_stem == "songofsolomon"


def test_key_from_name(spark):
    df = spark.createDataFrame([("61-Mt-morphgnt.txt",), ("99-Xx-morphgnt.txt",), ("readme.txt",)], "f string")
    dim = book_dimension(spark, "greek")
    got = with_key_from_name(df, "f", tables.GREEK_FILE_PATTERN, dim, "file_number", "name", on_no_match="null")
    res = {r.f: (r.book_number, r.book_name) for r in got.collect()}
    assert res == {"61-Mt-morphgnt.txt": (61, "Matthew"), "99-Xx-morphgnt.txt": (99, ""), "readme.txt": (None, "")}
    assert df.select(key_from_name("f", tables.GREEK_FILE_PATTERN).alias("k")).where("k is not null").count() == 2


def test_payload_profile(spark):
    df = spark.createDataFrame([("a", "x"), ("a", "héllo"), ("b", "")], "g string, t string")
    rows = {r.g: r for r in payload_profile(df, ["g"], ["t"]).collect()}
    sizes = [len(json.dumps({"t": v}, separators=(",", ":"), ensure_ascii=False).encode()) for v in ("x", "héllo")]
    assert rows["a"].records == 2 and rows["a"].min_bytes == min(sizes) and rows["a"].max_bytes == max(sizes)
    assert rows["b"].total_bytes == len('{"t":""}')


def test_join_small_hints_fixed_tables_only(spark):
    big = spark.range(100).withColumnRenamed("id", "k")
    small = spark.range(10).withColumnRenamed("id", "k")
    plan = lambda **kw: join_small(big, small, "k", **kw)._jdf.queryExecution().analyzed().toString().lower()
    assert "broadcast" in plan(known_small=True)
    assert "broadcast" not in plan()  # adaptive execution decides from real sizes


def test_default_folders():
    from tagweave.functions import tables

    assert tables.DEFAULT_NESTED_PATH == "./morphhb/" and tables.DEFAULT_TAGGED_PATH == "./morphgnt/"


def test_scratch_needs_a_shared_folder(monkeypatch):
    from tagweave import session

    class Sc:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    fake = type("S", (), {"sparkContext": Sc(), "conf": Conf()})()
    try:
        session.checkpoint_root(fake)
        raise AssertionError("expected an error")
    except RuntimeError as e:
        assert "spark.checkpoint.dir" in str(e)
