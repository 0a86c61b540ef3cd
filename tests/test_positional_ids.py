"""Positional decode (FIXTURES §5), labels and identifier composition."""

import pytest
from pyspark.sql import functions as F

from tagweave.functions import concat_id, decode_positional, greek_part, label, padded_id, recode_ref, sequence_id


def test_positional_golden(spark):
    rows = [("N-", "----NSF-"), ("V-", "3AAI-S--"), ("A-", "----APMC"), ("RA", "3P"), ("C-", "--------ZZ")]
    df = spark.createDataFrame(rows, "part string, codes string")
    got = [r.m.asDict() for r in df.select(decode_positional("codes", part="part").alias("m")).collect()]
    absent = dict.fromkeys(["person", "tense", "voice", "mood", "case", "number", "gender", "degree"])
    assert got[0] == {**absent, "part": "noun", "case": "nominative", "number": "singular", "gender": "feminine"}
    assert got[1] == {**absent, "part": "verb", "person": "third", "tense": "aorist", "voice": "active", "mood": "indicative", "number": "singular"}
    assert got[2] == {**absent, "part": "adjective", "case": "accusative", "number": "plural", "gender": "masculine", "degree": "comparative"}
    assert got[3] == {**absent, "part": "definite article", "person": "third", "tense": "present"}
    assert got[4] == {**absent, "part": "conjunction"}


def test_invalid_part_raises(spark):
    df = spark.createDataFrame([("ZZ", "x")], "part string, codes string")
    with pytest.raises(Exception, match="invalid part ZZ"):
        df.select(decode_positional("codes", part="part")).collect()
    assert df.select(greek_part("part", strict=False).alias("p")).first().p is None


def test_label_generic(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    assert [r.l for r in df.select(label("c", {"a": "A"}).alias("l")).collect()] == ["A", None]


def test_recode_and_concat_ids(spark):
    refs = ["010101", "010101", "010102", "010101", "xx0101"]
    df = spark.createDataFrame([(r, o) for r, o in zip(refs, [1, 2, 1, 1, 3])], "ref string, ord int")
    out = df.select(recode_ref("ref").alias("v")).withColumn("id", concat_id("v", F.lit(1)))
    assert [r.v for r in out.collect()] == ["400101", "400101", "400102", "400101", "390101"]
    d2 = spark.createDataFrame([("400101", 10), ("400101", 1000)], "v string, o int")
    assert [r.i for r in d2.select(concat_id("v", "o").alias("i")).collect()] == [40010110, 4001011000]
    with pytest.raises(Exception, match="32-bit"):
        d2.select(concat_id("v", "o", strict32=True)).collect()


def test_padded_and_sequence_ids(spark):
    df = spark.createDataFrame([(31, 1, 1, 1), (1, 3, 1, 1000), (32, 4, 11, 688)], "b int, c int, v int, o int")
    rows = df.select(padded_id("b", "c", "v").alias("verse"), padded_id("b", "c", "v", "o", widths=(2, 3, 3, 3)).alias("s"),
                     sequence_id("b", "c", "v", "o").alias("id")).collect()
    assert [(r.verse, r.s, r.id) for r in rows] == [
        ("31001001", "31001001001", 31001001001),
        ("01003001", "010030011000", 10030011000),
        ("32004011", "32004011688", 32004011688),
    ]
