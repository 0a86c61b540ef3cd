"""Sinks (JSONL round trip, kvbatch data source) and incremental arrival."""

import json
import os

import pytest
from pyspark.sql import functions as F

from tagweave.sinks import read_jsonl, register, write_jsonl
from recording import read_calls
from tagweave.streaming import stream_corpus_files

CLIENT = "recording:recording_client"


def test_jsonl_append_and_dynamic_overwrite(spark, tmp_path):
    df = spark.createDataFrame([("Jonah", 1, "a"), ("Jonah", 2, "b"), ("Nahum", 3, "c")], "book string, id bigint, lemma string")
    out = str(tmp_path / "jsonl")
    write_jsonl(df, out, by="book", mode="append")
    write_jsonl(df, out, by="book", mode="append")
    assert read_jsonl(spark, out, "id bigint, lemma string, book string").count() == 6  # re-run duplicates
    write_jsonl(df.where("book = 'Jonah'"), out, by="book", mode="overwrite")
    back = read_jsonl(spark, out, "id bigint, lemma string, book string")
    assert back.where("book = 'Jonah'").count() == 2 and back.where("book = 'Nahum'").count() == 2
    assert os.path.isdir(os.path.join(out, "book=Jonah"))


def _kv_df(spark, n=60):
    return spark.createDataFrame([(f"v{i // 7}", i, f"w{i}") for i in range(n)], "verse string, id bigint, lemma string")


def test_kvbatch_retry_profile(spark, tmp_path):
    register(spark)
    rec = str(tmp_path / "rec")
    (_kv_df(spark).repartition(3).write.format("kvbatch").mode("append")
        .option("table", "morphwlc").option("client", CLIENT).option("client.record_dir", rec)
        .option("client.reject_last", "2").option("base_sleep", "0.01").save())
    calls = read_calls(rec)
    assert all(c["n"] <= 25 for c in calls)
    accepted = sorted(i["id"] for c in calls for i in c["accepted"])
    assert accepted == list(range(60))  # every row delivered exactly once despite rejections
    assert any(c["n"] == 2 for c in calls)  # the resend of the rejected tail


def test_kvbatch_multi_put_and_per_row_group_boundaries(spark, tmp_path):
    register(spark)
    rec = str(tmp_path / "mp")
    df = _kv_df(spark).repartition(2, "verse").sortWithinPartitions("verse", "id")
    (df.write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT)
        .option("client.record_dir", rec).option("profile", "multi_put").option("key", "id")
        .option("batch_size", "5").option("group_by", "verse").save())
    calls = read_calls(rec)
    for c in calls:
        assert c["n"] <= 5 and len({i["verse"] for i in c["accepted"]}) == 1
        assert c["keys"] == [str(i["id"]) for i in c["accepted"]]
    rec2 = str(tmp_path / "pr")
    (_kv_df(spark, 10).write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT)
        .option("client.record_dir", rec2).option("profile", "per_row").option("key", "id").save())
    assert sorted(int(c["keys"][0]) for c in read_calls(rec2)) == list(range(10))


def test_kvbatch_option_check_before_data(spark, tmp_path):
    register(spark)
    with pytest.raises(Exception, match="required option"):
        _kv_df(spark).write.format("kvbatch").mode("append").option("client", CLIENT).save()
    with pytest.raises(Exception, match="(?i)project_id"):
        (_kv_df(spark).write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT)
            .option("require", "PROJECT_ID").save())


def test_stream_nested_books_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    (landing / "jonah.json").write_text(json.dumps([[[["a", "1", "HNp"], ["b", "2", "HD"]]]]), encoding="utf-8")
    out = str(tmp_path / "out")
    ck = str(tmp_path / "ck")

    def sink(words, epoch):
        write_jsonl(words.select("book", "id", "MorphologyString"), out, by="book", mode="append")

    stream_corpus_files(spark, str(landing), sink, kind="nested", checkpoint=ck).awaitTermination(120)
    (landing / "nahum.json").write_text(json.dumps([[[["c", "3", "HNp"]]]]), encoding="utf-8")
    stream_corpus_files(spark, str(landing), sink, kind="nested", checkpoint=ck).awaitTermination(120)
    back = read_jsonl(spark, out, "id bigint, MorphologyString string, book string")
    assert sorted(r.id for r in back.collect()) == [32001001001, 32001001002, 34001001001]  # no file twice


def test_stream_tagged_lines(spark, tmp_path):
    landing = tmp_path / "gl"
    landing.mkdir()
    (landing / "61-Mt-morphgnt.txt").write_text("010101 N- ----NSF- a a a a\n010101 C- -------- b b b b\n", encoding="utf-8")
    got = []
    stream_corpus_files(spark, str(landing), lambda w, e: got.extend(r.id for r in w.collect()), kind="tagged",
                        checkpoint=str(tmp_path / "ck2")).awaitTermination(120)
    assert sorted(got) == [4001011, 4001012]


def test_kvbatch_exact_batches_per_group(spark, tmp_path):
    from tagweave.operators import exact_batches

    register(spark)
    rows = [("Jonah", i) for i in range(230)] + [("Nahum", i) for i in range(60)]
    df = spark.createDataFrame(rows, "book string, ordinal int")
    laid = exact_batches(df, ["book"], ["ordinal"], 25, chunk=F.floor(F.col("ordinal") / 40), partitions=4)
    rec = str(tmp_path / "exact")
    (laid.write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT)
        .option("client.record_dir", rec).option("group_by", "book,batch_no").save())
    got = sorted((c["accepted"][0]["book"], [i["ordinal"] for i in c["accepted"]]) for c in read_calls(rec))
    want = sorted([("Jonah", list(range(lo, min(lo + 25, 230)))) for lo in range(0, 230, 25)]
                  + [("Nahum", list(range(lo, min(lo + 25, 60)))) for lo in range(0, 60, 25)])
    assert got == want


def test_stream_files_to_table_is_incremental(spark, tmp_path):
    from tagweave.streaming import stream_files_to_table

    landing, out, ck = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "ck")
    spark.createDataFrame([(1, "a b")], "doc_id bigint, text string").write.mode("append").parquet(landing)
    split = lambda df: df.select("doc_id", F.explode(F.split("text", " ")).alias("token"))
    assert stream_files_to_table(spark, landing, split, out, checkpoint=ck).count() == 2
    spark.createDataFrame([(2, "c")], "doc_id bigint, text string").write.mode("append").parquet(landing)
    back = stream_files_to_table(spark, landing, split, out, checkpoint=ck)
    assert sorted((r.doc_id, r.token) for r in back.collect()) == [(1, "a"), (1, "b"), (2, "c")]


def test_kvbatch_fixed_batches_across_arrow_batches(spark, tmp_path):
    register(spark)
    rec = str(tmp_path / "fixed")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")  # batches of 25 span Arrow batches
    try:
        (_kv_df(spark).coalesce(1).write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT)
            .option("client.record_dir", rec).save())
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    calls = read_calls(rec)
    assert [c["n"] for c in calls] == [25, 25, 10]
    assert [i["id"] for c in calls for i in c["accepted"]] == list(range(60))


def test_replayed_micro_batch_adds_no_row(spark, tmp_path):
    from tagweave.streaming.incremental import epoch_writer

    out = str(tmp_path / "epochs")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    each = epoch_writer(lambda b: b, out)
    each(df, 0)
    each(df, 0)  # the batch runs again after its write
    each(df, 1)
    assert spark.read.option("basePath", out).parquet(out).count() == 4


def test_jsonl_in_word_order(spark, tmp_path):
    out = str(tmp_path / "ordered")
    df = spark.range(500).select(F.lit("b").alias("book"), ((F.col("id") * 37) % 500).alias("n")).withColumn("pos", F.col("n"))
    write_jsonl(df.repartition(7), out, by="book", order=["pos"], max_records_per_file=200)
    files = sorted((tmp_path / "ordered" / "book=b").glob("part-*.json"))
    got = [json.loads(x)["n"] for f in files for x in f.read_text().splitlines()]
    assert got == list(range(500)) and all(len(f.read_text().splitlines()) <= 200 for f in files)
