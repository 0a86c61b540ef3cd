"""Words that stay where they are, literal splits, and tables that are folders."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave.operators import explode_nested, explode_text, run_ordinal_in_order, split_nested
from tagweave.operators.explode import _literal
from tagweave.plans import catalog
from tagweave.plans.wlc import manifest_check, read_wlc_words
from tagweave.sources import chapters as C
from tagweave.sources import read_tagged_lines

TEXTS = ["a b. c\nd", "", None, "\n", ". ", " x  y. . z\n\n", "é\u00a0日本. \U0001f600 q\r\n", "a.b . c"]


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture()
def documents(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")


@pytest.mark.parametrize("layout", ["file", "folder"])
def test_stream_reads_a_table_of_either_layout(spark, tmp_path, documents, layout):
    out = tmp_path / "made" if layout == "file" else tmp_path / "documents.parquet"
    documents.repartition(1 if layout == "file" else 3).write.parquet(str(out))
    if layout == "file":
        next(out.glob("part-*.parquet")).rename(tmp_path / "documents.parquet")
    got = catalog.stream_tokens(spark, str(tmp_path))
    want = catalog.gen_nested(spark, str(tmp_path))
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_words_of_even_lines_are_not_shuffled(spark, tmp_path):
    (tmp_path / "hebrew").mkdir()
    (tmp_path / "hebrew" / "a.txt").write_text('{"book_key": "jonah", "book": [[[["w", "1", "HNcmsc"]]]]}\n')
    words = read_wlc_words(spark, str(tmp_path), layout="lines", glob="*.txt", check=manifest_check(spark))
    p = plan(words)
    # one exchange beside the broadcasts: that of the distinct tags
    assert "SortMergeJoin" not in p and "REBALANCE" not in p.upper() and p.count("Exchange hashpartitioning") == 1
    assert [(r.book, r.lemma, r.MorphologyString is not None) for r in words.collect()] == [("Jonah", "w", True)]


def test_lines_in_order_are_not_shuffled(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"01010{i // 5} N- x t w n l\n" for i in range(20)))
    lines = read_tagged_lines(spark, str(tmp_path)).select("file", "block", "seq", F.col("fields")[0].alias("ref"))
    rows = run_ordinal_in_order(lines, by=["file"], chunk="block", value="ref")
    assert "SortMergeJoin" not in plan(rows) and "BroadcastHashJoin" in plan(rows)
    assert [r.ord for r in rows.orderBy("block", "seq").collect()] == [1, 2, 3, 4, 5] * 4


def test_literal_splits_equal_the_nested_ones(documents):
    seps = ["\n", r"\. ", " "]
    assert [_literal(s) for s in [*seps, ".", r"\s", "a+", r"\\", "[ ]", "", "ab"]] == ["\n", ". ", " ", None, None, None, "\\", None, None, "ab"]
    for ordinal in ("ordinal", None):
        got = explode_text(documents, "text", seps, ordinal=ordinal)
        want = explode_nested(documents.select("doc_id", split_nested("text", seps).alias("n")), "n", ordinal=ordinal)
        assert "MapInArrow" in plan(got) and got.dtypes == want.dtypes
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    regex = explode_text(documents, "text", ["\n", r"\.\s", "[ ]"])
    assert "MapInArrow" not in plan(regex)


def test_pieces_are_joined_as_bytes():
    batch = pa.RecordBatch.from_pydict({"f": pa.array([1, 1, 1, 2]), "block": pa.array([0, 0, 9, 0]), "value": ["é", "", "x]", ""]})
    runs = [(f, block, text, new) for _, f, block, text, new in C._runs(iter([batch]))]
    assert runs == [(1, 0, "é[".encode(), True), (1, 9, b"[x]", True), (2, 0, b"", True)]
