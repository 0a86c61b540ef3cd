"""Nested books written as lines, and words exploded without an ordinal."""

import pytest
from pyspark.sql import functions as F

from tagweave.operators import explode_nested, split_nested
from tagweave.plans import catalog
from tagweave.plans.books import book_lines

SEPS = ["\n", r"\. ", " "]
TEXTS = ["a b. c\nd", "", None, "\n", ". ", " x  y. . z\n\n", "é 日本. \U0001f600 q\r\n", 'q" \\ \t\b\f\x01\x1f\x7f  \\n"', "\x00 a"]


@pytest.mark.parametrize("seps", [SEPS, [SEPS[1], SEPS[0], SEPS[2]], SEPS[::2], [" "]])
def test_lines_equal_to_json(spark, seps):
    rows = [(i, f'k"{i}' if i else None, t) for i, t in enumerate(TEXTS)] + [(-5, "n", "neg tok"), (10**12, "b", "big tok"), (None, "m", "nul tok")]
    df = spark.createDataFrame(rows, "n bigint, k string, t string")
    df = df.unionByName(spark.sql("select 77L n, 'u' k, cast(x'61ff20e2822062c3' as string) t"))
    tags = ["A", 'B"', "C/d"]

    def json(third):
        nested, level = split_nested("t", seps), lambda t: F.array(t, F.col("k"), third(t))
        for _ in seps:
            level = (lambda below: lambda c: F.transform(c, below))(level)
        return sorted(r[0] for r in df.select(F.to_json(F.struct(F.col("k").alias("book_key"), level(nested).alias("book")))).collect())

    def lines(third, tags=()):
        return sorted(r.value for r in book_lines(df, F.col("k"), F.col("t"), seps, F.col("k"), third, tags).collect())

    n = F.col("n")
    assert lines(n.cast("string")) == json(lambda t: n.cast("string"))
    listed = F.array(*[F.lit(t) for t in tags])
    assert lines(n, tags) == json(lambda t: F.get(listed, F.pmod(n + F.length(t), F.lit(len(tags))).cast("int")))


def test_lines_need_plain_separators(spark):
    with pytest.raises(ValueError):
        book_lines(spark.range(1), F.lit("k"), F.lit("t"), [r"\s"], F.lit("a"), F.lit("b"))


def test_words_without_ordinal(spark):
    books = [(1, [[["a", None], [], None, ["b"]], None, [], [["c"]]]), (2, None), (3, []), (None, [[["d"]]])]
    df = spark.createDataFrame(books, "k int, book array<array<array<string>>>")
    want = explode_nested(df, "book").drop("ordinal")
    got = explode_nested(df, "book", ordinal=None)
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    # innermost arrays are exploded as they are: one generator for the verses, one for the words
    assert got._jdf.queryExecution().executedPlan().toString().count("Generate ") == 2
    flat = explode_nested(df, F.array(F.lit("x"), F.lit("y")), coords=(), ordinal=None, keep=["k"])
    assert flat.count() == 8


def test_variant_books_are_compressed(spark, tmp_path):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS) if t is not None], "doc_id bigint, text string")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    words = catalog.src_variant(spark, str(tmp_path))
    files = words.inputFiles()
    assert files and all(f.endswith(".txt.snappy") for f in files)
    assert any("/hebrew/books/" in f for f in files) and any("/remapped/books/" in f for f in files)
    for variant, seps in (("hebrew", SEPS), ("remapped", [SEPS[1], SEPS[0], SEPS[2]])):
        want = explode_nested(df.select("doc_id", split_nested("text", seps).alias("b")), "b", value="token").drop("ordinal")
        got = words.where(F.col("variant") == variant).select("doc_id", *[F.col(c).cast("int") for c in ("chapter", "verse", "word")], "token")
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
