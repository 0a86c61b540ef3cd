import pytest

# Rows every operator must stand: nulls, empty and long texts, ties, repeats.
LONG = " ".join(f"w{i % 977} tail{i % 13}" for i in range(20_000))
ODD_ROWS = [
    (1, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood", "a"),
    (1, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood", "a"),
    (1, "another text of the same id", "b"),
    (None, "the quick brown fox jumps over the lazy dog and runs far away into the deep dark wood", None),
    (None, None, None),
    (2, None, "a"),
    (3, "", "a"),
    (4, " \t\n ", "b"),
    (5, LONG, "a"),
    (6, LONG, "b"),
    (7, "été ÉTÉ naïve 日本語 \x0b x", "c"),
    (-3, "z " * 60, "c"),
]


@pytest.fixture(scope="session")
def odd(spark):
    # extra columns whose names clash with ones the operators use inside
    schema = "doc_id bigint, text string, source string"
    df = spark.createDataFrame(ODD_ROWS, schema)
    from pyspark.sql import functions as F

    return df.select(
        F.lit(1).alias("key"), F.lit("x").alias("code"), "doc_id", F.lit(2).alias("id"), "text", F.lit("t").alias("tie"), "source",
        F.lit(0).alias("n"), F.lit(0).alias("size"), F.lit(0).alias("spans"), F.lit("y").alias("kept"), F.lit(True).alias("word"),
    ).repartition(3)


@pytest.fixture(scope="session")
def empty(odd):
    return odd.where("1 = 0")


@pytest.fixture(scope="session")
def vocab():
    public = pytest.importorskip("public_tokenizers")
    return public.path
