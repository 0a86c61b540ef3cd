"""The manifest check decides whether `wlc_words` has rows; large books in
compressed files that follow each other."""

import gzip
import json
import random

import pytest

from tagweave.plans import books as books_plan
from tagweave.plans import catalog
from tagweave.sources import read_nested_chapters


def documents(spark, folder, ids):
    rows = [(i, f"a{i} b. c\nd") for i in ids]
    spark.createDataFrame(rows, "doc_id bigint, text string").write.parquet(str(folder / "documents.parquet"))
    return str(folder)


def test_a_missing_book_fails_wlc_words(spark, tmp_path):
    with pytest.raises(FileNotFoundError, match="manifest entry missing: ruth"):
        catalog.wlc_words(spark, documents(spark, tmp_path, [i for i in range(90) if i % 39 != 7])).collect()


def test_all_books_give_their_words(spark, tmp_path):
    words = catalog.wlc_words(spark, documents(spark, tmp_path, range(39))).collect()
    assert len(words) == 4 * 39 and len({w.book for w in words}) == 39


HARD = ["a", "[", "]", '"', "\\", '\\"[', "],[", "é", "日本", "", " ", '"]]]', "x\\\\", "\n\t[", "a,b"]


def book(seed, chapters=25):
    rnd = random.Random(seed)
    word = lambda: [rnd.choice(HARD) for _ in range(rnd.randint(0, 3))]
    verse = lambda: [word() for _ in range(rnd.randint(0, 4))]
    return [None if rnd.random() < 0.1 else [verse() for _ in range(rnd.randint(0, 4))] for _ in range(chapters)]


@pytest.fixture()
def small_splits(spark):
    old = {k: spark.conf.get(k, None) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.mark.parametrize("packed", [False, True])
def test_books_in_parts_equal_their_whole(spark, tmp_path, small_splits, packed):
    """A book's files are cut at any line, and compressed or not."""
    books = {"one.x": book(1), "two": book(2, 60), "none": []}
    rnd = random.Random(packed)
    for name, content in books.items():
        text = json.dumps(content, indent=1, ensure_ascii=False)
        ends = [k + 1 for k, c in enumerate(text[:-1]) if c == "\n"]
        cuts = sorted(rnd.sample(ends, min(12, len(ends))))
        (tmp_path / name).mkdir()
        for k, (a, b) in enumerate(zip([0, *cuts], [*cuts, len(text)])):
            raw = text[a:b].encode()
            file = tmp_path / name / f"part-{k:03d}.txt{'.gz' if packed else ''}"
            file.write_bytes(gzip.compress(raw) if packed else raw)
    got = read_nested_chapters(spark, f"{tmp_path}/*", glob="*.txt*", separator="\n", parts=True).collect()
    found = {(r.book_key, r.chapter): json.loads(json.dumps(r.content, default=list)) for r in got}
    assert len(found) == len(got) and {(r.file_name, r.file.rsplit("/", 1)[1]) for r in got} == {("one.x", "one.x"), ("two", "two")}
    assert found == {(k.removesuffix(".x"), c): v for k, b in books.items() for c, v in enumerate(b, 1) if v is not None}


def test_separators_of_whole_files(spark, tmp_path, small_splits):
    (tmp_path / "b.json").write_text(json.dumps(book(3, 50), indent=2))
    rows = [sorted(map(str, read_nested_chapters(spark, str(tmp_path), separator=s).collect())) for s in "[\n"]
    assert rows[0] == rows[1] and len(rows[0]) > 30
    for options in ({"parts": True}, {"separator": '"'}):
        with pytest.raises(ValueError, match="separator"):
            read_nested_chapters(spark, str(tmp_path), **options)


def test_large_books_are_stored_compressed_in_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(books_plan, "PART_BYTES", 2000)
    monkeypatch.setattr(books_plan, "_FILE_LINES", 7)
    monkeypatch.setattr(catalog, "scratch_path", lambda *_: str(tmp_path / "scratch"))
    texts = {i: None if i == 9 else "\n".join(" ".join(f'w{i}"\\[{k}' for k in range(j % 5)) for j in range(i % 11)) for i in range(120)}
    spark.createDataFrame(list(texts.items()), "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    words = catalog.src_chapters(spark, str(tmp_path))
    plan = words._jdf.queryExecution().executedPlan().toString()
    want = []
    for b in range(8):
        n, ids = 0, [i for i in range(b, 120, 8) if texts[i] is not None]
        for chapter, i in enumerate(ids, 2):
            for v, line in enumerate(texts[i].split("\n"), 1):
                for w, token in enumerate(line.split(" "), 1):
                    want.append((b, i, chapter, v, w, n := n + 1, token, '] "[\\\\" ['))
    assert sorted(map(tuple, words.collect())) == sorted(want)
    files = [p for p in (tmp_path / "scratch").rglob("part-*")]
    assert len(files) > 60 and all(p.name.endswith(".txt.snappy") for p in files)
    # the chapters' content is shuffled once, by what the ordinals' offsets are joined on
    assert plan.count("REPARTITION_BY_COL") == 2 and "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan
