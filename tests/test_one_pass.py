"""What runs in one pass: run ordinals in scan order, the observed manifest,
routed lines, and the writer's own progress; ties of last writes."""

import inspect
import json
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tagweave.operators import latest_by_key, run_ordinal
from tagweave.operators import sequence as S
from tagweave.plans.gnt import read_gnt_words, read_routed_gnt_words
from tagweave.plans.stores import DEFAULT_TABLE, write_words
from tagweave.plans.wlc import manifest_check, read_wlc_words
from tagweave.sinks.kvbatch import progress, register, write_report
from tagweave.sources import ManifestCheck
from tagweave.sources.files import DEFAULT_NESTED_PATH, DEFAULT_TAGGED_PATH

CLIENT = "recording:recording_client"


@pytest.fixture()
def conf(spark):
    old = {}

    def set_(**kw):
        for k, v in kw.items():
            k = k.replace("__", ".")
            old.setdefault(k, spark.conf.get(k, None))
            spark.conf.set(k, v)

    yield set_
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def lines_of(rnd, n):
    """Tagged lines whose reference stays, changes and comes back; long runs
    fill whole splits."""
    refs = []
    while len(refs) < n:
        ref = f"{rnd.choice([1, 2, 27]):02d}{rnd.randint(1, 3):02d}{rnd.randint(1, 4):02d}"
        refs += [ref] * rnd.choice([1, 2, 5, 40, 200])
    return [f"{r} N- ----NSF- t{i} w n l" for i, r in enumerate(refs[:n])]


def ordinals(lines):
    out, last, k = [], None, 0
    for line in lines:
        ref = line.split(" ")[0]
        k = k + 1 if ref == last else 1
        last = ref
        out.append((line.split(" ")[3], k))
    return out


@pytest.mark.parametrize("split", ["512", "4096", "134217728"])
def test_run_ordinal_over_file_splits(spark, tmp_path, conf, split):
    rnd = random.Random(int(split))
    want = set()
    for name in ("61-Mt", "62-Mk", "63-Lk"):
        lines = lines_of(rnd, 700)
        lines = [line.replace(" t", f" {name}t") for line in lines]
        (tmp_path / f"{name}-morphgnt.txt").write_text("\n".join(lines) + "\n")
        want |= set(ordinals(lines))
    conf(spark__sql__files__maxPartitionBytes=split, spark__sql__files__openCostInBytes="0", spark__sql__execution__arrow__maxRecordsPerBatch="33")
    words = read_gnt_words(spark, str(tmp_path))
    assert {(r.text, r.ord) for r in words.collect()} == want
    plan = words._jdf.queryExecution().executedPlan().toString()
    assert "RangePartitioning" not in plan and " ord" in " ".join(words.columns) and words.count() == 2100


def test_both_run_ordinals_agree(spark, conf):
    conf(spark__sql__execution__arrow__maxRecordsPerBatch="7")
    rnd = random.Random(3)
    rows, seq = [], 0
    for g in (None, "a", "b"):
        for chunk in range(6):
            for _ in range(rnd.choice([1, 3, 30])):
                rows.append((g, chunk, seq, rnd.choice([None, None, "x"]) if g == "a" else "same" if g == "b" else rnd.choice("xy")))
                seq += 1
    schema = "g string, chunk int, seq int, v string"
    df = spark.createDataFrame(rows, schema).coalesce(1)
    a = run_ordinal(df, ["g"], ["seq"], "v", chunk=F.col("chunk"))
    b = S.run_ordinal_in_order(df, ["g"], "chunk", "v")
    assert b.columns == a.columns
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))
    assert S.run_ordinal_in_order(df.where("1 = 0"), ["g"], "chunk", "v").count() == 0


def test_runs_go_on_between_batches():
    runs = S._Runs(1)
    key, v = lambda x: [pa.array(x)], lambda x: pa.array(x, pa.string())
    assert [x.tolist() for x in runs.add(key([1, 1]), v(["a", "a"]))] == [[1, 2], [1, 1], [True, False]]
    assert [x.tolist() for x in runs.add(key([1, 1, 2]), v(["a", "b", "b"]))] == [[3, 1, 1], [1, 2, 1], [False, False, True]]
    assert [x.tolist() for x in runs.add(key([2]), v(["b"]))] == [[2], [1], [False]]


def books(root, layout, names=("jonah", "nahum")):
    folder = root / "hebrew"
    folder.mkdir()
    content = {n: [[[[f"{n}{v}", str(v), "HNcmsc"] for v in range(3)], [["x", "9", "HD"]]], None, [[["y", "1", "HNp"]]]] for n in names}
    if layout == "lines":
        (folder / "all.txt").write_text("\n".join(json.dumps({"book_key": n, "book": b}) for n, b in content.items()) + "\n")
    else:
        for n, b in content.items():
            (folder / f"{n}.json").write_text(json.dumps(b, indent=2))
    return str(root)


@pytest.mark.parametrize("layout", ["files", "lines", "chapters"])
def test_manifest_is_observed_by_the_job(spark, tmp_path, layout):
    root = books(tmp_path, layout)
    check = manifest_check(spark)
    words = read_wlc_words(spark, root, layout=layout, glob="*.txt" if layout == "lines" else "*.json", check=check)
    rows = {(r.book, r.chapter, r.verse_no, r.word_no, r.ordinal, r.lemma) for r in words.collect()}
    assert ("Jonah", 3, 1, 1, 5, "y") in rows and ("Nahum", 1, 2, 1, 4, "x") in rows and len(rows) == 10
    missing = check.missing()
    assert len(missing) == 37 and "jonah" not in missing and missing[0] == "genesis"
    with pytest.raises(FileNotFoundError, match="genesis"):
        check.verify()


def test_layouts_give_the_same_words(spark, tmp_path):
    a, b = tmp_path / "a", tmp_path / "b"
    a.mkdir(), b.mkdir()
    out = []
    for root, layout in ((books(a, "files"), "files"), (str(a), "chapters"), (books(b, "lines"), "lines")):
        w = read_wlc_words(spark, root, layout=layout, glob="*.txt" if layout == "lines" else "*.json", allow_missing=True)
        out.append((w.dtypes, sorted(map(str, w.collect()))))
    assert out[0] == out[1] == out[2]


def test_observed_check_passes_and_ends_a_write(spark, tmp_path):
    root = books(tmp_path, "files")
    for keys, good in ((["jonah", "nahum"], True), (["jonah", "obadiah"], False)):
        check = ManifestCheck(keys)
        words = read_wlc_words(spark, root, check=check)
        out = str(tmp_path / f"out{good}")
        if good:
            write_words(words, "wlc", "jsonl", path=out, check=check)
        else:
            with pytest.raises(FileNotFoundError, match="obadiah"):
                write_words(words, "wlc", "jsonl", path=out, check=check)


def test_overwrite_makes_reruns_safe(spark, tmp_path):
    root = books(tmp_path, "files")
    words = read_wlc_words(spark, root, allow_missing=True)
    count = lambda p: spark.read.json(f"{p}/{DEFAULT_TABLE['wlc']}").count()
    for mode, n in (("append", 20), ("overwrite", 10)):
        out = str(tmp_path / mode)
        for _ in range(2):
            write_words(words, "wlc", "jsonl", path=out, mode=mode)
        assert count(out) == n
    write_words(words.where("book = 'Jonah'"), "wlc", "jsonl", path=str(tmp_path / "overwrite"), mode="overwrite")
    assert count(tmp_path / "overwrite") == 10  # the other book stays


def test_defaults():
    assert inspect.signature(read_wlc_words).parameters["root"].default == DEFAULT_NESTED_PATH == "./morphhb/"
    assert inspect.signature(read_wlc_words).parameters["variant"].default == "hebrew"
    assert inspect.signature(read_gnt_words).parameters["path"].default == DEFAULT_TAGGED_PATH
    assert set(DEFAULT_TABLE) == {"wlc", "gnt"}


def test_routed_lines(spark, tmp_path, conf):
    src = tmp_path / "in"
    src.mkdir()
    rnd = random.Random(8)
    good = lines_of(rnd, 400)
    text, bad = [], []
    for k, line in enumerate(good):
        text.append(line)
        if k % 7 == 0:
            bad.append(rnd.choice(["", "010101 N-", "x y"]))
            text.append(bad[-1])
    (src / "61-Mt-morphgnt.txt").write_text("\n".join(text) + "\n")
    conf(spark__sql__files__maxPartitionBytes="3000", spark__sql__files__openCostInBytes="0")
    words, left = read_routed_gnt_words(spark, str(src), str(tmp_path / "routed"))
    assert {(r.text, r.ord) for r in words.collect()} == set(ordinals(good))
    assert sorted(r.line for r in left.collect()) == sorted(bad)
    assert words.count() + left.count() == len(text)
    assert "/in/" not in words._jdf.queryExecution().executedPlan().toString()  # nothing is read from the source again


def make_events(spark, n=500):
    rnd = random.Random(1)
    rows = [(rnd.choice([None, 1, 2, 3, 99]), rnd.choice("ab"), rnd.choice([None, 1.0, 2.0, 3.0]), rnd.choice([None, 1, 2]), f"v{k % 50}", {"k": k % 3}) for k in range(n)]
    return rows, spark.createDataFrame(rows, "key int, part string, ts double, n int, text string, props map<string,int>").repartition(4)


@pytest.mark.parametrize("seq", [["ts", "n"], ["n", "ts"], ["ts"]])
def test_latest_by_key_ties(spark, seq):
    rows, df = make_events(spark)
    got = latest_by_key(df, ["key", "part"], seq)
    at = {"ts": 2, "n": 3}
    rank = lambda r: tuple((r[at[c]] is not None, r[at[c]] or 0) for c in seq)
    best = {}
    for r in rows:
        best[r[:2]] = max(best.get(r[:2], rank(r)), rank(r))
    found = got.collect()
    assert {(r.key, r.part) for r in found} == set(best) and len(found) == len(best)
    assert all(rank(tuple(r)) == best[r.key, r.part] for r in found)
    assert sorted(map(str, found)) == sorted(map(str, latest_by_key(df.repartition(7), ["key", "part"], seq).collect()))  # ties too


def test_latest_by_key_of_text(spark):
    rows, df = make_events(spark)
    found = {r.key: r.text for r in latest_by_key(df, ["key"], ["text", "n"]).collect()}
    assert found == {k: max(r[4] for r in rows if r[0] == k) for k in {r[0] for r in rows}}
    assert latest_by_key(df.where("1 = 0"), ["key"], ["ts"]).count() == 0


@pytest.mark.parametrize("reject", [0, 3])
def test_progress_comes_from_the_writer(spark, tmp_path, reject):
    register(spark)
    from tagweave.operators import exact_batches

    rows = [("Jonah", i) for i in range(230)] + [("Nahum", i) for i in range(60)]
    df = spark.createDataFrame(rows, "book string, ordinal int")
    laid = exact_batches(df, ["book"], ["ordinal"], 25, chunk=F.floor(F.col("ordinal") / 40), partitions=4)
    folder = str(tmp_path / "report")
    for _ in range(2):  # a second write's report replaces the first's
        (laid.write.format("kvbatch").mode("append").option("table", "t").option("client", CLIENT).option("client.record_dir", str(tmp_path / "rec"))
            .option("client.reject_last", str(reject)).option("base_sleep", "0.01").option("group_by", "book,batch_no").option("report", folder).save())
    report = write_report(spark, folder)
    assert report.agg(F.sum("rows")).first()[0] == 290
    assert report.where(f"resends <> {int(reject > 0)}").count() == 0
    done = {(r.group[0], r.batch): (r.lo, r.hi, r.pct) for r in progress(report).collect()}
    assert len(done) == 13 and done["Jonah", 0] == (0, 25, 10.87) and done["Jonah", 9] == (225, 230, 100.0) and done["Nahum", 2] == (50, 60, 100.0)
    assert progress(report, group=1, number=None).where("pct > 100").count() == 0


def test_write_words_reports(spark, tmp_path):
    words = read_wlc_words(spark, books(tmp_path, "files"), allow_missing=True)
    folder = str(tmp_path / "progress")
    write_words(words, "wlc", "dynamo", client=CLIENT, options={"client.record_dir": str(tmp_path / "rec")}, report=folder)
    done = progress(write_report(spark, folder)).collect()
    assert sorted((r.group[0], r.lo, r.hi, r.pct) for r in done) == [("Jonah", 0, 5, 100.0), ("Nahum", 0, 5, 100.0)]
