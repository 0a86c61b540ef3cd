"""The pipeline's stages against what each must do to its own input."""

from pyspark.sql import functions as F

import corpus_pipeline as P
from tagweave.llm import decontam, rules, simhash

SF_SMALL = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "decontamination", "mixing", "token_output"]
    given = docs
    rows = {}
    for name, stage in P.STAGES:
        out = stage(spark, given, SF_SMALL)
        if name != "token_output":
            assert out.columns == docs.columns
        kept = out.collect()
        rows[name] = (given, kept)
        given = spark.createDataFrame(kept, out.schema)

    given, kept = rows["quality_rules"]
    ok = {r.doc_id for r in rules.ledger(given).where(rules.verdict()).collect()}
    assert {r.doc_id for r in kept} == ok
    given, kept = rows["near_duplicates"]
    groups = {r.component_id for r in simhash.near_duplicates(given).collect()}
    assert sorted(r.doc_id for r in kept) == sorted(groups)
    given, kept = rows["decontamination"]
    items = spark.read.parquet(f"{SF_SMALL}/benchmark.parquet")
    found = {r.doc_id: r for r in decontam.scan(given, items).collect()}
    for r in kept:
        f = found[r.doc_id]
        assert (r.text == f.text) == (f["__n_hit"] == 0) and r.n_chars == len(r.text)
    assert {r.doc_id for r in kept} == {i for i, f in found.items() if not f["__drop"]}
    given, kept = rows["mixing"]
    size = {r.doc_id: len(r.text.split()) for r in given.collect()}
    took = {r.doc_id: len(r.text.split()) for r in kept}
    assert all(0 < took[i] <= 3 * size[i] for i in took)
    assert abs(sum(took.values()) - sum(size.values())) < 64 * 21
    given, kept = rows["token_output"]
    assert sorted(r.doc_id for r in kept) == sorted(r.doc_id for r in given.collect())
    start = 0
    for r in sorted(kept, key=lambda r: r.doc_id):
        assert r.start == start
        start += r.n_tokens


def test_run_and_empty_input(spark, tmp_path):
    src = tmp_path / "sf"
    for t in ("documents", "benchmark"):
        spark.read.parquet(f"{SF_SMALL}/{t}.parquet").where(F.lit(False)).write.parquet(str(src / f"{t}.parquet"))
    assert P.run(spark, str(src)).count() == 0


def test_each_stage_on_odd_rows(spark, odd, empty):
    n = odd.count()
    for name, stage in P.STAGES:
        out = stage(spark, odd, SF_SMALL)
        rows = out.collect()
        if name == "token_output":
            assert len(rows) == n and sum(r.doc_id is None for r in rows) == 2
        else:
            # decontamination and mixing state the length of what they have changed
            assert [c for c in out.columns if c != "n_chars"] == odd.columns
            given = {(r.doc_id, r.text) for r in odd.collect()}
            if name in ("quality_rules", "near_duplicates"):
                assert {(r.doc_id, r.text) for r in rows} <= given
            assert len(rows) <= n and all(r.key == 1 and r.kept == "y" for r in rows)
        assert stage(spark, empty, SF_SMALL).count() == 0
