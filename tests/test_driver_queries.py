"""Every registered query runs on the smallest driver tables and has an
oracle; a few are checked against DuckDB here (the full comparison is
scripts/check_oracle.py)."""

import duckdb
import pytest

import __spark_entry__ as E

from tagweave.plans import catalog, oracle

SF_SMALL = "/root/testdata/sf0.001"

CHECK = ["gen_nested", "gen_levels", "src_chapters", "ord_run", "dec_tree", "dec_tree_verbs", "dec_dictionary", "batch_progress", "json_valid",
         "ser_omit_empty", "sink_profile", "src_manifest", "src_manifest_books", "src_variant", "wlc_words",
         "ser_json_sorted_nested", "ent_item_nested", "exact_batches", "gnt_words"]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() > 0
    assert {"doc_id", "ordinal", "id", "verse_id", "token"} <= set(df.columns)


def test_every_query_has_oracle():
    assert set(catalog.QUERIES) == set(oracle.oracle_sql())
    assert set(catalog.QUERIES) <= set(E.queries())


@pytest.mark.parametrize("key", CHECK)
def test_against_duckdb(spark, key):
    con = duckdb.connect()
    for t in ["orders", "lineitem", "events", "documents", "customer", "conversations", "pages", "nation", "supplier"]:  # noqa: E501
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    df = E.queries()[key](spark, SF_SMALL)
    got = sorted(tuple(str(r[c]) for c in sorted(df.columns)) for r in df.collect())
    res = con.execute(E.oracle_sql()[key])
    cols = [d[0] for d in res.description]
    idx = sorted(range(len(cols)), key=lambda i: cols[i])
    want = sorted(tuple(str(r[i]) for i in idx) for r in res.fetchall())
    assert sorted(df.columns) == sorted(cols)
    assert got == want
