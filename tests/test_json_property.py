"""Strict JSON validity agrees with DuckDB's json_valid on random JSON-like
strings.  Known differences are excluded: duplicate object keys (Spark
rejects them) and trailing commas like ``[1,]`` (DuckDB accepts them; they
are not JSON)."""

import re

import duckdb
from hypothesis import given, settings
from hypothesis import strategies as st

from tagweave.functions import is_json

ALPHABET = '{}[]":,0123456789.-+eE \tnultrfasx\\/'
_KEY = re.compile(r'"([^"\\]*)"\s*:')
_TRAILING_COMMA = re.compile(r",\s*[\]}]")


def _has_duplicate_keys(s: str) -> bool:
    keys = _KEY.findall(s)
    return len(keys) != len(set(keys))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.text(alphabet=ALPHABET, max_size=14), min_size=20, max_size=60))
def test_is_json_matches_duckdb(spark, values):
    values = [v for v in values if not _has_duplicate_keys(v) and not _TRAILING_COMMA.search(v)]
    values += ['{"a":[1,2,{"b":null}]}', "[1e5, -0.5, true]", '"a\\\\n"', "{}x", "01"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = {r.v: bool(r.ok) for r in df.select("v", is_json("v").alias("ok")).collect()}
    con = duckdb.connect()
    for v in set(values):
        want = con.execute("SELECT json_valid(?)", [v]).fetchone()[0]
        assert got[v] == bool(want), repr(v)
