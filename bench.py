"""Benchmark of the headline queries.

Runs on ``$BENCH_SF_DIR`` (default /root/testdata/sf0.1) with
``local[$BENCH_CPUS]`` and prints one JSON line.  Each query runs once to
warm up, then ``$BENCH_REPS`` (default 3) times; the median is reported.
A query is executed in full through the ``noop`` sink, so nothing is
collected to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tagweave.functions import decode_tree, language, tag_string  # noqa: E402
from tagweave.operators import decode_by_dictionary, spread  # noqa: E402
from tagweave.plans import catalog  # noqa: E402
from tagweave.session import drop_scratch, scratch_path  # noqa: E402
from tagweave.sinks import write_jsonl  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
REPS = int(os.environ.get("BENCH_REPS", "3"))


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("tagweave-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(max(8, 2 * int(CPUS))))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


ROWS: dict[str, int] = {}


# Aggregating queries are measured on the rows they read, not the rows
# they return.
INPUT_TABLE = {"upsert_latest": "events", "sink_profile": "documents"}


def noop(df: DataFrame, name: str | None = None) -> None:
    df.write.format("noop").mode("overwrite").save()
    if name and name not in ROWS:
        src = INPUT_TABLE.get(name)
        ROWS[name] = catalog.table(df.sparkSession, SF_DIR, src).count() if src else df.count()


def lineitem_tags(spark: SparkSession) -> DataFrame:
    li = spread(catalog.table(spark, SF_DIR, "lineitem").select("l_orderkey", "l_linenumber"))
    sample = F.array(*[F.lit(t) for t in catalog.TAG_SAMPLE])
    idx = ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % len(catalog.TAG_SAMPLE) + 1).cast("int")
    return li.withColumn("tag", F.element_at(sample, idx))


def q_tree_rows(spark):
    t = lineitem_tags(spark)
    noop(t.select("l_orderkey", language("tag").alias("language"), tag_string(decode_tree("tag")).alias("m")), "tree_decode_rows")


def q_tree_dictionary(spark):
    d = decode_by_dictionary(lineitem_tags(spark), "tag")
    noop(d.select("l_orderkey", "language", "morphology_string"), "tree_decode_dictionary")


_JSONL_OUT: list[str] = []


def q_jsonl_write(spark):
    li = catalog.table(spark, SF_DIR, "lineitem")
    ROWS.setdefault("jsonl_write", li.count())
    if not _JSONL_OUT:  # one output folder, overwritten by every run
        _JSONL_OUT.append(scratch_path(spark, "bench-jsonl"))
    write_jsonl(li, _JSONL_OUT[0], by="l_returnflag", mode="overwrite")


QUERIES = {
    "gen_nested": lambda s: noop(catalog.gen_nested(s, SF_DIR), "gen_nested"),
    "id_sequence": lambda s: noop(catalog.id_sequence(s, SF_DIR), "id_sequence"),
    "ord_global": lambda s: noop(catalog.ord_global(s, SF_DIR), "ord_global"),
    "tree_decode_rows": q_tree_rows,
    "tree_decode_dictionary": q_tree_dictionary,
    "dec_positional": lambda s: noop(catalog.dec_positional(s, SF_DIR), "dec_positional"),
    "ord_run": lambda s: noop(catalog.ord_run(s, SF_DIR), "ord_run"),
    "batch_ranges": lambda s: noop(catalog.batch_ranges_q(s, SF_DIR), "batch_ranges"),
    "ser_json": lambda s: noop(catalog.ser_json(s, SF_DIR), "ser_json"),
    "json_columns": lambda s: noop(catalog.json_columns_q(s, SF_DIR), "json_columns"),
    "json_valid": lambda s: noop(catalog.json_valid(s, SF_DIR), "json_valid"),
    "upsert_latest": lambda s: noop(catalog.upsert_latest(s, SF_DIR), "upsert_latest"),
    "sink_profile": lambda s: noop(catalog.sink_profile(s, SF_DIR), "sink_profile"),
    "wlc_words_e2e": lambda s: noop(catalog.wlc_words(s, SF_DIR), "wlc_words_e2e"),
    "batch_progress": lambda s: noop(catalog.batch_progress(s, SF_DIR), "batch_progress"),
    "gnt_words_e2e": lambda s: noop(catalog.gnt_words(s, SF_DIR), "gnt_words_e2e"),
    "jsonl_write": q_jsonl_write,
}


def main() -> None:
    only = set(sys.argv[1:])
    spark = session()
    times: dict[str, float] = {}
    for name, fn in QUERIES.items():
        if only and name not in only:
            continue
        fn(spark)  # warm-up
        runs = []
        for _ in range(REPS):
            t0 = time.perf_counter()
            fn(spark)
            runs.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(runs), 3)
    drop_scratch(spark)
    sf = os.path.basename(SF_DIR.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "total_median_sec",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "rows": ROWS,
        "rows_per_sec": {k: round(ROWS[k] / v) for k, v in times.items() if k in ROWS and v > 0},
        "cpus": int(CPUS),
        "spark": spark.version,
    }))


if __name__ == "__main__":
    main()
