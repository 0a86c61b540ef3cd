"""The registered queries of the operators and, where SQL can express one, its
DuckDB form.  Each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ._licence_rules import RULES as LICENCE_RULES
from ._licence_rules import SENTENCES
from ._text import small_batches
from .conversations import damaged, repair
from .decontam import scan
from .hard_negatives import mine
from .licenses import license_scan
from .lm import score
from .minhash import near_duplicates as minhash_near_duplicates
from .mixing import plan_mix, taken, with_sources
from .resample import resample
from .rules import BASE_POLICY, ledger, verdict
from .simhash import near_duplicates
from .substring_dedup import remove_repeats
from .suffix_dedup import remove_repeated_bytes
from .tokens import lookup, read_manifest, with_crc32, write_shards


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def vocabulary(name: str) -> str:
    """Place of a public vocabulary file; on a cluster the package that holds
    them is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


OP1_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT r, doc_id, p, array_to_string(list_slice(ws, p, p + 12), ' ') AS k
  FROM (SELECT r, doc_id, ws, unnest(range(1, len(ws) - 11)) AS p FROM d)),
hit AS (SELECT r, p FROM (SELECT r, p, doc_id, min(doc_id) OVER (PARTITION BY k) AS low FROM w) WHERE low < doc_id),
gone AS (SELECT DISTINCT r, unnest(range(p, p + 13)) AS q FROM hit),
g AS (SELECT r, list(q) AS qs FROM gone GROUP BY r),
o AS (SELECT doc_id, ws, list_filter(ws, lambda x, i: NOT coalesce(list_contains(qs, i), false)) AS kept FROM d LEFT JOIN g USING (r))
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(kept))::BIGINT AS n_removed, sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM o
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(_table(spark, sf_dir, "documents"), shingle=3, max_bits=3)
    return found.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def op4_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    root = scratch_path(spark, "token-shards")
    write_shards(docs, root, vocabulary("word_bpe_49k.json"), end_id=1)
    found = with_crc32(lookup(docs, root), read_manifest(root)["width"])
    return found.select("doc_id", "start", "n_tokens", "ids_crc32", "shard")


def op5_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = plan_mix(_table(spark, sf_dir, "documents"))
    return with_sources(taken(mix), mix).select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    led = ledger(_table(spark, sf_dir, "documents"))
    base_failed = ~verdict(BASE_POLICY)
    return led.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        base_failed.alias("base_failed"), (~base_failed & verdict()).alias("kept"), "failed_bits",
    )


OP6_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
        list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS ls FROM d),
g AS (SELECT r, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS k
      FROM (SELECT r, ws, unnest(range(1, len(ws) - 1)) AS i FROM w)),
rep AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, k) AS c FROM g) WHERE c > 1),
cov AS (SELECT r, count(DISTINCT p) AS n FROM (SELECT r, unnest([i, i + 1, i + 2]) AS p FROM rep) GROUP BY r),
m AS (SELECT w.doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0)::BIGINT AS word_chars,
        length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols,
        len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines, coalesce(cov.n, 0) AS n_repeat_words,
        length(regexp_replace(t, '[\x00-\x40\x5B-\x60\x7B-\x7F]', '', 'g')) AS n_letters,
        length(regexp_replace(t, '[^A-Z]', '', 'g')) AS n_upper
      FROM w LEFT JOIN cov USING (r)),
b AS (SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (10 * n_symbols > n_words)::BIGINT
        + 8 * (2 * n_dup_lines > n_lines)::BIGINT + 16 * (word_chars < 2 * n_words)::BIGINT
        + 32 * (word_chars > 20 * n_words)::BIGINT + 64 * (2 * n_upper > n_letters)::BIGINT AS failed_bits FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, (failed_bits & 3) <> 0 AS base_failed,
  failed_bits = 0 AS kept, failed_bits FROM b
"""


def op7_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(_table(spark, sf_dir, "documents"), vocabulary("piece_bpe_32k.model"))


def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan(_table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_sentences", "n_known", F.array_join("sentence_ids", ",").alias("sentence_ids"),
        F.array_join("licenses", ",").alias("licenses"), "license",
    )


def _op8_sql() -> str:
    known = ", ".join(f"('{s}', '{i}')" for s, i in SENTENCES.items())
    # a rule matches when its identifiers appear in this order: a regular expression over ",a,b,c,"
    rules = ", ".join(f"CASE WHEN regexp_matches(x, ',{',(.*,)?'.join(seq)},') THEN '{name}' END" for name, seq in LICENCE_RULES)
    return rf"""
WITH known(s, id) AS (VALUES {known}),
d AS (SELECT row_number() OVER () AS r, doc_id, list_filter(list_transform(string_split(regexp_replace(regexp_replace(
        lower(coalesce(text, '')), '[.!?;]+([ \t\n\r"'')]|\z)', chr(10), 'g'), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g'), chr(10)),
        lambda y: trim(y)), lambda y: y <> '') AS ss FROM documents),
u AS (SELECT r, unnest(ss) AS s, unnest(range(len(ss))) AS p FROM d),
k AS (SELECT r, count(*) AS n, string_agg(id, ',' ORDER BY p) AS ids FROM u JOIN known USING (s) GROUP BY r),
m AS (SELECT doc_id, len(ss) AS n_sentences, coalesce(n, 0) AS n_known, coalesce(ids, '') AS sentence_ids,
        replace(',' || coalesce(ids, '') || ',', ',', ',,') AS x FROM d LEFT JOIN k USING (r)),
f AS (SELECT *, list_filter([{rules}], lambda y: y IS NOT NULL) AS found FROM m),
o AS (SELECT *, list_filter(found, lambda y, i: list_position(found, y) = i) AS ls FROM f)
SELECT doc_id, n_sentences, n_known, sentence_ids, array_to_string(ls, ',') AS licenses, ls[1] AS license FROM o
"""


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    found = resample(docs, labels, good="quality = 1 AND coalesce(toxic, 0) = 0", unwanted="toxic = 1")
    return found.select("doc_id", "n_grams", "log_weight", F.col("key").alias("gumbel_key"), F.col("selected").alias("kept"))


def op10_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = scan(docs, _table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", F.col("__n_words").alias("n_words"), F.col("__n_hit").alias("n_hit"),
        F.size("__items").cast("bigint").alias("n_items"), F.sha2(F.array_join("__items", ","), 256).alias("items_sha256"),
        (F.col("__n_hit") > 0).alias("contaminated"),
    )


OP10_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (SELECT row_number() OVER () AS k, item_id::VARCHAR AS item,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
i1 AS (SELECT *, least(10, len(ws)) AS n FROM i WHERE len(ws) > 0),
iw AS (SELECT DISTINCT k, item, n, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - n + 2)) AS p FROM i1)),
sizes AS (SELECT DISTINCT n FROM iw),
dw AS (SELECT r, p, n, array_to_string(list_slice(ws, p, p + n - 1), ' ') AS w
  FROM (SELECT r, ws, n, unnest(range(1, len(ws) - n + 2)) AS p FROM d, sizes)),
m AS (SELECT r, p, dw.n, k, item FROM dw JOIN iw USING (n, w)),
h AS (SELECT r, count(DISTINCT q) AS n_hit FROM (SELECT r, unnest(range(p, p + n)) AS q FROM (SELECT DISTINCT r, p, n FROM m)) GROUP BY r),
t AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (r) LEFT JOIN t USING (r)
"""


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(_table(spark, sf_dir, "embeddings"), anchors=F.col("vec_id") % 100 == 0, label_col=label).drop("positive_rank")


OP11_SQL = r"""
WITH v AS (SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.r AS ar, a.vec_id AS anchor_id, b.vec_id AS other_id, a.label = b.label AS alike,
    coalesce(list_inner_product(a.q, b.q), 0)::BIGINT AS score FROM v a JOIN v b ON a.r <> b.r WHERE a.vec_id % 100 = 0),
p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY ar ORDER BY score DESC, other_id NULLS LAST) AS p FROM s WHERE alike) WHERE p <= 5),
n AS (SELECT p.ar, p.p, p.anchor_id, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.ar, p.p ORDER BY s.score DESC, s.other_id NULLS LAST) AS k
  FROM p JOIN s ON p.ar = s.ar AND NOT s.alike AND 80 * p.score <= 100 * s.score AND 100 * s.score <= 100 * p.score)
SELECT anchor_id, positive_id, k::INTEGER AS rank, negative_id, positive_score, negative_score FROM n WHERE k <= 5
"""


def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash_near_duplicates(_table(spark, sf_dir, "documents"), shingle=5, percent=85)
    kept = F.col("id").eqNullSafe(F.col("component_id"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id", kept.alias("kept"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "conversations")
    return repair(rows, damaged(rows))


QUERIES = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_simhash_near_dedup": op3_simhash_near_dedup,
    "op4_token_output": op4_token_output,
    "op5_source_mixing": op5_source_mixing,
    "op6_quality_rules": op6_quality_rules,
    "op7_lm_scoring": op7_lm_scoring,
    "op8_license_scan": op8_license_scan,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_benchmark_decontamination": op10_benchmark_decontamination,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_minhash_near_dedup": op12_minhash_near_dedup,
    "op13_conversation_repair": op13_conversation_repair,
}

ORACLE_SQL = {
    "op1_substring_dedup": OP1_SQL,
    "op6_quality_rules": OP6_SQL,
    "op8_license_scan": _op8_sql(),
    "op10_benchmark_decontamination": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
}
