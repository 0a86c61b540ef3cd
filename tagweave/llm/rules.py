"""Rule bitmask ledger: every quality rule is evaluated once per document and
leaves one failure bit next to its measurements; policies are versioned bit
masks applied to the ledger afterwards, and ablations are bitwise
aggregations of it, so no rule is ever measured again.

Edge cases: a null or empty text has no words, all measures 0, and fails
``few_words``; a null id is kept as null; repeated rows each get their own
row; other columns of the input are ignored by `ledger` and kept by
`apply_policy`; an empty table gives no rows.  A very long text is measured whole,
as a block of its own."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._text import BLOCK_BYTES, WORD_BYTES, blocks, find_words, mapped, mix64, per_text, row_of, word_hashes

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letters", "n_upper")

_SYMBOLS = np.zeros(256, dtype=bool)
_SYMBOLS[list(b"#*$%&|<>")] = True
_UPPER = np.zeros(256, dtype=bool)
_UPPER[65:91] = True
_LETTER = _UPPER.copy()
_LETTER[97:123] = True
_LETTER[128:] = True
# bytes that start a character: all but those inside one
_STARTS = np.ones(256, dtype=bool)
_STARTS[0x80:0xC0] = False
_NO_LINE_END = np.ones(256, dtype=bool)
_NO_LINE_END[10] = False


@dataclass(frozen=True)
class Rule:
    """``fails`` is a SQL predicate over the measures; ``bit`` never changes
    once a ledger was written with it."""

    bit: int
    name: str
    fails: str


RULES = (
    Rule(0, "few_words", "n_words < 50"),
    Rule(1, "repeated_windows", "100 * n_repeat_words > 50 * n_words"),
    Rule(2, "symbols", "10 * n_symbols > n_words"),
    Rule(3, "duplicate_lines", "2 * n_dup_lines > n_lines"),
    Rule(4, "short_words", "word_chars < 2 * n_words"),
    Rule(5, "long_words", "word_chars > 20 * n_words"),
    Rule(6, "shouting", "2 * n_upper > n_letters"),
)


@dataclass(frozen=True)
class Policy:
    """Which rule bits reject a document.  A new version is a new mask over
    the same ledger."""

    version: int
    rules: tuple[str, ...] = field(default_factory=lambda: tuple(r.name for r in RULES))

    def mask(self, rules: Sequence[Rule] = RULES) -> int:
        bits = {r.name: r.bit for r in rules}
        return sum(1 << bits[name] for name in self.rules)


BASE_POLICY = Policy(1, ("few_words", "repeated_windows"))
POLICY = Policy(2)


def _repeat_words(words: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Per text: words covered by a 3-word window that occurs twice or more in it."""
    n = len(words)
    covered = np.zeros(n, dtype=bool)
    if n >= 3:
        row = row_of(first)
        with np.errstate(over="ignore"):
            key = mix64(words[:-2] + mix64(words[1:-1] * np.uint64(3) + mix64(words[2:] * np.uint64(5))))
            key = mix64(key + row[:-2].astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        at = np.flatnonzero(row[:-2] == row[2:])
        key = key[at]
        ranked = np.sort(key)
        twice = ranked[1:][ranked[1:] == ranked[:-1]]
        if len(twice):
            place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            at = at[twice[place] == key]
        else:
            at = at[:0]
        for d in range(3):
            covered[at + d] = True
    return per_text(covered, first)


def _lines(data: np.ndarray, offsets: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per text: lines that hold a word, and those equal to an earlier one.
    ``words``: where words start; none goes over a line's end."""
    start, end, first = find_words(data, offsets, _NO_LINE_END)  # non-empty lines
    if not len(start):
        z = np.zeros(len(offsets) - 1, np.int64)
        return z, z
    keep = np.append(words, len(data))[np.searchsorted(words, start)] < end
    row = row_of(first)
    lines = np.bincount(row[keep], minlength=len(offsets) - 1)
    h = word_hashes(data, start, end, seed=7)
    with np.errstate(over="ignore"):
        key = mix64(h + row.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))[keep]
    row = row[keep]
    order = np.argsort(key)
    dup = key[order[1:]] == key[order[:-1]]
    return lines, np.bincount(row[order[1:]][dup], minlength=len(offsets) - 1)


def measure(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """All measures of a block of texts."""
    start, end, first = find_words(data, offsets)
    words = word_hashes(data, start, end)

    def count(table: np.ndarray) -> np.ndarray:
        return np.diff(np.searchsorted(np.flatnonzero(mapped(data, table)), offsets))

    size = np.diff(offsets)
    lines, dup = _lines(data, offsets, start)
    return {
        "n_words": np.diff(first),
        # of what most bytes are, the others are counted
        "word_chars": size - count(~(WORD_BYTES & _STARTS)),
        "n_symbols": count(_SYMBOLS),
        "n_lines": lines,
        "n_dup_lines": dup,
        "n_repeat_words": _repeat_words(words, first),
        "n_letters": size - count(~(_LETTER & _STARTS)),
        "n_upper": count(_UPPER),
    }


def _measure_batches(batches: Iterator[pa.RecordBatch], text: int | None = None) -> Iterator[pa.RecordBatch]:
    """Batches with the measures of column ``text``; by default of the last
    column, which is left out."""
    for batch in batches:
        kept = batch.num_columns - (text is None)
        for i, j, data, offsets in blocks(batch.column(kept if text is None else text), BLOCK_BYTES):
            m = measure(data, offsets)
            cols = [batch.column(k).slice(i, j - i) for k in range(kept)]
            yield pa.RecordBatch.from_arrays(
                [*cols, *[pa.array(m[name].astype(np.int64)) for name in MEASURES]],
                names=[*batch.schema.names[:kept], *MEASURES],
            )


def failure_bits(rules: Sequence[Rule] = RULES) -> Column:
    return sum(
        (F.when(F.expr(r.fails), F.lit(1 << r.bit).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for r in rules),
        F.lit(0).cast("bigint"),
    )


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """``(id, measures..., failed_bits)``, one row per input row.  A map-only
    pass: nothing is shuffled, and memory is bounded by one block of texts."""
    cols = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("__text"))
    schema = f"`{id_col}` {cols.schema[0].dataType.simpleString()}, " + ", ".join(f"{m} bigint" for m in MEASURES)
    return cols.mapInArrow(_measure_batches, schema).withColumn("failed_bits", failure_bits(rules))


def verdict(policy: Policy = POLICY, rules: Sequence[Rule] = RULES, bits: str = "failed_bits") -> Column:
    """True where the policy keeps the document."""
    return F.col(bits).bitwiseAND(F.lit(policy.mask(rules)).cast("bigint")) == 0


def apply_policy(docs: DataFrame, policy: Policy = POLICY, text_col: str = "text", rules: Sequence[Rule] = RULES) -> DataFrame:
    """The rows of ``docs`` that the policy keeps, columns unchanged."""
    types = ", ".join(f"c{i} {f.dataType.simpleString()}" for i, f in enumerate(docs.schema))
    schema = types + ", " + ", ".join(f"{m} bigint" for m in MEASURES)
    plain = docs.toDF(*[f"c{i}" for i in range(len(docs.columns))])
    t = docs.columns.index(text_col)
    if docs.schema[t].dataType.simpleString() == "string":  # sent to Python once
        measured = plain.mapInArrow(lambda batches: _measure_batches(batches, t), schema)
    else:
        measured = plain.withColumn("__text", F.col(f"c{t}").cast("string")).mapInArrow(_measure_batches, schema)
    kept = measured.withColumn("failed_bits", failure_bits(rules)).where(verdict(policy, rules))
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(docs.columns)])


def ablation(led: DataFrame, policy: Policy = POLICY, rules: Sequence[Rule] = RULES) -> DataFrame:
    """Per rule of the policy: documents it rejects, documents only it
    rejects, and documents the policy would keep without it.  One partially
    aggregated pass over the bits."""
    mask = policy.mask(rules)
    hit = F.col("failed_bits").bitwiseAND(F.lit(mask).cast("bigint"))
    use = [r for r in rules if r.name in policy.rules]
    aggs = [F.count(F.lit(1)).alias("n"), F.sum((hit == 0).cast("bigint")).alias("kept")]
    for r in use:
        b = F.lit(1 << r.bit).cast("bigint")
        aggs += [F.sum((hit.bitwiseAND(b) != 0).cast("bigint")).alias(f"any_{r.bit}"), F.sum((hit == b).cast("bigint")).alias(f"only_{r.bit}")]
    one = led.agg(*aggs)
    rows = F.array(*[
        F.struct(F.lit(r.name).alias("rule"), F.lit(r.bit).alias("bit"), F.col(f"any_{r.bit}").alias("rejects"),
                 F.col(f"only_{r.bit}").alias("only_this"), (F.col("kept") + F.col(f"only_{r.bit}")).alias("kept_without"))
        for r in use
    ])
    return one.select("n", F.explode(rows).alias("r")).select("n", "r.*")
