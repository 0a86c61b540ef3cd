"""Sentence-rule recognition of licence texts: normalised sentences are mapped
to known licence-sentence identifiers, and the identifier sequence of a
document is matched against ordered licence rules.  DataFrame functions only.

A known sentence may be wrapped over lines, with comment marks before each: a
match runs over any whole lines up to a blank line or a sentence end, the
longest known sentence first.

Edge cases: null and empty texts have no sentences and no licence; a null id
stays null; every input row gives one output row, equal rows equal ones; extra
columns are ignored; an empty table gives no rows; rules are tried in their order,
so the first that matches is the document's licence."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._licence_rules import RULES, SENTENCES

_SENTENCE_END = r"[.!?;]+([ \t\n\r\"')]|\z)"
_NO_WORD = r"[^\p{L}\p{N}\n]+"
# comment marks that would end a sentence at the start of a line
_MARKS = r"(?m)^[ \t]*[;!]+(?=[ \t\r\n]|\z)"


def sentences(text: Column) -> Column:
    """Sentences of a text in order, as lower-case words and numbers with one
    space between.  A sentence ends at ``. ! ? ;`` before white space, a quote
    or the end, and at a line end; those without a word go."""
    lines = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _SENTENCE_END, "\n")
    words = F.regexp_replace(lines, _NO_WORD, " ")
    return F.filter(F.transform(F.split(words, "\n"), lambda s: F.trim(s)), lambda s: s != "")


def wrapped(text: Column) -> Column:
    """A text as lower-case words and numbers: a space inside a line, a line
    end between lines, two and more at sentence ends and blank lines."""
    marked = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _MARKS, "")
    ends = F.regexp_replace(marked, _SENTENCE_END, "\n\n")
    return F.regexp_replace(F.regexp_replace(ends, _NO_WORD, " "), " ?\n ?", "\n")


def _any_of(names: Sequence[str]) -> str:
    """A pattern of whole lines that are one of the known sentences, the longest
    that fits first.  Its words may be a line end apart, never two."""
    longest = sorted(names, key=lambda t: (-len(t), t))
    return r"(?m)^ ?(" + "|".join(t.replace(" ", "[ \n]") for t in longest) + r") ?$"


def _contains_in_order(ids: Column, rule: Sequence[str]) -> Column:
    """True when the rule's identifiers appear in ``ids`` in this order, other
    known sentences allowed in between: the state is how many have matched."""
    want = F.array(*[F.lit(x) for x in rule])
    state = F.aggregate(
        ids, F.lit(1), lambda n, x: F.when((n <= len(rule)) & (F.get(want, n - 1) == x), n + 1).otherwise(n)
    )
    return state > len(rule)


def license_scan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    known: dict[str, str] = SENTENCES,
    rules: Sequence[tuple[str, tuple[str, ...]]] = RULES,
) -> DataFrame:
    """``(id, n_sentences, n_known, sentence_ids, licenses, license)``: the
    known-sentence identifiers in text order, every licence whose rule matches
    (in rule order, once), and the first of them (null: none).

    Everything is one projection over a row: no shuffle, no explode, so a very
    long text costs its own task only."""
    names = sorted(known)
    texts = F.array(*[F.lit(t) for t in names])
    ids = F.array(*[F.lit(known[t]) for t in names])
    text = F.col(text_col).cast("string")
    met = F.regexp_extract_all(wrapped(text), F.lit(_any_of(names)), F.lit(1)) if names else F.array().cast("array<string>")
    d = docs.select(F.col(id_col).alias("__id"), sentences(text).alias("__s"), F.transform(met, lambda s: F.translate(s, "\n", " ")).alias("__k"))
    d = d.withColumn("sentence_ids", F.transform(F.col("__k"), lambda s: F.get(ids, (F.array_position(texts, s) - 1).cast("int"))))
    found = F.array_distinct(
        F.array_compact(F.array(*[F.when(_contains_in_order(F.col("sentence_ids"), seq), F.lit(name)) for name, seq in rules]))
    )
    d = d.withColumn("licenses", found)
    return d.select(
        F.col("__id").alias(id_col),
        F.size("__s").cast("bigint").alias("n_sentences"),
        F.size("sentence_ids").cast("bigint").alias("n_known"),
        "sentence_ids",
        "licenses",
        F.get("licenses", F.lit(0)).alias("license"),
    )
