"""Tree-shaped tag decode (G2, D2) as Spark SQL functions.

A tag is ``<language letter><segment>[/<segment>...]``.  Each segment starts
with a part-of-speech letter; every following letter fills the next
attribute of that part's *path* (see ``tables.TREE_PATHS``).  The grammar
is finite, so the whole decode is literal path tables plus
``transform``/``filter`` lambdas — no Python in the data path.

The decoder is generated as one SQL expression from the path tables and
handed to Spark in a single call (``F.expr``), instead of being assembled
from hundreds of JVM calls per query.  For a named column it is inlined;
for any other Column it goes through a SQL temporary function
(``tagweave_decode_tree`` ...), which the analyzer inlines as well and
which ``register_sql_functions`` also makes available to ``spark.sql``.

Output per tag: ``array<map<string,string>>``, one map per segment, keys in
path order with ``Part`` first.  Rules kept from the corpus convention:

* a letter missing from the slot's lookup gives the key with value ``""``;
* a slot without a lookup (conjunction, adverb) gives ``""``;
* a pronoun whose type letter is not ``x`` skips the next letter and reads
  gender, number, state (its person is lost) unless ``pronoun_person``;
* a tag with fewer letters than the path simply stops.

Errors (empty tag, empty segment, unknown part, verb under an unknown
language, more letters than the path) fail the job with ``on_error='fail'``
or give null with ``on_error='null'``; ``tree_error`` returns the reason.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from . import tables
from ._util import col, sql_string

FUNCTION_PREFIX = "tagweave_"
_SEGMENTS_TYPE = "ARRAY<MAP<STRING, STRING>>"
_QUOTE = "chr(39)"  # a single quote, without depending on literal escaping


def _slot_sql(name: str, lut: str | None) -> str:
    """A path slot: attribute name, the lookup's one-letter codes as one
    string and its labels in the same order (``instr`` + index lookup)."""
    table = tables.TREE_LOOKUPS[lut] if lut else {}
    if any(len(k) != 1 for k in table):
        raise ValueError(f"lookup {lut} must have one-letter codes")
    if table:
        labels = "array(" + ", ".join(sql_string(v) for v in table.values()) + ")"
    else:
        labels = "cast(array() as array<string>)"
    return f"named_struct('name', {sql_string(name)}, 'codes', {sql_string(''.join(table))}, 'labels', {labels})"


def _map_sql(mapping: dict[str, str]) -> str:
    return "map(" + ", ".join(f"{sql_string(k)}, {sql_string(v)}" for k, v in mapping.items()) + ")"


def _paths_sql() -> str:
    entries = [
        f"{sql_string(key)}, array({', '.join(_slot_sql(name, lut) for name, lut in path)})"
        for key, path in tables.TREE_PATHS.items()
    ]
    return "map(" + ", ".join(entries) + ")"


def _in_list(values) -> str:
    return ", ".join(sql_string(v) for v in values)


def _segments_sql(pronoun_person: bool, tag: str = "tag") -> str:
    """SQL over the tag expression ``tag``: ``array<struct<err, m>>`` — per
    segment the error reason, or its attribute map (keys in path order)."""
    parts = dict(tables.PART_LABEL)
    parts.update({f"V{lang}": lab for lang, lab in tables.VERB_LABEL.items()})
    x = sql_string(tables.PRONOUN_DECIDER_LETTER)
    if pronoun_person:
        pronoun = f"CASE WHEN get(tw_s.letters, 1) = {x} THEN 'P_person_x' ELSE 'P_person' END"
    else:
        pronoun = f"CASE WHEN get(tw_s.letters, 0) = {x} THEN 'P_x' ELSE 'P' END"
    key = (
        f"CASE WHEN tw_s.pos = 'V' THEN concat('V', substring({tag}, 1, 1), "
        f"CASE WHEN get(tw_s.letters, 1) IN ({_in_list(tables.PARTICIPLE_LETTERS)}) THEN '_participle' ELSE '' END) "
        f"WHEN tw_s.pos = 'P' THEN {pronoun} "
        f"WHEN tw_s.pos IN ({_in_list(tables.PART_LABEL)}) THEN tw_s.pos END"
    )
    split_letters = (
        f"transform(split(substring({tag}, 2), '/', -1), tw_g -> named_struct("
        "'pos', substring(tw_g, 1, 1), "
        "'letters', CASE WHEN length(tw_g) <= 1 THEN cast(array() as array<string>) ELSE split(substring(tw_g, 2), '', -1) END))"
    )
    keyed = (
        f"transform({split_letters}, tw_s -> named_struct("
        "'pos', tw_s.pos, 'letters', tw_s.letters, "
        f"'part_key', CASE WHEN tw_s.pos = 'V' THEN concat('V', substring({tag}, 1, 1)) ELSE tw_s.pos END, "
        f"'path', {_paths_sql()}[{key}]))"
    )
    err = (
        "CASE WHEN length(tw_p.pos) = 0 THEN 'empty segment' "
        "WHEN tw_p.path IS NULL THEN concat('unknown part of speech ', tw_p.part_key) "
        "WHEN size(tw_p.letters) > size(tw_p.path) THEN 'more letters than the path' END"
    )
    entry = (
        "named_struct('key', get(tw_p.path, tw_i).name, 'value', "
        "coalesce(get(get(tw_p.path, tw_i).labels, instr(get(tw_p.path, tw_i).codes, tw_l) - 1), ''))"
    )
    attrs = f"filter(transform(tw_p.letters, (tw_l, tw_i) -> {entry}), tw_e -> tw_e.key != {sql_string(tables.SKIP)})"
    head = f"array(named_struct('key', 'Part', 'value', {_map_sql(parts)}[tw_p.part_key]))"
    seg_map = f"map_from_entries(concat({head}, {attrs}))"
    return f"transform({keyed}, tw_p -> named_struct('err', {err}, 'm', CASE WHEN ({err}) IS NULL THEN {seg_map} END))"


def _first_error_sql(segs: str, tag: str = "tag") -> str:
    return (
        f"CASE WHEN {tag} IS NULL THEN CAST(NULL AS STRING) WHEN length({tag}) < 2 THEN 'empty tag' "
        f"ELSE get(filter({segs}, tw_z -> tw_z.err IS NOT NULL), 0).err END"
    )


@functools.lru_cache(maxsize=256)
def _function_bodies(pronoun_person: bool, tag: str = "tag") -> dict[str, tuple[str, str]]:
    """name -> (return type, SQL over the tag expression ``tag``).  The
    segments are computed once and bound to ``tw_segs`` by a one-element
    ``transform``."""
    segs = _segments_sql(pronoun_person, tag)
    err = _first_error_sql("tw_segs", tag)
    message = f"concat('invalid tag ', {_QUOTE}, {tag}, {_QUOTE}, ': ', {err})"
    fail = (
        f"transform(array({segs}), tw_segs -> CASE "
        f"WHEN ({err}) IS NOT NULL THEN cast(raise_error({message}) AS {_SEGMENTS_TYPE}) "
        f"WHEN {tag} IS NOT NULL THEN transform(tw_segs, tw_y -> tw_y.m) END)[0]"
    )
    null = f"transform(array({segs}), tw_segs -> CASE WHEN ({err}) IS NULL AND {tag} IS NOT NULL THEN transform(tw_segs, tw_y -> tw_y.m) END)[0]"
    reason = f"transform(array({segs}), tw_segs -> {err})[0]"
    return {"decode_tree": (_SEGMENTS_TYPE, fail), "decode_tree_or_null": (_SEGMENTS_TYPE, null), "tree_error": ("STRING", reason)}


_REGISTERED: set[tuple[int, str]] = set()


def register_sql_functions(spark: SparkSession | None = None, names: list[str] | None = None) -> list[str]:
    """Define the tree decoders as SQL temporary functions in ``spark``:
    ``tagweave_decode_tree``, ``tagweave_decode_tree_or_null``,
    ``tagweave_tree_error`` and their ``_pp`` forms (pronoun person read),
    for use from ``spark.sql``.  ``names``: only these.  Returns the names."""
    spark = spark or SparkSession.active()
    done = []
    for pp, suffix in ((False, ""), (True, "_pp")):
        for base, (rtype, body) in _function_bodies(pp).items():
            name = f"{FUNCTION_PREFIX}{base}{suffix}"
            if names is not None and name not in names:
                continue
            spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}(tag STRING) RETURNS {rtype} RETURN {body}")
            _REGISTERED.add((id(spark), name))
            done.append(name)
    return done


def _ident(name: str) -> str:
    """A column name (``a`` or ``a.b``) as a quoted SQL identifier."""
    return ".".join("`" + part.replace("`", "``") + "`" for part in name.split("."))


def _call(base: str, tag: str | Column, pronoun_person: bool) -> Column:
    if isinstance(tag, str):
        # a named column: inline the generated SQL (one JVM call, no limits)
        return F.expr(_function_bodies(pronoun_person, f"CAST({_ident(tag)} AS STRING)")[base][1])
    # any other Column: through the session's SQL function (not usable
    # directly inside a generator — materialise it in a select first)
    spark = SparkSession.active()
    name = f"{FUNCTION_PREFIX}{base}{'_pp' if pronoun_person else ''}"
    if (id(spark), name) not in _REGISTERED or not spark.catalog.functionExists(name):
        register_sql_functions(spark, [name])
    return F.call_function(name, tag.cast("string"))


def split_tag(tag: str | Column) -> Column:
    """Segments of a tag after its language letter, order kept."""
    return F.split(F.substr(col(tag), F.lit(2)), "/", -1)


def tree_error(tag: str | Column, pronoun_person: bool = False) -> Column:
    """Reason a tag cannot be decoded, or null when it decodes."""
    return _call("tree_error", tag, pronoun_person)


def decode_tree(tag: str | Column, pronoun_person: bool = False, on_error: str = "fail") -> Column:
    """Decode a tree-shaped tag to ``array<map<string,string>>``."""
    if on_error == "fail":
        return _call("decode_tree", tag, pronoun_person)
    if on_error == "null":
        return _call("decode_tree_or_null", tag, pronoun_person)
    raise ValueError("on_error must be 'fail' or 'null'")
