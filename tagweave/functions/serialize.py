"""Serialisation and JSON scalars."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ._util import col


def tag_string(morphology: str | Column) -> Column:
    """``k=v`` joined by ``,`` inside a segment and ``|`` between segments,
    keys in path order (J1).  The order is fixed, unlike a hash map's."""
    return F.array_join(
        F.transform(
            col(morphology),
            lambda m: F.array_join(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), e["value"])), ","),
        ),
        "|",
    )


def sort_keys(c: Column, dtype: T.DataType) -> Column:
    """``c`` with the fields of structs and the entries of maps in byte order
    of name, at every level, inside arrays as well — the key order of a
    generic-map JSON encoder (upper case first) (J3)."""
    if isinstance(dtype, T.StructType):
        fields = sorted(dtype.fields, key=lambda f: f.name.encode("utf-8"))
        built = F.struct(*[sort_keys(c[f.name], f.dataType).alias(f.name) for f in fields])
        return F.when(c.isNotNull(), built)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: sort_keys(x, dtype.elementType)) if _has_keys(dtype.elementType) else c
    if isinstance(dtype, T.MapType):
        # strings compare by their bytes, so entries sorted as (key, value) are in byte order of key
        if isinstance(dtype.valueType, T.AtomicType):
            return F.map_from_entries(F.array_sort(F.map_entries(c)))
        keys = F.array_sort(F.map_keys(c))
        return F.map_from_arrays(keys, F.transform(keys, lambda k: sort_keys(F.try_element_at(c, k), dtype.valueType)))
    return c


def _has_keys(dtype: T.DataType) -> bool:
    if isinstance(dtype, T.ArrayType):
        return _has_keys(dtype.elementType)
    return isinstance(dtype, (T.StructType, T.MapType))


def _omit_empty(c: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.StructType):
        return F.struct(*[_omit_empty(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])
    if isinstance(dtype, T.StringType):
        return F.nullif(c, F.lit(""))
    return c


def record_json(
    df: DataFrame,
    columns: Iterable[str] | Mapping[str, str | Column] | None = None,
    key_order: str = "declared",
    omit_empty: Iterable[str] = (),
) -> Column:
    """``to_json`` of one object per row.

    ``columns``: names, or ``{json_key: column}``; default all columns.
    ``key_order``: ``'declared'`` keeps the given order; ``'sorted'`` sorts
    keys byte-wise at every level (upper case first), as a generic map
    encoder does.  ``omit_empty``: keys whose empty strings (recursively,
    for structs) are dropped from the object.  Nulls are always dropped.
    """
    if columns is None:
        columns = df.columns
    items = list(columns.items()) if isinstance(columns, Mapping) else [(c, c) for c in columns]
    probe = df.select(*[col(c).alias(k) for k, c in items])
    types = {f.name: f.dataType for f in probe.schema.fields}
    omit = set(omit_empty)
    built: list[tuple[str, Column]] = []
    for k, c in items:
        value = col(c)
        if k in omit:
            value = _omit_empty(value, types[k])
        if key_order == "sorted":
            value = sort_keys(value, types[k])
        built.append((k, value.alias(k)))
    if key_order == "sorted":
        built.sort(key=lambda kv: kv[0].encode("utf-8"))
    elif key_order != "declared":
        raise ValueError("key_order must be 'declared' or 'sorted'")
    return F.to_json(F.struct(*[c for _, c in built]))


def json_columns(df: DataFrame, source: str | Column, paths: Mapping[str, str], max_len: int = 200) -> DataFrame:
    """Computed text columns from a JSON document column (J5): the scalar at
    each JSON path as text, cut to ``max_len`` characters; a missing value, an
    object or an array gives null, as a relational ``JSON_VALUE`` does.  The
    document is parsed once, whatever the number of paths."""
    base = df.select("*", F.try_parse_json(col(source)).alias("__doc"))

    def value(path: str) -> Column:
        v = F.try_variant_get("__doc", path, "variant")
        scalar = ~F.schema_of_variant(v).rlike("^(OBJECT|ARRAY)")
        return F.when(scalar, F.substring(F.try_variant_get("__doc", path, "string"), 1, max_len))

    return base.select(*df.columns, *[value(p).alias(name) for name, p in paths.items()])


# FIXED VALUES: the text columns that the relational tables compute from their documents.
GNT_JSON_COLUMNS = {
    "WordID": "$.id", "VerseID": "$.verse", "Text": "$.text", "mssqlWord": "$.word", "Normalized": "$.normalized",
    "Lemma": "$.lemma", "Codes": "$.codes",
}
WLC_JSON_COLUMNS = {
    "WordID": "$.id", "Verse": "$.verse", "CoreID": "$.coreid", "Language": "$.language", "Lemma": "$.lemma", "Codes": "$.codes",
}


def is_json(c: str | Column, kind: str = "any") -> Column:
    """Strict JSON validity (J6): exactly one JSON value, nothing trailing.

    ``try_parse_json`` alone accepts trailing text, so the document is parsed
    as the value of an object member, where a second value cannot follow, and
    counted as the single element of an array, where a further member cannot.
    A document with a repeated object key is not valid here, though a
    relational ``ISJSON`` accepts it.  ``kind='container'`` accepts only
    objects and arrays."""
    v = col(c)
    as_member = F.concat(F.lit('{"a":'), v, F.lit("}"))
    valid = F.try_parse_json(as_member).isNotNull() & (F.json_array_length(F.concat(F.lit("["), v, F.lit("]"))) == 1)
    if kind == "container":
        valid = valid & F.ltrim(v).substr(1, 1).isin("{", "[")
    elif kind != "any":
        raise ValueError("kind must be 'any' or 'container'")
    return F.when(v.isNull(), F.lit(None).cast("boolean")).otherwise(F.coalesce(valid, F.lit(False)))
