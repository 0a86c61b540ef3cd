"""Store-shaped projections (E1-E6): wide property bags, flattened
structs, flat keyed entities, attribute-typed items and JSON rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import col
from ..functions.serialize import record_json


def to_wide_entity(
    df: DataFrame,
    partition_key: str | Column,
    row_key: str | Column,
    properties: Mapping[str, str | Column],
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(partition_key, row_key, properties map<string,string>)``.
    ``keep``: columns passed through unchanged (e.g. for batch layout)."""
    bag: list[Column] = []
    for name, c in properties.items():
        bag += [F.lit(name), col(c).cast("string")]
    return df.select(
        *keep,
        col(partition_key).cast("string").alias("partition_key"),
        col(row_key).cast("string").alias("row_key"),
        F.create_map(*bag).alias("properties"),
    )


def flatten_struct(df: DataFrame, struct_col: str, rename: Mapping[str, str] | None = None, empty_as: str | None = "") -> DataFrame:
    """Lift the fields of a struct column to top-level columns.
    ``empty_as``: value written for null fields (``""`` keeps every
    property present, as a property-bag store does)."""
    rename = rename or {}
    st = df.schema[struct_col].dataType
    if not isinstance(st, T.StructType):
        raise TypeError(f"{struct_col} is not a struct")
    lifted = []
    for f in st.fields:
        c = F.col(struct_col)[f.name]
        if empty_as is not None:
            c = F.coalesce(c, F.lit(empty_as))
        lifted.append(c.alias(rename.get(f.name, f.name)))
    return df.select(*[c for c in df.columns if c != struct_col], *lifted)


def to_keyed(df: DataFrame, key: str | Column, record: Sequence[str | Column] | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(key string, record struct)``: a keyed entity whose name is the id
    text (E3/E4)."""
    record = list(record or df.columns)
    return df.select(*keep, col(key).cast("string").alias("key"), F.struct(*record).alias("record"))


def _attribute(c: Column, dtype: T.DataType) -> Column:
    """``struct<type, value>`` of one attribute."""
    if isinstance(dtype, T.NumericType):
        kind, text = "N", c.cast("string")
    elif isinstance(dtype, T.BooleanType):
        kind, text = "BOOL", c.cast("string")
    elif isinstance(dtype, T.ArrayType):
        kind, text = "L", F.to_json(F.transform(c, lambda x: _typed(x, dtype.elementType)))
    elif isinstance(dtype, (T.StructType, T.MapType)):
        kind, text = "M", F.to_json(_typed(c, dtype)["M"])
    else:
        kind, text = "S", c.cast("string")
    return F.struct(F.when(c.isNull(), F.lit("NULL")).otherwise(F.lit(kind)).alias("type"), F.when(c.isNotNull(), text).alias("value"))


def _typed(c: Column, dtype: T.DataType) -> Column:
    """A nested value as a store types it: an object whose one key is the
    type.  A null element keeps its place as an object without a value."""
    if isinstance(dtype, T.NumericType):
        return F.struct(c.cast("string").alias("N"))
    if isinstance(dtype, T.BooleanType):
        return F.struct(c.alias("BOOL"))
    if isinstance(dtype, T.ArrayType):
        return F.struct(F.transform(c, lambda x: _typed(x, dtype.elementType)).alias("L"))
    if isinstance(dtype, T.MapType):
        return F.struct(F.transform_values(c, lambda k, v: _typed(v, dtype.valueType)).alias("M"))
    if isinstance(dtype, T.StructType):
        return F.struct(F.when(c.isNotNull(), F.struct(*[_typed(c[f.name], f.dataType).alias(f.name) for f in dtype.fields])).alias("M"))
    return F.struct(c.cast("string").alias("S"))


def to_item(df: DataFrame, hash_key: str, range_key: str | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """``(hash_key, range_key, attributes map<string, struct<type,value>>)``
    (E5): every column as a typed attribute: ``N`` number, ``S`` string,
    ``BOOL``, ``NULL`` (no value), ``L`` list and ``M`` record, the last two as
    JSON text of typed members."""
    attrs: list[Column] = []
    for f in df.schema.fields:
        if f.name not in keep:
            attrs += [F.lit(f.name), _attribute(F.col(f.name), f.dataType)]
    return df.select(
        *keep,
        F.col(hash_key).cast("string").alias("hash_key"),
        (F.col(range_key).cast("string") if range_key else F.lit(None).cast("string")).alias("range_key"),
        F.create_map(*attrs).alias("attributes"),
    )


def to_json_row(df: DataFrame, id_col: str, columns: Sequence[str] | Mapping[str, str | Column] | None = None, key_order: str = "declared") -> DataFrame:
    """``(id bigint, content string)``: the record as JSON text."""
    return df.select(
        F.col(id_col).cast("bigint").alias("id"),
        record_json(df, columns, key_order=key_order).alias("content"),
    )


def to_flat_entity(
    df: DataFrame,
    key: str | Column,
    columns: Sequence[str] | Mapping[str, str | Column],
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(key string, <flat columns>)``: a flat entity named by the key text
    (E3); nested values must already be flattened or serialised."""
    items = list(columns.items()) if isinstance(columns, Mapping) else [(c, c) for c in columns]
    return df.select(*keep, col(key).cast("string").alias("key"), *[col(c).alias(n) for n, c in items])


def project_fields(df: DataFrame, fields: str | Column, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Fields of an array column by position (P1): ``names[i]`` gets
    element ``i``; a missing element is null."""
    arr = col(fields)
    return df.select(*keep, *[F.get(arr, i).alias(n) for i, n in enumerate(names)])
