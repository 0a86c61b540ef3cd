"""Word rows of the two corpora shaped for each store (E1-E6, J2-J4), with
the batch size each store profile uses.

``words`` is the output of ``read_wlc_words`` (corpus ``'wlc'``) or
``read_gnt_words`` (corpus ``'gnt'``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import tables
from ..functions.serialize import GNT_JSON_COLUMNS, WLC_JSON_COLUMNS, json_columns, record_json, sort_keys
from ..operators.entities import to_item, to_keyed, to_wide_entity
from ..sources.files import ManifestCheck

DEFAULT_TABLE = {"gnt": tables.DEFAULT_TAGGED_TABLE, "wlc": tables.DEFAULT_NESTED_TABLE}

WLC_JSON = ["codes", "language", "lemma", "coreid", "morphology", "id", "verse", "MorphologyString"]
GNT_JSON = ["verse", "id", "codes", "morphology", "text", "word", "normalized", "lemma"]


def _check(corpus: str) -> None:
    if corpus not in ("wlc", "gnt"):
        raise ValueError("corpus must be 'wlc' or 'gnt'")


def sorted_record(df: DataFrame, columns: list[str]) -> DataFrame:
    """Columns, and keys at every level below, in byte order of name."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.select(*[sort_keys(F.col(n), types[n]).alias(n) for n in sorted(columns, key=lambda n: n.encode("utf-8"))])


def jsonl_records(words: DataFrame, corpus: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Rows for the JSON Lines sink: the word record with sorted keys, empty
    Greek morphology attributes omitted, plus ``book`` for the folder and the
    columns of ``keep``."""
    _check(corpus)
    cols = WLC_JSON if corpus == "wlc" else GNT_JSON
    src = words
    if corpus == "gnt":
        m = F.col("morphology")
        src = words.withColumn("morphology", F.struct(*[F.nullif(m[n], F.lit("")).alias(n) for n in tables.GREEK_MORPHOLOGY_FIELDS]))
    book = ["book"] if "book" in words.columns else []
    out = sorted_record(src, cols + [c for c in (*book, *keep) if c not in cols])
    return out


def json_rows(words: DataFrame, corpus: str) -> DataFrame:
    """``(id, content)`` for the relational sink (E6): the record as JSON,
    fields in declared order, keys of maps inside sorted (J3)."""
    _check(corpus)
    cols = WLC_JSON if corpus == "wlc" else GNT_JSON
    omit = ("morphology",) if corpus == "gnt" else ()
    types = {f.name: f.dataType for f in words.schema.fields}
    src = words.select(*[sort_keys(F.col(c), types[c]).alias(c) if not isinstance(types[c], T.StructType) else F.col(c) for c in dict.fromkeys([*cols, "id"])])
    return src.select(F.col("id").alias("id"), record_json(src, cols, omit_empty=omit).alias("content"))


def json_view(rows: DataFrame, corpus: str) -> DataFrame:
    """The relational table with its computed text columns (J5): ``rows``
    ``(id, content)`` plus one column for each named path of the corpus."""
    _check(corpus)
    return json_columns(rows, "content", WLC_JSON_COLUMNS if corpus == "wlc" else GNT_JSON_COLUMNS)


def wide_entities(words: DataFrame, corpus: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Property-bag rows keyed by (verse, id text) (E1, E2).  The WLC bag
    drops ``language``; the GNT bag flattens the morphology (empty stays
    ``""``)."""
    _check(corpus)
    if corpus == "wlc":
        props = {"Lemma": "lemma", "CoreID": "coreid", "MorphCodes": "MorphologyString", "UniqueID": "verse", "Codes": "codes"}
    else:
        m = F.col("morphology")
        props = {name.capitalize(): F.coalesce(m[name], F.lit("")) for name in tables.GREEK_MORPHOLOGY_FIELDS}
        props.update({"Text": "text", "Word": "word", "Normalized": "normalized", "Lemma": "lemma", "Codes": "codes"})
    return to_wide_entity(words, "verse", "id", props, keep=keep)


def flat_entities(words: DataFrame, corpus: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Keyed entities named by the id text (E3, E4): WLC as a 7-field flat
    record with the morphology string; GNT as the word record itself."""
    _check(corpus)
    if corpus == "wlc":
        record = ["codes", "language", "lemma", "coreid", F.col("MorphologyString").alias("morphology"), "id", "verse"]
        return to_keyed(words, "id", record, keep=keep)
    return to_keyed(words, "id", GNT_JSON, keep=keep)


def items(words: DataFrame, corpus: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """Attribute-typed items with hash key ``verse`` and range key ``id``
    (E5)."""
    _check(corpus)
    cols = WLC_JSON if corpus == "wlc" else GNT_JSON
    return to_item(words.select(*keep, *[c for c in cols if c not in keep]), "verse", "id", keep=keep)


# Store -> (shape, kvbatch profile, key columns of the shaped row).
_KV_STORES = {
    "dynamo": ("items", "batch_retry", ("hash_key", "range_key")),
    "datastore": ("flat", "multi_put", ("key",)),
    "table": ("wide", "per_row", ("partition_key", "row_key")),
}


def shape(words: DataFrame, corpus: str, store: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """The word rows as the given store keeps them (``keep``: extra columns
    passed through for layout)."""
    if store == "jsonl":
        return jsonl_records(words, corpus)
    if store == "sql":
        return json_rows(words, corpus)
    if store not in _KV_STORES:
        raise ValueError(f"unknown store {store!r}")
    kind = _KV_STORES[store][0]
    return {"items": items, "flat": flat_entities, "wide": wide_entities}[kind](words, corpus, keep=keep)


def write_words(
    words: DataFrame,
    corpus: str,
    store: str,
    client: str | None = None,
    path: str | None = None,
    table: str | None = None,
    exact_batches_per_book: bool = True,
    options: dict[str, str] | None = None,
    writers: int | None = None,
    mode: str = "append",
    check: ManifestCheck | None = None,
    report: str | None = None,
) -> None:
    """Write corpus words to a store: shape (E*), keep the last row per key
    (K7), lay out batches that never span a book (B1) and write them.

    ``store``: ``'jsonl'`` (``path``), ``'dynamo'`` / ``'datastore'`` /
    ``'table'`` (``kvbatch`` with ``client='module:factory'`` and the
    store's batch size).  ``exact_batches_per_book``: each batch is exactly
    the book's words ``[i*n, (i+1)*n)`` in order, as the reference sends
    them; otherwise batches follow a range layout (cheaper, same rows).
    ``writers`` bounds how many tasks write to the store at once (merging
    partitions without a shuffle; a batch never straddles partitions), so
    a large cluster does not exceed the store's write capacity.
    Relational stores use ``sinks.write_jdbc_json(json_rows(...))``.

    ``mode`` of the JSON Lines store: ``'append'`` adds the rows again on a
    re-run, ``'overwrite'`` replaces the books that are written.  ``check``: a
    manifest check that watches ``words``, verified when the write has ended.
    ``report``: a shared folder for the progress of a key-value write, read by
    ``sinks.kvbatch.write_report``.
    """
    from ..operators.batching import exact_batches, latest_by_key, order_for_batches
    from ..sinks.jsonl import write_jsonl
    from ..sinks.kvbatch import register

    _check(corpus)
    table = table or DEFAULT_TABLE[corpus]
    order = ["ordinal"] if corpus == "wlc" else ["file", "block", "seq"]
    split = ["chapter"] if corpus == "wlc" else ["file", "block"]
    if store == "jsonl":
        if not path:
            raise ValueError("jsonl needs a path")
        records = jsonl_records(words, corpus, keep=tuple(order))
        write_jsonl(records, f"{path.rstrip('/')}/{table}", by="book", mode=mode, order=order)
        if check is not None:
            check.verify()
        return
    if store not in _KV_STORES:
        raise ValueError(f"unknown store {store!r}")
    if not client:
        raise ValueError(f"{store} needs client='module:factory'")
    _, profile, keys = _KV_STORES[store]
    size = STORE_BATCH[store]
    layout_in = tuple(dict.fromkeys(("book", *split, *order)))
    shaped = shape(words, corpus, store, keep=layout_in)
    payload = [c for c in shaped.columns if c not in layout_in]
    # last write wins per store key (a repeated id overwrites in the store)
    latest = latest_by_key(shaped, list(keys), order)
    if exact_batches_per_book:
        laid = exact_batches(latest, ["book"], order, size, chunk=F.struct(*split))
        layout = ["book", "batch_no"]
    else:
        laid = order_for_batches(latest, ["book"], order)
        layout = ["book"]
    out = laid.select(*layout, *payload)
    if writers:
        out = out.coalesce(writers)
    register(out.sparkSession)
    writer = (
        out.write.format("kvbatch").mode("append")
        .option("table", table).option("client", client).option("profile", profile)
        .option("batch_size", str(size)).option("group_by", ",".join(layout)).option("exclude", ",".join(layout))
    )
    if profile != "batch_retry":
        writer = writer.option("key", ",".join(keys))
    for k, v in (({"report": report} if report else {}) | (options or {})).items():
        writer = writer.option(k, v)
    writer.save()
    if check is not None:
        check.verify()


STORE_BATCH = {
    "jsonl": tables.BATCH_SIZE["jsonl"],
    "dynamo": tables.BATCH_SIZE["dynamo"],
    "datastore": tables.BATCH_SIZE["datastore"],
    "table": tables.BATCH_SIZE["table"],
    "sql": tables.BATCH_SIZE["sql"],
}
