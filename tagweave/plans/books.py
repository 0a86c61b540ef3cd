"""Nested books as lines of text files: one ``{"book_key", "book"}`` object a
line, which ``read_nested_books`` reads back (layout ``lines``)."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.explode import _literal, _slices

# What a JSON string may not hold as it is; the backslash is first, as the
# others bring their own.
_ESCAPES = {"\\": "\\\\", '"': '\\"', "\b": "\\b", "\t": "\\t", "\n": "\\n", "\f": "\\f", "\r": "\\r"}
_ESCAPES |= {chr(i): f"\\u{i:04X}" for i in range(32) if chr(i) not in _ESCAPES}


def _present(strings: pa.Array, sought: Iterable[str]) -> list[str]:
    """Those of the ``sought`` ASCII characters that are in any string."""
    whole = pc.binary_join(pa.ListArray.from_arrays([0, len(strings)], pc.fill_null(strings, "")), "")[0].as_buffer()
    seen = np.zeros(256, bool)
    seen[np.frombuffer(whole, np.uint8)] = True
    return [c for c in sought if seen[ord(c)]]


def _escaped(strings: pa.Array, special: Iterable[str]) -> pa.Array:
    for c in special:
        strings = pc.replace_substring(strings, c, _ESCAPES[c])
    return strings


def _quoted(strings: pa.Array) -> pa.Array:
    """JSON strings; null is the word ``null``."""
    return pc.fill_null(pc.binary_join_element_wise('"', _escaped(strings, _present(strings, _ESCAPES)), '"', ""), "null")


def _arrays(items: pa.Array, counts: np.ndarray) -> pa.Array:
    """JSON arrays of ``counts`` items each."""
    offsets = pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32))
    return pc.binary_join_element_wise("[", pc.binary_join(pa.ListArray.from_arrays(offsets, items), ","), "]", "")


def book_lines(
    df: DataFrame, key: Column, text: Column, separators: Sequence[str], second: Column, third: Column, tags: Sequence[str] = ()
) -> DataFrame:
    """``(value)``: a nested book for each row of ``df``.  ``text`` is split by
    one plain separator a level, a word is ``[token, second, third]``.  With
    ``tags``, ``third`` is a number: a word has the tag at this number plus the
    token's length, modulo the number of tags.  A null key or text leaves its
    field out.  Lines are put together as Arrow columns, with no object for a
    word."""
    literals = [_literal(s) for s in separators]
    if not all(literals):
        raise ValueError("separators must be plain texts")
    tag_ends = pc.binary_join_element_wise(_quoted(pa.array([*tags, None], pa.string())), "]", "")
    escapes = [c for c in _ESCAPES if c not in literals]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in (part for batch in batches for part in _slices(batch)):
            keys, seconds, thirds, texts = part.columns
            tokens, counts, first = texts, [], np.arange(part.num_rows)
            for literal in literals:
                pieces = pc.split_pattern(tokens, literal)
                n = pc.fill_null(pc.list_value_length(pieces), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                tokens, first = pieces.flatten(), np.repeat(first, n)
                counts.append(n)
            row = pa.array(first)  # the row that a token comes from
            seconds = pc.binary_join_element_wise('",', _quoted(seconds), ",", "")
            if tags:
                number = pc.add_checked(thirds.take(row), pc.utf8_length(tokens).cast(pa.int64()))
                at = pc.fill_null(number, 0).to_numpy(zero_copy_only=False) % len(tags)
                last = tag_ends.take(pa.array(np.where(pc.is_null(number).to_numpy(zero_copy_only=False), len(tags), at)))
            else:
                last = pc.binary_join_element_wise(_quoted(thirds), "]", "").take(row)
            tokens = _escaped(tokens, _present(texts, escapes))
            content = pc.binary_join_element_wise('["', tokens, seconds.take(row), last, "")
            for n in reversed(counts):
                content = _arrays(content, n)
            has_key, has_text = pc.is_valid(keys), pc.is_valid(texts)
            fields = [
                pc.if_else(has_key, pc.binary_join_element_wise('"book_key":', _quoted(keys), ""), None),
                pc.if_else(has_text, pc.binary_join_element_wise('"book":', content, ""), None),
            ]
            inside = pc.binary_join_element_wise(*fields, ",", null_handling="skip")
            yield pa.RecordBatch.from_arrays([pc.binary_join_element_wise("{", inside, "}", "")], names=["value"])

    third = third.cast("bigint") if tags else F.make_valid_utf8(third)
    columns = [F.make_valid_utf8(key), F.make_valid_utf8(second), third, F.make_valid_utf8(text)]
    return df.select(*[c.alias(f"c{i}") for i, c in enumerate(columns)]).mapInArrow(lines, "value string")


PART_BYTES = 1 << 24  # of text that a task writes of a large book
_FILE_LINES = 1 << 17  # of JSON in a file
_OPEN, _CHAPTER, _CLOSE = range(3)


def write_books(df: DataFrame, book: Column, order: Column, text: Column, separators: Sequence[str], second: Column, third: str, path: str) -> None:
    """Few large nested books: the files of a folder ``path/book=<n>``, in order
    of their names, are one JSON text, compressed.  Its chapters are null and then
    the rows of ``df`` by ``order``, each text split by two plain separators, a
    word being ``[token, second, third]``; a null text gives no chapter.

    Texts are dealt by ranges of ``(book, order)`` and made JSON after that, so
    a book is written by as many tasks as it needs and only its text is shuffled.  A
    line is a verse, and a file ends after any line, in the middle of a chapter
    too."""
    literals = [_literal(s) for s in separators]
    if len(literals) != 2 or not all(literals):
        raise ValueError("separators must be two plain texts")
    last = _quoted(pa.array([third]))[0].as_py() + "]"
    escapes = [c for c in _ESCAPES if c not in literals]

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        done = 0
        for part in (part for batch in batches for part in _slices(batch)):
            books, kinds, seconds, texts = part.columns
            verses = pc.split_pattern(texts, literals[0])
            n_verses = pc.fill_null(pc.list_value_length(verses), 0).to_numpy(zero_copy_only=False).astype(np.int64)
            words = pc.split_pattern(verses.flatten(), literals[1])
            n_words = words.value_lengths().to_numpy().astype(np.int64)
            row = np.repeat(np.arange(part.num_rows), n_verses)
            tokens = _escaped(words.flatten(), _present(texts, escapes))
            ends = pc.binary_join_element_wise('",', _quoted(seconds), ",", last, "")
            content = _arrays(pc.binary_join_element_wise('["', tokens, ends.take(pa.array(np.repeat(row, n_words))), ""), n_words)
            first, final = np.ones(len(row), bool), np.ones(len(row), bool)
            first[1:] = final[:-1] = row[1:] != row[:-1]
            value = pc.binary_join_element_wise(pc.if_else(pa.array(first), ",\n [", ","), content, pc.if_else(pa.array(final), "]", ""), "")
            kind = kinds.to_numpy()
            edge = np.flatnonzero(kind != _CHAPTER)
            if len(edge):
                row = np.concatenate([row, edge])
                order = np.argsort(row, kind="stable")
                value = pa.concat_arrays([value, pa.array(["[ null" if k == _OPEN else "]" for k in kind[edge]], pa.string())]).take(pa.array(order))
                row = row[order]
            out = pa.RecordBatch.from_arrays([books.take(pa.array(row)), pa.array(np.arange(done, done + len(row))), value], names=["book", "line", "value"])
            done += len(row)
            for a in range(0, len(row), 1 << 13):
                yield out.slice(a, 1 << 13)

    rows = df.select(
        book.cast("bigint").alias("book"), F.lit(_CHAPTER).alias("kind"), order.alias("order"),
        F.make_valid_utf8(second).alias("second"), F.make_valid_utf8(text).alias("text"),
    )
    size = rows.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    edges = rows.select("book").distinct().select("book", F.explode(F.array(F.lit(_OPEN), F.lit(_CLOSE))).alias("kind"))
    whole = rows.unionByName(edges, allowMissingColumns=True)
    keys = ["book", "kind", "order"]
    dealt = whole.repartitionByRange(max(1, -(-size // PART_BYTES)), *keys).sortWithinPartitions(*keys).select("book", "kind", "second", "text")
    made = dealt.mapInArrow(lines, "book bigint, line bigint, value string").sortWithinPartitions("book", "line").select("book", "value")
    made.write.partitionBy("book").option("compression", "snappy").option("maxRecordsPerFile", _FILE_LINES).text(path)
