"""Nested explode with 1-based coordinates (G1) and book-global ordinals (O1)."""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions._util import col
from .sequence import _join_back


def _coordinate_tree(c: Column, names: Sequence[str], depth: int, acc: list[tuple[str, Column]]) -> Column:
    """Turn ``array^(depth+1)<T>`` into ``array^(depth+1)<struct<coords..., pos, value>>``
    and flatten it to one level."""
    if depth == 0:
        return F.transform(
            c,
            lambda w, wi: F.struct(*[v.alias(n) for n, v in acc], (wi + 1).alias(names[-1]), w.alias("value")),
        )
    inner = F.transform(c, lambda x, xi: _coordinate_tree(x, names, depth - 1, acc + [(names[len(acc)], xi + 1)]))
    # an element that is null has its number and no content
    return F.flatten(F.filter(inner, lambda x: x.isNotNull()))


def explode_nested(
    df: DataFrame,
    column: str | Column,
    coords: Sequence[str] = ("chapter", "verse"),
    position: str = "word",
    ordinal: str | None = "ordinal",
    value: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per innermost element of a nested array column.

    ``column`` has ``len(coords) + 1`` array levels.  Every output row gets
    the 1-based index at each level (``coords`` and ``position``), the
    element (``value``) and, when ``ordinal`` is set, a 1-based running
    number over the whole row's content that never resets at a level
    boundary.  Map-only: no shuffle, no window; the ordinal comes from
    ``posexplode`` of the flattened array.  Without it the innermost arrays
    are exploded as they are, which builds no struct for an element.
    """
    names = list(coords) + [position]
    keep = [c for c in (keep if keep is not None else df.columns) if c != (column if isinstance(column, str) else None)]
    if coords and not ordinal:
        inner = df.select(*keep, F.explode(_coordinate_tree(col(column), names[:-1], len(coords) - 1, [])).alias("__s"))
        exploded = inner.select(*keep, "__s", F.posexplode(F.col("__s")["value"]).alias("__pos", "__value"))
        numbers = [*[F.col("__s")[n].alias(n) for n in coords], (F.col("__pos") + 1).alias(position)]
        return exploded.select(*keep, *numbers, F.col("__value").alias(value))
    flat = _coordinate_tree(col(column), names, len(coords), [])
    exploded = df.select(*keep, F.posexplode(flat).alias("__pos", "__s"))
    out = [*keep, *[F.col("__s")[n].alias(n) for n in names]]
    if ordinal:
        out.append((F.col("__pos") + 1).alias(ordinal))
    out.append(F.col("__s")["value"].alias(value))
    return exploded.select(*out)


def _leaves(c: Column, depth: int) -> Column:
    """Number of innermost elements of ``array^depth``."""
    if depth == 1:
        return F.size(c).cast("bigint")
    return F.aggregate(F.filter(c, lambda x: x.isNotNull()), F.lit(0).cast("bigint"), lambda n, x: n + _leaves(x, depth - 1))


def explode_chapters(
    chapters: DataFrame,
    by: Sequence[str],
    chapter: str = "chapter",
    content: str = "content",
    coords: Sequence[str] = ("verse",),
    position: str = "word",
    ordinal: str | None = "ordinal",
    value: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """One row per innermost element of chapters that are rows of their own.

    ``content`` has ``len(coords) + 1`` array levels.  ``ordinal`` runs through
    all chapters of ``by``: each chapter's own ordinals start after a prefix sum
    over the sizes of the chapters before it, one small row a chapter, so a book
    of any size is as many tasks as its chapters are dealt to."""
    by = list(by)
    keep = list(keep if keep is not None else [c for c in chapters.columns if c not in (content, chapter)])
    d = chapters  # not filtered: the content, often parsed just here, would be made once more for it
    names = [*coords, position]
    flat = _coordinate_tree(F.col(content), names, len(coords), [])
    if not ordinal:
        rows = d.select(*keep, chapter, F.explode(flat).alias("__s"))
        return rows.select(*keep, chapter, *[F.col("__s")[n].alias(n) for n in names], F.col("__s")["value"].alias(value))
    before = Window.partitionBy(*by).orderBy(chapter).rowsBetween(Window.unboundedPreceding, -1)
    sizes = d.select(*by, chapter, F.coalesce(_leaves(F.col(content), len(coords) + 1), F.lit(0)).alias("__n"))
    offsets = sizes.select(*by, chapter, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__off"))
    # the offsets are hashed, so that the content need not be sorted
    rows = _join_back(d, offsets.hint("shuffle_hash"), [*by, chapter]).select(*keep, chapter, "__off", F.posexplode(flat).alias("__pos", "__s"))
    return rows.select(
        *keep, chapter, *[F.col("__s")[n].alias(n) for n in names], (F.col("__pos") + 1 + F.col("__off")).alias(ordinal), F.col("__s")["value"].alias(value)
    )


def explode_levels(
    df: DataFrame,
    column: str | Column,
    by: Sequence[str],
    coords: Sequence[str] = ("chapter", "verse"),
    position: str = "word",
    ordinal: str | None = "ordinal",
    value: str = "value",
    keep: Sequence[str] | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """`explode_nested` in two levels: the first level's elements become rows
    and are dealt to all tasks before the rest is exploded.

    ``by`` names the columns that tell the rows of ``df`` apart.  Same rows as
    `explode_nested`, for books that are too large to be exploded by the task
    that holds them."""
    by = list(by)
    keep = [c for c in (keep if keep is not None else df.columns) if c != (column if isinstance(column, str) else None)]
    extra = [c for c in by if c not in keep]
    chapters = df.select(*keep, *extra, F.posexplode(col(column)).alias("__p", "__content"))
    chapters = chapters.select(*keep, *extra, (F.col("__p") + 1).alias(coords[0]), "__content")
    # dealt by book and chapter; the sizes and the rows share this shuffle
    spread = [*by, coords[0]]
    chapters = chapters.repartition(partitions, *spread) if partitions else chapters.repartition(*spread)
    out = explode_chapters(chapters, by, coords[0], "__content", coords[1:], position, ordinal, value, keep=[*keep, *extra])
    return out.drop(*extra)


def split_nested(text: str | Column, separators: Sequence[str]) -> Column:
    """Split a text into nested arrays, one regex separator per level,
    e.g. ``('\\n', ' ')`` -> lines of tokens.  Empty pieces are kept."""
    def level(c: Column, seps: Sequence[str]) -> Column:
        parts = F.split(c, seps[0], -1)
        if len(seps) == 1:
            return parts
        return F.transform(parts, lambda p: level(p, seps[1:]))

    return level(col(text), list(separators))


def explode_text(
    df: DataFrame,
    text: str | Column,
    separators: Sequence[str],
    coords: Sequence[str] = ("chapter", "verse"),
    position: str = "word",
    ordinal: str | None = "ordinal",
    value: str = "value",
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """``explode_nested(split_nested(text, separators), ...)`` in one pass:
    the coordinates are attached while the text is split, so the nested
    array is built once instead of twice.  One separator (a regex) per
    level: ``len(separators) == len(coords) + 1``."""
    if len(separators) != len(coords) + 1:
        raise ValueError("one separator per level")
    names = list(coords) + [position]
    keep = list(keep if keep is not None else [c for c in df.columns if c != (text if isinstance(text, str) else None)])

    literals = [_literal(x) for x in separators]
    if all(literals):
        return _explode_literal(df.select(*keep, col(text).cast("string").alias("__text")), keep, literals, names, ordinal, value)

    def level(c: Column, depth: int, acc: list[tuple[str, Column]]) -> Column:
        parts = F.split(c, separators[depth], -1)
        if depth == len(names) - 1:
            return F.transform(
                parts,
                lambda w, wi: F.struct(*[v.alias(n) for n, v in acc], (wi + 1).alias(names[-1]), w.alias("value")),
            )
        return F.flatten(F.transform(parts, lambda x, xi: level(x, depth + 1, acc + [(names[depth], xi + 1)])))

    exploded = df.select(*keep, F.posexplode(level(col(text), 0, [])).alias("__pos", "__s"))
    out = [*keep, *[F.col("__s")[n].alias(n) for n in names]]
    if ordinal:
        out.append((F.col("__pos") + 1).alias(ordinal))
    out.append(F.col("__s")["value"].alias(value))
    return exploded.select(*out)


def _literal(separator: str) -> str | None:
    """The text that a regex stands for, if it stands for one text only."""
    text = re.sub(r"\\([^0-9A-Za-z])", r"\1", separator)
    plain = not re.search(r"[\\.^$|?*+()\[\]{}]", re.sub(r"\\[^0-9A-Za-z]", "", separator))
    return text if plain and text else None


_TEXT_BYTES = 1 << 22  # of text that is split at a time


def _slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `_TEXT_BYTES` of text, or one row."""
    size = pc.fill_null(pc.binary_length(batch.column(batch.num_columns - 1)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // _TEXT_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
    for a, b in zip(cuts, cuts[1:]):
        if b > a:
            yield batch.slice(a, b - a)


def _explode_literal(
    df: DataFrame, keep: Sequence[str], separators: Sequence[str], names: Sequence[str], ordinal: str | None, value: str
) -> DataFrame:
    """Split and numbered as whole Arrow columns; ``df`` has ``keep`` and the
    text.  A level's pieces are numbered from the offsets of its lists, so no
    word is an object of its own."""
    kept = len(keep)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _slices(batch):
                pieces = part.column(kept)
                pieces = pieces.cast(pa.string())
                row = np.arange(part.num_rows)
                first = row  # the row in `part` that a piece comes from
                numbers: list[np.ndarray] = []
                for separator in separators:
                    lists = pc.split_pattern(pieces, separator)
                    n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False).astype(np.int64)
                    begin = np.cumsum(n) - n
                    pieces = lists.flatten()
                    numbers = [np.repeat(x, n) for x in numbers]
                    numbers.append((np.arange(len(pieces)) - np.repeat(begin, n) + 1).astype(np.int32))
                    first = np.repeat(first, n)
                if not len(pieces):
                    continue
                extra = []
                if ordinal:
                    start = np.flatnonzero(np.r_[True, first[1:] != first[:-1]])
                    length = np.diff(np.r_[start, len(first)])
                    extra = [pa.array((np.arange(len(first)) - np.repeat(start, length) + 1).astype(np.int32))]
                out = [*part.select(list(range(kept))).take(pa.array(first)).columns, *map(pa.array, numbers), *extra, pieces]
                done = pa.RecordBatch.from_arrays(out, names=schema.names)
                for a in range(0, len(first), 1 << 16):
                    yield done.slice(a, 1 << 16)

    whole = [*names, *([ordinal] if ordinal else [])]
    schema = T.StructType([*df.schema.fields[:kept], *[T.StructField(n, T.IntegerType()) for n in whole], T.StructField(value, T.StringType())])
    return df.mapInArrow(rows, schema)
