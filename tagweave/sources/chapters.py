"""Nested JSON books cut at chapter ends, so that one file is many tasks.

A file is read as text with ``[`` (or a line end) as line separator: Spark
splits it at any of them, and a split's pieces arrive in file order.  Whether a
split starts inside a string, and how deep, is known only from all before it.  A
first pass therefore sums up each split for both cases: quotes, brackets, and
commas by depth.  A window over these sums, one small row a split, gives every
split its start, and a second pass cuts chapters out.  What a split holds of a
chapter that goes over its ends is put together by (file, chapter), and that
shuffle also deals the chapters to all tasks.  A book may also be a folder of
files that follow each other by name, cut at any line: its splits are summed up
through all of them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Schema of a chapter: verse -> word -> strings.
NESTED3 = "array<array<array<string>>>"

_QUOTE, _ESCAPE, _OPEN, _CLOSE, _COMMA = (ord(c) for c in '"\\[],')
_RUN_BYTES = 1 << 19  # about as much text is looked at at a time
_DEEP = 8  # commas are counted at depths from -8 to 8 beside a split's start


def _pieces(spark: SparkSession, path: str, glob: str, separator: str = "[") -> DataFrame:
    raw = spark.read.option("lineSep", separator).option("pathGlobFilter", glob).text(path)
    return raw.select(F.xxhash64("_metadata.file_path").alias("f"), F.col("_metadata.file_block_start").alias("block"), "value")


def _runs(batches: Iterator[pa.RecordBatch], separator: bytes = b"[") -> Iterator[tuple[pa.RecordBatch, int, int, bytes, bool]]:
    """``(batch, f, block, text, new)`` for every run of pieces of one split;
    the separators are back in the text.  ``new``: the split's first run."""
    last = None
    for batch in batches:
        f, block = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
        if not len(f):
            continue
        size = pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False)
        some = np.cumsum(size, dtype=np.int64) // _RUN_BYTES
        cut = np.flatnonzero((f[1:] != f[:-1]) | (block[1:] != block[:-1]) | (some[1:] != some[:-1])) + 1
        for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(f)], strict=True):
            key = int(f[a]), int(block[a])
            pieces = batch.column(2).slice(a, b - a).cast(pa.binary())
            text = pc.binary_join(pa.ListArray.from_arrays(pa.array([0, b - a], pa.int32()), pieces), separator)[0].as_py()
            # only a file's first piece has no separator in front of it
            yield batch, *key, text if key != last and key[1] == 0 else separator + text, key != last
            last = key


_MARK = np.zeros(256, bool)
_MARK[[_OPEN, _CLOSE, _COMMA]] = True


def _marks(data: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """``(whether [ ] or comma, 1 where an odd number of quotes came before,
    quotes)``."""
    quotes = np.flatnonzero(data == _QUOTE)
    escaped = quotes[data[quotes - 1] == _ESCAPE]
    if len(escaped):
        # a quote after an odd run of escapes is part of its string
        escapes = np.flatnonzero(data == _ESCAPE)
        place = np.arange(len(escapes))
        start = np.ones(len(escapes), bool)
        start[1:] = escapes[1:] != escapes[:-1] + 1
        run = place + 1 - np.maximum.accumulate(np.where(start, place, 0))
        before = np.zeros(len(data), bool)
        before[escapes[run % 2 == 1]] = True  # the last of a run says whether it is odd
        before[-1] = False  # what the quote at 0 would look at
        quotes = quotes[~before[quotes - 1]]
    parity = np.zeros(len(data), np.uint8)
    parity[quotes] = 1
    return np.frombuffer(data.tobytes().translate(_MARK.tobytes()), bool), np.bitwise_xor.accumulate(parity), len(quotes)


def _steps(kind: np.ndarray) -> np.ndarray:
    return (kind == _OPEN).astype(np.int8) - (kind == _CLOSE).astype(np.int8)


_SUMS = "f bigint, block bigint, quotes bigint, d0 bigint, d1 bigint, o0 bigint, o1 bigint, h0 array<bigint>, h1 array<bigint>"


def _summaries(batches: Iterator[pa.RecordBatch], separator: bytes = b"[") -> Iterator[pa.RecordBatch]:
    now, quotes, depth, opens, commas = None, 0, [0, 0], [0, 0], np.zeros((2, 2 * _DEEP + 1), np.int64)

    def row() -> pa.RecordBatch:
        values = [[v] for v in (*now, quotes, *depth, *opens, commas[0].tolist(), commas[1].tolist())]
        types = [pa.int64()] * 7 + [pa.list_(pa.int64())] * 2
        names = ["f", "block", "quotes", "d0", "d1", "o0", "o1", "h0", "h1"]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types, strict=True)], names=names)

    for _, f, block, text, new in _runs(batches, separator):
        if new:
            if now is not None:
                yield row()
            now, quotes, depth, opens, commas = (f, block), 0, [0, 0], [0, 0], np.zeros((2, 2 * _DEEP + 1), np.int64)
        data = np.frombuffer(text, np.uint8)
        mark, parity, n = _marks(data)
        for start in (0, 1):  # outside or inside a string at the split's start
            kind = data[mark & (parity == (quotes + start) % 2)]
            step = _steps(kind)
            level = depth[start] + np.cumsum(step, dtype=np.int64)
            here = level[kind == _COMMA] + _DEEP
            here = here[(here >= 0) & (here <= 2 * _DEEP)]
            commas[start] += np.bincount(here, minlength=2 * _DEEP + 1)
            depth[start] += int(step.sum())
            opens[start] += int((kind == _OPEN).sum())
        quotes += n
    if now is not None:
        yield row()


def _starts(sums: DataFrame, files: DataFrame) -> DataFrame:
    """``(f, block, inside, depth, chapter, balanced)``: how each split starts, and
    whether its book is an array that closes all it opens."""
    known = sums.join(F.broadcast(files), "f")
    w = Window.partitionBy("file").orderBy("name", "block").rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy("file")
    known = known.withColumn("inside", F.pmod(F.coalesce(F.sum("quotes").over(w), F.lit(0)), F.lit(2)))
    known = known.withColumn("d", F.when(F.col("inside") == 0, F.col("d0")).otherwise(F.col("d1")))
    known = known.withColumn("o", F.when(F.col("inside") == 0, F.col("o0")).otherwise(F.col("o1")))
    known = known.withColumn("h", F.when(F.col("inside") == 0, F.col("h0")).otherwise(F.col("h1")))
    known = known.withColumn("depth", F.coalesce(F.sum("d").over(w), F.lit(0)))
    # commas at depth 1 part the chapters
    known = known.withColumn("commas", F.coalesce(F.get("h", (F.lit(1 + _DEEP) - F.col("depth")).cast("int")), F.lit(0)))
    balanced = (F.sum("d").over(every) == 0) & (F.sum("o").over(every) > 0) & (F.pmod(F.sum("quotes").over(every), F.lit(2)) == 0)
    chapter = F.coalesce(F.sum("commas").over(w), F.lit(0)) + 1
    return known.select("f", "block", "inside", "depth", chapter.alias("chapter"), balanced.alias("balanced"))


_PARTS = "f bigint, chapter bigint NOT NULL, block bigint, part bigint, balanced boolean, text string"


def _parts(batches: Iterator[pa.RecordBatch], separator: bytes = b"[") -> Iterator[pa.RecordBatch]:
    """Chapters, or what a split holds of them, in file order."""
    quotes = depth = chapter = part = 0
    open_, held, where = False, [], (0, 0, True)
    rows: list[tuple] = []

    def close() -> None:
        nonlocal held, part
        if held:
            rows.append((where[0], chapter, where[1], part, where[2], "".join(held)))
            held, part = [], part + 1

    def flush() -> Iterator[pa.RecordBatch]:
        if rows:
            types = [pa.int64()] * 4 + [pa.bool_(), pa.string()]
            names = ["f", "chapter", "block", "part", "balanced", "text"]
            yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows, strict=True), types, strict=True)], names=names)
            rows.clear()

    for batch, f, block, raw, new in _runs(batches, separator):
        if new:
            close()
            k = int(np.flatnonzero((batch.column(0).to_numpy() == f) & (batch.column(1).to_numpy() == block))[0])
            quotes, depth, chapter, balanced = (batch.column(i)[k].as_py() for i in (3, 4, 5, 6))
            part, where = 0, (f, block, balanced)
            if block == 0:
                rows.append((f, 0, 0, 0, balanced, ""))  # stands for the file
            open_ = depth >= 2
        data = np.frombuffer(raw, np.uint8)
        sign, parity, n = _marks(data)
        at = np.flatnonzero(sign & (parity == quotes % 2))
        kind = data[at]
        level = depth + np.cumsum(_steps(kind), dtype=np.int64)
        # the marks that open, close or part chapters
        mark = ((kind == _OPEN) & (level == 2)) | ((kind == _CLOSE) & (level == 1)) | ((kind == _COMMA) & (level == 1))
        done = 0
        for p, m in zip(at[mark].tolist(), kind[mark].tolist(), strict=True):
            if m == _OPEN:
                open_, done = True, p
            elif m == _CLOSE:
                if open_:
                    held.append(raw[done : p + 1].decode())
                close()
                open_ = False
            else:
                chapter += 1
        if open_:
            held.append(raw[done:].decode())
            if sum(map(len, held)) > 1 << 22:
                close()
        quotes, depth = (quotes + n) % 2, int(level[-1]) if len(level) else depth
        yield from flush()
    close()
    yield from flush()


def read_nested_chapters(
    spark: SparkSession, path: str, glob: str = "*.json", schema: str = NESTED3, on_error: str = "fail", separator: str = "[", parts: bool = False
) -> DataFrame:
    """``(file, file_name, book_key, chapter, content)``: one row for each
    chapter (first-level array) of the nested JSON books in ``path``, with its
    1-based place among the first level's elements.

    A file is read by as many tasks as ``spark.sql.files.maxPartitionBytes``
    cuts it into (a compressed one by one), twice; a chapter must fit in a task.
    Brackets, quotes and escapes inside strings and any white space are
    respected.  Elements that are no array (``null``) keep their number and have
    no row, nor has an empty book.  A chapter that does not parse, or a file
    whose brackets or quotes do not close, fails the job (``on_error='fail'``) or
    gives null content (``'null'``; the file's is a row with chapter 0).  An
    empty file has none.  What tells the splits' starts apart, and the files'
    names, are broadcast: a small row for each split of a file, less than the
    scheduler holds of it.

    ``separator``: where a file may be split and read on.  ``[`` is in every
    book; a line end is cheaper for books that have lines, and one without them
    is read as one piece.  ``parts``: a book is a folder, whose files in order of
    their names are one JSON text, each of whole lines; ``file`` is the folder."""
    if on_error not in ("fail", "null"):
        raise ValueError("on_error must be 'fail' or 'null'")
    if separator not in ("[", "\n") or (parts and separator != "\n"):
        raise ValueError("separator must be '[' or a line end, a line end for books in parts")
    listed = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path).select(
        F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("name")
    )
    file = F.regexp_replace("path", "/[^/]*$", "") if parts else F.col("path")
    files = listed.select(F.xxhash64("path").alias("f"), file.alias("file"), "name")
    cut = separator.encode()
    pieces = _pieces(spark, path, glob, separator)
    starts = _starts(pieces.mapInArrow(lambda batches: _summaries(batches, cut), _SUMS), files)
    started = pieces.join(F.broadcast(starts), ["f", "block"]).select("f", "block", "value", "inside", "depth", "chapter", "balanced")
    found = started.mapInArrow(lambda batches: _parts(batches, cut), _PARTS).join(F.broadcast(files), "f")
    # dealt by what tells chapters apart: what is joined to them by it needs no other shuffle
    dealt = found.drop("f").repartition("file", "chapter").groupBy("file", "chapter")
    ordered = F.sort_array(F.collect_list(F.struct("name", "block", "part", "text")))
    chapters = dealt.agg(ordered.alias("parts"), F.min("balanced").alias("balanced"), F.min("name").alias("name"))
    content = F.when(F.col("balanced"), F.from_json(F.array_join(F.col("parts.text"), ""), schema))
    name = F.substring_index("file", "/", -1) if parts else F.col("name")
    key = F.regexp_replace(name, r"\.[^.]*$", "") if parts else F.regexp_extract(name, r"^(.*)\.[^.]*$", 1)
    out = chapters.where("chapter > 0 OR NOT balanced").select("file", name.alias("file_name"), key.alias("book_key"), "chapter", content.alias("content"))
    if on_error == "fail":
        message = F.concat(F.lit("not a nested book: "), F.col("file"), F.lit(", chapter "), F.col("chapter").cast("string"))
        out = out.withColumn("content", F.when(F.col("content").isNull(), F.raise_error(message).cast(schema)).otherwise(F.col("content")))
    return out
