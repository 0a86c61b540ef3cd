"""Token ids in binary shards with a minimal perfect hash index.

A shard is two files.  ``shard-N.bin`` holds the raw ids of its documents in
ascending id order, little-endian, 2 bytes each where the vocabulary allows
and else 4.  ``shard-N.idx`` maps a document id to its place in constant time:
a cascade of bit arrays (each key is placed in the first level where it hashes
alone; its slot is the rank of its bit), and per slot a stored 32-bit
fingerprint, the document's row and, per row, the offset.  A key that was never
stored is refused by the fingerprint, then by the stored id.

Edge cases: a null or empty text is the end id alone; a null id is a key of
its own and sorts first; rows that repeat an id stand side by side, in order of
their ids, and a lookup returns all of them; extra columns are ignored; an
empty table gives no shard and no rows.  A very long text is encoded whole, as a
block of its own, and is one row of its shard."""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ._encode import encoder
from ._scratch import commit, filesystem
from ._text import blocks, mix64

SHARD_BYTES = 32 << 20  # of text in a shard, more where there would be over MAX_SHARDS
SHARD_ROWS = 1 << 20
MAX_SHARDS = 20_000
_READ_BYTES = 1 << 22
_GAMMA = 2
_MAGIC = b"TWTOKIX1"


def _hash(keys: np.ndarray, null: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix64(mix64(keys.astype(np.int64).view(np.uint64) + np.uint64(0x632BE59BD9B4E019)) + null.astype(np.uint64))


def _level(h: np.ndarray, level: int, size: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return (mix64(h + np.uint64(0x9E3779B97F4A7C15 * (level + 1) % (1 << 64))) % np.uint64(size)).astype(np.int64)


class PerfectHash:
    """Minimal perfect hash over distinct 64-bit key hashes."""

    def __init__(self, sizes: np.ndarray, words: np.ndarray):
        self.sizes, self.words = sizes, words
        self.base = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
        self.rank = np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)])

    @classmethod
    def build(cls, h: np.ndarray) -> PerfectHash:
        sizes, bits, level = [], [], 0
        while len(h):
            size = -(-max(_GAMMA * len(h), 64) // 64) * 64
            pos = _level(h, level, size)
            alone = np.bincount(pos, minlength=size) == 1
            bits.append(alone)
            sizes.append(size)
            h = h[~alone[pos]]
            level += 1
            if level > 200:
                raise ValueError("two keys have the same 64-bit hash")
        packed = np.packbits(np.concatenate(bits) if bits else np.zeros(0, bool), bitorder="little")
        return cls(np.asarray(sizes, np.int64), packed.view("<u8"))

    def slots(self, h: np.ndarray) -> np.ndarray:
        """Slot of each key; -1 for a key that no level holds."""
        out = np.full(len(h), -1, np.int64)
        todo = np.arange(len(h))
        for level, size in enumerate(self.sizes):
            pos = self.base[level] + _level(h[todo], level, int(size))
            word, bit = self.words[pos >> 6], (pos & 63).astype(np.uint64)
            hit = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[todo[hit]] = (self.rank[pos >> 6] + below)[hit]
            todo = todo[~hit]
            if not len(todo):
                break
        return out


def build_index(keys: np.ndarray, null: np.ndarray, lengths: np.ndarray) -> bytes:
    """The index file of documents in payload order (equal keys adjacent)."""
    n = len(keys)
    new = np.ones(n, bool)
    new[1:] = (keys[1:] != keys[:-1]) | (null[1:] != null[:-1])
    row = np.flatnonzero(new)
    h = _hash(keys[row], null[row])
    mph = PerfectHash.build(h)
    slot = mph.slots(h)
    first = np.zeros(len(row), "<u4")
    first[slot] = row
    prints = np.zeros(len(row), "<u4")
    prints[slot] = mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32)
    start = np.zeros(n + 1, "<u8")
    np.cumsum(lengths, out=start[1:])
    arrays = {
        "sizes": mph.sizes.astype("<i8"), "bits": mph.words.astype("<u8"), "prints": prints, "first": first,
        "keys": keys.astype("<i8"), "null": null.astype("u1"), "start": start,
    }
    head = json.dumps({k: [a.dtype.str, len(a)] for k, a in arrays.items()}).encode()
    return b"".join([_MAGIC, len(head).to_bytes(8, "little"), head, *[a.tobytes() for a in arrays.values()]])


class ShardIndex:
    """Keyed access to one shard's index."""

    def __init__(self, raw: bytes):
        if raw[:8] != _MAGIC:
            raise ValueError("not a token shard index")
        n = int.from_bytes(raw[8:16], "little")
        at, self.arrays = 16 + n, {}
        for name, (dtype, size) in json.loads(raw[16 : 16 + n]).items():
            self.arrays[name] = np.frombuffer(raw, dtype=dtype, count=size, offset=at)
            at += self.arrays[name].nbytes
        self.mph = PerfectHash(self.arrays["sizes"], self.arrays["bits"])
        # rows of each slot's key, once: a lookup reads a few places of arrays
        first = self.arrays["first"].astype(np.int64)
        order = np.argsort(first, kind="stable")
        self.rows = np.empty(len(first), np.int64)
        self.rows[order] = np.diff(np.append(first[order], len(self.arrays["keys"])))

    def find(self, keys: np.ndarray, null: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``(first row, rows)`` of each key; no rows for an unknown one."""
        a = self.arrays
        h = _hash(keys, null)
        slot = self.mph.slots(h)
        known = slot >= 0
        s = np.where(known, slot, 0)
        if len(a["prints"]) == 0:
            return np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        known &= a["prints"][s] == (mix64(h ^ np.uint64(0xA5A5A5A5A5A5A5A5)) >> np.uint64(32))
        row = a["first"][s].astype(np.int64)
        known &= (a["keys"][row] == keys) & (a["null"][row] == null)
        return row, np.where(known, self.rows[s], 0)


def read_rows(payload, at: np.ndarray, rows: np.ndarray, width: int) -> Iterator[bytes]:
    """The ids of each row; rows that follow each other are read together, up
    to ``_READ_BYTES`` at a time."""
    i = 0
    while i < len(rows):
        j, begin = i + 1, at[rows[i]]
        while j < len(rows) and rows[j] == rows[j - 1] + 1 and (at[rows[j] + 1] - begin) * width <= _READ_BYTES:
            j += 1
        raw = payload.read_at(int((at[rows[j - 1] + 1] - begin) * width), int(begin * width))
        for r in rows[i:j].tolist():
            yield raw[(at[r] - begin) * width : (at[r + 1] - begin) * width]
        i = j


def _bounds(docs: DataFrame, id_col: str, text_col: str) -> list[int]:
    """Upper ids of all shards but the last, from the id column alone."""
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(F.col(text_col).cast("string"))), F.lit(0))).first()
    n = max(1, min(MAX_SHARDS, max(-(-size // SHARD_BYTES), -(-rows // SHARD_ROWS))))
    if n == 1:
        return []
    cuts = docs.agg(F.percentile_approx(F.col(id_col), [i / n for i in range(1, n)], 100 * n).alias("q")).first()[0]
    return sorted(set(cuts or []))


def _shard(ids: pa.Array, bounds: np.ndarray) -> pa.Array:
    """Number of the shard of each id: the bounds below it (null: the first)."""
    at = np.searchsorted(bounds, ids.fill_null(0).to_numpy(), side="left")
    return pa.array(np.where(np.asarray(ids.is_null()), 0, at).astype(np.int32))


def encode(
    docs: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text", bounds: Sequence[int] = ()
) -> DataFrame:
    """``(shard, id, ids)`` with the raw ids of each whole text as one binary
    value, and the shard its id falls in; no shuffle."""
    cuts = np.asarray(bounds, dtype=np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(tokenizer)
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(1)):
                ids, at = enc.block(data, offsets, end_id)
                size = enc.dtype.itemsize
                col = pa.LargeBinaryArray.from_buffers(pa.large_binary(), j - i, [None, pa.py_buffer((at * size).astype(np.int64)), pa.py_buffer(ids)])
                own = batch.column(0).slice(i, j - i)
                yield pa.RecordBatch.from_arrays([_shard(own, cuts), own, col.cast(pa.binary())], names=["shard", "id", "ids"])

    return docs.select(F.col(id_col).cast("bigint").alias("id"), F.col(text_col).cast("string")).mapInArrow(run, "shard int, id bigint, ids binary")


def write_shards(
    docs: DataFrame, root: str, tokenizer: str, end_id: int = 1, id_col: str = "doc_id", text_col: str = "text"
) -> list[dict]:
    """Encode ``docs`` and write shards under ``root`` (a shared folder).
    Returns the manifest in shard order, one entry per shard, which is also
    written as ``manifest.json``.

    Ids decide the shard, so shards follow each other in ascending order; one
    shuffle moves the ids (half the text's size), each task streams its rows
    into the payload and holds only the index of the shard it writes."""
    spark = docs.sparkSession
    width = encoder(tokenizer).dtype.itemsize
    bounds = _bounds(docs, id_col, text_col)
    fsys, base = filesystem(root)
    fsys.create_dir(base)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = filesystem(root)
        now, stream, finish, keys, lengths = None, None, None, [], []

        def close() -> pa.RecordBatch:
            finish()
            k = np.concatenate([x[0] for x in keys])
            null = np.concatenate([x[1] for x in keys])
            n = np.concatenate(lengths)
            index, done = commit(files, f"{where}/shard-{now:06d}.idx")
            index.write(build_index(k, null, n))
            done()
            return pa.RecordBatch.from_pylist([{"shard": int(now), "n_docs": len(k), "n_tokens": int(n.sum())}])

        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j:
                    continue
                if shard[i] != now:
                    if now is not None:
                        yield close()
                    now, keys, lengths = shard[i], [], []
                    stream, finish = commit(files, f"{where}/shard-{now:06d}.bin")
                ids = batch.column(1).slice(i, j - i)
                payload = batch.column(2).slice(i, j - i).cast(pa.large_binary())
                off = np.frombuffer(payload.buffers()[1], np.int64)[payload.offset : payload.offset + j - i + 1]
                stream.write(memoryview(payload.buffers()[2])[off[0] : off[-1]])
                keys.append((ids.fill_null(0).to_numpy(), np.asarray(ids.is_null())))
                lengths.append(np.diff(off) // width)
        if now is not None:
            yield close()

    encoded = encode(docs, tokenizer, end_id, id_col, text_col, bounds)
    dealt = encoded.repartitionById(len(bounds) + 1, F.col("shard").cast("int"))
    rows = dealt.sortWithinPartitions("shard", F.col("id").asc_nulls_first(), "ids").mapInArrow(write, "shard bigint, n_docs bigint, n_tokens bigint").collect()
    manifest, start = [], 0
    for r in sorted(rows, key=lambda r: r["shard"]):
        manifest.append({"shard": r["shard"], "start": start, "n_docs": r["n_docs"], "n_tokens": r["n_tokens"]})
        start += r["n_tokens"]
    stream, finish = commit(fsys, f"{base}/manifest.json")
    stream.write(json.dumps({"bounds": bounds, "width": width, "shards": manifest}).encode())
    finish()
    return manifest


def read_manifest(root: str) -> dict:
    files, where = filesystem(root)
    with files.open_input_stream(f"{where}/manifest.json") as f:
        return json.loads(f.read())


def lookup(keys: DataFrame, root: str, id_col: str = "doc_id") -> DataFrame:
    """Keyed access: for every distinct id of ``keys`` the stored documents, as
    ``(id, shard, start, n_tokens, ids)`` with ``start`` the number of ids
    before the document in the whole collection.  Unknown ids give no row."""
    head = read_manifest(root)
    starts = {s["shard"]: s["start"] for s in head["shards"]}
    width = head["width"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, where = filesystem(root)
        now, index, payload = None, None, None
        for batch in batches:
            shard = batch.column(0).to_numpy()
            cuts = np.concatenate([[0], np.flatnonzero(np.diff(shard)) + 1, [len(shard)]])
            for i, j in zip(cuts[:-1], cuts[1:], strict=True):
                if i == j or int(shard[i]) not in starts:
                    continue
                if shard[i] != now:
                    now = shard[i]
                    with files.open_input_stream(f"{where}/shard-{now:06d}.idx") as f:
                        index = ShardIndex(f.read())
                    payload = files.open_input_file(f"{where}/shard-{now:06d}.bin")
                    at = index.arrays["start"].astype(np.int64)
                ids = batch.column(1).slice(i, j - i)
                row, n = index.find(ids.fill_null(0).to_numpy(), np.asarray(ids.is_null()))
                key = np.repeat(np.arange(j - i), n)
                rows = np.concatenate([np.arange(r, r + m) for r, m in zip(row, n, strict=True)]) if len(row) else row
                for lo in range(0, len(rows), 1000):
                    part = rows[lo : lo + 1000]
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(key[lo : lo + 1000])),
                            pa.array(np.full(len(part), now, np.int32)),
                            pa.array(starts[int(now)] + at[part]),
                            pa.array(at[part + 1] - at[part]),
                            pa.array(list(read_rows(payload, at, part, width)), pa.binary()),
                        ],
                        names=["id", "shard", "start", "n_tokens", "ids"],
                    )

    cuts = np.asarray(head["bounds"], dtype=np.int64)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([_shard(batch.column(0), cuts), batch.column(0)], names=["shard", "id"])

    wanted = keys.select(F.col(id_col).cast("bigint").alias("id")).distinct().mapInArrow(place, "shard int, id bigint")
    dealt = wanted.repartitionById(len(cuts) + 1, "shard")
    found = dealt.sortWithinPartitions("shard", "id").mapInArrow(read, "id bigint, shard int, start bigint, n_tokens bigint, ids binary")
    return found.withColumnRenamed("id", id_col)


def with_crc32(found: DataFrame, width: int) -> DataFrame:
    """``ids_crc32`` of each document's ids as little-endian unsigned 32-bit
    integers, in place of ``ids``."""
    dtype = f"<u{width}"
    out = [f for f in found.schema if f.name != "ids"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            crc = [zlib.crc32(np.frombuffer(x.as_py(), dtype).astype("<u4").tobytes()) for x in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([*[batch.column(f.name) for f in out], pa.array(crc, pa.int64())], names=[*[f.name for f in out], "ids_crc32"])

    return found.mapInArrow(run, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out) + ", ids_crc32 bigint")
