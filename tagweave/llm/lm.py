"""Language-model scores: a smoothed word-frequency base and a subword lattice
likelihood.

The lattice model takes an existing subword vocabulary with its scores.  Every
segmentation of a word into pieces has the product of its pieces'
probabilities; the word's probability is their sum over all segmentations, got
by a forward recursion in log space.  Words are independent, so a document's
marginal probability is the product over its words and an end piece.

The public vocabulary at hand scores its pieces by merge rank, not by
probability.  The ranks give a Zipf prior, and the vocabulary's own
segmentation of the training words, weighted by their counts, gives the piece
counts added to it; the tokenizer itself is not trained.  Byte pieces cover
whatever the vocabulary does not spell.

Word counts come from the training documents (``held_out`` is false) and are
one table row for each distinct word, so they grow with the corpus.  Scores
reach the documents two ways: the ``HEAD_WORDS`` most frequent words (a fixed
bound) are broadcast, all others are joined by a shuffle on the word's hash, so
nothing is left out.

Edge cases: null and empty texts are the end token alone; a null id counts as
the empty text when documents are held out; rows that repeat an id are scored
row by row; with no training words every count is 0; extra columns are
ignored; an empty table gives no rows.  Very long texts are cut into words as
any; a very long word (an unspaced script, an encoded file) is looked up a chunk
of positions at a time, and only the sum over the pieces that end at a position
goes byte by byte, a few microseconds each, in memory of the chunk."""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ._scratch import stored
from ._text import LOWER, blocks, byte_table, find_words, prefix_hash, range_hash, row_of, word_hashes

LONG_WORD = 512  # bytes; longer words go one by one
_POSITIONS = 1 << 13
HEAD_WORDS = 1 << 16
HOLD_OUT = 10
ALPHA = 0.1
PRIOR_WORDS = 10_000.0
_SPACE = "▁"
_END = "</s>"
_COUNT_BLOCK = 1 << 20


def held_out(ids: pa.Array, mod: int = HOLD_OUT) -> np.ndarray:
    """True where the remainder of crc32(id as text) is 0."""
    return np.fromiter((zlib.crc32(b"" if x is None else str(x).encode()) % mod == 0 for x in ids.to_pylist()), bool, len(ids))


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(word, c, n)``: lower-cased words with their count in the training
    documents and in all; combined in each block, then by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            train = ~held_out(batch.column(0))
            for i, j, data, offsets in blocks(batch.column(1), _COUNT_BLOCK):
                data = LOWER[data]
                start, end, first = find_words(data, offsets)
                if not len(start):
                    continue
                h = word_hashes(data, start, end)
                _, where, back = np.unique(h, return_index=True, return_inverse=True)
                n = np.bincount(back, minlength=len(where))
                c = np.bincount(back, weights=train[i:j][row_of(first)], minlength=len(where)).astype(np.int64)
                raw = data.tobytes()
                words = [raw[a:b] for a, b in zip(start[where].tolist(), end[where].tolist(), strict=True)]
                for lo in range(0, len(words), 20_000):
                    part = slice(lo, lo + 20_000)
                    yield pa.RecordBatch.from_arrays([pa.array(words[part], pa.binary()), pa.array(c[part]), pa.array(n[part])], names=["word", "c", "n"])

    rows = docs.select(F.col(id_col), F.col(text_col).cast("string")).mapInArrow(run, "word binary, c bigint, n bigint")
    return rows.groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n"))


@lru_cache(maxsize=1)
def _processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def piece_counts(words: DataFrame, vocabulary: str) -> list[float]:
    """How often the vocabulary's own segmentation of the training words uses
    each piece; one number for each piece of the vocabulary."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sp = _processor(vocabulary)
        total = np.zeros(sp.get_piece_size(), dtype=np.float64)
        for batch in batches:
            counts = batch.column(1).to_numpy()
            text = [w.as_py().decode("utf-8", "replace") for w in batch.column(0)]
            for lo in range(0, len(text), 2000):
                ids = sp.encode(text[lo : lo + 2000], num_threads=1)
                n = np.fromiter(map(len, ids), np.int64, len(ids))
                flat = np.fromiter((x for w in ids for x in w), np.int64, int(n.sum()))
                total += np.bincount(flat, weights=np.repeat(counts[lo : lo + 2000], n), minlength=len(total))
        used = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(total[used])], names=["piece", "n"])

    rows = words.where("c > 0").select("word", "c").mapInArrow(run, "piece bigint, n double")
    out = np.zeros(_processor(vocabulary).get_piece_size())
    for r in rows.groupBy("piece").agg(F.sum("n").alias("n")).collect():
        out[r["piece"]] = r["n"]
    return out


class Lattice:
    """Log10 probabilities of words under all their segmentations."""

    def __init__(self, vocabulary: str, counts: np.ndarray, n_docs: int):
        sp = _processor(vocabulary)
        n = sp.get_piece_size()
        ids = [i for i in range(n) if not sp.is_control(i) and not sp.is_unknown(i)]
        rank = np.array([-sp.get_score(i) for i in ids])
        prior = 1.0 / (rank - rank.min() + 2.7)
        weight = counts[ids] + PRIOR_WORDS * prior / prior.sum()
        total = weight.sum() + n_docs + 1
        self.log_end = math.log((n_docs + 1) / total)
        logp = np.log(weight / total)
        pieces = [bytes([int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i) else sp.id_to_piece(i).encode() for i in ids]
        best: dict[bytes, float] = {}
        for p, x in zip(pieces, logp.tolist(), strict=True):  # a byte may also be a piece of its own
            best[p] = float(np.logaddexp(best[p], x)) if p in best else x
        lowest = float(logp.min())
        for b in range(256):
            best.setdefault(bytes([b]), lowest)
        flat = b"".join(best)
        size = np.fromiter(map(len, best), np.int64, len(best))
        end = np.cumsum(size)
        prefix, inv = prefix_hash(byte_table(11)[np.frombuffer(flat, np.uint8)])
        h = range_hash(prefix, inv, end - size, end)
        order = np.argsort(h)
        self.keys, self.logp = h[order], np.array(list(best.values()))[order]
        self.longest = int(size.max())
        self.lengths = np.unique(size)

    def words(self, words: list[bytes]) -> np.ndarray:
        """Natural-log probability of each word, the space mark before it."""
        out = np.zeros(len(words))
        mark = _SPACE.encode()
        full = [mark + w for w in words]
        size = np.fromiter(map(len, full), np.int64, len(full))
        order = np.argsort(size, kind="stable")
        at = 0
        short = int(np.searchsorted(size[order], LONG_WORD, side="right"))
        for i in order[short:].tolist():
            out[i] = self._one(full[i])
        order = order[:short]
        while at < len(order):
            # words of like length, so many that the table of a step stays small
            top = min(len(order), at + max(1, 60_000 // int(size[order[at]])))
            part = order[at:top]
            out[part] = self._batch([full[i] for i in part], size[part])
            at = top
        return out

    def _one(self, word: bytes) -> float:
        """The recursion for one long word: all pieces that end in a chunk of
        positions are looked up at once; the last ``longest`` forward values go
        on to the next chunk."""
        lengths = self.lengths
        ahead = np.full(self.longest + 1, -np.inf)  # forward values, the newest last
        ahead[-1] = 0.0
        for a in range(0, len(word), _POSITIONS):
            n = min(_POSITIONS, len(word) - a)
            first = max(0, a - self.longest)
            data = np.frombuffer(word, np.uint8, count=a + n - first, offset=first)
            prefix, inv = prefix_hash(byte_table(11)[data])
            end = np.arange(a + 1, a + n + 1) - first
            found = np.full((n, len(lengths)), -np.inf)
            for c, k in enumerate(lengths.tolist()):
                ok = np.flatnonzero(end + first >= k)
                h = range_hash(prefix, inv, end[ok] - k, end[ok])
                slot = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = self.keys[slot] == h
                found[ok[hit], c] = self.logp[slot[hit]]
            values = np.concatenate([ahead, np.empty(n)])
            back = len(ahead) - lengths
            for j in range(n):
                terms = values[back + j] + found[j]
                top = terms.max()
                values[len(ahead) + j] = top + math.log(np.exp(terms - top).sum())
            ahead = values[-len(ahead) :].copy()
        return float(ahead[-1])

    def _batch(self, words: list[bytes], size: np.ndarray) -> np.ndarray:
        n = len(words)
        data = np.frombuffer(b"".join(words), np.uint8)
        begin = np.cumsum(size) - size
        prefix, inv = prefix_hash(byte_table(11)[data])
        # the last `longest` forward values of each word, the newest in front
        alpha = np.full((n, self.longest), -np.inf)
        alpha[:, 0] = 0.0
        out = np.zeros(n)
        for j in range(1, int(size.max()) + 1):
            live = np.flatnonzero(size >= j)
            end = begin[live] + j
            terms = np.full((len(live), self.longest), -np.inf)
            for k in self.lengths[self.lengths <= j]:
                h = range_hash(prefix, inv, end - k, end)
                slot = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
                hit = self.keys[slot] == h
                terms[hit, k - 1] = alpha[live[hit], k - 1] + self.logp[slot[hit]]
            top = terms.max(axis=1)
            value = top + np.log(np.exp(terms - top[:, None]).sum(axis=1))
            alpha[live, 1:] = alpha[live, :-1]
            alpha[live, 0] = value
            done = size[live] == j
            out[live[done]] = value[done]
        return out


def score_words(words: DataFrame, vocabulary: str, counts: np.ndarray, n_docs: int) -> DataFrame:
    """``(hash, c, n, logp)`` of each distinct word."""
    piece = words.sparkSession.sparkContext.broadcast(counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattice(vocabulary, piece.value, n_docs)
        for batch in batches:
            for i, j, data, offsets in blocks(batch.column(0)):
                h = word_hashes(data, offsets[:-1], offsets[1:])
                raw = data.tobytes()
                logp = lattice.words([raw[a:b] for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), batch.column(1).slice(i, j - i), batch.column(2).slice(i, j - i), pa.array(logp)],
                    names=["hash", "c", "n", "logp"],
                )

    return words.select("word", "c", "n").mapInArrow(run, "hash bigint, c bigint, n bigint, logp double")


def _above(scored: DataFrame, most: int) -> Column:
    """True for the most frequent words, ``most`` of them at most: a threshold
    on the count, found by counting words in bins of like count (some hundred
    bins, whatever the corpus)."""
    level = F.floor(F.log2("n") * 16)
    left, low = most, math.inf
    for r in scored.groupBy(level.alias("b")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("b")).collect():
        if r["n"] > left:
            break
        left, low = left - r["n"], r["b"]
    return F.lit(False) if low == math.inf else level >= low


def score(
    docs: DataFrame, vocabulary: str, id_col: str = "doc_id", text_col: str = "text", head_words: int = HEAD_WORDS
) -> DataFrame:
    """``(id, held_out, n_tokens, n_known, train_tokens, base_score, score)``,
    one row per input row; scores are log10 probabilities."""
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
    words = stored(word_counts(docs, id_col, "text"), "lm-words")

    def count_train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int((~held_out(batch.column(0))).sum())], pa.int64())], names=["n"])

    n_train = docs.select(id_col).mapInArrow(count_train, "n bigint").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    n_words, distinct = words.where("c > 0").agg(F.coalesce(F.sum("c"), F.lit(0)), F.count(F.lit(1))).first()
    tokens, kinds = n_words + n_train, distinct + (n_train > 0)
    counts = piece_counts(words, vocabulary)
    scored = stored(score_words(words, vocabulary, counts, n_train), "lm-scores")
    log_end = Lattice(vocabulary, counts, n_train).log_end
    bottom = math.log(tokens + ALPHA * (kinds + 1)) if tokens else math.log(ALPHA)

    top = scored.where(_above(scored, head_words)).toPandas().sort_values("hash")
    key = top["hash"].to_numpy()
    base = np.log(top["c"].to_numpy() + ALPHA)
    head = spark.sparkContext.broadcast((key, base, (top["c"].to_numpy() > 0).astype(np.int64), top["logp"].to_numpy()))
    end_base = math.log(n_train + ALPHA) if n_train else math.log(ALPHA)

    def per_doc(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, hb, hk, hl = head.value
        row = TaskContext.get().partitionId() << 40

        def rows(no, kind, h, n, known, b, s, ids, held):
            cols = [pa.array(no, pa.int64()), pa.array(np.full(len(no), kind), pa.int8()), pa.array(h, pa.int64()), pa.array(n, pa.int64()),
                    pa.array(known, pa.int64()), pa.array(b, pa.float64()), pa.array(s, pa.float64()), ids, held]
            return pa.RecordBatch.from_arrays(cols, names=["row", "kind", "hash", "n", "known", "base", "logp", "id", "held"])

        for batch in batches:
            held = held_out(batch.column(0))
            id_type = batch.column(0).type
            for i, j, data, offsets in blocks(batch.column(1)):
                data = LOWER[data]
                start, end, first = find_words(data, offsets)
                h = word_hashes(data, start, end).view(np.int64)
                of = row_of(first)
                slot = np.minimum(np.searchsorted(keys, h), max(len(keys) - 1, 0))
                hit = keys[slot] == h if len(keys) else np.zeros(len(h), bool)
                s, r = slot[hit], of[hit]
                m = j - i
                no = row + np.arange(m)
                yield rows(
                    no, 0, np.zeros(m, np.int64), np.diff(first) + 1, np.bincount(r, weights=hk[s], minlength=m).astype(np.int64) + (n_train > 0),
                    np.bincount(r, weights=hb[s], minlength=m) + end_base, np.bincount(r, weights=hl[s], minlength=m) + log_end,
                    batch.column(0).slice(i, m), pa.array(held[i:j]),
                )
                if not hit.all():
                    order = np.lexsort((h[~hit], of[~hit]))
                    h2, r2 = h[~hit][order], of[~hit][order]
                    new = np.ones(len(h2), bool)
                    new[1:] = (h2[1:] != h2[:-1]) | (r2[1:] != r2[:-1])
                    at = np.flatnonzero(new)
                    n = np.diff(np.append(at, len(h2)))
                    z = np.zeros(len(at))
                    yield rows(no[r2[at]], 1, h2[at], n, z.astype(np.int64), z, z, pa.nulls(len(at), id_type), pa.nulls(len(at), pa.bool_()))
                row += m

    id_sql = docs.schema[id_col].dataType.simpleString()
    schema = f"row bigint, kind tinyint, hash bigint, n bigint, known bigint, base double, logp double, id {id_sql}, held boolean"
    parts = stored(docs.mapInArrow(per_doc, schema), "lm-parts")
    tail = parts.where("kind = 1").select("row", "hash", "n").join(scored.select("hash", "c", "logp"), "hash")
    tail = tail.groupBy("row").agg(
        F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("known"),
        F.sum(F.col("n") * F.log(F.col("c") + ALPHA)).alias("base"),
        F.sum(F.col("n") * F.col("logp")).alias("logp"),
    )
    heads = parts.where("kind = 0").drop("kind", "hash")
    t = tail.select("row", *[F.col(c).alias(f"t_{c}") for c in ("known", "base", "logp")])
    both = heads.join(t, "row", "left")
    add = lambda c, zero: F.col(c) + F.coalesce(f"t_{c}", F.lit(zero))
    ten = math.log(10)
    return both.select(
        F.col("id").alias(id_col),
        F.col("held").alias("held_out"),
        F.col("n").alias("n_tokens"),
        add("known", 0).alias("n_known"),
        F.lit(tokens).cast("bigint").alias("train_tokens"),
        ((add("base", 0.0) - F.col("n") * bottom) / ten).alias("base_score"),
        (add("logp", 0.0) / ten).alias("score"),
    )
