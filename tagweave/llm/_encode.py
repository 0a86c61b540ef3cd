"""Token ids of whole texts through the tokenizers library, a block of texts
at a time.

The vocabulary's tokenizer drops white space and never joins text across it,
so a text's ids are its words' ids in a row.  Each distinct word of a block is
encoded once and kept in a bounded cache of the worker; texts are put together
from it with array operations.  Words that need no normalisation beyond lower
case are cut with the tokenizer's own pattern and their pieces encoded in one
call; all other words go through the whole tokenizer."""

from __future__ import annotations

import os
from functools import lru_cache

import numpy as np
import regex
from tokenizers import Tokenizer, pre_tokenizers

from ._text import WORD_BYTES, find_words, mix64, ragged, word_hashes

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task has one core

# Fixed value: the split pattern of the vocabulary file.
_PATTERN = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")
_PLAIN = regex.compile(r"[!-~¡-įı-ɏ]*")
_MARK = "\x01"
WORD_CACHE = 1 << 18
PIECE_CACHE = 1 << 16
_AT_ONCE = 100  # words that the library is given in one text


def _ids(tokenizer: Tokenizer, text: str) -> list[int]:
    """Ids alone: the library's fast form keeps no offsets."""
    return tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids


class _Slots:
    """Places of 64-bit keys in a table of twice ``WORD_CACHE`` slots: a key
    stands at the first slot from its own on that was free."""

    def __init__(self, bits: int = WORD_CACHE.bit_length()):
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.zeros(1 << bits, np.uint64)
        self.used = np.zeros(1 << bits, bool)
        self.n = 0

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return (mix64(keys) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each key, -1 where there is none."""
        slot = self._home(keys)
        todo = np.flatnonzero((self.keys[slot] != keys) | ~self.used[slot])
        while len(todo):
            at = slot[todo]
            todo, free = todo[self.used[at]], todo[~self.used[at]]
            slot[free] = -1
            slot[todo] = (slot[todo] + 1) & self.mask
            at = slot[todo]
            todo = todo[(self.keys[at] != keys[todo]) | ~self.used[at]]
        return slot

    def add(self, keys: np.ndarray) -> np.ndarray:
        """Slots of new, distinct keys."""
        self.n += len(keys)
        slot, todo = self._home(keys), np.arange(len(keys))
        while len(todo):
            at = slot[todo]
            free = ~self.used[at]
            self.keys[at[free]] = keys[todo[free]]  # of those that want one slot the last gets it
            self.used[at[free]] = True
            todo = todo[self.keys[at] != keys[todo]]
            slot[todo] = (slot[todo] + 1) & self.mask
        return slot


class WordEncoder:
    def __init__(self, path: str):
        self.full = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)
        self.bare.normalizer = None
        self.bare.pre_tokenizer = pre_tokenizers.Sequence(
            [pre_tokenizers.WhitespaceSplit(), pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)]
        )
        vocab = self.full.get_vocab(with_added_tokens=True)
        self.dtype = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        suffix = getattr(self.full.model, "end_of_word_suffix", None) or ""
        self.is_end = np.zeros(max(vocab.values()) + 1, dtype=bool)
        self.is_end[[i for t, i in vocab.items() if suffix and t.endswith(suffix)]] = True
        self.quick = bool(suffix) and '"' + _PATTERN.pattern.replace("\\", "\\\\") + '"' in self.full.to_str()
        special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.special = regex.compile("|".join(map(regex.escape, special)) or r"(?!)")
        self.quick &= not any(s.isalpha() for s in special)
        mark = self.full.encode(_MARK, add_special_tokens=False).ids
        self.mark = mark[0] if len(mark) == 1 else None
        self.pieces: dict[str, bytes] = {}
        self.clear()

    def clear(self) -> None:
        self.slots = _Slots()
        size = len(self.slots.keys)
        self.at, self.n, self.hits = np.zeros(size, np.int64), np.zeros(size, np.int32), np.zeros(size, np.int8)
        self.pool, self.end = np.zeros(1 << 16, self.dtype), 0

    def forget(self) -> None:
        """Make room: only words that came back in later blocks stay."""
        keep = np.flatnonzero(self.slots.used & (self.hits > 1))
        keys, at, n, hits, pool = self.slots.keys[keep], self.at[keep], self.n[keep], self.hits[keep], self.pool
        self.clear()
        if len(keep) * 2 <= WORD_CACHE:
            self._keep(keys, n, pool[ragged(at, n)])
            self.hits[self.slots.find(keys)] = hits // 2

    def _keep(self, keys: np.ndarray, n: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """Slots of new words, with their ids one after the other."""
        slot = self.slots.add(keys)
        if self.end + len(ids) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.end], np.zeros(self.end // 2 + 2 * len(ids), self.dtype)])
        self.pool[self.end : self.end + len(ids)] = ids
        self.at[slot], self.n[slot] = self.end + np.cumsum(n) - n, n
        self.end += len(ids)
        return slot

    def _grow(self, n: int) -> None:
        used = np.flatnonzero(self.slots.used)
        keys, rest = self.slots.keys[used], [x[used] for x in (self.at, self.n, self.hits)]
        self.slots = _Slots((2 * n).bit_length())
        slot = self.slots.add(keys)
        self.at, self.n, self.hits = (np.zeros(len(self.slots.keys), x.dtype) for x in rest)
        self.at[slot], self.n[slot], self.hits[slot] = rest

    def _pack(self, ids) -> bytes:
        return np.asarray(ids, dtype=self.dtype).tobytes()

    def _whole(self, words: list[str]) -> list[bytes]:
        """Through the whole tokenizer: joined with a mark of known id between
        the words, or one by one where a word holds the mark."""
        out: list[bytes] = [b""] * len(words)
        joined = [i for i, w in enumerate(words) if self.mark is not None and _MARK not in w]
        for at in range(0, len(joined), _AT_ONCE):
            part = joined[at : at + _AT_ONCE]
            ids = np.asarray(_ids(self.full, f" {_MARK} ".join([words[i] for i in part])), dtype=np.int64)
            cut = np.flatnonzero(ids == self.mark)
            if len(cut) == len(part) - 1:
                for i, run in zip(part, np.split(ids, cut), strict=True):
                    out[i] = self._pack(run if i == part[0] else run[1:])
            else:
                for i in part:
                    out[i] = self._pack(self.full.encode(words[i], add_special_tokens=False).ids)
        for i in set(range(len(words))) - set(joined):
            out[i] = self._pack(self.full.encode(words[i], add_special_tokens=False).ids)
        return out

    def _encode_pieces(self, pieces: list[str]) -> None:
        for at in range(0, len(pieces), _AT_ONCE):
            part = pieces[at : at + _AT_ONCE]
            ids = np.asarray(_ids(self.bare, " ".join(part)), dtype=np.int64)
            ends = np.flatnonzero(self.is_end[ids]) + 1
            if len(ends) != len(part):
                for p in part:
                    self.pieces[p] = self._pack(self.bare.encode(p, add_special_tokens=False).ids)
            else:
                raw, at_byte = self._pack(ids), (ends * self.dtype.itemsize).tolist()
                self.pieces.update(zip(part, [raw[a:b] for a, b in zip([0, *at_byte[:-1]], at_byte, strict=True)], strict=True))

    def words(self, words: list[str]) -> list[bytes]:
        """Ids of each word, as bytes."""
        if len(self.pieces) > PIECE_CACHE:
            self.pieces.clear()
        known, plain, find, special = self.pieces, _PLAIN.fullmatch, _PATTERN.findall, self.special.search
        cut: list[str | list[str] | None] = []  # one piece, several, or through the whole tokenizer
        for w in words:
            low = w.lower()
            if low.isalpha():
                cut.append(low if low.isascii() or plain(low) else None)
            elif plain(low) and not special(w):
                cut.append(find(low))
            else:
                cut.append(None)
        if not self.quick:
            cut = [None] * len(words)
        pieces = {c for c in cut if type(c) is str}
        for c in cut:
            if type(c) is list:
                pieces.update(c)
        missing = [p for p in pieces if p not in known]
        if missing:
            self._encode_pieces(missing)
        slow = iter(self._whole([w for w, c in zip(words, cut, strict=True) if c is None]))
        return [known[c] if type(c) is str else next(slow) if c is None else b"".join([known[p] for p in c]) for c in cut]

    def block(self, data: np.ndarray, offsets: np.ndarray, end_id: int | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, offsets)`` of a block of texts, ``end_id`` after each."""
        start, end, first = find_words(data, offsets, WORD_BYTES)
        h = word_hashes(data, start, end)
        if self.slots.n > WORD_CACHE:
            self.forget()
        slot = self.slots.find(h)
        new = np.flatnonzero(slot < 0)
        seen = slot[slot >= 0]
        self.hits[seen] = np.minimum(self.hits[seen], 100) + 1  # once a block
        if len(new):
            uniq, where, back = np.unique(h[new], return_index=True, return_inverse=True)
            fresh = new[where]
            raw = data.tobytes()
            text = b" ".join([raw[a:b] for a, b in zip(start[fresh].tolist(), end[fresh].tolist(), strict=True)])
            got = self.words(text.decode("utf-8", "replace").split(" "))
            n = np.fromiter((len(g) for g in got), np.int64, len(got)) // self.dtype.itemsize
            if self.slots.n + len(uniq) > 3 * len(self.slots.keys) // 4:
                # a block of very many words: it has a table of its own size until words are forgotten
                self._grow(self.slots.n + len(uniq))
                slot = self.slots.find(h)
            slot[new] = self._keep(uniq, n, np.frombuffer(b"".join(got), dtype=self.dtype))[back]
        n_word = self.n[slot].astype(np.int64)
        total = np.zeros(len(n_word) + 1, np.int64)
        np.cumsum(n_word, out=total[1:])
        ids = self.pool[ragged(self.at[slot], n_word)]
        bounds = total[first]
        if end_id is not None:
            words, bounds = ids, bounds + np.arange(len(bounds))
            ids = np.full(len(words) + len(bounds) - 1, end_id, self.dtype)
            inside = np.ones(len(ids), bool)
            inside[bounds[1:] - 1] = False
            ids[inside] = words
        return ids, bounds


@lru_cache(maxsize=1)
def encoder(path: str) -> WordEncoder:
    """One encoder for each Python worker."""
    return WordEncoder(path)
