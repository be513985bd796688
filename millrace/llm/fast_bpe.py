"""Token ids of a byte-pair vocabulary with word ends, by words: each distinct word is merged once.

Words are runs without ASCII white space, known by 64-bit hashes. Those that a worker has not met
are merged together: for a batch of pieces the pair of the lowest rank is found and merged in all of
them at once, in numpy. Words of other than plain Latin letters, with an apostrophe, of more than LONG
bytes, or holding a special token go through the tokenizer itself, which no run without white space can tell from the
whole text.
"""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa

from millrace.llm import hashing

#: Distinct words that a worker keeps, and words merged together.
KEPT, BATCH = 120_000, 8192
#: Places of words that are merged together: bounds the scratch memory.
PLACES = 600_000
#: Bytes of a word above which it goes through the tokenizer, as merging by arrays looks through it at each merge.
LONG = 256
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ASCII = np.zeros(256, dtype=bool)
_ASCII[33:127] = True
_ASCII[39] = False
#: Kinds of bytes by which a word falls into pieces: 1 letters, 2 digits, 0 the rest.
_KIND = np.zeros(256, dtype=np.uint8)
_KIND[97:123] = 1
_KIND[48:58] = 2


def _byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    kept = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out, spare = {b: chr(b) for b in kept}, 256
    for b in range(256):
        if b not in out:
            out[b] = chr(spare)
            spare += 1
    return [out[b] for b in range(256)]


class Words:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab, letters = model["vocab"], _byte_letters()
        self.inner = np.array([vocab[c] for c in letters], dtype=np.int64)
        self.last = np.array([vocab[c + "</w>"] for c in letters], dtype=np.int64)
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        left = np.array([vocab[a] for a, _ in merges], dtype=np.int64)
        right = np.array([vocab[b] for _, b in merges], dtype=np.int64)
        self.made = np.array([vocab[a + b] for a, b in merges] + [0], dtype=np.int64)
        self.none = len(merges)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._table(left << 20 | right)
        self.forget()

    def _table(self, keys: np.ndarray) -> None:
        """An open-addressing table of pairs, so that ranks can be looked up by arrays."""
        self.bits = 18
        size = 1 << self.bits
        self.slot_key, self.slot_rank = np.full(size, -1, dtype=np.int64), np.full(size, self.none, dtype=np.int32)
        todo, self.probes = np.arange(len(keys)), 0
        while len(todo):
            at = (self._home(keys[todo]) + self.probes) & (size - 1)
            free = self.slot_key[at] < 0
            _, first = np.unique(np.where(free, at, size + np.arange(len(at))), return_index=True)
            take = np.zeros(len(todo), dtype=bool)
            take[first] = True
            take &= free
            self.slot_key[at[take]], self.slot_rank[at[take]] = keys[todo[take]], todo[take]
            todo = todo[~take]
            self.probes += 1

    def _home(self, key: np.ndarray) -> np.ndarray:
        return ((key.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        key = left << 20 | right
        home = self._home(key)
        out = np.full(len(key), self.none, dtype=np.int32)
        open_, k = np.arange(len(key)), 0
        while len(open_) and k < self.probes:
            at = (home[open_] + k) & ((1 << self.bits) - 1)
            found = self.slot_key[at]
            hit = found == key[open_]
            out[open_[hit]] = self.slot_rank[at[hit]]
            open_ = open_[~hit & (found >= 0)]
            k += 1
        return out

    def merge(self, raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of pieces of raw, one after the other, and the number of each piece's ids."""
        counts = np.zeros(len(begin), dtype=np.int64)
        order = np.argsort(length, kind="stable")
        parts, at = [], 0
        while at < len(order):
            rows = order[at : at + BATCH]
            most = int(np.searchsorted(length[rows], max(4, int(length[rows[0]]) * 5 // 4), side="right"))
            rows = rows[: max(1, min(most, PLACES // int(length[rows[max(0, most - 1)]])))]
            at += len(rows)
            ids, alive = self._merge(raw, begin[rows], length[rows])
            counts[rows] = alive.sum(axis=1)
            parts.append((rows, ids[alive]))
        ends = np.cumsum(counts)
        out = np.zeros(int(ends[-1]) if len(ends) else 0, dtype=np.uint16)
        for rows, ids in parts:
            n = counts[rows]
            out[np.repeat(ends[rows] - n - (np.cumsum(n) - n), n) + np.arange(len(ids))] = ids
        return out, counts

    def _merge(self, raw: np.ndarray, begin: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a batch of pieces as a matrix, and which of its places are ids."""
        width, every = int(lengths.max()), np.arange(len(begin))
        place = np.arange(width)[None, :]
        flat = raw[np.minimum(begin[:, None] + place, len(raw) - 1)]
        ids = self.inner[flat]
        ids[every, lengths - 1] = self.last[flat[every, lengths - 1]]
        alive = place < lengths[:, None]
        ranks = np.full((len(begin), width), self.none, dtype=np.int32)
        if width > 1:
            pair = alive[:, 1:]
            ranks[:, :-1][pair] = self.rank(ids[:, :-1][pair], ids[:, 1:][pair])
        after = np.where(place + 1 < lengths[:, None], place + 1, -1).astype(np.int32)
        before = (place - 1 + np.zeros((len(begin), 1), dtype=np.int64)).astype(np.int32)
        work = every
        while len(work):
            own = ranks[work]
            p = own.argmin(axis=1)
            best = own[np.arange(len(work)), p]
            busy = best < self.none
            work, p, best = work[busy], p[busy], best[busy]
            if not len(work):
                break
            gone = after[work, p]
            ids[work, p] = self.made[best]
            alive[work, gone] = False
            ranks[work, gone] = self.none
            nxt, prv = after[work, gone], before[work, p]
            after[work, p] = nxt
            has = nxt >= 0
            before[work[has], nxt[has]] = p[has]
            new = np.full(len(work), self.none, dtype=np.int32)
            new[has] = self.rank(ids[work[has], p[has]], ids[work[has], nxt[has]])
            ranks[work, p] = new
            has = prv >= 0
            ranks[work[has], prv[has]] = self.rank(ids[work[has], prv[has]], ids[work[has], p[has]])
        return ids, alive

    def learn(self, raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The ids of words of raw, one after the other, and the number of each word's ids."""
        length = end - begin
        ends = np.cumsum(length)
        flat = raw[np.repeat(begin - (ends - length), length) + np.arange(int(ends[-1]))]
        word = np.repeat(np.arange(len(begin)), length)
        # Plain words: printable ASCII without an apostrophe, and the letters that UTF-8 writes with byte C3.
        lead = flat == 0xC3
        tail = np.zeros(len(flat), dtype=bool)
        tail[1:] = lead[:-1]
        odd = ~(_ASCII[flat] | lead | tail) | (tail & ((flat == 0x97) | (flat == 0xB7)))
        plain = (np.bincount(word, odd, len(begin)) == 0) & (length <= LONG)
        for k in np.flatnonzero(plain & (np.bincount(word, flat == 0x7C, len(begin)) > 0)):
            if any(s in bytes(flat[ends[k] - length[k] : ends[k]]).decode() for s in self.special):
                plain[k] = False
        flat = np.where(tail & (flat >= 0x80) & (flat <= 0x9E), flat + 32, _LOWER[flat]).astype(np.uint8)
        kind = np.where(lead | tail, 1, _KIND[flat])
        first = np.ones(len(flat), dtype=bool)  # a digit stands alone; else a piece is a run of one kind
        first[1:] = (word[1:] != word[:-1]) | (kind[1:] != kind[:-1]) | (kind[1:] == 2)
        keep = plain[word]
        starts = np.flatnonzero(first & keep)
        stops = np.append(np.flatnonzero(first), len(flat))
        stops = stops[np.searchsorted(stops, starts, side="right")]
        ids, by_piece = self.merge(flat, starts, stops - starts)
        counts = np.bincount(word[starts], by_piece, len(begin)).astype(np.int64)
        if plain.all():
            return ids, counts
        other = {int(k): np.array(self.tokenizer.encode(bytes(raw[begin[k] : end[k]]).decode(), add_special_tokens=False).ids, dtype=np.uint16) for k in np.flatnonzero(~plain)}
        for k, own in other.items():
            counts[k] = len(own)
        out, at = np.zeros(int(counts.sum()), dtype=np.uint16), np.cumsum(counts) - counts
        for k, own in other.items():
            out[at[k] : at[k] + len(own)] = own
        out[np.repeat(plain, counts)] = ids
        return out, counts

    def ids(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts of a column, special tokens not added, and the offsets of the texts in them."""
        raw, off = hashing.text_bytes(column)
        starts, ends, first = hashing.word_spans(raw, off)
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(len(off), np.int64)
        distinct, where, which = np.unique(hashing.word_hashes(raw, starts, ends, lower=False), return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT:
            self.forget()
        names = distinct.tolist()
        slot = np.array([self.known.get(x, -1) for x in names], dtype=np.int64)
        new = np.flatnonzero(slot < 0)
        if len(new):
            ids, counts = self.learn(raw, starts[where[new]], ends[where[new]])
            slot[new] = len(self.known) + np.arange(len(new))
            self.known.update((names[i], int(slot[i])) for i in new.tolist())
            self.begin = np.concatenate([self.begin, len(self.pool) + np.cumsum(counts) - counts])
            self.count = np.concatenate([self.count, counts])
            self.pool = np.concatenate([self.pool, ids])
        slot = slot[which]
        n = self.count[slot]
        stop = np.cumsum(n)
        out = self.pool[np.repeat(self.begin[slot] - (stop - n), n) + np.arange(int(stop[-1]))]
        return out, np.concatenate([[0], stop])[first]

    def forget(self) -> None:
        self.known: dict[int, int] = {}
        self.begin, self.count, self.pool = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint16)


@lru_cache(maxsize=2)
def words_of(path: str) -> Words:
    """One per worker and vocabulary; workers are used again by later tasks."""
    return Words(path)
