"""Words and word shingles of whole Arrow batches as 64-bit hashes, without a Python object per word."""

from __future__ import annotations

import numpy as np
import pyarrow as pa

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))
#: Bytes hashed at a time; bounds the scratch memory whatever the length of a text.
SLAB = 1 << 18

_rng = np.random.RandomState(20240501)
_VALUE = _rng.randint(1, 1 << 62, 256).astype(np.uint64) | np.uint64(1)
_PLACE = _rng.randint(1, 1 << 62, 64).astype(np.uint64) | np.uint64(1)
_LENGTH = np.uint64(0xD6E8FEB86659FD93)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUE_LOWER = _VALUE[_LOWER]
_INK = np.ones(256, dtype=bool)
_INK[[32, 9, 10, 11, 12, 13]] = False


def _powers(base: np.uint64) -> np.ndarray:
    out = np.full(SLAB + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _BACK = _powers(_BASE), _powers(_INVERSE)


def mix(h: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser, in place."""
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a string column and the offsets of its rows; a null row is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    raw = np.frombuffer(data, dtype=np.uint8)[off[0] : off[-1]] if data is not None and data.size else np.zeros(0, np.uint8)
    return raw, off - off[0]


def word_spans(raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and for each row the index of its first word (one more at the end)."""
    ink = _INK[raw]
    first, last = ink.copy(), ink.copy()
    if len(raw):
        first[1:] &= ~ink[:-1]
        last[:-1] &= ~ink[1:]
        at = off[:-1][off[:-1] < len(raw)]
        first[at] = ink[at]
        at = off[1:][off[1:] > 0] - 1
        last[at] = ink[at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(starts, off)


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A hash of each word's bytes: a polynomial over a byte table, finalised. A-Z count as a-z if lower."""
    table = _VALUE_LOWER if lower else _VALUE
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        at = starts[i]
        j = int(np.searchsorted(ends, at + SLAB, side="right"))
        if j <= i:  # one word of more than a slab
            total, place = np.uint64(0), np.uint64(1)
            with np.errstate(over="ignore"):
                for k in range(int(at), int(ends[i]), SLAB):
                    piece = table[raw[k : min(k + SLAB, int(ends[i]))]]
                    total = total + place * (piece * _POWER[: len(piece)]).sum(dtype=np.uint64)
                    place = place * _POWER[SLAB]
            out[i] = total
            i += 1
            continue
        stop = int(ends[j - 1])
        part = table[raw[at:stop]]
        part *= _POWER[: len(part)]
        sums = np.empty(len(part) + 1, dtype=np.uint64)
        sums[0] = 0
        np.cumsum(part, out=sums[1:])
        s = starts[i:j] - at
        out[i:j] = (sums[ends[i:j] - at] - sums[s]) * _BACK[s]
        i = j
    return mix(out)


@np.errstate(over="ignore")
def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of `size` words within a row, and the rows' offsets in them.

    A row of fewer words, but one at least, gives one hash: that of its whole sequence.
    """
    n = np.diff(first)
    runs = np.where(n >= size, n - size + 1, (n > 0).astype(n.dtype))
    offsets = np.zeros(len(n) + 1, dtype=np.int64)
    np.cumsum(runs, out=offsets[1:])
    if len(words) == 0:
        return np.zeros(0, np.uint64), offsets
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    every = np.zeros(len(words), dtype=np.uint64)
    for k in range(size):
        every += padded[k : k + len(words)] * _PLACE[k]
    every += np.uint64(size) * _LENGTH
    begin = np.repeat(first[:-1], runs) + (np.arange(offsets[-1]) - np.repeat(offsets[:-1], runs))
    out = every[begin]
    for row in np.flatnonzero((n > 0) & (n < size)):
        own = words[first[row] : first[row + 1]]
        out[offsets[row]] = (own * _PLACE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own)) * _LENGTH
    return mix(out), offsets


#: Rows whose words are held at a time.
ROWS = 500


def shingle_sets(column: pa.Array, size: int = 5):
    """Yields the sorted distinct shingle hashes of each row."""
    for k in range(0, len(column), ROWS):
        yield from _shingle_sets(column.slice(k, ROWS), size)


def _shingle_sets(column: pa.Array, size: int):
    raw, off = text_bytes(column)
    starts, ends, first = word_spans(raw, off)
    hashes, offsets = shingle_hashes(word_hashes(raw, starts, ends), first, size)
    for i in range(len(off) - 1):
        own = hashes[offsets[i] : offsets[i + 1]]
        if len(own) > 1:
            own = np.sort(own)
            keep = np.empty(len(own), dtype=bool)
            keep[0] = True
            np.not_equal(own[1:], own[:-1], out=keep[1:])
            own = own[keep]
        yield own
