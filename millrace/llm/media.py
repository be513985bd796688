"""Texts as 8-bit WAV media, read back, with short-time Fourier transforms and peak-pair fingerprints.

The payload is the UTF-8 text with zero bytes up to a positive multiple of 64; each byte is one
sample of a mono 8-bit WAV made and read by the wave module. Frames of the samples read back are
Hann-windowed and transformed; every tile of some frames by some bins gives one peak, its loudest
point, and each peak is paired with the peaks of its own and the next higher band one tile later, and
with that of the next higher band in its own tile, so that one tile has pairs too. A pair is one
number: the frame of its first peak, then that peak's bin, the other's bin and the frames between
them, so that an array of pairs is coded by time. Of two peaks in one frame the lower one is first.

Media are stored as a column of a table (`store`), from which the samples are read back (`features`).
Null texts count as empty (64 zero bytes). Long texts are transformed in slabs of frames. Repeated
rows each have a row; of equally loud points the earlier, then the lower one is the peak. Equal texts
have equal media and fingerprints. An empty table gives an empty one.
"""

from __future__ import annotations

import hashlib
import io
import wave
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, need

RATE, FRAME, HOP = 8000, 256, 128
#: Frames and bins of a tile; bin 0 (the mean) is left out, which leaves 128 bins.
TILE_FRAMES, TILE_BINS = 8, 16
#: Tiles transformed at a time.
SLAB = 512

_HANN = (0.5 - 0.5 * np.cos(2 * np.pi * np.arange(FRAME) / FRAME)).astype(np.float32)


def payload_of(text: bytes) -> bytes:
    return text + bytes(-len(text) % 64 if text else 64)


def to_wav(payload: bytes) -> bytes:
    held = io.BytesIO()
    with wave.open(held, "wb") as w:
        w.setnchannels(1)
        w.setsampwidth(1)
        w.setframerate(RATE)
        w.writeframes(payload)
    return held.getvalue()


def from_wav(media: bytes) -> bytes:
    with wave.open(io.BytesIO(media), "rb") as r:
        if (r.getnchannels(), r.getsampwidth()) != (1, 1):
            raise ValueError("not mono 8-bit")
        return r.readframes(r.getnframes())


def peaks(samples: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Frame and bin of the peak of each tile, as arrays (tiles in time, bands)."""
    frames = max(1, -(-(len(samples) - FRAME) // HOP) + 1)
    tiles = -(-frames // TILE_FRAMES)
    need_ = (tiles * TILE_FRAMES - 1) * HOP + FRAME
    padded = np.full(need_, 128, dtype=np.uint8)  # 128 is silence in 8-bit WAV
    padded[: len(samples)] = samples
    views = np.lib.stride_tricks.sliding_window_view(padded, FRAME)[::HOP]
    at_frame, at_bin = [], []
    for k in range(0, tiles, SLAB):
        part = views[k * TILE_FRAMES : (k + SLAB) * TILE_FRAMES].astype(np.float32) - np.float32(128)
        spectrum = np.fft.rfft(part * _HANN, axis=1)[:, 1:]
        loud = spectrum.real**2 + spectrum.imag**2
        n = len(loud) // TILE_FRAMES
        grid = loud.reshape(n, TILE_FRAMES, -1, TILE_BINS).swapaxes(1, 2).reshape(n, -1, TILE_FRAMES * TILE_BINS)
        best = grid.argmax(axis=2)
        at_frame.append(best // TILE_BINS + (np.arange(k, k + n) * TILE_FRAMES)[:, None])
        at_bin.append(best % TILE_BINS + (np.arange(grid.shape[1]) * TILE_BINS)[None, :] + 1)
    return np.concatenate(at_frame), np.concatenate(at_bin)


def fingerprint(samples: np.ndarray) -> np.ndarray:
    """Peak pairs as numbers: frame << 32 | bin << 16 | other bin << 8 | frames between, in order of time."""
    when, what = (x.astype(np.int64) for x in peaks(samples))
    out = []
    for up in (0, 1):
        one, two = np.s_[:-1, : what.shape[1] - up], np.s_[1:, up:]
        out.append((when[one] << 32 | what[one] << 16 | what[two] << 8 | (when[two] - when[one])).ravel())
    gap = when[:, 1:] - when[:, :-1]  # within a tile the higher band's peak may be the earlier one
    low, high = what[:, :-1], what[:, 1:]
    one, two = np.where(gap >= 0, low, high), np.where(gap >= 0, high, low)
    out.append((np.minimum(when[:, :-1], when[:, 1:]) << 32 | one << 16 | two << 8 | np.abs(gap)).ravel())
    return np.sort(np.concatenate(out))


_NAMES = ["payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "fingerprint"]


def _store(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            raw = [(text or "").encode() for text in part.column(part.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(map(len, raw), pa.int64()), pa.array([to_wav(payload_of(x)) for x in raw], pa.binary())], names=[*part.schema.names[:-1], "n_bytes", "media"])


def _features(batches):
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            rows: list[list] = [[] for _ in _NAMES]
            for media_ in part.column(part.num_columns - 1):
                media_ = media_.as_py()
                back = from_wav(media_)
                values = (len(back), hashlib.sha256(back).hexdigest(), zlib.crc32(back[-64:]), len(media_), hashlib.sha256(media_).hexdigest(), fingerprint(np.frombuffer(back, dtype=np.uint8)))
                for column, x in zip(rows, values, strict=True):
                    column.append(x)
            arrays = [pa.array(x, pa.string() if n.endswith("sha256") else pa.int64()) for n, x in zip(_NAMES[:-1], rows, strict=False)]
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in rows[-1]])]).astype(np.int32)
            arrays.append(pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate(rows[-1]) if rows[-1] else np.zeros(0, np.int64))))
            yield pa.RecordBatch.from_arrays([*part.columns, *arrays], names=[*part.schema.names, *_NAMES])


def _kind(rows: DataFrame, leave: str | None = None) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if f.name != leave)


def store(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs(text, ...), n_bytes and media, the text as WAV: to be written as a table."""
    rows = need(docs, *keep, "text")
    return rows.mapInArrow(_store, f"{_kind(rows, 'text')}, n_bytes long, media binary")


def features(stored: DataFrame) -> DataFrame:
    """The columns of a stored table (media last) with what is read back from its media, and the fingerprint."""
    kind = f"{_kind(stored)}, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, fingerprint array<long>"
    return stored.mapInArrow(_features, kind)


def media(docs: DataFrame, keep: list[str]) -> DataFrame:
    """store() written to the shared folder, and features() of what was written: with media and fingerprint columns."""
    return features(cut(store(docs, keep)))


def digest(df: DataFrame) -> DataFrame:
    """A feature column: the fingerprint's number of pairs and a hash of them. The media, which the stored table has, are left out."""
    return df.withColumn("feature", F.concat_ws(":", F.size("fingerprint").cast("string"), F.hex(F.xxhash64("fingerprint")))).drop("media")
