"""Cost-balanced packing of all documents into training sequences.

A document's cost is linear in its tokens plus quadratic in the tokens that attend to each other.
Documents stream through a task in groups of a bounded number of tokens. In a group, whole sequences
are cut off the longest documents first; the other pieces, by descending cost, go to the sequence of
the lowest cost so far that has room for them. A piece that fits nowhere whole is cut at the
lowest-cost one, so every sequence of a group is full. What is left over moves on to the task's next
group. What the tasks have left at their ends, less than a sequence each, is packed in the same way
by a second pass of few tasks; only what these have left is cut into sequences whose lengths are
powers of two, which need no padding.

No text is shuffled and memory is bounded by the group; a word of any length is read in time near to
linear. Null and empty texts are documents of one token, the end token. Repeated rows, and rows of
one id or of none, are separate documents; ties in cost go by place in the table. An empty table
gives an empty one. sequence_id is the pass and the task's number times 2 ** 33 plus a count.
"""

from __future__ import annotations

import heapq
import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, lean, need
from millrace.llm.fast_bpe import words_of

CAPACITY = 4096
#: Fixed value: the id that ends each document.
END = 2
#: Sequences that are filled together.
GROUP = 256
#: Rows tokenized at a time.
ROWS = 512
#: Cost of a piece of n tokens: n + QUADRATIC n^2.
QUADRATIC = 1 / 4096


def cost(n: int) -> float:
    return n + QUADRATIC * n * n


def fill(pieces: list[tuple[int, int, int]], sequences: int, capacity: int = CAPACITY) -> list[list[tuple[int, int, int]]]:
    """Places pieces (document, start, length), of which there are tokens for all sequences and no more, so that each is full."""
    out: list[list] = [[] for _ in range(sequences)]
    room, spent = np.full(sequences, capacity), np.zeros(sequences)
    todo = [(-length, doc, start) for doc, start, length in pieces if length]
    heapq.heapify(todo)
    while todo:
        length, doc, start = heapq.heappop(todo)
        length = -length
        fits = room >= length
        # The lowest-cost sequence with room for the whole piece; if there is none, the lowest-cost one with any.
        chosen = int(np.where(fits if fits.any() else room > 0, spent, np.inf).argmin())
        n = min(length, int(room[chosen]))
        out[chosen].append((doc, start, n))
        room[chosen] -= n
        spent[chosen] += cost(n)
        if n < length:
            heapq.heappush(todo, (n - length, doc, start + n))
    return out


def pack_group(lengths: list[int], capacity: int = CAPACITY, last: bool = False) -> tuple[list[list[tuple[int, int, int]]], list[tuple[int, int, int]]]:
    """(full sequences, pieces left over) of documents of these lengths; if last, nothing is left over."""
    full, pieces = [], []
    for doc, n in enumerate(lengths):
        for k in range(n // capacity):
            full.append([(doc, k * capacity, capacity)])
        if n % capacity:
            pieces.append((doc, n - n % capacity, n % capacity))
    pieces.sort(key=lambda p: (-p[2], p[0]))
    sequences = sum(p[2] for p in pieces) // capacity
    # The shortest pieces wait for the next group: cut off what exceeds whole sequences.
    spare = sum(p[2] for p in pieces) - sequences * capacity
    rest: list[tuple[int, int, int]] = []
    while spare:
        doc, start, n = pieces.pop()
        if n <= spare:
            rest.append((doc, start, n))
            spare -= n
        else:
            pieces.append((doc, start, n - spare))
            rest.append((doc, start + n - spare, spare))
            spare = 0
    full += fill(pieces, sequences, capacity)
    if last:
        size = 1 << capacity.bit_length()
        while rest:
            have = sum(p[2] for p in rest)
            while size > have:
                size >>= 1
            own, need_ = [], size
            while need_:
                doc, start, n = rest.pop(0)
                take = min(n, need_)
                own.append((doc, start, take))
                need_ -= take
                if take < n:
                    rest.insert(0, (doc, start + take, n - take))
            full.append(own)
    return full, rest


_NAMES = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
#: Tasks' rests that one task of the second pass packs: less than so many sequences.
RESTS = 256


class _Packer:
    """Documents, or parts of them, that wait in a task, and the rows that packing makes of them."""

    def __init__(self, number: int, capacity: int, with_ids: bool):
        self.number, self.capacity, self.with_ids, self.held = number, capacity, with_ids, 0
        # Id, first token held, its tokens, tokens of the whole document.
        self.waiting: list[tuple[int | None, int, bytes, int]] = []

    def add(self, doc_id: int | None, start: int, tokens: bytes, total: int) -> None:
        self.waiting.append((doc_id, start, tokens, total))
        self.held += len(tokens) // 2

    def give(self, last: bool) -> pa.RecordBatch:
        """The rows of all full sequences; if last, of what is left too."""
        sequences, rest = pack_group([len(w[2]) // 2 for w in self.waiting], self.capacity, last)
        rows: list[list] = [[] for _ in _NAMES]
        ids = []
        for own in sequences:
            offset = 0
            for doc, start, n in own:
                doc_id, first, tokens, total = self.waiting[doc]
                part = np.frombuffer(tokens, dtype="<u2", count=n, offset=2 * start).astype("<u4")
                for column, x in zip(rows, (doc_id, first + start, n, zlib.crc32(part.tobytes()), total, self.number, offset), strict=True):
                    column.append(x)
                if self.with_ids:
                    ids.append(part.astype(np.int32))
                offset += n
            self.number += 1
        self.waiting = [(w[0], w[1] + s, w[2][2 * s : 2 * (s + n)], w[3]) for d, s, n in rest for w in (self.waiting[d],)]
        self.held = sum(len(w[2]) // 2 for w in self.waiting)
        arrays = [pa.array(x, pa.int64()) for x in rows]
        if self.with_ids:
            arrays.append(pa.array(ids, pa.list_(pa.int32())))
        return pa.RecordBatch.from_arrays([*arrays, pa.nulls(len(rows[0]), pa.binary())], names=self.names())

    def names(self) -> list[str]:
        return [*_NAMES, *["ids"] * self.with_ids, "tokens"]

    def rest(self) -> pa.RecordBatch:
        """What waits, as rows with their tokens and without a sequence."""
        w, n = self.waiting, len(self.waiting)
        given = [[x[0] for x in w], [x[1] for x in w], [len(x[2]) // 2 for x in w], [0] * n, [x[3] for x in w], [-1] * n, [0] * n]
        arrays = [pa.array(x, pa.int64()) for x in given] + [pa.nulls(n, pa.list_(pa.int32()))] * self.with_ids
        return pa.RecordBatch.from_arrays([*arrays, pa.array([x[2] for x in w], pa.binary())], names=self.names())


def _pack(path: str, capacity: int, group: int, with_ids: bool):
    """The first pass: full sequences, and the rest of the task."""

    def run(batches):
        words = words_of(path)
        end = np.array([END], dtype="<u2").tobytes()
        own = _Packer(TaskContext.get().partitionId() << 33, capacity, with_ids)
        for batch in batches:
            for k in range(0, batch.num_rows, ROWS):
                part = batch.slice(k, ROWS)
                flat, off = words.ids(part.column(1))
                for i, doc_id in enumerate(part.column(0).to_pylist()):
                    tokens = flat[off[i] : off[i + 1]].astype("<u2").tobytes() + end
                    own.add(doc_id, 0, tokens, len(tokens) // 2)
                    if own.held >= group * capacity:
                        yield own.give(False)
        if own.waiting:
            yield own.give(False)
        if own.waiting:
            yield own.rest()

    return run


def _pack_rests(capacity: int, group: int, with_ids: bool):
    """The second pass, over rows of rests."""

    def run(batches):
        own = _Packer(1 << 61 | TaskContext.get().partitionId() << 33, capacity, with_ids)
        for batch in batches:
            for doc_id, start, total, tokens in zip(*(batch.column(i).to_pylist() for i in (0, 1, 4, batch.num_columns - 1)), strict=True):
                own.add(doc_id, start, tokens, total)
                if own.held >= group * capacity:
                    yield own.give(False)
        if own.waiting:
            yield own.give(True)

    return run


def pack(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, group: int = GROUP, with_ids: bool = False) -> DataFrame:
    """One row a piece of docs(doc_id, text): doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset; its ids if asked for."""
    rows = need(docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    kind = ", ".join(f"{c} long" for c in _NAMES) + ", ids array<int>" * with_ids + ", tokens binary"
    first = cut(rows.mapInArrow(lean(_pack(tokenizer_path, capacity, group, with_ids)), kind))
    rests = first.where("sequence_id < 0")
    tokens = rests.agg(F.coalesce(F.sum("length"), F.lit(0)).alias("n")).first()["n"]
    rests = rests.repartition(max(1, -(-tokens // (RESTS * capacity))), F.xxhash64("doc_id", "start", "doc_tokens", "tokens"))
    second = rests.mapInArrow(lean(_pack_rests(capacity, group, with_ids)), kind)
    return first.where("sequence_id >= 0").unionByName(second).drop("tokens")
