"""Token counts by greedy longest match, in one pass a word: a trie with failure links (LinMaxMatch).

Song et al. 2021. Each trie node v holds what the longest-match procedure must have given out once no
child of v fits the next character: here only how many pieces (pops), and the node of what is left
over (its failure link). Both are computed once, from shorter to longer strings, so that no piece is
ever built and no character is read twice.

The vocabulary is that of a sentence-piece model: pieces at a word's start carry the mark U+2581.
A character that no piece has counts as its UTF-8 bytes (the model's byte fallback). Words are runs
without ASCII white space; each distinct word of a batch is walked once. Null texts have no words.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from millrace.llm import hashing
from millrace.llm.common import need

#: Fixed value: the mark of a word's start.
MARK = "▁"
#: Distinct words whose counts a worker keeps.
KEPT = 250_000


class Automaton:
    def __init__(self, vocabulary: list[str]):
        """Nodes by string: child (node << 21 | character -> node), pops and fail of each, and tail: pieces that finish a word there."""
        self.child: dict[int, int] = {}
        parent, letter, is_piece = [0], [""], [False]
        for piece in vocabulary:
            v = 0
            for c in piece:
                key = v << 21 | ord(c)
                if key not in self.child:
                    self.child[key] = len(parent)
                    parent.append(v)
                    letter.append(c)
                    is_piece.append(False)
                v = self.child[key]
            if v:
                is_piece[v] = True
        n = len(parent)
        depth = [0] * n
        for v in range(1, n):  # parents come before their children
            depth[v] = depth[parent[v]] + 1
        self.pops, self.fail, self.tail = [0] * n, [-1] * n, [0] * n
        for v in sorted(range(1, n), key=depth.__getitem__):
            if is_piece[v]:
                self.pops[v], self.fail[v] = 1, 0
            else:
                count, z = self.pops[parent[v]], self.fail[parent[v]]
                key = ord(letter[v])
                while z >= 0 and z << 21 | key not in self.child:
                    count, z = count + self.pops[z], self.fail[z]
                if z >= 0:
                    self.pops[v], self.fail[v] = count, self.child[z << 21 | key]
            # A node without a link holds a character no piece can begin with; see count().
            self.tail[v] = self.pops[v] + self.tail[self.fail[v]] if self.fail[v] >= 0 else -1
        self.singles = {c for c in letter[1:] if c and self._whole(c, is_piece)}

    def _whole(self, c: str, is_piece: list[bool]) -> bool:
        v = self.child.get(ord(c))
        return v is not None and is_piece[v]

    def count(self, word: str) -> int:
        """Pieces of a word, its start mark included. Characters that are no piece by themselves end a run and count as their bytes."""
        total, v, child, pops, fail = 0, 0, self.child, self.pops, self.fail
        for c in MARK + word:
            key = ord(c)
            if c not in self.singles:
                total += self.tail[v] + len(c.encode("utf-8", "surrogatepass"))
                v = 0
                continue
            while (nxt := child.get(v << 21 | key)) is None:
                total += pops[v]
                v = fail[v]
            v = nxt
        return total + self.tail[v]


def greedy_pieces(word: str, vocabulary: set[str]) -> list[str]:
    """The same by its definition, for tests: the longest piece at each place, or one character's bytes."""
    text, out, at, longest = MARK + word, [], 0, max(map(len, vocabulary), default=1)
    while at < len(text):
        for end in range(min(len(text), at + longest), at, -1):
            if text[at:end] in vocabulary:
                out.append(text[at:end])
                at = end
                break
        else:
            out += [f"<{b:02x}>" for b in text[at].encode()]
            at += 1
    return out


def vocabulary_of(path: str) -> list[str]:
    """The ordinary pieces of a sentence-piece model whose every character is a piece too; others could not always be cut."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    pieces = [model.id_to_piece(i) for i in ids if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))]
    single = {p for p in pieces if len(p) == 1}
    return [p for p in pieces if all(c in single for c in p)]


class Counter:
    def __init__(self, path: str):
        self.automaton, self.known = Automaton(vocabulary_of(path)), {}

    def of(self, column: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Words, pieces, and pieces of the longest word of each text."""
        raw, off = hashing.text_bytes(column)
        starts, ends, first = hashing.word_spans(raw, off)
        words = np.diff(first)
        if not len(starts):
            return words, np.zeros(len(words), np.int64), np.zeros(len(words), np.int64)
        distinct, where, which = np.unique(hashing.word_hashes(raw, starts, ends, lower=False), return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > KEPT:
            self.known.clear()
        counts = []
        for h, i in zip(distinct.tolist(), where.tolist(), strict=True):
            n = self.known.get(h)
            if n is None:
                n = self.known[h] = self.automaton.count(raw[starts[i] : ends[i]].tobytes().decode())
            counts.append(n)
        each = np.array(counts, dtype=np.int64)[which]
        sums = np.concatenate([[0], np.cumsum(each)])
        most = np.zeros(len(words), dtype=np.int64)
        some = words > 0
        most[some] = np.maximum.reduceat(each, first[:-1][some])
        return words, sums[first[1:]] - sums[first[:-1]], most


@lru_cache(maxsize=2)
def counter_of(path: str) -> Counter:
    return Counter(path)


def _count(path: str):
    def run(batches):
        counter = counter_of(path)
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                part = batch.slice(k, 512)
                words, pieces, most = counter.of(part.column(part.num_columns - 1))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], pa.array(words, pa.int64()), pa.array(pieces, pa.int64()), pa.array(most, pa.int64())], names=[*part.schema.names[:-1], "n_words", "n_pieces", "max_word_pieces"])

    return run


def token_counts(docs: DataFrame, model_path: str, keep: list[str]) -> DataFrame:
    """The columns `keep` of docs(text, ...) with n_words, n_pieces and max_word_pieces."""
    rows = need(docs, *keep, "text")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[:-1])
    return rows.mapInArrow(_count(model_path), f"{kind}, n_words long, n_pieces long, max_word_pieces long")
