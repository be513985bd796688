"""N-gram Jaccard self-join by prefix filters under several global token orders.

Two texts link when |A & B| >= t |A | B| over their sets of distinct word shingles. Under any total
order of all shingles, two linked sets share one among their first n - ceil(t n) + 1.

1. The first order puts rare shingles first, by hashed counters over all documents (a table of fixed
   size; a counter counts as far as it exceeds what chance puts into one, so that the order stays of
   use however full the table is). Its prefixes are joined by token and give candidates.
2. Candidates pass further filters before any whole set is touched, the cheapest first. Each text
   with a candidate has a bitmap of its set; the bits that only one side has must leave room for the
   overlap needed. For what passes, prefixes under two further orders are made, of which one puts one
   half of all shingles first and the other the other half (rare ones first in each): a pair must
   share a token under every order. Only for what is left are whole sets made and compared.

What keeps groups from exploding:
* Texts of the same set are one node, whatever their number.
* A posting list first links each member to one centre only (a star; rows linear in the list), the
  text with the fewest rarer shingles. Only members that these stars leave in different components
  are then paired, so that a group of near copies never becomes all its pairs while no link between
  components is lost. Long lists are paired in blocks, by tasks that hold the bitmaps and give out
  only the pairs that pass them.
* Shingles that the counters show in very many texts are dealt over several tasks.

Nulls, empty texts and texts without a word have no shingles and link with nothing. Repeated rows
keep one row each; very long texts are hashed in slabs. Ties (equal places in an order) go by hash.
A null doc_id takes part in linking but never names a component. An empty table gives an empty one.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import hashing
from millrace.llm.common import cut, forget_shuffles, join_groups, lean, need, number_filter, release, runs_of_rows, small_batches, unpacked
from millrace.llm.graph import components

#: log2 of the number of hashed counters, and of the counters in a piece of the table.
COUNTER_BITS, PIECE_BITS = 22, 16
#: Counter levels are 4 log2 of the count above chance; lists above this level are dealt over several tasks.
HOT_LEVEL = 48
#: Lists of up to LIST ** 2 pairs are paired by a join; longer ones in blocks of BLOCK members by their bitmaps.
LIST, BLOCK = 64, 256
#: Further rounds of stars at most, and pairs a row up to which those that are left are formed without another.
MORE_STARS, FEW_A_ROW = 1, 8
#: Rows of texts, and of pairs' sets, that Python is handed at a time.
TEXT_ROWS, PAIR_ROWS = 1000, 500
#: Linked texts whose components are broadcast at most, 16 bytes each; more are joined by shuffle.
FEW_NODES = 500_000
#: Pairs that are broadcast at most, 24 bytes a side; more are joined by shuffle.
FEW_PAIRS = 100_000
#: Pairs that one task compares at least, where there are as many: tasks cost more than the pairs of a small table.
PAIRS_A_TASK = 200
#: The further global orders: an odd multiplier that orders hashes of one level, and the half that comes first.
FURTHER_ORDERS = ((0xA0761D6478BD642F, 0), (0xE7037ED1A0B428DB, 1))

_COUNTERS = np.uint64((1 << COUNTER_BITS) - 1)


def prefix_length(n, numerator: int, denominator: int):
    """n - ceil(t n) + 1 in whole numbers."""
    return n - -(-(n * numerator) // denominator) + 1


def _survey(size: int):
    """Per document: id, print, set size, set hash. Per task: the counter table in pieces."""

    def run(batches):
        table = np.zeros(1 << COUNTER_BITS, dtype=np.uint32)
        for batch in batches:
            n, key = [], []
            for own in hashing.shingle_sets(batch.column(2), size):
                n.append(len(own))
                if len(own):
                    key.append(_set_key(own))
                    np.add.at(table, (own & _COUNTERS).astype(np.int64), 1) if len(own) < 64 else _count(table, own)
                else:
                    key.append(0)
            k = len(n)
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(n, pa.int64()), pa.array(np.array(key, dtype=np.uint64).view(np.int64)), pa.nulls(k, pa.int32()), pa.nulls(k, pa.binary())], names=_SURVEY)
        pieces = table.reshape(-1, 1 << PIECE_BITS)
        used = [i for i in range(len(pieces)) if pieces[i].any()]
        if used:
            null = pa.nulls(len(used), pa.int64())
            yield pa.RecordBatch.from_arrays([null, null, null, null, pa.array(used, pa.int32()), pa.array([zlib.compress(pieces[i].tobytes(), 1) for i in used], pa.binary())], names=_SURVEY)

    return run


_SURVEY = ["doc_id", "print", "n", "key", "piece", "counts"]


def _count(table: np.ndarray, own: np.ndarray) -> None:
    at, times = np.unique((own & _COUNTERS).astype(np.int64), return_counts=True)
    table[at] += times.astype(np.uint32)


def _set_key(own: np.ndarray) -> int:
    """A 64-bit name of a set: every element enters through an independent finaliser."""
    salted = hashing.mix(own ^ np.uint64(0x2545F4914F6CDD1D))
    return int(hashing.mix(np.array([salted.sum(dtype=np.uint64) ^ np.uint64((len(own) * 0x9E3779B97F4A7C15) & (2**64 - 1))], dtype=np.uint64))[0])


def _levels(total: np.ndarray) -> np.ndarray:
    """Levels of the counters of a piece: 0 for what rare shingles alone make of one, then 4 log2 of the excess."""
    usual = float(np.median(total))
    excess = np.maximum(0.0, total.astype(np.float64) - usual - 3 * math.sqrt(usual))
    return np.minimum(127, np.round(4 * np.log2(excess + 1))).astype(np.uint8)


def _add_pieces(last: bool):
    def run(pdf):
        total = np.zeros(1 << PIECE_BITS, dtype=np.uint64)
        for blob in pdf["counts"]:
            total += np.frombuffer(zlib.decompress(blob), dtype=np.uint32)
        if last:
            out = _levels(total)
        else:
            out = np.minimum(total, 0xFFFFFFFF).astype(np.uint32)
        return pdf.iloc[:1].assign(counts=[zlib.compress(out.tobytes(), 1)])

    return run


def rarity(survey: DataFrame) -> bytes:
    """The level of each hashed counter, summed over all documents: 2 ** COUNTER_BITS bytes, whatever the input."""
    pieces = survey.where("piece is not null").select("piece", F.pmod(F.xxhash64("counts"), F.lit(64)).alias("salt"), "counts")
    kind = "piece int, salt long, counts binary"
    pieces = pieces.groupBy("piece", "salt").applyInPandas(_add_pieces(False), kind).groupBy("piece").applyInPandas(_add_pieces(True), kind)
    out = np.zeros(1 << COUNTER_BITS, dtype=np.uint8)
    for row in pieces.select("piece", "counts").collect():  # at most 64 rows of 64 KB
        at = row["piece"] << PIECE_BITS
        out[at : at + (1 << PIECE_BITS)] = np.frombuffer(zlib.decompress(row["counts"]), dtype=np.uint8)
    return out.tobytes()


def _ordered(own: np.ndarray, levels: np.ndarray) -> np.ndarray:
    """The set as tokens whose numeric order is the first global order: rare first, then by hash."""
    return np.sort((levels[(own & _COUNTERS).astype(np.int64)].astype(np.uint64) << np.uint64(56)) | (own >> np.uint64(8)))


def _postings(levels_held, size: int, t: tuple[int, int]):
    def run(batches):
        levels = np.frombuffer(levels_held.value, dtype=np.uint8)
        for batch in batches:
            parts: list[tuple] = []
            held = 0
            for own in hashing.shingle_sets(batch.column(0), size):
                n = len(own)
                if not n:
                    continue
                tokens = _ordered(own, levels)[: prefix_length(n, *t)]
                parts.append((tokens, _set_key(own), n))
                held += len(tokens)
                if held > 200_000:
                    yield _posting_batch(parts)
                    parts, held = [], 0
            if parts:
                yield _posting_batch(parts)

    return run


def _posting_batch(parts) -> pa.RecordBatch:
    lengths = [len(x[0]) for x in parts]
    tokens = np.concatenate([x[0] for x in parts])
    key = np.repeat(np.array([x[1] for x in parts], dtype=np.uint64), lengths)
    n = np.repeat(np.array([x[2] for x in parts], dtype=np.int64), lengths)
    at = np.concatenate([np.arange(k, dtype=np.int64) for k in lengths])
    level = (tokens >> np.uint64(56)).astype(np.int64)
    over = np.clip((level - HOT_LEVEL) // 4, 0, 10)  # each halves the share of a task
    salt = (key % (np.uint64(1) << over.astype(np.uint64))).astype(np.int32)
    return pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(salt, pa.int32()), pa.array(key.view(np.int64)), pa.array((n << 32) | at)], names=["token", "salt", "key", "place"])


def _size_class(n):
    """Sets of linked texts are in the same class or in neighbouring ones."""
    return np.floor(np.log(np.maximum(n, 1)) / math.log(4 / 3)).astype(np.int64)


def _shared_lists(batches):
    """Of rows sorted by (token, salt, size class, position, key): those whose token a text of like size, or another task, may hold too.

    Adds the first key of each size class of a list as its centre. That is the text with the fewest
    rarer shingles, of a group of near copies the one nearest to what they were copied from.
    Streams: holds one row and the first of its class.
    """
    names = ["token", "salt", "key", "place", "centre", "centre_place"]
    tail = None  # the last row, its centre, the centre's place, whether it has company; not yet given out
    for batch in batches:
        token, salt, key, place = (batch.column(i).to_numpy() for i in range(4))
        if not len(token):
            continue
        if tail is not None:
            token, salt, key, place = (np.concatenate([np.array([x], y.dtype), y]) for x, y in zip(tail[:4], (token, salt, key, place), strict=True))
        keep = np.ones(len(token), dtype=bool)  # a copy of the same text in the same list
        keep[1:] = (token[1:] != token[:-1]) | (key[1:] != key[:-1])
        token, salt, key, place = token[keep], salt[keep], key[keep], place[keep]
        listed = np.zeros(len(token), dtype=bool)
        listed[1:] = (token[1:] == token[:-1]) & (salt[1:] == salt[:-1])
        kind = _size_class(place >> 32)
        same = listed.copy()
        same[1:] &= kind[1:] == kind[:-1]
        first = np.maximum.accumulate(np.where(same, 0, np.arange(len(token))))
        centre, centre_place = key[first], place[first]
        near = listed.copy()  # beside a row of its own size class or the next
        near[1:] &= kind[1:] - kind[:-1] <= 1
        company = near.copy()
        company[:-1] |= near[1:]
        company |= (token.view(np.uint64) >> np.uint64(56)).astype(np.int64) >= HOT_LEVEL + 4
        if tail is not None:
            own = first == 0
            centre[own], centre_place[own] = tail[4], tail[5]
            company[0] |= tail[6]
        tail = (token[-1], salt[-1], key[-1], place[-1], centre[-1], centre_place[-1], company[-1])
        give = company.copy()
        give[-1] = False
        yield pa.RecordBatch.from_arrays([pa.array(x[give]) for x in (token, salt, key, place, centre, centre_place)], names=names)
    if tail is not None and tail[6]:
        yield pa.RecordBatch.from_arrays([pa.array([int(x)], pa.int32() if i == 1 else pa.int64()) for i, x in enumerate(tail[:6])], names=names)


def _sets(held, bits: int, size: int, made):
    """(key, *made(set)) of the texts whose doc_id and key pass the filter, once for each task."""

    def run(batches):
        wanted, low, seen = unpacked(held), (1 << bits) - 1, set()
        for batch in batches:
            chosen = np.array([d is None or wanted[d & low] for d in batch.column(0).to_pylist()], dtype=bool)
            if not chosen.any():
                continue
            found, blobs, sizes = [], [], 0
            for own in hashing.shingle_sets(batch.column(1).filter(pa.array(chosen)), size):
                if len(own) and wanted[(key := _set_key(own)) & low] and key not in seen:
                    if len(seen) < 200_000:
                        seen.add(key)
                    found.append(key)
                    blobs.append(made(own))
                    sizes += len(own)
                    if sizes > 500_000:
                        yield _set_batch(found, blobs)
                        found, blobs, sizes = [], [], 0
            if found:
                yield _set_batch(found, blobs)

    return run


def _set_batch(keys, blobs):
    columns = [pa.array(c, pa.binary()) for c in zip(*blobs, strict=True)]
    return pa.RecordBatch.from_arrays([pa.array(np.array(keys, dtype=np.uint64).view(np.int64)), *columns], names=["key", *(f"blob{i}" for i in range(len(columns)))])


def bitmap_of(own: np.ndarray) -> np.ndarray:
    """The set as bits, one and a half to three for each element: 64-bit words."""
    bits = max(64, 1 << (3 * len(own) // 2).bit_length())
    flat = np.zeros(bits, dtype=bool)
    flat[((own >> np.uint64(7)) & np.uint64(bits - 1)).astype(np.int64)] = True
    return np.packbits(flat, bitorder="little").view(np.uint64)


def folded(words: np.ndarray, width: int) -> np.ndarray:
    """A bitmap, or the rows of several, in fewer words: bits that meet are ORed."""
    while words.shape[-1] > width:
        half = words.shape[-1] // 2
        words = words[..., :half] | words[..., half:]
    return words


def room(n_a, n_b, t: tuple[int, int]):
    """Elements that the sets may have alone, each, in a pair that links."""
    need_ = -(-((n_a + n_b) * t[0]) // (t[0] + t[1]))
    return n_a - need_, n_b - need_


def sized_bitmap(own: np.ndarray) -> bytes:
    """The size of a set, then its bitmap."""
    return np.array([len(own)], dtype=np.uint64).tobytes() + bitmap_of(own).tobytes()


def _prefixes(levels_held, t: tuple[int, int]):
    """The prefixes of a set under the further orders, as sorted 32-bit names, one after the other."""

    def made(own: np.ndarray) -> bytes:
        levels = np.frombuffer(levels_held.value, dtype=np.uint8)
        level = levels[(own & _COUNTERS).astype(np.int64)].astype(np.uint64) << np.uint64(56)
        half, p, parts = (own >> np.uint64(40)) & np.uint64(1), prefix_length(len(own), *t), []
        for factor, first in FURTHER_ORDERS:
            mixed = own * np.uint64(factor)
            place = ((half ^ np.uint64(first)) << np.uint64(63)) | level | (mixed >> np.uint64(8))
            chosen = mixed if p >= len(own) else mixed[np.argpartition(place, p - 1)[:p]]
            parts.append((np.sort(chosen) >> np.uint64(32)).astype(np.uint32))
        return np.concatenate(parts).tobytes()

    return made


def meets(a: np.ndarray, b: np.ndarray) -> int:
    """Equal neighbours in the two sorted together: shared elements, where each has its elements once."""
    both = np.concatenate([a, b])
    both.sort()
    return int(np.count_nonzero(both[1:] == both[:-1]))


def _by_pair(kind, test):
    """Of rows (a, b, side, blob) sorted by them, the pairs whose two blobs, arrays of that kind, pass the test; each once, also where blobs come twice."""

    def read(blob):
        return np.frombuffer(blob.as_py(), dtype=kind)

    def run(batches):
        held = None  # the first text of a pair whose second is in the next batch
        last_key, last = None, None
        for batch in batches:
            left, right, side, blobs = (batch.column(i) for i in range(4))
            src, dst = [], []
            for a, b, second, blob in zip(left.to_pylist(), right.to_pylist(), side.to_pylist(), blobs, strict=True):
                if not second:
                    held = (a, b, blob)
                elif held is not None and held[:2] == (a, b):
                    if a != last_key:
                        last_key, last = a, read(held[2])
                    if test(last, read(blob)):
                        src.append(a)
                        dst.append(b)
                    held = None
            yield pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), pa.array(dst, pa.int64())], names=["src", "dst"])

    return run


def _room_left(t: tuple[int, int]):
    """Whether two bitmaps have bits alone no more than a pair that links may."""

    def test(x: np.ndarray, y: np.ndarray) -> bool:
        alone_x, alone_y = room(int(x[0]), int(y[0]), t)
        width = min(len(x), len(y)) - 1
        a, b = folded(x[1:], width), folded(y[1:], width)
        return int(np.bitwise_count(a & ~b).sum()) <= alone_x and int(np.bitwise_count(b & ~a).sum()) <= alone_y

    return test


def _share_prefixes(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two texts share a prefix token under every further order."""
    k = len(FURTHER_ORDERS)
    return all(meets(x[i * len(x) // k : (i + 1) * len(x) // k], y[i * len(y) // k : (i + 1) * len(y) // k]) for i in range(k))


def _links(t: tuple[int, int]):
    def test(a, b):
        shared = meets(a, b)
        return shared * t[1] >= (len(a) + len(b) - shared) * t[0]

    return test


def _list_pairs(t: tuple[int, int]):
    """Of rows (token, kind, x, y, side, key, place, comp, bitmap) sorted by them: the pairs to look at of the two sides.

    x and y name the blocks of a list that meet here. Members of one component are not paired, nor
    those that the sizes, the places or the bitmaps rule out.
    """

    def run(batches):
        names, src, dst = ["a", "b"], [], []
        for _, _, _, _, side, key, place, comp, blob in runs_of_rows(batches, 4):
            n, at = place >> 32, place & 0xFFFFFFFF
            two = np.flatnonzero(side == 1)
            bits = [np.frombuffer(b, dtype=np.uint64)[1:] for b in blob]
            for i in np.flatnonzero(side == 0).tolist():
                j = two
                most = 1 + np.minimum(n[i] - at[i] - 1, n[j] - at[j] - 1)
                j = j[(comp[j] != comp[i]) & (np.minimum(n[i], n[j]) * t[1] >= np.maximum(n[i], n[j]) * t[0]) & (most * (t[0] + t[1]) >= (n[i] + n[j]) * t[0])]
                alone_i, alone_j = room(n[i], n[j], t)
                good = []
                for k, most_i, most_k in zip(j.tolist(), alone_i.tolist(), alone_j.tolist(), strict=True):
                    width = min(len(bits[i]), len(bits[k]))
                    a, b = folded(bits[i], width), folded(bits[k], width)
                    if int(np.bitwise_count(a & ~b).sum()) <= most_i and int(np.bitwise_count(b & ~a).sum()) <= most_k:
                        good.append(k)
                j = np.array(good, dtype=np.int64)
                if len(j):
                    src.append(np.minimum(key[i], key[j]))
                    dst.append(np.maximum(key[i], key[j]))
            if sum(map(len, src)) > 50_000:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (src, dst)], names=names)
                src, dst = [], []
        if src:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in (src, dst)], names=names)

    return run


class _Join:
    def __init__(self, docs: DataFrame, size: int, t: tuple[int, int]):
        self.docs, self.size, self.t, self.spark = docs, size, t, docs.sparkSession
        self.parts = max(12, int(self.spark.conf.get("spark.sql.shuffle.partitions")))

    def survey(self) -> DataFrame:
        text = need(self.docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("print"), "text")
        return cut(text.mapInArrow(lean(_survey(self.size)), "doc_id long, print long, n long, key long, piece int, counts binary"))

    def lists(self, levels) -> DataFrame:
        rows = need(self.docs, "text").mapInArrow(lean(_postings(levels, self.size, self.t)), "token long, salt int, key long, place long")
        rows = rows.repartition(self.parts, "token", "salt").sortWithinPartitions("token", "salt", _class("place"), _at("place"), "place", "key")
        return cut(rows.mapInArrow(lean(_shared_lists), "token long, salt int, key long, place long, centre long, centre_place long"))

    def tasks(self, pairs: int) -> int:
        return min(self.parts, max(6, pairs // PAIRS_A_TASK))

    def made_of(self, keys: DataFrame, survey: DataFrame, made, blobs: int = 1, most: int | None = None) -> DataFrame:
        """(key, blob0, ...) of the sets named by keys(key), made(set) each, read once more from its document of the smallest id.

        A filter of the distinct keys and of those ids says which documents to give out. It is sized by the
        number of keys up to a limit; false hits may give other sets, or one twice, which does no harm.
        most: pairs that the keys are of, if known.
        """
        keys = keys.distinct()
        keys = cut(keys if most is None else keys.coalesce(self.tasks(most)))
        least = survey.where("n > 0 and doc_id is not null").join(keys, "key", "left_semi").groupBy("key").agg(F.min("doc_id").alias("doc_id"))
        held, bits = number_filter(keys.unionByName(least.select(F.col("doc_id").alias("key"))), 2 * keys.count())
        release(keys)
        rows = need(self.docs, "doc_id", "text").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        return cut(rows.mapInArrow(lean(_sets(held, bits, self.size, made)), "key long" + "".join(f", blob{i} binary" for i in range(blobs))))

    def paired(self, pairs: DataFrame, n: int, blobs: DataFrame, blob: str, kind, test) -> tuple[DataFrame, int]:
        """(a, b) of those n distinct pairs(a, b) whose blobs pass the test, and how many they are."""
        sides = pairs.select("a", "b", F.explode(F.array(F.struct(F.lit(0).alias("side"), F.col("a").alias("key")), F.struct(F.lit(1).alias("side"), F.col("b").alias("key")))).alias("s")).select("a", "b", "s.side", "s.key")
        if n <= FEW_PAIRS:  # so that the blobs stay where they are
            sides = F.broadcast(sides)
        both = sides.join(blobs, "key").select("a", "b", "side", blob).repartition(self.parts, "a", "b").coalesce(self.tasks(n)).sortWithinPartitions("a", "b", "side")
        with small_batches(self.spark, PAIR_ROWS):
            out = cut(both.mapInArrow(lean(_by_pair(kind, test)), "src long, dst long").select(F.col("src").alias("a"), F.col("dst").alias("b")))
        return out, out.count()

    def links(self, pairs: DataFrame, bitmaps: DataFrame, levels, survey: DataFrame) -> DataFrame:
        """(src, dst) of distinct pairs (a, b) that pass every filter, and then the test on their whole sets."""
        every = cut(pairs)
        passed, n = self.paired(every, every.count(), bitmaps, "blob0", np.uint64, _room_left(self.t))
        release(every)
        if n:
            prefixes = _prefixes(levels, self.t)
            # One reading of the texts gives prefixes and sets; the sets' column is read for what the prefixes leave.
            blobs = self.made_of(passed.select(F.explode(F.array("a", "b")).alias("key")), survey, lambda own: (prefixes(own), own.tobytes()), 2, n)
            for blob, kind, test in (("blob0", np.uint32, _share_prefixes), ("blob1", np.uint64, _links(self.t))):
                if n:
                    old, (passed, n) = passed, self.paired(passed, n, blobs, blob, kind, test)
                    release(old)
            release(blobs)
        forget_shuffles(self.spark)
        return passed.select(F.col("a").alias("src"), F.col("b").alias("dst"))

    def could_link(self, n_a, n_b, place_a, place_b):
        """Size and position filters: whether the two sets can link if this token, at these places, is the first they share.

        Linked sets have a first shared token, and for it this holds; pairs need be formed at such tokens only.
        """
        top, bottom = self.t
        most = 1 + F.least(n_a - place_a - 1, n_b - place_b - 1)
        return (F.least(n_a, n_b) * bottom >= F.greatest(n_a, n_b) * top) & (most * (top + bottom) >= (n_a + n_b) * top)


def _n(c):
    return F.shiftright(F.col(c), 32)


def _class(c):
    return F.floor(F.ln(_n(c)) / F.lit(math.log(4 / 3)))


def _at(c):
    return F.col(c).bitwiseAND(F.lit(0xFFFFFFFF))


def links(docs: DataFrame, size: int = 5, numerator: int = 75, denominator: int = 100) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(texts, links, components) of docs(doc_id, text).

    texts: doc_id, print (hash of the text), n (set size), key (name of the set). links: src, dst
    (keys of different sets), enough of the links to connect all that are connected; no component
    misses one. components: node (a linked set's key), comp.
    """
    job = _Join(docs, size, (numerator, denominator))
    survey = job.survey()
    levels = job.spark.sparkContext.broadcast(rarity(survey))
    lists = job.lists(levels)
    forget_shuffles(job.spark)
    bitmaps = job.made_of(lists.select("key"), survey, lambda own: (sized_bitmap(own),))
    ordered = (F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    # Stars: each member against the centre of its list, and the centres of one token's tasks against each other.
    star = lists.where("key <> centre").where(job.could_link(_n("place"), _n("centre_place"), _at("place"), _at("centre_place")))
    tops = lists.where("key = centre").select("token", "salt", F.col("centre").alias("a"))
    across = tops.where("salt > 0").join(tops.where("salt = 0").select("token", F.col("a").alias("b")), "token").where("a <> b")
    found = job.links(star.select(F.col("centre").alias("a"), F.col("key").alias("b")).unionByName(across.select("a", "b")).select(*ordered).distinct(), bitmaps, levels, survey)
    # Stars once more, while lists are left with many members in many components: about the first of each size class and any comp but one's own.
    comp, new = None, found
    for again in range(MORE_STARS, -1, -1):
        comp = cut(components(new if comp is None else _edges(comp).unionByName(new)))
        rows = cut(_apart(lists, comp))
        sizes = cut(_sizes(rows))
        most = sizes.agg(F.coalesce(F.sum("m"), F.lit(0)).alias("rows"), F.coalesce(F.sum(F.col("m") * F.col("few")), F.lit(0)).alias("pairs")).first()
        if not again or most["pairs"] <= FEW_A_ROW * most["rows"]:
            break
        first = rows.groupBy("token", _class("place").alias("c"), "comp").agg(F.min(F.struct(_at("place").alias("at"), F.col("key").alias("a"), F.col("place").alias("pa"))).alias("f"))
        one = first.groupBy("token", "c").agg(F.min(F.struct("f.at", "f.a", "f.pa", "comp")).alias("f")).select("token", "c", "f.a", "f.pa", F.col("f.comp").alias("comp_a"))
        pairs = rows.withColumn("c", F.explode(F.array(_class("place"), _class("place") - 1))).join(one, ["token", "c"]).where("comp <> comp_a").where(job.could_link(_n("place"), _n("pa"), _at("place"), _at("pa")))
        new = job.links(pairs.select("a", F.col("key").alias("b")).select(*ordered).distinct(), bitmaps, levels, survey)
        found = found.unionByName(new)
        release(rows, sizes)
    # What is left: between different components of a list, at tokens that can be the first they share.
    release(lists)
    more = job.links(_left(rows, sizes, bitmaps, job).distinct(), bitmaps, levels, survey)
    release(rows, sizes, bitmaps)
    return survey.where("piece is null").select("doc_id", "print", "n", "key"), found.unionByName(more).distinct(), cut(components(_edges(comp).unionByName(more)))


def _edges(comp: DataFrame) -> DataFrame:
    """Components as edges, from which they are found again in one step."""
    return comp.where("node <> comp").select(F.col("node").alias("src"), F.col("comp").alias("dst"))


def _apart(lists: DataFrame, comp: DataFrame) -> DataFrame:
    """The rows of the lists whose members are in more than one component."""
    comp = comp.select(F.col("node").alias("key"), "comp")
    rows = lists.select("token", "key", "place").join(F.broadcast(comp) if comp.count() <= FEW_NODES else comp, "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    return rows.join(rows.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).where("lo <> hi").select("token"), "token")


def _sizes(rows: DataFrame) -> DataFrame:
    """By list: m members, the component of most of them, and how many are outside of that."""
    by_comp = rows.groupBy("token", "comp").agg(F.count("*").alias("n"))
    sizes = by_comp.groupBy("token").agg(F.sum("n").alias("m"), F.max(F.struct("n", "comp")).alias("big"))
    return sizes.select("token", "m", F.col("big.comp").alias("big"), (F.col("m") - F.col("big.n")).alias("few"))


def _left(rows: DataFrame, sizes: DataFrame, bitmaps: DataFrame, job: _Join) -> DataFrame:
    """The pairs (a, b) of the lists' members in different components.

    Of a pair one side at least is outside of the list's largest component. Where members times
    those outside are at most LIST ** 2, they are joined. Other lists are cut into blocks of BLOCK,
    those inside and those outside by themselves, and tasks hold a block of each, or two of those
    outside, and look at the bitmaps first; a member is sent once for each block of those outside,
    and one outside once for each block of the list.
    """
    long_one = F.col("m") * F.col("few") > LIST * LIST
    short = rows.join(sizes.where(~long_one).select("token", "big"), "token")
    a, b = (short.select("token", "big", *(F.col(c).alias(f"{c}_{side}") for c in ("key", "place", "comp"))) for side in "ab")
    b = b.where("comp_b <> big").drop("big")
    pairs = a.join(b, "token").where("comp_a <> comp_b and (comp_a = big or key_a < key_b)").where(job.could_link(_n("place_a"), _n("place_b"), _at("place_a"), _at("place_b")))
    pairs = pairs.select(F.least("key_a", "key_b").alias("a"), F.greatest("key_a", "key_b").alias("b"))
    dealt = rows.join(sizes.where(long_one), "token")
    zero, blocks = F.lit(0).cast("long"), lambda c: F.ceil(F.col(c) / BLOCK)
    dealt = dealt.withColumn("x", F.pmod(F.xxhash64("key"), blocks("m"))).withColumn("y", F.pmod(F.xxhash64("key"), blocks("few")))
    every = lambda c: F.sequence(zero, blocks(c) - 1)
    cell = lambda kind, x, y, side: F.struct(F.lit(kind).cast("long").alias("kind"), x.alias("x"), y.alias("y"), F.lit(side).cast("long").alias("side"))
    inside = F.transform(every("few"), lambda o: cell(0, F.col("x"), o, 0))
    outside = F.concat(
        F.transform(every("m"), lambda o: cell(0, o, F.col("y"), 1)),
        F.transform(F.filter(every("few"), lambda o: o >= F.col("y")), lambda o: cell(1, F.col("y"), o, 0)),
        F.transform(F.filter(every("few"), lambda o: o <= F.col("y")), lambda o: cell(1, o, F.col("y"), 1)),
    )
    dealt = dealt.withColumn("c", F.explode(F.when(F.col("comp") == F.col("big"), inside).otherwise(outside)))
    # Bitmaps are put to members once, then go with them.
    own = rows.join(sizes.where(long_one).select("token"), "token", "left_semi").select("key").distinct()
    own = bitmaps.join(own, "key", "left_semi").dropDuplicates(["key"])
    if own.count() <= FEW_PAIRS:
        own = F.broadcast(own)
    dealt = dealt.join(own, "key").select("token", "c.kind", "c.x", "c.y", "c.side", "key", "place", "comp", "blob0")
    dealt = dealt.repartition(job.parts, "token", "kind", "x", "y").sortWithinPartitions("token", "kind", "x", "y", "side", "key")
    return pairs.unionByName(dealt.mapInArrow(_list_pairs(job.t), "a long, b long"))


def groups_of(docs: DataFrame, size: int = 5, numerator: int = 75, denominator: int = 100) -> DataFrame:
    """(doc_id, print, n_shingles, component_id, first_id, first_print) for every row of docs(doc_id, text).

    print: hash of the text. first_id, first_print: the least row of the component, by id (null ids
    last), then print; both null where the document has no shingles.
    """
    with small_batches(docs.sparkSession, TEXT_ROWS):
        texts, _, comp = links(docs, size, numerator, denominator)
    own = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "print")
    # Copies of one text first, on the map side; then by component over distinct texts.
    by_key = texts.where("n > 0").groupBy("key").agg(F.min(own).alias("first"), F.count("*").alias("m")).join(comp.withColumnRenamed("node", "key"), "key", "left").withColumn("comp", F.coalesce("comp", "key"))
    by_key = cut(by_key)
    by_comp = by_key.groupBy("comp").agg(F.min("first").alias("least"), F.count("*").alias("texts"))
    named = join_groups(by_key, cut(by_comp), "comp", "texts").select("key", "m", "least")
    out = join_groups(texts.withColumn("key", F.when(F.col("n") > 0, F.col("key"))), cut(named), "key", "m")
    return out.select("doc_id", "print", F.col("n").alias("n_shingles"), F.coalesce("least.doc_id", "doc_id").alias("component_id"), F.col("least.doc_id").alias("first_id"), F.col("least.print").alias("first_print"))


def near_duplicate_groups(docs: DataFrame, size: int = 5, numerator: int = 75, denominator: int = 100) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of docs(doc_id, text).

    component_id: the smallest doc_id reachable through links, the document itself included.
    """
    return groups_of(docs, size, numerator, denominator).select("doc_id", "n_shingles", "component_id")
