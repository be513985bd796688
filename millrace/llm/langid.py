"""Language identification by bit-sliced Bloom filters over character n-grams.

One table of words serves all languages: bit l of entry h says that language l's filter has bit h
set, so that ANDing the entries of an n-gram's hashes gives at once the set of all languages that
contain it. Per document, n-grams are counted by language (popcounts of the masks' bits), each count
is corrected for the false positives that the filter's fill predicts, and the largest decides.

n-grams are runs of GRAM bytes of the lower-cased text, over letters and the spaces around words; two
spaces are put on both sides, so that one letter has some too. Training reads a sample of about
PER_LANGUAGE whole documents a language: those whose hash of id and text lies below a threshold that
follows from the language's number of documents. The sample's n-grams are counted and ORed into the
table on the executors; the driver sees the table alone, whose size is fixed for 64 languages.
An n-gram that does not tell languages apart (in all of them) adds the same to every count.

Null texts, and texts without a letter, are `und` with score 0. Ties go to the first language by
name; so do texts that no language has an n-gram of, with score 0. Repeated rows of one id and text
are learned from once, and each predicted. Very long texts are read whole, in slabs. From an empty
table, or one without a language, nothing is learned and all is `und`.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import cut, lean, need, release
from millrace.llm.hashing import mix, text_bytes

GRAM, HASHES, TABLE_BITS = 5, 2, 20
#: Documents a language that are learned from, at about.
PER_LANGUAGE = 400
#: An n-gram enters a language's filter if that share of its sampled documents have it, and one at least.
MIN_SHARE = 0.005
#: log2 of the table's entries in a piece, as it is put together.
PIECE_BITS = 14
#: Rows handed on at a time, and bytes of text looked at at a time.
ROWS = 1000
SLAB = 1 << 19

#: Bytes as they count: A-Z as a-z, the rest of ASCII that is no letter as a space, UTF-8 bytes as they are.
_FOLD = np.full(256, 32, dtype=np.uint8)
_FOLD[97:123] = np.arange(97, 123)
_FOLD[65:91] = np.arange(97, 123)
_FOLD[128:] = np.arange(128, 256)


def padded(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column's rows, with two spaces on both sides of each."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    two, none = (pa.scalar(x, pa.large_string()) for x in ("  ", ""))
    return text_bytes(pc.binary_join_element_wise(two, column.fill_null("").cast(pa.large_string()), two, none))


def has_letter(text: str) -> bool:
    """Whether a text has a character of a Unicode letter category."""
    return any(map(str.isalpha, text))


def grams(raw: np.ndarray) -> np.ndarray:
    """A 64-bit code of each run of GRAM folded bytes; runs of spaces count as they stand."""
    if len(raw) < GRAM:
        return np.zeros(0, np.uint64)
    folded = _FOLD[raw].astype(np.uint64)
    out = folded[: len(folded) - GRAM + 1].copy()
    for k in range(1, GRAM):
        out <<= np.uint64(8)
        out |= folded[k : len(folded) - GRAM + 1 + k]
    return out


def slots(codes: np.ndarray) -> list[np.ndarray]:
    h = mix(codes.copy())
    low = np.uint64((1 << TABLE_BITS) - 1)
    return [((h >> np.uint64(21 * k)) & low).astype(np.int64) for k in range(HASHES)]


class Model:
    def __init__(self, languages: list[str], table: np.ndarray):
        self.languages, self.table = languages, table  # table: (2 ** TABLE_BITS, words of 64 languages)
        bits = [((table[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)) for k in range(len(languages))]
        self.false_rate = np.array([float(b.mean()) ** HASHES for b in bits])

    def popcounts(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Per row: n-grams by language that may contain them, and n-grams in all."""
        rows, width = len(off) - 1, len(self.languages)
        counts, total = np.zeros((rows, width), dtype=np.int64), np.maximum(np.diff(off) - GRAM + 1, 0)
        at = 0
        while at < len(raw):  # slabs overlap by the bytes of a run that begins in them
            stop = min(len(raw), at + SLAB)
            codes = grams(raw[at : min(len(raw), stop + GRAM - 1)])
            first, last = int(np.searchsorted(off, at, "right")) - 1, int(np.searchsorted(off, stop, "left"))
            begin = np.clip(off[first:last] - at, 0, len(codes))
            end = np.clip(off[first + 1 : last + 1] - GRAM + 1 - at, 0, len(codes))
            masks = self.table[(s := slots(codes))[0]]
            for other in s[1:]:
                masks &= self.table[other]
            for k in range(width):
                hit = ((masks[:, k // 64] >> np.uint64(k % 64)) & np.uint64(1)).astype(np.uint8)
                sums = np.zeros(len(codes) + 1, dtype=np.int64)
                np.cumsum(hit, out=sums[1:])
                counts[first:last, k] += np.where(end > begin, sums[end] - sums[np.minimum(begin, end)], 0)
            at = stop
        return counts, total

    def decide(self, raw: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of the language and a score of 0 to 1 for each row: the corrected share of its n-grams that language has."""
        counts, total = self.popcounts(raw, off)
        rate = self.false_rate[None, :]
        share = (counts - total[:, None] * rate) / np.maximum(total[:, None], 1) / np.maximum(1 - rate, 1e-9)
        share = np.clip(share, 0, 1)
        best = share.argmax(axis=1) if share.shape[1] else np.zeros(len(total), np.int64)
        top = share.max(axis=1) if share.shape[1] else np.zeros(len(total))
        return best, top


def held_out(doc_id: Column) -> Column:
    """Documents never learned from: crc32 of the id as text, mod 4, is 2. A null id counts as held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(True))


def _gram_rows(batches):
    """Of rows (language number, text): the number and each distinct n-gram of the text."""
    for batch in batches:
        for k in range(0, batch.num_rows, 50):
            part = batch.slice(k, 50)
            raw, off = padded(part.column(1))
            own = [np.unique(grams(raw[a:b])) for a, b in zip(off, off[1:])]
            yield pa.RecordBatch.from_arrays([part.column(0).take(pa.array(np.repeat(np.arange(len(own)), [len(x) for x in own]))), pa.array(np.concatenate(own).view(np.int64))], names=["k", "code"])


def _slot_rows(batches):
    """Of rows (language number, n-gram): the table entries and bits that they set."""
    for batch in batches:
        k, code = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
        for at in slots(code):
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(k // 64, pa.int64()), pa.array((np.uint64(1) << (k % 64).astype(np.uint64)).view(np.int64))], names=["slot", "word", "bits"])


def _piece(pdf):
    """A piece of the table, packed."""
    out = np.zeros(1 << PIECE_BITS, dtype=np.uint64)
    out[pdf["slot"].to_numpy() & ((1 << PIECE_BITS) - 1)] = pdf["bits"].to_numpy().view(np.uint64)
    return pdf.iloc[:1][["piece", "word"]].assign(data=[zlib.compress(out.tobytes(), 1)])


def fit(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """A model from docs(doc_id, text, lang), of the rows not held out that have a text and a language."""
    spark = docs.sparkSession
    rows = need(docs, "doc_id", "lang", "text").where(~held_out(F.col("doc_id"))).where("lang is not null and text is not null")
    found = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # a row a language
    languages = sorted(found)
    table = np.zeros((1 << TABLE_BITS, max(1, -(-len(languages) // 64))), dtype=np.uint64)
    if not languages:
        return Model([], table)
    span = 1 << 30
    chosen = spark.createDataFrame([(lang, k, min(span, -(-span * per_language // found[lang]))) for k, lang in enumerate(languages)], "_lang string, k long, below long")
    rank = F.xxhash64("doc_id", "text")
    sample = rows.withColumn("rank", rank).join(F.broadcast(chosen), F.col("lang") == F.col("_lang")).where(F.pmod("rank", F.lit(span)) < F.col("below"))
    sample = cut(sample.select("k", "rank", "text").dropDuplicates(["k", "rank"]))
    least = sample.groupBy("k").agg(F.greatest(F.lit(1.0), F.lit(MIN_SHARE) * F.count("*")).alias("least"))
    codes = sample.select("k", "text").mapInArrow(lean(_gram_rows), "k long, code long").groupBy("k", "code").agg(F.count("*").alias("n"))
    codes = codes.join(F.broadcast(least), "k").where("n >= least").select("k", "code")  # a row a language
    bits = codes.mapInArrow(_slot_rows, "slot long, word long, bits long").groupBy("slot", "word").agg(F.bit_or("bits").alias("bits"))
    pieces = bits.withColumn("piece", F.shiftright("slot", PIECE_BITS)).groupBy("piece", "word").applyInPandas(_piece, "piece long, word long, data binary")
    for r in pieces.toLocalIterator():  # the table: 8 MB for 64 languages, packed
        table[r["piece"] << PIECE_BITS : (r["piece"] + 1) << PIECE_BITS, r["word"]] = np.frombuffer(zlib.decompress(r["data"]), dtype=np.uint64)
    release(sample)
    return Model(languages, table)


def _predict(held, text_too: bool):
    def run(batches):
        languages, blob, width = held.value
        model = Model(languages, np.frombuffer(zlib.decompress(blob), dtype=np.uint64).reshape(-1, width).copy())
        for batch in (b.slice(k, ROWS) for b in batches for k in range(0, b.num_rows, ROWS)):
            column = batch.column(batch.num_columns - 1)
            raw, off = padded(column)
            best, score = model.decide(raw, off)
            lang, value = [], []
            for i, text in enumerate(column.to_pylist()):
                known = text is not None and languages and has_letter(text)
                lang.append(languages[best[i]] if known else "und")
                value.append(float(score[i]) if known else 0.0)
            given = batch.num_columns if text_too else batch.num_columns - 1
            yield pa.RecordBatch.from_arrays([*batch.columns[:given], pa.array(lang, pa.string()), pa.array(value, pa.float64())], names=[*batch.schema.names[:given], "lang_pred", "score"])

    return run


def with_language(docs: DataFrame, model: Model, keep: list[str], text_too: bool = True) -> DataFrame:
    """The columns `keep` of docs, text if asked for, and lang_pred and score. lang and source play no part."""
    spark = docs.sparkSession
    held = spark.sparkContext.broadcast((model.languages, zlib.compress(model.table.tobytes(), 1), model.table.shape[1]))
    rows = need(docs, *keep, "text")
    kind = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields if text_too or f.name != "text")
    return rows.mapInArrow(lean(_predict(held, text_too)), f"{kind}, lang_pred string, score double")


def predict(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) for every row; `und` if the text is null or has no letter."""
    out = with_language(docs, fit(docs, per_language), ["doc_id"], text_too=False)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
