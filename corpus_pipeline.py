"""The corpus pipeline: language ID, near-duplicate join, personal data, mixing, packing.

Each stage takes (spark, docs, sf_dir), works on all rows that the stage before it kept, and is
written as Parquet and read back before the next one. All but the last return the columns of
`documents`.
"""

from __future__ import annotations

import uuid
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import langid, mixing, ngram_join, packing, pii_crf
from millrace.llm.common import cut, documents, forget_shuffles, need, shared_dir, shrink_heaps
from millrace.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: Below this corrected share of n-grams no language is believed; clean prose has far more.
LEAST_SCORE = 0.3


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter or text, and those in which no learned language is recognised.

    A text too short for an n-gram has nothing against it, and is kept.
    """
    model = langid.fit(docs)
    out = langid.with_language(docs, model, [c for c in COLUMNS if c != "text"])
    return out.where((F.col("lang_pred") != "und") & ((F.col("score") >= LEAST_SCORE) | (F.octet_length("text") < langid.GRAM))).select(*COLUMNS)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near copies: the one of the smallest id, of the smallest text hash among rows of that id.

    Rows without an id take part by an id made of their content, after all given ones. Rows equal in
    id and text are one document; the one of the smallest source, language and length stays. Texts
    are not shuffled but for rows that a filter cannot tell from those that go (see _doubtful).
    """
    content = F.xxhash64("text", "lang", "source", "n_chars").bitwiseAND(F.lit((1 << 61) - 1)) + F.lit(1 << 62)
    rows = need(docs, *COLUMNS).withColumn("_id", F.coalesce(F.col("doc_id").cast("long"), content)).withColumn("_print", F.xxhash64("text"))
    groups = cut(ngram_join.groups_of(rows.select(F.col("_id").alias("doc_id"), "text")).select("doc_id", "print", "first_id", "first_print"))
    forget_shuffles(spark)
    shrink_heaps(spark)
    gone = groups.where("first_id is not null and (doc_id <> first_id or print <> first_print)").select(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).distinct()
    twice = groups.groupBy(F.col("doc_id").alias("_id"), F.col("print").alias("_print")).agg(F.count("*").alias("n")).where("n > 1").select("_id", "_print")
    gone, twice = cut(gone), cut(twice)
    sure, maybe = _doubtful(rows, gone.unionByName(twice))
    maybe = maybe.join(gone, ["_id", "_print"], "left_anti")
    once = maybe.join(twice, ["_id", "_print"], "left_anti").select(*COLUMNS)
    least = F.min(F.struct("source", "lang", "n_chars", "doc_id", "text")).alias("r")
    again = maybe.join(twice, ["_id", "_print"], "left_semi").groupBy("_id", "_print").agg(least).select(*(f"r.{c}" for c in COLUMNS))
    return sure.select(*COLUMNS).unionByName(once).unionByName(again)


#: Bits of the filter of rows that may go: 16 for each, up to this power of two (16 MB).
MOST_BITS = 27


def _doubtful(rows: DataFrame, marked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """rows (with _id, _print) in two parts: those surely not in marked(_id, _print), and those that may be.

    A bitmap with two bits for each marked row is joined by broadcast, in pieces of 4 KB. Beyond
    MOST_BITS / 16 marked rows more and more of the rest may be, and is told apart by the joins that follow.
    """
    bits = min(MOST_BITS, max(15, (16 * marked.count()).bit_length()))
    place = [F.pmod(F.shiftright(F.xxhash64("_id", "_print"), k), F.lit(1 << bits)) for k in (0, 28)]
    bitmap = marked.select(F.explode(F.array(*place)).alias("p")).groupBy(F.bitmap_bucket_number("p").alias("piece")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("bits"))
    bitmap = cut(bitmap)
    out = rows
    for k, p in enumerate(place):
        own = bitmap.select(F.col("piece").alias(f"_piece{k}"), F.col("bits").alias(f"_bits{k}"))
        out = out.withColumn(f"_p{k}", p).join(F.broadcast(own), F.bitmap_bucket_number(f"_p{k}") == F.col(f"_piece{k}"), "left")  # at most 2 ** (bits - 15) rows of 4 KB
    hit = F.lit(True)
    for k in range(len(place)):
        at = F.bitmap_bit_position(f"_p{k}")
        byte = F.conv(F.hex(F.substring(f"_bits{k}", (at / 8).cast("int") + 1, 1)), 16, 10).cast("int")
        hit = hit & F.coalesce(F.call_function("getbit", byte, (at % 8).cast("int")) == 1, F.lit(False))
    return out.where(~hit).select(*rows.columns), out.where(hit).select(*rows.columns)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data by its kind in brackets; keeps every document."""
    out = pii_crf.scan(docs, [c for c in COLUMNS if c not in ("text", "n_chars")], redact=True)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeats or leaves out whole documents by the quotas of the mix's shards, at even steps: see mixing.copies. Texts without a word stay once."""
    out = mixing.copies(need(docs, *COLUMNS)).where("copies > 0")
    return out.select(*COLUMNS, F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("_copy")).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, tokenizer_path())


#: Rows that Python workers are handed at a time: texts are of kilobytes, and workers live through all stages.
BATCH_ROWS = 1000


def _staged(stage):
    """The stage, with batches of BATCH_ROWS for all that the session runs from then on, after the heaps that the one before grew are given back."""

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
        shrink_heaps(spark)
        return stage(spark, docs, sf_dir)

    return run_stage


STAGES = [(name, _staged(stage)) for name, stage in (("language", language), ("near_duplicates", near_duplicates), ("personal_data", personal_data), ("mix_sources", mix_sources), ("packing", pack))]

#: None: language models, fields and token ids are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        path = f"{shared_dir(spark)}/pipeline-{name}-{uuid.uuid4().hex}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
