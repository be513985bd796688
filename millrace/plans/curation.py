"""End-to-end plans: filter, dedup, blend, split; and the same dedup as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import blend, dedup, quality, validate
from millrace.streaming import curation as streaming


def curate(docs: DataFrame, targets: DataFrame, sink: str) -> DataFrame:
    """Curated documents with their split: quality, exact and near dedup, budget, overflow, exact-size validation split.

    One pass over the texts filters them and gives their hashes, lengths and signature buckets; all
    else works on ids. The texts are met again by the ids that are chosen. Ids must be unique.
    """
    rows = docs.select("doc_id", "source", "text")
    seen = quality.quality_filter(rows)
    buckets = F.transform(dedup.band_keys(), lambda b: F.xxhash64(F.col("source"), b["band"], b["key"]))
    chars = F.length(T.text_or_empty("text")).cast("bigint")
    seen = dedup.cut(seen.select(*dedup.hash_columns(), chars.alias("chars"), buckets.alias("buckets")))
    first = dedup.cut(dedup.survivors_of(seen.drop("chars", "buckets")).where("kept").select("doc_id"))
    own = dedup.cut(seen.join(first, "doc_id", "left_semi").select("doc_id", "source", "chars", "skip", "buckets"))
    found = dedup.clusters(dedup.bucket_edges(own.where("not skip").select("doc_id", F.explode("buckets").alias("bucket"))))
    kept = own.join(found.where("doc_id <> cluster"), "doc_id", "left_anti").select("doc_id", "source", "chars")
    chosen = blend.split(blend.blend(dedup.cut(kept), targets, sink).where("kept or overflow").select("doc_id"))
    return rows.join(chosen, "doc_id")


def validated(docs: DataFrame, threshold: float | None = None) -> DataFrame:
    return validate.validate(docs, threshold).where("reason is null").drop("reason")


def funnel(docs: DataFrame) -> DataFrame:
    """By source with documents left: raw, filtered, and after exact dedup of what was filtered."""
    rows = docs.select("doc_id", "source", "text")
    raw = rows.groupBy("source").agg(F.count("*").alias("raw"))
    judged = dedup.cut(dedup.hashed(quality.quality_filter(rows)))  # the filter and the hash once; ids and hashes from here on
    left = dedup.survivors_of(judged).groupBy("source").agg(F.count("*").alias("filtered"), F.count_if("kept").alias("deduped"))
    return left.join(raw, "source").select("source", "raw", "filtered", "deduped")


def stream_dedup(spark: SparkSession, path: str) -> DataFrame:
    """(hash, doc_id): what a stream over the files of path (a file or a folder) leaves in a table."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        import tempfile

        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    base = f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"
    schema = spark.read.parquet(path).schema
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where).isFile():  # a stream reads folders
        reader, path = reader.option("pathGlobFilter", where.getName()), where.getParent().toString()
    streaming.dedup_into(reader.parquet(path), f"{base}/table", f"{base}/checkpoint").awaitTermination()
    return spark.read.parquet(f"{base}/table").select("hash", "doc_id")


def exact_hash_of(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", T.exact_hash(T.text_or_empty("text")).alias("hash"))
