"""Sinks: sharded JSON lines, split folders, token tables with a manifest, versioned folders."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def jsonl(df: DataFrame, path: str, rows_a_file: int = 100_000) -> None:
    """All or nothing: the committer renames files only when the job has ended."""
    df.write.mode("overwrite").option("maxRecordsPerFile", rows_a_file).json(path)


def splits(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").partitionBy("split").json(path)


def versioned(base: str, target: str, date: str, stage: str = "curated") -> str:
    return f"{base.rstrip('/')}/{target}/{date}/{stage}"


def date_path(at: Column) -> Column:
    """The date part of a versioned path."""
    return F.date_format(at, "yyyy-MM-dd")


def stamp(at: Column) -> Column:
    """A moment in a file's name, in the session's time zone (UTC)."""
    return F.date_format(at, "yyyyMMdd'T'HHmmss'Z'")


def missing(files: DataFrame, there: DataFrame) -> DataFrame:
    """Those of files(key, size) that a store does not hold yet with the same size."""
    return files.join(there.select("key", "size"), ["key", "size"], "left_anti")


def fingerprint(spark: SparkSession, path: str) -> str:
    """The SHA-256 of a file that all executors can read: what a tokenizer is known by."""
    return spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]


def manifest_of(df: DataFrame, **named) -> dict:
    """What a token table's manifest says: documents, tokens, the largest id, its type and format, and what is named."""
    one = df.agg(F.count("*").alias("n_docs"), F.coalesce(F.sum(F.size("ids")), F.lit(0)).alias("n_tokens"), F.coalesce(F.max(F.array_max("ids")), F.lit(0)).alias("max_id")).first()
    return {"n_docs": one["n_docs"], "n_tokens": one["n_tokens"], "max_id": one["max_id"], "dtype": "uint16" if one["max_id"] < 1 << 16 else "uint32", "format_version": FORMAT_VERSION} | named


FORMAT_VERSION = 1


def tokens(df: DataFrame, path: str, manifest: dict) -> None:
    """Token arrays as Parquet, and beside them a manifest: counts of what was written, and what it was made with."""
    df.write.mode("overwrite").parquet(path)
    manifest = manifest_of(df.sparkSession.read.parquet(path), **manifest)
    df.sparkSession.createDataFrame([(json.dumps(manifest, sort_keys=True),)], "manifest string").coalesce(1).write.mode("overwrite").text(f"{path.rstrip('/')}.manifest")


def read_tokens(spark: SparkSession, path: str, expected: dict) -> DataFrame:
    """The token table, refused if its manifest differs in a key that is expected."""
    held = json.loads(spark.read.text(f"{path.rstrip('/')}.manifest").first()[0])
    if stale := {k: (held.get(k), v) for k, v in expected.items() if held.get(k) != v}:
        raise ValueError(f"stale tokens at {path}: {stale}")
    return spark.read.parquet(path)


def uint16(df: DataFrame) -> DataFrame:
    """(doc_id, data): ids as unsigned 16-bit little-endian bytes, for flat binary files."""
    hexed = F.array_join(F.transform("ids", lambda i: F.concat(F.lpad(F.hex(i % 256), 2, "0"), F.lpad(F.hex(F.floor(i / 256)), 2, "0"))), "")
    return df.select("doc_id", F.unhex(hexed).alias("data"))
