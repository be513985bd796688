"""Structured Streaming forms: incremental exact dedup, file intake with back pressure, windowed counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.functions import text as T
from millrace.operators import quality


def intake(spark: SparkSession, path: str, schema: str, files_a_trigger: int = 8) -> DataFrame:
    """New Parquet files of a folder, some at a time; the checkpoint records what has been read."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_a_trigger).parquet(path)


def filtered(stream: DataFrame) -> DataFrame:
    """The quality filter on a stream: the same narrow expression as in batch."""
    return quality.quality_filter(stream)


def dedup_into(stream: DataFrame, table: str, checkpoint: str) -> StreamingQuery:
    """Appends to a Parquet folder the documents whose hash it does not hold yet; the first of a batch by doc_id wins.

    State is the folder itself, not the stream's memory, so it may outgrow any executor. A batch that
    is run again finds its own hashes and adds nothing.
    """

    def add(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        rows = batch.withColumn("hash", T.exact_hash(T.text_or_empty("text")))
        first = rows.groupBy("hash").agg(F.min("doc_id").alias("doc_id"))
        rows = rows.join(first, ["hash", "doc_id"], "left_semi").dropDuplicates(["hash", "doc_id"])
        path = spark._jvm.org.apache.hadoop.fs.Path(table)
        if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
            rows = rows.join(spark.read.schema(rows.schema).parquet(table).select("hash"), "hash", "left_anti")
        rows.write.mode("append").parquet(table)

    return stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def windowed_counts(events: DataFrame, width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """Events and their value by window and type; an extension that batch and stream share."""
    rows = events.withWatermark("ts", late) if events.isStreaming else events
    return rows.groupBy(F.window("ts", width).alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("value")).select(F.col("w.start").alias("start"), "event_type", "n", "value")
