"""Shared parts of the training-data operators: durable cuts and column guards."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
import zlib
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Separators of words in every contract: space, tab, LF, VT, FF, CR.
SPACE_CLASS = r"[\x20\x09-\x0D]"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir. Where it is unset, a temporary one, in local mode only."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        named = spark.sparkContext.getCheckpointDir()
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        named = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def cut(df: DataFrame) -> DataFrame:
    """Writes df as Parquet into the shared folder and reads it back.

    This cuts the lineage: a lost executor costs a reread, not a recomputation. The shuffle files of the
    plan go once it is written, without waiting for the driver's collector.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/millrace-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    with setting(spark, "spark.sql.classic.shuffleDependency.fileCleanup.enabled", "true"):
        df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Deletes the files of tables that cut() wrote. Only for tables that all that follows has been cut from."""
    for df in cuts:
        if path := getattr(df, "_cut_path", None):
            spark = df.sparkSession
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def forget_shuffles(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of plans that are done with, which it does once the driver's collector has met them."""
    gc.collect()
    spark._jvm.System.gc()


def shrink_heaps(spark: SparkSession) -> None:
    """Executors give back the heap that earlier work grew and no longer uses, which Python workers beside them can need.

    A task for each core collects the heap of the executor that it runs in; where all are idle, that is each executor.
    Results do not depend on it.
    """
    cores = spark.sparkContext.defaultParallelism
    spark.range(0, cores, 1, cores).select(F.java_method(F.lit("java.lang.System"), F.lit("gc")).alias("done")).collect()  # a null a core


@contextmanager
def setting(spark: SparkSession, name: str, value: str):
    """What is run inside runs with that value of a setting."""
    before = spark.conf.get(name)
    spark.conf.set(name, value)
    try:
        yield
    finally:
        spark.conf.set(name, before)


def small_batches(spark: SparkSession, rows: int):
    """Python is handed so many rows at a time by what is run inside: for rows of many kilobytes."""
    return setting(spark, "spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def lean(run):
    """run(batches), after which the worker, which later tasks use again, gives memory back that it has freed."""

    def whole(batches):
        yield from run(batches)
        gc.collect()
        pa.default_memory_pool().release_unused()
        if (trim := getattr(ctypes.CDLL(None), "malloc_trim", None)) is not None:
            trim(0)

    return whole


#: A group with more than this share of all rows is dealt by broadcast; there are at most as many as its inverse.
HOT_SHARE = 0.001


def join_groups(rows: DataFrame, groups: DataFrame, key: str, size: str) -> DataFrame:
    """rows left join groups, one row of which has each key and its number of rows.

    Groups of more than HOT_SHARE of all rows, at most 1 / HOT_SHARE of them, are broadcast, so that
    no task gets the rows of one; the rest is joined by shuffle. Rows of a null key match nothing.
    """
    total = groups.agg(F.coalesce(F.sum(size), F.lit(0)).alias("t")).first()["t"]
    hot = groups.where(F.col(size) > max(1.0, total * HOT_SHARE)).drop(size)
    given = [c for c in groups.columns if c not in (key, size)]
    none = rows.where(F.col(key).isNull()).select(*rows.columns, *(F.lit(None).cast(groups.schema[c].dataType).alias(c) for c in given))
    rows = rows.where(F.col(key).isNotNull())
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), key, "left")
    few = marked.where("_hot").select(*rows.columns, *given)
    many = marked.where("_hot is null").select(*rows.columns).join(groups.drop(size), key, "left").select(*rows.columns, *given)
    return few.unionByName(many).unionByName(none)


def need(df: DataFrame, *columns: str) -> DataFrame:
    """Only the named columns, so that extra columns of any name cannot clash with derived ones."""
    return df.select(*(F.col(f"`{c}`") for c in columns))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def runs_of_rows(batches, keys: int):
    """The rows of each run of equal first `keys` columns, as arrays; a run may cross batches. Null whole numbers are 0."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [(c.fill_null(0) if c.null_count and pa.types.is_integer(c.type) else c).to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate([h, c]) for h, c in zip(held, columns, strict=True)]
        change = np.zeros(len(columns[0]), dtype=bool)
        change[0] = True
        for c in columns[:keys]:
            change[1:] |= c[1:] != c[:-1]
        edges = np.flatnonzero(change).tolist()
        for a, b in zip(edges, edges[1:]):
            yield [c[a:b] for c in columns]
        held = [c[edges[-1] :] for c in columns]
    if held is not None:
        yield held


def _bitmap(bits: int):
    def run(batches):
        table = np.zeros(1 << bits, dtype=bool)
        for batch in batches:
            table[(batch.column(0).to_numpy().view(np.uint64) & np.uint64((1 << bits) - 1)).astype(np.int64)] = True
        yield pa.RecordBatch.from_arrays([pa.array([zlib.compress(np.packbits(table).tobytes(), 1)], pa.binary())], names=["bits"])

    return run


def _or_all(pdf):
    total = None
    for blob in pdf["bits"]:
        own = np.frombuffer(zlib.decompress(blob), dtype=np.uint8)
        total = own.copy() if total is None else total | own
    return pdf.iloc[:1].assign(bits=[zlib.compress(total.tobytes(), 1)])


#: log2 of the bits of a filter of numbers: by how many there are, up to a limit; false hits only cost bytes.
LEAST_BITS, MOST_BITS = 16, 28
#: Numbers that the driver makes a filter of itself at most, 8 bytes each; more are put into bitmaps by tasks.
FEW_NUMBERS = 500_000


def number_filter(numbers: DataFrame, count: int):
    """(broadcast bitmap, its log2 of bits) of a column of 64-bit numbers, by their low bits: 16 bits a number, 32 MB at most."""
    bits = min(MOST_BITS, max(LEAST_BITS, (16 * count).bit_length()))
    if count <= FEW_NUMBERS:
        made = next(_bitmap(bits)(numbers.toArrow().to_batches()))
        return numbers.sparkSession.sparkContext.broadcast(made.column(0)[0].as_py()), bits
    found = numbers.mapInArrow(_bitmap(bits), "bits binary")
    for parts in (16, 1):  # at most 16 rows of a fixed size meet in the last task
        found = found.withColumn("g", F.pmod(F.xxhash64("bits"), F.lit(parts))).groupBy("g").applyInPandas(_or_all, "bits binary, g long").select("bits")
    found = found.collect()
    return numbers.sparkSession.sparkContext.broadcast(bytes(found[0]["bits"]) if found else zlib.compress(bytes(1 << bits - 3))), bits


def unpacked(held) -> np.ndarray:
    """A broadcast bitmap as an array of truth values."""
    return np.unpackbits(np.frombuffer(zlib.decompress(held.value), dtype=np.uint8)).view(bool)
