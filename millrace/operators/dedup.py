"""Exact and near-duplicate removal: first wins, across sources for exact and within a source for near copies.

Order is (source rank, doc_id, null ids last). Texts stay out of the shuffles: hashes and ids move,
and texts are met again by a semi-join. Exact survivors are the least ordinal of a hash, which
aggregates on the map side. Rows equal in id, source and hash are one document, of which one row stays.
"""

from __future__ import annotations

import random
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T

BANDS, ROWS, GRAM = 14, 8, 5


def cut(df: DataFrame) -> DataFrame:
    """df written to the shared checkpoint folder and read back; a local folder only where none is set."""
    spark = df.sparkSession
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    path = f"{base.rstrip('/')}/dedup-{spark.sparkContext.applicationId}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._cut_path = path
    return out


def release(*cuts: DataFrame) -> None:
    """Deletes the files of tables that cut() wrote and that nothing reads any more."""
    for df in cuts:
        if path := getattr(df, "_cut_path", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


def source_rank(order: list[str] | None = None) -> Column:
    """Position of a source in the given order; without one, the number at its end."""
    if order:
        return F.coalesce(F.array_position(F.array(*map(F.lit, order)), F.col("source")), F.lit(0)).cast("int")
    return F.coalesce(F.regexp_extract("source", r"(\d+)$", 1).try_cast("int"), F.lit(0))


def hash_columns(order: list[str] | None = None, bypass: tuple[str, ...] = ("synthetic_arithmetic",)) -> list[Column]:
    """doc_id, source, rank, hash and skip: what exact dedup needs of each row."""
    skip = F.coalesce(F.col("source").isin(*bypass), F.lit(False)) if bypass else F.lit(False)
    return [F.col("doc_id"), F.col("source"), source_rank(order).alias("rank"), T.exact_hash(T.text_or_empty("text")).alias("hash"), skip.alias("skip")]


def hashed(docs: DataFrame, order: list[str] | None = None, bypass: tuple[str, ...] = ("synthetic_arithmetic",)) -> DataFrame:
    return docs.select(*hash_columns(order, bypass))


def survivors_of(rows: DataFrame) -> DataFrame:
    """(doc_id, source, hash, kept) of rows of hashed()."""
    place = F.struct("rank", F.col("doc_id").isNull().alias("none"), "doc_id", "source")
    first = rows.where("not skip").groupBy("hash").agg(F.min(place).alias("first"))
    out = rows.join(first, "hash", "left").withColumn("chosen", ~F.col("skip") & F.coalesce(F.col("first").eqNullSafe(place), F.lit(False)))
    # Of rows equal in all of that, one; the others of a hash are not ordered.
    nth = F.row_number().over(Window.partitionBy("hash", "chosen").orderBy(F.lit(0)))
    one = out.where("chosen").withColumn("kept", nth == 1)
    return one.unionByName(out.where("not chosen").withColumn("kept", F.col("skip"))).select("doc_id", "source", "hash", "kept")


def exact_survivors(docs: DataFrame, order: list[str] | None = None, bypass: tuple[str, ...] = ("synthetic_arithmetic",)) -> DataFrame:
    """(doc_id, source, hash, kept): the first of each hash is kept; sources in `bypass` neither lose nor claim a hash."""
    return survivors_of(hashed(docs, order, bypass))


def exact_dedup(docs: DataFrame, order: list[str] | None = None, bypass: tuple[str, ...] = ("synthetic_arithmetic",)) -> DataFrame:
    """The rows of docs that are first of their hash."""
    own = hashed(docs, order, bypass)
    kept = survivors_of(own).where("kept").select(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("hash").alias("_h"))
    twice = own.where("not skip").groupBy(F.col("doc_id").alias("_i"), F.col("source").alias("_s"), F.col("hash").alias("_h")).agg(F.count("*").alias("n")).where("n > 1").drop("n")
    rows = docs.withColumn("_hash", T.exact_hash(T.text_or_empty("text")))
    same = F.col("doc_id").eqNullSafe(F.col("_i")) & F.col("source").eqNullSafe(F.col("_s")) & (F.col("_hash") == F.col("_h"))
    rows = rows.join(kept, same, "left_semi")
    many = rows.join(twice, same, "left_semi").dropDuplicates(["doc_id", "source", "_hash"])
    return rows.join(twice, same, "left_anti").unionByName(many).drop("_hash")


def new_only(docs: DataFrame, seen: DataFrame) -> DataFrame:
    """Documents whose hash is not in seen(hash): the incremental form."""
    return docs.withColumn("hash", T.exact_hash(T.text_or_empty("text"))).join(seen.select("hash").distinct(), "hash", "left_anti")


#: Fixed value: the prime that the hash functions are taken modulo.
PRIME = (1 << 31) - 1


def functions(n: int, seed: int = 42) -> list[tuple[int, int]]:
    """(a, b) of n hash functions (a x + b) mod PRIME."""
    rng = random.Random(seed)
    return [(rng.randrange(1, PRIME), rng.randrange(PRIME)) for _ in range(n)]


def _permuted(a: int, b: int):
    return lambda x: (x * F.lit(a) + F.lit(b)) % F.lit(PRIME)


def band_keys(bands: int = BANDS, rows: int = ROWS, gram: int = GRAM) -> Column:
    """The bands of a MinHash signature over word n-grams of `text`, as an array of (band, key); empty for fewer than `gram` words.

    Each n-gram is hashed once, by MD5; the functions are whole-number arithmetic on that, which
    other engines do alike.
    """
    grams = T.ngrams(T.words(T.normalize(T.text_or_empty("text"))), gram)
    hashes = F.array_distinct(F.transform(grams, lambda g: F.pmod(T.portable_hash(g), F.lit(PRIME))))

    def keys(g: Column) -> Column:
        least = [F.array_min(F.transform(g, _permuted(a, b))) for a, b in functions(bands * rows)]
        return F.array(*(F.struct(F.lit(k).alias("band"), F.concat_ws("-", *(x.cast("string") for x in least[k * rows : (k + 1) * rows])).alias("key")) for k in range(bands)))

    return F.filter(T.let(hashes, keys), lambda b: b["key"] != "")


def signatures(docs: DataFrame, bands: int = BANDS, rows: int = ROWS, gram: int = GRAM) -> DataFrame:
    """(doc_id, source, band, key): the band_keys() of docs(doc_id, source, text), a row each."""
    return docs.select("doc_id", "source", F.explode(band_keys(bands, rows, gram)).alias("b")).select("doc_id", "source", "b.band", "b.key")


def star_edges(sig: DataFrame) -> DataFrame:
    """(src, dst) of signatures(): see bucket_edges. Buckets are known by hashes of their keys."""
    return bucket_edges(cut(sig.select("doc_id", F.xxhash64("source", "band", "key").alias("bucket"))))


def bucket_edges(rows: DataFrame) -> DataFrame:
    """(src, dst): each member of a bucket with its least id; linear in the bucket. rows(doc_id, bucket) are read twice."""
    rows = rows.where("doc_id is not null")
    least = rows.groupBy("bucket").agg(F.min("doc_id").alias("src"), F.max("doc_id").alias("most")).where("src <> most")
    return rows.join(least.drop("most"), "bucket").where("doc_id <> src").select("src", F.col("doc_id").alias("dst")).distinct()


def clusters(edges: DataFrame) -> DataFrame:
    """(doc_id, cluster): least reachable id, by alternating large and small stars until nothing changes."""
    edges = cut(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct())
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        big = both.where("v > u").join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = big.groupBy("u").agg(F.min("v").alias("m"))
        moved = big.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        old, edges = edges, cut(moved.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        release(old)
        now = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")), F.bit_xor(F.xxhash64("v", "u"))).first()
        if now == state:
            break
        state = now
    return edges.groupBy("u").agg(F.min("v").alias("cluster")).select(F.col("u").alias("doc_id"), "cluster").unionByName(edges.select(F.col("v").alias("doc_id"), F.col("v").alias("cluster")).distinct())


def fuzzy_survivors(docs: DataFrame, bypass: tuple[str, ...] = ("synthetic_arithmetic",)) -> DataFrame:
    """(doc_id, source, cluster, kept): the least id of each cluster within a source is kept. Rows without an id are in no cluster and kept."""
    skip = F.coalesce(F.col("source").isin(*bypass), F.lit(False)) if bypass else F.lit(False)
    found = clusters(star_edges(signatures(docs.where(~skip))))
    return docs.select("doc_id", "source").join(found, "doc_id", "left").select("doc_id", "source", F.coalesce("cluster", "doc_id").alias("cluster")).withColumn("kept", F.col("cluster").eqNullSafe(F.col("doc_id")))


def dedup(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """Exact across sources, then near copies within each source."""
    rest = exact_dedup(docs, order)
    return rest.join(fuzzy_survivors(rest).where("not kept").select("doc_id").distinct(), "doc_id", "left_anti")


def removed(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """What dedup() takes out, for a sink: the columns of docs and `stage`, exact or near."""
    rest = exact_dedup(docs, order)
    near = rest.join(fuzzy_survivors(rest).where("not kept").select("doc_id").distinct(), "doc_id", "left_semi").withColumn("stage", F.lit("near"))
    return docs.exceptAll(rest).withColumn("stage", F.lit("exact")).unionByName(near.select(*docs.columns, "stage"))


def report(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """By source: documents, kept, exact duplicates."""
    return exact_survivors(docs, order).groupBy("source").agg(F.count("*").alias("total"), F.count_if("kept").alias("kept"), F.count_if(~F.col("kept")).alias("exact_duplicates"))


def index_size(docs: DataFrame) -> DataFrame:
    """Distinct hashes, and the bytes of an index of them."""
    n = F.count_distinct(T.exact_hash(T.text_or_empty("text")))
    return docs.agg(n.alias("hashes"), (n * 8).alias("index_bytes"))
