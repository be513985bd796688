"""Blending sources to a character budget: targets, caps, deficits, overflow, splits, statistics.

Ordered cuts (keep while the sum before a document is below the target) are two-phase: sums by bucket
of the order first, then a running sum inside each bucket only, so that a source of half the corpus
is no single window partition.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Shares in per cent by source, and of the code bucket by code source, in order.
DATA_MIX = {
    "common_crawl": 10.0, "fineweb": 46.0, "wikipedia": 10.0, "pg19": 2.5, "pes2o": 5.0,
    "open_web_math": 10.0, "stackexchange": 5.0, "synthetic_arithmetic": 1.5, "code": 10.0,
}
CODE_SUBMIX = {"stack_v1": 50.0, "codesearchnet": 35.0, "stack_smol": 10.0, "jupyter": 4.0, "conala": 1.0}
OVERFLOW_SINK = "fineweb"
CORPUS_TOKENS = {"mini": 1_000_000, "125m": 5_500_000_000, "350m": 15_000_000_000, "1b": 30_000_000_000}
EPOCHS = {"mini": 1, "125m": 2, "350m": 2, "1b": 1}
DISPLAY = {"mini": "1M", "125m": "5.5B", "350m": "15B", "1b": "30B"}
CHARS_PER_TOKEN = 4.3
CHARS_PER_SEGMENT = 17_000_000
VAL_FRACTION = 0.005
#: Mean characters of a document and download allowance by source.
DOC_CHARS = {
    "fineweb": 3_000, "wikipedia": 5_000, "pg19": 400_000, "pes2o": 1_400, "open_web_math": 8_000,
    "stackexchange": 1_700, "synthetic_arithmetic": 1_500, "stack_v1": 5_500, "stack_smol": 10_000, "jupyter": 11_000,
}
ALLOWANCE = {"wikipedia": 3.0, "synthetic_arithmetic": 1.5}
#: Row caps of the smallest target.
MINI_CAPS = {
    "common_crawl": 2, "fineweb": 10_000, "wikipedia": 5_000, "pg19": 50, "pes2o": 2_000, "open_web_math": 3_000, "stackexchange": 2_000,
    "synthetic_arithmetic": 2_000, "codesearchnet": 5_000, "stack_smol": 2_000, "stack_v1": 3_000, "jupyter": 500, "conala": 500,
}
SOURCES = [s for s in DATA_MIX if s != "code"] + list(CODE_SUBMIX)


def char_targets(tokens: int, mix: dict[str, float] | None = None, submix: dict[str, float] | None = None) -> dict[str, int]:
    """Characters by source; the code bucket is truncated before it is shared out."""
    mix, submix = mix or DATA_MIX, submix or CODE_SUBMIX
    budget = {s: int(tokens * (p / 100.0) * CHARS_PER_TOKEN) for s, p in mix.items()}
    code = budget.pop("code", None)
    return budget | ({s: int(code * (p / 100.0)) for s, p in submix.items()} if code is not None else {})


def doc_cap(source: str, target: str) -> int | None:
    if source not in DOC_CHARS:
        return None
    share = DATA_MIX[source] / 100.0 if source in DATA_MIX else DATA_MIX["code"] / 100.0 * (CODE_SUBMIX[source] / 100.0)
    return int(CORPUS_TOKENS[target] * share * CHARS_PER_TOKEN / DOC_CHARS[source] * ALLOWANCE.get(source, 5.0))


def crawl_segments(tokens: int) -> int:
    return max(1, math.ceil(int(tokens * (DATA_MIX["common_crawl"] / 100.0) * CHARS_PER_TOKEN) / CHARS_PER_SEGMENT))


def consumed_tokens(target: str) -> int:
    return CORPUS_TOKENS[target] * EPOCHS[target]


#: What a target must say, and the older names of two of them.
TARGET_KEYS = ("corpus_tokens", "epochs", "crawls", "display_corpus")
ALIASES = {"total_tokens": "corpus_tokens", "display_tokens": "display_corpus"}


def mix_faults(mix: dict[str, float] | None = None, submix: dict[str, float] | None = None, sink: str = OVERFLOW_SINK, targets: dict[str, dict] | None = None, mini: dict[str, int] | None = None) -> list[str]:
    """What is wrong with a mix: shares that do not sum to 100, an unknown sink, names in both levels; targets without a key or with an alias that differs; caps of unknown sources."""
    mix, submix = DATA_MIX if mix is None else mix, CODE_SUBMIX if submix is None else submix
    out = [f"{n} sums to {sum(m.values())}" for n, m in (("mix", mix), ("submix", submix)) if abs(sum(m.values()) - 100) > 1e-6]
    out += [f"unknown sink {sink}"] if sink not in mix else []
    out += [f"{s} is in both" for s in sorted(set(mix) & set(submix))]
    for name, target in (targets or {}).items():
        out += [f"{name} lacks {k}" for k in TARGET_KEYS if k not in target]
        out += [f"{name}: {old} differs from {new}" for old, new in ALIASES.items() if old in target and target[old] != target.get(new)]
    return out + [f"unknown source {s}" for s in sorted(set(mini or {}) - set(mix) - set(submix))]


def mix_table(spark: SparkSession, tokens: int) -> DataFrame:
    """(source, ord, target_chars): one row a source, in mix order."""
    return spark.createDataFrame([(s, i, t) for i, (s, t) in enumerate(char_targets(tokens).items())], "source string, ord int, target_chars long")


#: Ranges of the order, of like numbers of rows, that running sums are cut into by key.
BUCKETS = 128


def running(df: DataFrame, keys: list[str], order: str, value: str, out: str) -> DataFrame:
    """df with `out`: the sum of `value` over rows of the same keys that come before by `order` (unique by key).

    Rows are cut into BUCKETS ranges of the order by key, at its approximate quantiles, so that each
    has a like number of rows however the order is spread; bucket totals are a small table, and the
    running sum proper is within a bucket.
    """
    cuts = F.array(*(F.lit(k / BUCKETS) for k in range(1, BUCKETS)))
    edges = df.groupBy(*keys).agg(F.percentile_approx(order, cuts, F.lit(50 * BUCKETS)).alias("_edges"))
    edges = edges.select(*(F.col(k).alias(f"_k_{k}") for k in keys), F.array_distinct("_edges").alias("_edges"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_k_{k}"))
    df = df.join(edges, same).withColumn("_b", F.size(F.filter("_edges", lambda e: e < F.col(order)))).drop("_edges", *(f"_k_{k}" for k in keys))
    before = Window.partitionBy(*keys).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, "_b").agg(F.sum(value).alias("_t")).withColumn("_before", F.coalesce(F.sum("_t").over(before), F.lit(0))).drop("_t")
    inside = Window.partitionBy(*keys, "_b").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return df.join(totals, [*keys, "_b"]).withColumn(out, F.col("_before") + F.coalesce(F.sum(value).over(inside), F.lit(0))).drop("_b", "_before")


def cap(docs: DataFrame, targets: DataFrame) -> DataFrame:
    """docs(doc_id, source, chars) joined to targets(source, target_chars): `before`, and `kept` while it is below the target."""
    out = running(docs.join(targets.select("source", "target_chars"), "source"), ["source"], "doc_id", "chars", "before")
    return out.withColumn("kept", F.col("before") < F.col("target_chars"))


def blend(docs: DataFrame, targets: DataFrame, sink: str) -> DataFrame:
    """Rows of cap() with `overflow`: further documents of the sink, until they make up the deficit of all present sources."""
    capped = cap(docs, targets)
    by_source = capped.groupBy("source").agg(F.max("target_chars").alias("target_chars"), F.sum(F.when(F.col("kept"), F.col("chars")).otherwise(0)).alias("used"))
    deficit = by_source.agg(F.coalesce(F.sum(F.greatest(F.lit(0), F.col("target_chars") - F.col("used"))), F.lit(0)).alias("deficit"), F.coalesce(F.max(F.when(F.col("source") == sink, F.col("used"))), F.lit(0)).alias("sink_used"))
    out = capped.crossJoin(F.broadcast(deficit))  # one row
    after = (F.col("source") == sink) & ~F.col("kept") & (F.col("before") + F.col("chars") > F.col("sink_used")) & (F.col("before") - F.col("sink_used") < F.col("deficit"))
    return out.withColumn("overflow", F.coalesce(after, F.lit(False))).drop("deficit", "sink_used")


def n_val(n: Column, fraction: float = VAL_FRACTION, least: int = 1) -> Column:
    return F.greatest(F.lit(least), F.floor(n * F.lit(fraction)))


def split(docs: DataFrame, seed: str = "42", fraction: float = VAL_FRACTION, least: int = 1, rule: Callable[[Column], Column] | None = None) -> DataFrame:
    """docs with `split`: exactly n_val rows in hash order are 'val', the rest 'train'. A rule gives another number of the whole.

    The threshold is found by counts over hash prefixes (65 536 at most), and only the rows of the
    prefix that it falls into are ranked.
    """
    h = F.md5(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")))
    rows = docs.withColumn("_h", h).withColumn("_p", F.substring("_h", 1, 4))
    counts = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy(F.lit(0))
    n = F.sum("_n").over(whole)
    want = rule(n) if rule else n_val(n, fraction, least)
    counts = counts.withColumn("_want", want).withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy(F.lit(0)).orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    left = counts.where("_before < _want").select("_p", (F.col("_want") - F.col("_before")).alias("_left"), "_n")
    rows = rows.join(F.broadcast(left), "_p", "left")  # 65 536 rows at most
    contested = (F.col("_left") < F.col("_n")) & F.col("_left").isNotNull()
    rank = F.row_number().over(Window.partitionBy("_p").orderBy("_h", "doc_id"))
    ranked = rows.where(contested).withColumn("split", F.when(rank <= F.col("_left"), "val").otherwise("train"))
    whole = rows.where(~contested).withColumn("split", F.when(F.col("_left").isNull(), "train").otherwise("val"))
    return whole.unionByName(ranked).drop("_h", "_p", "_left", "_n")


def blend_stats(blended: DataFrame) -> DataFrame:
    """By source: docs, chars, target, deficit, overflow, and tokens estimated."""
    own = blended.groupBy("source").agg(
        F.count_if("kept").alias("docs"),
        F.sum(F.when(F.col("kept"), F.col("chars")).otherwise(0)).alias("chars"),
        F.max("target_chars").alias("target_chars"),
        F.count_if("overflow").alias("overflow_docs"),
        F.sum(F.when(F.col("overflow"), F.col("chars")).otherwise(0)).alias("overflow_chars"),
    )
    own = own.withColumn("deficit", F.greatest(F.lit(0), F.col("target_chars") - F.col("chars")))
    return own.withColumn("estimated_tokens", F.floor((F.col("chars") + F.col("overflow_chars")) / F.lit(CHARS_PER_TOKEN)).cast("bigint"))


def stats_json(stats: DataFrame) -> DataFrame:
    """The statistics of all sources as one JSON text."""
    entry = F.struct("source", F.struct("docs", "chars", "target_chars", "deficit", "overflow_docs", "overflow_chars").alias("s"))
    return stats.agg(F.to_json(F.struct(F.sum("docs").alias("total_documents"), F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("source_mix"))).alias("stats"))


def head(docs: DataFrame, caps: DataFrame) -> DataFrame:
    """The first rows of each source by doc_id, as many as caps(source, n) says."""
    out = running(docs.withColumn("_one", F.lit(1)).join(caps, "source"), ["source"], "doc_id", "_one", "_before")
    return out.where(F.col("_before") < F.col("n")).drop("_one", "_before", "n")


def flatten(df: DataFrame) -> DataFrame:
    """Nested records (text, id, metadata map) as one map of strings; top-level keys win, file_path goes."""
    top = F.map_filter(F.create_map(F.lit("id"), F.col("id").cast("string")), lambda k, v: v.isNotNull())
    meta = F.map_filter(F.coalesce("metadata", F.expr("map()").cast("map<string,string>")), lambda k, v: ~k.isin("file_path", "text", "id"))
    return df.select("text", F.map_concat(meta, top).alias("meta"))


def chars(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "source", F.length(T.text_or_empty("text")).cast("bigint").alias("chars"))
