"""Summary queries over a corpus and over evaluation results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.blend import CHARS_PER_TOKEN
from millrace.operators.validate import ends_well

#: Words left out of frequency lists.
COMMON = ("the", "and", "for", "that", "with", "this", "from", "are", "was", "not")


def by_source(docs: DataFrame) -> DataFrame:
    n = F.sum(F.length("text"))
    return docs.groupBy("source").agg(F.count("*").alias("docs"), n.alias("total_chars"), F.floor(n / F.count("*")).alias("avg_chars"), F.floor(n / F.lit(CHARS_PER_TOKEN)).alias("est_tokens"))


def share(df: DataFrame, by: str) -> DataFrame:
    n = df.groupBy(by).agg(F.count("*").alias("_n"))
    return n.select(by, F.round(100.0 * F.col("_n") / F.sum("_n").over(Window.partitionBy(F.lit(0))), 6).alias("pct"))


def length_summary(docs: DataFrame) -> DataFrame:
    n = F.length("text")
    return docs.groupBy("source").agg(
        F.count("*").alias("n"), F.min(n).alias("least"), F.floor(F.percentile(n, 0.5)).alias("median"),
        F.floor(F.avg(n)).alias("mean"), F.max(n).alias("most"), F.round(F.percentile(n, 0.95), 3).alias("p95"),
    )


def quantiles(df: DataFrame, by: str, value: str, qs: tuple[float, ...]) -> DataFrame:
    return df.groupBy(by).agg(*(F.round(F.percentile(value, q), 3).alias(f"p{round(q * 100)}") for q in qs))


def before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    both = before.select(F.lit("before").alias("stage"), F.length("text").alias("n")).unionByName(after.select(F.lit("after").alias("stage"), F.length("text").alias("n")))
    return both.groupBy("stage").agg(F.round(F.avg("n"), 6).alias("mean"), F.percentile("n", 0.5).alias("median"))


def extremes(df: DataFrame, key: str, value: str, k: int) -> DataFrame:
    rows = df.where(F.col(value).isNotNull()).select(key, F.col(value).alias("_v"))
    ends = ((F.desc("_v"), "top"), (F.asc("_v"), "bottom"))
    top, bottom = (rows.orderBy(order, key).limit(k).select(F.lit(name).alias("side"), key, F.round("_v", 3).alias(value)) for order, name in ends)
    return top.unionByName(bottom)


def terminal_ratio(docs: DataFrame) -> DataFrame:
    lines = T.lines(T.text_or_empty("text"))
    own = F.coalesce(F.size(F.filter(lines, ends_well)) / F.nullif(F.size(lines), F.lit(0)), F.lit(0.0))
    return docs.groupBy("source").agg(F.round(F.avg(own), 6).alias("ratio"))


def retention(judged: DataFrame) -> DataFrame:
    kept = F.count_if(F.col("reason").isNull())
    return judged.agg(F.count("*").alias("curated"), kept.alias("validated"), F.round(kept / F.count("*"), 6).alias("retention"))


def target_vs_realized(targets: DataFrame, docs: DataFrame) -> DataFrame:
    every = Window.partitionBy(F.lit(0))
    real = docs.groupBy("source").agg(F.sum("chars").alias("_n"))
    out = targets.join(real, "source", "left")
    return out.select("source", F.round(100.0 * F.col("target_chars") / F.sum("target_chars").over(every), 6).alias("target_pct"), F.round(F.coalesce(100.0 * F.col("_n") / F.sum("_n").over(every), F.lit(0.0)), 6).alias("realized_pct"))


def top_words(docs: DataFrame, k: int = 15) -> DataFrame:
    """The commonest lower-case words of three letters or more by source, over all words of all documents; ties by word."""
    every = F.regexp_extract_all(F.lower(T.text_or_empty("text")), F.lit(f"([{T.WORD_CHARS}]+)"), F.lit(1))
    found = F.filter(every, lambda w: w.rlike("^[a-z]{3,}$"))
    n = docs.select("source", F.explode(found).alias("word")).where(~F.col("word").isin(*COMMON)).groupBy("source", "word").agg(F.count("*").alias("n"))
    return n.withColumn("rank", F.row_number().over(Window.partitionBy("source").orderBy(F.desc("n"), "word"))).where(F.col("rank") <= k)


def histogram(df: DataFrame, by: str, value: str, lo: float, hi: float, bins: int) -> DataFrame:
    """Counts by equal bins; values beyond the last edge count in the last bin."""
    at = F.least(F.floor((F.col(value) - lo) / ((hi - lo) / bins)), F.lit(bins - 1))
    return df.groupBy(by, at.alias("bin")).agg(F.count("*").alias("n"))


def turns(conversations: DataFrame) -> DataFrame:
    own = conversations.groupBy("conv_id").agg(F.count("*").alias("turns"), F.sum(F.length("text")).alias("chars"))
    return own.groupBy("turns").agg(F.count("*").alias("conversations"), F.sum("chars").alias("chars"))


def over_limit(lengths: DataFrame) -> DataFrame:
    n = F.count("*")
    return lengths.agg(
        (F.count_if(F.col("n") > 2048) / n).alias("over_2048"), (F.count_if(F.col("n") > 4096) / n).alias("over_4096"), F.round(F.avg("n"), 6).alias("mean"),
        F.percentile("n", 0.5).alias("median"), F.round(F.percentile("n", 0.95), 6).alias("p95"),
    )


def moving_average(df: DataFrame, by: str, order: tuple[str, ...], value: str, width: int) -> DataFrame:
    """The mean over `width` rows, where there are that many."""
    w = Window.partitionBy(by).orderBy(*order).rowsBetween(1 - width, 0)
    out = df.select(by, order[-1], F.avg(value).over(w).alias("_m"), F.count("*").over(w).alias("_n"))
    return out.where(F.col("_n") == width).select(by, order[-1], F.round("_m", 6).alias("moving"))


def behaviour(cases: DataFrame, max_words: int = 35, check_runs: bool = True, run: int = 6) -> DataFrame:
    """cases with `failures`: which expectations of a case its output misses."""
    low = F.lower("output")
    has = lambda x: F.contains(low, F.lower(x))
    words = T.words(T.strip(low))
    tests = [
        F.when(T.strip(T.text_or_empty("output")) == "", "empty"),
        F.when(~F.forall("must_contain", has), "missing"),
        F.when((F.size("must_contain_any") > 0) & ~F.exists("must_contain_any", has), "missing_any"),
        F.when(F.exists("must_not_contain", has), "forbidden"),
        F.when(F.col("category").isin("simple_factual", "stop_behavior") & (F.size(words) > max_words), "too_long"),
    ]
    if check_runs:
        tests.append(F.when(T.longest_run(F.regexp_extract_all(low, F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))) >= run, "repeated"))
    return cases.withColumn("failures", F.filter(F.array(*tests), lambda x: x.isNotNull()))


def pass_rate(judged: DataFrame) -> DataFrame:
    return judged.groupBy("category").agg(F.count("*").alias("cases"), F.count_if(F.size("failures") == 0).alias("passed"))


def eval_pivot(scores: DataFrame, tasks: list[str], baseline: str) -> DataFrame:
    """model by task, with each task's difference from the baseline model."""
    wide = scores.groupBy("model").pivot("task", tasks).agg(F.avg("value"))
    every = Window.partitionBy(F.lit(0))
    base = {t: F.max(F.when(F.col("model") == baseline, F.col(t))).over(every) for t in tasks}
    return wide.select("model", *(F.round(t, 6).alias(t) for t in tasks), *(F.round(F.col(t) - base[t], 6).alias(f"{t}_delta") for t in tasks))


def _named(n: str):
    return lambda k, v: F.startswith(k, F.lit(f"{n},"))


def resolve_metric(results: Column, names: tuple[str, ...]) -> Column:
    """The first metric that is there, under its name, its name with ',none', or with any filter."""
    out = []
    for n in names:
        by_filter = F.map_values(F.map_filter(results, _named(n)))
        out += [results[n], results[f"{n},none"], F.get(by_filter, F.lit(0))]
    return F.coalesce(*out)


#: n-grams of a benchmark that are broadcast at most, 8 bytes each; more are joined by shuffle.
FEW_GRAMS = 2_000_000


def overlap(docs: DataFrame, benchmark: DataFrame, n: int = 13) -> DataFrame:
    """(doc_id, shared): distinct n-grams that a document shares with a benchmark, known by 64-bit hashes; an extension."""
    grams = lambda df, *keep: df.select(*keep, F.explode(F.array_distinct(F.transform(T.ngrams(T.words(T.normalize(T.text_or_empty("text"))), n), lambda g: F.xxhash64(g)))).alias("g"))
    known = grams(benchmark).distinct()
    if known.count() <= FEW_GRAMS:
        known = F.broadcast(known)
    return grams(docs, "doc_id").join(known, "g", "left_semi").groupBy("doc_id").agg(F.count_distinct("g").alias("shared"))


def mix_markdown(realized: DataFrame) -> DataFrame:
    """(ord, line): target_vs_realized() as the lines of a Markdown table, by source."""
    row = F.concat(F.lit("| `"), "source", F.lit("` | "), F.format_string("%.1f%% | %.2f%% |", F.col("target_pct"), F.col("realized_pct")))
    body = realized.select(F.row_number().over(Window.orderBy("source")).alias("ord"), row.alias("line"))  # a row a source
    head = realized.sparkSession.createDataFrame([(-1, "| Source | Target share | Realized share |"), (0, "|---|---|---|")], "ord int, line string")
    return head.unionByName(body)


def benchmark_scores(meta: DataFrame, tasks: DataFrame, groups: DataFrame) -> DataFrame:
    """(key, score) of meta(key, task): the task's score, else that of the group of its name; without either no row."""
    out = meta.join(tasks.select("task", F.col("score").alias("_t")), "task", "left").join(groups.select("task", F.col("score").alias("_g")), "task", "left")
    return out.select("key", F.coalesce("_t", "_g").alias("score")).where("score is not null")


def learning_rate(step: Column, max_steps: int, peak: float, warmup: int) -> Column:
    """Linear warm-up, then a half cosine down to nothing at max_steps."""
    through = F.least(F.lit(1.0), (step - warmup) / F.lit(max(1, max_steps - warmup)))
    return F.when(step < warmup, peak * step / F.lit(max(1, warmup))).otherwise(peak * 0.5 * (1 + F.cos(F.pi() * through)))


def micro_batch(budget_gb: Column, state_gb: Column, per_sequence_gb: Column, target: Column, power_of_two: bool = True) -> Column:
    """The largest batch that memory has room for, up to the target, one at least; a power of two if asked for."""
    most = F.greatest(F.lit(1), F.least(F.greatest(F.lit(0), F.floor((budget_gb - state_gb) / per_sequence_gb)), target))
    return F.pow(F.lit(2), F.length(F.bin(most)) - 1).cast("bigint") if power_of_two else most
