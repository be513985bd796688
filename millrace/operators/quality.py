"""The curation quality filter: ordered rules, one recorded reason a document.

Each rule is a factory from text to a column; the verdict is one CASE WHEN over them, so that a
corpus is judged in a single narrow stage. Divisions are guarded, as the optimiser may evaluate a
branch early.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Sources of code, stop words and boilerplate phrases.
CODE_SOURCES = ("synthetic_arithmetic", "codesearchnet", "stack_smol", "stack_v1", "jupyter", "conala")
STOP_WORDS = (
    "the be to of and a in that have it for not on with he as you do at this but his by from they we say her she or an will my one all"
).split()
BOILERPLATE = (
    "cookie policy", "privacy policy", "terms of service", "terms and conditions", "all rights reserved",
    "subscribe to our newsletter", "javascript is (?:disabled|required)", "please enable javascript",
    "click here to (?:accept|enable|continue)", "we use cookies", "your (?:privacy|cookie) (?:settings|preferences|choices)",
)
BULLETS = "•\\-*·–—▪◦"
SYMBOLS = r"[#$%&*+/<=>@\\^_`|~]"


@dataclass(frozen=True)
class QualityConfig:
    min_length: int = 500
    max_length: int = 50_000
    min_mean_word: float = 3.0
    max_mean_word: float = 10.0
    max_symbol_ratio: float = 0.08
    max_bullet_ratio: float = 0.9
    max_ellipsis_ratio: float = 0.3
    min_alpha_ratio: float = 0.75
    max_repeated_lines: float = 0.2
    min_stop_words: int = 3
    stop_word_tokens: int = 100
    max_boilerplate: int = 2
    skip_min_length: tuple[str, ...] = ("conala", "jupyter")
    skip_max_length: tuple[str, ...] = ("pg19", "jupyter")
    skip_prose: tuple[str, ...] = CODE_SOURCES
    extra: dict = field(default_factory=dict, hash=False)


def ratio(a: Column, b: Column) -> Column:
    return a / F.nullif(b, F.lit(0))


def _in(names: tuple[str, ...]) -> Column:
    return F.coalesce(F.col("source").isin(*names), F.lit(False)) if names else F.lit(False)


def _may_be_boilerplate() -> Column:
    """A word that each phrase has, or a letter that folds to one of ASCII by upper case alone."""
    low = F.lower("_text")
    out = F.contains("_text", F.lit("ſ"))
    for word in ("cookie", "privacy", "terms", "reserved", "newsletter", "javascript", "click here"):
        out = out | F.contains(low, F.lit(word))
    return out


def features(docs: DataFrame, keep_text: bool = False, c: QualityConfig | None = None) -> DataFrame:
    """The numbers that the rules test, as columns. A null text counts as empty."""
    c = c or QualityConfig()
    text = T.text_or_empty("text")
    df = docs.withColumn("_text", text).withColumn("_lines", T.lines(text)).withColumn("_words", T.words(text))
    n_lines, n_words = F.size("_lines"), F.size("_words")
    stop = F.array(*map(F.lit, STOP_WORDS))
    return df.select(
        *(x for x in docs.columns if keep_text or x != "text"),
        F.length("_text").alias("len"),
        n_lines.alias("n_lines"),
        n_words.alias("n_words"),
        F.size(F.filter("_lines", lambda x: x.rlike(f"^[{BULLETS}]"))).alias("n_bullets"),
        F.size(F.filter("_lines", lambda x: x.endswith("..."))).alias("n_ellipses"),
        (n_lines - F.size(F.array_distinct("_lines"))).alias("n_repeated"),
        F.length(F.array_join("_words", "")).alias("word_chars"),
        F.regexp_count("_text", F.lit(SYMBOLS)).alias("n_symbols"),
        (F.length("_text") - F.length(F.regexp_replace("_text", r"\p{L}+", ""))).alias("n_alpha"),
        F.when(_may_be_boilerplate(), F.regexp_count("_text", F.lit(f"(?iu){'|'.join(BOILERPLATE)}"))).otherwise(0).alias("n_boilerplate"),
        F.size(F.array_intersect(F.transform(F.slice("_words", 1, c.stop_word_tokens), F.lower), stop)).alias("n_stop"),
    )


def rules(c: QualityConfig | None = None) -> list[tuple[str, Column]]:
    """(reason, test) in order, over the columns of features() and source."""
    c = c or QualityConfig()
    prose = ~_in(c.skip_prose)
    mean = ratio(F.col("word_chars"), F.col("n_words"))
    return [
        ("too_short", ~_in(c.skip_min_length) & (F.col("len") < c.min_length)),
        ("too_long", ~_in(c.skip_max_length) & (F.col("len") > c.max_length)),
        ("no_lines", F.col("n_lines") == 0),
        ("high_bullet_ratio", ratio(F.col("n_bullets"), F.col("n_lines")) > c.max_bullet_ratio),
        ("high_ellipsis_ratio", ratio(F.col("n_ellipses"), F.col("n_lines")) > c.max_ellipsis_ratio),
        ("high_repeated_lines", (F.col("n_lines") >= 4) & (ratio(F.col("n_repeated"), F.col("n_lines")) > c.max_repeated_lines)),
        ("no_words", prose & (F.col("n_words") == 0)),
        ("mean_word_too_short", prose & (mean < c.min_mean_word)),
        ("mean_word_too_long", prose & (mean > c.max_mean_word)),
        ("high_symbol_ratio", prose & (ratio(F.col("n_symbols"), F.col("n_words")) > c.max_symbol_ratio)),
        ("empty", prose & (F.col("len") == 0)),
        ("low_alpha_ratio", prose & (ratio(F.col("n_alpha"), F.col("len")) < c.min_alpha_ratio)),
        ("boilerplate", prose & (F.col("n_boilerplate") >= c.max_boilerplate)),
        ("insufficient_stop_words", prose & (F.col("n_stop") < c.min_stop_words)),
    ]


def verdict(docs: DataFrame, c: QualityConfig | None = None, keep_text: bool = False, with_features: bool = False) -> DataFrame:
    """docs with `reason`: the first failing rule, or null."""
    out = features(docs, keep_text, c)
    case = F.lit(None).cast("string")
    for name, test in reversed(rules(c)):
        case = F.when(test, F.lit(name)).otherwise(case)
    out = out.withColumn("reason", case)
    given = [x for x in docs.columns if keep_text or x != "text"]
    return out if with_features else out.select(*given, "reason")


def quality_filter(docs: DataFrame, c: QualityConfig | None = None) -> DataFrame:
    return verdict(docs, c, keep_text=True).where("reason is null").drop("reason")


def rejection_report(docs: DataFrame, c: QualityConfig | None = None) -> DataFrame:
    """Rows by source and reason; kept documents under 'kept'."""
    return verdict(docs, c).groupBy("source", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


def with_code_sources(docs: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """docs with source tags renamed, for skip rules that go by tag."""
    m = F.col("source")
    for a, b in mapping.items():
        m = F.when(F.col("source") == a, F.lit(b)).otherwise(m)
    return docs.withColumn("source", m)
