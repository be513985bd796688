"""Quality rules: ordered decision lists learned by sequential covering, in DataFrame operations only.

Statistics of every whole text are Spark expressions. A bounded sample of labelled rows (at most
SAMPLE of them, the smallest by hash of doc_id) comes to the driver as numbers; there rules are grown
condition by condition (FOIL gain) on one part and pruned on the other (RIPPER's measure), each
taking the bad rows it covers out of the sample. The list becomes one ordered conditional expression.

Null and empty texts have statistics of 0 and fail the base. A label that is repeated counts as often
as it is, also with a repeated document; labels that differ for one id each count. Rows without a
label, and labels without a document, teach nothing; without labels there are no rules. Ties between
conditions go to the first statistic, then to the smallest threshold, then to `above`. Repeated rows
each have a row, and very long texts are read whole. An empty table gives an empty one.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import need

#: Labelled rows that are read at most; what is learned does not depend on more.
SAMPLE = 4000
#: Thresholds tried for a statistic, conditions of a rule, rules of a list.
CUTS, CONDITIONS, RULES = 24, 3, 8
#: A rule must be this pure on the rows it is judged by, and cover so many of them.
PURITY, SUPPORT = 0.9, 3
#: Words of a window that counts as repeated.
WINDOW = 5


def with_statistics(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """docs(text, ...) with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words.

    Null text counts as empty: all zero. A text's repeated windows are found by their hashes; only
    texts that have one are looked at further.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    lines = F.filter(F.split(text, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    runs = F.expr(
        f"CASE WHEN size(_words) >= {window} THEN transform(sequence(0, size(_words) - {window}), i -> xxhash64("
        + ", ".join(f"get(_words, i + {k})" if k else "get(_words, i)" for k in range(window))
        + ")) ELSE array() END"
    )
    out = docs.withColumn("_words", words).withColumn("_runs", runs).withColumn("_lines", lines)
    # Windows sorted by hash; those equal to a neighbour, as their positions.
    repeated = F.expr(
        "CASE WHEN size(array_distinct(_runs)) = size(_runs) THEN cast(array() AS array<int>) ELSE "
        "transform(array(array_sort(transform(_runs, (h, i) -> struct(h, i)))), s -> "
        "transform(filter(s, (x, j) -> (j > 0 AND get(s, j - 1).h = x.h) OR (get(s, j + 1).h <=> x.h)), x -> x.i))[0] END"
    )
    out = out.withColumn("_at", F.array_sort(repeated))
    covered = F.expr(f"aggregate(_at, struct(0 AS n, -{window} AS last), (a, p) -> struct(a.n + least({window}, p - a.last) AS n, p AS last)).n")
    # A row generator of one row: a filter on the statistics cannot be pushed below it, which would compute them again.
    return out.select(
        *(F.col(f"`{c}`") for c in docs.columns),
        F.inline(F.array(F.struct(
        F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        covered.cast("long").alias("n_repeat_words"),
        F.length(F.regexp_replace(text, r"[^\p{Lu}]+", "")).cast("long").alias("n_upper"),
        ))),
    )


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (F.col("n_repeat_words") * 100 > F.col("n_words") * 20)


def ratios() -> dict[str, Column]:
    """What the rules may test: statistics a word or character, defined for empty texts too."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return {
        "symbols_a_word": F.col("n_symbols") / words,
        "chars_a_word": F.col("word_chars") / words,
        "dup_lines_a_word": F.col("n_dup_lines") / words,
        "repeat_share": F.col("n_repeat_words") / words,
        "upper_share": F.col("n_upper") / chars,
        "words": F.col("n_words").cast("double"),
    }


@dataclass(frozen=True)
class Condition:
    feature: str
    above: bool
    threshold: float

    def holds(self, row: dict) -> bool:
        return row[self.feature] > self.threshold if self.above else row[self.feature] <= self.threshold

    def column(self) -> Column:
        value = ratios()[self.feature]
        return value > F.lit(self.threshold) if self.above else value <= F.lit(self.threshold)


def covers(rule: list[Condition], row: dict) -> bool:
    return all(c.holds(row) for c in rule)


def _thresholds(rows: list[dict], feature: str) -> list[float]:
    values = sorted({r[feature] for r in rows})
    if len(values) < 2:
        return []
    middles = [(a + b) / 2 for a, b in zip(values, values[1:])]
    step = max(1, len(middles) // CUTS)
    return [float(f"{x:.6g}") for x in middles[step // 2 :: step]]


def _grow(rows: list[dict], features: list[str]) -> list[Condition]:
    """Adds the condition of the largest FOIL gain until no good row is covered."""
    rule: list[Condition] = []
    while rows and len(rule) < CONDITIONS and any(not r["bad"] for r in rows):
        p0, n0 = sum(r["bad"] for r in rows), len(rows)
        best, gain = None, 1e-9
        for f in features:
            for cut in _thresholds(rows, f):
                for above in (True, False):
                    c = Condition(f, above, cut)
                    inside = [r["bad"] for r in rows if c.holds(r)]
                    p = sum(inside)
                    if p and (g := p * (math.log2(p / len(inside)) - math.log2(p0 / n0))) > gain:
                        best, gain = c, g
        if best is None:
            break
        rule.append(best)
        rows = [r for r in rows if best.holds(r)]
    return rule


def _prune(rule: list[Condition], rows: list[dict]) -> list[Condition]:
    """The shortest beginning of the rule that is worth most on rows it was not grown on."""

    def worth(r: list[Condition]) -> float:
        inside = [x["bad"] for x in rows if covers(r, x)]
        return (2 * sum(inside) - len(inside)) / len(inside) if inside else -1.0

    return max((rule[: k + 1] for k in range(len(rule))), key=lambda r: (worth(r), -len(r)), default=[])


def learn(rows: list[dict], features: list[str]) -> list[list[Condition]]:
    """An ordered list of rules for the bad rows. rows: the features and bad (0 or 1). Deterministic."""
    left, rules = list(rows), []
    while len(rules) < RULES and any(r["bad"] for r in left):
        grow, prune = [r for i, r in enumerate(left) if i % 3], [r for i, r in enumerate(left) if not i % 3]
        rule = _prune(_grow(grow, features), prune)
        if not rule:
            break
        inside = [r["bad"] for r in left if covers(rule, r)]
        if len(inside) < SUPPORT or sum(inside) < PURITY * len(inside):
            break
        rules.append(rule)
        left = [r for r in left if not covers(rule, r)]
    return rules


def verdict(rules: list[list[Condition]]) -> Column:
    """The number of the first rule that covers a row, from 1; null if none does."""
    out = F.lit(None).cast("int")
    for k in range(len(rules), 0, -1):
        test = rules[k - 1][0].column()
        for c in rules[k - 1][1:]:
            test = test & c.column()
        out = F.when(test, F.lit(k)).otherwise(out)
    return out


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> list[list[Condition]]:
    """Rules from labels(doc_id, quality): quality 0 is bad. Rows without a label value are left out."""
    chosen = need(labels, "doc_id", "quality").where("doc_id is not null and quality is not null").select(F.col("doc_id").alias("_id"), F.col("quality").cast("int").alias("_quality"))
    chosen = chosen.orderBy(F.xxhash64("_id"), "_id", "_quality").limit(sample)
    rows = need(docs, "doc_id", "text").join(F.broadcast(chosen), F.col("doc_id") == F.col("_id"))  # at most `sample` ids
    named = ratios()
    rows = with_statistics(rows.select("_id", "_quality", "text")).where(~base_failed())
    rows = rows.select("_id", "_quality", *(c.alias(n) for n, c in named.items())).orderBy("_id", "_quality", *named).limit(2 * sample)
    return learn([r.asDict() | {"bad": int(r["_quality"] == 0)} for r in rows.collect()], list(named))


def judge(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """docs with the statistics, base_failed, rule (first rule against a row) and kept."""
    rules = fit(docs, labels, sample)
    out = with_statistics(need(docs, "doc_id", "text")).withColumn("base_failed", base_failed()).withColumn("rule", verdict(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull()).drop("text")
