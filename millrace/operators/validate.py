"""Second-pass validation: punctuation, repetition, perplexity against a fitted threshold, and published filters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T

#: Sources that the punctuation and repetition rules pass over (no arithmetic among them).
CODE_SOURCES = ("codesearchnet", "stack_smol", "stack_v1", "jupyter", "conala")
TERMINAL = (".", "!", "?", '"', "'")
#: Limits of the published repetition filter.
TOP_NGRAMS = ((2, 0.2), (3, 0.18), (4, 0.16))
DUP_LINES = DUP_PARAGRAPHS = 0.3
DUP_LINE_CHARS = DUP_PARAGRAPH_CHARS = 0.2


def ends_well(line: Column) -> Column:
    return F.right(line, F.lit(1)).isin(*TERMINAL)


def manual_reason(threshold: float | None = None, max_repeated: float = 0.3, code: tuple[str, ...] = CODE_SOURCES) -> Column:
    """The first failing rule over text, source and (where a threshold is given) perplexity; null passes."""
    lines = T.lines(T.text_or_empty("text"))
    prose = ~F.coalesce(F.col("source").isin(*code), F.lit(False))
    n = F.size(lines)
    out = F.when(prose & ~F.exists(lines, ends_well), "terminal_punct")
    out = out.when(prose & (n >= 4) & ((n - F.size(F.array_distinct(lines))) / F.nullif(n, F.lit(0)) > max_repeated), "repeated_lines")
    if threshold is not None:
        out = out.when(F.col("perplexity") > threshold, "perplexity")
    return out


def validate(docs: DataFrame, threshold: float | None = None) -> DataFrame:
    return docs.withColumn("reason", manual_reason(threshold))


def counters(judged: DataFrame, by: str = "split") -> DataFrame:
    """total, kept and rejected by reason, by split and over all (split null)."""
    return judged.rollup(by).agg(
        F.count("*").alias("total"),
        F.count_if(F.col("reason").isNull()).alias("kept"),
        *(F.count_if(F.col("reason") == r).alias(f"rejected_{r}") for r in ("terminal_punct", "repeated_lines", "perplexity")),
    )


def order_statistic(df: DataFrame, value: str, q: float = 0.9) -> DataFrame:
    """One row: the value at index int(q n) of the sorted values, 0-based. Found by counts of distinct values."""
    from pyspark.sql import Window

    counts = df.where(F.col(value).isNotNull()).groupBy(F.col(value).alias("v")).agg(F.count("*").alias("n"))
    whole, upto = Window.partitionBy(F.lit(0)), Window.partitionBy(F.lit(0)).orderBy("v")
    counts = counts.withColumn("_at", F.floor(F.lit(q) * F.sum("n").over(whole))).withColumn("_cum", F.sum("n").over(upto))
    return counts.where("_cum > _at").agg(F.min("v").alias("threshold"))


def unigram_perplexity(docs: DataFrame, prefix: int = 2000, sample: DataFrame | None = None) -> DataFrame:
    """docs with `perplexity`: a stand-in for a trained language model.

    exp of the mean negative log probability of the prefix's lower-cased words under add-one
    unigram counts of all texts. Word counts are pre-aggregated, and a document's words are grouped
    before they meet the counts. Texts without a word have null.
    """
    base = (sample or docs).select(F.explode(T.words(F.lower(T.text_or_empty("text")))).alias("w")).groupBy("w").agg(F.count("*").alias("c"))
    total = base.agg(F.sum("c").alias("n"), F.count("*").alias("v"))
    own = docs.select("doc_id", F.explode(T.words(F.lower(T.prefix(T.text_or_empty("text"), prefix)))).alias("w")).groupBy("doc_id", "w").agg(F.count("*").alias("k"))
    scored = own.join(base, "w", "left").crossJoin(F.broadcast(total))  # one row
    p = -F.ln((F.coalesce("c", F.lit(0)) + 1) / (F.col("n") + F.col("v")))
    scored = scored.groupBy("doc_id").agg((F.sum(F.col("k") * p) / F.sum("k")).alias("h"))
    return docs.join(scored.select("doc_id", F.exp("h").alias("perplexity")), "doc_id", "left")


def repetition(docs: DataFrame) -> DataFrame:
    """(doc_id, and the measures of the repetition filter): duplicate lines and paragraphs by count and characters, top n-gram characters.

    A text's n-grams are sorted and counted where it is read. Rows of one id are one document to the
    n-grams; only those of ids met more than once are grouped by shuffle. Rows without an id have none.
    """
    text = T.text_or_empty("text")
    lines, paras = T.lines(text), F.filter(F.transform(F.split(text, "\n\n+"), T.strip), lambda x: x != "")
    df = docs.select("doc_id", text.alias("t"), lines.alias("lines"), paras.alias("paras"))

    def chars(a: Column) -> Column:
        return F.length(F.array_join(a, ""))

    def dup(c: str) -> tuple[Column, Column]:
        a = F.col(c)
        return (F.size(a) - F.size(F.array_distinct(a))) / F.nullif(F.size(a), F.lit(0)), (chars(a) - chars(F.array_distinct(a))) / F.nullif(F.length("t"), F.lit(0))

    line, line_chars = dup("lines")
    para, para_chars = dup("paras")
    most = T.let(T.words(F.col("t")), lambda w: F.struct(*(_most_repeated(w, n).alias(f"top_{n}") for n, _ in TOP_NGRAMS)))
    df = df.select("doc_id", F.length("t").alias("len"), line.alias("dup_line"), line_chars.alias("dup_line_char"), para.alias("dup_para"), para_chars.alias("dup_para_char"), most.alias("most"))
    own = (F.when(F.col("doc_id").isNotNull(), F.col(f"most.top_{n}") / F.nullif(F.col("len"), F.lit(0))).alias(f"top_{n}") for n, _ in TOP_NGRAMS)
    df = df.select("doc_id", "dup_line", "dup_line_char", "dup_para", "dup_para_char", *own)
    again = docs.where(F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1").select("doc_id")
    n_again = again.count()
    if n_again:
        if n_again <= FEW_IDS:
            again = F.broadcast(again)
        together = _top_of_ids(docs.join(again, "doc_id", "left_semi"))
        names = [f"top_{n}" for n, _ in TOP_NGRAMS]
        together = together.select("doc_id", F.struct(*names).alias("all"))
        df = df.join(F.broadcast(together) if n_again <= FEW_IDS else together, "doc_id", "left")
        df = df.select(*(c for c in df.columns if c not in (*names, "all")), *(F.coalesce(F.col(f"all.{c}"), F.col(c)).alias(c) for c in names))
    return df.na.fill(0.0, [c for c in df.columns if c != "doc_id"])


#: Ids met more than once that are broadcast at most.
FEW_IDS = 100_000


def _most_repeated(w: Column, n: int) -> Column:
    """The most characters that one n-gram of the words w takes, of those met twice or more; 0 if there is none."""
    start = F.struct(F.lit(None).cast("string").alias("last"), F.lit(0).alias("run"), F.lit(0).alias("best"))

    def step(s: Column, g: Column) -> Column:
        run = F.when(s["last"] == g, s["run"] + 1).otherwise(F.lit(1))
        best = F.when(s["last"] == g, F.greatest(s["best"], F.length(g) * (s["run"] + 1))).otherwise(s["best"])
        return F.struct(g.alias("last"), run.alias("run"), best.alias("best"))

    return F.aggregate(F.sort_array(T.ngrams(w, n)), start, step, lambda s: s["best"])


def _top_of_ids(docs: DataFrame) -> DataFrame:
    """(doc_id, top_2, top_3, top_4) of all rows of an id together, by the longest of its texts."""
    text = T.text_or_empty("text")
    df = docs.select("doc_id", F.length(text).alias("len"), T.words(text).alias("w"))
    grams = df.select("doc_id", "len", F.explode(F.array(*(F.struct(F.lit(n).alias("n"), T.ngrams(F.col("w"), n).alias("g")) for n, _ in TOP_NGRAMS))).alias("x"))
    grams = grams.select("doc_id", "len", "x.n", F.explode("x.g").alias("g")).groupBy("doc_id", "n", "g").agg(F.count("*").alias("k"), F.max("len").alias("len"))
    # Every id has a row, so that what its rows have by themselves does not count.
    return grams.groupBy("doc_id").agg(*(F.coalesce(F.max(F.when((F.col("k") > 1) & (F.col("n") == n), F.length("g") * F.col("k") / F.nullif(F.col("len"), F.lit(0)))), F.lit(0.0)).alias(f"top_{n}") for n, _ in TOP_NGRAMS))


def repetition_reason() -> Column:
    """The first limit that the measures of repetition() exceed."""
    out = F.when(F.col("dup_para") > DUP_PARAGRAPHS, "dup_para_frac").when(F.col("dup_para_char") > DUP_PARAGRAPH_CHARS, "dup_para_char_frac")
    out = out.when(F.col("dup_line") > DUP_LINES, "dup_line_frac").when(F.col("dup_line_char") > DUP_LINE_CHARS, "dup_line_char_frac")
    for n, most in TOP_NGRAMS:
        out = out.when(F.col(f"top_{n}") > most, f"top_{n}_gram")
    return out


def c4(docs: DataFrame, min_sentences: int = 3) -> DataFrame:
    """(doc_id, kept_lines, sentences, kept): lines that end in punctuation stay; a text needs enough sentences in them."""
    lines = F.filter(T.lines(T.text_or_empty("text")), lambda x: F.right(x, F.lit(1)).isin(".", "!", "?", '"'))
    body = F.array_join(lines, "\n")
    sentences = F.regexp_count(body, F.lit(r"[.!?]+"))
    return docs.select("doc_id", F.size(lines).alias("kept_lines"), sentences.alias("sentences"), (sentences >= min_sentences).alias("kept"))


def language_ok(label: Column, score: Column, least: float = 0.65) -> Column:
    """Whether a predicted label passes as English; a missing prediction passes."""
    return F.coalesce((label == "en") & (score >= least), F.lit(True))


def stats_json(counted: DataFrame, threshold: float | None = None) -> DataFrame:
    """counters() as one JSON text: the totals, the threshold, and the same by split."""
    names = [c for c in counted.columns if c != "split"]
    own = F.struct(*(F.col(c) for c in names))
    by = F.map_from_entries(F.array_sort(F.collect_list(F.when(F.col("split").isNotNull(), F.struct("split", own.alias("v"))))))
    total = F.max(F.when(F.col("split").isNull(), own))
    one = counted.agg(total.alias("t"), by.alias("splits"))
    return one.select(F.to_json(F.struct(*(F.col(f"t.{c}").alias(c) for c in names), F.lit(threshold).cast("double").alias("perplexity_threshold"), "splits")).alias("stats"))
