"""Token streams: framing, packing windows over the whole stream, checks and frequencies."""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators.blend import running

#: Special ids.
BOS, EOS = 2, 3


def encode(docs: DataFrame, encoder: Callable[[], Callable[[list[str]], list[list[int]]]], max_id: int = 65_535) -> DataFrame:
    """(doc_id, ids): BOS, the encoder's ids, EOS. The encoder is made once a task; ids must fit 16 bits."""

    def run(batches):
        own = encoder()
        for b in batches:
            ids = [[BOS, *x, EOS] for x in own([t or "" for t in b.column(1).to_pylist()])]
            if any(i > max_id for x in ids for i in x):
                raise ValueError(f"a token id exceeds {max_id}")
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(ids, pa.list_(pa.int32()))], names=["doc_id", "ids"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, ids array<int>")


def byte_ids(text: Column) -> Column:
    """Ids of a byte vocabulary, native: each UTF-8 byte plus 16, framed."""

    def ids(hexed: Column) -> Column:
        n = F.length(hexed) / 2
        return F.when(n > 0, F.transform(F.sequence(F.lit(1), n.cast("int")), lambda i: F.conv(F.substr(hexed, 2 * i - 1, F.lit(2)), 16, 10).cast("int") + 16)).otherwise(F.array().cast("array<int>"))

    own = T.let(F.hex(F.encode(text, "UTF-8")), ids)
    return F.concat(F.array(F.lit(BOS)), own, F.array(F.lit(EOS)))


def word_ids(text: Column, vocabulary: int = 32_000) -> Column:
    """Ids of a hashed word vocabulary, native and the same in other engines, framed."""
    own = F.transform(T.words(text), lambda w: (16 + F.pmod(T.portable_hash(w), F.lit(vocabulary - 16))).cast("int"))
    return F.concat(F.array(F.lit(BOS)), own, F.array(F.lit(EOS)))


def offsets(tokens: DataFrame) -> DataFrame:
    """tokens(doc_id, ids) with `start`: tokens of all documents before it by doc_id."""
    return running(tokens.withColumn("_n", F.size("ids").cast("bigint")).withColumn("_all", F.lit(0)), ["_all"], "doc_id", "_n", "start").drop("_all", "_n")


def windows(tokens: DataFrame, seq: int, stride: int | None = None) -> DataFrame:
    """(example, ids): fixed windows over the stream; complete ones only.

    Each document is cut at window edges into slices, so that one row a slice and not one a token is
    shuffled; a window is put together from its slices.
    """
    stride = stride or seq
    placed = offsets(tokens).withColumn("n", F.size("ids").cast("bigint"))
    first = F.greatest(F.lit(0), F.ceil((F.col("start") - seq + 1) / stride)).cast("bigint")
    last = F.floor((F.col("start") + F.col("n") - 1) / stride).cast("bigint")
    cuts = placed.where("n > 0").select("start", "n", "ids", F.explode(F.when(last >= first, F.sequence(first, last)).otherwise(F.array().cast("array<bigint>"))).alias("example"))
    lo = F.greatest(F.col("start"), F.col("example") * stride)
    hi = F.least(F.col("start") + F.col("n"), F.col("example") * stride + seq)
    part = cuts.where(hi > lo).select("example", (lo - F.col("example") * stride).alias("at"), F.slice("ids", (lo - F.col("start") + 1).cast("int"), (hi - lo).cast("int")).alias("ids"))
    whole = part.groupBy("example").agg(F.array_sort(F.collect_list(F.struct("at", "ids"))).alias("parts"))
    return whole.select("example", F.flatten(F.transform("parts", lambda p: p["ids"])).alias("ids")).where(F.size("ids") == seq)


def n_examples(n_tokens: Column, seq: int, stride: int) -> Column:
    return F.when(n_tokens >= seq, F.floor((n_tokens - seq) / stride) + 1).otherwise(F.lit(0))


def token_budget(tokens: DataFrame, seq: int, stride: int | None = None) -> DataFrame:
    """One row: tokens, training examples and their tokens, the share of the stream that they use, and the tail kept for evaluation."""
    one = tokens.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0)).cast("bigint").alias("n_tokens"))
    n = n_examples(F.col("n_tokens"), seq, stride or seq)
    one = one.withColumn("examples", n.cast("bigint")).withColumn("training_tokens", F.col("examples") * seq)
    return one.withColumn("utilization", F.round(F.col("training_tokens") / F.greatest("n_tokens", F.lit(1)), 6)).withColumn("eval_tokens", eval_tail(F.col("n_tokens"), seq))


def eval_tail(n_tokens: Column, seq: int) -> Column:
    """Tokens of the evaluation tail: 1 % of the whole windows, four windows at least, in whole windows."""
    whole = F.floor(n_tokens / seq) * seq
    return (F.floor(F.greatest(F.lit(4 * seq), F.floor(whole / 100)) / seq) * seq).cast("bigint")


#: The special tokens in the order of their ids.
SPECIALS = (
    "<PAD>", "<UNK>", "<BOS>", "<EOS>", "<|system|>", "<|user|>", "<|assistant|>", "<|endofturn|>", "<|code|>", "<|endofcode|>",
    "<|tool|>", "<|endoftool|>", "<|reasoning|>", "<|endofreasoning|>", "<|context|>", "<|endofcontext|>",
)


def misplaced_specials(vocabulary: DataFrame) -> DataFrame:
    """(token, expected, id) of the special tokens that vocabulary(token, id) has under another id, or not at all."""
    wanted = vocabulary.sparkSession.createDataFrame([(t, i) for i, t in enumerate(SPECIALS)], "token string, expected long")
    return wanted.join(vocabulary.select("token", F.col("id").cast("long").alias("id")), "token", "left").where(~F.col("id").eqNullSafe(F.col("expected")))


def stream_stats(tokens: DataFrame) -> DataFrame:
    """One row: documents, tokens, least and largest id, BOS and EOS counts, whether each is framed."""
    framed = (F.element_at("ids", 1) == BOS) & (F.element_at("ids", -1) == EOS)
    return tokens.agg(
        F.count("*").alias("n_docs"),
        F.sum(F.size("ids")).cast("bigint").alias("n_tokens"),
        F.min(F.array_min("ids")).alias("min_id"),
        F.max(F.array_max("ids")).alias("max_id"),
        F.sum(F.size(F.filter("ids", lambda i: i == BOS))).cast("bigint").alias("n_bos"),
        F.sum(F.size(F.filter("ids", lambda i: i == EOS))).cast("bigint").alias("n_eos"),
        F.bool_and(framed).alias("framed"),
    )


def top_tokens(tokens: DataFrame, k: int = 50) -> DataFrame:
    return tokens.select(F.explode("ids").alias("id")).groupBy("id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "id").limit(k)


def eos_gap(tokens: DataFrame) -> DataFrame:
    """One row: end tokens and the mean tokens between neighbouring ones over the stream."""
    one = tokens.agg(F.count("*").alias("n_eos"), F.sum(F.size("ids")).alias("n"), F.min_by(F.size("ids"), "doc_id").alias("first"))
    return one.select("n_eos", ((F.col("n") - F.col("first")) / F.nullif(F.col("n_eos") - 1, F.lit(0))).alias("mean_gap"))


def word_counts(docs: DataFrame, pattern: str = r"\p{L}+|\p{N}+|[^\p{L}\p{N}\s]+") -> DataFrame:
    """(token, n): what a vocabulary is trained from, counted with map-side sums."""
    return docs.select(F.explode(F.regexp_extract_all(T.text_or_empty("text"), F.lit(f"({pattern})"), F.lit(1))).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


def _joiner(a: str, b: str):
    """A step that appends a symbol, or joins it to the last one if the two are the pair."""

    def step(acc: Column, x: Column) -> Column:
        joined = (F.size(acc) > 0) & (F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit("")) == a) & (x == b)
        return F.when(joined, F.concat(F.slice(acc, F.lit(1), F.greatest(F.size(acc) - 1, F.lit(0))), F.array(F.lit(a + b)))).otherwise(F.concat(acc, F.array(x)))

    return step


def merges(counts: DataFrame, n: int) -> list[tuple[str, str]]:
    """The first n byte-pair merges over weighted words, each step one aggregate of pairs; symbols are arrays."""
    words = counts.select(F.col("n"), F.filter(F.split("token", ""), lambda c: c != "").alias("s"))
    out: list[tuple[str, str]] = []
    for _ in range(n):
        pairs = words.select("n", F.explode(F.when(F.size("s") > 1, F.transform(F.sequence(F.lit(1), F.size("s") - 1), lambda i: F.struct(F.element_at("s", i).alias("a"), F.element_at("s", i + 1).alias("b")))).otherwise(F.expr("array()").cast("array<struct<a:string,b:string>>"))).alias("p"))
        best = pairs.groupBy("p.a", "p.b").agg(F.sum("n").alias("k")).orderBy(F.desc("k"), "a", "b").first()
        if best is None or best["k"] < 2:
            break
        a, b = best["a"], best["b"]
        out.append((a, b))
        empty = F.array().cast("array<string>")

        words = words.select("n", F.aggregate("s", empty, _joiner(a, b)).alias("s"))
    return out


def fertility(docs: DataFrame, n_tokens: Column) -> DataFrame:
    """One row: tokens over words of all documents."""
    n_words = F.size(T.words(T.text_or_empty("text")))
    return docs.agg((F.sum(n_tokens) / F.nullif(F.sum(n_words), F.lit(0))).alias("fertility"))


def fertility_by(docs: DataFrame, n_tokens: Column, least_words: int = 10) -> DataFrame:
    """The mean over documents of tokens a word, by source; of texts with more than `least_words`."""
    n = F.size(T.words(F.col("text")))
    return docs.where(n > least_words).groupBy("source").agg(F.round(F.avg(n_tokens / n), 6).alias("fertility"))
