"""Conversations and preference pairs: normalising, classifying, generating, splitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from millrace.functions import code as C
from millrace.functions import text as T

#: Fixed value: our default system messages.
SYSTEM = "You are a helpful assistant."
CODE_SYSTEM = "You are a careful programming assistant."
MESSAGE = "array<struct<role:string,content:string>>"


def message(role: str, content: Column) -> Column:
    return F.struct(F.lit(role).alias("role"), content.alias("content"))


def conversations(turns: DataFrame, system: str = SYSTEM) -> DataFrame:
    """(conv_id, conversations, valid) of turns(conv_id, turn, role, text).

    The system turn or the default comes first; human and user, gpt and assistant are one; other
    roles are left out. Valid: no empty turn, two messages at least, an assistant's last.
    """
    role, text = F.lower(F.coalesce("role", F.lit(""))), T.strip(T.text_or_empty("text"))
    rows = turns.select("conv_id", "turn", F.when(role.isin("human", "user"), "user").when(role.isin("gpt", "assistant"), "assistant").when(role == "system", "system").alias("r"), text.alias("c"))
    grouped = rows.groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("turn", "r", "c"))).alias("t"),
        F.bool_or((F.col("c") == "") & ~F.col("r").eqNullSafe("system")).alias("hole"),
    )
    first = F.filter("t", lambda x: (x["r"] == "system") & (x["c"] != ""))
    head = F.coalesce(F.try_element_at(first, F.lit(1))["c"], F.lit(system))
    body = F.transform(F.filter("t", lambda x: x["r"].isin("user", "assistant")), lambda x: F.struct(x["r"].alias("role"), x["c"].alias("content")))
    out = grouped.select("conv_id", "hole", F.concat(F.array(message("system", head)), body).alias("conversations"))
    valid = ~F.col("hole") & (F.size("conversations") >= 2) & (F.element_at("conversations", -1)["role"] == "assistant")
    return out.select("conv_id", "conversations", valid.alias("valid"))


def render(conv: Column) -> Column:
    """The chat template as one text."""
    return F.array_join(F.transform(conv, lambda m: F.concat(F.lit("<|"), m["role"], F.lit("|>\n"), m["content"], F.lit("\n<|end|>\n"))), "")


def code_pairs(df: DataFrame) -> DataFrame:
    """df(instruction, solution, ...) with sft_type, reason (null: kept), answer and normalized."""
    q, a = T.strip(T.text_or_empty("instruction")), T.strip(T.text_or_empty("solution"))
    kind = C.sft_type(F.col("_q"), F.col("_a"))
    df = df.withColumn("_q", q).withColumn("_a", a).withColumn("sft_type", kind).withColumn("_code", C.looks_like_code(F.col("_a"))).withColumn("_fence", C.largest_fence(F.col("_a")))
    explains = F.col("sft_type") == "code_explanation"
    use = F.col("sft_type").isin(*C.CODE_OUTPUT_TYPES) & F.col("_fence").isNotNull()
    answer = F.when(use, F.col("_fence")).otherwise(F.col("_a"))
    reason = (
        F.when(F.col("_q") == "", "missing_instruction")
        .when(F.col("_a") == "", "missing_solution")
        .when(explains & C.mostly_code(F.col("_a")), "code_explanation_is_code")
        .when(~explains & C.prose_without_code(F.col("_a")), "prose_only")
        .when(~explains & ~F.col("_code"), "no_code_detected")
        .when(answer == "", "empty_after_normalization")
    )
    return df.withColumn("reason", reason).withColumn("answer", answer).withColumn("normalized", use).drop("_q", "_a", "_code", "_fence")


def code_conversations(df: DataFrame) -> DataFrame:
    kept = code_pairs(df).where("reason is null")
    conv = F.array(message("system", F.lit(CODE_SYSTEM)), message("user", T.strip(F.col("instruction"))), message("assistant", F.col("answer")))
    return kept.select(conv.alias("conversations"), F.lit("code").alias("source"), "sft_type", "normalized")


def cross(prompts: DataFrame, templates: DataFrame) -> DataFrame:
    """Every prompt in every template ({q} stands for it); both are small literal tables."""
    return prompts.crossJoin(F.broadcast(templates)).withColumn("prompt", F.expr("replace(template, '{q}', q)")).drop("template", "q")


def replicate(df: DataFrame, n: int = 20) -> DataFrame:
    return df.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(n))))


#: Problems by operation: operands, and templates in turn.
ARITHMETIC_TEMPLATES = ("What is {expr}?", "Answer only the result: {expr}", "Compute {expr}.", "What does {expr} equal?", "Give the answer to {expr}.", "Return only the number: {expr}")


def arithmetic_problems(spark: SparkSession) -> DataFrame:
    """(op, i, expr, answer, prompt): sums, differences, products and exact quotients of small numbers."""
    n = lambda a, b, x: spark.range(a, b).select(F.col("id").alias(x))
    parts = [
        (n(1, 31, "a").crossJoin(n(1, 31, "b")), "+", F.col("a"), F.col("a") + F.col("b")),
        (n(2, 41, "a").crossJoin(n(1, 21, "b")).where("b <= a"), "-", F.col("a"), F.col("a") - F.col("b")),
        (n(2, 16, "a").crossJoin(n(2, 16, "b")), "*", F.col("a"), F.col("a") * F.col("b")),
        (n(2, 16, "b").crossJoin(n(1, 21, "a")).select("b", "a"), "/", F.col("a") * F.col("b"), F.col("a")),
    ]
    out = None
    for df, op, left, answer in parts:
        order = ("b", "a") if op == "/" else ("a", "b")
        own = df.select(F.lit(op).alias("op"), (F.row_number().over(Window.orderBy(*order)) - 1).alias("i"), F.concat(left.cast("string"), F.lit(f" {op} "), F.col("b").cast("string")).alias("expr"), answer.cast("long").alias("answer"))
        out = own if out is None else out.unionByName(own)
    template = F.element_at(F.array(*map(F.lit, ARITHMETIC_TEMPLATES)), (F.col("i") % len(ARITHMETIC_TEMPLATES) + 1).cast("int"))
    return out.withColumn("prompt", F.replace(template, F.lit("{expr}"), F.col("expr")))


def interleave(df: DataFrame, group: Column, i: str = "i") -> DataFrame:
    """df with `pos`: rank by place within the group, then group."""
    return df.withColumn("pos", F.row_number().over(Window.orderBy(i, group)) - 1)


#: Prefixes of prompt variants, in turn.
VARIANTS = {
    "direct": "Answer directly. ", "brief": "Give a brief correct answer. ", "stop": "Answer correctly and stop. ",
    "no_extra": "Do not add extra explanation. ", "factual": "Be factual. ",
}


def variant(prompt: Column, name: Column) -> Column:
    out = F.lit("")
    for k, v in VARIANTS.items():
        out = F.when(name == k, F.lit(v)).otherwise(out)
    return F.concat(out, prompt)


def response_mix(base: DataFrame, order: tuple[str, ...], targets: dict[str, int], total: int) -> DataFrame:
    """base(kind, i, prompt, answer) to `total` rows (pos, kind, prompt, answer, variant).

    First each kind up to its target; then what is left of them, one of each kind in turn; then
    variants, kind by kind, walking through each kind's rows from where the count has come to.
    """
    rank, target = F.lit(None).cast("int"), F.lit(0)
    for k, name in enumerate(order):
        rank, target = F.when(F.col("kind") == name, F.lit(k)).otherwise(rank), F.when(F.col("kind") == name, F.lit(targets.get(name, 0))).otherwise(target)
    rows = base.withColumn("k", rank).where("k is not null").withColumn("late", F.col("i") >= target)
    rows = rows.withColumn("pos", F.row_number().over(Window.orderBy("late", F.when(F.col("late"), F.lit(0)).otherwise(F.col("k")), "i", "k")) - 1)
    sizes = {r["kind"]: (r["n"], r["k"]) for r in rows.groupBy("kind", "k").agg(F.count("*").alias("n")).collect()}  # a row a kind
    have = sum(n for n, _ in sizes.values())
    live = [(name, *sizes[name]) for name in order if name in sizes]
    first = rows.where(F.col("pos") < total).select("pos", "kind", "prompt", "answer", F.lit(None).cast("string").alias("variant"))
    if have >= total or not live:
        return first
    v = base.sparkSession.range(total - have).select(F.col("id").alias("v"))
    turn = F.col("v") % len(live)
    name, size = F.lit(None).cast("string"), F.lit(1)
    for j, (n, count, _) in enumerate(live):
        name, size = F.when(turn == j, F.lit(n)).otherwise(name), F.when(turn == j, F.lit(count)).otherwise(size)
    names = F.array(*map(F.lit, VARIANTS))
    more = v.select((F.col("v") + have).alias("pos"), name.alias("kind"), ((F.lit(have) + 2 * F.col("v")) % size).alias("i"), F.element_at(names, (F.col("v") % len(VARIANTS) + 1).cast("int")).alias("variant"))
    more = more.join(base.select("kind", "i", "prompt", "answer"), ["kind", "i"]).select("pos", "kind", variant(F.col("prompt"), F.col("variant")).alias("prompt"), "answer", "variant")
    return first.unionByName(more)


# ---- preference pairs


def transcript(text: Column) -> Column:
    """Turns of a transcript with Human and Assistant marks, blank ones left out."""
    return F.filter(F.transform(F.split(text, "\n\nHuman: |\n\nAssistant: "), T.strip), lambda t: t != "")


def transcript_pairs(df: DataFrame, system: str = SYSTEM) -> DataFrame:
    """df(chosen, rejected texts) as (prompt, chosen, rejected messages); rows that do not parse or agree are left out."""
    df = df.withColumn("_c", transcript(T.text_or_empty("chosen"))).withColumn("_r", transcript(T.text_or_empty("rejected"))).where("size(_c) >= 2 and size(_r) >= 1")
    turns = F.transform(F.slice("_c", F.lit(1), F.greatest(F.size("_c") - 1, F.lit(0))), lambda t, i: F.struct(F.when(i % 2 == 0, "user").otherwise("assistant").alias("role"), t.alias("content")))
    return _pairs(df, F.concat(F.array(message("system", F.lit(system))), turns), F.try_element_at("_c", F.lit(-1)), F.try_element_at("_r", F.lit(-1)), "transcript")


def question_pairs(df: DataFrame, default: str = SYSTEM) -> DataFrame:
    """df(system, question, chosen, rejected texts) as messages."""
    clean = {c: T.strip(T.text_or_empty(c)) for c in ("question", "chosen", "rejected")}
    system = F.when(T.text_or_empty("system") == "", F.lit(default)).otherwise(F.col("system"))
    prompt = F.array(message("system", system), message("user", clean["question"]))
    return _pairs(df.where(clean["question"] != ""), prompt, clean["chosen"], clean["rejected"], "question")


def message_pairs(df: DataFrame, default: str = SYSTEM) -> DataFrame:
    """df(chosen, rejected as message arrays): the last turns are the answers; the first system and all user turns the prompt."""
    last = lambda c: F.try_element_at(c, F.lit(-1))
    df = df.where("size(chosen) >= 2 and size(rejected) >= 1").where((last("chosen")["role"] == "assistant") & (last("rejected")["role"] == "assistant"))
    ahead = F.slice("chosen", F.lit(1), F.greatest(F.size("chosen") - 1, F.lit(0)))
    of = lambda role: F.transform(F.filter(ahead, lambda m: m["role"] == role), lambda m: T.strip(F.coalesce(m["content"], F.lit(""))))
    system = F.coalesce(F.nullif(F.try_element_at(of("system"), F.lit(1)), F.lit("")), F.lit(default))
    question = F.array_join(F.filter(of("user"), lambda t: t != ""), "\n\n")
    df = df.withColumn("_s", system).withColumn("_q", question).where("_q <> ''")
    answer = lambda c: T.strip(F.coalesce(last(c)["content"], F.lit("")))
    return _pairs(df, F.array(message("system", F.col("_s")), message("user", F.col("_q"))), answer("chosen"), answer("rejected"), "messages")


def _pairs(df: DataFrame, prompt: Column, chosen: Column, rejected: Column, source: str) -> DataFrame:
    out = df.select(*[c for c in df.columns if c.endswith("_id")], prompt.alias("prompt"), chosen.alias("_chosen"), rejected.alias("_rejected"))
    out = out.where((F.col("_chosen") != "") & (F.col("_rejected") != "") & (F.col("_chosen") != F.col("_rejected")))
    return out.select(*[c for c in df.columns if c.endswith("_id")], "prompt", F.array(message("assistant", F.col("_chosen"))).alias("chosen"), F.array(message("assistant", F.col("_rejected"))).alias("rejected"), F.lit(source).alias("source"))


def within_length(pairs: DataFrame, count: Column | None = None, most: int = 2048, allowance: int = 16) -> DataFrame:
    """Pairs whose prompt and longer answer fit; tokens are counted by words unless columns n_prompt, n_chosen, n_rejected are given."""
    if "n_prompt" not in pairs.columns:
        words = lambda c: F.aggregate(F.transform(c, lambda m: F.size(T.words(m["content"]))), F.lit(0), lambda a, b: a + b)
        pairs = pairs.withColumn("n_prompt", words("prompt")).withColumn("n_chosen", words("chosen")).withColumn("n_rejected", words("rejected"))
    return pairs.withColumn("fits", F.col("n_prompt") + F.greatest("n_chosen", "n_rejected") + allowance <= most)


def drop_rates(pairs: DataFrame) -> DataFrame:
    """By source: pairs, dropped, rate."""
    return pairs.groupBy("source").agg(F.count("*").alias("total"), F.count_if(~F.col("fits")).alias("dropped"), (F.count_if(~F.col("fits")) / F.count("*")).alias("drop_rate"))


def n_val_pairs(n: Column, fraction: float = 0.05) -> Column:
    return F.when(n < 500, F.greatest(F.lit(1), F.floor(n * fraction))).otherwise(F.greatest(F.lit(500), F.floor(n * fraction)))


def n_val_chat(n: Column, fraction: float = 0.02) -> Column:
    """Validation rows of chat data: a share of them, 1 000 at least, whatever there are."""
    return F.least(n, F.greatest(F.lit(1000), F.floor(n * fraction)))


def n_val_code(n: Column, fraction: float = 0.05) -> Column:
    """Validation rows of code data: a share of them, 500 at least, but one row stays for training."""
    return F.least(F.greatest(F.lit(500), F.floor(n * fraction)), F.greatest(F.lit(1), n - 1))


def text_of(df: DataFrame, name: str) -> Column:
    """A column's text whatever its type: a text itself, the last element of an array, the content of a message; else ''."""
    kind = df.schema[name].dataType
    value = F.col(name)
    if isinstance(kind, ArrayType):
        value, kind = F.try_element_at(value, F.lit(-1)), kind.elementType
    if isinstance(kind, StructType):
        value = value["content"] if "content" in kind.names else F.lit("")
    return F.coalesce(value.cast("string"), F.lit(""))


def reasons(judged: DataFrame) -> DataFrame:
    """Rows of code_pairs() by type and reason, kept ones under 'kept'."""
    return judged.groupBy("sft_type", F.coalesce("reason", F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))
