"""Scans: JSON lines (tolerant or strict) and the per-source formatters, from raw columns to documents.

Each formatter takes a DataFrame of the source's raw columns and returns text, source and the
source's own fields, after its length gate. All are narrow and native: column pruning and partition
pruning reach the scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import code as C
from millrace.functions import text as T

#: Least characters of a stripped text by source.
MIN_LENGTH = {"common_crawl": 300, "fineweb": 200, "wikipedia": 1000, "pg19": 10_000, "pes2o": 500, "open_web_math": 200, "stackexchange": 200, "stack_smol": 50, "stack_v1": 50, "jupyter": 500}

#: Fixed value: page parts that are no text.
PAGE_NOISE = "|".join(f"<{t}\\b[^>]*>.*?</{t}>" for t in ("script", "style", "nav", "header", "footer", "title")) + "|<!--.*?-->"


def jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Well-formed lines as rows; a malformed line is dropped."""
    return jsonl_with_faults(spark, path, schema).where("_fault is null").drop("_fault")


def jsonl_with_faults(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines as rows, with the text of a malformed one in _fault."""
    return spark.read.schema(f"{schema}, _fault string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_fault").json(path)


def jsonl_strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of a file in which a malformed line is an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def parse_faults(lines: DataFrame, schema: str) -> DataFrame:
    """One row of lines(value): lines and malformed ones."""
    parsed = F.from_json("value", f"{schema}, _fault string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_fault"})
    return lines.select(parsed.alias("r")).agg(F.count("*").alias("lines"), F.count_if(F.col("r._fault").isNotNull()).alias("parse_errors"))


def or_empty(*names: str) -> Column:
    """The first of the columns that is neither null nor empty, or ''."""
    return F.coalesce(*(F.nullif(F.col(n), F.lit("")) for n in names), F.lit(""))


def _gate(df: DataFrame, source: str, text: Column, least: int, **fields: Column) -> DataFrame:
    out = df.select(text.alias("text"), F.lit(source).alias("source"), *(c.alias(n) for n, c in fields.items()))
    return out.where(F.length("text") >= least)


def web(df: DataFrame) -> DataFrame:
    return _gate(df, "fineweb", T.strip(or_empty("text")), MIN_LENGTH["fineweb"], url=or_empty("url"), dump=or_empty("dump"), language=or_empty("language"))


def encyclopedia(df: DataFrame) -> DataFrame:
    return _gate(df, "wikipedia", T.strip(or_empty("text")), MIN_LENGTH["wikipedia"], title=or_empty("title"), url=or_empty("url"))


def books(df: DataFrame) -> DataFrame:
    return _gate(df, "pg19", T.strip(or_empty("text")), MIN_LENGTH["pg19"], title=or_empty("short_book_title"), publication_date=F.col("publication_date").cast("string"), url=or_empty("url"))


def papers(df: DataFrame, subsets: tuple[str, ...] = ("s2orc", "s2ag")) -> DataFrame:
    """The subset is the part of the source's name before a slash."""
    subset = F.split_part(or_empty("source"), F.lit("/"), F.lit(1))
    df = df.withColumn("_subset", subset).where(F.col("_subset").isin(*subsets))
    return _gate(df, "pes2o", T.strip(or_empty("text")), MIN_LENGTH["pes2o"], paper_id=F.col("id").cast("string"), subset=F.col("_subset"))


def math_pages(df: DataFrame) -> DataFrame:
    """The subdomain comes out of a JSON text; one that does not parse gives ''."""
    subdomain = F.coalesce(F.get_json_object("metadata", "$.subdomain"), F.get_json_object("metadata", "$.extraction_info.subdomain"), F.lit(""))
    return _gate(df, "open_web_math", T.strip(or_empty("text")), MIN_LENGTH["open_web_math"], url=or_empty("url"), date=F.col("date").cast("string"), subdomain=subdomain)


def question_answers(df: DataFrame, least_score: int = 1) -> DataFrame:
    """The question with its best answer (the first of the highest score), as plain text."""
    none = F.struct(F.lit(None).cast("string").alias("text"), F.lit(least_score - 1).alias("score"))

    def better(best: Column, a: Column) -> Column:
        score = F.coalesce(a["pm_score"].try_cast("int"), F.lit(0))
        return F.when(score > best["score"], F.struct(F.coalesce(a["text"], F.lit("")).alias("text"), score.alias("score"))).otherwise(best)

    best = F.aggregate("answers", none, better, lambda b: b["text"])
    df = df.withColumn("_q", T.html_to_text(or_empty("question"))).withColumn("_a", T.html_to_text(F.coalesce(best, F.lit("")))).where("_q <> '' and _a <> ''")
    text = F.concat(F.lit("Q: "), F.col("_q"), F.lit("\n\nA: "), F.col("_a"))
    return _gate(df, "stackexchange", text, MIN_LENGTH["stackexchange"], site=T.url_site(F.coalesce(F.get("metadata", F.lit(0)), F.lit(""))), question_id=F.col("qid").cast("string"))


def functions_with_docs(df: DataFrame, least_code: int = 100, least_doc: int = 20) -> DataFrame:
    """Documentation as comment lines above the code, from which an inline copy is taken out."""
    code, doc = T.strip(or_empty("func_code_string", "code")), T.strip(or_empty("func_documentation_string", "docstring"))
    df = df.withColumn("_doc", doc).withColumn("_code0", code)
    df = df.withColumn("_code", F.when(F.col("language").isin("python", "ruby"), C.splice_docstring(F.col("_code0"), F.col("_doc"))).otherwise(F.col("_code0")))
    df = df.where((F.length("_code") >= least_code) & (F.length("_doc") >= least_doc))
    mark = F.when(F.col("language").isin("python", "ruby"), "#").otherwise("//")
    text = F.concat(C.comment_lines(F.col("_doc"), mark), F.lit("\n"), F.col("_code"))
    return _gate(df, "codesearchnet", text, 1, language=F.col("language"), repo=or_empty("repository_name", "repo"), path=or_empty("func_path_in_repository", "path"))


def code_files(df: DataFrame, source: str = "stack_v1", languages: tuple[str, ...] = ("python", "go", "rust", "shell")) -> DataFrame:
    """Files of some languages; on a table partitioned by language only their folders are read."""
    df = df.where(F.col("language").isin(*languages))
    return _gate(df, source, T.strip(or_empty("content")), MIN_LENGTH[source], language=F.col("language"), repo=or_empty("max_stars_repo_name", "repository_name"), path=or_empty("max_stars_repo_path", "path"))


def notebooks(df: DataFrame) -> DataFrame:
    return _gate(df, "jupyter", T.strip(or_empty("text", "content")), MIN_LENGTH["jupyter"], repo=or_empty("repo_name"))


def intents(df: DataFrame, least: int = 10) -> DataFrame:
    """An intent as a comment above its snippet."""
    intent, snippet = T.strip(or_empty("rewritten_intent", "intent")), T.strip(or_empty("snippet"))
    df = df.where((F.length(intent) >= least) & (F.length(snippet) >= least))
    return _gate(df, "conala", F.concat(C.comment_lines(intent, F.lit("#")), F.lit("\n"), snippet), 1, language=F.lit("python"), question_id=F.col("question_id").cast("string"))


def pages(df: DataFrame, least: int = MIN_LENGTH["common_crawl"]) -> DataFrame:
    """Raw pages as texts: page_id, url, site, text. Scripts, styles, comments and navigation go before the tags do."""
    bare = F.regexp_replace("html", f"(?is){PAGE_NOISE}", "")
    return df.select("page_id", "url", T.url_site(F.col("url")).alias("site"), T.html_to_text(bare).alias("text")).where(F.length("text") >= least)


def arithmetic(spark: SparkSession, n: int, seed: int = 42) -> DataFrame:
    """A generator of n documents of worked sums: (id, text, source). Draws are hashes of (seed, id, place); reruns agree.

    + - * / are drawn as 40, 30, 20 and 10 %, 28 to 44 problems a document, in five styles, a blank line
    before one problem in five; quotients are exact.
    """

    def draw(*place: Column) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), *place), F.lit(1_000_003))

    docs = spark.range(n).select("id", (28 + draw(F.col("id"), F.lit("n")) % 17).alias("n"))
    rows = docs.select("id", F.explode(F.sequence(F.lit(1), F.col("n").cast("int"))).alias("k"))
    d = lambda name: draw(F.col("id"), F.col("k"), F.lit(name))
    rows = rows.select("id", "k", (d("op") % 100).alias("o"), (d("style") % 100).alias("s"), (d("a") % 99 + 1).alias("a"), (d("b") % 20 + 1).alias("b"), (d("blank") % 5 == 0).alias("blank"))
    op = F.when(F.col("o") < 40, "+").when(F.col("o") < 70, "-").when(F.col("o") < 90, "*").otherwise("/")
    rows = rows.withColumn("op", op).withColumn("x", F.when(F.col("op") == "/", F.col("a") * F.col("b")).when(F.col("op") == "-", F.greatest("a", "b")).otherwise(F.col("a")))
    rows = rows.withColumn("y", F.when(F.col("op") == "-", F.least("a", "b")).otherwise(F.col("b")))
    z = F.when(F.col("op") == "+", F.col("x") + F.col("y")).when(F.col("op") == "-", F.col("x") - F.col("y")).when(F.col("op") == "*", F.col("x") * F.col("y")).otherwise(F.col("a"))
    rows = rows.withColumn("z", z)
    name = F.when(F.col("op") == "+", "plus").when(F.col("op") == "-", "minus").when(F.col("op") == "*", "times").otherwise("divided by")
    expr = F.concat_ws(" ", F.col("x").cast("string"), "op", F.col("y").cast("string"))
    line = (
        F.when(F.col("s") < 35, F.concat(expr, F.lit(" = "), F.col("z")))
        .when(F.col("s") < 60, F.concat(F.lit("Q: What is "), expr, F.lit("?\nA: "), F.col("z")))
        .when(F.col("s") < 75, F.concat_ws(" ", T.number_words(F.col("x")), name, T.number_words(F.col("y")), F.lit("is"), T.number_words(F.col("z"))))
        .when(F.col("s") < 90, F.concat(F.lit("Compute "), expr, F.lit(". The answer is "), F.col("z"), F.lit(".")))
        .otherwise(F.concat(F.col("z"), F.lit(" equals "), expr))
    )
    rows = rows.withColumn("line", F.concat(F.when(F.col("blank") & (F.col("k") > 1), "\n").otherwise(""), line))
    whole = rows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("k", "line"))).alias("l"))
    return whole.select("id", F.concat(F.array_join(F.transform("l", lambda x: x["line"]), "\n"), F.lit("\n"), F.lit("[set "), F.col("id").cast("string"), F.lit("]")).alias("text"), F.lit("synthetic_arithmetic").alias("source"))
