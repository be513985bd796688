"""The registered queries over the corpus tables, each with the DuckDB statement it is checked by where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import blend, chat, dedup, quality, stats, tokens, validate
from millrace.plans import curation
from millrace.plans import sql as Q
from millrace.sources import records, sinks
from millrace.streaming import curation as streaming

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None):
    def run(f):
        QUERIES[f.__name__] = lambda spark, d: longs(f(spark, d))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return run


def longs(df: DataFrame) -> DataFrame:
    """Whole numbers as 64 bits, as the oracles have them."""
    return df.select(*(F.col(f"`{n}`").cast("bigint").alias(n) if kind in ("int", "smallint", "tinyint") else F.col(f"`{n}`") for n, kind in df.dtypes))


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def docs_of(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents")


# ---- quality filter


@register(f"SELECT doc_id, source, reason FROM ({Q.verdict()})")
def quality_verdict(spark, d):
    return quality.verdict(docs_of(spark, d).select("doc_id", "source", "text"))


@register(f"SELECT source, coalesce(reason, 'kept') AS reason, count(*) AS n FROM ({Q.verdict()}) GROUP BY 1, 2")
def quality_rejections(spark, d):
    return quality.rejection_report(docs_of(spark, d).select("doc_id", "source", "text"))


@register("SELECT doc_id, len, n_lines, n_words, n_bullets, n_ellipses, n_repeated, word_chars, n_symbols, n_alpha, n_boilerplate, n_stop FROM (" + Q.FEATURES.replace("{docs}", "documents").replace("{source}", "source") + ")")
def quality_features(spark, d):
    return quality.features(docs_of(spark, d).select("doc_id", "text"))


CODE_TAGS = {"src3": "jupyter", "src7": "conala", "src9": "pg19"}


@register(f"""SELECT doc_id, source, reason FROM ({Q.verdict(source="CASE source WHEN 'src3' THEN 'jupyter' WHEN 'src7' THEN 'conala' WHEN 'src9' THEN 'pg19' ELSE source END")})""")
def quality_code_routing(spark, d):
    return quality.verdict(quality.with_code_sources(docs_of(spark, d).select("doc_id", "source", "text"), CODE_TAGS))


# ---- dedup


@register(Q.EXACT)
def exact_dedup(spark, d):
    return dedup.exact_survivors(docs_of(spark, d))


@register(f"SELECT source, count(*) AS total, count(*) FILTER (kept) AS kept, count(*) FILTER (NOT kept) AS exact_duplicates FROM ({Q.EXACT}) GROUP BY source")
def exact_dedup_report(spark, d):
    return dedup.report(docs_of(spark, d))


@register(f"""SELECT count(DISTINCT {Q.exact_hash("coalesce(text, '')")}) AS hashes, count(DISTINCT {Q.exact_hash("coalesce(text, '')")}) * 8 AS index_bytes FROM documents""")
def hash_index(spark, d):
    return dedup.index_size(docs_of(spark, d))


@register(f"""WITH h AS (SELECT doc_id, source, {Q.exact_hash("coalesce(text, '')")} AS hash FROM documents)
SELECT doc_id, hash FROM h WHERE source <> 'src0' AND hash NOT IN (SELECT hash FROM h WHERE source = 'src0')""")
def incremental_dedup(spark, d):
    docs = docs_of(spark, d)
    seen = docs.where("source = 'src0'").select(T.exact_hash(T.text_or_empty("text")).alias("hash"))
    return dedup.new_only(docs.where("source <> 'src0'"), seen).select("doc_id", "hash")


_GRAMS = f"""SELECT doc_id, source, list_distinct(list_transform({Q.ngrams('w', 5)}, lambda z: {Q.portable_hash('z')} % {dedup.PRIME})) AS g FROM (SELECT doc_id, source, {Q.words(Q.normalize("coalesce(text, '')"))} AS w FROM {{docs}})"""
_AB = "(VALUES " + ", ".join(f"({i // dedup.ROWS}, {i}, {a}::BIGINT, {b}::BIGINT)" for i, (a, b) in enumerate(dedup.functions(dedup.BANDS * dedup.ROWS))) + ") f(band, i, a, b)"


def signatures_sql(docs: str = "documents") -> str:
    return f"""SELECT doc_id, source, band::BIGINT AS band, string_agg(least::VARCHAR, '-' ORDER BY i) AS key FROM (
SELECT doc_id, source, band, i, min((x * a + b) % {dedup.PRIME}) AS least FROM (SELECT doc_id, source, unnest(g) AS x FROM ({_GRAMS.replace('{docs}', docs)})), {_AB} GROUP BY ALL) GROUP BY doc_id, source, band"""


def edges_sql(docs: str = "documents") -> str:
    return f"SELECT DISTINCT src, dst FROM (SELECT min(doc_id) OVER (PARTITION BY source, band, key) AS src, doc_id AS dst FROM ({signatures_sql(docs)})) WHERE src <> dst"


def clusters_sql(docs: str = "documents") -> str:
    return f"""WITH RECURSIVE e AS MATERIALIZED ({edges_sql(docs)}), b AS MATERIALIZED (SELECT src, dst FROM e UNION SELECT dst, src FROM e),
r(doc_id, other) AS (SELECT src, src FROM b UNION SELECT r.doc_id, b.dst FROM r JOIN b ON r.other = b.src) SELECT doc_id, min(other) AS cluster FROM r GROUP BY doc_id"""


@register(signatures_sql())
def minhash_bands(spark, d):
    return dedup.signatures(docs_of(spark, d))


@register(edges_sql())
def minhash_edges(spark, d):
    return dedup.star_edges(dedup.signatures(docs_of(spark, d)))


@register(clusters_sql())
def minhash_clusters(spark, d):
    return dedup.clusters(dedup.star_edges(dedup.signatures(docs_of(spark, d))))


def fuzzy_sql(docs: str = "documents") -> str:
    return f"SELECT d.doc_id, d.source, coalesce(c.cluster, d.doc_id) AS cluster, coalesce(c.cluster, d.doc_id) = d.doc_id AS kept FROM {docs} d LEFT JOIN ({clusters_sql(docs)}) c USING (doc_id)"


@register(fuzzy_sql())
def fuzzy_dedup(spark, d):
    return dedup.fuzzy_survivors(docs_of(spark, d))


@register(f"""WITH x AS (SELECT doc_id FROM ({Q.EXACT}) WHERE NOT kept), rest AS (SELECT * FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM x))
SELECT doc_id, 'exact' AS stage FROM x UNION ALL SELECT doc_id, 'near' FROM ({fuzzy_sql('rest')}) WHERE NOT kept""")
def removed_documents(spark, d):
    return dedup.removed(docs_of(spark, d)).select("doc_id", "stage")


# ---- blend, split


def aims_sql(tokens: int) -> str:
    return ", ".join(f"({s!r}, {i}, {t})" for i, (s, t) in enumerate(blend.char_targets(tokens).items()))


@register("SELECT t.target, m.source, m.ord::BIGINT AS ord, CASE WHEN m.code THEN floor(floor(t.tokens * 0.1::DOUBLE * 4.3) * (m.pct / 100.0::DOUBLE)) ELSE floor(t.tokens * (m.pct / 100.0::DOUBLE) * 4.3) END::BIGINT AS target_chars FROM (VALUES ('mini', 1000000), ('125m', 5500000000), ('350m', 15000000000), ('1b', 30000000000)) t(target, tokens), (VALUES ('common_crawl', 0, 10.0::DOUBLE, false), ('fineweb', 1, 46.0, false), ('wikipedia', 2, 10.0, false), ('pg19', 3, 2.5, false), ('pes2o', 4, 5.0, false), ('open_web_math', 5, 10.0, false), ('stackexchange', 6, 5.0, false), ('synthetic_arithmetic', 7, 1.5, false), ('stack_v1', 8, 50.0, true), ('codesearchnet', 9, 35.0, true), ('stack_smol', 10, 10.0, true), ('jupyter', 11, 4.0, true), ('conala', 12, 1.0, true)) m(source, ord, pct, code)")
def char_targets(spark, d):
    out = None
    for name, n in blend.CORPUS_TOKENS.items():
        own = blend.mix_table(spark, n).withColumn("target", F.lit(name))
        out = own if out is None else out.unionByName(own)
    return out


_DOC_CHARS = ", ".join(f"('{k}', {v})" for k, v in blend.DOC_CHARS.items())
_SHARES = ", ".join(f"('{k}', {v / 100.0!r}::DOUBLE, 1.0::DOUBLE)" for k, v in blend.DATA_MIX.items() if k != "code") + ", " + ", ".join(f"('{k}', {blend.DATA_MIX['code'] / 100.0!r}::DOUBLE, {v / 100.0!r}::DOUBLE)" for k, v in blend.CODE_SUBMIX.items())
_MINI = ", ".join(f"('{k}', {v}::BIGINT)" for k, v in blend.MINI_CAPS.items())


@register(f"""SELECT t.target, s.source, floor(t.tokens * (s.p * s.q) * 4.3::DOUBLE / c.chars * CASE s.source WHEN 'wikipedia' THEN 3.0::DOUBLE WHEN 'synthetic_arithmetic' THEN 1.5::DOUBLE ELSE 5.0::DOUBLE END)::BIGINT AS max_docs,
CASE WHEN s.source = 'common_crawl' THEN greatest(1, ceil(floor(t.tokens * 0.1::DOUBLE * 4.3::DOUBLE) / 17000000))::BIGINT END AS segments, t.tokens * t.epochs AS consumed_tokens, m.cap AS mini_cap
FROM (VALUES ('mini', 1000000::BIGINT, 1), ('125m', 5500000000, 2), ('350m', 15000000000, 2), ('1b', 30000000000, 1)) t(target, tokens, epochs), (VALUES {_SHARES}) s(source, p, q) LEFT JOIN (VALUES {_DOC_CHARS}) c(source, chars) USING (source) JOIN (VALUES {_MINI}) m(source, cap) USING (source)""")
def download_plan(spark, d):
    rows = [(t, s, blend.doc_cap(s, t), blend.crawl_segments(n) if s == "common_crawl" else None, blend.consumed_tokens(t), blend.MINI_CAPS[s]) for t, n in blend.CORPUS_TOKENS.items() for s in blend.SOURCES]
    return spark.createDataFrame(rows, "target string, source string, max_docs long, segments long, consumed_tokens long, mini_cap long")


#: A mix over the table's own sources and one that it has not: budgets by number, src0 the sink.
_AIMS = "SELECT CASE WHEN i = 20 THEN 'absent' ELSE 'src' || i END AS source, (20000 + 4000 * i)::BIGINT AS target_chars FROM range(21) r(i)"


def aims(spark):
    return spark.range(21).select(F.when(F.col("id") == 20, "absent").otherwise(F.concat(F.lit("src"), F.col("id").cast("string"))).alias("source"), (20000 + 4000 * F.col("id")).alias("target_chars"))


_CHARS = "SELECT doc_id, source, length(coalesce(text, ''))::BIGINT AS chars FROM documents"
_CAP = f"""SELECT *, before < target_chars AS kept FROM (SELECT c.doc_id, c.source, chars, target_chars,
coalesce(sum(chars) OVER (PARTITION BY c.source ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM ({_CHARS}) c JOIN ({_AIMS}) a ON c.source = a.source)"""
_BLEND = f"""WITH c AS ({_CAP}), s AS (SELECT source, max(target_chars) AS t, coalesce(sum(chars) FILTER (kept), 0) AS used FROM c GROUP BY source),
f AS (SELECT sum(greatest(0, t - used)) AS deficit, coalesce(max(used) FILTER (source = 'src0'), 0) AS sink_used FROM s)
SELECT c.*, source = 'src0' AND NOT kept AND before + chars > sink_used AND before - sink_used < deficit AS overflow FROM c, f"""


def capped_docs(spark, d):
    return blend.chars(docs_of(spark, d))


@register(_CAP)
def blend_cap(spark, d):
    return blend.cap(capped_docs(spark, d), aims(spark))


@register(_BLEND)
def blend_overflow(spark, d):
    return blend.blend(capped_docs(spark, d), aims(spark), "src0")


@register(f"""SELECT source, docs, chars, target_chars, overflow_docs, overflow_chars, greatest(0, target_chars - chars)::BIGINT AS deficit, floor((chars + overflow_chars) / 4.3::DOUBLE)::BIGINT AS estimated_tokens FROM (
SELECT source, count(*) FILTER (kept) AS docs, coalesce(sum(chars) FILTER (kept), 0)::BIGINT AS chars, max(target_chars) AS target_chars, count(*) FILTER (overflow) AS overflow_docs, coalesce(sum(chars) FILTER (overflow), 0)::BIGINT AS overflow_chars FROM ({_BLEND}) GROUP BY source)""")
def blend_stats(spark, d):
    return blend.blend_stats(blend.blend(capped_docs(spark, d), aims(spark), "src0"))


@register("""SELECT '{"total_documents":' || sum(docs)::BIGINT || ',"source_mix":{' || string_agg('"' || source || '":{"docs":' || docs || ',"chars":' || chars || ',"target_chars":' || target_chars || ',"deficit":' || deficit
|| ',"overflow_docs":' || overflow_docs || ',"overflow_chars":' || overflow_chars || '}', ',' ORDER BY source) || '}}' AS stats FROM (""" + ORACLES["blend_stats"] + ")")
def blend_stats_json(spark, d):
    return blend.stats_json(blend.blend_stats(blend.blend(capped_docs(spark, d), aims(spark), "src0")))


_SPLIT = Q.split_sql("(SELECT doc_id, source FROM documents)", "doc_id", "42", 0.005, 1)


@register(_SPLIT)
def split_exact(spark, d):
    return blend.split(docs_of(spark, d).select("doc_id", "source"))


@register(f"SELECT source, count(*) AS docs, count(*) FILTER (split = 'val') AS val_docs FROM ({Q.split_sql('(SELECT doc_id, source FROM documents)', 'doc_id', '42', 0.05, 1)}) GROUP BY source")
def val_mix(spark, d):
    return blend.split(docs_of(spark, d).select("doc_id", "source"), fraction=0.05).groupBy("source").agg(F.count("*").alias("docs"), F.count_if(F.col("split") == "val").alias("val_docs"))


@register("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS r FROM documents) WHERE r <= 7")
def head_caps(spark, d):
    docs = docs_of(spark, d).select("doc_id", "source")
    return blend.head(docs, docs.select("source").distinct().withColumn("n", F.lit(7))).select("doc_id", "source")


@register("SELECT doc_id, source FROM (SELECT doc_id, source, row_number() OVER (ORDER BY md5('7:' || doc_id), doc_id) AS r FROM documents WHERE length(text) > 1000) WHERE r <= 50")
def shuffled_cap(spark, d):
    rows = docs_of(spark, d).where(F.length("text") > 1000).select("doc_id", "source", F.md5(F.concat(F.lit("7:"), F.col("doc_id").cast("string"))).alias("h"))
    return rows.orderBy("h", "doc_id").limit(50).select("doc_id", "source")


@register("SELECT doc_id, CASE WHEN lang IS NULL THEN 0 ELSE 1 END + 1 AS n_keys, lang AS lang, doc_id::VARCHAR AS id FROM documents")
def flatten_records(spark, d):
    nested = docs_of(spark, d).select("doc_id", "text", F.col("doc_id").alias("id"), F.create_map(F.lit("lang"), F.col("lang"), F.lit("file_path"), F.lit("x"), F.lit("id"), F.lit("inner")).alias("metadata"))
    flat = blend.flatten(nested.select("text", "id", "metadata"))
    return flat.select(F.col("meta")["id"].cast("long").alias("doc_id"), F.size("meta").alias("n_keys"), F.col("meta")["lang"].alias("lang"), F.col("meta")["id"].alias("id"))


@register("SELECT * FROM (VALUES ('own', 0::BIGINT), ('shares', 1), ('submix', 1), ('sink', 1), ('overlap', 2), ('keys', 1), ('aliases', 2), ('mini', 1)) t(mix, faults)")
def mix_integrity(spark, d):
    """Faults of the mix as it is, and of mixes with one thing wrong each."""
    mix, sub = blend.DATA_MIX, blend.CODE_SUBMIX
    target = {"corpus_tokens": 5, "epochs": 1, "crawls": ("a",), "display_corpus": "5"}
    cases = {
        "own": blend.mix_faults(targets={"x": target}, mini=blend.MINI_CAPS),
        "shares": blend.mix_faults(mix=mix | {"fineweb": 45.0}),
        "submix": blend.mix_faults(submix=sub | {"conala": 2.0}),
        "sink": blend.mix_faults(sink="nowhere"),
        "overlap": blend.mix_faults(submix=sub | {"pg19": 1.0}),
        "keys": blend.mix_faults(targets={"x": {k: v for k, v in target.items() if k != "epochs"}}),
        "aliases": blend.mix_faults(targets={"x": target | {"total_tokens": 6, "display_tokens": "6"}}),
        "mini": blend.mix_faults(mini=blend.MINI_CAPS | {"other": 3}),
    }
    return spark.createDataFrame([(k, len(v)) for k, v in cases.items()], "mix string, faults long")


# ---- validation

_TERMINAL = "list_contains(['.', '!', '?', '\"', ''''], right(l, 1))"
_MANUAL = f"""SELECT doc_id, source, CASE WHEN NOT list_bool_or(list_concat([false], list_transform(ls, lambda l: {_TERMINAL}))) THEN 'terminal_punct'
WHEN len(ls) >= 4 AND (len(ls) - len(list_distinct(ls))) / len(ls) > 0.3 THEN 'repeated_lines' END AS reason
FROM (SELECT doc_id, source, {Q.lines("coalesce(text, '')")} AS ls FROM documents)"""


@register(_MANUAL)
def validate_manual(spark, d):
    return validate.validate(docs_of(spark, d)).select("doc_id", "source", "reason")


@register(f"""SELECT split, count(*) AS total, count(*) FILTER (reason IS NULL) AS kept, count(*) FILTER (reason = 'terminal_punct') AS rejected_terminal_punct,
count(*) FILTER (reason = 'repeated_lines') AS rejected_repeated_lines, count(*) FILTER (reason = 'perplexity') AS rejected_perplexity
FROM ({_MANUAL}) m JOIN ({Q.split_sql('(SELECT doc_id FROM documents)', 'doc_id', '42', 0.05, 1)}) s USING (doc_id) GROUP BY ROLLUP (split)""")
def validate_counters(spark, d):
    return validate.counters(validate.validate(blend.split(docs_of(spark, d), fraction=0.05)))


_PPL = f"""WITH w AS (SELECT unnest({Q.words("lower(coalesce(text, ''))")}) AS w FROM documents), b AS (SELECT w, count(*) AS c FROM w GROUP BY w), t AS (SELECT sum(c)::BIGINT AS n, count(*) AS v FROM b),
o AS (SELECT doc_id, w, count(*) AS k FROM (SELECT doc_id, unnest({Q.words("lower(substr(coalesce(text, ''), 1, 2000))")}) AS w FROM documents) GROUP BY doc_id, w)
SELECT d.doc_id, p AS perplexity FROM documents d LEFT JOIN (SELECT doc_id, exp(sum(k * -ln((coalesce(c, 0) + 1) / (n + v)::DOUBLE)) / sum(k)) AS p FROM o LEFT JOIN b USING (w), t GROUP BY doc_id) USING (doc_id)"""


@register(f"SELECT doc_id, round(perplexity, 3) AS perplexity FROM ({_PPL})")
def perplexity(spark, d):
    return validate.unigram_perplexity(docs_of(spark, d).select("doc_id", "text")).select("doc_id", F.round("perplexity", 3).alias("perplexity"))


@register(f"SELECT round(list_sort(list(perplexity))[floor(0.9 * count(*))::BIGINT + 1], 3) AS threshold FROM ({_PPL}) WHERE perplexity IS NOT NULL")
def perplexity_threshold(spark, d):
    scored = validate.unigram_perplexity(docs_of(spark, d).select("doc_id", "text"))
    return validate.order_statistic(scored, "perplexity").select(F.round("threshold", 3).alias("threshold"))


@register(f"SELECT source, round(quantile_cont(perplexity, 0.1), 3) AS p10, round(quantile_cont(perplexity, 0.5), 3) AS p50, round(quantile_cont(perplexity, 0.9), 3) AS p90, round(quantile_cont(perplexity, 0.99), 3) AS p99 FROM ({_PPL}) JOIN documents USING (doc_id) WHERE perplexity < 10000 GROUP BY source")
def perplexity_quantiles(spark, d):
    scored = validate.unigram_perplexity(docs_of(spark, d).select("doc_id", "source", "text"))
    return stats.quantiles(scored.where("perplexity < 10000"), "source", "perplexity", (0.1, 0.5, 0.9, 0.99))


_REPETITION = f"""WITH x AS (SELECT doc_id, t, length(t) AS n, {Q.lines('t')} AS ls, list_filter(list_transform(regexp_split_to_array(t, '\\n\\n+'), lambda p: {Q.strip('p')}), lambda p: p <> '') AS ps, {Q.words('t')} AS w FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)),
g AS ({' UNION ALL '.join(f"SELECT doc_id, n, {k} AS k, unnest({Q.ngrams('w', k)}) AS g FROM x" for k in (2, 3, 4))}),
c AS (SELECT doc_id, k, g, count(*) AS m, max(n) AS n FROM g GROUP BY doc_id, k, g),
p AS (SELECT doc_id, max(length(g) * m / n) FILTER (k = 2) AS top_2, max(length(g) * m / n) FILTER (k = 3) AS top_3, max(length(g) * m / n) FILTER (k = 4) AS top_4 FROM c WHERE m > 1 GROUP BY doc_id)
SELECT doc_id, round(coalesce((len(ls) - len(list_distinct(ls))) / nullif(len(ls), 0), 0), 6) AS dup_line, round(coalesce((len(ps) - len(list_distinct(ps))) / nullif(len(ps), 0), 0), 6) AS dup_para,
round(coalesce((length(array_to_string(ls, '')) - length(array_to_string(list_distinct(ls), ''))) / nullif(n, 0), 0), 6) AS dup_line_char,
round(coalesce((length(array_to_string(ps, '')) - length(array_to_string(list_distinct(ps), ''))) / nullif(n, 0), 0), 6) AS dup_para_char,
round(coalesce(top_2, 0), 6) AS top_2, round(coalesce(top_3, 0), 6) AS top_3, round(coalesce(top_4, 0), 6) AS top_4 FROM x LEFT JOIN p USING (doc_id)"""


@register(_REPETITION)
def repetition_measures(spark, d):
    m = validate.repetition(docs_of(spark, d))
    return m.select("doc_id", *(F.round(c, 6).alias(c) for c in ("dup_line", "dup_para", "dup_line_char", "dup_para_char", "top_2", "top_3", "top_4")))


@register(f"""SELECT doc_id, CASE WHEN dup_para > 0.3 THEN 'dup_para_frac' WHEN dup_para_char > 0.2 THEN 'dup_para_char_frac' WHEN dup_line > 0.3 THEN 'dup_line_frac' WHEN dup_line_char > 0.2 THEN 'dup_line_char_frac'
WHEN top_2 > 0.2 THEN 'top_2_gram' WHEN top_3 > 0.18 THEN 'top_3_gram' WHEN top_4 > 0.16 THEN 'top_4_gram' END AS reason FROM ({_REPETITION.replace(', 6)', ', 12)')})""")
def repetition_filter(spark, d):
    return validate.repetition(docs_of(spark, d)).select("doc_id", validate.repetition_reason().alias("reason"))


@register(f"""SELECT doc_id, len(ls) AS kept_lines, {Q.count(f'array_to_string(ls, {Q.NL})', '[.!?]+')} AS sentences, {Q.count(f'array_to_string(ls, {Q.NL})', '[.!?]+')} >= 3 AS kept
FROM (SELECT doc_id, list_filter({Q.lines("coalesce(text, '')")}, lambda l: list_contains(['.', '!', '?', '"'], right(l, 1))) AS ls FROM documents)""")
def c4_filter(spark, d):
    return validate.c4(docs_of(spark, d))


# ---- statistics


@register("SELECT source, count(*) AS docs, sum(length(text))::BIGINT AS total_chars, (sum(length(text)) // count(*))::BIGINT AS avg_chars, floor(sum(length(text)) / 4.3::DOUBLE)::BIGINT AS est_tokens FROM documents GROUP BY source")
def source_stats(spark, d):
    return stats.by_source(docs_of(spark, d))


@register("SELECT source, lang, count(*) AS n FROM documents GROUP BY source, lang")
def source_languages(spark, d):
    return docs_of(spark, d).groupBy("source", "lang").agg(F.count("*").alias("n"))


@register("SELECT source, round(100.0 * count(*) / sum(count(*)) OVER (), 6) AS pct FROM documents GROUP BY source")
def source_share(spark, d):
    return stats.share(docs_of(spark, d), "source")


@register("SELECT source, count(*) AS n, min(length(text)) AS least, floor(quantile_cont(length(text), 0.5))::BIGINT AS median, floor(avg(length(text)))::BIGINT AS mean, max(length(text)) AS most, round(quantile_cont(length(text), 0.95), 3) AS p95 FROM documents GROUP BY source")
def length_summary(spark, d):
    return stats.length_summary(docs_of(spark, d))


@register(f"""WITH v AS ({_MANUAL}) SELECT stage, round(avg(n), 6) AS mean, quantile_cont(n, 0.5)::DOUBLE AS median FROM (SELECT 'before' AS stage, length(text) AS n FROM documents UNION ALL SELECT 'after', length(text) FROM documents JOIN v USING (doc_id) WHERE reason IS NULL) GROUP BY stage""")
def lengths_before_after(spark, d):
    docs = docs_of(spark, d)
    return stats.before_after(docs, validate.validate(docs).where("reason is null"))


@register(f"""WITH p AS ({_PPL}) SELECT 'top' AS side, doc_id, round(perplexity, 3) AS perplexity FROM (SELECT * FROM p WHERE perplexity IS NOT NULL ORDER BY perplexity DESC, doc_id LIMIT 3) UNION ALL
SELECT 'bottom', doc_id, round(perplexity, 3) FROM (SELECT * FROM p WHERE perplexity IS NOT NULL ORDER BY perplexity, doc_id LIMIT 3)""")
def perplexity_extremes(spark, d):
    return stats.extremes(validate.unigram_perplexity(docs_of(spark, d).select("doc_id", "text")), "doc_id", "perplexity", 3)


@register(f"""SELECT source, round(avg(coalesce(len(list_filter(ls, lambda l: {_TERMINAL})) / nullif(len(ls), 0), 0)), 6) AS ratio FROM (SELECT source, {Q.lines("coalesce(text, '')")} AS ls FROM documents) GROUP BY source""")
def terminal_punct_ratio(spark, d):
    return stats.terminal_ratio(docs_of(spark, d))


@register(f"SELECT count(*) AS curated, count(*) FILTER (reason IS NULL) AS validated, round(count(*) FILTER (reason IS NULL) / count(*), 6) AS retention FROM ({_MANUAL})")
def retention(spark, d):
    return stats.retention(validate.validate(docs_of(spark, d)))


@register(f"""SELECT a.source, round(100.0 * target_chars / sum(target_chars) OVER (), 6) AS target_pct, round(coalesce(100.0 * n / sum(n) OVER (), 0), 6) AS realized_pct
FROM ({_AIMS}) a LEFT JOIN (SELECT source, sum(chars) AS n FROM ({_CHARS}) GROUP BY source) USING (source)""")
def target_vs_realized(spark, d):
    return stats.target_vs_realized(aims(spark), capped_docs(spark, d))


@register(f"""WITH w AS (SELECT source, unnest(list_filter(regexp_extract_all(lower(text), '[{T.WORD_CHARS}]+'), lambda x: regexp_full_match(x, '[a-z]{{3,}}'))) AS word FROM documents),
c AS (SELECT source, word, count(*) AS n FROM w WHERE word NOT IN ({", ".join(map(repr, stats.COMMON))}) GROUP BY source, word)
SELECT source, word, n, rank FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n DESC, word) AS rank FROM c) WHERE rank <= 15""")
def word_frequency(spark, d):
    return stats.top_words(docs_of(spark, d))


@register("SELECT source, least(floor(length(text) / 1000.0), 49)::BIGINT AS bin, count(*) AS n FROM documents GROUP BY 1, 2")
def length_histogram(spark, d):
    return stats.histogram(docs_of(spark, d).select("source", F.length("text").alias("n_chars")), "source", "n_chars", 0, 50_000, 50)


@register(f"""SELECT conv_turns AS turns, count(*) AS conversations, sum(chars)::BIGINT AS chars FROM (SELECT conv_id, count(*) AS conv_turns, sum(length(text)) AS chars FROM conversations GROUP BY conv_id) GROUP BY 1""")
def turn_distribution(spark, d):
    return stats.turns(table(spark, d, "conversations"))


@register(f"""SELECT count(*) FILTER (n > 2048) / count(*) AS over_2048, count(*) FILTER (n > 4096) / count(*) AS over_4096, round(avg(n), 6) AS mean, quantile_cont(n, 0.5)::DOUBLE AS median, round(quantile_cont(n, 0.95), 6) AS p95 FROM (SELECT len({Q.words("coalesce(text, '')")}) + 2 AS n FROM documents)""")
def over_limit(spark, d):
    return stats.over_limit(docs_of(spark, d).select((F.size(T.words(T.text_or_empty("text"))) + 2).alias("n")))


@register(f"SELECT round(sum(length(text)) / sum(len({Q.words('text')})), 6) AS chars_per_word FROM documents")
def chars_per_word(spark, d):
    return docs_of(spark, d).agg(F.round(F.sum(F.length("text")) / F.sum(F.size(T.words(F.col("text")))), 6).alias("chars_per_word"))


# ---- tokens

_IDS = f"""SELECT doc_id, list_concat([2::BIGINT], list_concat(list_transform({Q.words("coalesce(text, '')")}, lambda w: 16 + {Q.portable_hash('w')} % 31984), [3::BIGINT])) AS ids FROM documents"""
_STREAM = f"""SELECT id, row_number() OVER (ORDER BY doc_id, k) - 1 AS pos FROM (SELECT doc_id, unnest(ids) AS id, unnest(range(len(ids))) AS k FROM ({_IDS}))"""


def token_table(spark, d):
    return docs_of(spark, d).select("doc_id", tokens.word_ids(T.text_or_empty("text")).alias("ids"))


@register(f"SELECT doc_id, len(ids) AS n, coalesce(sum(len(ids)) OVER (ORDER BY doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM ({_IDS})")
def token_offsets(spark, d):
    return tokens.offsets(token_table(spark, d)).select("doc_id", F.size("ids").alias("n"), "start")


@register(f"SELECT (pos // 512)::BIGINT AS example, sum(id)::BIGINT AS total, arg_min(id, pos) AS first_id, arg_max(id, pos) AS last_id FROM ({_STREAM}) GROUP BY 1 HAVING count(*) = 512")
def token_windows(spark, d):
    w = tokens.windows(token_table(spark, d), 512)
    return w.select("example", F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.element_at("ids", 1).alias("first_id"), F.element_at("ids", -1).alias("last_id"))


@register(f"""WITH s AS ({_STREAM}), n AS (SELECT count(*) AS n FROM s), e AS (SELECT unnest(range((n - 512) // 384 + 1)) AS example FROM n WHERE n >= 512)
SELECT example, sum(id)::BIGINT AS total, count(*) AS n FROM e JOIN s ON pos >= example * 384 AND pos < example * 384 + 512 GROUP BY example""")
def token_windows_overlapping(spark, d):
    w = tokens.windows(token_table(spark, d), 512, 384)
    return w.select("example", F.aggregate("ids", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("total"), F.size("ids").alias("n"))


@register(f"""SELECT count(*) AS n_docs, sum(len(ids))::BIGINT AS n_tokens, min(list_min(ids)) AS min_id, max(list_max(ids)) AS max_id, sum(len(list_filter(ids, lambda i: i = 2)))::BIGINT AS n_bos,
sum(len(list_filter(ids, lambda i: i = 3)))::BIGINT AS n_eos, bool_and(ids[1] = 2 AND ids[-1] = 3) AS framed FROM ({_IDS})""")
def token_stream_checks(spark, d):
    return tokens.stream_stats(token_table(spark, d))


@register(f"SELECT id, count(*) AS n FROM (SELECT unnest(ids) AS id FROM ({_IDS})) GROUP BY id ORDER BY n DESC, id LIMIT 50")
def token_frequency(spark, d):
    return tokens.top_tokens(token_table(spark, d))


@register(f"SELECT count(*) AS n_eos, round((max(pos) - min(pos)) / (count(*) - 1), 6) AS mean_gap FROM ({_STREAM}) WHERE id = 3")
def eos_gap(spark, d):
    return tokens.eos_gap(token_table(spark, d)).select("n_eos", F.round("mean_gap", 6).alias("mean_gap"))


@register(f"SELECT round(sum(octet_length(encode(text))) / sum(len({Q.words('text')})), 6) AS fertility FROM documents")
def byte_fertility(spark, d):
    return tokens.fertility(docs_of(spark, d), F.octet_length("text")).select(F.round("fertility", 6).alias("fertility"))


@register("SELECT CASE WHEN regexp_matches(token, '^\\p{L}+$') THEN 'letters' WHEN regexp_matches(token, '^\\p{N}+$') THEN 'digits' ELSE 'other' END AS class, count(*) AS types, sum(n)::BIGINT AS occurrences FROM (SELECT token, count(*) AS n FROM (SELECT unnest(regexp_extract_all(coalesce(text, ''), '\\p{L}+|\\p{N}+|[^\\p{L}\\p{N}\\s]+')) AS token FROM documents) GROUP BY token) GROUP BY 1")
def vocabulary_classes(spark, d):
    c = tokens.word_counts(docs_of(spark, d))
    kind = F.when(F.col("token").rlike(r"^\p{L}+$"), "letters").when(F.col("token").rlike(r"^\p{N}+$"), "digits").otherwise("other")
    return c.groupBy(kind.alias("class")).agg(F.count("*").alias("types"), F.sum("n").alias("occurrences"))


@register()
def bpe_merges(spark, d):
    found = tokens.merges(tokens.word_counts(docs_of(spark, d)), 5)
    return spark.createDataFrame([(i, a, b) for i, (a, b) in enumerate(found)], "step long, a string, b string")


@register(f"""SELECT doc_id, md5(array_to_string(list_transform(ids, lambda i: lpad(format('{{:X}}', i % 256), 2, '0') || lpad(format('{{:X}}', i // 256), 2, '0')), '')) AS data FROM ({_IDS})""")
def uint16_bytes(spark, d):
    return sinks.uint16(token_table(spark, d)).select("doc_id", F.md5(F.hex("data")).alias("data"))


# ---- conversations and pairs

_CONV = f"""SELECT conv_id, list_concat([{{'role': 'system', 'content': coalesce(first_system, '{chat.SYSTEM}')}}], list_filter(t, lambda x: x.role IN ('user', 'assistant'))) AS conv, hole FROM (
SELECT conv_id, min_by(c, turn) FILTER (r = 'system' AND c <> '') AS first_system, list({{'role': r, 'content': c}} ORDER BY turn) AS t, bool_or(c = '' AND r IS DISTINCT FROM 'system') AS hole FROM (
SELECT conv_id, turn, CASE WHEN lower(role) IN ('human', 'user') THEN 'user' WHEN lower(role) IN ('gpt', 'assistant') THEN 'assistant' WHEN lower(role) = 'system' THEN 'system' END AS r, {Q.strip("coalesce(text, '')")} AS c FROM conversations) GROUP BY conv_id)"""


@register(f"""SELECT conv_id, len(conv) AS n, NOT hole AND len(conv) >= 2 AND conv[-1].role = 'assistant' AS valid, md5(array_to_string(list_transform(conv, lambda m: '<|' || m.role || '|>' || chr(10) || m.content || chr(10) || '<|end|>' || chr(10)), '')) AS rendered FROM ({_CONV})""")
def chat_conversations(spark, d):
    c = chat.conversations(table(spark, d, "conversations"))
    return c.select("conv_id", F.size("conversations").alias("n"), "valid", F.md5(chat.render(F.col("conversations"))).alias("rendered"))


@register(f"""SELECT conv_id, md5(q) AS question, md5(a) AS chosen, length(a) - length(b) AS diff, n + greatest(na, nb) + 16 <= 2048 AS fits FROM (
SELECT conv_id, array_to_string(list_transform(list_filter(conv[:-2], lambda m: m.role = 'user'), lambda m: m.content), chr(10) || chr(10)) AS q, conv[-1].content AS a, conv[-1].content[1:40] AS b,
len({Q.words('conv[1].content')}) + len({Q.words("array_to_string(list_transform(list_filter(conv[:-2], lambda m: m.role = 'user'), lambda m: m.content), chr(10) || chr(10))")}) AS n, len({Q.words('conv[-1].content')}) AS na, len({Q.words(Q.strip('conv[-1].content[1:40]'))}) AS nb
FROM ({_CONV}) WHERE NOT hole AND len(conv) >= 2 AND conv[-1].role = 'assistant') WHERE q <> '' AND a <> {Q.strip('b')}""".replace("length(a) - length(b)", f"length(a) - length({Q.strip('b')})"))
def preference_pairs(spark, d):
    p = chat.within_length(chat.message_pairs(pair_source(spark, d)))
    return p.select("conv_id", F.md5(F.element_at("prompt", 2)["content"]).alias("question"), F.md5(F.col("chosen")[0]["content"]).alias("chosen"), (F.length(F.col("chosen")[0]["content"]) - F.length(F.col("rejected")[0]["content"])).alias("diff"), "fits")


def pair_source(spark, d):
    c = chat.conversations(table(spark, d, "conversations")).where("valid")
    short = F.struct(F.lit("assistant").alias("role"), F.substring(F.element_at("conversations", -1)["content"], 1, 40).alias("content"))
    return c.select("conv_id", F.col("conversations").alias("chosen"), F.concat(F.slice("conversations", 1, F.size("conversations") - 1), F.array(short)).alias("rejected"))


@register(f"""SELECT conv_id, len(t) AS n_turns, md5(t[-1]) AS answer FROM (SELECT conv_id, list_filter(list_transform(regexp_split_to_array(s, '\\n\\nHuman: |\\n\\nAssistant: '), lambda x: {Q.strip('x')}), lambda x: x <> '') AS t FROM (
SELECT conv_id, string_agg(chr(10) || chr(10) || CASE WHEN role = 'assistant' THEN 'Assistant: ' ELSE 'Human: ' END || text, '' ORDER BY turn) AS s FROM conversations WHERE role <> 'system' GROUP BY conv_id))""")
def transcript_turns(spark, d):
    rows = table(spark, d, "conversations").where("role <> 'system'")
    mark = F.when(F.col("role") == "assistant", "Assistant: ").otherwise("Human: ")
    text = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", F.concat(F.lit("\n\n"), mark, F.col("text")).alias("x")))).alias("l"))
    t = text.select("conv_id", chat.transcript(F.array_join(F.transform("l", lambda x: x["x"]), "")).alias("t"))
    return t.select("conv_id", F.size("t").alias("n_turns"), F.md5(F.element_at("t", -1)).alias("answer"))


@register("SELECT op, count(*) AS n, sum(answer)::BIGINT AS total, min(prompt) AS first_prompt FROM (SELECT *, replace(['What is {expr}?', 'Answer only the result: {expr}', 'Compute {expr}.', 'What does {expr} equal?', 'Give the answer to {expr}.', 'Return only the number: {expr}'][i % 6 + 1], '{expr}', expr) AS prompt FROM (SELECT op, expr, answer, row_number() OVER (PARTITION BY op ORDER BY x, y) - 1 AS i FROM (SELECT '+' AS op, a AS x, b AS y, a || ' + ' || b AS expr, a + b AS answer FROM range(1, 31) t(a), range(1, 31) u(b) UNION ALL SELECT '-', a, b, a || ' - ' || b, a - b FROM range(2, 41) t(a), range(1, 21) u(b) WHERE b <= a UNION ALL SELECT '*', a, b, a || ' * ' || b, a * b FROM range(2, 16) t(a), range(2, 16) u(b) UNION ALL SELECT '/', b, a, (a * b) || ' / ' || b, a FROM range(2, 16) t(b), range(1, 21) u(a)))) GROUP BY op")
def arithmetic_problems(spark, d):
    return chat.arithmetic_problems(spark).groupBy("op").agg(F.count("*").alias("n"), F.sum("answer").alias("total"), F.min("prompt").alias("first_prompt"))


@register("SELECT copy, count(*) AS n FROM (SELECT item_id FROM benchmark), range(1, 21) r(copy) GROUP BY copy")
def replicated(spark, d):
    return chat.replicate(table(spark, d, "benchmark").select("item_id")).groupBy("copy").agg(F.count("*").alias("n"))


@register("SELECT item_id, replace(template, '{q}', text) AS prompt FROM benchmark, (VALUES ('{q}'), ('Answer briefly: {q}'), ('Just answer: {q}')) t(template)")
def prompt_templates(spark, d):
    q = table(spark, d, "benchmark").select("item_id", F.col("text").alias("q"))
    return chat.cross(q, spark.createDataFrame([("{q}",), ("Answer briefly: {q}",), ("Just answer: {q}",)], "template string"))


CODE_ROWS = [
    (1, "Write a function to add.", "```python\ndef add(a, b):\n    return a + b\n```"),
    (2, "Explain what this does: def f(x)", "The function returns its argument and adds one to it, nothing else."),
    (3, "Explain the code", "def f(x):\n    y = 1;\n    return x\n"),
    (4, "Fix the bug", "def g(x):\n    return x + 1  # was x - 1"),
    (5, "Complete the function body", "x = 1\nfor i in range(3):\n    x += i\nreturn x"),
    (6, "Do something", "This code is good because it is short and needs nothing further."),
    (7, "", "def x(): return 1"),
    (8, "Say hello", ""),
    (9, "Say hello", "Hello there, this is just some plain prose text."),
    (10, "Generate code", "text before\n```js\nlet a = 1;\n```\nand\n```js\nlet bb = 22;\nlet c = 3;\n```"),
]


@register()
def code_sft(spark, d):
    return chat.code_pairs(spark.createDataFrame(CODE_ROWS, "row_id long, instruction string, solution string")).drop("instruction", "solution")


# ---- pages, scalar functions, runs


@register(f"SELECT page_id, url, split_part(regexp_extract(url, '://([^/]*)', 1), '.', 1) AS site, md5(t) AS text_md5, length(t) AS n_chars FROM (SELECT page_id, url, {Q.html_to_text(f'''regexp_replace(html, '(?is){records.PAGE_NOISE}', '', 'g')''')} AS t FROM pages) WHERE length(t) >= 300")
def pages_to_text(spark, d):
    return records.pages(table(spark, d, "pages")).select("page_id", "url", "site", F.md5("text").alias("text_md5"), F.length("text").alias("n_chars"))


# ---- source formatters, over raw columns made of the tables

_STRIPPED = Q.strip("coalesce(text, '')")


def raw_docs(spark, d):
    """The documents as raw rows of several sources: text, url, titles, a subset, metadata as JSON."""
    i = F.col("doc_id")
    return docs_of(spark, d).select(
        F.concat(F.lit("  "), "text", F.lit("\n")).alias("text"), i.alias("id"), F.concat(F.lit("http://"), "source", F.lit(".org/"), i).alias("url"), F.when(i % 3 > 0, F.lit("CC-1")).alias("dump"), F.col("lang").alias("language"),
        F.concat(F.lit("T"), i).alias("title"), F.concat(F.lit("B"), i).alias("short_book_title"), (1800 + i % 100).alias("publication_date"), F.element_at(F.array(*map(F.lit, ("s2orc/train", "s2ag", "other/x"))), (i % 3 + 1).cast("int")).alias("source"),
        F.when(i % 4 == 0, "not json").when(i % 4 == 1, F.lit('{"subdomain": "math"}')).when(i % 4 == 2, F.lit('{"extraction_info": {"subdomain": "algebra"}}')).alias("metadata"), F.lit("2020-01-01").alias("date"),
    )


@register(f"SELECT md5(t) AS text, 'fineweb' AS source, 'http://' || source || '.org/' || doc_id AS url, CASE WHEN doc_id % 3 > 0 THEN 'CC-1' ELSE '' END AS dump, coalesce(lang, '') AS language FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE length(t) >= 200")
def source_web(spark, d):
    return records.web(raw_docs(spark, d)).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'wikipedia' AS source, 'T' || doc_id AS title, 'http://' || source || '.org/' || doc_id AS url FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE length(t) >= 1000")
def source_encyclopedia(spark, d):
    return records.encyclopedia(raw_docs(spark, d)).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'pg19' AS source, 'B' || doc_id AS title, (1800 + doc_id % 100)::VARCHAR AS publication_date, 'http://' || source || '.org/' || doc_id AS url FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE length(t) >= 10000")
def source_books(spark, d):
    return records.books(raw_docs(spark, d)).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'pes2o' AS source, doc_id::VARCHAR AS paper_id, CASE doc_id % 3 WHEN 0 THEN 's2orc' ELSE 's2ag' END AS subset FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE doc_id % 3 < 2 AND length(t) >= 500")
def source_papers(spark, d):
    return records.papers(raw_docs(spark, d)).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'open_web_math' AS source, 'http://' || source || '.org/' || doc_id AS url, '2020-01-01' AS date, CASE doc_id % 4 WHEN 1 THEN 'math' WHEN 2 THEN 'algebra' ELSE '' END AS subdomain FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE length(t) >= 200")
def source_math_pages(spark, d):
    return records.math_pages(raw_docs(spark, d)).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'jupyter' AS source, 'r' || doc_id AS repo FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE length(t) >= 500")
def source_notebooks(spark, d):
    i = F.col("doc_id")
    raw = docs_of(spark, d).select(F.when(i % 2 == 0, F.col("text")).otherwise("").alias("text"), F.col("text").alias("content"), F.concat(F.lit("r"), i).alias("repo_name"))
    return records.notebooks(raw).withColumn("text", F.md5("text"))


@register(f"SELECT md5(t) AS text, 'stack_v1' AS source, lang AS language, source AS repo, 'p' || doc_id AS path FROM (SELECT *, {_STRIPPED} AS t FROM documents) WHERE lang IN ('en', 'fr') AND length(t) >= 50")
def source_code_files(spark, d):
    raw = docs_of(spark, d).select(F.col("text").alias("content"), F.col("lang").alias("language"), F.lit("").alias("max_stars_repo_name"), F.col("source").alias("repository_name"), F.concat(F.lit("p"), "doc_id").alias("max_stars_repo_path"), F.lit(None).cast("string").alias("path"))
    return records.code_files(raw, languages=("en", "fr")).withColumn("text", F.md5("text"))


@register(f"""SELECT md5('# ' || replace(i, chr(10), chr(10) || '# ') || chr(10) || s) AS text, 'conala' AS source, 'python' AS language, item_id::VARCHAR AS question_id
FROM (SELECT item_id, {Q.strip("text || chr(10) || 'second line ' || item_id")} AS i, {Q.strip("'x = ' || item_id || ' * 1000000'")} AS s FROM benchmark) WHERE length(i) >= 10 AND length(s) >= 10""")
def source_intents(spark, d):
    i = F.col("item_id").cast("string")
    raw = table(spark, d, "benchmark").select(F.when(F.col("item_id") % 2 == 0, F.lit("")).otherwise(F.concat("text", F.lit("\nsecond line "), i)).alias("rewritten_intent"), F.concat("text", F.lit("\nsecond line "), i).alias("intent"), F.concat(F.lit("x = "), i, F.lit(" * 1000000")).alias("snippet"), i.alias("question_id"))
    return records.intents(raw).withColumn("text", F.md5("text"))


@register(f"""SELECT 'Q: ' || md5(q) || ' A: ' || md5(a) AS text, 'stackexchange' AS source, 'math' AS site, id::VARCHAR AS question_id FROM (SELECT conv_id AS id, {Q.strip("max(text) FILTER (role = 'user')")} AS q, {Q.strip("arg_max(text, (turn % 5 + 1, -turn)) FILTER (role = 'assistant')")} AS a
FROM conversations GROUP BY conv_id) WHERE q <> '' AND a <> '' AND length(q) + length(a) + 8 >= 200""")
def source_question_answers(spark, d):
    rows = table(spark, d, "conversations")
    answer = F.struct("turn", F.struct(F.col("text").alias("text"), (F.col("turn") % 5 + 1).cast("string").alias("pm_score")).alias("a"))
    raw = rows.groupBy(F.col("conv_id").alias("qid")).agg(F.max(F.when(F.col("role") == "user", F.col("text"))).alias("question"), F.array_sort(F.collect_list(F.when(F.col("role") == "assistant", answer))).alias("l"))
    raw = raw.select("qid", "question", F.transform("l", lambda x: x["a"]).alias("answers"), F.array(F.lit("https://math.stackexchange.com/q/1")).alias("metadata"))
    out = records.question_answers(raw)
    parts = F.split(F.substring("text", 4, 1 << 30), "\n\nA: ")
    return out.withColumn("text", F.concat(F.lit("Q: "), F.md5(F.get(parts, F.lit(0))), F.lit(" A: "), F.md5(F.get(parts, F.lit(1)))))


@register("SELECT event_type, count(*) AS n, sum(try_cast(json_extract_string(props, '$.k') AS BIGINT))::BIGINT AS total FROM events GROUP BY event_type")
def json_fields(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.sum(F.get_json_object("props", "$.k").try_cast("bigint")).alias("total"))


@register("SELECT count(*) AS lines, count(*) FILTER (event_id % 10 = 3) AS parse_errors FROM events")
def jsonl_faults(spark, d):
    lines = table(spark, d, "events").select(F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("{"), F.col("props"))).otherwise(F.col("props")).alias("value"))
    return records.parse_faults(lines, "k bigint")


@register(f"""WITH w AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT doc_id, {Q.words("coalesce(text, '')")} AS w FROM documents)),
g AS (SELECT doc_id, w, i - row_number() OVER (PARTITION BY doc_id, w ORDER BY i) AS g FROM w)
SELECT doc_id, coalesce(max(n), 0)::BIGINT AS run FROM documents LEFT JOIN (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id, w, g) USING (doc_id) GROUP BY doc_id""")
def longest_word_run(spark, d):
    return docs_of(spark, d).select("doc_id", T.longest_run(T.words(T.text_or_empty("text"))).alias("run"))


@register("SELECT user_id, event_id, round(avg(value) OVER w, 6) AS moving FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 9 PRECEDING AND CURRENT ROW) QUALIFY count(*) OVER w = 10")
def moving_average(spark, d):
    return stats.moving_average(table(spark, d, "events"), "user_id", ("ts", "event_id"), "value", 10)


@register("SELECT user_id, max(ts) AS last_ts, max_by(event_id, (ts, event_id)) AS last_event FROM events GROUP BY user_id")
def latest_event(spark, d):
    return table(spark, d, "events").groupBy("user_id").agg(F.max("ts").alias("last_ts"), F.max_by("event_id", F.struct("ts", "event_id")).alias("last_event"))


@register("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n, round(sum(value), 3) AS value FROM events GROUP BY 1, 2")
def windowed_events(spark, d):
    return streaming.windowed_counts(table(spark, d, "events")).select("start", "event_type", "n", F.round("value", 3).alias("value"))


@register("SELECT p_partkey AS part, '[' || p_name || '](http://x/' || p_partkey || ')' AS link FROM part")
def markdown_links(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("part"), T.markdown_link(F.col("p_name"), F.concat(F.lit("http://x/"), F.col("p_partkey").cast("string"))).alias("link"))


_UNITS, _TENS = str(T.UNITS), str(T.TENS)
_U100 = f"CASE WHEN r < 20 THEN ({_UNITS})[r + 1] WHEN r % 10 = 0 THEN ({_TENS})[r // 10 + 1] ELSE ({_TENS})[r // 10 + 1] || '-' || ({_UNITS})[r % 10 + 1] END"


@register(f"SELECT n, CASE WHEN n < 100 THEN w WHEN r = 0 THEN ({_UNITS})[n // 100 + 1] || ' hundred' ELSE ({_UNITS})[n // 100 + 1] || ' hundred and ' || w END AS words FROM (SELECT n, n % 100 AS r, {_U100.replace('r ', '(n % 100) ').replace('[r', '[(n % 100)')} AS w FROM range(1000) t(n))")
def number_words(spark, d):
    return spark.range(1000).select(F.col("id").alias("n"), T.number_words(F.col("id")).alias("words"))


@register()
def synthetic_arithmetic(spark, d):
    return records.arithmetic(spark, 50)


# ---- evaluation


@register(f"""WITH w AS (SELECT doc_id, unnest(w) AS w, unnest(range(len(w))) AS i FROM (SELECT doc_id, regexp_extract_all(lower(text), '[{T.WORD_CHARS}]+') AS w FROM documents)),
g AS (SELECT doc_id, w, i - row_number() OVER (PARTITION BY doc_id, w ORDER BY i) AS g FROM w), r AS (SELECT doc_id, max(n) AS run FROM (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id, w, g) GROUP BY doc_id)
SELECT category, count(*) AS cases, count(*) FILTER (n = 0) AS passed FROM (SELECT CASE doc_id % 3 WHEN 0 THEN 'simple_factual' WHEN 1 THEN 'stop_behavior' ELSE 'concept' END AS category, (CASE WHEN NOT contains(lower(text), 'the') THEN 1 ELSE 0 END)
+ (CASE WHEN contains(lower(text), 'idiot') THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 3 < 2 AND len({Q.words("text")}) > 35 THEN 1 ELSE 0 END) + (CASE WHEN coalesce(run, 0) >= 6 THEN 1 ELSE 0 END) AS n FROM documents LEFT JOIN r USING (doc_id)) GROUP BY category""")
def behaviour_pass_rate(spark, d):
    docs = docs_of(spark, d)
    category = F.when(F.col("doc_id") % 3 == 0, "simple_factual").when(F.col("doc_id") % 3 == 1, "stop_behavior").otherwise("concept")
    cases = docs.select(F.col("doc_id").alias("id"), category.alias("category"), F.col("text").alias("output"), F.array(F.lit("the")).alias("must_contain"), F.array().cast("array<string>").alias("must_contain_any"), F.array(F.lit("idiot")).alias("must_not_contain"))
    return stats.pass_rate(stats.behaviour(cases))


@register("SELECT model, round(max(v) FILTER (event_type = 'click'), 6) AS click, round(max(v) FILTER (event_type = 'view'), 6) AS view, round(max(v) FILTER (event_type = 'click') - max(b) FILTER (event_type = 'click'), 6) AS click_delta FROM (SELECT *, max(v) FILTER (model = 'm0') OVER (PARTITION BY event_type) AS b FROM (SELECT 'm' || (user_id % 4) AS model, event_type, avg(value) AS v FROM events GROUP BY 1, 2)) GROUP BY model")
def eval_pivot(spark, d):
    scores = table(spark, d, "events").select(F.concat(F.lit("m"), (F.col("user_id") % 4).cast("string")).alias("model"), F.col("event_type").alias("task"), "value")
    return stats.eval_pivot(scores, ["click", "view"], "m0").select("model", "click", "view", "click_delta")


@register("SELECT * FROM (VALUES ('a', 0.6::DOUBLE), ('b', 0.4::DOUBLE), ('c', 0.3::DOUBLE), ('d', NULL)) t(task, score)")
def metric_resolution(spark, d):
    rows = spark.createDataFrame([("a", {"acc,none": 0.5, "acc_norm,none": 0.6}), ("b", {"acc": 0.4}), ("c", {"em,x": 0.3, "em_stderr,x": 0.1}), ("d", {})], "task string, results map<string,double>")
    return rows.select("task", stats.resolve_metric(F.col("results"), ("acc_norm", "acc", "em")).alias("score"))


# ---- whole plans, set operations, streams


@register(f"""WITH v AS (SELECT doc_id, source, t FROM ({Q.verdict()}) WHERE reason IS NULL), e AS (SELECT source, row_number() OVER (PARTITION BY {Q.exact_hash('t')} ORDER BY {Q.RANK}, doc_id) AS r FROM v)
SELECT source, (SELECT count(*) FROM documents x WHERE x.source = e.source) AS raw, count(*) AS filtered, count(*) FILTER (r = 1) AS deduped FROM e GROUP BY source""")
def curation_funnel(spark, d):
    return curation.funnel(docs_of(spark, d))


_CURATED = f"""WITH q AS (SELECT doc_id, source, text FROM documents JOIN (SELECT doc_id, reason FROM ({Q.verdict()})) USING (doc_id) WHERE reason IS NULL),
rest AS (SELECT * FROM q WHERE doc_id IN (SELECT doc_id FROM ({Q.EXACT.replace('FROM documents', 'FROM q')}) WHERE kept)), near AS (SELECT doc_id FROM ({fuzzy_sql('rest')}) WHERE kept),
own AS (SELECT doc_id, source, length(coalesce(text, ''))::BIGINT AS chars FROM rest WHERE doc_id IN (SELECT doc_id FROM near)),
chosen AS (SELECT doc_id FROM ({_BLEND.replace(_CHARS, 'SELECT doc_id, source, chars FROM own')}) WHERE kept OR overflow)
SELECT d.doc_id, d.source, s.split FROM documents d JOIN ({Q.split_sql('chosen', 'doc_id', '42', 0.005, 1)}) s USING (doc_id)"""


@register(_CURATED)
def curated_corpus(spark, d):
    return curation.curate(docs_of(spark, d), aims(spark), "src0").select("doc_id", "source", "split")


@register(f"SELECT 'only_curated' AS part, count(*) AS n FROM (SELECT doc_id FROM ({Q.EXACT}) WHERE kept EXCEPT SELECT doc_id FROM ({_MANUAL}) WHERE reason IS NULL) UNION ALL SELECT 'both', count(*) FROM (SELECT doc_id FROM ({Q.EXACT}) WHERE kept INTERSECT SELECT doc_id FROM ({_MANUAL}) WHERE reason IS NULL)")
def corpus_set_difference(spark, d):
    docs = docs_of(spark, d)
    a, b = dedup.exact_survivors(docs).where("kept").select("doc_id"), validate.validate(docs).where("reason is null").select("doc_id")
    n = lambda df, name: df.agg(F.count("*").alias("n")).select(F.lit(name).alias("part"), "n")
    return n(a.subtract(b), "only_curated").unionByName(n(a.intersect(b), "both"))


@register("SELECT kind, count(*) AS n, sum(length(text))::BIGINT AS chars FROM (SELECT 'documents' AS kind, text FROM documents UNION ALL SELECT 'conversations', text FROM conversations UNION ALL SELECT 'benchmark', text FROM benchmark) GROUP BY kind")
def union_of_tables(spark, d):
    parts = [table(spark, d, n).withColumn("kind", F.lit(n)).select("kind", "text", F.lit(i).alias(f"only_{n}")) for i, n in enumerate(("documents", "conversations", "benchmark"))]
    whole = parts[0].unionByName(parts[1], allowMissingColumns=True).unionByName(parts[2], allowMissingColumns=True)
    return whole.groupBy("kind").agg(F.count("*").alias("n"), F.sum(F.length("text")).alias("chars"))


@register(f"SELECT hash, min(doc_id) AS doc_id FROM ({Q.EXACT}) GROUP BY hash")
def streaming_dedup(spark, d):
    return curation.stream_dedup(spark, f"{d}/documents.parquet")


@register(f"""WITH g AS (SELECT DISTINCT unnest({Q.ngrams('w', 13)}) AS g FROM (SELECT {Q.words(Q.normalize('text'))} AS w FROM benchmark)), d AS (SELECT doc_id, unnest({Q.ngrams('w', 13)}) AS g FROM (SELECT doc_id, {Q.words(Q.normalize("coalesce(text, '')"))} AS w FROM documents))
SELECT doc_id, count(DISTINCT g) AS shared FROM d SEMI JOIN g USING (g) GROUP BY doc_id""")
def benchmark_overlap(spark, d):
    return stats.overlap(docs_of(spark, d), table(spark, d, "benchmark"))


