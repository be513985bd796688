"""Further registered queries: splits, budgets, reports and checks, each with its DuckDB statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.operators import blend, chat, response_tables, stats, tokens, validate
from millrace.plans import catalog as C
from millrace.plans import sql as Q
from millrace.sources import sinks

register, table, docs_of = C.register, C.table, C.docs_of


# ---- splits of chat, code and preference data

_CONVS = "(SELECT conv_id AS doc_id FROM conversations GROUP BY conv_id)"


def _split_sql(n: str) -> str:
    return f"SELECT count(*) FILTER (r <= n_val) AS val, count(*) FILTER (r > n_val) AS train FROM (SELECT row_number() OVER (ORDER BY md5('42:' || doc_id), doc_id) AS r, {n} AS n_val FROM {_CONVS})"


def _split_of(spark, d, n_val):
    rows = table(spark, d, "conversations").select(F.col("conv_id").alias("doc_id")).distinct()
    out = blend.split(rows, rule=n_val)
    return out.agg(F.count_if(F.col("split") == "val").alias("val"), F.count_if(F.col("split") == "train").alias("train"))


@register(_split_sql("least(count(*) OVER (), greatest(1000, floor(count(*) OVER () * 0.02::DOUBLE)))"))
def chat_split(spark, d):
    return _split_of(spark, d, chat.n_val_chat)


@register(_split_sql("least(greatest(500, floor(count(*) OVER () * 0.05::DOUBLE)), greatest(1, count(*) OVER () - 1))"))
def code_split(spark, d):
    return _split_of(spark, d, chat.n_val_code)


@register(_split_sql("CASE WHEN count(*) OVER () < 500 THEN greatest(1, floor(count(*) OVER () * 0.05::DOUBLE)) ELSE greatest(500, floor(count(*) OVER () * 0.05::DOUBLE)) END"))
def preference_split(spark, d):
    return _split_of(spark, d, chat.n_val_pairs)


# ---- tokens


@register(f"""SELECT n_tokens, examples, examples * 512 AS training_tokens, round(examples * 512 / greatest(n_tokens, 1), 6) AS utilization, (greatest(4 * 512, n_tokens // 512 * 512 // 100) // 512 * 512)::BIGINT AS eval_tokens
FROM (SELECT n AS n_tokens, CASE WHEN n >= 512 THEN (n - 512) // 384 + 1 ELSE 0 END AS examples FROM (SELECT sum(len(ids))::BIGINT AS n FROM ({C._IDS})))""")
def token_budget(spark, d):
    return tokens.token_budget(C.token_table(spark, d), 512, 384)


@register("SELECT * FROM (VALUES ('<|user|>', 5::BIGINT, 6::BIGINT), ('<|assistant|>', 6, 5), ('<|endofcontext|>', 15, NULL)) t(token, expected, id)")
def special_ids(spark, d):
    swapped = [(t, {5: 6, 6: 5}.get(i, i)) for i, t in enumerate(tokens.SPECIALS) if i != 15]
    return tokens.misplaced_specials(spark.createDataFrame(swapped, "token string, id long"))


@register(f"SELECT source, round(avg(f), 6) AS fertility FROM (SELECT source, octet_length(encode(text)) / len(w) AS f FROM (SELECT source, text, {Q.words('text')} AS w FROM documents) WHERE len(w) > 10) GROUP BY source")
def fertility_by_source(spark, d):
    return tokens.fertility_by(docs_of(spark, d), F.octet_length("text"))


# ---- validation and reports


@register(f"""SELECT m.doc_id, coalesce(m.reason, CASE WHEN p.perplexity > (SELECT list_sort(list(perplexity))[floor(0.9 * count(*))::BIGINT + 1] FROM ({C._PPL}) WHERE perplexity IS NOT NULL) THEN 'perplexity' END) AS reason
FROM ({C._MANUAL}) m LEFT JOIN ({C._PPL}) p USING (doc_id)""")
def validate_perplexity(spark, d):
    scored = validate.unigram_perplexity(docs_of(spark, d).select("doc_id", "source", "text"))
    threshold = validate.order_statistic(scored, "perplexity").first()["threshold"]  # one number
    return validate.validate(scored, threshold).select("doc_id", "reason")


@register(f"""WITH m AS ({C._MANUAL}), s AS ({Q.split_sql('(SELECT doc_id FROM documents)', 'doc_id', '42', 0.05, 1)}), c AS (SELECT split, count(*) AS total, count(*) FILTER (reason IS NULL) AS kept,
count(*) FILTER (reason = 'terminal_punct') AS tp, count(*) FILTER (reason = 'repeated_lines') AS rl FROM m JOIN s USING (doc_id) GROUP BY ROLLUP (split)),
j AS (SELECT split, '"total":' || total || ',"kept":' || kept || ',"rejected_terminal_punct":' || tp || ',"rejected_repeated_lines":' || rl || ',"rejected_perplexity":0' AS j FROM c)
SELECT '{{' || (SELECT j FROM j WHERE split IS NULL) || ',"perplexity_threshold":450.5,"splits":{{"train":{{' || (SELECT j FROM j WHERE split = 'train') || '}},"val":{{' || (SELECT j FROM j WHERE split = 'val') || '}}}}}}' AS stats""")
def validation_stats_json(spark, d):
    return validate.stats_json(validate.counters(validate.validate(blend.split(docs_of(spark, d), fraction=0.05))), 450.5)


@register(f"""WITH r AS (SELECT a.source, round(100.0 * target_chars / sum(target_chars) OVER (), 6) AS t, round(coalesce(100.0 * n / sum(n) OVER (), 0), 6) AS z FROM ({C._AIMS}) a LEFT JOIN (SELECT source, sum(chars) AS n FROM ({C._CHARS}) GROUP BY source) USING (source))
SELECT -1::BIGINT AS ord, '| Source | Target share | Realized share |' AS line UNION ALL SELECT 0, '|---|---|---|' UNION ALL SELECT row_number() OVER (ORDER BY source), '| `' || source || '` | ' || printf('%.1f%% | %.2f%% |', t, z) FROM r""")
def mix_markdown(spark, d):
    return stats.mix_markdown(stats.target_vs_realized(C.aims(spark), C.capped_docs(spark, d)))


@register("SELECT source, count(*) AS total, count(*) FILTER (NOT fits) AS dropped, count(*) FILTER (NOT fits) / count(*) AS drop_rate FROM (SELECT 'messages' AS source, fits FROM (" + C.ORACLES["preference_pairs"] + ")) GROUP BY source")
def preference_drop_rates(spark, d):
    return chat.drop_rates(chat.within_length(chat.message_pairs(C.pair_source(spark, d))))


@register("SELECT 'messages' AS source, round(avg(diff), 6) AS mean_diff, round(count(*) FILTER (diff > 0) / count(*), 6) AS chosen_longer FROM (" + C.ORACLES["preference_pairs"] + ")")
def preference_lengths(spark, d):
    p = chat.message_pairs(C.pair_source(spark, d)).withColumn("diff", F.length(F.col("chosen")[0]["content"]) - F.length(F.col("rejected")[0]["content"]))
    return p.groupBy("source").agg(F.round(F.avg("diff"), 6).alias("mean_diff"), F.round(F.count_if(F.col("diff") > 0) / F.count("*"), 6).alias("chosen_longer"))


@register("""SELECT conv_id, md5(coalesce(arg_max(text, turn), '')) AS last_message, md5(arg_max(coalesce(text, ''), turn)) AS last_text, count(*) = 1 AS single FROM conversations GROUP BY conv_id""")
def extract_text(spark, d):
    turns = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("l"))
    whole = turns.select("conv_id", F.transform("l", lambda x: F.struct(x["role"].alias("role"), x["text"].alias("content"))).alias("messages"), F.transform("l", lambda x: x["text"]).alias("texts"), "l")
    return whole.select("conv_id", F.md5(chat.text_of(whole, "messages")).alias("last_message"), F.md5(chat.text_of(whole, "texts")).alias("last_text"), (F.size("l") == 1).alias("single"))


@register("SELECT event_id, strftime(ts, '%Y-%m-%d') AS day, strftime(ts, '%Y%m%dT%H%M%SZ') AS stamp FROM events")
def event_stamps(spark, d):
    return table(spark, d, "events").select("event_id", sinks.date_path(F.col("ts")).alias("day"), sinks.stamp(F.col("ts")).alias("stamp"))


@register("SELECT 'part-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey AS key, l_suppkey AS size FROM lineitem WHERE NOT (l_orderkey % 3 = 0 AND l_suppkey % 2 = 0)")
def missing_files(spark, d):
    """Keys of a listing that a store lacks, or holds with another size."""
    key = F.concat_ws("-", F.lit("part"), "l_orderkey", "l_linenumber", "l_partkey")
    files = table(spark, d, "lineitem").select(key.alias("key"), F.col("l_suppkey").alias("size"), (F.col("l_orderkey") % 3 == 0).alias("held"))
    there = files.where("held").select("key", F.when(F.col("size") % 2 == 0, F.col("size")).otherwise(F.col("size") + 1).alias("size")).distinct()
    return sinks.missing(files.select("key", "size"), there)


@register("SELECT 'k' || p_partkey AS key, CASE WHEN p_size % 3 = 0 THEN p_retailprice ELSE p_size::DOUBLE END AS score FROM part WHERE p_size % 3 < 2")
def benchmark_scores(spark, d):
    part = table(spark, d, "part")
    meta = part.select(F.concat(F.lit("k"), F.col("p_partkey").cast("string")).alias("key"), F.col("p_partkey").alias("task"))
    own = part.where("p_size % 3 = 0").select(F.col("p_partkey").alias("task"), F.col("p_retailprice").alias("score"))
    groups = part.where("p_size % 3 < 2").select(F.col("p_partkey").alias("task"), F.col("p_size").cast("double").alias("score"))
    return stats.benchmark_scores(meta, own, groups)


@register("SELECT step, round(CASE WHEN step < 100 THEN 0.0006::DOUBLE * step / 100 ELSE 0.0006::DOUBLE * 0.5 * (1 + cos(pi() * least(1.0, (step - 100) / 900.0::DOUBLE))) END, 12) AS rate FROM range(1101) t(step)")
def learning_rates(spark, d):
    return spark.range(1101).select(F.col("id").alias("step"), F.round(stats.learning_rate(F.col("id"), 1000, 0.0006, 100), 12).alias("rate"))


@register("SELECT p_partkey AS part, (1 << floor(log2(greatest(1, least(greatest(0, floor((p_retailprice - 100) / (p_size + 1))), 64))))::INT)::BIGINT AS micro FROM part")
def micro_batches(spark, d):
    return table(spark, d, "part").select(F.col("p_partkey").alias("part"), stats.micro_batch(F.col("p_retailprice"), F.lit(100), F.col("p_size") + 1, F.lit(64)).alias("micro"))


# ---- handwritten rows


def _quoted(x: str) -> str:
    return "'" + x.replace("'", "''") + "'"


_R = response_tables
_QUESTIONS = ", ".join(
    [f"('{kind}', 0, {n}, {_quoted(q)}, [{_quoted(a)}])" for kind, own in (("simple_factual", _R.FACTS), ("ai_concept", _R.CONCEPTS), ("concise_answer", _R.CONCISE)) for n, (q, a) in enumerate(own)]
    + [f"('factual_restraint', 0, {n}, {_quoted(q)}, [{', '.join(map(_quoted, _R.RESTRAINED))}])" for n, q in enumerate(_R.PRIVATE)]
    + [f"('factual_restraint', 1, {n}, {_quoted(q)}, [{_quoted(a)}])" for n, (q, a) in enumerate(_R.UNSURE)]
)
_TEMPLATES = ", ".join(f"('{kind}', {k}, {_quoted(t)})" for kind, own in _R.TEMPLATES.items() for k, t in enumerate(own))
_BASE = f"""SELECT kind, row_number() OVER (PARTITION BY kind ORDER BY part, n, k) - 1 AS i, replace(template, '{{q}}', q) AS prompt, answers[(n + k) % len(answers) + 1] AS answer
FROM (VALUES {_QUESTIONS}) a(kind, part, n, q, answers) JOIN (VALUES {_TEMPLATES}) t(kind, k, template) USING (kind) WHERE part = 0 OR k < {_R.UNSURE_TEMPLATES}"""


@register(_BASE)
def response_base(spark, d):
    return response_tables.base(spark)


_RANKS = "(VALUES " + ", ".join(f"('{k}', {r}, {_R.TARGETS[k]})" for r, k in enumerate(_R.ORDER)) + ") r(kind, k, target)"
_PREFIX = "CASE v % 5 " + " ".join(f"WHEN {j} THEN {_quoted(p)}" for j, p in enumerate(chat.VARIANTS.values())) + " END"
_NAME = "CASE v % 5 " + " ".join(f"WHEN {j} THEN {_quoted(n)}" for j, n in enumerate(chat.VARIANTS)) + " END"


@register(f"""WITH b AS ({_BASE}), s AS (SELECT kind, k, target, count(*) AS size FROM b JOIN {_RANKS} USING (kind) GROUP BY ALL), have AS (SELECT sum(size)::BIGINT AS have FROM s),
first AS (SELECT row_number() OVER (ORDER BY i >= target, CASE WHEN i >= target THEN 0 ELSE k END, i, k) - 1 AS pos, kind, prompt, answer, NULL AS variant FROM b JOIN {_RANKS} USING (kind)),
v AS (SELECT v, have FROM have, range(5000) t(v) WHERE v < 5000 - have)
SELECT * FROM first WHERE pos < 5000 UNION ALL SELECT have + v, s.kind, {_PREFIX} || prompt, answer, {_NAME} FROM v JOIN s ON v % 4 = s.k JOIN b ON b.kind = s.kind AND b.i = (have + 2 * v) % size""")
def response_control(spark, d):
    return response_tables.response_control(spark)
