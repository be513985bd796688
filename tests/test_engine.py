import importlib
import json
import math
import os
import random
import re

import pytest
from pyspark.sql import functions as F

from millrace.functions import code as C
from millrace.functions import text as T
from millrace.operators import blend, chat, dedup, quality, stats, tokens, validate
from millrace.sources import records, sinks

DOCS = "doc_id long, text string, source string"
TEXTS = ["", None, "a b", "x" * 600, "the cat and the dog sat. " * 30, "• a\n• b\n• c", "one...\ntwo...\nthree", "same line here\n" * 6, "İ ² ¼ \x1c é́  NBSP ok\u0085end", "$ # % & * + / < = " * 60]


def frame(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source if isinstance(source, str) else source[i]) for i, t in enumerate(texts)], DOCS)


def py_reason(text, source):
    text = text or ""
    code = source in quality.CODE_SOURCES
    if source not in ("conala", "jupyter") and len(text) < 500:
        return "too_short"
    if source not in ("pg19", "jupyter") and len(text) > 50_000:
        return "too_long"
    lines = [x.strip() for x in text.split("\n") if x.strip()]
    if not lines:
        return "no_lines"
    if sum(x[0] in "•-*·–—▪◦" for x in lines) / len(lines) > 0.9:
        return "high_bullet_ratio"
    if sum(x.endswith("...") for x in lines) / len(lines) > 0.3:
        return "high_ellipsis_ratio"
    if len(lines) >= 4 and (len(lines) - len(set(lines))) / len(lines) > 0.2:
        return "high_repeated_lines"
    if code:
        return None
    w = text.split()
    mean = sum(map(len, w)) / len(w)
    if mean < 3:
        return "mean_word_too_short"
    if mean > 10:
        return "mean_word_too_long"
    if len(re.findall(quality.SYMBOLS, text)) / len(w) > 0.08:
        return "high_symbol_ratio"
    if sum(c.isalpha() for c in text) / len(text) < 0.75:
        return "low_alpha_ratio"
    if len(re.findall("|".join(quality.BOILERPLATE), text, re.I)) >= 2:
        return "boilerplate"
    return None if len(set(map(str.lower, w[:100])) & set(quality.STOP_WORDS)) >= 3 else "insufficient_stop_words"


def test_quality_reasons(spark):
    good = "the house of the man and his dog is here in that place for all days " * 10
    texts = TEXTS + [
        good, good[:499], good[:500], "word and the of " * 3200, " " * 600, "\n" * 600, "a b c " * 100, "extraordinarily complicated " * 30, "1234 the of and " * 40,
        good + " cookie policy PRIVACY Policy", good + " cookie policy", "wort " * 120, "- a\n" * 180 + "plain", "wait...\n" * 80 + "z",
    ]
    for source in ("s", "jupyter", "conala", "pg19"):
        got = {r["doc_id"]: r["reason"] for r in quality.verdict(frame(spark, texts, source)).collect()}
        assert [got[i] for i in range(len(texts))] == [py_reason(t, source) for t in texts], source


def test_text_functions_match_python(spark):
    rng = random.Random(1)
    alphabet = "aB é\t\n \x1c_-.²ß日"
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 30))) for _ in range(200)]
    df = frame(spark, texts).select("doc_id", T.strip(F.col("text")).alias("s"), T.words(F.col("text")).alias("w"), T.lines(F.col("text")).alias("l"), T.normalize(F.col("text")).alias("n"), T.ngrams(T.words(F.col("text")), 3).alias("g"))
    for r in df.collect():
        t = texts[r["doc_id"]]
        w = t.split()
        assert (r["s"], r["w"], r["l"]) == (t.strip(), w, [x.strip() for x in t.split("\n") if x.strip()])
        assert r["n"] == re.sub(r"\s+", " ", re.sub(r"[^\w\s]", "", t.lower())).strip()
        assert r["g"] == [" ".join(w[i : i + 3]) for i in range(len(w) - 2)]


def test_number_words_and_runs(spark):
    got = {r["n"]: r["w"] for r in spark.createDataFrame([(n,) for n in (0, 7, 13, 20, 42, 100, 115, 999, 1000, -3)], "n long").select("n", T.number_words(F.col("n")).alias("w")).collect()}
    assert got == {0: "zero", 7: "seven", 13: "thirteen", 20: "twenty", 42: "forty-two", 100: "one hundred", 115: "one hundred and fifteen", 999: "nine hundred and ninety-nine", 1000: "1000", -3: "-3"}
    runs = spark.createDataFrame([([],), (["a"],), (["a", "a", "b", "a", "a", "a"],)], "a array<string>").select(T.longest_run(F.col("a")).alias("r")).collect()
    assert [r["r"] for r in runs] == [0, 1, 3]


def test_exact_dedup_first_wins_and_bypass(spark):
    df = frame(spark, ["Same, text!", "same text", "", None, "other", "same text"], ["src9", "src1", "src2", "src0", "src3", "synthetic_arithmetic"])
    kept = {r["doc_id"] for r in dedup.exact_dedup(df).collect()}
    assert kept == {1, 3, 4, 5}
    assert {r["doc_id"] for r in dedup.exact_dedup(df, ["src9", "src1", "src2", "src0"]).collect()} == {0, 2, 4, 5}


def test_clusters_are_transitive(spark):
    edges = spark.createDataFrame([(1, 2), (3, 2), (3, 4), (9, 8), (8, 9), (5, 5)], "src long, dst long")
    assert {r["doc_id"]: r["cluster"] for r in dedup.clusters(edges).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8}
    assert dedup.clusters(edges.where("src > 100")).collect() == []


def test_fuzzy_keeps_one_of_near_copies_in_a_source(spark):
    base = " ".join(f"w{i}" for i in range(300))
    df = frame(spark, [base, base.replace("w299", "zz"), base, "a b c", base], ["x", "x", "y", "x", "synthetic_arithmetic"])
    got = {r["doc_id"]: r["kept"] for r in dedup.fuzzy_survivors(df).collect()}
    assert got == {0: True, 1: False, 2: True, 3: True, 4: True}


def test_char_targets_and_plan():
    mini = blend.char_targets(1_000_000)
    assert mini == {"common_crawl": 430_000, "fineweb": 1_978_000, "wikipedia": 430_000, "pg19": 107_500, "pes2o": 215_000, "open_web_math": 430_000, "stackexchange": 215_000, "synthetic_arithmetic": 64_500, "stack_v1": 215_000, "codesearchnet": 150_500, "stack_smol": 43_000, "jupyter": 17_200, "conala": 4_300}
    assert blend.char_targets(5_500_000_000)["fineweb"] == 10_879_000_000
    assert blend.crawl_segments(5_500_000_000) == 140 and blend.crawl_segments(1_000_000) == 1
    assert blend.doc_cap("fineweb", "125m") == 18_131_666 and blend.doc_cap("pg19", "125m") == 7390 and blend.doc_cap("conala", "125m") is None
    assert blend.mix_faults() == [] and blend.mix_faults({"a": 50.0}, {}, "b")


def test_cap_keeps_the_crossing_document_and_overflow_fills(spark):
    rows = [(i, "a", 10) for i in range(5)] + [(10 + i, "b", 10) for i in range(9)] + [(30, "c", 0)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, chars long")
    aims = spark.createDataFrame([("a", 100), ("b", 25), ("c", 5), ("gone", 1000)], "source string, target_chars long")
    out = {r["doc_id"]: r for r in blend.blend(docs, aims, "b").collect()}
    assert [out[10 + i]["kept"] for i in range(9)] == [True] * 3 + [False] * 6
    # deficit: a misses 50, c misses 5; the sink gives documents until 55 are made up
    assert [out[10 + i]["overflow"] for i in range(9)] == [False] * 3 + [True] * 6
    assert sum(r["overflow"] for r in blend.blend(docs, aims.where("source <> 'a'"), "b").collect()) == 1


@pytest.mark.parametrize("n", [1, 199, 200, 499, 1000])
def test_split_is_exact(spark, n):
    out = blend.split(spark.range(n).select(F.col("id").alias("doc_id")))
    assert out.where("split = 'val'").count() == max(1, int(n * 0.005)) and out.count() == n


def test_order_statistic_index(spark):
    for n in (1, 10, 57):
        df = spark.range(n).select(F.col("id").cast("double").alias("x"))
        assert validate.order_statistic(df, "x").first()[0] == sorted(range(n))[int(0.9 * n)]


def test_validation_rules(spark):
    texts = ["no end", "ends.\nnot", 'says "x"', "a.\nb\na.\na.\na.", "", "a.\na.\nc.\nd."]
    got = [r["reason"] for r in validate.validate(frame(spark, texts)).orderBy("doc_id").collect()]
    assert got == ["terminal_punct", None, None, "repeated_lines", "terminal_punct", None]
    assert all(r["reason"] is None for r in validate.validate(frame(spark, texts, "conala")).collect())


@pytest.mark.parametrize(("seq", "stride"), [(4, 4), (4, 3), (50, 50), (1, 1), (3, 5)])
def test_windows(spark, seq, stride):
    rng = random.Random(2)
    docs = [(i, [rng.randint(0, 9) for _ in range(rng.randint(0, 9))]) for i in range(9)]
    stream = [x for _, ids in docs for x in ids]
    out = tokens.windows(spark.createDataFrame(docs, "doc_id long, ids array<int>"), seq, stride)
    want = [stream[k : k + seq] for k in range(0, len(stream) - seq + 1, stride)]
    assert [r["ids"] for r in out.orderBy("example").collect()] == want


def test_bpe_merges_and_bytes(spark):
    counts = spark.createDataFrame([("hug", 10), ("pug", 5), ("hugs", 5), ("aaa", 3)], "token string, n long")
    assert tokens.merges(counts, 3)[:2] == [("u", "g"), ("h", "ug")]
    assert spark.createDataFrame([("aé",), ("",)], "t string").select(tokens.byte_ids(F.col("t")).alias("i")).collect()[0]["i"] == [2, 97 + 16, 0xC3 + 16, 0xA9 + 16, 3]


def test_conversations(spark):
    turns = [(1, 0, "system", "S"), (1, 1, "human", "q"), (1, 2, "gpt", "a"), (2, 0, "user", "q"), (2, 1, "assistant", " "), (3, 0, "user", "q"), (3, 1, "tool", "t"), (4, 0, "system", ""), (4, 1, "user", "q"), (4, 2, "assistant", "a")]
    out = {r["conv_id"]: r for r in chat.conversations(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()}
    assert [out[i]["valid"] for i in (1, 2, 3, 4)] == [True, False, False, True]
    assert out[1]["conversations"][0]["content"] == "S" and out[4]["conversations"][0]["content"] == chat.SYSTEM


def test_code_pairs(spark):
    from millrace.plans.catalog import CODE_ROWS

    out = {r["row_id"]: r for r in chat.code_pairs(spark.createDataFrame(CODE_ROWS, "row_id long, instruction string, solution string")).collect()}
    assert [out[i]["sft_type"] for i in (1, 2, 4, 5)] == ["code_generation", "code_explanation", "code_repair", "function_completion"]
    assert [out[i]["reason"] for i in (2, 3, 6, 7, 8, 9)] == [None, "code_explanation_is_code", "prose_only", "missing_instruction", "missing_solution", "no_code_detected"]
    assert out[1]["answer"] == "def add(a, b):\n    return a + b" and out[10]["answer"] == "let bb = 22;\nlet c = 3;"


def test_response_mix_counts(spark):
    base = spark.createDataFrame([(k, i, f"{k}{i}", "x") for k, n in (("a", 5), ("b", 2)) for i in range(n)], "kind string, i long, prompt string, answer string")
    rows = sorted(chat.response_mix(base, ("a", "b"), {"a": 2, "b": 9}, 12).collect(), key=lambda r: r["pos"])
    assert [r["pos"] for r in rows] == list(range(12))
    assert [r["prompt"] for r in rows[:7]] == ["a0", "a1", "b0", "b1", "a2", "a3", "a4"]
    assert [r["kind"] for r in rows[7:]] == ["a", "b", "a", "b", "a"] and rows[7]["variant"] == "direct"


def test_preference_pairs(spark):
    t = "\n\nHuman: hi\n\nAssistant: yes"
    df = spark.createDataFrame([(1, t, t.replace("yes", "no")), (2, t, t), (3, "\n\nHuman: x", t), (4, None, t)], "pair_id long, chosen string, rejected string")
    rows = chat.transcript_pairs(df).collect()
    assert [r["pair_id"] for r in rows] == [1] and [m["role"] for m in rows[0]["prompt"]] == ["system", "user"]
    q = spark.createDataFrame([(1, "", " q ", "a", "b"), (2, "s", "", "a", "b"), (3, "s", "q", "a", " a ")], "q_id long, system string, question string, chosen string, rejected string")
    assert [r["q_id"] for r in chat.question_pairs(q).collect()] == [1]
    kind = "array<struct<role:string,content:string>>"
    m = [(1, [("user", "a"), ("assistant", "b"), ("user", "c"), ("assistant", "x")], [("assistant", "y")]), (2, [("user", "a"), ("user", "b")], [("assistant", "y")])]
    rows = chat.message_pairs(spark.createDataFrame(m, f"m_id long, chosen {kind}, rejected {kind}")).collect()
    assert [r["m_id"] for r in rows] == [1] and rows[0]["prompt"][1]["content"] == "a\n\nc"


def test_sources(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"text": "a"}\nnot json\n{"text": "b"}\n')
    assert [r["text"] for r in records.jsonl(spark, str(path), "text string").collect()] == ["a", "b"]
    with pytest.raises(Exception):
        records.jsonl_strict(spark, str(path), "text string").collect()
    answers = [("5", "<p>five &amp; more</p>"), ("5", "later"), ("-1", "bad"), ("x", "odd")]
    qa = spark.createDataFrame([(7, "<p>" + "why " * 60 + "</p>", answers, ["https://math.stackexchange.com/q/7"]), (8, "q", [("0", "no")], [])], "qid long, question string, answers array<struct<pm_score:string,text:string>>, metadata array<string>")
    rows = records.question_answers(qa).collect()
    assert len(rows) == 1 and rows[0]["site"] == "math" and rows[0]["text"].endswith("A: five & more")
    fn = spark.createDataFrame([("python", 'def f(x):\n    """Adds one to the\n    argument."""\n    return x + 1\n' + "# pad\n" * 20, "Adds one to the argument.", "r", "p")], "language string, func_code_string string, func_documentation_string string, repository_name string, func_path_in_repository string")
    fn = fn.withColumns({"code": F.lit(""), "docstring": F.lit(""), "repo": F.lit(""), "path": F.lit("")})
    text = records.functions_with_docs(fn).first()["text"]
    assert text.startswith("# Adds one to the argument.\ndef f(x):\n") and '"""' not in text
    docs = records.arithmetic(spark, 3).collect()
    assert len(docs) == 3 and docs == records.arithmetic(spark, 3).collect()
    for a, op, b, c in re.findall(r"^(\d+) ([-+*/]) (\d+) = (-?\d+)$", "\n".join(r["text"] for r in docs), re.M):
        assert {"+": int(a) + int(b), "-": int(a) - int(b), "*": int(a) * int(b), "/": int(a) / int(b)}[op] == int(c)


def test_code_files_prune_partitions(spark, tmp_path):
    df = spark.createDataFrame([("python", "x = 1 " * 20, "r", "p"), ("cobol", "y", "r", "p")], "language string, content string, repository_name string, path string").withColumns({"max_stars_repo_name": F.lit(""), "max_stars_repo_path": F.lit("")})
    df.write.partitionBy("language").parquet(str(tmp_path / "t"))
    out = records.code_files(spark.read.parquet(str(tmp_path / "t")))
    assert out.count() == 1 and re.search(r"PartitionFilters: \[[^\]]*language#\d+ IN", out._jdf.queryExecution().toString())


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, [2, 258, 3])], "doc_id long, ids array<int>")
    assert bytes(sinks.uint16(df).first()["data"]) == b"\x02\x00\x02\x01\x03\x00"
    sinks.tokens(df, str(tmp_path / "t"), {"version": 1})
    assert sinks.read_tokens(spark, str(tmp_path / "t"), {"version": 1}).count() == 1
    with pytest.raises(ValueError):
        sinks.read_tokens(spark, str(tmp_path / "t"), {"version": 2})
    sinks.splits(spark.createDataFrame([("train", "a"), ("val", "b")], "split string, text string"), str(tmp_path / "s"))
    assert sorted(x for x in os.listdir(tmp_path / "s") if "=" in x) == ["split=train", "split=val"]


def test_streaming_dedup_is_incremental(spark, tmp_path):
    from millrace.streaming import curation

    src, out, state = (str(tmp_path / x) for x in ("src", "out", "state"))
    schema = "doc_id long, text string"
    spark.createDataFrame([(1, "a b"), (2, "A, b!"), (3, "c")], schema).coalesce(1).write.parquet(src)
    curation.dedup_into(curation.intake(spark, src, schema), out, state).awaitTermination()
    spark.createDataFrame([(4, "C"), (5, "d")], schema).coalesce(1).write.mode("append").parquet(src)
    curation.dedup_into(curation.intake(spark, src, schema), out, state).awaitTermination()
    assert sorted(r["doc_id"] for r in spark.read.parquet(out).collect()) == [1, 3, 5]


def test_behaviour_failures(spark):
    kind = "id string, category string, output string, must_contain array<string>, must_contain_any array<string>, must_not_contain array<string>"
    rows = [("a", "c", "Paris is it", ["paris"], [], []), ("b", "c", " ", ["x"], ["y"], []), ("c", "simple_factual", "w " * 40, [], [], ["W"]), ("d", "c", "no no no no no no", [], [], [])]
    got = {r["id"]: r["failures"] for r in stats.behaviour(spark.createDataFrame(rows, kind)).collect()}
    assert got == {"a": [], "b": ["empty", "missing", "missing_any"], "c": ["forbidden", "too_long", "repeated"], "d": ["repeated"]}


def test_code_predicates(spark):
    rows = [("```python\nx = 1 + 2\n```", True), ("```\nx = 1\n```", False), ("just prose that says nothing much at all", False), ("def f():\n    return 1  # something", True), ("short", False)]
    got = spark.createDataFrame(rows, "t string, w boolean").select(C.looks_like_code(F.col("t")).alias("g"), "w").collect()
    assert all(r["g"] == r["w"] for r in got)


def test_stats_json(spark):
    docs = spark.createDataFrame([(i, "a", 10) for i in range(5)], "doc_id long, source string, chars long")
    aims = spark.createDataFrame([("a", 25)], "source string, target_chars long")
    got = json.loads(blend.stats_json(blend.blend_stats(blend.blend(docs, aims, "a"))).first()[0])
    assert got["total_documents"] == 3 and got["source_mix"]["a"]["chars"] == 30


def test_entry_registers_everything():
    entry = importlib.import_module("__spark_entry__")
    assert len(entry.queries()) >= 80 and set(entry.oracle_sql()) <= set(entry.queries())


def test_perplexity_by_hand(spark):
    out = {r["doc_id"]: r["perplexity"] for r in validate.unigram_perplexity(frame(spark, ["a a b", "", "b"])).collect()}
    p = {"a": 3 / 6, "b": 3 / 6}
    assert out[1] is None and math.isclose(out[0], math.exp(-(2 * math.log(p["a"]) + math.log(p["b"])) / 3))


SAMPLE = ["quality_verdict", "exact_dedup", "blend_overflow", "split_exact", "validate_counters", "source_stats", "token_windows", "chat_conversations", "pages_to_text", "number_words"]


@pytest.mark.skipif(not os.path.isdir("/root/testdata/sf0.001"), reason="no fixture tables here")
@pytest.mark.parametrize("name", SAMPLE)
def test_oracles(spark, name):
    duckdb = pytest.importorskip("duckdb")
    from millrace.plans.catalog import ORACLES, QUERIES

    d = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "conversations", "pages", "events", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS FROM '{d}/{t}.parquet'")
    got = QUERIES[name](spark, d)
    want = con.execute(ORACLES[name])
    names = [c[0] for c in want.description]
    rows = sorted(map(repr, (tuple(r[c] for c in sorted(names)) for r in got.collect())))
    order = [names.index(c) for c in sorted(names)]
    assert rows == sorted(map(repr, (tuple(r[i] for i in order) for r in want.fetchall())))


# ---- null and repeated ids, uneven orders, guards


def test_exact_dedup_with_null_and_repeated_ids(spark):
    from millrace.operators import dedup

    rows = [(None, "src1", "same text here"), (1, "src1", "same text here"), (2, "src0", "Same text, here!"), (None, "src0", "another one"), (None, "src0", "another one"), (3, "src2", "third"), (3, "src2", "third"), (3, "src2", "fourth"), (4, None, "third")]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = sorted(map(tuple, dedup.exact_dedup(docs).collect()), key=str)
    assert got == sorted([(2, "src0", "Same text, here!"), (None, "src0", "another one"), (3, "src2", "fourth"), (4, None, "third")], key=str)
    assert dedup.exact_survivors(docs).where("kept").count() == 4 and dedup.exact_survivors(docs).count() == len(rows)
    assert dedup.exact_dedup(docs.limit(0)).collect() == []
    assert dedup.fuzzy_survivors(docs).where("kept").count() == len(rows)  # too short for a signature


def test_removed_rows_and_kept_ones_make_the_whole(spark):
    from millrace.operators import dedup

    words = [f"word{i}" for i in range(120)]
    near = [*words[:119], "other"]
    rows = [(1, "a", " ".join(words)), (2, "a", " ".join(near)), (3, "b", " ".join(words).upper()), (4, "b", " ".join(words[::-1]))]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    out = {(r["doc_id"], r["stage"]) for r in dedup.removed(docs).collect()}
    assert out == {(3, "exact"), (2, "near")}
    assert sorted(r["doc_id"] for r in dedup.dedup(docs).collect()) == [1, 4]


def test_running_sums_of_uneven_ids(spark):
    import random

    from millrace.operators import blend

    rng = random.Random(1)
    ids = sorted({int(10 ** rng.uniform(0, 17)) for _ in range(700)})
    rows = [(i, "ab"[k % 2], rng.randint(0, 9)) for k, i in enumerate(ids)]
    got = {r["i"]: r["sum"] for r in blend.running(spark.createDataFrame(rows, "i long, k string, v long"), ["k"], "i", "v", "sum").collect()}
    for key in "ab":
        total = 0
        for i, k, v in rows:
            if k == key:
                assert got[i] == total
                total += v


def test_split_has_exactly_as_many(spark):
    from millrace.operators import blend, chat

    for n in (1, 199, 500, 1500):
        docs = spark.range(n).withColumnRenamed("id", "doc_id")
        count = lambda df: df.where("split = 'val'").count()
        assert count(blend.split(docs, fraction=0.05)) == max(1, int(n * 0.05))
        assert count(blend.split(docs, rule=chat.n_val_code)) == min(max(500, int(n * 0.05)), max(1, n - 1))
        assert count(blend.split(docs, rule=chat.n_val_chat)) == min(n, max(1000, int(n * 0.02)))
        assert count(blend.split(docs, rule=chat.n_val_pairs)) == (max(1, int(n * 0.05)) if n < 500 else max(500, int(n * 0.05)))


def test_encode_guards_ids_and_manifest_refuses_stale_tokens(spark, tmp_path):
    from millrace.operators import tokens
    from millrace.sources import sinks

    docs = spark.createDataFrame([(1, "ab"), (2, None)], "doc_id long, text string")
    encoder = lambda: lambda texts: [[ord(c) for c in t] for t in texts]
    out = tokens.encode(docs, encoder)
    assert {r["doc_id"]: r["ids"] for r in out.collect()} == {1: [2, 97, 98, 3], 2: [2, 3]}
    with pytest.raises(Exception, match="exceeds 90"):
        tokens.encode(docs, encoder, max_id=90).collect()
    vocabulary = tmp_path / "vocabulary.json"
    vocabulary.write_text("{}")
    made = sinks.fingerprint(spark, str(vocabulary))
    sinks.tokens(out, str(tmp_path / "t"), {"tokenizer": made})
    assert sinks.read_tokens(spark, str(tmp_path / "t"), {"tokenizer": made, "n_docs": 2, "n_tokens": 6, "max_id": 98, "dtype": "uint16"}).count() == 2
    vocabulary.write_text("{1}")
    with pytest.raises(ValueError, match="stale"):
        sinks.read_tokens(spark, str(tmp_path / "t"), {"tokenizer": sinks.fingerprint(spark, str(vocabulary))})


def test_texts_of_any_type(spark):
    from millrace.operators import chat

    df = spark.createDataFrame([("a", ["b", "c"], [("user", "x"), ("assistant", None)]), (None, [], [])], "s string, l array<string>, m array<struct<role:string,content:string>>")
    assert [tuple(r) for r in df.select(*(chat.text_of(df, c) for c in "slm")).collect()] == [("a", "c", ""), ("", "", "")]


def test_interleave_takes_groups_in_turn(spark):
    from millrace.operators import chat

    df = spark.createDataFrame([(g, i) for g in "ba" for i in range(2)], "g string, i long")
    got = sorted((r["pos"], r["g"], r["i"]) for r in chat.interleave(df, F.col("g")).collect())
    assert got == [(0, "a", 0), (1, "b", 0), (2, "a", 1), (3, "b", 1)]


def test_language_labels(spark):
    from millrace.operators import validate

    df = spark.createDataFrame([("en", 0.7), ("en", 0.6), ("de", 0.9), (None, None)], "l string, s double")
    assert [r[0] for r in df.select(validate.language_ok(F.col("l"), F.col("s"))).collect()] == [True, False, False, True]


def test_no_local_scratch_on_a_cluster():
    from millrace.operators import dedup

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        conf, sparkContext = Conf(), Context()

    class Frame:
        sparkSession = Session()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        dedup.cut(Frame())


def test_repetition_without_a_shuffle_of_ngrams(spark, monkeypatch):
    import itertools
    from collections import Counter

    from millrace.operators import validate

    texts = ["", None, "a", "a b", "a b a b a b", "one two three one two three four", "x " * 200, "é 日本 é 日本 é", "a b c d e f"]
    rows = [*enumerate(texts), (None, "a b a b"), (50, "p q r"), (50, "p q r s"), (51, "a b a b"), (51, "c")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")

    def top(of: list, n: int) -> float:
        counts = Counter(" ".join(w[i : i + n]) for w in (t.split() for t in of) for i in range(len(w) - n + 1))
        most = {}
        for t in of:
            for w in [t.split()]:
                for i in range(len(w) - n + 1):
                    g = " ".join(w[i : i + n])
                    most[g] = max(most.get(g, 0), len(t))
        return max((len(g) * k / most[g] for g, k in counts.items() if k > 1), default=0.0)

    for few in (validate.FEW_IDS, 0):
        monkeypatch.setattr(validate, "FEW_IDS", few)
        got = sorted((repr(r["doc_id"]), *(round(r[f"top_{n}"], 9) for n in (2, 3, 4))) for r in validate.repetition(docs).collect())
        by_id = {i: [t or "" for j, t in rows if j == i] for i, _ in rows}
        want = sorted((repr(i), *(0.0 if i is None else round(top(by_id[i], n), 9) for n in (2, 3, 4))) for i, _ in rows)
        assert got == want
    single = validate.repetition(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))
    assert "Exchange" not in single._jdf.queryExecution().executedPlan().toString()
