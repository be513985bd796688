"""The registered queries of the training-data operators: one a operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decision_rules, langid, licenses, media, mixing, mixing_sql, ngram_join, packing, pii_crf, substring, wordpiece
from millrace.llm.common import documents


def tokenizer_path() -> str:
    """The vocabulary file of packing and token counts; never copied into the repository."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def piece_model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def op1_crf_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_crf.scan(documents(spark, sf_dir), ["doc_id"])


def op2_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_duplicate_groups(documents(spark, sf_dir))


def op3_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(documents(spark, sf_dir))


def op4_wav_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return media.digest(media.media(documents(spark, sf_dir), ["doc_id"]))


def op5_license_patience(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.matches(documents(spark, sf_dir), ["doc_id"])


def op6_decision_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decision_rules.judge(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet"))


def op7_language_bitmask(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(documents(spark, sf_dir))


def op8_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), tokenizer_path())


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wordpiece.token_counts(documents(spark, sf_dir), piece_model_path(), ["doc_id"])


def op10_fuzzy_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.passages(documents(spark, sf_dir))


QUERIES = {
    f.__name__: f
    for f in (
        op1_crf_pii,
        op2_ngram_jaccard,
        op3_mix_sources,
        op4_wav_fingerprint,
        op5_license_patience,
        op6_decision_list,
        op7_language_bitmask,
        op8_pack_sequences,
        op9_token_counts,
        op10_fuzzy_passages,
    )
}

ORACLES = {"op3_mix_sources": mixing_sql.MIX}
