"""The registered queries of this folder: each applies one operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontaminate, fill_in_middle, langid, lm_scoring, merkle, metric_tree, minhash, mixing, oracle, phrase_dedup, quality_rules, secret_scan, token_counts, toxicity


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(_table(spark, sf_dir, "documents"))


def op2_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_token_counts(spark: SparkSession, sf_dir: str, model: str | None = None) -> DataFrame:
    if model is None:
        import public_tokenizers

        model = str(public_tokenizers.path("piece_bpe_32k.model"))
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), model)


def op5_phrase_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup.digest(_table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op7_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score(_table(spark, sf_dir, "documents"))


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.secrets(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language(_table(spark, sf_dir, "documents"))


def op11_metric_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metric_tree.nearest(_table(spark, sf_dir, "embeddings"))


def op12_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.digest(_table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_in_middle.digest(_table(spark, sf_dir, "documents"))


def queries() -> dict:
    return {f.__name__: f for f in (op1_quality_rules, op2_minhash, op3_toxicity, op4_token_counts, op5_phrase_dedup, op6_mixing, op7_lm_scores, op8_secrets, op9_decontamination, op10_language, op11_metric_tree, op12_merkle, op13_fill_in_middle)}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
