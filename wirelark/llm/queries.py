"""One query for each operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, capfilters, language, licenses, packing, quality, ranking, secrets, simhash, suffixes, tokenfiles, toxicity, whitening


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(_table(spark, sf_dir, "documents"))


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(_table(spark, sf_dir, "documents"))


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.predictions(_table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def packing_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Operator 5 under its three limits at once, over whole conversations."""
    return packing.pack_conversations(_table(spark, sf_dir, "conversations"))


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digests(_table(spark, sf_dir, "documents"), secrets.train(secrets.labelled_samples(spark)))


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfiles.written(_table(spark, sf_dir, "documents"))


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return capfilters.near_duplicates(_table(spark, sf_dir, "embeddings"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.predictions(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.licensed(_table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.searched(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op12_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.digests(_table(spark, sf_dir, "documents"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_bpe, op3_simhash, op4_language, op5_packing, op6_secrets, op7_token_files, op8_embeddings,
        op9_toxicity, op10_licenses, op11_ranked_search, op12_suffix_dedup, op13_whitening, packing_conversations,
    )
}
ORACLES: dict[str, str] = {"op1_quality_rules": quality.ORACLE, "op8_embeddings": capfilters.ORACLE, "op11_ranked_search": ranking.ORACLE, "op12_suffix_dedup": suffixes.ORACLE}
