"""A training corpus from raw documents: language, quality, near-duplicates, secrets, packing.

Each stage takes whole texts of any length, rows that repeat, and columns of any names beside doc_id, text, lang and
source; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from wirelark.llm import language, packing, quality, secrets, simhash
from wirelark.shared import removed, settled
from wirelark.shipping import ship


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is determined; the others go. Columns as they came.

    Null and empty texts and texts without a letter go; if no row has a language and a text to learn from, all go. Of
    two languages with equal shares the first by name counts; rows that repeat stay or go alike.
    """
    return language.identified(docs)


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep, without the lines over the limit. Columns as they came.

    Null, empty and short texts go; a null source is the empty one. Copies count as one document and share a verdict;
    a line exactly at its limit stays. n_chars, where there is one, is counted anew if lines went.
    """
    return quality.cleaned(docs)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates, the one with the smallest doc_id. Columns as they came.

    Null and empty texts are one group. Rows without a doc_id all stay. Of rows that repeat a doc_id the one with the
    least text, then the least row as JSON, stays.
    """
    return simhash.deduplicated(docs)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by a mark. Columns as they came.

    Null texts stay null; rows that repeat stay; n_chars, where there is one, is counted anew if a secret went.
    """
    return secrets.redacted(docs, secrets.train(secrets.labelled_samples(spark)))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 4096 tokens.

    A null or empty text is its end id alone; rows that repeat are packed each on its own; of pieces that fit equally
    well the earliest is placed first.
    """
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("quality", good_quality),
    ("near_duplicates", one_of_each),
    ("secrets", without_secrets),
    ("packing", packed),
]
#: SQL can express neither the mixture nor the packing.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; what a stage stored on the way goes when its result is written."""
    docs, path = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    ship(spark)
    for name, stage in STAGES[:-1]:
        before, given = path, docs
        docs, path = settled(spark, f"pipeline-{name}", lambda: stage(spark, given, sf_dir))
        if before:
            removed(spark, before)
    return STAGES[-1][1](spark, docs, sf_dir)
