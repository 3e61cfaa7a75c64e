"""A corpus pipeline of five stages, each on all that its predecessor kept.

Language ID drops what it rejects; the n-gram join keeps one document of each group of near duplicates (five words, 0.8); decontamination
drops documents that hold a window of a test item; the secret scan replaces secrets in the texts; packing cuts the rest into
sequences. Rows that share a doc_id are one document to the second stage. Null texts are rejected by the first stage, so an
input without any text gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from siteconcord.llm import decontaminate, language, ngram_join, secret_scan
from siteconcord.llm.batches import byte_batches
from siteconcord.llm.common import table
from siteconcord.llm.queries import pack
from siteconcord.session import materialized

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = language.fit(docs.filter(~language.held_out()))
    return language.keep_identified(docs.select(*COLUMNS), model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs.select(*COLUMNS), k=5, percent=80)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_scan.redact(docs.select(*COLUMNS))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return pack(docs)


STAGES = [
    ("language_id", identify_language),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]

# Language ID, the packing and the spans of secrets have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    # One session runs all stages: what an executor once took for large batches of whole texts it would hold through the later ones.
    with byte_batches(spark):
        for name, stage in STAGES:
            docs = materialized(stage(spark, docs, sf_dir), name)
    return docs
