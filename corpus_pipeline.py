"""Documents to packed training sequences: toxicity, quality, near-duplicates, packing."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from lodgetrail.llm import packing, quality, simhash, toxicity
from lodgetrail.llm.tables import table
from lodgetrail.sources import scratch


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.clean_documents(docs, table(spark, sf_dir, "labels"))


def of_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.one_of_each(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # The stages share their workers, and what these keep adds up.
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), kept=48 << 20)


STAGES = [
    ("toxicity", without_toxic),
    ("quality", of_quality),
    ("near_duplicates", without_near_duplicates),
    ("packing", packed),
]

#: The classifiers and the tokenizer cannot be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch.fresh_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
