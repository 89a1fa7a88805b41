"""From raw documents to packed training sequences: five stages, each by one corpus operator.

Every stage works on what its predecessor kept, is written as Parquet to the folder that driver and executors share, and is
read again by the next. All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelcraft.llm import langid_kn, packing, semicrf, simhash_gray, ssk_svm
from panelcraft.llm.common import shared_table


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the string-kernel machine scores at its threshold or above go."""
    machine = ssk_svm.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return ssk_svm.keep_clean(docs, machine)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or unlike every language that the labels know, go."""
    return langid_kn.keep_identified(docs, langid_kn.fit(docs.select("doc_id", "text", "lang")))


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays, that of the smallest id."""
    return simhash_gray.keep_one(docs)


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Spans of personal data become their kind in brackets; n_chars follows the text."""
    return semicrf.redact(docs, semicrf.fit(docs)).withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))


def sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The place of every piece of every document in sequences of 1024 tokens."""
    return packing.pack(docs)


STAGES = [("toxicity", toxicity), ("language", language), ("near_copies", near_copies), ("personal_data", personal_data),
          ("packing", sequences)]

#: Fitted models and tokenizers are beyond SQL; the stages are tested against brute force and planted cases.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = shared_table(stage(spark, docs, sf_dir), name)
    return docs


QUERIES = {"pipeline": run}
ORACLES = {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}
