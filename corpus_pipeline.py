"""Training corpus pipeline: five stages over ``documents``, each a Parquet table for the next.

Every stage takes (spark, docs, sf_dir); all but the last return the columns of documents.  Null and empty texts,
repeated rows, empty tables and further columns are handled as the called operators say.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plume.llm import decontam, langid, mixing, pii, simhash
from plume.llm.common import table, written


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a recognisable language; a missing ``lang`` becomes the predicted one."""
    found = langid.identify(docs, langid.learned(docs), out=("__lang", "__score"))
    lang = F.coalesce("lang", F.col("__lang").cast(docs.schema["lang"].dataType))
    return found.where(F.col("__lang") != langid.UND).withColumn("lang", lang).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each SimHash group: the one with the smallest id, null ids last."""
    return simhash.one_each(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents contaminated by the benchmark."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def private_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data in the texts by its kind."""
    return pii.redact(docs)


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the documents that the mix takes, with their size, target and number of copies."""
    return mixing.mixed(docs)


STAGES = [("language_id", language_id), ("near_dedup", near_dedup), ("decontamination", decontamination),
          ("pii", private_data), ("source_mix", source_mix)]

#: Two stages have no SQL form (rank-order profiles, SimHash groups); the tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
