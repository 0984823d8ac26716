"""The training-data pipeline: classify, deduplicate, decontaminate, mix and shard documents.

Every stage takes (spark, docs, sf_dir), works on all that its predecessor kept, and
is written as Parquet and reread before the next. All but the last return the columns
of their input; rows that repeat a doc_id are kept or dropped together.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import decontaminate, mixing, near_dedup, quality, sharding
from terrace.llm.common import saved, table

QUALITY_FROM = 0.3
SHARDS = 16


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep what the line field, fitted to the labelled documents among the input, scores at 0.3 or more."""
    field = quality.fit_quality(docs, table(spark, sf_dir, "labels"), quality.training_rows())
    return docs.where(quality.quality_column(field, F.col("text")) >= QUALITY_FROM)


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest doc_id of each near-duplicate group."""
    found = near_dedup.near_duplicates(docs).where("kept").select(F.col("doc_id").alias("__kept")).distinct()
    return docs.join(found, docs["doc_id"].eqNullSafe(found["__kept"]), "left_semi")


def decontaminate_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a window of a benchmark item."""
    return decontaminate.decontaminated(docs, table(spark, sf_dir, "benchmark"), remove="documents")


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents so that sources meet their targets."""
    return mixing.mix_rows(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row's shard and slot on the Hilbert order."""
    return sharding.hilbert_shards(docs, shards=SHARDS)


STAGES = [
    ("quality classifier", classify),
    ("near-duplicates", deduplicate),
    ("benchmark decontamination", decontaminate_documents),
    ("source mixing", mix),
    ("sharding", shard),
]

# Learned scores and hashes of Spark's own have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
