"""Bounded training samples of labelled documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import hash01


def fold(id_column: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo ``folds``; a null id counts as empty text."""
    return F.pmod(F.crc32(F.encode(F.coalesce(id_column.cast("string"), F.lit("")), "UTF-8")), F.lit(folds))


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, keep: Column, limit: int, id_column: str = "doc_id", text_column: str = "text", seed: int = 11
) -> DataFrame:
    """Up to ``limit`` rows (id, text, label) of the labelled rows that ``keep`` admits.

    The labels that come first by a seeded hash of the id are taken, so the sample is
    the same in every run and of bounded size; null labels and ids are left out. The
    ids of the sample are broadcast: ``limit`` bounds them. Of rows that repeat an id
    the text with the smallest hash is taken, in a partial aggregate of every map task.
    """
    chosen = labels.where(keep & F.col(label).isNotNull() & F.col(id_column).isNotNull())
    chosen = chosen.select(F.col(id_column).alias("id"), F.col(label).cast("int").alias("label")).distinct()
    chosen = chosen.orderBy(hash01(F.lit(seed), F.col("id")), "id", "label").limit(limit)
    rows = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(chosen), "id")
    first = F.min_by("text", F.struct(F.xxhash64("text"), F.md5("text")))
    return rows.groupBy("id", "label").agg(first.alias("text")).select("id", "text", "label")
