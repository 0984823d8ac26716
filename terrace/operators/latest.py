"""One row per key.

Every function filters ``row_number() = 1`` directly above its window, the
shape for which Spark keeps one row per key in each map task before the
shuffle. A key that holds a large share of the table therefore reaches its
reducer as at most one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def best_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key under ``order``; give a total order for a repeatable result."""
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The latest row of each key, NULL times last; ties fall to the highest remaining columns."""
    if tiebreak is None:
        tiebreak = [c for c in df.columns if c not in keys and c != order_by]
    order = [F.col(f"`{c}`").desc_nulls_last() for c in [order_by, *tiebreak]]
    return best_per_key(df, [f"`{k}`" for k in keys], order)


def current_assignment(
    df: DataFrame,
    keys: Sequence[str],
    end: str,
    start: str,
    tiebreak: Sequence[str] | None = None,
) -> DataFrame:
    """The most recently started of each key's open (``end`` is NULL) records."""
    return dedupe_latest(df.filter(F.col(end).isNull()), keys, start, tiebreak)


def duplicate_keys(df: DataFrame, keys: Sequence[str], count: str = "n_rows") -> DataFrame:
    """Keys held by more than one row, with their row counts."""
    return df.groupBy(*keys).agg(F.count("*").alias(count)).filter(F.col(count) > 1)


def preview(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first ``n`` rows in a stated order; each task keeps at most ``n`` of its rows."""
    return df.orderBy(*order).limit(n)
