"""Dimension-building operators: unknown member, junk dimension, date dimension, bridge count."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import day_attributes
from ..functions.columns import UNKNOWN_KEY, UNKNOWN_LABEL, UNKNOWN_SK, surrogate_key


def with_unknown_member(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Append one row typed like ``df``: ``values`` where given, NULL elsewhere."""
    stray = set(values) - set(df.columns)
    if stray:
        raise ValueError(f"unknown member sets absent columns: {sorted(stray)}")
    member = df.sparkSession.range(1).select(
        *[F.lit(values.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(member)


def unknown_version(sk: str, key: str, labels: Sequence[str] = (), **extra) -> dict[str, object]:
    """Values of the Unknown row of a versioned dimension."""
    return {
        sk: UNKNOWN_SK,
        key: UNKNOWN_KEY,
        **{c: UNKNOWN_LABEL for c in labels},
        **extra,
        "valid_from": "1900-01-01 00:00:00",
        "is_current": True,
        "is_unknown": True,
    }


def flag_combinations(df: DataFrame, defaults: Mapping[str, object]) -> DataFrame:
    """Distinct combinations of low-cardinality columns, NULLs replaced first."""
    return df.select(*[F.coalesce(F.col(c), F.lit(d)).alias(c) for c, d in defaults.items()]).distinct()


def junk_dimension(combinations: DataFrame, sk: str, unknown: Mapping[str, object]) -> DataFrame:
    """Hash key per combination plus the Unknown row."""
    keyed = combinations.select(
        surrogate_key(*combinations.columns).alias(sk), *combinations.columns, F.lit(False).alias("is_unknown")
    )
    return with_unknown_member(keyed, {sk: UNKNOWN_SK, **unknown, "is_unknown": True})


def junk_lookup(df: DataFrame, junk: DataFrame, sk: str, columns: Sequence[str]) -> DataFrame:
    """Add the junk key by plain equality of all columns; a NULL on either side misses."""
    right = junk.select(F.col(sk), *[F.col(c).alias(f"_junk_{c}") for c in columns])
    condition = F.lit(True)
    for c in columns:
        condition = condition & (F.col(c) == F.col(f"_junk_{c}"))
    joined = df.join(right, condition, "left").drop(*[f"_junk_{c}" for c in columns])
    return joined.withColumn(sk, F.coalesce(F.col(sk), F.lit(UNKNOWN_SK)))


def date_dimension(df: DataFrame, dates: Sequence[str], fiscal_start_month: int = 7) -> DataFrame:
    """One row per day of every calendar year touched by ``dates``, plus the Unknown row.

    One aggregate pass finds both ends; the days come from a sequence on that
    single row, so the size depends on the years covered and not on the rows.
    """
    earliest = F.least(*[F.col(c) for c in dates]) if len(dates) > 1 else F.col(dates[0])
    latest = F.greatest(*[F.col(c) for c in dates]) if len(dates) > 1 else F.col(dates[0])
    ends = df.agg(F.min(earliest).cast("date").alias("lo"), F.max(latest).cast("date").alias("hi"))
    last_day = F.date_add(F.add_months(F.trunc("hi", "year"), 12), -1)
    days = ends.select(F.explode(F.sequence(F.trunc("lo", "year"), last_day)).alias("day"))
    calendar = days.select(
        *[c.alias(name) for name, c in day_attributes(F.col("day"), fiscal_start_month).items()]
    )
    return with_unknown_member(calendar, {"date_sk": UNKNOWN_KEY, "is_unknown": True})


def with_bridge_count(df: DataFrame, bridge: DataFrame, key: str, name: str) -> DataFrame:
    """Number of bridge rows per key, 0 where there are none."""
    counts = bridge.groupBy(F.col(key).alias("_bridge_key")).agg(F.count("*").alias(name))
    joined = df.join(counts, F.col(key) == F.col("_bridge_key"), "left").drop("_bridge_key")
    return joined.withColumn(name, F.coalesce(F.col(name), F.lit(0).cast("bigint")))
