"""Checks that return the rows breaking a rule; an empty result passes."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import moment, packed, unpacked
from ..operators.latest import duplicate_keys

FAR_FUTURE = "9999-12-31 00:00:00"


def scoped(df: DataFrame, where: str | Column | None) -> DataFrame:
    """Restrict a check to some rows."""
    return df if where is None else df.filter(where)


# --- conditions that are true on a violating row -------------------------------


def is_missing(col: str) -> Column:
    return F.col(f"`{col}`").isNull()


def is_unaccepted(col: str, values: Sequence) -> Column:
    """NULL passes; values are compared as text so that untyped tables work too."""
    return ~F.col(f"`{col}`").cast("string").isin([str(v) for v in values])


def is_outside(col: str, low=None, high=None) -> Column:
    """Outside [low, high]; either end may be open and NULL passes."""
    c = F.col(f"`{col}`")
    tests = ([c < F.lit(low)] if low is not None else []) + ([c > F.lit(high)] if high is not None else [])
    if not tests:
        raise ValueError("give at least one bound")
    return tests[0] if len(tests) == 1 else tests[0] | tests[1]


def is_unmatched(col: str, pattern: str) -> Column:
    return ~F.col(f"`{col}`").cast("string").rlike(pattern)


def is_untrue(expression: str, column: str | None = None) -> Column:
    """The expression (prefixed by ``column`` if given) is false; NULL passes."""
    return ~F.expr(f"{column} {expression}" if column else expression)


# --- row-local checks ------------------------------------------------------------


def not_null(df: DataFrame, col: str, where=None) -> DataFrame:
    return scoped(df, where).filter(is_missing(col))


def accepted_values(df: DataFrame, col: str, values: Sequence, where=None) -> DataFrame:
    return scoped(df, where).filter(is_unaccepted(col, values))


def value_between(df: DataFrame, col: str, low=None, high=None, where=None) -> DataFrame:
    return scoped(df, where).filter(is_outside(col, low, high))


def matches_regex(df: DataFrame, col: str, pattern: str, where=None) -> DataFrame:
    return scoped(df, where).filter(is_unmatched(col, pattern))


def expression_is_true(df: DataFrame, expression: str, column: str | None = None, where=None) -> DataFrame:
    return scoped(df, where).filter(is_untrue(expression, column))


# --- checks over keys ------------------------------------------------------------


def unique(df: DataFrame, col: str, where=None) -> DataFrame:
    """Values held by more than one row; NULLs are ignored."""
    kept = scoped(df, where).filter(F.col(f"`{col}`").isNotNull())
    if not isinstance(df.schema[col].dataType, T.StringType):
        return duplicate_keys(kept, [f"`{col}`"])
    held = duplicate_keys(kept.select(packed(F.col(f"`{col}`")).alias(col)), [f"`{col}`"])
    return held.withColumn(col, unpacked(F.col(f"`{col}`")))


def unique_combination(df: DataFrame, cols: Sequence[str], where=None) -> DataFrame:
    """Combinations held by more than one row; NULL counts as a value."""
    return duplicate_keys(scoped(df, where), [f"`{c}`" for c in cols])


def relationships(df: DataFrame, col: str, parent: DataFrame, parent_col: str, where=None) -> DataFrame:
    """Rows whose non-NULL key is absent from the parent."""
    child = scoped(df, where).filter(F.col(f"`{col}`").isNotNull())
    keys = parent.select(F.col(f"`{parent_col}`").alias("_parent_key"))
    return child.join(keys, F.col(f"`{col}`") == F.col("_parent_key"), "left_anti")


def orphan_keys(df: DataFrame, col: str, parent: DataFrame, parent_col: str, where=None) -> DataFrame:
    """The keys behind ``relationships`` with their row counts.

    Child rows are counted per key before the join, so one frequent key meets
    the parent as a single row.
    """
    child = scoped(df, where).filter(F.col(f"`{col}`").isNotNull())
    key, parent_key = F.col(f"`{col}`"), F.col(f"`{parent_col}`")
    both_text = all(isinstance(t.schema[c].dataType, T.StringType) for t, c in ((df, col), (parent, parent_col)))
    if both_text:
        key, parent_key = packed(key), packed(parent_key)
    counted = child.groupBy(key.alias("orphan_key")).agg(F.count("*").alias("n_rows"))
    orphans = counted.join(parent.select(parent_key.alias("_parent_key")), F.col("orphan_key") == F.col("_parent_key"), "left_anti")
    return orphans.withColumn("orphan_key", unpacked("orphan_key")) if both_text else orphans


def scd2_overlaps(
    df: DataFrame,
    key: str,
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    where="is_unknown = false",
) -> DataFrame:
    """Versions that start before an earlier version of the same key has ended.

    One row per (key, start) with the end it runs into, where an open end
    counts as the far future; ``n_versions`` above 1 marks a start used twice.

    Versions are first folded per (key, start). Then the latest earlier end is a
    running maximum inside each day of starts plus the maximum of the days
    before, so no task needs all versions of a key: a day's starts form one
    group and a key contributes one small row per day to the second window.
    """
    starts = (
        scoped(df, where)
        .select(
            F.col(key).alias("business_key"),
            F.col(valid_from).alias("valid_from"),
            F.coalesce(F.col(valid_to), F.lit(FAR_FUTURE).cast(df.schema[valid_to].dataType)).alias("valid_to"),
        )
        .groupBy("business_key", "valid_from")
        .agg(F.max("valid_to").alias("valid_to"), F.count("*").alias("n_versions"))
        .withColumn("_day", F.col("valid_from").cast("date"))
    )
    before = Window.partitionBy("business_key", "_day").orderBy("valid_from").rowsBetween(
        Window.unboundedPreceding, -1
    )
    days_before = Window.partitionBy("business_key").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = (
        starts.groupBy("business_key", "_day")
        .agg(F.max("valid_to").alias("_day_end"))
        .select("business_key", "_day", F.max("_day_end").over(days_before).alias("_carried"))
    )
    return (
        starts.withColumn("_running", F.max("valid_to").over(before))
        .join(carried, ["business_key", "_day"])
        .withColumn("earlier_valid_to", F.greatest("_running", "_carried"))
        .filter((F.col("n_versions") > 1) | (F.col("earlier_valid_to") > F.col("valid_from")))
        .select("business_key", "valid_from", "valid_to", "earlier_valid_to", "n_versions")
    )


# --- checks over tables ----------------------------------------------------------


def negative_overhead(fact: DataFrame) -> DataFrame:
    """Fact rows whose loaded total is below their line total."""
    return fact.filter("line_total_with_overhead < line_total").select(
        "sales_order_line_sk",
        "sales_order_line_bk",
        "line_total",
        "line_total_with_overhead",
        (F.col("line_total_with_overhead") - F.col("line_total")).alias("overhead_delta"),
    )


def reconcile(
    left: DataFrame, left_col: str, right: DataFrame, right_col: str, left_name: str, right_name: str,
    tolerance: str = "0.01",
) -> DataFrame:
    """One row if two totals differ by more than the tolerance."""
    a = left.agg(F.sum(left_col).alias(left_name))
    b = right.agg(F.sum(right_col).alias(right_name))
    gap = F.abs(F.col(left_name) - F.col(right_name))
    return (
        a.crossJoin(F.broadcast(b))
        .withColumn("delta", gap)
        .filter(F.col("delta") > F.lit(tolerance).cast("decimal(10,4)"))
    )


def not_exactly_one(tables: Mapping[str, DataFrame], condition: str) -> DataFrame:
    """Tables where the number of rows meeting ``condition`` is not one."""
    counts = None
    for name, df in tables.items():
        row = df.filter(condition).agg(F.count("*").alias("cnt")).select(F.lit(name).alias("dim_name"), "cnt")
        counts = row if counts is None else counts.unionByName(row)
    return counts.filter("cnt <> 1")


def missing_unknown_member(dimensions: Mapping[str, DataFrame]) -> DataFrame:
    """Versioned dimensions without exactly one open Unknown row."""
    return not_exactly_one(dimensions, "is_unknown = true AND valid_to IS NULL")


def freshness(df: DataFrame, loaded_at: str | Column, as_of, warn_hours: int, error_hours: int) -> DataFrame:
    """One row: newest load time, age in seconds, and pass / warn / error."""
    column = F.col(loaded_at) if isinstance(loaded_at, str) else loaded_at
    newest = df.agg(F.max(column.cast("timestamp")).alias("max_loaded_at"))
    age = F.unix_timestamp(moment(as_of)) - F.unix_timestamp("max_loaded_at")
    status = (
        F.when(F.col("age_seconds").isNull() | (F.col("age_seconds") > error_hours * 3600), "error")
        .when(F.col("age_seconds") > warn_hours * 3600, "warn")
        .otherwise("pass")
    )
    return newest.withColumn("age_seconds", age).withColumn("status", status)
