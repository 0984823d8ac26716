"""Point-in-time lookup and joins that survive hot keys.

Plain joins carry no hint: Catalyst and adaptive execution broadcast a side
only below ``autoBroadcastJoinThreshold`` and otherwise shuffle both sides and
split skewed partitions. ``hot`` adds an explicit split of the keys that hold
a large share of the left side.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hot_keys(df: DataFrame, key: str, share: float) -> DataFrame:
    """Keys with at least ``share`` of all rows, as column ``hot_key``.

    At most ``1 / share`` keys can qualify, so the result is safe to broadcast
    at any input size.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    total = df.agg(F.count("*").alias("n")).scalar()
    return (
        df.filter(F.col(key).isNotNull())
        .groupBy(F.col(key).alias("hot_key"))
        .agg(F.count("*").alias("_n"))
        .filter(F.col("_n") >= total * F.lit(share))
        .select("hot_key")
    )


def heavy_hitters(df: DataFrame, keys: Sequence[str], share: float) -> dict[str, list]:
    """For each of ``keys`` the values (None included) with about ``share`` of all rows or more, in one pass.

    Every task keeps a mergeable sketch per key, so nothing is shuffled by key and the
    driver gets at most ``1 / share`` values per key. The sketches may miss or add
    values near ``share``; joins give the same rows whatever is listed.
    """
    if not 0 < share <= 1:
        raise ValueError("share must be in (0, 1]")
    wanted = math.ceil(1 / share)
    tracked = min(1_000_000, max(1024, 8 * wanted))
    sketches = [F.expr(f"approx_top_k(`{key}`, {wanted}, {tracked})").alias(f"k{i}") for i, key in enumerate(keys)]
    found = df.agg(F.count(F.lit(1)).alias("n"), *sketches).first()
    least = max(1, found["n"] * share)
    return {key: [v["item"] for v in found[f"k{i}"] or [] if v["count"] >= least] for i, key in enumerate(keys)}


def in_list(key: str, values: Sequence) -> Column:
    """Whether the key is one of ``values``; None lists NULL keys."""
    some = [v for v in values if v is not None]
    listed = F.coalesce(F.col(key).isin(some), F.lit(False)) if some else F.lit(False)
    return listed | F.col(key).isNull() if len(some) < len(values) else listed


def spread_slot(is_hot: Column, spread_by: Sequence[str], salts: int) -> Column:
    """Slot 0, or one of ``salts`` slots where ``is_hot``."""
    spread = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in spread_by]), F.lit(salts)).cast("int")
    return F.when(is_hot, spread).otherwise(F.lit(0))


def repeated_slots(is_hot: Column, salts: int) -> Column:
    return F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))


def left_join(
    left: DataFrame,
    right: DataFrame,
    left_key: str,
    right_key: str,
    residual: Column | None = None,
    hot: DataFrame | Sequence | None = None,
    salts: int = 32,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Left equi-join with an optional residual; ``right_key`` is dropped.

    ``hot`` lists keys to split, as values (from ``heavy_hitters``) or as a table (from
    ``hot_keys``): their left rows are spread over ``salts`` slots by a hash of
    ``spread_by`` (default all columns) and the matching right rows, only those, are
    repeated per slot. Rows with a NULL key match nothing; they are spread the same way
    where ``hot`` is a table or lists None.
    """
    condition = F.col(left_key) == F.col(right_key)
    if residual is not None:
        condition = condition & residual
    if hot is None or (not isinstance(hot, DataFrame) and not hot):
        return left.join(right, condition, "left").drop(right_key)

    if isinstance(hot, DataFrame):
        hot = F.broadcast(hot)
        left = left.join(hot, F.col(left_key) == F.col("hot_key"), "left")
        right = right.join(hot, F.col(right_key) == F.col("hot_key"), "left")
        on_left, on_right = F.col("hot_key").isNotNull() | F.col(left_key).isNull(), F.col("hot_key").isNotNull()
    else:
        on_left, on_right = in_list(left_key, hot), in_list(right_key, [v for v in hot if v is not None])
    salted_left = left.withColumn("_slot", spread_slot(on_left, spread_by or [c for c in left.columns if c != "hot_key"], salts)).drop("hot_key")
    salted_right = right.withColumn("_right_slot", F.explode(repeated_slots(on_right, salts))).drop("hot_key")
    condition = condition & (F.col("_slot") == F.col("_right_slot"))
    return salted_left.join(salted_right, condition, "left").drop(right_key, "_slot", "_right_slot")


def point_in_time_join(
    facts: DataFrame,
    versions: DataFrame,
    fact_key: str,
    version_key: str,
    at: str,
    take: Mapping[str, str],
    valid_from: str = "valid_from",
    valid_to: str = "valid_to",
    hot: DataFrame | Sequence | None = None,
    salts: int = 32,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Add the columns of the version valid at ``at``: from <= at < to, open end allowed.

    ``take`` maps output names to version columns. Every fact row is kept once
    as long as versions of a key do not overlap (see ``quality.checks``).
    """
    right = versions.select(
        F.col(version_key).alias("_version_key"),
        F.col(valid_from).alias("_valid_from"),
        F.col(valid_to).alias("_valid_to"),
        *[F.col(source).alias(name) for name, source in take.items()],
    )
    inside = (F.col(at) >= F.col("_valid_from")) & (
        (F.col(at) < F.col("_valid_to")) | F.col("_valid_to").isNull()
    )
    joined = left_join(facts, right, fact_key, "_version_key", inside, hot, salts, spread_by)
    return joined.drop("_valid_from", "_valid_to")
