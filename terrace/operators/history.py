"""Type-2 history: snapshots, version queries and dimensions."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import moment, surrogate_key

HISTORY_COLUMNS = ("scd_id", "updated_at", "valid_from", "valid_to")


def version_id(key: str | Column, valid_from: str | Column) -> Column:
    key = F.col(key) if isinstance(key, str) else key
    valid_from = F.col(valid_from) if isinstance(valid_from, str) else valid_from
    return F.md5(F.concat(key.cast("string"), F.lit("|"), valid_from.cast("string")))


def _opened(current: DataFrame, key: str, start: Column, as_of: Column) -> DataFrame:
    return current.select(
        *current.columns,
        version_id(key, start).alias("scd_id"),
        as_of.alias("updated_at"),
        start.alias("valid_from"),
        F.lit(None).cast("timestamp").alias("valid_to"),
    )


def scd2_snapshot(
    history: DataFrame | None,
    current: DataFrame,
    key: str,
    check_cols: Sequence[str],
    as_of,
    initial_valid_from=None,
) -> DataFrame:
    """Fold the current state into the history.

    A new key opens a version at ``as_of``. A key whose check columns changed
    (NULL compared as a value) closes its open version and opens another. A key
    that vanished closes. Other open versions, with the values they hold, and
    all closed ones stay as they are; a key that comes back opens a version.

    ``initial_valid_from`` backdates the versions of the very first load, so
    facts older than the first run still find a version.

    One full outer join of open versions with the current state decides all
    outcomes; closed versions never enter it.
    """
    now = moment(as_of)
    if history is None:
        start = now if initial_valid_from is None else moment(initial_valid_from)
        return _opened(current, key, start, now)

    added = [c for c in current.columns if c not in history.columns]
    columns = [*[c for c in history.columns if c not in HISTORY_COLUMNS], *added, *HISTORY_COLUMNS]
    types = {f.name: f.dataType for f in current.schema.fields}
    history = history.withColumns({c: F.lit(None).cast(types[c]) for c in added})
    history = history.select(*columns)
    closed = history.filter(F.col("valid_to").isNotNull())
    opened = history.filter(F.col("valid_to").isNull())

    incoming = _opened(current, key, now, now)
    missing = [c for c in columns if c not in incoming.columns]
    incoming = incoming.withColumns(
        {c: F.lit(None).cast(history.schema[c].dataType) for c in missing}
    ).select(*columns)

    old = opened.select(F.col(key).alias("_old_key"), F.struct(*columns).alias("_old"))
    new = incoming.select(F.col(key).alias("_new_key"), F.struct(*columns).alias("_new"))
    pairs = old.join(new, F.col("_old_key") == F.col("_new_key"), "full_outer")

    changed = reduce(
        lambda a, b: a | b,
        [~F.col(f"_old.{c}").eqNullSafe(F.col(f"_new.{c}")) for c in check_cols],
    )
    ended = F.col("_old").withField("valid_to", now)
    outcome = (
        F.when(F.col("_old").isNull(), F.array("_new"))
        .when(F.col("_new").isNull(), F.array(ended))
        .when(changed, F.array(ended, F.col("_new")))
        .otherwise(F.array("_old"))
    )
    moved = pairs.select(F.explode(outcome).alias("_row")).select("_row.*")
    return closed.unionByName(moved)


def scd2_dimension(history: DataFrame, sk: str, columns: Sequence[str]) -> DataFrame:
    """History as dimension versions: hashed key, validity columns and a current flag."""
    return history.select(
        surrogate_key("scd_id").alias(sk),
        *columns,
        "valid_from",
        "valid_to",
        F.col("valid_to").isNull().alias("is_current"),
        F.lit(False).alias("is_unknown"),
    )


def scd2_history(history: DataFrame, key: str, value) -> DataFrame:
    """All versions of one key, oldest first."""
    return history.filter(F.col(key) == F.lit(value)).orderBy("valid_from")


def open_versions(history: DataFrame) -> DataFrame:
    """Number of open versions."""
    return history.filter(F.col("valid_to").isNull()).agg(F.count("*").alias("open_rows"))


def keys_open_twice(history: DataFrame, key: str) -> DataFrame:
    """Keys with more than one open version."""
    return (
        history.filter(F.col("valid_to").isNull())
        .groupBy(key)
        .agg(F.count("*").alias("open_versions"))
        .filter("open_versions > 1")
    )
