"""Keyed merge, lookback slice and change batches."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import moment, not_blank, packed
from .latest import duplicate_keys

BEGINNING = "0001-01-01 00:00:00"


def incremental_slice(
    src: DataFrame,
    target: DataFrame | None,
    src_time: str,
    target_time: str,
    days: int,
    marks: DataFrame | None = None,
) -> DataFrame:
    """Rows no older than the target's newest time minus ``days``; everything on a first run.

    ``target`` is None on a first run, which also takes untimed rows; nothing is run to
    find out. The cutoff is a scalar subquery compared with the bare column, so it is
    pushed into the Parquet scan as a literal and prunes row groups. A target without
    rows or times gives no cutoff and lets every timed row through. ``marks`` (from
    ``read_marks``: the largest time of each partition) stands in for a scan of the target.
    """
    if target is None:
        return src
    time_type = src.schema[src_time].dataType
    known, column = (target, target_time) if marks is None else (marks, f"{target_time}_max")
    newest = F.max(column) - F.make_interval(days=F.lit(days))
    cutoff = known.agg(
        F.coalesce(newest.cast(time_type), F.lit(BEGINNING).cast(time_type)).alias("cutoff")
    ).scalar()
    return src.filter(F.col(src_time) >= cutoff)


class DuplicateKeys(ValueError):
    """A merge batch holds the same key twice."""


def require_unique(df: DataFrame, keys: Sequence[str]) -> None:
    sample = duplicate_keys(df, keys).limit(1).collect()
    if sample:
        shown = {k: sample[0][k] for k in keys}
        raise DuplicateKeys(f"{sample[0]['n_rows']} batch rows share key {shown}")


def merge_upsert(
    target: DataFrame | None,
    updates: DataFrame,
    keys: Sequence[str],
    check_unique: bool = True,
    within: str | None = None,
) -> DataFrame:
    """Replace matched rows, insert the rest, keep target rows absent from the batch.

    Columns new in the batch are added with NULL on kept rows; columns missing
    from it stay and are NULL on the rows it writes. Nothing is ever deleted.
    Only the batch's keys take part in the join, so a small batch is broadcast
    and the target is not shuffled. ``within`` names a column of the target in whose
    order the rows that a larger batch replaces lie close together, such as the time of the
    lookback: a pass over the target's keys finds between which values they lie, and
    only target rows there (or without a value) are shuffled whole.
    """
    if check_unique:
        require_unique(updates, keys)
    if target is None:
        return updates
    if within is None:
        kept = target.join(updates.select(*keys), list(keys), "left_anti")
    else:
        near = _may_match(target, updates, keys, within)
        absent = target.filter(near).join(updates.select(*keys), list(keys), "left_anti")
        kept = target.filter(~near).unionByName(absent)
    return kept.unionByName(updates, allowMissingColumns=True).select(
        *target.columns, *[c for c in updates.columns if c not in target.columns]
    )


def _may_match(target: DataFrame, updates: DataFrame, keys: Sequence[str], within: str) -> Column:
    """Whether ``within`` lies where target rows hold a key of the batch: never NULL, and true on each such row."""

    def narrow(df: DataFrame) -> list[Column]:
        text = {f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)}
        return [(packed(k) if k in text else F.col(k)).alias(k) for k in keys]

    matched = target.select(*narrow(target), F.col(within).alias("_within")).join(updates.select(*narrow(updates)), list(keys), "left_semi")
    ends = matched.agg(
        F.struct(F.count(F.lit(1)).alias("n"), F.min("_within").alias("first"), F.max("_within").alias("last")).alias("ends")
    ).scalar()
    inside = F.col(within).between(ends["first"], ends["last"])
    return (ends["n"] > 0) & F.coalesce(inside, F.lit(True))


def number_from(df: DataFrame, order: str, start: Column, name: str, blocks: int = 256) -> DataFrame:
    """Consecutive numbers ``start + 1, start + 2, ...`` in the order of a unique integer column.

    Rows are numbered inside ``blocks`` ranges of about equally many rows, cut at
    quantiles, and offset by the totals of the ranges before. However sparse the values
    are, only one small row per range passes through the running total.
    """
    steps = F.array(*[F.lit(k / blocks) for k in range(1, blocks)])
    cuts = df.agg(F.percentile_approx(order, steps, F.lit(100 * blocks)).alias("cuts")).scalar()
    below = F.size(F.filter("_cuts", lambda cut: cut < F.col(order)))
    numbered = df.withColumn("_cuts", cuts).withColumn("_block", below).drop("_cuts")
    sizes = numbered.groupBy(F.col("_block").alias("_size_block")).agg(F.count("*").alias("_size"))
    before = Window.orderBy("_size_block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "_size_block", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset")
    )
    inside = F.row_number().over(Window.partitionBy("_block").orderBy(order))
    return (
        numbered.withColumn("_place", inside)
        .join(offsets, F.col("_block") == F.col("_size_block"))
        .withColumn(name, start + F.col("_offset") + F.col("_place"))
        .drop("_block", "_size_block", "_offset", "_place")
    )


def hash_guid(*parts: Column) -> Column:
    """GUID-shaped text from a hash, equal on every recomputation of the row."""
    digest = F.upper(F.md5(F.concat_ws("|", *parts)))
    bounds = [(1, 8), (9, 4), (13, 4), (17, 4), (21, 12)]
    return F.concat_ws("-", *[F.substring(digest, start, size) for start, size in bounds])


def apply_changes(
    df: DataFrame,
    changes: DataFrame,
    key: str,
    as_of,
    op: str = "op",
    seq: str = "change_seq",
    guid: str = "rowguid",
    modified: str = "ModifiedDate",
) -> DataFrame:
    """Apply a batch of inserts, updates and deletes, each as if run in ``seq`` order.

    ``changes`` carries ``op`` ('insert', 'update', 'delete'), a unique integer
    ``seq`` and any of the table's columns as text. Inserts without a key are
    numbered after the largest key in use; a missing guid or modified time is
    filled. Updates overwrite only with non-blank values and always bump the
    modified time. Deletes drop the rows that hold the key at that point; an
    unknown key changes nothing.

    The changes are folded to one row per key before they meet the table, so a
    key that is changed very often still joins as a single row.
    """
    fields = [c for c in df.columns if c in changes.columns]
    stamp = moment(as_of).cast("string")
    types = {f.name: f.dataType for f in df.schema.fields}
    cleaned = changes.select(
        F.lower(F.col(op)).alias("_op"),
        F.col(seq).cast("bigint").alias("_seq"),
        *[not_blank(F.col(c).cast("string")).alias(c) for c in fields],
    )

    inserted = cleaned.filter("_op = 'insert'")
    keyed = inserted.filter(F.col(key).isNotNull())
    in_use = df.select(F.col(key).cast("bigint").alias("k")).unionByName(
        keyed.select(F.col(key).cast("bigint").alias("k"))
    )
    largest = in_use.agg(F.coalesce(F.max("k"), F.lit(0).cast("bigint")).alias("k")).scalar()
    numbered = (
        number_from(inserted.filter(F.col(key).isNull()), "_seq", largest, "_new_key")
        .withColumn(key, F.col("_new_key").cast("string"))
        .drop("_new_key")
    )
    added = keyed.unionByName(numbered)
    if guid in df.columns:
        given = F.col(guid) if guid in fields else F.lit(None).cast("string")
        made = hash_guid(F.col(key), F.col("_seq").cast("string"), stamp)
        added = added.withColumn(guid, F.coalesce(given, made))
    if modified in df.columns:
        given = F.col(modified) if modified in fields else F.lit(None).cast("string")
        added = added.withColumn(modified, F.coalesce(given, stamp))
    typed_added = added.select(
        "_seq",
        *[
            (F.col(c) if c in added.columns else F.lit(None)).cast(types[c]).alias(c)
            for c in df.columns
        ],
    )
    rows = df.withColumn("_seq", F.lit(-1).cast("bigint")).unionByName(typed_added)

    is_update = F.col("_op") == "update"
    editable = [c for c in fields if c not in (key, modified)]
    has_value = F.coalesce(*[F.col(c) for c in editable]) if editable else F.lit(None)
    if modified in fields:
        has_value = F.coalesce(has_value, F.col(modified))
    folded = (
        cleaned.filter(F.col("_op").isin("update", "delete") & F.col(key).isNotNull())
        .groupBy(F.col(key).cast(types[key]).alias("_change_key"))
        .agg(
            F.max(F.when(F.col("_op") == "delete", F.col("_seq"))).alias("_deleted_at"),
            F.max(F.when(is_update & has_value.isNotNull(), F.col("_seq"))).alias("_updated_at"),
            *[
                F.max(
                    F.when(is_update & F.col(c).isNotNull(), F.struct("_seq", F.col(c).alias("value")))
                ).alias(f"_set_{i}")
                for i, c in enumerate(editable)
            ],
        )
    )
    joined = rows.join(folded, F.col(key) == F.col("_change_key"), "left")
    alive = joined.filter(F.col("_deleted_at").isNull() | (F.col("_seq") > F.col("_deleted_at")))
    out = []
    for c in df.columns:
        current = F.col(f"`{c}`")
        if c in editable:
            change = f"_set_{editable.index(c)}"
            applies = F.col(f"{change}._seq") > F.col("_seq")
            current = F.when(applies, F.col(f"{change}.value").cast(types[c])).otherwise(current)
        elif c == modified:
            current = F.when(F.col("_updated_at") > F.col("_seq"), stamp.cast(types[c])).otherwise(current)
        out.append(current.alias(c))
    return alive.select(*out)


def change_report(df: DataFrame, changes: DataFrame, key: str, op: str = "op") -> DataFrame:
    """Per keyed operation: requests, distinct keys, keys present in ``df`` and rows they touch."""
    key_type = df.schema[key].dataType
    asked = (
        changes.filter(F.lower(F.col(op)).isin("update", "delete"))
        .groupBy(
            F.lower(F.col(op)).alias("op"), not_blank(F.col(key).cast("string")).cast(key_type).alias("_k")
        )
        .agg(F.count("*").alias("_requests"))
    )
    # Only keys that are asked for are counted in the table.
    held = (
        df.join(asked.select(F.col("_k").alias(key)).distinct(), key, "left_semi")
        .groupBy(F.col(key).alias("_held"))
        .agg(F.count("*").alias("_rows"))
    )
    return (
        asked.join(held, F.col("_k") == F.col("_held"), "left")
        .groupBy("op")
        .agg(
            F.sum("_requests").alias("requests"),
            F.count("_k").alias("keys"),
            F.count("_rows").alias("keys_found"),
            F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows_affected"),
        )
    )
