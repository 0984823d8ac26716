"""Select, rename, cast and hierarchy flattening."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def conform(df: DataFrame, mapping: Mapping[str, Column | tuple[str, str] | str]) -> DataFrame:
    """Project to exactly ``mapping``: name -> source column, (source, type), or an expression.

    Casts are strict: a value that does not fit its type fails the job.
    """
    columns = []
    for name, spec in mapping.items():
        if isinstance(spec, tuple):
            spec = F.col(f"`{spec[0]}`").cast(spec[1])
        elif isinstance(spec, str):
            spec = F.col(f"`{spec}`")
        columns.append(spec.alias(name))
    return df.select(*columns)


def prefix_columns(df: DataFrame, prefix: str, columns: Sequence[str]) -> DataFrame:
    """Mark columns with the grain they belong to."""
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in columns})


@dataclass(frozen=True)
class Level:
    """One parent level: its table, its key, the child's foreign key and what to carry down."""

    parent: DataFrame
    key: str
    child_key: str
    labels: Mapping[str, str]
    carry: Sequence[str] = ()


def flatten_hierarchy(df: DataFrame, levels: Sequence[Level]) -> DataFrame:
    """Left-join each parent level in turn; missing labels take their default.

    ``labels`` maps a parent column to its default; ``carry`` columns (such as
    the next level's key) come along as they are. No row of ``df`` is dropped.
    """
    for level in levels:
        wanted = [*level.labels, *level.carry]
        parent = level.parent.select(F.col(level.key).alias("_parent_key"), *wanted)
        df = df.join(parent, F.col(level.child_key) == F.col("_parent_key"), "left").drop("_parent_key")
        df = df.withColumns({c: F.coalesce(F.col(c), F.lit(d)) for c, d in level.labels.items()})
    return df


def lookup_chain(df: DataFrame, hops: Sequence[tuple[DataFrame, str, str]]) -> DataFrame:
    """Chained left joins ``(table, its key, key on the left)`` that keep every row of ``df``.

    Columns of a hop must not clash with those already present; the hop's key is
    kept so a later hop can start from it.
    """
    for table, key, left_key in hops:
        if key == left_key:
            df = df.join(table, key, "left")
        else:
            df = df.join(table, F.col(left_key) == F.col(key), "left")
    return df
