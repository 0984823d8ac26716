"""Exact deduplication by salted combining of digest groups, with whole contents compared at every stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import SPACE, saved


def normalised(text: Column) -> Column:
    """Each run of white space becomes one space; null counts as empty.

    The pattern skips single spaces, which are right already.
    """
    runs = rf"[\x09-\x0D][{SPACE}]*|\x20[{SPACE}]+"
    return F.regexp_replace(F.coalesce(text, F.lit("")), runs, " ")


def sha256(content: Column) -> Column:
    return F.unhex(F.sha2(content, 256))


def _winners(rows: DataFrame, salts: int) -> DataFrame:
    """(digest, content, keep, n) of ``rows``: combined in each map task, then per salt, then the winners of the salts."""
    salt = F.pmod(F.xxhash64("id"), F.lit(salts)).alias("salt")
    salted = rows.groupBy("digest", salt, "content").agg(F.min("id").alias("keep"), F.count(F.lit(1)).alias("n"))
    return salted.groupBy("digest", "content").agg(F.min("keep").alias("keep"), F.sum("n").alias("n"))


def exact_groups(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    digest: Callable[[Column], Column] = sha256,
    salts: int = 32,
    broadcast_digests: int = 200_000,
) -> DataFrame:
    """Group every row with the rows of equal normalised text.

    Returns one row per input row: ``id_column``, ``digest``, ``keep_id`` (the
    smallest id of the group), ``group_size`` (rows), ``kept``.

    Copies meet within each map task first, then per (digest, salt, content), and one
    winner of each salt goes into the global merge, so a text that a third of all rows
    share arrives there as at most ``salts`` rows. Content is part of the key in all
    steps: texts with equal digests stay apart, and rows of such a digest find their
    group by content. A digest that occurs once has no one to be compared with: while
    the repeated digests are few enough to be sent to all tasks (``broadcast_digests``,
    counted before), texts of other digests are left out of the steps where they stand;
    beyond that all texts go through them.

    Null text counts as empty. Ids that are null never win against others; a group
    of null ids only has a null ``keep_id``. Rows that repeat an id in one group are
    ``kept`` together. Other columns are ignored.
    """
    rows = docs.select(F.col(id_column).alias("id"), normalised(F.col(text_column)).alias("content"))
    rows = rows.select("id", "content", digest(F.col("content")).alias("digest"))
    digests = saved(rows.select("id", "digest"), "digests")
    repeated = digests.groupBy("digest").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("digest")
    repeated = saved(repeated, "repeated-digests")
    few = repeated.count() <= broadcast_digests
    winners = saved(_winners(rows.join(F.broadcast(repeated), "digest", "left_semi") if few else rows, salts), "winners")
    variants = winners.groupBy("digest").agg(
        F.count(F.lit(1)).alias("variants"), F.min("keep").alias("keep"), F.sum("n").alias("n")
    )
    found = digests.join(variants, "digest", "left")
    clashing = variants.where("variants > 1").select("digest")
    if not clashing.isEmpty():  # different texts under one digest: their rows need the content itself
        apart = (
            rows.join(clashing, "digest", "left_semi")
            .join(winners, ["digest", "content"])
            .select("digest", "id", F.lit(1).cast("long").alias("variants"), "keep", "n")
        )
        found = found.where("variants IS NULL OR variants = 1").unionByName(apart)
    alone = F.col("variants").isNull()
    keep = F.when(alone, F.col("id")).otherwise(F.col("keep"))
    return found.select(
        F.col("id").alias(id_column),
        "digest",
        keep.alias("keep_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n")).cast("long").alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
    )
