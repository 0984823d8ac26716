"""One key holds a third of all rows: results stay whole and equal a brute-force reading."""

from collections import defaultdict
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from terrace.operators.allocation import allocate
from terrace.operators.incremental import apply_changes
from terrace.operators.joins import hot_keys, point_in_time_join
from terrace.operators.latest import dedupe_latest
from terrace.quality.checks import orphan_keys, scd2_overlaps, unique

N = 3000


@pytest.fixture(scope="module")
def lines(spark):
    """Order 0 holds a third of the lines; the key is missing on every eleventh row."""
    key = F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise((F.col("id") * 7) % 211)
    return spark.range(N).select(
        "id",
        F.when(F.col("id") % 11 != 0, key.cast("int")).alias("k"),
        ((F.col("id") * 37) % 101).cast("int").alias("at"),
        (((F.col("id") * 13) % 97) + 1).cast("decimal(38,6)").alias("w"),
    ).cache()


def plain(df):
    return [r.asDict() for r in df.collect()]


def test_dedupe(lines):
    best = {}
    for r in plain(lines):
        rank = (r["at"], r["id"])
        if r["k"] not in best or rank > best[r["k"]]:
            best[r["k"]] = rank
    got = {r.k: (r.at, r.id) for r in dedupe_latest(lines, ["k"], "at", ["id"]).collect()}
    assert got == best


def test_allocation_returns_every_line_and_sums_back(spark, lines):
    heads = lines.select("k").distinct().filter("k IS NOT NULL").withColumn("freight", F.lit(1000).cast("decimal(19,4)"))
    shares = allocate(lines, heads, "k", "w", {"share": "freight"}, "id")
    counts, sums = defaultdict(int), defaultdict(Decimal)
    for r in shares.select("k", "share").collect():
        counts[r.k] += 1
        sums[r.k] += r.share
    expected = defaultdict(int)
    for r in plain(lines):
        if r["k"] is not None:
            expected[r["k"]] += 1
    assert counts == expected
    assert all(total == 1000 for total in sums.values())


@pytest.mark.parametrize("split", [False, True])
def test_point_in_time(spark, lines, split):
    versions = [(k, s, s + 40 if s < 80 else None, f"{k}@{s}") for k in range(0, 211, 2) for s in (0, 40, 80)]
    dim = spark.createDataFrame(versions, "bk int, valid_from int, valid_to int, sk string")
    hot = hot_keys(lines, "k", 0.2) if split else None
    if split:
        assert [r.hot_key for r in hot.collect()] == [0]
    got = point_in_time_join(lines, dim, "k", "bk", "at", {"sk": "sk"}, hot=hot, salts=16, spread_by=["id"])
    found = {r.id: r.sk for r in got.select("id", "sk").collect()}
    assert got.count() == N
    for r in plain(lines):
        want = None if r["k"] is None or r["k"] % 2 else f"{r['k']}@{min(r['at'] // 40 * 40, 80)}"
        assert found[r["id"]] == want


def test_overlaps_of_a_key_with_very_many_versions(spark):
    start = F.timestamp_seconds(F.col("id") * 3600)
    late = F.timestamp_seconds(F.col("id") * 3600 + F.when(F.col("id") % 100 == 5, 7200).otherwise(3600))
    history = spark.range(N).select(
        F.when(F.col("id") % 3 != 0, F.col("id")).otherwise(0).alias("bk"), start.alias("valid_from"), late.alias("valid_to")
    )
    by_key = defaultdict(list)
    for r in history.collect():
        by_key[r.bk].append((r.valid_from, r.valid_to))
    want = {
        (k, a[0]) for k, spans in by_key.items() for a in spans if any(b[0] < a[0] < b[1] for b in spans)
    }
    got = {(r.business_key, r.valid_from) for r in scd2_overlaps(history, "bk", where=None).collect()}
    assert got == want


def test_counts_per_key(spark, lines):
    counts = defaultdict(int)
    for r in plain(lines):
        if r["k"] is not None:
            counts[r["k"]] += 1
    assert {r.k: r.n_rows for r in unique(lines, "k").collect()} == {k: n for k, n in counts.items() if n > 1}
    parent = spark.range(1, 100).select(F.col("id").cast("int").alias("pk"))
    orphans = {r.orphan_key: r.n_rows for r in orphan_keys(lines, "k", parent, "pk").collect()}
    assert orphans == {k: n for k, n in counts.items() if not 1 <= k < 100}


def test_a_key_changed_a_thousand_times(spark):
    table = spark.range(10).select(
        F.col("id").cast("string").alias("CustomerID"), F.lit("old").alias("Name"), F.lit("t").alias("ModifiedDate")
    )
    changes = spark.range(N).select(
        F.lit("update").alias("op"),
        F.col("id").alias("change_seq"),
        F.when(F.col("id") % 3 == 0, "4").otherwise((F.col("id") % 7).cast("string")).alias("CustomerID"),
        F.concat(F.lit("n"), F.col("id").cast("string")).alias("Name"),
    )
    want = {str(k): "old" for k in range(10)}
    for r in changes.orderBy("change_seq").collect():
        want[r.CustomerID] = r.Name
    got = apply_changes(table, changes, "CustomerID", "2020-01-01 00:00:00")
    assert {r.CustomerID: r.Name for r in got.collect()} == want
