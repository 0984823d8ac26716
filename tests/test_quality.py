from decimal import Decimal

import pytest
from conftest import rows_of, ts
from pyspark.sql import functions as F

from terrace.quality import checks
from terrace.quality.contracts import CONTRACTS
from terrace.quality.suite import ContractBroken, accepted, between, contract, enforce, holds, key, matches, related, run_suite


@pytest.fixture
def table(frame):
    return frame(
        [(1, "a", 5, True), (2, "b", None, False), (2, None, 50, None), (None, "zz", -1, True)],
        "id int, code string, qty int, flag boolean",
    )


def test_row_checks(table):
    assert checks.not_null(table, "code").count() == 1
    assert checks.not_null(table, "code", where="flag").count() == 0
    assert rows_of(checks.accepted_values(table, "code", ["a", "b"]), "code") == [("zz",)]
    assert checks.accepted_values(table, "id", [1, "2"]).count() == 0
    assert rows_of(checks.value_between(table, "qty", 0, 10), "qty") == [(-1,), (50,)]
    assert rows_of(checks.value_between(table, "qty", low=0), "qty") == [(-1,)]
    assert rows_of(checks.matches_regex(table, "code", "^[a-z]$"), "code") == [("zz",)]
    assert checks.expression_is_true(table, "qty > 0").count() == 1
    assert checks.expression_is_true(table, ">= 0", column="qty", where="flag").count() == 1
    with pytest.raises(ValueError):
        checks.is_outside("qty")


def test_key_checks(table, frame):
    assert rows_of(checks.unique(table, "id")) == [(2, 2)]
    assert checks.unique(table, "code").isEmpty()
    nulls = frame([(None, 1), (None, 1), (2, 1)], "a int, b int")
    assert checks.unique(nulls, "a").isEmpty()
    assert rows_of(checks.unique_combination(nulls, ["a", "b"])) == [(None, 1, 2)]
    parent = frame([(1,)], "pk int")
    assert checks.relationships(table, "id", parent, "pk").count() == 2
    assert rows_of(checks.orphan_keys(table, "id", parent, "pk")) == [(2, 2)]
    assert checks.relationships(table, "id", parent, "pk", where="flag").isEmpty()


def span(key, a, b, unknown=False):
    return (key, ts(a), ts(b) if b else None, unknown)


def test_overlaps(frame):
    schema = "bk int, valid_from timestamp, valid_to timestamp, is_unknown boolean"
    df = frame(
        [
            span(1, "2011-01-01", "2012-01-01"), span(1, "2012-01-01", None),  # touching
            span(2, "2011-01-01", "2012-01-02"), span(2, "2012-01-01", None),  # overlapping
            span(3, "2011-01-01", None), span(3, "2011-01-01", None),  # doubled
            span(4, "2011-01-01", None), span(4, "2011-01-02", "2011-01-03"), span(4, "2014-01-01", None),
            span(5, "2011-01-01T01:00:00", "2011-01-01T05:00:00"), span(5, "2011-01-01T02:00:00", "2011-01-01T03:00:00"),
            span(5, "2011-01-01T04:00:00", "2011-01-01T06:00:00"), span(5, "2011-01-01T06:00:00", None),
            span(-1, "1900-01-01", None, True), span(-1, "1900-01-02", None, True),
        ],
        schema,
    )
    got = rows_of(checks.scd2_overlaps(df, "bk"), "business_key", "valid_from", "n_versions")
    assert got == [
        (2, ts("2012-01-01"), 1),
        (3, ts("2011-01-01"), 2),
        (4, ts("2011-01-02"), 1),
        (4, ts("2014-01-01"), 1),
        (5, ts("2011-01-01T02:00:00"), 1),
        (5, ts("2011-01-01T04:00:00"), 1),
    ]


def test_overlap_keys_equal_the_pairwise_definition(spark):
    import random

    rng = random.Random(5)
    rows = []
    for k in range(60):
        for _ in range(rng.randint(1, 5)):
            start = rng.randint(0, 400)
            rows.append((k, start, start + rng.randint(1, 120) if rng.random() < 0.8 else None))
    df = spark.createDataFrame(rows, "bk int, s int, e int").select(
        "bk",
        F.timestamp_seconds(F.col("s") * 3600 * 5).alias("valid_from"),
        F.timestamp_seconds(F.col("e") * 3600 * 5).alias("valid_to"),
    )
    pairs = {
        a[0]
        for i, a in enumerate(rows)
        for j, b in enumerate(rows)
        if i != j and a[0] == b[0]
        and (a[1] == b[1] or (a[1] < (b[2] or 10**9) and (a[2] or 10**9) > b[1]))
    }
    assert {r.business_key for r in checks.scd2_overlaps(df, "bk", where=None).collect()} == pairs


def test_table_checks(frame):
    a, b = frame([(Decimal("10.00"),)], "x decimal(10,2)"), frame([(Decimal("10.01"),)], "x decimal(10,2)")
    assert checks.reconcile(a, "x", b, "x", "l", "r").isEmpty()
    c = frame([(Decimal("10.02"),)], "x decimal(10,2)")
    assert rows_of(checks.reconcile(a, "x", c, "x", "l", "r")) == [(Decimal("10.00"), Decimal("10.02"), Decimal("0.02"))]
    dims = frame([(True, None), (False, None)], "is_unknown boolean, valid_to timestamp")
    closed = frame([(True, ts("2011-01-01"))], "is_unknown boolean, valid_to timestamp")
    got = checks.missing_unknown_member({"ok": dims, "twice": dims.unionByName(dims), "closed": closed})
    assert rows_of(got) == [("closed", 0), ("twice", 2)]
    fact = frame(
        [("s", "1-1", Decimal("5"), Decimal("4")), ("t", "1-2", Decimal("5"), Decimal("5"))],
        "sales_order_line_sk string, sales_order_line_bk string, line_total decimal(38,6), "
        "line_total_with_overhead decimal(38,6)",
    )
    assert rows_of(checks.negative_overhead(fact), "sales_order_line_bk", "overhead_delta") == [("1-1", Decimal("-1"))]


@pytest.mark.parametrize(
    "as_of, status", [("2014-01-02 00:00:00", "pass"), ("2014-01-02 00:00:01", "warn"), ("2014-01-03 00:00:01", "error")]
)
def test_freshness(frame, as_of, status):
    df = frame([("2014-01-01 00:00:00",), ("2013-01-01 00:00:00",)], "LoadedAt string")
    row = checks.freshness(df, "LoadedAt", as_of, 24, 48).collect()[0]
    assert row.status == status and row.max_loaded_at == ts("2014-01-01")
    assert checks.freshness(df.limit(0), "LoadedAt", as_of, 24, 48).collect()[0].status == "error"


def test_freshness_levels():
    from terrace.sources.registry import freshness_hours

    assert freshness_hours("Customer") == (24, 48)
    assert freshness_hours("StateProvince") == (168, 720)
    assert freshness_hours("Product") is None


def test_suite_report(table, frame):
    items = contract(
        key("id"), accepted("code", "a", "b"), between("qty", low=0), matches("code", "^[a-z]$"),
        holds("qty < 10"), related("id", "parent.pk", where="flag"),
    )
    report = run_suite(table, "t", items, {"parent": frame([(2,)], "pk int")})
    got = {(r.column_name, r.test): r.violations for r in report.collect()}
    assert got == {
        ("id", "not_null"): 1, ("id", "unique"): 1, ("code", "accepted_values"): 1, ("qty", "value_between"): 1,
        ("code", "matches_regex"): 1, ("", "expression_is_true"): 1, ("id", "relationships"): 1,
    }
    with pytest.raises(ContractBroken, match="t.code accepted_values a,b: 1"):
        enforce(report)
    enforce(report.filter("violations = 0"))


def test_declared_counts():
    from collections import Counter

    counts = Counter(c.test for items in CONTRACTS.values() for c in items)
    assert counts == {
        "not_null": 297, "unique": 62, "relationships": 72, "accepted_values": 25, "unique_combination": 11,
        "expression_is_true": 15, "value_between": 66, "matches_regex": 4, "scd2_no_overlap": 3,
    }


def test_text_keys_are_counted_as_they_are(frame):
    digest = "d41d8cd98f00b204e9800998ecf8427e"
    child = frame([(digest,), (digest,), (digest.upper(),), ("-1",), ("-1",), ("",), (None,), (None,)], "k string")
    assert rows_of(checks.unique(child, "k")) == [("-1", 2), (digest, 2)]
    parent = frame([("-1",), (None,)], "p string")
    assert rows_of(checks.orphan_keys(child, "k", parent, "p")) == [("", 1), (digest.upper(), 1), (digest, 2)]
    assert "unhex" in checks.unique(child, "k")._jdf.queryExecution().executedPlan().toString()
