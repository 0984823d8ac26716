from decimal import Decimal

import pytest
from conftest import rows_of, ts
from pyspark.sql import functions as F

from terrace.operators.allocation import allocate
from terrace.operators.dimensions import (
    date_dimension,
    flag_combinations,
    junk_dimension,
    junk_lookup,
    with_bridge_count,
    with_unknown_member,
)
from terrace.operators.joins import heavy_hitters, hot_keys, left_join, point_in_time_join
from terrace.operators.latest import best_per_key, current_assignment, dedupe_latest, duplicate_keys
from terrace.operators.shape import Level, conform, flatten_hierarchy


def test_dedupe_latest(frame):
    df = frame(
        [(1, "2013-01-01", "a"), (1, "2014-01-01", "b"), (2, "2013-01-01", "x"), (2, "2013-01-01", "y"),
         (3, None, "n"), (3, "2010-01-01", "o"), (None, "2013-01-01", "p"), (None, "2012-01-01", "q")],
        "k int, modified string, v string",
    )
    assert rows_of(dedupe_latest(df, ["k"], "modified"), "k", "v") == [(1, "b"), (2, "y"), (3, "o"), (None, "p")]


def test_current_assignment_filters_before_it_ranks(frame):
    df = frame(
        [("closed", 1, "2012-01-01", "2013-01-01"), ("open", 1, "2011-01-01", None),
         ("late", 2, "2012-05-01", None), ("early", 2, "2012-01-01", None), ("gone", 3, "2012-01-01", "2012-02-01")],
        "who string, k int, start string, stop string",
    )
    assert rows_of(current_assignment(df, ["k"], "stop", "start"), "k", "who") == [(1, "open"), (2, "late")]


def test_best_per_key_two_levels(frame):
    df = frame(
        [(1, 2, "2014"), (1, 1, "2010"), (2, 2, None), (2, 2, "2011"), (2, 2, "2012")], "k int, kind int, at string"
    )
    best = best_per_key(df, ["k"], [F.col("kind").asc(), F.col("at").desc_nulls_last()])
    assert rows_of(best) == [(1, 1, "2010"), (2, 2, "2012")]


def test_duplicate_keys(frame):
    df = frame([(1,), (1,), (2,), (None,), (None,)], "k int")
    assert rows_of(duplicate_keys(df, ["k"])) == [(1, 2), (None, 2)]


def test_conform_casts_strictly(frame):
    df = frame([("1", "x", "0")], "a string, `Group` string, flag string")
    out = conform(df, {"a_bk": ("a", "int"), "grp": "Group", "is_on": ("flag", "boolean")})
    assert out.dtypes == [("a_bk", "int"), ("grp", "string"), ("is_on", "boolean")]
    bad = conform(frame([("5&|",)], "a string"), {"a": ("a", "int")})
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        bad.collect()


def test_flatten_hierarchy_keeps_every_row(frame):
    child = frame([(1, 10), (2, 99), (3, None)], "id int, sub int")
    sub = frame([(10, "Sub", 7)], "sub int, sub_name string, cat int")
    cat = frame([(8, "Cat")], "cat int, cat_name string")
    flat = flatten_hierarchy(
        child, [Level(sub, "sub", "sub", {"sub_name": "None"}, ["cat"]), Level(cat, "cat", "cat", {"cat_name": "None"})]
    )
    assert rows_of(flat, "id", "sub_name", "cat_name") == [
        (1, "Sub", "None"), (2, "None", "None"), (3, "None", "None")
    ]


@pytest.fixture
def versions(frame):
    return frame(
        [("a1", 1, ts("1900-01-01"), ts("2012-01-01")), ("a2", 1, ts("2012-01-01"), None),
         ("b1", 2, ts("2011-01-01"), ts("2012-01-01")), ("-1", -1, ts("1900-01-01"), None)],
        "sk string, bk int, valid_from timestamp, valid_to timestamp",
    )


@pytest.fixture
def facts(frame):
    return frame(
        [(1, 1, ts("2011-12-31T23:59:59")), (2, 1, ts("2012-01-01")), (3, 2, ts("2010-01-01")),
         (4, 2, ts("2012-01-01")), (5, 2, ts("2011-06-01")), (6, None, ts("2012-01-01")), (7, 3, ts("2012-01-01"))],
        "id int, bk_fact int, at timestamp",
    )


EXPECTED = [(1, "a1"), (2, "a2"), (3, None), (4, None), (5, "b1"), (6, None), (7, None)]


def test_point_in_time_is_half_open(facts, versions):
    got = point_in_time_join(facts, versions, "bk_fact", "bk", "at", {"found": "sk"})
    assert rows_of(got, "id", "found") == EXPECTED
    assert got.columns == ["id", "bk_fact", "at", "found"]


def test_point_in_time_with_split_keys(facts, versions):
    hot = hot_keys(facts, "bk_fact", 0.25)
    assert rows_of(hot) == [(1,), (2,)]
    got = point_in_time_join(facts, versions, "bk_fact", "bk", "at", {"found": "sk"}, hot=hot, salts=3)
    assert rows_of(got, "id", "found") == EXPECTED
    assert got.columns == ["id", "bk_fact", "at", "found"]


def test_split_join_spreads_a_hot_key(spark):
    facts = spark.range(900).select("id", F.when(F.col("id") < 600, 1).when(F.col("id") < 700, 2).alias("k"))
    dim = spark.createDataFrame([(1, "one"), (2, "two")], "key int, label string")
    hot = hot_keys(facts, "k", 0.3)
    got = left_join(facts, dim, "k", "key", hot=hot, salts=8)
    assert rows_of(got.groupBy("label").count()) == [("one", 600), ("two", 100), (None, 200)]
    # and the rows of the hot key really carry different join slots
    slots = facts.filter("k = 1").select(F.pmod(F.xxhash64("id", "k"), F.lit(8)).alias("s")).distinct().count()
    assert slots == 8


def test_unknown_member_is_typed(frame):
    df = frame([("x", 1, Decimal("1.5"), False)], "sk string, bk int, price decimal(19,4), is_unknown boolean")
    out = with_unknown_member(df, {"sk": "-1", "bk": -1, "price": "0", "is_unknown": True})
    assert out.dtypes == df.dtypes
    assert rows_of(out) == [("-1", -1, Decimal("0"), True), ("x", 1, Decimal("1.5"), False)]
    with pytest.raises(ValueError, match="absent"):
        with_unknown_member(df, {"nope": 1})


def test_junk_dimension_and_lookup(frame):
    lines = frame([(1, "S", True), (2, None, True), (3, "S", None)], "id int, status string, flag boolean")
    combos = flag_combinations(lines, {"status": "Unknown", "flag": False})
    junk = junk_dimension(combos, "junk_sk", {"status": "Unknown"})
    assert junk.count() == 4
    found = junk_lookup(lines, junk, "junk_sk", ["status", "flag"])
    # a NULL on the line misses although its default is a member
    assert [(i, sk == "-1") for i, sk in rows_of(found, "id", "junk_sk")] == [(1, False), (2, True), (3, True)]


def test_bridge_count(frame):
    offers = frame([(1,), (2,)], "offer int")
    bridge = frame([(1, 7), (1, 8)], "offer int, product int")
    out = with_bridge_count(offers, bridge, "offer", "n")
    assert rows_of(out) == [(1, 2), (2, 0)] and dict(out.dtypes)["n"] == "bigint"


def test_date_dimension(frame):
    df = frame(
        [(ts("2011-05-31"), None, ts("2014-07-12")), (ts("2012-02-29"), ts("2012-03-01"), None)],
        "ordered timestamp, shipped timestamp, due timestamp",
    )
    days = date_dimension(df, ["ordered", "shipped", "due"])
    assert len(days.columns) == 29
    assert days.count() == 1461 + 1
    row = days.filter("date_sk = 20120229").collect()[0].asDict()
    assert row["quarter_name"] == "Q1 2012" and row["month_name"] == "February" and row["day_of_week"] == 4
    assert row["is_last_day_of_month"] and not row["is_weekend"] and row["fiscal_year_quarter"] == "FY2012-FQ3"
    assert str(row["quarter_end_date"]) == "2012-03-31" and str(row["year_end_date"]) == "2012-12-31"
    unknown = days.filter("date_sk = -1").collect()[0].asDict()
    assert unknown["is_unknown"] and unknown["full_date"] is None
    assert date_dimension(df.limit(0), ["ordered"]).count() == 1


def test_allocation(frame):
    lines = frame(
        [(1, 1, Decimal(10)), (1, 2, Decimal(20)), (1, 3, Decimal(70)), (2, 1, Decimal(0)), (3, 1, Decimal(5))],
        "k int, line int, w decimal(38,6)",
    )
    heads = frame([(1, Decimal("10.01")), (2, Decimal("3"))], "k int, freight decimal(19,4)")
    out = allocate(lines, heads, "k", "w", {"share": "freight"}, "line")
    assert dict(out.dtypes)["share"] == "decimal(38,6)"
    assert rows_of(out, "k", "line", "share") == [
        (1, 1, Decimal("1.001")), (1, 2, Decimal("2.002")), (1, 3, Decimal("7.007")), (2, 1, Decimal("0"))
    ]


def test_allocation_of_a_large_order_returns_every_millionth(spark):
    lines = spark.range(3_000_000).selectExpr("1 AS k", "id AS line", "cast(1 AS decimal(38,6)) AS w")
    heads = spark.sql("SELECT 1 AS k, cast(1000 AS decimal(19,4)) AS freight")
    out = allocate(lines, heads, "k", "w", {"share": "freight"}, "line")
    total, least, largest = out.selectExpr("sum(share)", "min(share)", "max(share)").first()
    assert total == 1000 and least == Decimal("0.000333") and largest == Decimal("1.000333")


def test_allocation_of_missing_values(frame):
    lines = frame([(1, 1, None), (1, 2, Decimal(3)), (1, 3, Decimal(4)), (2, 1, Decimal(1))], "k int, line int, w decimal(38,6)")
    heads = frame([(1, Decimal("1")), (2, None)], "k int, freight decimal(19,4)")
    out = allocate(lines, heads, "k", "w", {"share": "freight"}, "line")
    assert rows_of(out, "k", "line", "share") == [
        (1, 1, Decimal("0")), (1, 2, Decimal("0.428572")), (1, 3, Decimal("0.571428")), (2, 1, Decimal("0"))
    ]


def cut_shares(lines, amount):
    """Shares by whole numbers: cut toward zero, the smallest line takes the rest."""
    units = int(amount * 10**6)
    weights = {line: int(w * 10**6) for line, w in lines}
    total = sum(weights.values())
    cut = {line: abs(units * w) // total * (1 if units * w >= 0 else -1) for line, w in weights.items()}
    cut[min(cut)] += units - sum(cut.values())
    return {line: Decimal(c).scaleb(-6) for line, c in cut.items()}


@pytest.mark.parametrize("hot", [[], [2, 5, 7]])
def test_allocation_over_the_whole_range(frame, hot):
    top = Decimal("999999999999999.9999")
    orders = {
        1: (Decimal("100000000000000.0001"), [Decimal(1), Decimal(1), Decimal(1)]),
        2: (-top, [Decimal("12345678901234567890123.123456"), Decimal("7.5"), Decimal("0.000001")]),
        3: (top, [Decimal("70000000000000"), Decimal("10000000000000.5"), Decimal("3")]),
        4: (Decimal("2000000000000"), [Decimal("5"), Decimal("-2"), Decimal("0.1")]),
        5: (Decimal("-0.0001"), [Decimal("3"), Decimal("3"), Decimal("3")]),
        6: (Decimal("1000000000000"), [Decimal("10000000000000"), Decimal("1"), None]),
        7: (top, [Decimal("0.000001"), Decimal("0.000001"), Decimal("0.000002")]),
    }
    rows = [(k, i, w) for k, (_, weights) in orders.items() for i, w in enumerate(weights)]
    lines = frame(rows, "k int, line int, w decimal(38,6)")
    heads = frame([(k, amount) for k, (amount, _) in orders.items()], "k int, freight decimal(19,4)")
    out = allocate(lines, heads, "k", "w", {"share": "freight", "again": "freight"}, "line", hot=hot, salts=3)
    got = {(r.k, r.line): r.share for r in out.collect()}
    for k, (amount, weights) in orders.items():
        want = cut_shares([(i, w) for i, w in enumerate(weights) if w is not None], amount)
        assert {i: got[k, i] for i in want} == want
        assert sum(got[k, i] for i in range(3)) == amount
    assert out.filter("share <> again").count() == 0 and out.columns == ["k", "line", "w", "freight", "share", "again"]


def test_allocation_of_weights_of_32_digits_sums_back(frame):
    big = Decimal("3" * 31 + ".123456")
    lines = frame([(1, 1, big), (1, 2, big), (1, 3, Decimal(1))], "k int, line int, w decimal(38,6)")
    heads = frame([(1, Decimal("123456789.1234"))], "k int, freight decimal(19,4)")
    shares = [r.share for r in allocate(lines, heads, "k", "w", {"share": "freight"}, "line").orderBy("line").collect()]
    assert sum(shares) == Decimal("123456789.1234") and shares[1] == Decimal("61728394.561700") and shares[2] == 0


def test_heavy_hitters_of_many_keys_in_one_pass(spark):
    rows = spark.range(9000).selectExpr("CASE WHEN id % 3 = 0 THEN NULL ELSE id END AS a", "CASE WHEN id % 3 = 1 THEN 'hot' ELSE string(id) END AS b", "id AS c")
    assert heavy_hitters(rows, ["a", "b", "c"], 0.1) == {"a": [None], "b": ["hot"], "c": []}
    assert heavy_hitters(rows.limit(0), ["a", "b"], 0.1) == {"a": [], "b": []}
