from decimal import Decimal

from conftest import ts
from pyspark.sql import functions as F

from terrace.functions import columns as c


def one(frame, schema, row, *exprs):
    return tuple(frame([row], schema).select(*[e.alias(f"c{i}") for i, e in enumerate(exprs)]).collect()[0])


def test_surrogate_key_separates_null_and_blank(frame):
    df = frame([(None, "a"), ("", "a"), ("a", None)], "x string, y string")
    keys = [r.k for r in df.select(c.surrogate_key("x", "y").alias("k")).collect()]
    assert len(set(keys)) == 3 and all(len(k) == 32 for k in keys)


def test_composite_key_is_null_with_a_null_part(frame):
    got = frame([(1, 2), (1, None)], "a int, b int").select(c.composite_key("a", "b").alias("k")).collect()
    assert [r.k for r in got] == ["1-2", None]


def test_leading_timestamp_ignores_what_follows(frame):
    for text in ("2013-07-31 00:00:00.000000000", "2013-07-31 00:00:00.000&|", "2013-07-31 00:00:00"):
        assert one(frame, "t string", (text,), c.leading_timestamp("t")) == (ts("2013-07-31 00:00:00"),)
    assert one(frame, "t string", (None,), c.leading_timestamp("t")) == (None,)


def test_mask_tail(frame):
    texts = ["1111222233334444", "4444", "444", None]
    got = frame([(t,) for t in texts], "t string").select(c.mask_tail("t").alias("m")).collect()
    assert [r.m for r in got] == ["XXXXXXXXXXXX4444", "4444", "444", None]


def test_full_name(frame):
    rows = [("A", "", "Z", None), ("A", None, "Z", ""), ("A", "B", "Z", "Jr."), (None, None, None, None)]
    df = frame(rows, "f string, m string, l string, s string")
    assert [r.n for r in df.select(c.full_name("f", "m", "l", "s").alias("n")).collect()] == [
        "A Z", "A Z", "A B Z Jr.", ""
    ]


def test_decode(frame):
    df = frame([(1,), (6,), (9,), (None,)], "s int")
    labels = {1: "In process", 6: "Cancelled"}
    assert [r.d for r in df.select(c.decode("s", labels).alias("d")).collect()] == [
        "In process", "Cancelled", "Unknown", "Unknown"
    ]


def test_discount_tier_edges(frame):
    from terrace.plans.dimensions import discount_tier

    rates = ["0", "0.0499", "0.05", "0.1499", "0.15", "0.2999", "0.30", "1"]
    df = frame([(Decimal(r),) for r in rates], "r decimal(10,4)")
    assert [r.t for r in df.select(discount_tier("r").alias("t")).collect()] == [
        "No Discount", "Low (<5%)", "Medium (5-15%)", "Medium (5-15%)", "High (15-30%)", "High (15-30%)",
        "Deep (30%+)", "Deep (30%+)",
    ]


def test_date_key(frame):
    df = frame([(ts("2011-05-31T13:00:00"),), (None,)], "d timestamp")
    got = df.select(c.date_key("d").alias("k"))
    assert dict(got.dtypes) == {"k": "int"} and [r.k for r in got.collect()] == [20110531, -1]


def test_lifecycle_and_activity(frame):
    day = ts("2012-01-01")
    df = frame(
        [(day, None), (None, day), (None, None), (None, ts("2099-01-01"))], "gone timestamp, sell_end timestamp"
    )
    status = c.lifecycle_status("gone", "sell_end", "2013-01-01 00:00:00")
    assert [r.s for r in df.select(status.alias("s")).collect()] == ["Discontinued", "Inactive", "Active", "Active"]
    spans = frame(
        [(day, day), (ts("2011-01-01"), ts("2011-12-31")), (None, day)], "a timestamp, b timestamp"
    )
    active = c.active_between("a", "b", "2012-01-01 00:00:00")
    assert [r.x for r in spans.select(active.alias("x")).collect()] == [True, False, False]


def test_guarded_ratio(frame):
    df = frame([(6, 4), (1, 0)], "n int, d int")
    assert [r.q for r in df.select(c.guarded_ratio(F.col("n"), F.col("d")).alias("q")).collect()] == [1.5, None]


def test_fiscal_calendar(frame):
    from terrace.functions.calendar import fiscal_quarter, fiscal_year

    days = [ts(d) for d in ("2011-06-30", "2011-07-01", "2011-10-01", "2012-01-01", "2012-04-01")]
    df = frame([(d.date(),) for d in days], "d date")
    got = df.select(fiscal_year(F.col("d"), 7).alias("y"), fiscal_quarter(F.col("d"), 7).alias("q")).collect()
    assert [tuple(r) for r in got] == [(2011, 4), (2012, 1), (2012, 2), (2012, 3), (2012, 4)]
    january = df.select(fiscal_year(F.col("d"), 1).alias("y"), fiscal_quarter(F.col("d"), 1).alias("q")).collect()
    assert [tuple(r) for r in january] == [(2011, 2), (2011, 3), (2011, 4), (2012, 1), (2012, 2)]


def test_packed_keys_are_given_back(spark):
    keys = ["d41d8cd98f00b204e9800998ecf8427e", "D41D8CD98F00B204E9800998ECF8427E", "-1", "", "sixteen letters!", "g" * 32, "é-1", None]
    df = spark.createDataFrame([(k,) for k in keys], "k string").select("k", c.packed("k").alias("p"))
    rows = df.select("k", c.unpacked("p").alias("back"), F.length("p").alias("n")).collect()
    assert [r.back for r in rows] == keys
    assert rows[0].n == 16 and all(r.n is None or r.n > 16 for r in rows[1:])
    assert df.select("p").distinct().count() == len(keys)
