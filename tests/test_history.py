from conftest import rows_of, ts

from terrace.operators.history import keys_open_twice, open_versions, scd2_dimension, scd2_history, scd2_snapshot
from terrace.plans.history import CLOSED_AT, fold_stored
from terrace.sources.tables import partition_values, stored

T1, T2, T3, T4 = "2013-01-01 00:00:00", "2014-01-01 00:00:00", "2015-01-01 00:00:00", "2016-01-01 00:00:00"
SCHEMA = "bk int, price int, note string"


def snap(history, rows, frame, as_of, **kw):
    return scd2_snapshot(history, frame(rows, SCHEMA), "bk", ["price"], as_of, **kw)


def test_all_outcomes(frame):
    first = snap(None, [(1, 10, "a"), (2, 20, "b"), (3, None, "c"), (4, 40, "d"), (5, 50, "e")], frame, T1)
    assert rows_of(open_versions(first)) == [(5,)]
    # unchanged, changed, NULL to value, value to NULL, gone, new
    second = snap(first, [(1, 10, "z"), (2, 21, "b"), (3, 30, "c"), (4, None, "d"), (6, 60, "f")], frame, T2)
    t1, t2 = ts(T1), ts(T2)
    assert rows_of(second, "bk", "price", "note", "valid_from", "valid_to") == [
        (1, 10, "a", t1, None),
        (2, 20, "b", t1, t2),
        (2, 21, "b", t2, None),
        (3, 30, "c", t2, None),
        (3, None, "c", t1, t2),
        (4, 40, "d", t1, t2),
        (4, None, "d", t2, None),
        (5, 50, "e", t1, t2),
        (6, 60, "f", t2, None),
    ]
    # a key that comes back opens a version; closed ones stay
    third = snap(second, [(1, 10, "z"), (2, 21, "b"), (3, 30, "c"), (4, None, "d"), (5, 50, "e"), (6, 60, "f")],
                 frame, T3)
    assert third.count() == second.count() + 1
    assert rows_of(scd2_history(third, "bk", 5), "valid_from", "valid_to") == [
        (t1, t2), (ts(T3), None)
    ]
    assert third.select("scd_id").distinct().count() == third.count()
    assert keys_open_twice(third, "bk").isEmpty()


def test_unchanged_input_adds_nothing(frame):
    rows = [(1, 10, "a"), (2, None, "b")]
    first = snap(None, rows, frame, T1)
    again = snap(first, rows, frame, T2)
    assert rows_of(again) == rows_of(first)


def test_first_load_can_be_backdated(frame):
    first = snap(None, [(1, 10, "a")], frame, T1, initial_valid_from="1900-01-01 00:00:00")
    assert rows_of(first, "valid_from", "updated_at") == [(ts("1900-01-01"), ts(T1))]
    second = snap(first, [(1, 11, "a")], frame, T2, initial_valid_from="1900-01-01 00:00:00")
    assert rows_of(second, "price", "valid_from", "valid_to") == [
        (10, ts("1900-01-01"), ts(T2)), (11, ts(T2), None)
    ]


def test_everything_vanishes(frame):
    first = snap(None, [(1, 10, "a"), (2, 20, "b")], frame, T1)
    gone = snap(first, [], frame, T2)
    assert rows_of(gone, "bk", "valid_to") == [(1, ts(T2)), (2, ts(T2))]


def test_new_and_dropped_columns(frame):
    first = snap(None, [(1, 10, "a"), (2, 20, "b")], frame, T1)
    wider = frame([(1, 11, "new"), (2, 20, "same")], "bk int, price int, extra string")
    second = scd2_snapshot(first, wider, "bk", ["price"], T2)
    assert rows_of(second, "bk", "price", "note", "extra") == [
        (1, 10, "a", None), (1, 11, None, "new"), (2, 20, "b", None)
    ]


def test_keys_open_twice(frame):
    first = snap(None, [(1, 10, "a"), (2, 20, "b")], frame, T1)
    doubled = first.unionByName(first.filter("bk = 2"))
    assert rows_of(keys_open_twice(doubled, "bk")) == [(2, 2)]


def test_dimension_columns(frame):
    first = snap(None, [(1, 10, "a")], frame, T1)
    dim = scd2_dimension(snap(first, [], frame, T2), "sk", ["bk", "price"])
    assert dim.columns == ["sk", "bk", "price", "valid_from", "valid_to", "is_current", "is_unknown"]
    assert rows_of(dim, "is_current", "is_unknown") == [(False, False)]


def test_many_runs_are_read_from_few_partitions(spark, tmp_path):
    base = str(tmp_path / "h")
    rounds = [
        (f"2020-01-{1 + n // 24:02d} {n % 24:02d}:00:00", spark.createDataFrame([(k, str((n + k) // 3)) for k in range(5)], "k int, v string"))
        for n in range(10)
    ]
    stored_history = fold_stored(rounds, "k", ["v"], base, fan=2)
    lazy = None
    for as_of, current in rounds:
        lazy = stored(scd2_snapshot(lazy, current, "k", ["v"], as_of), "h")
    columns = ["k", "v", "valid_from", "valid_to"]
    assert rows_of(stored_history, *columns) == rows_of(lazy, *columns)
    # Open versions, this run, the two before, and one range.
    assert len(partition_values(spark, base, CLOSED_AT)) <= 5
    assert len([p for p in (tmp_path / "h").iterdir() if p.name.startswith("run=")]) <= 10


def test_the_last_run_can_be_repeated_after_a_merge(spark, tmp_path):
    base = str(tmp_path / "h")
    rounds = [(f"2020-01-0{n + 1} 00:00:00", spark.createDataFrame([(1, str(n)), (2, "x")], "k int, v string")) for n in range(4)]
    once = rows_of(fold_stored(rounds, "k", ["v"], base, fan=2))
    assert rows_of(fold_stored(rounds[-1:], "k", ["v"], base, fan=2)) == once
