import time
from pathlib import Path

import pytest
from conftest import rows_of, ts
from pyspark.sql import functions as F

from terrace.operators.incremental import DuplicateKeys, incremental_slice
from terrace.sources import tables
from terrace.sources.delimited import ingest, read_delimited
from terrace.sources.registry import SOURCES
from terrace.sources.tables import (
    append,
    compact_partitions,
    materialize,
    merge_partitions,
    partition_values,
    read_current,
    read_marks,
    read_partitions,
    retire_runs,
    save_overwrite,
    source,
    write_partitions,
    write_version,
)


def test_registry():
    assert len(SOURCES) == 22
    assert SOURCES["SalesTerritory"].columns[3] == "Group"
    assert [len(SOURCES[t].columns) for t in ("Product", "SalesOrderHeader", "Person")] == [25, 26, 13]
    for spec in SOURCES.values():
        assert set(spec.dedupe_keys) <= set(spec.columns) and spec.columns[-1] == "ModifiedDate"


def test_tab_file(spark, tmp_path):
    (tmp_path / "t.csv").write_text('1\t\tx y\n2\t"q""t"\tz\n', encoding="utf-8")
    df = read_delimited(spark, str(tmp_path / "t.csv"), ["a", "b", "c"])
    assert df.dtypes == [("a", "string"), ("b", "string"), ("c", "string")]
    assert rows_of(df) == [("1", None, "x y"), ("2", 'q"t', "z")]


def test_two_character_separator_over_lines(spark, tmp_path):
    (tmp_path / "t.csv").write_text('1+|"two\nlines"+|é\n2+|+|z|+\n', encoding="utf-8")
    df = read_delimited(spark, str(tmp_path / "t.csv"), ["a", "b", "c"], "+|", True)
    assert rows_of(df) == [("1", "two\nlines", "é"), ("2", None, "z|+")]


def test_ingest_stamps_the_load_time(spark, tmp_path):
    (tmp_path / "ProductCategory.csv").write_text("4\tAccessories\tG\t2008-04-30 00:00:00\n")
    df = ingest(spark, "ProductCategory", str(tmp_path / "ProductCategory.csv"), "2020-01-01 00:00:00")
    assert df.columns == ["ProductCategoryID", "Name", "rowguid", "ModifiedDate", "LoadedAt"]
    assert rows_of(df, "ModifiedDate", "LoadedAt") == [("2008-04-30 00:00:00", "2020-01-01 00:00:00")]


def test_overwrite_append_and_view(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    save_overwrite(frame([(1,), (2,)], "a int"), path)
    save_overwrite(frame([(3,)], "a int"), path)
    append(frame([(4,)], "a int"), path)
    assert rows_of(source(spark, path)) == [(3,), (4,)]
    materialize(frame([(5,)], "a int"), "a_view", "view")
    assert rows_of(source(spark, "a_view")) == [(5,)]
    assert rows_of(materialize(frame([(6,)], "a int"), path, "table")) == [(6,)]
    with pytest.raises(ValueError):
        materialize(frame([(6,)], "a int"), path, "cube")


def test_versions_survive_a_failed_write(spark, frame, tmp_path):
    base = str(tmp_path / "t")
    assert read_current(spark, base) is None
    write_version(frame([(1,)], "a int"), base)
    # a later version without its success marker is not read
    (tmp_path / "t" / "version=2").mkdir()
    assert rows_of(read_current(spark, base)) == [(1,)]
    second = write_version(read_current(spark, base).unionByName(frame([(2,)], "a int")), base)
    assert rows_of(second) == [(1,), (2,)]
    assert rows_of(read_current(spark, base)) == [(1,), (2,)]


def test_merge_rewrites_only_touched_partitions(spark, frame, tmp_path):
    base = str(tmp_path / "t")
    schema = "k int, v string, part int"
    merge_partitions(frame([(1, "a", 1), (2, "b", 2), (3, "c", 3), (4, "d", 4)], schema), base, ["k"], "part")
    # 2 changes, 3 moves and leaves its partition empty, 5 is new
    changes = frame([(2, "B", 2), (3, "C", 5), (5, "e", 2)], schema)
    merged = merge_partitions(changes, base, ["k"], "part", rows_move=True)
    assert rows_of(merged, "k", "v", "part") == [(1, "a", 1), (2, "B", 2), (3, "C", 5), (4, "d", 4), (5, "e", 2)]
    touched = {p.name for p in (tmp_path / "t" / "run=2").iterdir() if "=" in p.name}
    assert touched == {"part=2", "part=3", "part=5"}
    # a run that did not finish is invisible, and its number is not used again
    (tmp_path / "t" / "run=3" / "part=1").mkdir(parents=True)
    assert read_partitions(spark, base).count() == 5
    wider = frame([(4, "D", 4, True)], schema + ", extra boolean")
    assert rows_of(merge_partitions(wider, base, ["k"], "part"), "k", "v", "extra") == [
        (1, "a", None), (2, "B", None), (3, "C", None), (4, "D", True), (5, "e", None)
    ]
    assert (tmp_path / "t" / "run=4" / "_SUCCESS").exists()
    assert merge_partitions(wider.limit(0), base, ["k"], "part").count() == 5


def test_merge_reads_no_other_partition_where_keys_fix_it(spark, frame, tmp_path):
    base = str(tmp_path / "t")
    schema = "k int, v string, part int"
    merge_partitions(frame([(1, "a", 1), (2, "b", 2)], schema), base, ["k"], "part")
    merged = merge_partitions(frame([(2, "B", 2)], schema), base, ["k"], "part")
    assert rows_of(merged, "k", "v", "part") == [(1, "a", 1), (2, "B", 2)]
    assert {p.name for p in (tmp_path / "t" / "run=2").iterdir() if p.is_dir() and "=" in p.name} == {"part=2"}


def test_empty_first_batch_and_empty_partitions(spark, frame, tmp_path):
    base, schema = str(tmp_path / "t"), "k int, v string, part int"
    assert read_partitions(spark, base) is None
    first = merge_partitions(frame([], schema), base, ["k"], "part")
    assert first.columns == ["k", "v", "part"] and first.count() == 0
    assert read_partitions(spark, base).dtypes == first.dtypes
    second = merge_partitions(frame([(1, "a", 3)], schema), base, ["k"], "part")
    assert rows_of(second, "k", "v", "part") == [(1, "a", 3)]
    assert write_partitions(frame([], schema), base, "part", [3]).count() == 0
    assert read_partitions(spark, base).count() == 0


def test_kept_marks_follow_the_newest_run_of_each_partition(spark, frame, tmp_path):
    schema, base = "k int, at timestamp, part int", str(tmp_path / "t")
    assert read_marks(spark, base, "part", ["at"]) is None
    first = frame([(1, ts("2014-01-01"), 1), (2, ts("2014-01-09"), 2), (3, ts("2014-01-05"), 2)], schema)
    merge_partitions(first, base, ["k"], "part", marks=["at"])
    merge_partitions(frame([(4, ts("2014-02-01"), 3)], schema), base, ["k"], "part")  # a run without marks: its partition is scanned
    write_partitions(frame([(2, ts("2014-01-02"), 2)], schema), base, "part", [2, 3], marks=["at"])
    marks = read_marks(spark, base, "part", ["at"])
    assert rows_of(marks, "part", "at_min", "at_max") == [
        (1, ts("2014-01-01"), ts("2014-01-01")), (2, ts("2014-01-02"), ts("2014-01-02")), (3, None, None)
    ]
    src = frame([(d, ts(f"2014-01-{d:02d}")) for d in range(1, 10)], "d int, at timestamp")
    target = read_partitions(spark, base)
    late = incremental_slice(src, target, "at", "at", 1, marks)
    assert rows_of(late, "d") == rows_of(incremental_slice(src, target, "at", "at", 1), "d") == [(d,) for d in range(1, 10)]
    scanned = late._jdf.queryExecution().optimizedPlan().toString()
    assert "part=" not in scanned and f"{base}/run=1/part" not in scanned


def test_a_batch_with_a_repeated_key_is_refused(frame, tmp_path):
    with pytest.raises(DuplicateKeys):
        merge_partitions(frame([(1, 1), (1, 1)], "k int, part int"), str(tmp_path / "t"), ["k"], "part")


def test_superseded_runs_are_retired_and_the_state_before_stays_readable(spark, frame, tmp_path):
    schema, base = "k int, v int, part int", str(tmp_path / "t")
    before = None
    for run in range(1, 8):
        rows = [(k, run, k % 3) for k in range(6) if run == 1 or k % 3 == run % 2]
        merged = merge_partitions(frame(rows, schema), base, ["k"], "part", marks=["v"])
        retire_runs(spark, base)
        want = {k: max(r for r in range(1, run + 1) if r == 1 or k % 3 == r % 2) for k in range(6)}
        assert {r.k: r.v for r in merged.collect()} == want
        if before is not None:
            assert {r.k: r.v for r in before[0].collect()} == before[1]
        before = merged, want
        assert len(list((tmp_path / "t").glob("run=*"))) <= 4
    assert {r.part: r.v_max for r in read_marks(spark, base, "part", ["v"]).collect()} == {0: 6, 1: 7, 2: 1}


def test_given_up_partitions_do_not_return(spark, frame, tmp_path):
    base = str(tmp_path / "t")
    write_partitions(frame([(v, v) for v in range(6)], "p int, x int"), base, "p", list(range(6)), ["x"])
    before = read_partitions(spark, base)
    assert compact_partitions(spark, base, "p", [0, 1, 2], fan=4) == []
    assert compact_partitions(spark, base, "p", [0, 1, 2, 3], fan=4) == [0, 1, 2]
    assert partition_values(spark, base, "p") == [3, 4, 5]
    assert rows_of(read_partitions(spark, base), "x") == rows_of(before, "x")
    assert rows_of(read_marks(spark, base, "p", ["x"])) == [(3, 0, 3), (4, 4, 4), (5, 5, 5)]
    # The first run holds 4 and 5 still, so the one that ended 0 to 2 must stay.
    write_partitions(frame([(3, 9)], "p int, x int"), base, "p", [3])
    write_partitions(frame([(3, 8)], "p int, x int"), base, "p", [3])
    retire_runs(spark, base, states=1)
    assert rows_of(read_partitions(spark, base), "p", "x") == [(3, 8), (4, 4), (5, 5)]


def test_large_partitions_are_not_rewritten_with_small_ones(spark, frame, tmp_path):
    base = str(tmp_path / "t")
    write_partitions(frame([(0, "x" * 20)], "p int, s string").withColumn("s", F.expr("repeat(uuid(), 500)")), base, "p", [0])
    big = frame([(1, k) for k in range(4000)], "p int, k int").withColumn("s", F.expr("md5(cast(k as string))")).select("p", "s")
    write_partitions(big, base, "p", [1])
    write_partitions(frame([(v, "y") for v in range(2, 5)], "p int, s string"), base, "p", [2, 3, 4])
    assert compact_partitions(spark, base, "p", list(range(5)), fan=3, unit=20_000) == [2, 3]
    assert partition_values(spark, base, "p") == [0, 1, 4]


def test_stored_tables_leave_no_shuffle_behind(spark):
    kept = spark.conf.get(tables.CLEANUP, None)
    blocks = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def held():
        return {f for d in blocks.localDirsString() for f in Path(d).rglob("shuffle_*.data")}

    before = held()
    written = tables.stored(spark.range(1000).repartition(4, "id").withColumn("k", F.md5(F.col("id").cast("string"))), "some")
    until = time.time() + 20
    while held() - before and time.time() < until:  # they are deleted in the background
        time.sleep(0.1)
    assert not held() - before
    assert written.count() == 1000 and spark.conf.get(tables.CLEANUP, None) == kept
    assert all(".zstd." in f for f in written.inputFiles())


def test_cleanup_is_restored_after_overlapping_writes(spark):
    spark.conf.set(tables.CLEANUP, "false")
    try:
        tables.stored_all({f"t{i}": spark.range(10) for i in range(6)})
        assert spark.conf.get(tables.CLEANUP) == "false"
    finally:
        spark.conf.unset(tables.CLEANUP)
