import random

import pytest
from conftest import rows_of, ts
from pyspark.sql import functions as F

from terrace.operators.incremental import (
    DuplicateKeys,
    apply_changes,
    change_report,
    incremental_slice,
    merge_upsert,
    number_from,
)

NOW = "2020-01-01 00:00:00"


def test_merge_updates_inserts_and_keeps(frame):
    target = frame([(1, "a"), (2, "b")], "k int, v string")
    batch = frame([(2, "B"), (3, "C")], "k int, v string")
    merged = merge_upsert(target, batch, ["k"])
    assert rows_of(merged) == [(1, "a"), (2, "B"), (3, "C")]
    assert rows_of(merge_upsert(merged, batch, ["k"])) == rows_of(merged)
    assert rows_of(merge_upsert(None, batch, ["k"])) == rows_of(batch)
    assert rows_of(merge_upsert(target.limit(0), batch, ["k"])) == rows_of(batch)


def test_merge_evolves_columns(frame):
    target = frame([(1, "a", 7), (2, "b", 8)], "k int, v string, old int")
    batch = frame([(2, "B", True)], "k int, v string, fresh boolean")
    merged = merge_upsert(target, batch, ["k"])
    assert merged.columns == ["k", "v", "old", "fresh"]
    assert rows_of(merged) == [(1, "a", 7, None), (2, "B", None, True)]


def test_merge_rejects_a_key_twice(frame):
    with pytest.raises(DuplicateKeys, match="'k': 1"):
        merge_upsert(None, frame([(1, "a"), (1, "b")], "k int, v string"), ["k"])


def test_slice(frame):
    src = frame([(i, ts(f"2014-01-{i:02d}")) for i in range(1, 11)], "id int, at timestamp")
    assert incremental_slice(src, None, "at", "at", 2).count() == 10
    assert incremental_slice(src, src.limit(0), "at", "at", 2).count() == 10
    target = src.filter("id <= 8")
    assert [r[0] for r in rows_of(incremental_slice(src, target, "at", "at", 2), "id")] == [10, 6, 7, 8, 9]
    no_times = target.withColumn("at", F.lit(None).cast("timestamp"))
    assert incremental_slice(src, no_times, "at", "at", 2).count() == 10


def test_slice_pushes_the_cutoff_into_the_scan(spark, frame, tmp_path):
    frame([(i, ts(f"2014-01-{i:02d}")) for i in range(1, 11)], "id int, at timestamp").write.parquet(str(tmp_path / "t"))
    src = spark.read.parquet(str(tmp_path / "t"))
    plan = incremental_slice(src, src.filter("id < 5"), "at", "at", 2)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(at,ScalarSubquery" in plan


def test_numbers_are_dense_across_blocks(spark):
    picked = [3, 4, 9, 10, 11, 25, 26, 99, 2**60, 2**61 + 7]
    df = spark.createDataFrame([(p,) for p in picked], "seq bigint")
    out = number_from(df, "seq", F.lit(100), "id", blocks=4)
    assert rows_of(out.orderBy("seq"), "seq", "id") == sorted(
        [(p, 101 + i) for i, p in enumerate(picked)], key=lambda r: tuple((False, str(v)) for v in r)
    )


TABLE = "CustomerID string, Name string, City string, rowguid string, ModifiedDate string"
CHANGES = "change_seq bigint, op string, CustomerID string, Name string, City string"


def test_change_batch(frame):
    table = frame(
        [("1", "a", "x", "g1", "old"), ("2", "b", "y", "g2", "old"), ("3", "c", "z", "g3", "old")], TABLE
    )
    changes = frame(
        [
            (1, "insert", "", "new", None),
            (2, "insert", "7", " seven ", "q"),
            (3, "update", "1", " ", "X"),
            (4, "update", "1", "A", ""),
            (5, "delete", "2", None, None),
            (6, "update", "2", "ghost", None),
            (7, "delete", "99", None, None),
            (8, "update", "3", None, "  "),
            (9, "INSERT", None, "last", "w"),
            (10, "update", "9", "named", None),
        ],
        CHANGES,
    )
    out = apply_changes(table, changes, "CustomerID", NOW)
    assert out.columns == table.columns
    # inserts without a key are numbered after the largest key in use, 7; nothing to change leaves 3 alone
    assert rows_of(out, "CustomerID", "Name", "City", "ModifiedDate") == [
        ("1", "A", "X", NOW),
        ("3", "c", "z", "old"),
        ("7", "seven", "q", NOW),
        ("8", "new", None, NOW),
        ("9", "named", "w", NOW),
    ]
    guids = {r.CustomerID: r.rowguid for r in out.collect()}
    assert guids["1"] == "g1" and len(guids["8"]) == 36 and guids["8"] == guids["8"].upper()
    assert rows_of(change_report(table, changes, "CustomerID")) == [("delete", 2, 2, 1, 1), ("update", 5, 4, 3, 3)]


def test_change_batch_on_an_empty_table(frame):
    out = apply_changes(frame([], TABLE), frame([(1, "insert", None, "n", "c")], CHANGES), "CustomerID", NOW)
    assert rows_of(out, "CustomerID", "Name") == [("1", "n")]


def replay(rows, changes):
    """The batch one request at a time."""
    rows = [dict(r) for r in rows]
    used = [int(r["CustomerID"]) for r in rows]
    used += [int(c["CustomerID"]) for c in changes if c["op"] == "insert" and (c["CustomerID"] or "").strip()]
    following = max(used, default=0)
    for c in sorted(changes, key=lambda c: c["change_seq"]):
        clean = {f: (c[f] or "").strip() or None for f in ("CustomerID", "Name", "City")}
        if c["op"] == "insert":
            if clean["CustomerID"] is None:
                following += 1
                clean["CustomerID"] = str(following)
            rows.append({**clean, "ModifiedDate": NOW})
        elif c["op"] == "update":
            fields = {f: v for f, v in clean.items() if v is not None and f != "CustomerID"}
            for row in rows:
                if fields and row["CustomerID"] == clean["CustomerID"]:
                    row.update(fields, ModifiedDate=NOW)
        else:
            rows = [r for r in rows if r["CustomerID"] != clean["CustomerID"]]
    return sorted((r["CustomerID"], r["Name"], r["City"], r["ModifiedDate"]) for r in rows)


@pytest.mark.parametrize("seed", range(4))
def test_change_batch_equals_one_by_one(frame, seed):
    rng = random.Random(seed)
    rows = [
        {"CustomerID": str(k), "Name": f"n{k}", "City": f"c{k}", "ModifiedDate": "old"} for k in range(1, 6)
    ]
    changes = []
    for seq in range(30):
        op = rng.choice(["insert", "update", "update", "delete"])
        key = str(rng.randint(1, 9)) if op != "insert" or rng.random() < 0.6 else None
        changes.append(
            {"change_seq": seq, "op": op, "CustomerID": key, "Name": rng.choice([None, " ", f"N{seq}"]) if op == "update"
             else f"I{seq}", "City": rng.choice(["", f"C{seq}"]) if op == "update" else f"K{seq}"}
        )
    table = frame([(r["CustomerID"], r["Name"], r["City"], "g", "old") for r in rows], TABLE)
    batch = frame([tuple(c[f] for f in ("change_seq", "op", "CustomerID", "Name", "City")) for c in changes], CHANGES)
    got = apply_changes(table, batch, "CustomerID", NOW)
    assert sorted(tuple(r) for r in got.select("CustomerID", "Name", "City", "ModifiedDate").collect()) == replay(
        rows, changes
    )


def test_merge_within_equals_the_plain_merge(frame):
    target = frame(
        [("a", 1, "old"), ("b", 5, "old"), ("c", 6, "old"), ("d", None, "old"), ("e", 9, "old"), (None, 6, "old"), ("c", 7, "again")],
        "k string, at int, v string",
    )
    for keys in (["b", "c", "x"], ["d"], ["x"], [None, "e"], []):
        updates = frame([(k, 50, "new") for k in keys], "k string, at int, v string")
        plain = merge_upsert(target, updates, ["k"], check_unique=False)
        assert rows_of(merge_upsert(target, updates, ["k"], check_unique=False, within="at")) == rows_of(plain)


def test_merge_within_shuffles_whole_rows_only_there(spark, tmp_path):
    wide = spark.range(1000).selectExpr("md5(cast(id AS string)) AS k", "cast(id AS int) AS at", "cast(id AS string) AS v")
    wide.write.parquet(f"{tmp_path}/target")
    target = spark.read.parquet(f"{tmp_path}/target")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = merge_upsert(target, target.filter("at >= 990").withColumn("v", F.lit("new")), ["k"], check_unique=False, within="at")
        text = merged._jdf.queryExecution().executedPlan().toString()
        assert merged.filter("v = 'new'").count() == 10 and merged.count() == 1000
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    near = text[text.index("LeftAnti"):]
    assert near.index("Subquery") < near.index("FileScan")  # the filter on ``at`` lies below the join
