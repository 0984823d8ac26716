"""Physical plans: what is pushed down, pre-aggregated and kept free of Python."""

import re

import pytest
from pyspark.sql import functions as F

from terrace.operators.dimensions import date_dimension
from terrace.operators.incremental import merge_upsert
from terrace.operators.latest import dedupe_latest
from terrace.plans.dimensions import dim_date
from terrace.plans.sales import MART_PRODUCT, sales_fact, sales_mart
from terrace.quality.checks import not_null
from terrace.quality.suite import run_suite
from terrace.showcase import QUERIES
from terrace.showcase.operators import allocated_lines
from terrace.showcase.quality import SUITE_ITEMS
from terrace.showcase.registry import Tables
from terrace.showcase.warehouse import fact, fact_dimensions, lines_enriched, stg_header

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture
def t(spark):
    return Tables(spark, FOLDER)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dedupe_limits_groups_before_the_shuffle(t):
    lines = plan(dedupe_latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")).splitlines()
    kinds = [line for line in lines if "WindowGroupLimit" in line or "Exchange" in line]
    assert "Final" in kinds[0] and "Exchange" in kinds[1] and "Partial" in kinds[2]
    assert len(kinds) == 3


def test_filters_and_columns_reach_the_scan(t):
    text = plan(not_null(t.orders, "o_orderpriority", where="o_orderstatus <> 'P'").select("o_orderkey"))
    assert "IsNull(o_orderpriority)" in text and "Not(EqualTo(o_orderstatus,P))" in text
    assert "o_totalprice" not in text


def test_merge_joins_keys_only(t):
    text = plan(merge_upsert(t.orders, t.orders.filter("o_orderkey < 9"), ["o_orderkey"]))
    assert "LeftAnti" in text
    # once for the kept rows, once for the keys, once for the new rows
    assert sorted(s.split("]")[0].count("#") for s in text.split("FileScan parquet [")[1:]) == [1, 6, 6]


def test_row_local_checks_share_one_pass(t):
    lines = t.lineitem.selectExpr("*", "CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS rated_suppkey")
    local = [c for c in SUITE_ITEMS if c.test not in ("unique", "unique_combination", "relationships")]
    text = plan(run_suite(lines, "lineitem", local))
    assert text.count("FileScan") == 1 and text.count("Exchange") == 1


def test_allocation_shuffles_lines_once(spark, t):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(allocated_lines(t))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("Exchange hashpartitioning") == 2 and text.count("FileScan") == 2  # lines and headers
    assert text.count("SortMergeJoin") == 1


def test_allocation_divides_in_few_steps(t):
    # More columns between the windows than this made a method too large to be compiled.
    between = plan(allocated_lines(t)).split("Window [")[1].splitlines()
    assert sum("Project [" in line for line in between) <= 4


def dealt_by(df, spark):
    """The columns of every shuffle when nothing is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(df())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [re.sub(r"#\d+L?", "", line.split("hashpartitioning(")[1]) for line in text.splitlines() if "Exchange hashpartitioning(" in line]


def test_fact_looks_up_customers_by_order(spark, t):
    dims = fact_dimensions(t)
    keys = dealt_by(lambda: fact(t, dims), spark)
    assert not any(k.startswith("customer_bk,") for k in keys)  # headers are already dealt by it
    by_line = dealt_by(lambda: sales_fact(lines_enriched(t), dims), spark)
    assert any(k.startswith("customer_bk,") for k in by_line)
    whole = sales_fact(lines_enriched(t), dims)
    assert fact(t, dims).exceptAll(whole).count() == 0 and whole.count() == fact(t, dims).count()


def test_mart_shuffles_orders_without_measures(spark, t):
    dims = {**fact_dimensions(t), "dim_date": dim_date(stg_header(t))}
    text = plan(sales_mart(fact(t, dims, MART_PRODUCT), dims))
    keys = [line.split("keys=[")[1].split("]")[0] for line in text.splitlines() if "partial_sum(" in line]
    assert keys and all("_part" in k and "territory_name" not in k and "sales_order_bk" not in k for k in keys)


def test_carried_product_columns_are_those_of_the_lookup(spark, t):
    dims = {**fact_dimensions(t), "dim_date": dim_date(stg_header(t))}
    few = dims["dim_product"].filter("product_sk = '-1' OR product_bk % 3 <> 0")
    dims = {**dims, "dim_product": few.withColumn("standard_cost", F.when(F.col("product_sk") == "-1", F.lit(2)).otherwise(F.col("standard_cost")))}
    once, twice = sales_mart(fact(t, dims, MART_PRODUCT), dims), sales_mart(fact(t, dims), dims)
    assert once.filter("category_name = 'Unknown'").count() > 0
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


def test_date_dimension_scans_once(t):
    assert plan(date_dimension(t.orders, ["o_orderdate"])).count("FileScan") == 1


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_python_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, FOLDER))
    for operator in ("ArrowEvalPython", "BatchEvalPython", "MapInPandas", "CartesianProduct"):
        assert operator not in text
    # the only nested loop joins two one-row totals
    if name not in ("dq_reconcile", "mart_fact_reconciliation"):
        assert "BroadcastNestedLoopJoin" not in text
