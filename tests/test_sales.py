"""The sales fact and mart on tables of their own: what is shuffled, and that the rows stay those of plain joins."""

import re

import pytest
from pyspark.sql import functions as F

from star_tables import star_tables
from terrace.plans import sales
from terrace.showcase import warehouse


@pytest.fixture(scope="module")
def t(spark, tmp_path_factory):
    return star_tables(spark, tmp_path_factory.mktemp("star"))


def same(a, b):
    return a.count() == b.count() and a.exceptAll(b.select(a.columns)).isEmpty()


def exchanges(spark, build):
    """What every shuffle is dealt by when nothing but hinted tables is broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = build()._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    return [re.sub(r"#\d+L?", "", x.split("hashpartitioning(")[1]).split(", ")[0] for x in text.splitlines() if "Exchange hashpartitioning(" in x]


def odd_dimensions(t):
    """Products that are missing, that are valid twice at a time, and keys that are no digests."""
    dims = warehouse.fact_dimensions(t)
    products = dims["dim_product"].filter("product_bk % 4 <> 1")
    again = products.filter("product_bk % 5 = 0").withColumn("product_sk", F.concat(F.lit("again "), "product_sk"))
    return {**dims, "dim_product": products.unionByName(again)}


def test_fact_deals_lines_by_product_before_they_carry_their_header(spark, t):
    dims = warehouse.fact_dimensions(t)
    keys = exchanges(spark, lambda: warehouse.fact(t, dims))
    assert keys.count("l_partkey") == 1  # lines as read, whose header is joined afterwards


def test_fact_is_that_of_plain_joins(t):
    dims = odd_dimensions(t)
    whole = sales.sales_fact(warehouse.lines_enriched(t), dims)
    assert same(warehouse.fact(t, dims), whole)
    assert whole.filter("product_sk = '-1'").count() > 0 and whole.filter("product_sk LIKE 'again %'").count() > 0
    assert whole.count() > warehouse.lines_enriched(t).count()


def test_products_of_many_versions_are_looked_up_by_line(monkeypatch, t):
    dims = odd_dimensions(t)
    few = warehouse.keyed_lines(t, dims)
    monkeypatch.setattr(sales, "MOST_VERSIONS", 1)
    many = warehouse.keyed_lines(t, dims)
    assert sales.PRODUCT_VERSIONS in few.columns and sales.PRODUCT_VERSIONS not in many.columns
    assert same(sales.sales_fact(few, dims), sales.sales_fact(many, dims))


def test_ship_methods_are_written_before_headers_meet_them(t):
    lines = warehouse.fact(t, warehouse.fact_dimensions(t))
    assert any("/stg_ship_method-" in f for f in lines.inputFiles())
    assert "HashAggregate(keys=[ship_method_bk" not in lines._jdf.queryExecution().executedPlan().toString()


def test_mart_counts_orders_by_marks(spark, t):
    dims = warehouse.mart_dimensions(t)
    marked, grouped = warehouse.marked_fact(t, dims)
    plain = sales.sales_mart(warehouse.fact(t, dims, sales.MART_PRODUCT), dims)
    by_marks = sales.sales_mart(marked, grouped)
    assert same(by_marks, plain) and plain.filter("line_count > order_count").count() > 0
    assert plain.filter("category_name = 'Unknown'").count() > 0
    text = by_marks._jdf.queryExecution().executedPlan().toString()
    assert "_part#" not in text and "partial_sum" in text


def test_order_marks_shuffle_no_lines(spark, t):
    dims = warehouse.mart_dimensions(t)
    grouped = sales.grouped_dimensions(dims, warehouse.stored(sales.product_groups(dims["dim_product"]), "groups"))
    lines = warehouse.fact(t, grouped, sales.MART_CARRY)

    def shuffles(df):
        text = df._jdf.queryExecution().executedPlan().toString()
        return [text.count(f"Exchange hashpartitioning({key}") for key in ("l_orderkey", "sales_order_bk")]

    assert shuffles(sales.with_order_marks(lines, grouped)) == shuffles(lines)


def test_mart_of_repeated_keys_is_that_of_plain_joins(t):
    dims = warehouse.mart_dimensions(t)
    assert sales.one_row_per_key(dims)
    repeated = {**dims, "dim_product": dims["dim_product"].unionByName(dims["dim_product"].filter("product_bk = 3"))}
    assert not sales.one_row_per_key(repeated)
    whole, mart = warehouse.stored_fact_and_mart(t, repeated)
    assert same(mart, sales.sales_mart(warehouse.fact(t, repeated), repeated))
    assert same(whole, warehouse.fact(t, repeated))


def test_stored_fact_holds_what_the_mart_looks_up(t):
    dims = warehouse.mart_dimensions(t)
    whole, mart = warehouse.stored_fact_and_mart(t, dims)
    assert same(whole, warehouse.fact(t, dims))
    assert same(mart, sales.sales_mart(warehouse.fact(t, dims), dims))


def test_incremental_reads_stored_lines(t):
    files = warehouse.fact_sales_incremental(t).inputFiles()
    assert any("/int_sales_order_line_enriched-" in f for f in files) and not any("lineitem.parquet" in f for f in files)


def test_fact_reads_are_all_that_the_fact_needs(t):
    dims = warehouse.fact_dimensions(t)
    for lines in (warehouse.keyed_lines(t, dims), warehouse.lines_enriched(t)):
        read = set(sales.FACT_READS) | (set() if sales.JUNK_SK in lines.columns else set(lines.columns))
        assert same(sales.sales_fact(lines.select(*[c for c in lines.columns if c in read]), dims), sales.sales_fact(lines, dims))
