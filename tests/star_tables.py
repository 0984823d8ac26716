"""Small analytics tables of a test's own, as ``Tables`` reads them."""

from pyspark.sql import functions as F

from terrace.showcase.registry import Tables

ORDERS, CUSTOMERS, PARTS, SUPPLIERS = 60, 12, 20, 6


def star_tables(spark, folder) -> Tables:
    """Lines come up to four an order, every fifth twice; some orders, parts and customers are not there."""
    ids = spark.range
    k = F.col("id")
    day = F.expr("TIMESTAMP_NTZ '1999-11-01 00:00:00'") + F.make_dt_interval(days=(k * 7 % 120).cast("int"))
    tables = {
        "region": ids(5).select(k.cast("int").alias("r_regionkey"), F.concat(F.lit("REGION"), k.cast("string")).alias("r_name")),
        "nation": ids(5).select(
            k.cast("int").alias("n_nationkey"), F.concat(F.lit("NATION"), k.cast("string")).alias("n_name"), k.cast("int").alias("n_regionkey")
        ),
        "customer": ids(1, CUSTOMERS).select(
            k.alias("c_custkey"), F.concat(F.lit("Customer"), k.cast("string")).alias("c_name"), (k % 5).cast("int").alias("c_nationkey"),
            (k * 100.0 - 300).alias("c_acctbal"), F.element_at(F.array(F.lit("BUILDING"), F.lit("AUTO")), (k % 2 + 1).cast("int")).alias("c_mktsegment"),
        ),
        "supplier": ids(SUPPLIERS).select(
            k.alias("s_suppkey"), F.concat(F.lit("Supplier"), k.cast("string")).alias("s_name"), (k % 5).cast("int").alias("s_nationkey"),
            (k * 2000.0 - 1000).alias("s_acctbal"),
        ),
        "part": ids(PARTS).select(
            k.alias("p_partkey"), F.concat(F.lit("red part "), k.cast("string")).alias("p_name"), F.lit("Brand#1").alias("p_brand"),
            F.lit("SMALL").alias("p_type"), (k * 3 % 50 + 1).cast("int").alias("p_size"), (k * 10 + 0.5).alias("p_retailprice"),
        ),
        "orders": ids(ORDERS).select(
            k.alias("o_orderkey"), (k % (CUSTOMERS + 1)).alias("o_custkey"), F.element_at(F.array(*map(F.lit, "FOP")), (k % 3 + 1).cast("int")).alias("o_orderstatus"),
            (k * 3 + 10.25).alias("o_totalprice"), day.alias("o_orderdate"),
            F.concat((k % 5 + 1).cast("string"), F.lit("-KIND")).alias("o_orderpriority"),
        ),
        "lineitem": ids(4 * ORDERS + 48).select(
            F.when(k < 4 * ORDERS, F.floor(k / 4)).otherwise(F.floor((k - 4 * ORDERS) * 5 / 4)).alias("l_orderkey"),
            (k * 7 % (PARTS + 3)).alias("l_partkey"), (k % SUPPLIERS).alias("l_suppkey"),
            F.when(k < 4 * ORDERS, k % 4 + 1).otherwise((k - 4 * ORDERS) * 5 % 4 + 1).cast("int").alias("l_linenumber"),
            (k % 7 + 1.0).alias("l_quantity"), (k * 1.25 + 3).alias("l_extendedprice"), (k % 9 * 0.01).alias("l_discount"), F.lit(0.02).alias("l_tax"),
            F.lit("N").alias("l_returnflag"), F.lit("O").alias("l_linestatus"), day.alias("l_shipdate"),
        ),
    }
    for name, table in tables.items():
        table.write.parquet(f"{folder}/{name}.parquet")
    return Tables(spark, str(folder))
