"""Each operator on the analytics tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import (
    active_between,
    date_key,
    decode,
    full_name,
    lifecycle_status,
    mask_tail,
    presence_label,
    surrogate_key,
)
from ..operators.allocation import allocate
from ..operators.dimensions import (
    date_dimension,
    flag_combinations,
    junk_dimension,
    junk_lookup,
    with_bridge_count,
    with_unknown_member,
)
from ..operators.history import (
    keys_open_twice,
    open_versions,
    scd2_dimension,
    scd2_history,
)
from ..operators.incremental import apply_changes, change_report, incremental_slice, merge_upsert, number_from
from ..operators.joins import hot_keys, left_join, point_in_time_join
from ..operators.latest import best_per_key, current_assignment, dedupe_latest, duplicate_keys, preview
from ..operators.shape import Level, conform, flatten_hierarchy, lookup_chain, prefix_columns
from ..plans.dimensions import discount_tier
from ..plans.history import fold_rounds, fold_stored
from ..sources.tables import new_folder
from .registry import ORACLES, Tables, query

STATUS = {"F": "Fulfilled", "O": "Open", "P": "Partial"}


def money(col: str) -> Column:
    return F.col(col).cast("decimal(12,2)")


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


# --- shaping and one row per key ---------------------------------------------------


@query("""
SELECT o_orderkey AS order_bk, o_custkey AS customer_bk,
       CASE o_orderstatus WHEN 'F' THEN 'Fulfilled' WHEN 'O' THEN 'Open' WHEN 'P' THEN 'Partial'
            ELSE 'Unknown' END AS order_status,
       CAST(left(o_orderpriority, 1) AS INTEGER) AS priority_code,
       o_orderdate AS order_date,
       CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS order_date_sk,
       CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS total_due
FROM orders
""")
def conform_orders(t: Tables) -> DataFrame:
    return conform(
        t.orders,
        {
            "order_bk": "o_orderkey",
            "customer_bk": "o_custkey",
            "order_status": decode("o_orderstatus", STATUS),
            "priority_code": F.left(F.col("o_orderpriority"), F.lit(1)).cast("int"),
            "order_date": "o_orderdate",
            "order_date_sk": date_key("o_orderdate"),
            "total_due": ("o_totalprice", "decimal(12,2)"),
        },
    )


@query("""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST,
             l_quantity DESC NULLS LAST, l_extendedprice DESC NULLS LAST, l_discount DESC NULLS LAST,
             l_tax DESC NULLS LAST, l_returnflag DESC NULLS LAST, l_linestatus DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1
""")
def dedupe_latest_lines(t: Tables) -> DataFrame:
    return dedupe_latest(t.lineitem, ["l_orderkey", "l_linenumber"], "l_shipdate")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def duplicate_line_keys(t: Tables) -> DataFrame:
    return duplicate_keys(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""
SELECT o_custkey, o_orderkey, o_orderpriority, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey
    ORDER BY o_orderpriority ASC NULLS FIRST, o_orderdate DESC NULLS LAST, o_orderkey ASC) AS rn
  FROM orders) WHERE rn = 1
""")
def best_order_per_customer(t: Tables) -> DataFrame:
    order = [F.col("o_orderpriority").asc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()]
    return best_per_key(t.orders, ["o_custkey"], order).select(
        "o_custkey", "o_orderkey", "o_orderpriority", "o_orderdate"
    )


@query("""
WITH ranked AS (
  SELECT l_partkey, l_suppkey, l_shipdate, row_number() OVER (
    PARTITION BY l_partkey ORDER BY l_shipdate DESC, l_suppkey DESC) AS rn
  FROM lineitem WHERE l_returnflag = 'N')
SELECT p.p_partkey, r.l_suppkey AS current_suppkey, r.l_shipdate AS assigned_at
FROM part p LEFT JOIN ranked r ON r.l_partkey = p.p_partkey AND r.rn = 1
""")
def current_supplier_of_part(t: Tables) -> DataFrame:
    assignments = t.lineitem.select(
        "l_partkey",
        "l_suppkey",
        "l_shipdate",
        F.when(F.col("l_returnflag") != "N", F.col("l_shipdate")).alias("returned_at"),
    )
    current = current_assignment(assignments, ["l_partkey"], "returned_at", "l_shipdate", ["l_suppkey"])
    return t.part.join(current, F.col("p_partkey") == F.col("l_partkey"), "left").select(
        "p_partkey", F.col("l_suppkey").alias("current_suppkey"), F.col("l_shipdate").alias("assigned_at")
    )


@query("""
SELECT s.s_suppkey, s.s_name, coalesce(n.n_name, 'Unassigned') AS n_name, n.n_regionkey,
       coalesce(r.r_name, 'Unassigned') AS r_name
FROM supplier s
LEFT JOIN nation n ON n.n_nationkey = CASE WHEN s.s_acctbal < 0 THEN NULL ELSE s.s_nationkey END
LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
""")
def supplier_hierarchy(t: Tables) -> DataFrame:
    suppliers = t.supplier.withColumn("placed_in", F.when(F.col("s_acctbal") >= 0, F.col("s_nationkey")))
    flat = flatten_hierarchy(
        suppliers,
        [
            Level(t.nation, "n_nationkey", "placed_in", {"n_name": "Unassigned"}, ["n_regionkey"]),
            Level(t.region, "r_regionkey", "n_regionkey", {"r_name": "Unassigned"}),
        ],
    )
    return flat.select("s_suppkey", "s_name", "n_name", "n_regionkey", "r_name")


@query("""
SELECT c_custkey, n_name, r_name, o_orderkey, o_orderpriority FROM (
  SELECT c.c_custkey, n.n_name, r.r_name, o.o_orderkey, o.o_orderpriority, row_number() OVER (
    PARTITION BY c.c_custkey
    ORDER BY o.o_orderpriority ASC NULLS FIRST, o.o_orderdate DESC NULLS LAST, o.o_orderkey ASC) AS rn
  FROM customer c
  LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey
  LEFT JOIN orders o ON o.o_custkey = c.c_custkey) WHERE rn = 1
""")
def best_order_chain(t: Tables) -> DataFrame:
    order = [F.col("o_orderpriority").asc(), F.col("o_orderdate").desc_nulls_last(), F.col("o_orderkey").asc()]
    best = best_per_key(t.orders, ["o_custkey"], order).select("o_custkey", "o_orderkey", "o_orderpriority")
    reached = lookup_chain(
        t.customer,
        [(t.nation, "n_nationkey", "c_nationkey"), (t.region, "r_regionkey", "n_regionkey"),
         (best, "o_custkey", "c_custkey")],
    )
    return reached.select("c_custkey", "n_name", "r_name", "o_orderkey", "o_orderpriority")


@query("""
SELECT o_orderkey, o_custkey, o_orderdate AS order_orderdate, CAST(o_totalprice AS DOUBLE) AS order_totalprice
FROM orders
""")
def order_prefixed_columns(t: Tables) -> DataFrame:
    plain = t.orders.withColumnsRenamed({"o_orderdate": "orderdate", "o_totalprice": "totalprice"})
    return prefix_columns(plain, "order_", ["orderdate", "totalprice"]).select(
        "o_orderkey", "o_custkey", "order_orderdate", "order_totalprice"
    )


@query("SELECT c_custkey, c_name, c_mktsegment FROM customer ORDER BY c_custkey LIMIT 10")
def preview_customers(t: Tables) -> DataFrame:
    return preview(t.customer.select("c_custkey", "c_name", "c_mktsegment"), 10, ["c_custkey"])


@query("""
SELECT CAST(max(c_custkey) AS BIGINT) AS max_key, count(*) FILTER (c_acctbal < 0) AS debtors,
       count(c_mktsegment) AS with_segment, min(c_acctbal) AS lowest, max(c_acctbal) AS highest FROM customer
""")
def customer_high_water_mark(t: Tables) -> DataFrame:
    return t.customer.agg(
        F.coalesce(F.max("c_custkey"), F.lit(0)).alias("max_key"),
        F.count_if(F.col("c_acctbal") < 0).alias("debtors"),
        F.count("c_mktsegment").alias("with_segment"),
        F.min("c_acctbal").alias("lowest"),
        F.max("c_acctbal").alias("highest"),
    )


# --- column builders ---------------------------------------------------------------


@query("""
WITH f AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'F'),
     p AS (SELECT DISTINCT o_custkey FROM orders WHERE o_orderstatus = 'P')
SELECT c.c_custkey,
       CASE WHEN f.o_custkey IS NOT NULL AND p.o_custkey IS NOT NULL THEN 'Both'
            WHEN f.o_custkey IS NOT NULL THEN 'FulfilledOnly'
            WHEN p.o_custkey IS NOT NULL THEN 'PartialOnly' ELSE 'Neither' END AS customer_type
FROM customer c LEFT JOIN f ON f.o_custkey = c.c_custkey LEFT JOIN p ON p.o_custkey = c.c_custkey
""")
def customer_type(t: Tables) -> DataFrame:
    def with_status(status: str, name: str) -> DataFrame:
        return t.orders.filter(F.col("o_orderstatus") == status).select(F.col("o_custkey").alias(name)).distinct()

    joined = lookup_chain(
        t.customer,
        [(with_status("F", "fulfilled"), "fulfilled", "c_custkey"), (with_status("P", "partial"), "partial", "c_custkey")],
    )
    labels = {(True, True): "Both", (True, False): "FulfilledOnly", (False, True): "PartialOnly",
              (False, False): "Neither"}
    return joined.select("c_custkey", presence_label("fulfilled", "partial", labels).alias("customer_type"))


@query("""
SELECT c_custkey,
       repeat('X', CAST(greatest(length(c_name) - 4, 0) AS INTEGER)) || right(c_name, 4) AS masked_name,
       concat_ws(' ', c_mktsegment, nullif(CASE WHEN c_acctbal < 0 THEN '' ELSE 'B' END, ''), c_name,
                 nullif(CASE WHEN c_nationkey < 5 THEN 'Jr.' ELSE '' END, '')) AS full_name
FROM customer
""")
def mask_and_names(t: Tables) -> DataFrame:
    middle = F.when(F.col("c_acctbal") < 0, "").otherwise("B")
    suffix = F.when(F.col("c_nationkey") < 5, "Jr.").otherwise("")
    return t.customer.select(
        "c_custkey",
        mask_tail("c_name").alias("masked_name"),
        full_name("c_mktsegment", middle, "c_name", suffix).alias("full_name"),
    )


@query("""
SELECT CASE WHEN d = 0 THEN 'No Discount' WHEN d < 0.05 THEN 'Low (<5%)' WHEN d < 0.15 THEN 'Medium (5-15%)'
            WHEN d < 0.30 THEN 'High (15-30%)' ELSE 'Deep (30%+)' END AS discount_tier,
       count(*) AS line_count,
       CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DOUBLE) AS gross_revenue
FROM (SELECT *, CAST(l_discount AS DECIMAL(10,4)) AS d FROM lineitem) GROUP BY 1
""")
def price_tiers(t: Tables) -> DataFrame:
    return (
        t.lineitem.groupBy(discount_tier(F.col("l_discount").cast("decimal(10,4)")).alias("discount_tier"))
        .agg(F.count("*").alias("line_count"), F.sum(money("l_extendedprice")).alias("gross_revenue"))
    )


@query("""
SELECT p.p_partkey, CASE WHEN p.p_type = 'ECONOMY' THEN l.last_ship END AS discontinued_at,
       l.last_ship AS sell_end_at,
       CASE WHEN p.p_type = 'ECONOMY' AND l.last_ship IS NOT NULL THEN 'Discontinued'
            WHEN l.last_ship < TIMESTAMP '2001-06-01' THEN 'Inactive' ELSE 'Active' END AS product_status,
       coalesce(TIMESTAMP '2001-06-01' BETWEEN l.first_ship AND l.last_ship, false) AS is_active
FROM part p LEFT JOIN (
  SELECT l_partkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
  FROM lineitem GROUP BY l_partkey) l ON l.l_partkey = p.p_partkey
""")
def part_lifecycle(t: Tables) -> DataFrame:
    as_of = ntz("2001-06-01 00:00:00")
    shipped = t.lineitem.groupBy("l_partkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("sell_end_at")
    )
    dated = t.part.join(shipped, F.col("p_partkey") == F.col("l_partkey"), "left").withColumn(
        "discontinued_at", F.when(F.col("p_type") == "ECONOMY", F.col("sell_end_at"))
    )
    return dated.select(
        "p_partkey",
        "discontinued_at",
        "sell_end_at",
        lifecycle_status("discontinued_at", "sell_end_at", as_of).alias("product_status"),
        active_between("first_ship", "sell_end_at", as_of).alias("is_active"),
    )


# --- dimensions ----------------------------------------------------------------------


@query("""
WITH offers AS (
  SELECT p_type AS offer_type, min(l_shipdate) AS start_at, max(l_shipdate) AS end_at,
         max(CAST(l_discount AS DECIMAL(10,4))) AS discount_pct
  FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY p_type),
 parts AS (SELECT p_type, count(*) AS n FROM part WHERE p_size > 25 GROUP BY p_type)
SELECT md5(offer_type) AS offer_sk, offer_type, start_at, end_at, CAST(discount_pct AS DOUBLE) AS discount_pct,
       CASE WHEN discount_pct = 0 THEN 'No Discount' WHEN discount_pct < 0.05 THEN 'Low (<5%)'
            WHEN discount_pct < 0.15 THEN 'Medium (5-15%)' WHEN discount_pct < 0.30 THEN 'High (15-30%)'
            ELSE 'Deep (30%+)' END AS discount_tier,
       TIMESTAMP '1998-01-01' BETWEEN start_at AND end_at AS is_active,
       coalesce(parts.n, 0) AS eligible_product_count, false AS is_unknown
FROM offers LEFT JOIN parts ON parts.p_type = offer_type
UNION ALL
SELECT '-1', 'Unknown', NULL, NULL, 0, 'No Discount', false, 0, true
""")
def offer_dim(t: Tables) -> DataFrame:
    offers = (
        t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey"))
        .groupBy(F.col("p_type").alias("offer_type"))
        .agg(
            F.min("l_shipdate").alias("start_at"),
            F.max("l_shipdate").alias("end_at"),
            F.max(F.col("l_discount").cast("decimal(10,4)")).alias("discount_pct"),
        )
    )
    bridge = t.part.filter("p_size > 25").select(F.col("p_type").alias("offer_type"))
    described = with_bridge_count(offers, bridge, "offer_type", "eligible_product_count").select(
        surrogate_key("offer_type").alias("offer_sk"),
        "offer_type",
        "start_at",
        "end_at",
        "discount_pct",
        discount_tier("discount_pct").alias("discount_tier"),
        active_between("start_at", "end_at", ntz("1998-01-01 00:00:00")).alias("is_active"),
        "eligible_product_count",
        F.lit(False).alias("is_unknown"),
    )
    return with_unknown_member(
        described,
        {"offer_sk": "-1", "offer_type": "Unknown", "discount_pct": "0", "discount_tier": "No Discount",
         "is_active": False, "eligible_product_count": 0, "is_unknown": True},
    )


JUNK_DEFAULTS = {
    "o_orderstatus": "Unknown",
    "o_orderpriority": "Unknown",
    "l_returnflag": "Unknown",
    "l_linestatus": "Unknown",
}
JUNK_SQL = """
WITH flags AS (
  SELECT l_orderkey, l_linenumber, o_orderstatus, nullif(o_orderpriority, '4-NOT SPECIFIED') AS o_orderpriority,
         l_returnflag, l_linestatus
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
junk AS (
  SELECT md5(concat_ws('-', o_orderstatus, o_orderpriority, l_returnflag, l_linestatus)) AS junk_sk, *
  FROM (SELECT DISTINCT o_orderstatus, coalesce(o_orderpriority, 'Unknown') AS o_orderpriority,
               l_returnflag, l_linestatus FROM flags))
"""


def _line_flags(t: Tables) -> DataFrame:
    stated = F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    return t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "o_orderstatus", stated.alias("o_orderpriority"), "l_returnflag",
        "l_linestatus",
    )


def _junk(flags: DataFrame) -> DataFrame:
    unknown = {c: "Unknown" for c in JUNK_DEFAULTS}
    return junk_dimension(flag_combinations(flags, JUNK_DEFAULTS), "junk_sk", unknown)


@query(JUNK_SQL + """
SELECT junk_sk, o_orderstatus, o_orderpriority, l_returnflag, l_linestatus, false AS is_unknown FROM junk
UNION ALL SELECT '-1', 'Unknown', 'Unknown', 'Unknown', 'Unknown', true
""")
def junk_dim(t: Tables) -> DataFrame:
    return _junk(_line_flags(t))


@query(JUNK_SQL + """
SELECT f.l_orderkey, f.l_linenumber, coalesce(j.junk_sk, '-1') AS junk_sk
FROM flags f LEFT JOIN junk j ON j.o_orderstatus = f.o_orderstatus AND j.o_orderpriority = f.o_orderpriority
  AND j.l_returnflag = f.l_returnflag AND j.l_linestatus = f.l_linestatus
""")
def junk_key_of_line(t: Tables) -> DataFrame:
    flags = _line_flags(t)
    return junk_lookup(flags, _junk(flags), "junk_sk", list(JUNK_DEFAULTS)).select(
        "l_orderkey", "l_linenumber", "junk_sk"
    )


@query("""
SELECT md5(CAST(c_custkey AS VARCHAR)) AS customer_sk, c_custkey AS customer_bk, c_name AS customer_name,
       n_name AS nation_name, r_name AS region_name, c_mktsegment AS segment, false AS is_unknown
FROM customer LEFT JOIN nation ON n_nationkey = c_nationkey LEFT JOIN region ON r_regionkey = n_regionkey
UNION ALL SELECT '-1', -1, 'Unknown', NULL, NULL, NULL, true
""")
def unknown_member_customer(t: Tables) -> DataFrame:
    joined = lookup_chain(
        t.customer, [(t.nation, "n_nationkey", "c_nationkey"), (t.region, "r_regionkey", "n_regionkey")]
    )
    described = joined.select(
        surrogate_key("c_custkey").alias("customer_sk"),
        F.col("c_custkey").alias("customer_bk"),
        F.col("c_name").alias("customer_name"),
        F.col("n_name").alias("nation_name"),
        F.col("r_name").alias("region_name"),
        F.col("c_mktsegment").alias("segment"),
        F.lit(False).alias("is_unknown"),
    )
    return with_unknown_member(
        described, {"customer_sk": "-1", "customer_bk": -1, "customer_name": "Unknown", "is_unknown": True}
    )


def date_dim_sql(bounds: str) -> str:
    """SQL of the date dimension over a query that gives columns lo and hi."""
    return f"""
WITH bounds AS ({bounds}),
days AS (
  SELECT CAST(unnest(generate_series(date_trunc('year', lo), date_trunc('year', hi) + INTERVAL 1 YEAR - INTERVAL 1 DAY,
                                     INTERVAL 1 DAY)) AS DATE) AS d FROM bounds),
parts AS (
  SELECT d, year(d) AS y, quarter(d) AS q, month(d) AS m, day(d) AS dd,
         CASE WHEN month(d) >= 7 THEN year(d) + 1 ELSE year(d) END AS fy,
         CASE WHEN month(d) IN (7, 8, 9) THEN 1 WHEN month(d) IN (10, 11, 12) THEN 2
              WHEN month(d) IN (1, 2, 3) THEN 3 ELSE 4 END AS fq FROM days)
SELECT CAST(y * 10000 + m * 100 + dd AS INTEGER) AS date_sk, CAST(d AS VARCHAR) AS full_date,
       CAST(y AS INTEGER) AS year_number, CAST(q AS INTEGER) AS quarter_number, 'Q' || q AS quarter_label,
       'Q' || q || ' ' || y AS quarter_name, CAST(m AS INTEGER) AS month_number, monthname(d) AS month_name,
       left(monthname(d), 3) AS month_short_name, CAST(weekofyear(d) AS INTEGER) AS week_of_year,
       CAST(dayofyear(d) AS INTEGER) AS day_of_year, CAST(dd AS INTEGER) AS day_of_month,
       CAST(dayofweek(d) + 1 AS INTEGER) AS day_of_week, dayname(d) AS day_name,
       left(dayname(d), 3) AS day_short_name, dayofweek(d) IN (0, 6) AS is_weekend,
       CAST(fy AS INTEGER) AS fiscal_year, CAST(fq AS INTEGER) AS fiscal_quarter, 'FQ' || fq AS fiscal_quarter_label,
       'FY' || fy || '-FQ' || fq AS fiscal_year_quarter,
       CAST(CAST(date_trunc('month', d) AS DATE) AS VARCHAR) AS month_start_date,
       CAST(last_day(d) AS VARCHAR) AS month_end_date,
       CAST(CAST(date_trunc('quarter', d) AS DATE) AS VARCHAR) AS quarter_start_date,
       CAST(last_day(CAST(date_trunc('quarter', d) + INTERVAL 2 MONTH AS DATE)) AS VARCHAR) AS quarter_end_date,
       CAST(CAST(date_trunc('year', d) AS DATE) AS VARCHAR) AS year_start_date,
       y || '-12-31' AS year_end_date, d = last_day(d) AS is_last_day_of_month,
       m = 12 AND dd = 31 AS is_last_day_of_year, false AS is_unknown
FROM parts
UNION ALL
SELECT -1, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL,
       NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, true
"""


@query(date_dim_sql("""
SELECT min(least(o_orderdate, first_ship)) AS lo, max(greatest(o_orderdate, last_ship)) AS hi
FROM orders LEFT JOIN (SELECT l_orderkey, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship
                       FROM lineitem GROUP BY l_orderkey) ON l_orderkey = o_orderkey
"""))
def date_dim(t: Tables) -> DataFrame:
    shipped = t.lineitem.groupBy("l_orderkey").agg(
        F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship")
    )
    dated = t.orders.join(shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return date_dimension(dated, ["o_orderdate", "first_ship", "last_ship"])


# --- allocation ------------------------------------------------------------------------

# Shares in whole millionths, cut; the first line of an order also takes what is left.
SHARE_SQL = """(CAST({amount} * 1000000 AS HUGEINT) * CAST({weight} * 1000000 AS HUGEINT)) // CAST({total} * 1000000 AS HUGEINT)"""
REST_SQL = """
CAST({share} + CASE WHEN {line} = min({line}) OVER (PARTITION BY {order})
                    THEN CAST({amount} * 1000000 AS HUGEINT) - sum({share}) OVER (PARTITION BY {order}) ELSE 0 END AS DOUBLE) / 1000000
"""
LINE_ID_SQL = "CAST(l_linenumber AS BIGINT) * 10000000000000 + CAST(l_partkey AS BIGINT) * 1000000 + l_suppkey"

ALLOCATED_SQL = f"""
WITH l AS (SELECT l_orderkey, l_linenumber, {LINE_ID_SQL} AS line_id, CAST(l_extendedprice AS DECIMAL(12,2)) AS w FROM lineitem),
t AS (SELECT l_orderkey, sum(w) AS total FROM l GROUP BY l_orderkey),
s AS (
  SELECT l.*, CAST(o_totalprice AS DECIMAL(12,2)) AS amount,
         {SHARE_SQL.format(amount="CAST(o_totalprice AS DECIMAL(12,2))", weight="l.w", total="t.total")} AS share
  FROM l JOIN t ON t.l_orderkey = l.l_orderkey JOIN orders ON o_orderkey = l.l_orderkey),
a AS (
  SELECT l_orderkey, l_linenumber, CAST(w AS DOUBLE) AS line_total,
         {REST_SQL.format(share="share", line="line_id", order="l_orderkey", amount="amount")} AS allocated_total
  FROM s)
"""


def allocated_lines(t: Tables) -> DataFrame:
    number = F.col("l_linenumber").cast("bigint") * 10_000_000_000_000 + F.col("l_partkey").cast("bigint") * 1_000_000
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("order_bk"),
        "l_linenumber",
        (number + F.col("l_suppkey")).alias("line_id"),
        F.col("l_extendedprice").cast("decimal(12,2)").cast("decimal(38,6)").alias("line_total"),
    )
    headers = t.orders.select(
        F.col("o_orderkey").alias("order_bk"),
        F.col("o_totalprice").cast("decimal(12,2)").cast("decimal(19,4)").alias("header_total"),
    )
    return allocate(lines, headers, "order_bk", "line_total", {"allocated_total": "header_total"}, "line_id")


@query(f"{ALLOCATED_SQL} SELECT * FROM a")
def allocate_overhead(t: Tables) -> DataFrame:
    return allocated_lines(t).select(
        F.col("order_bk").alias("l_orderkey"), "l_linenumber", "line_total", "allocated_total"
    )


@query("""
SELECT o_orderkey, n AS line_count, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS allocated_total
FROM orders JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey
""")
def allocation_sums_back(t: Tables) -> DataFrame:
    """The shares of every order against its own header amount."""
    return (
        allocated_lines(t)
        .groupBy(F.col("order_bk").alias("o_orderkey"))
        .agg(F.count("*").alias("line_count"), F.sum("allocated_total").cast("decimal(18,6)").alias("allocated_total"))
    )


# --- incremental loads -------------------------------------------------------------------


@query("""
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS o_totalprice, o_orderdate,
       CAST(NULL AS VARCHAR) AS batch FROM orders WHERE o_orderdate < TIMESTAMP '1999-07-01'
UNION ALL
SELECT o_orderkey, o_custkey, CAST(CAST(o_totalprice AS DECIMAL(12,2)) + 1 AS DOUBLE), o_orderdate, 'late'
FROM orders WHERE o_orderdate >= TIMESTAMP '1999-07-01'
""")
def merge_upsert_orders(t: Tables) -> DataFrame:
    columns = ["o_orderkey", "o_custkey", money("o_totalprice").alias("o_totalprice"), "o_orderdate"]
    target = t.orders.filter(F.col("o_orderdate") < ntz("2000-01-01 00:00:00")).select(*columns)
    batch = (
        t.orders.filter(F.col("o_orderdate") >= ntz("1999-07-01 00:00:00"))
        .select(*columns)
        .withColumns({"o_totalprice": (F.col("o_totalprice") + 1).cast("decimal(12,2)"), "batch": F.lit("late")})
    )
    return merge_upsert(target, batch, ["o_orderkey"])


@query("""
SELECT o_orderkey, o_custkey, o_orderdate FROM orders
WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 7 DAY FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01')
""")
def incremental_slice_orders(t: Tables) -> DataFrame:
    target = t.orders.filter(F.col("o_orderdate") < ntz("2000-01-01 00:00:00"))
    return incremental_slice(t.orders, target, "o_orderdate", "o_orderdate", 7).select(
        "o_orderkey", "o_custkey", "o_orderdate"
    )


@query("""
SELECT event_id, ts, user_id, event_type FROM events
WHERE ts >= (SELECT max(ts) - INTERVAL 1 DAY FROM events WHERE event_type = 'click' AND ts < TIMESTAMP '2024-01-20')
""")
def incremental_slice_events(t: Tables) -> DataFrame:
    target = t.events.filter((F.col("event_type") == "click") & (F.col("ts") < ntz("2024-01-20 00:00:00")))
    return incremental_slice(t.events, target, "ts", "ts", 1).select("event_id", "ts", "user_id", "event_type")


@query("""
SELECT s_suppkey, CAST((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS BIGINT)
       AS new_key FROM supplier
""")
def number_new_suppliers(t: Tables) -> DataFrame:
    top = t.customer.agg(F.max("c_custkey").alias("k")).scalar()
    return number_from(t.supplier.select("s_suppkey"), "s_suppkey", top, "new_key", blocks=16)


CHANGE_TIME = "2002-01-01 00:00:00"


def _customer_text(t: Tables) -> DataFrame:
    return t.customer.select(
        F.col("c_custkey").cast("string").alias("CustomerID"),
        F.col("c_name").alias("Name"),
        F.col("c_mktsegment").alias("Segment"),
        money("c_acctbal").cast("string").alias("Balance"),
        F.md5("c_name").alias("rowguid"),
        F.lit("2001-01-01 00:00:00").alias("ModifiedDate"),
    )


def _customer_changes(t: Tables) -> DataFrame:
    """Debtors are renamed and moved, one segment leaves, every supplier joins as a customer."""
    key = F.col("c_custkey")
    updates = t.customer.filter("c_acctbal < 0").select(
        F.lit("update").alias("op"),
        key.alias("change_seq"),
        key.cast("string").alias("CustomerID"),
        F.lit("   ").alias("Name"),
        F.lit("WATCHED").alias("Segment"),
        F.when(F.col("c_nationkey") > 12, "0.00").alias("Balance"),
    )
    second = t.customer.filter("c_nationkey > 20").select(
        F.lit("update").alias("op"),
        (key + 1_000_000_000).alias("change_seq"),
        key.cast("string").alias("CustomerID"),
        F.concat(F.lit(" Renamed "), F.col("c_name")).alias("Name"),
        F.lit(None).cast("string").alias("Segment"),
        F.lit("").alias("Balance"),
    )
    deletes = t.customer.filter("c_mktsegment = 'MACHINERY'").select(
        F.lit("delete").alias("op"),
        (key + 2_000_000_000).alias("change_seq"),
        key.cast("string").alias("CustomerID"),
        *[F.lit(None).cast("string").alias(c) for c in ("Name", "Segment", "Balance")],
    )
    inserts = t.supplier.select(
        F.lit("insert").alias("op"),
        (F.col("s_suppkey") + 3_000_000_000).alias("change_seq"),
        F.lit("").alias("CustomerID"),
        F.col("s_name").alias("Name"),
        F.lit("SUPPLIER").alias("Segment"),
        money("s_acctbal").cast("string").alias("Balance"),
    )
    return updates.unionByName(second).unionByName(deletes).unionByName(inserts)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "CustomerID",
       CASE WHEN c_nationkey > 20 THEN 'Renamed ' || c_name ELSE c_name END AS "Name",
       CASE WHEN c_acctbal < 0 THEN 'WATCHED' ELSE c_mktsegment END AS "Segment",
       CASE WHEN c_acctbal < 0 AND c_nationkey > 12 THEN '0.00'
            ELSE CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS "Balance",
       md5(c_name) AS rowguid,
       CASE WHEN c_acctbal < 0 OR c_nationkey > 20 THEN '2002-01-01 00:00:00' ELSE '2001-01-01 00:00:00' END
         AS "ModifiedDate"
FROM customer WHERE c_mktsegment <> 'MACHINERY'
UNION ALL
SELECT k, n, 'SUPPLIER', b,
       substr(g, 1, 8) || '-' || substr(g, 9, 4) || '-' || substr(g, 13, 4) || '-' || substr(g, 17, 4) || '-'
         || substr(g, 21, 12), '2002-01-01 00:00:00'
FROM (SELECT k, n, b, upper(md5(k || '|' || (s + 3000000000) || '|2002-01-01 00:00:00')) AS g
      FROM (SELECT CAST((SELECT max(c_custkey) FROM customer) + row_number() OVER (ORDER BY s_suppkey) AS VARCHAR) AS k,
                   s_name AS n, s_suppkey AS s, CAST(CAST(s_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS b
            FROM supplier))
""")
def apply_changes_customer(t: Tables) -> DataFrame:
    return apply_changes(_customer_text(t), _customer_changes(t), "CustomerID", CHANGE_TIME)


@query("""
SELECT 'update' AS op, CAST(count(*) AS BIGINT) AS requests, CAST(count(DISTINCT c_custkey) AS BIGINT) AS keys,
       CAST(count(DISTINCT c_custkey) AS BIGINT) AS keys_found, CAST(count(DISTINCT c_custkey) AS BIGINT) AS rows_affected
FROM (SELECT c_custkey FROM customer WHERE c_acctbal < 0 UNION ALL SELECT c_custkey FROM customer WHERE c_nationkey > 20)
UNION ALL
SELECT 'delete', 2 * count(*), 2 * count(*), count(*), count(*) FROM customer WHERE c_mktsegment = 'MACHINERY'
""")
def change_report_customer(t: Tables) -> DataFrame:
    changes = _customer_changes(t)
    unknown = changes.filter("op = 'delete'").withColumn("CustomerID", F.concat(F.lit("9999999"), "CustomerID"))
    return change_report(_customer_text(t), changes.unionByName(unknown), "CustomerID")


# --- history -------------------------------------------------------------------------------

LOAD, REPRICE, WITHDRAW, RETURN = (
    "1998-01-01 00:00:00", "1999-01-01 00:00:00", "2000-01-01 00:00:00", "2001-01-01 00:00:00",
)
FIRST = "1900-01-01 00:00:00"


def _parts(t: Tables) -> DataFrame:
    return t.part.select(
        F.col("p_partkey").alias("part_bk"),
        F.col("p_name").alias("part_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").cast("decimal(12,2)").alias("list_price"),
    )


def part_rounds(t: Tables) -> tuple[list, list[str]]:
    """Load; reprice large parts and blank a brand; withdraw the smallest; bring some back."""
    parts = _parts(t)
    check = ["brand", "list_price"]
    repriced = parts.withColumns(
        {
            "list_price": F.when(F.col("size") > 40, F.col("list_price") + 5)
            .otherwise(F.col("list_price"))
            .cast("decimal(12,2)"),
            "brand": F.when(F.col("brand") != "Brand#7", F.col("brand")),
            # renamed everywhere, but the name opens no version
            "part_name": F.upper("part_name"),
        }
    )
    rounds = [
        (LOAD, parts),
        (REPRICE, repriced),
        (WITHDRAW, repriced.filter("size > 5")),
        (RETURN, repriced.filter("size > 3")),
    ]
    return rounds, check


def part_history(t: Tables) -> DataFrame:
    rounds, check = part_rounds(t)
    return fold_rounds(rounds, "part_bk", check, FIRST, "part_history")


HISTORY_SQL = """
WITH p AS (
  SELECT p_partkey AS part_bk, p_name AS n1, upper(p_name) AS n2, p_brand AS b1,
         CASE WHEN p_brand <> 'Brand#7' THEN p_brand END AS b2, p_size AS size,
         CAST(p_retailprice AS DECIMAL(12,2)) AS c1,
         CAST(CASE WHEN p_size > 40 THEN CAST(p_retailprice AS DECIMAL(12,2)) + 5
                   ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS DECIMAL(12,2)) AS c2,
         p_size > 40 OR p_brand = 'Brand#7' AS changed FROM part),
versions AS (
  SELECT part_bk, n1 AS part_name, b1 AS brand, size, c1 AS list_price,
         TIMESTAMP '1998-01-01' AS updated_at, TIMESTAMP '1900-01-01' AS valid_from,
         CASE WHEN changed THEN TIMESTAMP '1999-01-01' WHEN size <= 5 THEN TIMESTAMP '2000-01-01' END AS valid_to
  FROM p
  UNION ALL
  SELECT part_bk, n2, b2, size, c2, TIMESTAMP '1999-01-01', TIMESTAMP '1999-01-01',
         CASE WHEN size <= 5 THEN TIMESTAMP '2000-01-01' END FROM p WHERE changed
  UNION ALL
  SELECT part_bk, n2, b2, size, c2, TIMESTAMP '2001-01-01', TIMESTAMP '2001-01-01', NULL FROM p
  WHERE size > 3 AND size <= 5),
history AS (
  SELECT *, md5(part_bk || '|' || strftime(valid_from, '%Y-%m-%d %H:%M:%S')) AS scd_id FROM versions)
"""


@query(HISTORY_SQL + """
SELECT part_bk, part_name, brand, size, CAST(list_price AS DOUBLE) AS list_price, scd_id, updated_at, valid_from,
       valid_to FROM history
""")
def scd2_snapshot_part(t: Tables) -> DataFrame:
    return part_history(t)


@query(ORACLES["scd2_snapshot_part"])
def stored_history_part(t: Tables) -> DataFrame:
    """The same four runs on a stored history, the closed versions of the first two merged into one range by the last."""
    rounds, check = part_rounds(t)
    return fold_stored(rounds, "part_bk", check, new_folder(t.spark, "part-history"), FIRST, fan=2)


PART_COLUMNS = ["part_bk", "part_name", "brand", "size", "list_price"]
DIM_SQL = HISTORY_SQL + """, dim AS (
  SELECT md5(scd_id) AS part_sk, part_bk, part_name, brand, size, list_price, valid_from, valid_to,
         valid_to IS NULL AS is_current, false AS is_unknown FROM history
  UNION ALL
  SELECT '-1', -1, 'Unknown', 'Unknown', NULL, 0, TIMESTAMP '1900-01-01', NULL, true, true)
"""


def part_dimension(t: Tables) -> DataFrame:
    versions = scd2_dimension(part_history(t), "part_sk", PART_COLUMNS)
    unknown = {"part_sk": "-1", "part_bk": -1, "part_name": "Unknown", "brand": "Unknown", "list_price": "0",
               "valid_from": FIRST, "is_current": True, "is_unknown": True}
    return with_unknown_member(versions, unknown)


@query(DIM_SQL + """
SELECT part_sk, part_bk, part_name, brand, size, CAST(list_price AS DOUBLE) AS list_price, valid_from, valid_to,
       is_current, is_unknown FROM dim
""")
def scd2_dim_part(t: Tables) -> DataFrame:
    return part_dimension(t)


@query(HISTORY_SQL + "SELECT count(*) AS open_rows FROM history WHERE valid_to IS NULL")
def scd2_open_versions(t: Tables) -> DataFrame:
    return open_versions(part_history(t))


@query(HISTORY_SQL + """
SELECT part_bk, part_name, brand, CAST(list_price AS DOUBLE) AS list_price, valid_from, valid_to FROM history
WHERE part_bk = (SELECT max(part_bk) FROM history WHERE size > 3 AND size <= 5)
""")
def scd2_history_of_part(t: Tables) -> DataFrame:
    returned = t.part.filter("p_size > 3 AND p_size <= 5").agg(F.max("p_partkey").alias("k")).scalar()
    return scd2_history(part_history(t), "part_bk", returned).select(
        "part_bk", "part_name", "brand", "list_price", "valid_from", "valid_to"
    )


@query("""
SELECT p_partkey AS part_bk, CAST(2 AS BIGINT) AS open_versions FROM part
WHERE (p_size > 40 OR p_brand = 'Brand#7') AND p_size > 3
""")
def scd2_keys_open_twice(t: Tables) -> DataFrame:
    """Defect: the first versions of changed parts were never closed.

    Changed parts of size 4 and 5 are withdrawn and come back, so they end with
    two open versions as well; those up to size 3 keep only the reopened one.
    """
    reopened = F.when(F.col("valid_to") > F.lit(REPRICE).cast("timestamp"), F.col("valid_to"))
    return keys_open_twice(part_history(t).withColumn("valid_to", reopened), "part_bk")


@query(DIM_SQL + """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, coalesce(d.part_sk, '-1') AS part_sk,
       CAST(d.list_price AS DOUBLE) AS price_at_order
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN dim d ON d.part_bk = l.l_partkey AND o.o_orderdate >= d.valid_from
  AND (o.o_orderdate < d.valid_to OR d.valid_to IS NULL)
""")
def pit_join_lines(t: Tables) -> DataFrame:
    return _priced_lines(t, split=False)


@query(DIM_SQL + """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, coalesce(d.part_sk, '-1') AS part_sk,
       CAST(d.list_price AS DOUBLE) AS price_at_order
FROM lineitem l JOIN orders o ON o.o_orderkey = l.l_orderkey
LEFT JOIN dim d ON d.part_bk = l.l_partkey AND o.o_orderdate >= d.valid_from
  AND (o.o_orderdate < d.valid_to OR d.valid_to IS NULL)
""")
def pit_join_hot_parts(t: Tables) -> DataFrame:
    """The same lookup with parts above a share of the lines split over salts."""
    return _priced_lines(t, split=True)


def _priced_lines(t: Tables, split: bool) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", F.col("o_orderdate")
    )
    hot = hot_keys(t.lineitem, "l_partkey", 0.0005) if split else None
    versions = part_dimension(t).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("valid_from", "valid_to")}
    )
    take = {"part_sk": "part_sk", "price_at_order": "list_price"}
    found = point_in_time_join(lines, versions, "l_partkey", "part_bk", "o_orderdate", take, hot=hot)
    return found.withColumn("part_sk", F.coalesce("part_sk", F.lit("-1")))


@query("""
SELECT l_orderkey, l_linenumber, l_suppkey, s_name FROM lineitem
LEFT JOIN supplier ON s_suppkey = CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END
""")
def hot_supplier_lookup(t: Tables) -> DataFrame:
    """Left join in which a NULL key holds a large share of the lines."""
    lines = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey",
        F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")).alias("rated_suppkey"),
    )
    hot = hot_keys(lines, "rated_suppkey", 0.005)
    right = t.supplier.select(F.col("s_suppkey").alias("_supplier"), "s_name")
    return left_join(lines, right, "rated_suppkey", "_supplier", hot=hot, salts=8).select(
        "l_orderkey", "l_linenumber", "l_suppkey", "s_name"
    )


@query("""
SELECT l_suppkey AS hot_key FROM lineitem GROUP BY l_suppkey
HAVING count(*) >= 0.0105 * (SELECT count(*) FROM lineitem)
""")
def hot_supplier_keys(t: Tables) -> DataFrame:
    return hot_keys(t.lineitem, "l_suppkey", 0.0105)
