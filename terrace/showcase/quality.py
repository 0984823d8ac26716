"""Quality checks on the analytics tables, with defects put in by expression."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..quality import checks
from ..quality.suite import (
    accepted,
    between,
    contract,
    holds,
    matches,
    not_null,
    related,
    run_suite,
    together,
    unique,
)
from .operators import DIM_SQL, HISTORY_SQL, part_dimension, part_history
from .registry import Tables, query


@query("""
SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderpriority = '4-NOT SPECIFIED' AND o_orderstatus <> 'P'
""")
def dq_not_null(t: Tables) -> DataFrame:
    stated = t.orders.withColumn(
        "o_orderpriority", F.nullif(F.col("o_orderpriority"), F.lit("4-NOT SPECIFIED"))
    )
    return checks.not_null(stated, "o_orderpriority", where="o_orderstatus <> 'P'").select(
        "o_orderkey", "o_orderstatus"
    )


@query("""
SELECT c_phone, count(*) AS n_rows FROM (
  SELECT nullif(right(c_name, 2) || c_nationkey, '000') AS c_phone FROM customer)
WHERE c_phone IS NOT NULL GROUP BY c_phone HAVING count(*) > 1
""")
def dq_unique(t: Tables) -> DataFrame:
    phone = F.concat(F.right(F.col("c_name"), F.lit(2)), F.col("c_nationkey").cast("string"))
    return checks.unique(t.customer.withColumn("c_phone", F.nullif(phone, F.lit("000"))), "c_phone")


@query("""
SELECT o_orderkey, o_orderpriority FROM orders
WHERE o_orderpriority NOT IN ('1-URGENT', '2-HIGH', '3-MEDIUM', '5-LOW') AND o_orderdate >= TIMESTAMP '1998-01-01'
""")
def dq_accepted_values(t: Tables) -> DataFrame:
    allowed = ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]
    return checks.accepted_values(
        t.orders, "o_orderpriority", allowed, where="o_orderdate >= timestamp_ntz'1998-01-01 00:00:00'"
    ).select("o_orderkey", "o_orderpriority")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE l_returnflag <> 'R' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7)
""")
def dq_relationships(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("l_partkey", F.when(F.col("l_returnflag") != "R", F.col("l_partkey")))
    return checks.relationships(lines, "l_partkey", t.part.filter("p_size <> 7"), "p_partkey").select(
        "l_orderkey", "l_linenumber", "l_partkey"
    )


@query("""
SELECT l_partkey AS orphan_key, count(*) AS n_rows FROM lineitem
WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size <> 7) GROUP BY l_partkey
""")
def dq_orphan_keys(t: Tables) -> DataFrame:
    return checks.orphan_keys(t.lineitem, "l_partkey", t.part.filter("p_size <> 7"), "p_partkey")


@query("""
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM (
  SELECT CASE WHEN l_returnflag <> 'R' THEN l_orderkey END AS l_orderkey, l_linenumber FROM lineitem)
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1
""")
def dq_unique_combination(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("l_orderkey", F.when(F.col("l_returnflag") != "R", F.col("l_orderkey")))
    return checks.unique_combination(lines, ["l_orderkey", "l_linenumber"])


@query("""
SELECT l_orderkey, l_linenumber, l_shipdate, o_orderdate FROM lineitem JOIN orders ON o_orderkey = l_orderkey
WHERE NOT (l_shipdate >= o_orderdate)
""")
def dq_expression(t: Tables) -> DataFrame:
    lines = t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
    return checks.expression_is_true(lines, ">= o_orderdate", column="l_shipdate").select(
        "l_orderkey", "l_linenumber", "l_shipdate", "o_orderdate"
    )


@query("""
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem
WHERE (l_quantity < 2 OR l_quantity > 48) AND l_linestatus = 'F'
""")
def dq_between(t: Tables) -> DataFrame:
    return checks.value_between(t.lineitem, "l_quantity", 2, 48, where="l_linestatus = 'F'").select(
        "l_orderkey", "l_linenumber", "l_quantity"
    )


@query("SELECT p_partkey, p_brand FROM part WHERE NOT regexp_matches(p_brand, '^Brand#[0-9]$')")
def dq_regex(t: Tables) -> DataFrame:
    return checks.matches_regex(t.part, "p_brand", r"^Brand#[0-9]$").select("p_partkey", "p_brand")


@query(HISTORY_SQL + """, stretched AS (
  SELECT part_bk, valid_from, coalesce(
           CASE WHEN valid_to = TIMESTAMP '1999-01-01' THEN TIMESTAMP '1999-03-01' ELSE valid_to END,
           TIMESTAMP '9999-12-31') AS valid_to FROM history
  UNION ALL SELECT part_bk, valid_from, TIMESTAMP '9999-12-31' FROM history
  WHERE brand = 'Brand#3' AND valid_from = TIMESTAMP '1900-01-01'),
starts AS (
  SELECT part_bk, valid_from, max(valid_to) AS valid_to, count(*) AS n_versions FROM stretched
  GROUP BY part_bk, valid_from)
SELECT a.part_bk AS business_key, a.valid_from, a.valid_to, a.n_versions,
       max(b.valid_to) AS earlier_valid_to
FROM starts a LEFT JOIN starts b ON b.part_bk = a.part_bk AND b.valid_from < a.valid_from
GROUP BY a.part_bk, a.valid_from, a.valid_to, a.n_versions
HAVING a.n_versions > 1 OR max(b.valid_to) > a.valid_from
""")
def dq_scd2_overlap(t: Tables) -> DataFrame:
    """Defects: versions closed too late, and a brand whose first version is doubled."""
    late = F.when(F.col("valid_to") == F.lit("1999-01-01").cast("timestamp"), F.lit("1999-03-01").cast("timestamp"))
    history = part_history(t).withColumn("valid_to", F.coalesce(late, F.col("valid_to")))
    doubled = history.filter("brand = 'Brand#3' AND valid_from = timestamp'1900-01-01 00:00:00'")
    both = history.unionByName(doubled.withColumn("valid_to", F.lit(None).cast("timestamp")))
    return checks.scd2_overlaps(both, "part_bk", where=None)


@query("""
SELECT l_orderkey || '-' || l_linenumber AS sales_order_line_bk, md5(l_orderkey || '-' || l_linenumber) AS sales_order_line_sk,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS DOUBLE) AS line_total,
       CAST(CAST(l_extendedprice AS DECIMAL(12,2)) + CAST(0.05 - l_discount AS DECIMAL(4,2)) AS DOUBLE)
         AS line_total_with_overhead,
       CAST(CAST(0.05 - l_discount AS DECIMAL(4,2)) AS DOUBLE) AS overhead_delta
FROM lineitem WHERE CAST(0.05 - l_discount AS DECIMAL(4,2)) < 0
""")
def dq_overhead(t: Tables) -> DataFrame:
    line_bk = F.concat_ws("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string"))
    price = F.col("l_extendedprice").cast("decimal(12,2)")
    overhead = (F.lit(0.05) - F.col("l_discount")).cast("decimal(4,2)")
    fact = t.lineitem.select(
        line_bk.alias("sales_order_line_bk"),
        F.md5(line_bk).alias("sales_order_line_sk"),
        price.alias("line_total"),
        (price + overhead).alias("line_total_with_overhead"),
    )
    return checks.negative_overhead(fact)


@query("""
SELECT CAST(a AS DOUBLE) AS order_total, CAST(b AS DOUBLE) AS line_total, CAST(abs(a - b) AS DOUBLE) AS delta
FROM (SELECT CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS a FROM orders),
     (SELECT CAST(sum(CAST(l_extendedprice AS DECIMAL(12,2))) AS DECIMAL(22,2)) AS b FROM lineitem)
WHERE abs(a - b) > 0.01
""")
def dq_reconcile(t: Tables) -> DataFrame:
    orders = t.orders.select(F.col("o_totalprice").cast("decimal(12,2)").alias("amount"))
    lines = t.lineitem.select(F.col("l_extendedprice").cast("decimal(12,2)").alias("amount"))
    return checks.reconcile(orders, "amount", lines, "amount", "order_total", "line_total")


@query(DIM_SQL + """
SELECT 'dim_part_doubled' AS dim_name, 2 * count(*) AS cnt FROM dim WHERE is_unknown AND valid_to IS NULL
UNION ALL
SELECT 'dim_part_without', count(*) FROM dim WHERE is_unknown AND valid_to IS NOT NULL
""")
def dq_unknown_member(t: Tables) -> DataFrame:
    """One sound dimension, one with a second Unknown row and one without any."""
    dim = part_dimension(t)
    unknown = dim.filter("is_unknown")
    return checks.missing_unknown_member(
        {
            "dim_part": dim,
            "dim_part_doubled": dim.unionByName(unknown),
            "dim_part_without": dim.filter("NOT is_unknown"),
        }
    )


@query("""
SELECT max(ts) AS max_loaded_at,
       CAST(floor(epoch(TIMESTAMP '2024-02-01')) - floor(epoch(max(ts))) AS BIGINT) AS age_seconds,
       CASE WHEN epoch(TIMESTAMP '2024-02-01') - epoch(max(ts)) > 48 * 3600 THEN 'error'
            WHEN epoch(TIMESTAMP '2024-02-01') - epoch(max(ts)) > 24 * 3600 THEN 'warn' ELSE 'pass' END AS status
FROM events
""")
def dq_freshness(t: Tables) -> DataFrame:
    return checks.freshness(t.events, "ts", "2024-02-01 00:00:00", 24, 48)


SUITE_ITEMS = contract(
    not_null("l_orderkey", "l_shipdate"),
    not_null("rated_suppkey", where="l_linestatus = 'F'"),
    accepted("l_returnflag", "A", "N"),
    between("l_quantity", low=1, high=49),
    between("l_discount", high=0.08, where="l_linestatus = 'O'"),
    matches("l_linestatus", "^[F]$"),
    holds("l_tax <= l_discount"),
    unique("rated_suppkey"),
    together("l_orderkey", "l_linenumber"),
    related("l_orderkey", "orders.o_orderkey"),
    related("rated_suppkey", "supplier.s_suppkey", where="l_linestatus = 'F'"),
)


@query("""
WITH l AS (SELECT *, CASE WHEN l_returnflag <> 'R' THEN l_suppkey END AS rated_suppkey FROM lineitem),
o AS (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P'),
s AS (SELECT s_suppkey FROM supplier WHERE s_acctbal >= 0)
SELECT 'lineitem' AS table_name, * FROM (
SELECT 'l_orderkey' AS column_name, 'not_null' AS test, '' AS detail,
       CAST(count(*) FILTER (l_orderkey IS NULL) AS BIGINT) AS violations FROM l
UNION ALL SELECT 'l_shipdate', 'not_null', '', count(*) FILTER (l_shipdate IS NULL) FROM l
UNION ALL SELECT 'rated_suppkey', 'not_null', 'where l_linestatus = ''F''',
       count(*) FILTER (l_linestatus = 'F' AND rated_suppkey IS NULL) FROM l
UNION ALL SELECT 'l_returnflag', 'accepted_values', 'A,N', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM l
UNION ALL SELECT 'l_quantity', 'value_between', '1..49', count(*) FILTER (l_quantity < 1 OR l_quantity > 49) FROM l
UNION ALL SELECT 'l_discount', 'value_between', '..0.08 where l_linestatus = ''O''',
       count(*) FILTER (l_linestatus = 'O' AND l_discount > CAST(0.08 AS DOUBLE)) FROM l
UNION ALL SELECT 'l_linestatus', 'matches_regex', '^[F]$',
       count(*) FILTER (NOT regexp_matches(l_linestatus, '^[F]$')) FROM l
UNION ALL SELECT '', 'expression_is_true', 'l_tax <= l_discount', count(*) FILTER (NOT l_tax <= l_discount) FROM l
UNION ALL SELECT 'rated_suppkey', 'unique', '', count(*) FROM (
       SELECT rated_suppkey FROM l WHERE rated_suppkey IS NOT NULL GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'l_orderkey,l_linenumber', 'unique_combination', '', count(*) FROM (
       SELECT 1 FROM l GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1)
UNION ALL SELECT 'l_orderkey', 'relationships', 'orders.o_orderkey',
       count(*) FROM l WHERE l_orderkey NOT IN (SELECT o_orderkey FROM o)
UNION ALL SELECT 'rated_suppkey', 'relationships', 'supplier.s_suppkey where l_linestatus = ''F''',
       count(*) FROM l WHERE l_linestatus = 'F' AND rated_suppkey IS NOT NULL
         AND rated_suppkey NOT IN (SELECT s_suppkey FROM s))
""")
def dq_suite(t: Tables) -> DataFrame:
    lines = t.lineitem.withColumn("rated_suppkey", F.when(F.col("l_returnflag") != "R", F.col("l_suppkey")))
    parents = {"orders": t.orders.filter("o_orderstatus <> 'P'"), "supplier": t.supplier.filter("s_acctbal >= 0")}
    return run_suite(lines, "lineitem", SUITE_ITEMS, parents)
