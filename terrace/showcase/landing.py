"""Landing and staging: the analytics tables as text extracts, read and typed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.incremental import incremental_slice
from ..plans.staging import stage, stage_incremental
from ..sources.delimited import land, landing_file, read_delimited, with_loaded_at
from ..sources.records import read_records
from ..sources.registry import SOURCES
from ..sources.tables import merge_partitions, new_folder, read_marks, retire_runs, stored
from .registry import ORACLES, Tables, query

LOADED = "2002-01-01 00:00:00"
PADDING = ".000000000"


def landed(df: DataFrame, table: str, values: dict[str, Column | str]) -> DataFrame:
    """The extract of ``table``: its columns in order, as text, NULL where not given."""
    columns = []
    for name in SOURCES[table].columns:
        value = values.get(name)
        value = F.lit(None) if value is None else (F.col(value) if isinstance(value, str) else value)
        columns.append(value.cast("string").alias(name))
    return with_loaded_at(df.select(*columns), LOADED)


def stamp(col: str) -> Column:
    """A modification time the way the extracts write it, with nine fractional digits."""
    return F.concat(F.col(col).cast("string"), F.lit(PADDING))


def money(col: str) -> Column:
    return F.col(col).cast("decimal(19,4)")


def landed_orders(t: Tables) -> DataFrame:
    """Every order as landed first, and partly filled ones once more after a change."""

    def extract(df: DataFrame, status: Column, modified: Column) -> DataFrame:
        digit = F.left(F.col("o_orderpriority"), F.lit(1))
        return landed(
            df,
            "SalesOrderHeader",
            {
                "SalesOrderID": "o_orderkey",
                "RevisionNumber": digit,
                "OrderDate": "o_orderdate",
                "DueDate": F.col("o_orderdate") + F.expr("INTERVAL 12 DAY"),
                "ShipDate": F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate")),
                "Status": status,
                "OnlineOrderFlag": (digit == "5").cast("int"),
                "SalesOrderNumber": F.concat(F.lit("SO"), F.col("o_orderkey").cast("string")),
                "CustomerID": "o_custkey",
                "SubTotal": money("o_totalprice"),
                "Freight": F.lit("1.5"),
                "rowguid": F.md5(F.col("o_orderkey").cast("string")),
                "ModifiedDate": modified,
            },
        )

    first = extract(t.orders, F.when(F.col("o_orderstatus") == "O", 1).otherwise(2), stamp("o_orderdate"))
    partial = t.orders.filter("o_orderstatus = 'P'").withColumn(
        "changed", F.col("o_orderdate") + F.expr("INTERVAL 30 DAY")
    )
    return first.unionByName(extract(partial, F.lit(9), stamp("changed")))


ORDERS_SQL = """
staged AS (
  SELECT CAST(o_orderkey AS INTEGER) AS sales_order_bk, CAST(left(o_orderpriority, 1) AS INTEGER) AS revision_number,
         o_orderdate AS order_date, o_orderdate + INTERVAL 12 DAY AS due_date,
         CASE WHEN o_orderstatus = 'F' THEN o_orderdate END AS ship_date,
         CAST(CASE o_orderstatus WHEN 'P' THEN 9 WHEN 'O' THEN 1 ELSE 2 END AS INTEGER) AS order_status_code,
         CASE o_orderstatus WHEN 'P' THEN 'Unknown' WHEN 'O' THEN 'In process' ELSE 'Approved' END AS order_status,
         o_orderpriority = '5-LOW' AS is_online_order, 'SO' || o_orderkey AS sales_order_number,
         CAST(NULL AS VARCHAR) AS purchase_order_number, CAST(NULL AS VARCHAR) AS account_number,
         CAST(o_custkey AS INTEGER) AS customer_bk, CAST(NULL AS INTEGER) AS sales_person_bk,
         CAST(NULL AS INTEGER) AS sales_territory_bk, CAST(NULL AS INTEGER) AS bill_to_address_bk,
         CAST(NULL AS INTEGER) AS ship_to_address_bk, CAST(NULL AS INTEGER) AS ship_method_bk,
         CAST(NULL AS INTEGER) AS credit_card_bk, CAST(NULL AS VARCHAR) AS credit_card_approval_code,
         CAST(NULL AS INTEGER) AS currency_rate_bk,
         CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS sub_total, CAST(NULL AS DOUBLE) AS tax_amount,
         CAST(1.5 AS DOUBLE) AS freight, CAST(NULL AS DOUBLE) AS total_due, CAST(NULL AS VARCHAR) AS comment,
         md5(CAST(o_orderkey AS VARCHAR)) AS row_guid,
         CASE WHEN o_orderstatus = 'P' THEN o_orderdate + INTERVAL 30 DAY ELSE o_orderdate END AS modified_at
  FROM orders)"""


@query(f"WITH {ORDERS_SQL} SELECT * FROM staged")
def stage_order_header(t: Tables) -> DataFrame:
    return stage("SalesOrderHeader", landed_orders(t))


@query(f"""
WITH {ORDERS_SQL},
cutoff AS (SELECT max(modified_at) - INTERVAL 1 DAY AS cut FROM staged WHERE order_date < TIMESTAMP '2000-01-01')
SELECT * REPLACE (CASE WHEN modified_at >= (SELECT cut FROM cutoff) THEN freight ELSE 0 END AS freight) FROM staged
WHERE order_date < TIMESTAMP '2000-01-01' OR modified_at >= (SELECT cut FROM cutoff)
""")
def stage_order_header_incremental(t: Tables) -> DataFrame:
    """A stored table up to 1999 with stale freight; the run takes what changed since its newest row."""
    extract = landed_orders(t)
    stored = (
        stage("SalesOrderHeader", extract)
        .filter("order_date < timestamp'2000-01-01 00:00:00'")
        .withColumn("freight", F.lit(0).cast("decimal(19,4)"))
    )
    return stage_incremental("SalesOrderHeader", extract, stored)


@query("""
WITH landed AS (
  SELECT l_orderkey, l_linenumber, CAST(l_suppkey AS VARCHAR) AS carrier, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS qty,
         CAST(l_partkey AS VARCHAR) AS product, CAST(CAST(l_extendedprice AS DECIMAL(19,4)) AS VARCHAR) AS price,
         CAST(CAST(l_discount AS DECIMAL(19,4)) AS VARCHAR) AS discount, l_shipdate
  FROM lineitem)
SELECT l_orderkey || '-' || l_linenumber AS sales_order_line_bk, CAST(l_orderkey AS INTEGER) AS sales_order_bk,
       CAST(l_linenumber AS INTEGER) AS sales_order_detail_bk, CAST(product AS INTEGER) AS product_bk,
       CAST(1 AS INTEGER) AS special_offer_bk, carrier AS carrier_tracking_number, CAST(qty AS INTEGER) AS order_qty,
       CAST(price AS DOUBLE) AS unit_price, CAST(discount AS DOUBLE) AS unit_price_discount,
       CAST(price AS DOUBLE) AS line_total, CAST(NULL AS VARCHAR) AS row_guid, l_shipdate AS modified_at
FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC, carrier DESC, qty DESC, product DESC, price DESC, discount DESC) AS rn FROM landed)
WHERE rn = 1
""")
def stage_order_detail(t: Tables) -> DataFrame:
    extract = landed(
        t.lineitem,
        "SalesOrderDetail",
        {
            "SalesOrderID": "l_orderkey",
            "SalesOrderDetailID": "l_linenumber",
            "CarrierTrackingNumber": "l_suppkey",
            "OrderQty": F.col("l_quantity").cast("int"),
            "ProductID": "l_partkey",
            "SpecialOfferID": F.lit(1),
            "UnitPrice": money("l_extendedprice"),
            "UnitPriceDiscount": money("l_discount"),
            "LineTotal": money("l_extendedprice"),
            "ModifiedDate": stamp("l_shipdate"),
        },
    )
    return stage("SalesOrderDetail", extract)


def customer_extract(t: Tables) -> DataFrame:
    return landed(
        t.customer,
        "Customer",
        {
            "CustomerID": "c_custkey",
            "PersonID": F.when(F.col("c_acctbal") >= 0, F.col("c_custkey")),
            "StoreID": F.when(F.col("c_nationkey") < 8, F.col("c_custkey")),
            "TerritoryID": "c_nationkey",
            "AccountNumber": F.concat(F.lit("AW"), F.right(F.col("c_name"), F.lit(8))),
            "rowguid": F.md5("c_name"),
            "ModifiedDate": F.lit("2001-01-01 00:00:00" + PADDING + "&|"),
        },
    )


@query("""
SELECT CAST(c_custkey AS INTEGER) AS customer_bk, CAST(person AS INTEGER) AS person_bk, CAST(store AS INTEGER) AS store_bk,
       c_nationkey AS sales_territory_bk, 'AW' || right(c_name, 8) AS account_number,
       CASE WHEN person IS NOT NULL AND store IS NOT NULL THEN 'StoreContact' WHEN person IS NOT NULL THEN 'Individual'
            WHEN store IS NOT NULL THEN 'Store' ELSE 'Unknown' END AS customer_type,
       md5(c_name) AS row_guid, TIMESTAMP '2001-01-01' AS modified_at
FROM (SELECT *, CASE WHEN c_acctbal >= 0 THEN c_custkey END AS person,
             CASE WHEN c_nationkey < 8 THEN c_custkey END AS store FROM customer)
""")
def stage_customer(t: Tables) -> DataFrame:
    return stage("Customer", customer_extract(t))


@query(ORACLES["stage_customer"])
def land_and_stage_customer(t: Tables) -> DataFrame:
    """The extract as a delimited file, landed once as a stored table, scanned and staged."""
    folder = new_folder(t.spark, "landing")
    spec = SOURCES["Customer"]
    text = customer_extract(t).select(*spec.columns)
    text.write.csv(landing_file(folder, "Customer"), sep=spec.separator, nullValue="", emptyValue="")
    stored_tables = land(t.spark, folder, f"{folder}/landed", LOADED, ["Customer"])
    return stage("Customer", stored_tables["Customer"])



@query("""
SELECT CAST(s_suppkey AS INTEGER) AS person_bk, 'SP' AS person_type, s_acctbal < 0 AS is_eastern_name_style,
       CAST(NULL AS VARCHAR) AS title, left(s_name, 8) AS first_name,
       CASE WHEN s_nationkey < 10 THEN 'B' ELSE '' END AS middle_name, right(s_name, 9) AS last_name,
       CASE WHEN s_nationkey > 20 THEN 'Jr.' END AS suffix,
       left(s_name, 8) || CASE WHEN s_nationkey < 10 THEN ' B ' ELSE ' ' END || right(s_name, 9)
         || CASE WHEN s_nationkey > 20 THEN ' Jr.' ELSE '' END AS full_name,
       CAST(s_nationkey % 3 AS INTEGER) AS email_promotion_flag, md5(s_name) AS row_guid,
       TIMESTAMP '2001-01-01' AS modified_at
FROM supplier
""")
def stage_person(t: Tables) -> DataFrame:
    extract = landed(
        t.supplier,
        "Person",
        {
            "BusinessEntityID": "s_suppkey",
            "PersonType": F.lit("SP"),
            "NameStyle": (F.col("s_acctbal") < 0).cast("int"),
            "FirstName": F.left(F.col("s_name"), F.lit(8)),
            "MiddleName": F.when(F.col("s_nationkey") < 10, "B").otherwise(""),
            "LastName": F.right(F.col("s_name"), F.lit(9)),
            "Suffix": F.when(F.col("s_nationkey") > 20, "Jr."),
            "EmailPromotion": F.col("s_nationkey") % 3,
            "Demographics": F.lit("<survey/>"),
            "rowguid": F.md5("s_name"),
            "ModifiedDate": F.lit("2001-01-01 00:00:00" + PADDING),
        },
    )
    return stage("Person", extract)


@query("""
SELECT CAST(c_custkey AS INTEGER) AS credit_card_bk, c_mktsegment AS card_type,
       repeat('X', 9) || right(c_name, 4) AS card_number_masked, CAST(1 + c_nationkey % 12 AS INTEGER) AS exp_month,
       CAST(2005 AS INTEGER) AS exp_year, TIMESTAMP '2001-01-01' AS modified_at
FROM customer
""")
def stage_credit_card(t: Tables) -> DataFrame:
    extract = landed(
        t.customer,
        "CreditCard",
        {
            "CreditCardID": "c_custkey",
            "CardType": "c_mktsegment",
            "CardNumber": F.concat(F.lit("1111"), F.right(F.col("c_name"), F.lit(9))),
            "ExpMonth": F.col("c_nationkey") % 12 + 1,
            "ExpYear": F.lit(2005),
            "ModifiedDate": F.lit("2001-01-01 00:00:00"),
        },
    )
    return stage("CreditCard", extract)


@query("""
SELECT CAST(p_partkey AS INTEGER) AS product_bk, p_name AS product_name, 'PN-' || p_partkey AS product_number,
       p_size > 25 AS is_make, true AS is_finished_good, CAST(NULL AS VARCHAR) AS color,
       CAST(NULL AS INTEGER) AS safety_stock_level, CAST(NULL AS INTEGER) AS reorder_point,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS standard_cost,
       CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DOUBLE) AS list_price, CAST(p_size AS VARCHAR) AS size,
       CAST(NULL AS VARCHAR) AS size_uom_code, CAST(NULL AS VARCHAR) AS weight_uom_code,
       CAST(p_size AS DOUBLE) / 4 AS weight, p_size AS days_to_manufacture, left(p_type, 1) AS product_line,
       CAST(NULL AS VARCHAR) AS product_class, CAST(NULL AS VARCHAR) AS product_style,
       p_size AS product_subcategory_bk, CAST(NULL AS INTEGER) AS product_model_bk,
       TIMESTAMP '1995-01-01' AS sell_start_at, CAST(NULL AS TIMESTAMP) AS sell_end_at,
       CAST(NULL AS TIMESTAMP) AS discontinued_at, md5(p_name) AS row_guid, TIMESTAMP '2001-01-01' AS modified_at
FROM part
""")
def stage_product(t: Tables) -> DataFrame:
    extract = landed(
        t.part,
        "Product",
        {
            "ProductID": "p_partkey",
            "Name": "p_name",
            "ProductNumber": F.concat(F.lit("PN-"), F.col("p_partkey").cast("string")),
            "MakeFlag": (F.col("p_size") > 25).cast("int"),
            "FinishedGoodsFlag": F.lit(1),
            "StandardCost": money("p_retailprice"),
            "ListPrice": money("p_retailprice"),
            "Size": "p_size",
            "Weight": (F.col("p_size") / 4).cast("decimal(8,2)"),
            "DaysToManufacture": "p_size",
            "ProductLine": F.concat(F.left(F.col("p_type"), F.lit(1)), F.lit(" ")),
            "ProductSubcategoryID": "p_size",
            "SellStartDate": F.lit("1995-01-01 00:00:00"),
            "rowguid": F.md5("p_name"),
            "ModifiedDate": F.lit("2001-01-01 00:00:00" + PADDING),
        },
    )
    return stage("Product", extract)


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "CustomerKey", c_name AS "Name", c_mktsegment AS "Segment",
       CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS "Balance",
       '2002-01-01 00:00:00' AS "LoadedAt"
FROM customer
""")
def ingest_delimited(t: Tables) -> DataFrame:
    """Customers written as a headerless '+|' text extract in the shared folder and landed again."""
    path = new_folder(t.spark, "customer_extract")
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    fields = [F.col("c_custkey").cast("string"), "c_name", "c_mktsegment", F.coalesce(balance, F.lit(""))]
    t.customer.select(F.concat_ws("+|", *fields).alias("value")).write.text(path)
    return with_loaded_at(
        read_delimited(t.spark, path, ["CustomerKey", "Name", "Segment", "Balance"], sep="+|"), LOADED
    )


@query("""
SELECT CAST(c_custkey AS VARCHAR) AS "CustomerKey", c_mktsegment || chr(10) || 'of "' || c_name || '"+|' AS "Note",
       CASE WHEN c_acctbal >= 0 THEN CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) END AS "Balance",
       c_nationkey || '" rack' AS "Shelf", '2002-01-01 00:00:00' AS "LoadedAt"
FROM customer
""")
def ingest_multiline(t: Tables) -> DataFrame:
    """Customers with a quoted note over two lines, which holds quotes and a separator, and a stray quote elsewhere."""
    path = new_folder(t.spark, "customer_notes")
    note = F.concat(F.lit('"'), "c_mktsegment", F.lit('\nof ""'), "c_name", F.lit('""+|"'))
    balance = F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal").cast("decimal(12,2)").cast("string"))
    shelf = F.concat(F.col("c_nationkey").cast("string"), F.lit('" rack'))
    fields = [F.col("c_custkey").cast("string"), note, F.coalesce(balance, F.lit("")), shelf]
    t.customer.select(F.concat_ws("+|", *fields).alias("value")).write.text(path)
    return with_loaded_at(read_records(t.spark, path, ["CustomerKey", "Note", "Balance", "Shelf"], "+|"), LOADED)


@query("""
WITH o AS (
  SELECT o_orderkey, o_custkey, CAST(o_totalprice AS DECIMAL(12,2)) AS total, o_orderdate FROM orders
), late AS (
  SELECT max(o_orderdate) - INTERVAL 7 DAY AS cutoff FROM o WHERE o_orderdate < TIMESTAMP '2000-01-01'
)
SELECT o_orderkey, o_custkey, CAST(CASE WHEN o_orderdate >= cutoff THEN total + 1 ELSE total END AS DOUBLE) AS o_totalprice, o_orderdate,
       CAST(floor(o_orderkey / 16384) AS INTEGER) AS order_block
FROM o, late WHERE o_orderdate < TIMESTAMP '2000-01-01' OR o_orderdate >= cutoff
""")
def stored_merge_orders(t: Tables) -> DataFrame:
    """A first load and an increment into a stored table: the lookback reads the kept bounds, the merge only touched blocks."""
    base = new_folder(t.spark, "stored-orders")
    total = F.col("o_totalprice").cast("decimal(12,2)").alias("o_totalprice")
    block = F.floor(F.col("o_orderkey") / 16384).cast("int").alias("order_block")
    orders = t.orders.select("o_orderkey", "o_custkey", total, "o_orderdate", block)

    def merge(batch: DataFrame) -> DataFrame:
        return merge_partitions(stored(batch, "orders-batch"), base, ["o_orderkey"], "order_block", marks=["o_orderdate"])

    target = merge(orders.filter(F.col("o_orderdate") < F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")))
    marks = read_marks(t.spark, base, "order_block", ["o_orderdate"])
    changed = orders.withColumn("o_totalprice", (F.col("o_totalprice") + 1).cast("decimal(12,2)"))
    merged = merge(incremental_slice(changed, target, "o_orderdate", "o_orderdate", 7, marks))
    retire_runs(t.spark, base)
    return merged
