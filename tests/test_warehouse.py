"""The whole warehouse on the small landed set: load, change, reload."""

from decimal import Decimal

import pytest
from conftest import rows_of, ts
from fixture_tables import base_tables, line, order, write_landing

from terrace.plans.history import fold_rounds
from terrace.plans.sales import fact_batch, recent_orders
from terrace.plans.warehouse import StaleSource, build, freshness_report, require_fresh, run
from terrace.quality.checks import missing_unknown_member, negative_overhead, reconcile
from terrace.quality.contracts import CONTRACTS
from terrace.quality.suite import ContractBroken, run_suite
from terrace.sources.delimited import ingest_all
from terrace.sources.tables import read_partitions

AS_OF = "2013-01-15 00:00:00"
BACKDATE = "1900-01-01 00:00:00"


@pytest.fixture(scope="module")
def landed(spark, tmp_path_factory):
    folder = write_landing(tmp_path_factory.mktemp("landing"), base_tables())
    return ingest_all(spark, folder, "2013-01-15 01:00:00")


@pytest.fixture(scope="module")
def warehouse(landed):
    built = build(landed, AS_OF, initial_valid_from=BACKDATE)
    for layer in (built.history, built.gold):
        for name in layer:
            layer[name] = layer[name].cache()
    return built


def test_every_model_is_built(warehouse):
    assert len(warehouse.landed) == 22
    assert len(warehouse.staging) == 22
    assert len(warehouse.intermediate) == 6
    assert len(warehouse.history) == 3
    assert len(warehouse.gold) == 9


def test_staging_types_and_values(warehouse):
    header = warehouse.staging["stg_sales_order_header"]
    types = dict(header.dtypes)
    assert types["sub_total"] == "decimal(19,4)" and types["is_online_order"] == "boolean"
    assert types["order_date"] == "timestamp" and types["sales_order_bk"] == "int"
    assert rows_of(header.filter("sales_order_bk = 1"), "order_status", "modified_at") == [
        ("Shipped", ts("2013-07-31 00:00:00"))
    ]
    detail = warehouse.staging["stg_sales_order_detail"]
    assert dict(detail.dtypes)["line_total"] == "decimal(38,6)"
    assert "1-2" in [r[0] for r in rows_of(detail, "sales_order_line_bk")]
    people = warehouse.staging["stg_person"]
    assert rows_of(people.filter("person_bk in (101, 102)"), "full_name") == [
        ("First101 B Last101 Jr.",), ("First102 Last102",)
    ]
    assert "Demographics" not in people.columns
    assert rows_of(warehouse.staging["stg_credit_card"], "card_number_masked") == [("XXXXXXXXXX3344",)]
    assert rows_of(warehouse.staging["stg_customer"], "customer_bk", "customer_type") == [
        (1, "Individual"), (2, "Store"), (3, "StoreContact"), (4, "Unknown")
    ]
    product = warehouse.staging["stg_product"]
    assert rows_of(product.filter("product_bk = 707"), "product_line", "product_class") == [("R", "H")]
    assert list(product.columns)[0] == "product_bk"
    territory = warehouse.staging["stg_sales_territory"]
    assert rows_of(territory, "territory_group") == [("Europe",), ("North America",)]


def test_best_address_prefers_type_then_latest(warehouse):
    got = rows_of(warehouse.intermediate["int_customer_addresses"], "customer_bk", "city", "country_region_code")
    assert got == [(1, "Bothell", "US"), (2, None, None), (3, "Berlin", "DE"), (4, None, None)]


def test_employee_and_territory_current(warehouse):
    got = rows_of(warehouse.intermediate["int_employee_details"], "employee_bk", "pay_rate", "department_bk")
    assert got == [(274, Decimal("23.0769"), 3), (275, None, None)]
    got = rows_of(warehouse.intermediate["int_territory_current"], "sales_territory_bk", "current_sales_person_bk")
    assert got == [(1, 275), (2, None)]


def test_product_hierarchy_and_status(warehouse):
    got = rows_of(
        warehouse.intermediate["int_product_enriched"],
        "product_bk", "subcategory_name", "category_name", "product_status",
    )
    assert got == [
        (707, "Helmets", "Accessories", "Active"),
        (708, "Unassigned", "Unassigned", "Inactive"),
        (709, "Helmets", "Accessories", "Discontinued"),
    ]


def test_allocation_shares(warehouse):
    lines = warehouse.intermediate["int_sales_order_line_enriched"]
    assert dict(lines.dtypes)["allocated_freight"] == "decimal(38,6)"
    got = rows_of(lines, "sales_order_line_bk", "allocated_freight", "allocated_tax")
    assert got == [
        ("1-1", Decimal("0.25"), Decimal("0.8")),
        ("1-2", Decimal("0.5"), Decimal("1.6")),
        ("1-3", Decimal("1.75"), Decimal("5.6")),
        ("2-4", Decimal("2.5"), Decimal("8")),
        ("3-5", Decimal("0"), Decimal("0")),
    ]


def test_junk_combinations_and_missed_lookup(warehouse):
    combos = warehouse.intermediate["int_sales_order_flag_combinations"]
    assert rows_of(combos) == [
        ("Shipped", False, 0, "CARGO", "Vista"),
        ("Shipped", False, 8, "CARGO", "Vista"),
        ("Shipped", True, 8, "CARGO", "No Card"),
    ]
    fact = warehouse.gold["fct_sales_detail"]
    # order 3 has no revision number: defaulted in the dimension, not on the line
    missed = fact.filter("sales_order_junk_sk = '-1'")
    assert rows_of(missed, "sales_order_line_bk") == [("3-5",)]


def test_fact_grain_and_keys(warehouse):
    fact = warehouse.gold["fct_sales_detail"]
    assert fact.count() == 5
    got = rows_of(fact, "sales_order_line_bk", "order_date_sk", "ship_date_sk", "due_date_sk")
    assert got[0] == ("1-1", 20110531, 20110531, 20110531)
    assert got[3] == ("2-4", 20120712, -1, 20140712)
    assert fact.filter("employee_sk = '-1'").count() == 1
    assert fact.filter("product_sk = '-1' OR customer_sk = '-1'").count() == 0
    assert rows_of(fact.filter("sales_order_line_bk = '2-4'"), "discount_amount") == [(Decimal("5"),)]


def test_dimensions(warehouse):
    gold = warehouse.gold
    assert gold["dim_date"].count() == 1461 + 1
    assert gold["dim_customer"].count() == 5
    assert rows_of(gold["dim_customer"], "customer_bk", "customer_name")[:3] == [
        (-1, "Unknown"), (1, "First101 B Last101 Jr."), (2, "Corner Shop")
    ]
    offers = gold["dim_special_offer"]
    got = rows_of(offers, "special_offer_bk", "discount_tier", "is_active", "eligible_product_count")
    assert got == [(-1, "No Discount", False, 0), (1, "No Discount", False, 2), (2, "Medium (5-15%)", False, 0)]
    assert "national_id_number" not in gold["dim_employee"].columns
    assert gold["dim_sales_order_junk"].count() == 4


def test_mart_totals_match_fact(warehouse):
    fact, mart = warehouse.gold["fct_sales_detail"], warehouse.gold["mart_sales_summary"]
    assert reconcile(fact, "line_total", mart, "net_revenue", "fact", "mart").isEmpty()
    got = rows_of(
        mart, "year_number", "category_name", "employee_bk", "employee_name", "order_count", "units_sold",
        "net_revenue", "total_cost", "gross_profit",
    )
    assert got == [
        (2011, "Accessories", 274, "First274 Last274", 1, 3, Decimal("100"), Decimal("12"), Decimal("88")),
        (2012, "Accessories", 274, "First274 Last274", 1, 1, Decimal("0"), Decimal("4"), Decimal("-4")),
        (2012, "Unassigned", -1, "Unknown", 1, 2, Decimal("50"), Decimal("8"), Decimal("42")),
    ]
    types = dict(mart.dtypes)
    assert types["gross_revenue"] == "decimal(38,4)" and types["avg_units_per_order"] == "double"


def test_singular_checks(warehouse):
    gold = warehouse.gold
    assert negative_overhead(gold["fct_sales_detail"]).isEmpty()
    versioned = {n: gold[n] for n in ("dim_product", "dim_employee", "dim_salesterritory")}
    assert missing_unknown_member(versioned).isEmpty()


def test_contracts_hold_except_known_defects(warehouse):
    tables = warehouse.tables()
    broken = set()
    for name, items in CONTRACTS.items():
        report = run_suite(tables[name], name, items, tables)
        for row in report.filter("violations > 0").collect():
            broken.add((row.table_name, row.column_name, row.test))
    assert broken == {
        # the same order landed twice
        ("SalesOrderHeader", "SalesOrderID", "unique"),
        # a line without its order
        ("SalesOrderDetail", "SalesOrderID", "relationships"),
        ("stg_sales_order_detail", "sales_order_bk", "relationships"),
        # customer 4 has neither person nor store
        ("dim_customer", "customer_name", "not_null"),
        # an order without a revision number
        ("int_sales_order_line_enriched", "revision_number", "not_null"),
    }


def test_contract_columns_exist(warehouse):
    tables = warehouse.tables()
    for name, items in CONTRACTS.items():
        for check in items:
            missing = set(check.columns) - set(tables[name].columns)
            assert not missing, (name, missing)


def test_second_run_versions_changes_and_merges(spark, tmp_path):
    first_folder, second_folder = tmp_path / "one", tmp_path / "two"
    first_folder.mkdir(), second_folder.mkdir()
    tables = base_tables()
    first = run(
        spark, ingest_all(spark, write_landing(first_folder, tables), AS_OF), str(tmp_path / "wh"), AS_OF,
        initial_valid_from=BACKDATE,
    )
    assert first.gold["fct_sales_detail"].count() == 5

    later = "2013-08-01 00:00:00"
    tables["Product"][0]["ListPrice"] = "11.0000"
    tables["Product"].pop()
    tables["Employee"][0]["VacationHours"] = 99
    changed = "2013-07-31 12:00:00.0"
    tables["SalesOrderHeader"] = [
        order(5, "2013-08-05", ModifiedDate=changed),
        # an old order corrected outside the fact's window: staging takes it, the fact does not
        order(1, "2011-05-31", Status=6, ModifiedDate=changed),
    ]
    tables["SalesOrderDetail"] = [line(5, 7, "30.000000", ModifiedDate=changed)]
    second = run(
        spark, ingest_all(spark, write_landing(second_folder, tables), later), str(tmp_path / "wh"), later,
    )
    header = second.staging["stg_sales_order_header"]
    assert header.count() == 5
    assert rows_of(header.filter("sales_order_bk = 1"), "order_status") == [("Cancelled",)]

    versions = rows_of(second.history["snap_product"], "product_bk", "list_price", "valid_from", "valid_to")
    start, now = ts(BACKDATE), ts(later)
    assert versions == [
        (707, Decimal("11"), now, None),
        (707, Decimal("9"), start, now),
        (708, Decimal("9"), start, None),
        (709, Decimal("9"), start, now),
    ]
    assert second.history["snap_employee"].count() == 2

    # a third run closes nothing: it rewrites the open versions and keeps the closed ones
    again = run(
        spark, ingest_all(spark, str(second_folder), later), str(tmp_path / "wh"), "2013-09-01 00:00:00",
    )
    assert rows_of(again.history["snap_product"], "product_bk", "list_price", "valid_from", "valid_to") == versions
    assert again.gold["fct_sales_detail"].count() == 6
    closed = sorted(p.name for p in (tmp_path / "wh" / "snap_product").glob("run=*/closed_at=*") if any(p.iterdir()))
    assert closed.count("closed_at=0") == 3 and len(closed) == 4

    fact = second.gold["fct_sales_detail"]
    assert fact.count() == 6
    priced = fact.join(second.gold["dim_product"], "product_sk").filter("sales_order_bk = 5")
    assert rows_of(priced, "list_price") == [(Decimal("11"),)]
    old_flags = fact.filter("sales_order_bk = 1").join(second.gold["dim_sales_order_junk"], "sales_order_junk_sk")
    assert {r.order_status for r in old_flags.collect()} == {"Shipped"}


def test_lookback_on_the_change_time_takes_late_corrections(warehouse):
    gold, lines = warehouse.gold, warehouse.intermediate["int_sales_order_line_enriched"]
    stored = gold["fct_sales_detail"]
    assert fact_batch(lines, gold, stored).count() == 1  # order 2 is eight days older than order 3
    assert fact_batch(lines, gold, stored, lookback="modified_at").count() == 5


def test_hot_key_split_gives_the_same_fact(spark, landed, warehouse):
    split = build(landed, AS_OF, initial_valid_from=BACKDATE, hot_share=0.2)
    plain = warehouse.gold["fct_sales_detail"]
    columns = [c for c in plain.columns]
    assert rows_of(split.gold["fct_sales_detail"], *columns) == rows_of(plain, *columns)


def clean_tables():
    """The fixture without its defects."""
    tables = base_tables()
    tables["SalesOrderHeader"] = [
        {**o, "RevisionNumber": 8} for o in tables["SalesOrderHeader"] if "ModifiedDate" not in o
    ]
    tables["SalesOrderDetail"] = [d for d in tables["SalesOrderDetail"] if d["SalesOrderID"] != 99]
    tables["Customer"] = tables["Customer"][:3]
    return tables


def test_contracts_gate_the_run(spark, tmp_path):
    folder = tmp_path / "clean"
    folder.mkdir()
    sound = ingest_all(spark, write_landing(folder, clean_tables()), AS_OF)
    built = run(spark, sound, str(tmp_path / "wh"), AS_OF, initial_valid_from=BACKDATE, check=True)
    assert built.gold["mart_sales_summary"].count() == 3


def test_a_broken_contract_stops_the_run(spark, tmp_path):
    folder = tmp_path / "broken"
    folder.mkdir()
    tables = clean_tables()
    tables["SpecialOffer"][0]["DiscountPct"] = "1.5000"
    landed = ingest_all(spark, write_landing(folder, tables), AS_OF)
    with pytest.raises(ContractBroken, match="stg_special_offer.discount_pct value_between 0..1: 1"):
        run(spark, landed, str(tmp_path / "wh"), AS_OF, check=True)
    # only the merged staging tables were written, nothing built on the failed one
    assert {p.name for p in (tmp_path / "wh").iterdir()} == {"stg_sales_order_header", "stg_sales_order_detail"}


def test_stale_sources_stop_the_run(spark, landed):
    levels = {r.table_name: r.status for r in freshness_report(landed, "2013-01-16 12:00:00").collect()}
    assert set(levels.values()) == {"warn", "pass"} and "Customer" in levels
    assert "Customer" in require_fresh(freshness_report(landed, "2013-01-16 12:00:00"))
    with pytest.raises(StaleSource, match="Customer"):
        require_fresh(freshness_report(landed, "2013-01-18 00:00:00"))
    with pytest.raises(StaleSource):
        require_fresh(freshness_report({"Customer": landed["Customer"].limit(0)}, AS_OF))


def test_missing_files_are_named_together(spark, tmp_path):
    folder = write_landing(tmp_path, base_tables())
    (tmp_path / "Person.csv").unlink()
    (tmp_path / "Store.csv").unlink()
    with pytest.raises(FileNotFoundError, match="2 of 22 .*Person, Store"):
        ingest_all(spark, folder, AS_OF)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def scans(df):
    return [line for line in plan(df).splitlines() if "FileScan" in line]


def test_increments_read_their_slice(spark, tmp_path):
    folder, base = tmp_path / "in", str(tmp_path / "wh")
    folder.mkdir()
    run(spark, ingest_all(spark, write_landing(folder, base_tables()), AS_OF), base, AS_OF, initial_valid_from=BACKDATE)
    header, detail, fact = (
        read_partitions(spark, f"{base}/{n}") for n in ("stg_sales_order_header", "stg_sales_order_detail", "fct_sales_detail")
    )
    recent_header, recent_detail = recent_orders(header, detail, fact)
    assert rows_of(recent_header, "sales_order_bk") == [(3,), (4,)] and recent_detail.count() == 1
    for part in (recent_header, recent_detail):
        filters = [line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans(part)]
        assert any("order_block" in f for f in filters)
    again = recent_orders(header, detail, fact, lookback="modified_at")
    assert again[0].count() >= recent_header.count()

    # the next run's snapshot reads open versions, and its write holds no older closed ones
    history = read_partitions(spark, f"{base}/snap_product")
    open_rows = history.filter("closed_at IN (0, 1)")
    assert all("closed_at" in line.split("PartitionFilters:")[1].split("PushedFilters")[0] for line in scans(open_rows))


def test_run_on_empty_sources(spark, tmp_path):
    folder, base = tmp_path / "empty", str(tmp_path / "wh")
    folder.mkdir()
    nothing = ingest_all(spark, write_landing(folder, base_tables()), AS_OF)
    nothing = {name: table.limit(0) for name, table in nothing.items()}
    first = run(spark, nothing, base, AS_OF)
    assert first.gold["fct_sales_detail"].count() == 0 and first.history["snap_product"].count() == 0
    filled = ingest_all(spark, str(folder), AS_OF)
    second = run(spark, filled, base, "2014-07-01 00:00:00")
    assert second.gold["fct_sales_detail"].count() == 5 and second.history["snap_product"].count() == 3


def test_planned_scans_of_a_fold_do_not_double(spark, frame):
    rounds = [(f"20{10 + k}-01-01 00:00:00", frame([(1, k), (2, 0)], "k int, v int")) for k in range(6)]
    counts = [plan(fold_rounds(rounds[:n], "k", ["v"])).count("FileScan") for n in range(1, 7)]
    assert counts == [1] * 6
    assert fold_rounds(rounds, "k", ["v"]).count() == 7
