"""One run of the whole warehouse, lazily or into versioned tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.incremental import merge_upsert
from ..operators.joins import heavy_hitters
from ..quality import checks
from ..quality.suite import enforce, run_suite
from ..sources.registry import SOURCES, freshness_hours
from ..sources.tables import (
    holds_partitions,
    merge_partitions,
    read_current,
    read_marks,
    read_partitions,
    retire_runs,
    stored,
    write_version,
)
from . import dimensions, history, intermediate, sales, staging

HISTORIES = ("snap_product", "snap_employee", "snap_salesterritory")
STATE_TABLES = (*staging.MERGE_KEYS, *HISTORIES, "fct_sales_detail")


@dataclass
class Warehouse:
    """Tables of one run by layer; ``state`` is what the next run needs."""

    landed: dict[str, DataFrame]
    staging: dict[str, DataFrame] = field(default_factory=dict)
    intermediate: dict[str, DataFrame] = field(default_factory=dict)
    history: dict[str, DataFrame] = field(default_factory=dict)
    gold: dict[str, DataFrame] = field(default_factory=dict)
    warnings: list[str] = field(default_factory=list)

    @property
    def state(self) -> dict[str, DataFrame]:
        everything = self.tables()
        return {name: everything[name] for name in STATE_TABLES}

    def tables(self) -> dict[str, DataFrame]:
        return {**self.landed, **self.staging, **self.intermediate, **self.history, **self.gold}


@dataclass(frozen=True)
class Merged:
    """How a merge-loaded table is keyed and, when stored, split into partitions."""

    keys: tuple[str, ...]
    partition: str
    partition_value: Callable[[], Column]
    marks: tuple[str, ...]  # time columns whose bounds are kept for the next run's lookback


def _order_block() -> Column:
    return F.floor(F.coalesce(F.col("sales_order_bk"), F.lit(-1)) / 1_000_000).cast("int")


# All three are split by their order, which their keys contain, so no row ever moves.
MERGED = {
    "stg_sales_order_header": Merged(("sales_order_bk",), "order_block", _order_block, ("modified_at",)),
    "stg_sales_order_detail": Merged(("sales_order_line_bk",), "order_block", _order_block, ("modified_at",)),
    "fct_sales_detail": Merged((sales.FACT_KEY,), "order_block", _order_block, ("order_date", "updated_at")),
}


# Keys with more of a batch's lines than this are split in the joins of a stored run.
HOT_SHARE = 0.02


def build(
    landed: Mapping[str, DataFrame],
    as_of,
    state: Mapping[str, DataFrame] | None = None,
    initial_valid_from=None,
    keep=lambda name, df: df,
    merge=lambda name, target, batch: merge_upsert(target, batch, MERGED[name].keys, check_unique=False),
    inspect=lambda tables: None,
    hot_share: float | None = None,
    hold=lambda name, df: df,
    marks: Mapping[str, DataFrame] | None = None,
) -> Warehouse:
    """Wire all models in dependency order.

    ``state`` holds the previous run's ``STATE_TABLES``. ``keep`` is called on
    the histories, dimensions and mart, ``merge`` on the batches of the three
    merge-loaded tables; both return what later models read: a lazy frame by
    default, a written table in ``run``. Models in between stay lazy and are
    optimised as part of their readers. ``inspect`` sees the landed, staging
    and intermediate tables before anything is built on them. ``hold`` is called
    on the enriched lines of the fact's batch, which are read once per lookup
    where ``hot_share`` looks for keys to split. ``marks`` holds the kept time
    bounds of the merge-loaded tables, which spare a scan of them.
    """
    state, marks = state or {}, marks or {}
    w = Warehouse(dict(landed))
    inspect(w.landed)
    w.staging = staging.stage_views(landed)
    orders: dict[str, DataFrame] = {}  # with their partition column, where they are stored
    for source in ("SalesOrderHeader", "SalesOrderDetail"):
        name = SOURCES[source].staged_as
        batch = staging.staged_batch(source, landed[source], state.get(name), marks.get(name))
        orders[name] = merge(name, state.get(name), batch)
        w.staging[name] = orders[name].drop(MERGED[name].partition)
    s = w.staging
    inspect(s)

    mid = w.intermediate
    mid["int_customer_addresses"] = intermediate.customer_addresses(
        s["stg_customer"], s["stg_person"], s["stg_business_entity"],
        s["stg_business_entity_address"], s["stg_address"], s["stg_state_province"],
    )
    mid["int_employee_details"] = intermediate.employee_details(
        s["stg_employee"], s["stg_person"], s["stg_employee_pay_history"], s["stg_employee_dept_history"]
    )
    mid["int_product_enriched"] = intermediate.product_enriched(
        s["stg_product"], s["stg_product_subcategory"], s["stg_product_category"], as_of
    )
    mid["int_territory_current"] = intermediate.territory_current(
        s["stg_sales_territory"], s["stg_sales_territory_history"]
    )
    mid["int_sales_order_flag_combinations"] = intermediate.order_flag_combinations(
        s["stg_sales_order_header"], s["stg_ship_method"], s["stg_credit_card"]
    )
    mid["int_sales_order_line_enriched"] = intermediate.order_lines_enriched(
        s["stg_sales_order_detail"], s["stg_sales_order_header"], s["stg_ship_method"], s["stg_credit_card"]
    )
    inspect(mid)

    tracked = {
        "snap_product": (history.PRODUCT, mid["int_product_enriched"]),
        "snap_employee": (history.EMPLOYEE, mid["int_employee_details"]),
        "snap_salesterritory": (history.TERRITORY, mid["int_territory_current"]),
    }
    for name, (what, current) in tracked.items():
        w.history[name] = keep(
            name, history.snapshot(what, state.get(name), current, as_of, initial_valid_from)
        )

    gold = {
        "dim_customer": dimensions.dim_customer(
            s["stg_customer"], s["stg_person"], s["stg_store"], mid["int_customer_addresses"]
        ),
        "dim_product": dimensions.dim_product(w.history["snap_product"]),
        "dim_employee": dimensions.dim_employee(w.history["snap_employee"]),
        "dim_salesterritory": dimensions.dim_salesterritory(w.history["snap_salesterritory"]),
        "dim_date": dimensions.dim_date(s["stg_sales_order_header"]),
        "dim_special_offer": dimensions.dim_special_offer(
            s["stg_special_offer"], s["stg_special_offer_product"], as_of
        ),
        "dim_sales_order_junk": dimensions.dim_sales_order_junk(mid["int_sales_order_flag_combinations"]),
    }
    for name, dim in gold.items():
        w.gold[name] = keep(name, dim)

    stored_fact = state.get("fct_sales_detail")
    header, detail = sales.recent_orders(
        orders["stg_sales_order_header"], orders["stg_sales_order_detail"], stored_fact, marks=marks.get("fct_sales_detail")
    )
    hot_orders = [] if hot_share is None else heavy_hitters(detail, [sales.ORDER], hot_share)[sales.ORDER]
    recent = intermediate.order_lines_enriched(detail, header, s["stg_ship_method"], s["stg_credit_card"], hot_orders)
    # Whole orders of the window were taken, so the lines need no second cut.
    batch = sales.sales_fact(hold("recent_lines", recent), w.gold, hot_share)
    merged = merge("fct_sales_detail", stored_fact, batch)
    w.gold["fct_sales_detail"] = merged.drop(MERGED["fct_sales_detail"].partition)
    w.gold["mart_sales_summary"] = keep(
        "mart_sales_summary", sales.sales_mart(w.gold["fct_sales_detail"], w.gold)
    )
    return w


class StaleSource(ValueError):
    """A source is older than its error level allows."""


def freshness_report(landed: Mapping[str, DataFrame], as_of) -> DataFrame:
    """One row per source with declared levels: table_name, max_loaded_at, age_seconds, status."""
    levels = {name: freshness_hours(name) for name in landed}
    rows = [
        checks.freshness(landed[name], "LoadedAt", as_of, *hours).select(F.lit(name).alias("table_name"), "*")
        for name, hours in levels.items()
        if hours is not None
    ]
    return reduce(DataFrame.unionByName, rows)


def require_fresh(report: DataFrame) -> list[str]:
    """Stop on sources at error level; return those at warn level. One row per source is collected."""
    status = {r["table_name"]: r["status"] for r in report.collect()}
    stale = sorted(name for name, level in status.items() if level == "error")
    if stale:
        raise StaleSource(f"sources past their error level: {', '.join(stale)}")
    return sorted(name for name, level in status.items() if level == "warn")


def run(
    spark: SparkSession,
    landed: Mapping[str, DataFrame],
    base: str,
    as_of,
    initial_valid_from=None,
    check: bool = False,
    hot_share: float | None = HOT_SHARE,
) -> Warehouse:
    """Build on top of the newest finished state under ``base`` and write the next.

    Each stored table is read back after its write, which cuts the lineage of
    everything after it and lets Catalyst see its true size. A merge-loaded
    table rewrites only the partitions its batch touches, a history only its
    open versions and the ones closed by this run. The lookbacks read the time
    bounds that earlier runs kept with their partitions, keys with more than
    ``hot_share`` of a batch's lines are split in its joins, and files that neither
    the newest state nor the one before reads are deleted. Closed versions of many runs
    are merged into ranges of closing times. With ``check`` the sources
    must be fresh (``warnings`` names those at warn level) and the contracts of
    every table must hold before anything downstream is built.
    """
    from ..quality.contracts import CONTRACTS

    closing = history.closing_second(spark, as_of)

    def read(name: str) -> DataFrame | None:
        if name in MERGED:
            return read_partitions(spark, f"{base}/{name}")
        return read_current(spark, f"{base}/{name}")

    def read_state(name: str) -> DataFrame | None:
        """What this run changes or looks back at: of a history the open versions, and those closed at its own time.

        A merged table that never got a row is as good as none: the next run is its first.
        """
        if name not in HISTORIES:
            return read(name) if holds_partitions(spark, f"{base}/{name}") else None
        return history.read_history(spark, f"{base}/{name}", closing)

    state = {name: table for name in STATE_TABLES if (table := read_state(name)) is not None}
    done: dict[str, DataFrame] = {}

    def inspect(tables: Mapping[str, DataFrame]) -> None:
        done.update(tables)
        for name in tables:
            if check and name in CONTRACTS:
                enforce(run_suite(done[name], name, CONTRACTS[name], done))

    def checked(name: str, table: DataFrame) -> DataFrame:
        # Merged staging tables are inspected with their layer, whose tables they refer to.
        if name not in staging.MERGE_KEYS:
            inspect({name: table})
        return table

    def keep(name: str, df: DataFrame) -> DataFrame:
        if name in HISTORIES:
            return checked(name, history.write_history(df, f"{base}/{name}", closing))
        return checked(name, write_version(df, f"{base}/{name}"))

    def merge(name: str, target: DataFrame | None, batch: DataFrame) -> DataFrame:
        how = MERGED[name]
        # The batch is read several times by the merge.
        split = stored(batch.withColumn(how.partition, how.partition_value()), f"{name}_batch")
        merged = merge_partitions(split, f"{base}/{name}", how.keys, how.partition, marks=how.marks)
        retire_runs(spark, f"{base}/{name}")
        return checked(name, merged)

    warnings = require_fresh(freshness_report(landed, as_of)) if check else []
    marks = {name: read_marks(spark, f"{base}/{name}", how.partition, how.marks) for name, how in MERGED.items() if name in state}
    built = build(landed, as_of, state, initial_valid_from, keep, merge, inspect, hot_share, lambda name, df: stored(df, name), marks)
    built.warnings = warnings
    return built
