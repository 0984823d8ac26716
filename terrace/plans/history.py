"""The three type-2 histories: what they track and which changes open a version."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import moment
from ..operators.history import scd2_snapshot
from ..sources.tables import compact_partitions, partition_values, read_partitions, retire_runs, stored, write_partitions


@dataclass(frozen=True)
class Tracked:
    key: str
    columns: tuple[str, ...]
    check: tuple[str, ...]


# --- fixed values: tracked columns, and the ones whose change opens a version ------

PRODUCT = Tracked(
    key="product_bk",
    columns=(
        "product_bk", "product_name", "product_number", "is_make", "is_finished_good", "color",
        "product_line", "product_class", "product_style", "size", "weight", "standard_cost",
        "list_price", "days_to_manufacture", "product_subcategory_bk", "subcategory_name",
        "product_category_bk", "category_name", "product_status", "sell_start_at", "sell_end_at",
        "discontinued_at",
    ),
    check=(
        "product_name", "list_price", "standard_cost", "product_subcategory_bk",
        "product_category_bk", "subcategory_name", "category_name", "product_status", "color", "size",
    ),
)

EMPLOYEE = Tracked(
    key="employee_bk",
    columns=(
        "employee_bk", "first_name", "middle_name", "last_name", "full_name", "login_id",
        "national_id_number", "job_title", "organization_node", "organization_level",
        "department_bk", "birth_date", "marital_status", "gender", "hire_date", "is_salaried",
        "is_active_employee", "pay_rate", "pay_frequency",
    ),
    check=(
        "job_title", "department_bk", "organization_node", "organization_level", "pay_rate",
        "pay_frequency", "is_salaried", "is_active_employee", "marital_status",
    ),
)

TERRITORY = Tracked(
    key="sales_territory_bk",
    columns=(
        "sales_territory_bk", "territory_name", "country_region_code", "territory_group",
        "current_sales_person_bk", "sales_ytd", "sales_last_year", "cost_ytd", "cost_last_year",
    ),
    check=("territory_name", "country_region_code", "territory_group", "current_sales_person_bk"),
)

# --- end of fixed values -----------------------------------------------------------


def snapshot(
    tracked: Tracked, history: DataFrame | None, current: DataFrame, as_of, initial_valid_from=None
) -> DataFrame:
    return scd2_snapshot(
        history, current.select(*tracked.columns), tracked.key, tracked.check, as_of, initial_valid_from
    )


# Closed versions never change again, so a stored history is split by the second of the
# run that closed them: a run writes the open versions (0) and those it closed itself.
CLOSED_AT = "closed_at"


def closing_second(spark: SparkSession, as_of) -> int:
    return spark.range(1).select(F.unix_timestamp(moment(as_of))).first()[0]


def read_history(spark: SparkSession, base: str, closing: int | None = None) -> DataFrame | None:
    """A stored history, or with ``closing`` what that run changes: the open versions and those it closed before; None if never written."""
    table = read_partitions(spark, base)
    if table is None:
        return None
    return (table if closing is None else table.filter(F.col(CLOSED_AT).isin(0, closing))).drop(CLOSED_AT)


def write_history(history: DataFrame, base: str, closing: int, fan: int = 8) -> DataFrame:
    """Store the outcome of a run that read ``read_history(spark, base, closing)``, and read the whole history back.

    Older closed versions are neither read nor rewritten, but for neighbours of a like size
    that are merged into a range of closing times (see ``compact_partitions``), so
    the number of partitions grows with the logarithm of the size, not with the runs.
    Those of this run and the newest closed before it are never merged, so the last run
    can be repeated. Superseded runs are deleted; readers of the state before this run keep theirs.
    """
    spark = history.sparkSession
    closed = [v for v in partition_values(spark, base, CLOSED_AT) if v not in (0, closing)]
    compact_partitions(spark, base, CLOSED_AT, closed[:-1], fan)
    # All closed rows of ``history`` were closed by the run at ``closing``.
    label = F.when(F.col("valid_to").isNull(), F.lit(0)).otherwise(F.lit(closing)).cast("bigint")
    write_partitions(history.withColumn(CLOSED_AT, label), base, CLOSED_AT, [0, closing])
    retire_runs(spark, base, states=3)
    return read_history(spark, base)


def fold_stored(rounds, key: str, check, base: str, initial_valid_from=None, fan: int = 8) -> DataFrame:
    """The history after several (as_of, current state) runs on a table stored under ``base``."""
    history = None
    for as_of, current in rounds:
        closing = closing_second(current.sparkSession, as_of)
        state = read_history(current.sparkSession, base, closing)
        history = write_history(scd2_snapshot(state, current, key, check, as_of, initial_valid_from), base, closing, fan)
    return history


def fold_rounds(rounds, key: str, check, initial_valid_from=None, name: str = "history") -> DataFrame:
    """The history after several (as_of, current state) rounds.

    Each round is written before the next reads it, as between runs of a warehouse, so
    the plan of a round does not hold the plans of those before.
    """
    history = None
    for as_of, current in rounds:
        history = stored(scd2_snapshot(history, current, key, check, as_of, initial_valid_from), name)
    return history
