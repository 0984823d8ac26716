"""Declared checks of a table and their one-table report."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import checks


@dataclass(frozen=True)
class Check:
    test: str
    columns: tuple[str, ...] = ()
    values: tuple = ()
    expression: str | None = None
    parent: str | None = None
    low: object = None
    high: object = None
    scope: str | None = None

    @property
    def label(self) -> str:
        return ",".join(self.columns)

    @property
    def detail(self) -> str:
        """What tells two checks of one kind on the same columns apart."""
        parts = [self.expression, self.parent, ",".join(map(str, self.values)) or None]
        if self.low is not None or self.high is not None:
            parts.append(f"{'' if self.low is None else self.low}..{'' if self.high is None else self.high}")
        if self.scope:
            parts.append(f"where {self.scope}")
        return " ".join(p for p in parts if p)


def not_null(*columns: str, where: str | None = None) -> list[Check]:
    return [Check("not_null", (c,), scope=where) for c in columns]


def unique(*columns: str, where: str | None = None) -> list[Check]:
    return [Check("unique", (c,), scope=where) for c in columns]


def key(column: str) -> list[Check]:
    return not_null(column) + unique(column)


def accepted(column: str, *values, where: str | None = None) -> list[Check]:
    return [Check("accepted_values", (column,), values=values, scope=where)]


def related(column: str, parent: str, where: str | None = None) -> list[Check]:
    """``parent`` reads ``table.column``."""
    return [Check("relationships", (column,), parent=parent, scope=where)]


def together(*columns: str) -> list[Check]:
    return [Check("unique_combination", columns)]


def holds(expression: str, column: str | None = None, where: str | None = None) -> list[Check]:
    return [Check("expression_is_true", (column,) if column else (), expression=expression, scope=where)]


def between(*columns: str, low=None, high=None, where: str | None = None) -> list[Check]:
    return [Check("value_between", (c,), low=low, high=high, scope=where) for c in columns]


def matches(column: str, pattern: str) -> list[Check]:
    return [Check("matches_regex", (column,), expression=pattern)]


def no_overlap(column: str) -> list[Check]:
    return [Check("scd2_no_overlap", (column,))]


def contract(*groups: Iterable[Check]) -> list[Check]:
    return [check for group in groups for check in group]


def narrowed(items: Sequence[Check], scope: str) -> list[Check]:
    return [replace(c, scope=scope) for c in items]


ROW_LOCAL = {"not_null", "accepted_values", "value_between", "matches_regex", "expression_is_true"}


def broken(check: Check) -> Column:
    """True on a row that violates a row-local check."""
    if check.test == "not_null":
        bad = checks.is_missing(check.columns[0])
    elif check.test == "accepted_values":
        bad = checks.is_unaccepted(check.columns[0], check.values)
    elif check.test == "value_between":
        bad = checks.is_outside(check.columns[0], check.low, check.high)
    elif check.test == "matches_regex":
        bad = checks.is_unmatched(check.columns[0], check.expression)
    else:
        bad = checks.is_untrue(check.expression, check.columns[0] if check.columns else None)
    return bad if check.scope is None else F.expr(check.scope) & bad


def violations(df: DataFrame, check: Check, tables: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """The rows (or keys) that break one check."""
    if check.test in ROW_LOCAL:
        return df.filter(broken(check))
    if check.test == "unique":
        return checks.unique(df, check.columns[0], check.scope)
    if check.test == "unique_combination":
        return checks.unique_combination(df, check.columns, check.scope)
    if check.test == "relationships":
        table, column = check.parent.rsplit(".", 1)
        return checks.relationships(df, check.columns[0], tables[table], column, check.scope)
    if check.test == "scd2_no_overlap":
        return checks.scd2_overlaps(df, check.columns[0])
    raise ValueError(f"unknown check {check.test!r}")


def _count_broken(df: DataFrame, check: Check, tables) -> DataFrame:
    if check.test == "relationships":
        table, column = check.parent.rsplit(".", 1)
        orphans = checks.orphan_keys(df, check.columns[0], tables[table], column, check.scope)
        return orphans.agg(F.coalesce(F.sum("n_rows"), F.lit(0)).cast("bigint").alias("violations"))
    return violations(df, check, tables).agg(F.count("*").alias("violations"))


def run_suite(
    df: DataFrame,
    name: str,
    items: Sequence[Check],
    tables: Mapping[str, DataFrame] | None = None,
) -> DataFrame:
    """One row per check: table_name, column_name, test, detail, violations.

    All row-local checks share a single aggregate pass over the table; only the
    checks over keys shuffle, each on its own key.
    """

    def described(check: Check, counted: Column) -> list[Column]:
        return [
            F.lit(name).alias("table_name"),
            F.lit(check.label).alias("column_name"),
            F.lit(check.test).alias("test"),
            F.lit(check.detail).alias("detail"),
            counted.cast("bigint").alias("violations"),
        ]

    reports = []
    local = [c for c in items if c.test in ROW_LOCAL]
    if local:
        counts = df.agg(*[F.count_if(broken(c)).alias(f"c{i}") for i, c in enumerate(local)])
        rows = F.array(*[F.struct(*described(c, F.col(f"c{i}"))) for i, c in enumerate(local)])
        reports.append(counts.select(F.explode(rows).alias("r")).select("r.*"))
    for check in items:
        if check.test not in ROW_LOCAL:
            counted = _count_broken(df, check, tables)
            reports.append(counted.select(*described(check, F.col("violations"))))
    return reduce(DataFrame.unionByName, reports)


class ContractBroken(ValueError):
    """A table violates its declared checks."""


def enforce(report: DataFrame) -> None:
    """Stop the branch when any check of a report found violations.

    A report has one row per declared check, so all that failed are named.
    """
    failed = report.filter("violations > 0").orderBy("table_name", "column_name", "test", "detail").collect()
    if failed:
        lines = [f"{r.table_name}.{r.column_name} {r.test} {r.detail}: {r.violations}" for r in failed]
        raise ContractBroken("; ".join(lines))
