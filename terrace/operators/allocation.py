"""Pro-rating of header amounts to lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .joins import in_list, repeated_slots, spread_slot

SHARE_TYPE = "decimal(38,6)"
# Amounts and weights are counted in millionths. Products of an amount below 10^12 and a weight
# below 10^13 fit in a decimal; others are divided in parts of seven digits.
AMOUNT_TYPE, AMOUNT_UNITS = "decimal(21,6)", "decimal(21,0)"
WEIGHT_UNITS, LARGEST_WEIGHT = "decimal(30,0)", "1e24BD"
CUT_UNITS = "decimal(31,0)"
PART = 10_000_000


def _units(value: Column) -> Column:
    return value * F.lit(1_000_000)


def _with_cuts(joined: DataFrame, weight: str, amounts: Mapping[str, str]) -> DataFrame:
    """Add for each output ``_units_<name>`` (the amount) and ``_cut_<name>`` (the line's share, cut), in millionths.

    Where a product may pass 38 digits, the amount is divided in three parts from the
    left, each with the remainder of the one before.
    Weights of 10^24 and more lose their last eight digits before the division.
    """
    huge = F.greatest("_largest", "_total") >= F.expr(LARGEST_WEIGHT)
    hundred = F.lit(100).cast("decimal(3,0)")

    def counted(value: Column) -> Column:
        return F.when(huge, (value - value % hundred) / hundred).otherwise(_units(value)).cast(WEIGHT_UNITS)

    units = {f"_units_{name}": _units(F.col(amount).cast(AMOUNT_TYPE)).cast(AMOUNT_UNITS) for name, amount in amounts.items()}
    positive = F.col("_total") > 0
    joined = joined.withColumns({**units, "_weight": F.when(positive, counted(F.col(weight))), "_over": F.when(positive, counted(F.col("_total")))})
    return joined.withColumns({f"_cut_{name}": F.expr(_cut(f"`_units_{name}`")) for name in amounts})


def _cut(units: str) -> str:
    """``units * _weight div _over``; the long division is a fold, which only rows that need it evaluate.

    Written out as columns it makes the generated method too large to be compiled.
    """
    number = "decimal(38,0)"
    parts = ", ".join(f"cast(({units} % {above} - {units} % {size}) / {size} as decimal(7,0))" for above, size in ((PART * PART, PART), (PART, 1)))
    parts = f"array(cast(({units} - {units} % {PART * PART}) / {PART * PART} as decimal(7,0)), {parts})"
    x = f"cast(s.r * {PART} + part * _weight as {number})"
    step = f"named_struct('q', cast(s.q * {PART} + ({x} - {x} % _over) / _over as {number}), 'r', cast({x} % _over as {number}))"
    start = f"named_struct('q', cast(0 as {number}), 'r', cast(0 as {number}))"
    long = f"aggregate({parts}, {start}, (s, part) -> {step}, s -> s.q)"
    product = f"cast({units} as decimal(18,0)) * cast(_weight as decimal(19,0)) div _over"
    wide = f"NOT (abs({units}) < 1e18BD AND abs(_weight) < 1e19BD AND abs(_weight) <= _over)"
    return f"CASE WHEN {wide} THEN cast(coalesce({long}, 0) as {CUT_UNITS}) ELSE cast(coalesce({product}, 0L) as {CUT_UNITS}) END"


def allocate(
    lines: DataFrame,
    headers: DataFrame,
    key: str,
    weight: str,
    amounts: Mapping[str, str],
    line_key: str,
    hot: Sequence = (),
    salts: int = 32,
) -> DataFrame:
    """Join lines to their header and split header ``amounts`` (output -> header column) by ``weight``.

    A line gets ``amount * weight / total`` cut to millionths, and the line with the
    smallest ``line_key`` of its order (unique there, a number) also what the cut left
    over: shares sum back to the amount exactly, however many lines there are, and none
    is negative unless the amount or a weight is. Amounts may be any DECIMAL(19,4),
    weights any DECIMAL(38,6) whose sum is one. Lines without a header are dropped; where
    the total is zero, negative or missing every share is 0, and so is the share of a
    line without a weight.

    Lines are shuffled once, by order: the header, the total, the cut shares and the line
    that takes the rest are found in that partitioning; frames of large orders spill.
    ``hot`` (from ``heavy_hitters``) lists orders too large for one task: their lines are
    spread over ``salts`` slots and their totals, one row per listed order, are
    aggregated beforehand and sent to every task.
    """
    weighed = F.when(F.col(weight).isNotNull(), F.col(line_key))
    totals = {"_total": F.sum(weight), "_largest": F.max(F.abs(weight)), "_rest_line": F.min(weighed)}
    given = {f"_given_{name}": F.sum(f"_cut_{name}") for name in amounts}
    hot = [value for value in hot if value is not None]
    if hot:
        spread = lines.withColumn("_slot", spread_slot(in_list(key, hot), [line_key], salts))
        slotted = headers.withColumn("_slot", F.explode(repeated_slots(in_list(key, hot), salts)))
        joined, frame = spread.join(slotted, [key, "_slot"]), Window.partitionBy(key, "_slot")
        # One row per hot order.
        large = lines.where(in_list(key, hot))
        large_totals = large.groupBy(key).agg(*[v.alias(k) for k, v in totals.items()])
        cuts = _with_cuts(large.join(headers.where(in_list(key, hot)), key).join(F.broadcast(large_totals), key), weight, amounts)
        large_given = cuts.groupBy(F.col(key).alias("_hot_key")).agg(*[v.alias(f"_hot{k}") for k, v in given.items()])
        large_totals = large_totals.select(F.col(key).alias("_hot_key"), *[F.col(k).alias(f"_hot{k}") for k in totals])
    else:
        joined, frame = lines.join(headers, key), Window.partitionBy(key)

    def totalled(df: DataFrame, values: Mapping[str, Column], known: DataFrame | None) -> DataFrame:
        df = df.withColumns({k: v.over(frame) for k, v in values.items()})
        if known is None:
            return df
        df = df.join(F.broadcast(known), F.col(key) == F.col("_hot_key"), "left")
        df = df.withColumns({k: F.when(F.col("_hot_key").isNull(), F.col(k)).otherwise(F.col(f"_hot{k}")) for k in values})
        return df.drop("_hot_key", *[f"_hot{k}" for k in values])

    whole = _with_cuts(totalled(joined, totals, large_totals if hot else None), weight, amounts)
    whole = totalled(whole, given, large_given if hot else None)
    takes_rest = (F.col("_total") > 0) & (F.col(line_key) == F.col("_rest_line"))
    millionth = F.lit("0.000001").cast("decimal(6,6)")

    def share(name: str) -> Column:
        rest = F.coalesce(F.col(f"_units_{name}"), F.lit(0)) - F.col(f"_given_{name}")
        units = F.col(f"_cut_{name}") + F.when(takes_rest, rest).otherwise(F.lit(0))
        return (units.cast(CUT_UNITS) * millionth).cast(SHARE_TYPE)

    helpers = [f"_{part}_{name}" for name in amounts for part in ("units", "cut", "given")]
    whole = whole.withColumns({name: share(name) for name in amounts})
    return whole.drop("_slot", "_weight", "_over", *totals, *helpers)
