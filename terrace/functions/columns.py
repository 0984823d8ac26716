"""Scalar building blocks shared by the staging, dimension and fact plans."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stands in for NULL inside a hashed key, so that NULL and '' hash apart.
NULL_TOKEN = "_null_"

UNKNOWN_SK = "-1"
UNKNOWN_KEY = -1
UNKNOWN_LABEL = "Unknown"


def as_column(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def moment(as_of: str | date | datetime | Column) -> Column:
    """The processing time as a timestamp literal; a Column passes through."""
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def surrogate_key(*cols: str | Column) -> Column:
    """md5 over the string forms of ``cols``, in order, NULLs made visible."""
    parts = [F.coalesce(as_column(c).cast("string"), F.lit(NULL_TOKEN)) for c in cols]
    return F.md5(F.concat_ws("-", *parts))


def packed(key: str | Column) -> Column:
    """A hashed key in half the bytes, for shuffles: the 16 bytes of a lower-case hex digest, any other text behind 17 zero bytes."""
    text = as_column(key)
    digest = F.unhex(text)
    is_digest = (F.length(text) == 32) & (F.lower(F.hex(digest)) == text)
    return F.when(is_digest, digest).otherwise(F.concat(F.unhex(F.lit("00" * 17)), text.cast("binary")))


def unpacked(key: str | Column) -> Column:
    """The text that ``packed`` was given."""
    value = as_column(key)
    return F.when(F.length(value) == 16, F.lower(F.hex(value))).otherwise(F.substring(value, 18, 2**31 - 1).cast("string"))


def composite_key(*cols: str | Column, sep: str = "-") -> Column:
    """Readable joined key; NULL when any part is NULL."""
    parts: list[Column] = []
    for c in cols:
        if parts:
            parts.append(F.lit(sep))
        parts.append(as_column(c).cast("string"))
    return F.concat(*parts)


def leading_timestamp(col: str | Column, width: int = 19) -> Column:
    """Cast the first ``width`` characters; extracts carry trailing fractions or junk."""
    return F.left(as_column(col), F.lit(width)).cast("timestamp")


def mask_tail(col: str | Column, keep: int = 4, mask: str = "X") -> Column:
    """Replace all but the last ``keep`` characters."""
    text = as_column(col)
    hidden = F.greatest(F.length(text) - F.lit(keep), F.lit(0))
    return F.concat(F.repeat(F.lit(mask), hidden), F.right(text, F.lit(keep)))


def full_name(first, middle, last, suffix) -> Column:
    """Space-joined name that skips missing parts and an empty middle or suffix."""
    return F.concat_ws(
        " ",
        as_column(first),
        F.nullif(as_column(middle), F.lit("")),
        as_column(last),
        F.nullif(as_column(suffix), F.lit("")),
    )


def decode(col: str | Column, labels: Mapping, default: str | None = UNKNOWN_LABEL) -> Column:
    """Code to label; anything else, NULL included, becomes ``default``."""
    source = as_column(col)
    result = None
    for code, label in labels.items():
        hit = source == F.lit(code)
        result = F.when(hit, F.lit(label)) if result is None else result.when(hit, F.lit(label))
    return result.otherwise(F.lit(default))


def tier(col: str | Column, zero_label: str, steps: Sequence[tuple[str, str]], top_label: str) -> Column:
    """Label a rate: exactly zero, then the first upper bound it stays under, else the top."""
    rate = as_column(col)
    result = F.when(rate == F.lit(0), F.lit(zero_label))
    for bound, label in steps:
        result = result.when(rate < F.lit(bound).cast("decimal(10,4)"), F.lit(label))
    return result.otherwise(F.lit(top_label))


def presence_label(first: str | Column, second: str | Column, labels: Mapping[tuple[bool, bool], str]) -> Column:
    """Label a row by which of two keys are present."""
    a, b = as_column(first).isNotNull(), as_column(second).isNotNull()
    return (
        F.when(a & b, F.lit(labels[True, True]))
        .when(a, F.lit(labels[True, False]))
        .when(b, F.lit(labels[False, True]))
        .otherwise(F.lit(labels[False, False]))
    )


def date_key(col: str | Column, default: int = UNKNOWN_KEY) -> Column:
    """yyyyMMdd as int from the date parts (no text formatting), ``default`` for NULL."""
    day = as_column(col)
    number = F.year(day) * F.lit(10000) + F.month(day) * F.lit(100) + F.dayofmonth(day)
    return F.coalesce(number.cast("int"), F.lit(default))


def lifecycle_status(discontinued_at, sell_end_at, as_of) -> Column:
    """Discontinued / Inactive / Active at ``as_of``."""
    return (
        F.when(as_column(discontinued_at).isNotNull(), F.lit("Discontinued"))
        .when(as_column(sell_end_at) < moment(as_of), F.lit("Inactive"))
        .otherwise(F.lit("Active"))
    )


def active_between(start, end, as_of) -> Column:
    """True when ``as_of`` lies inside the closed interval; a NULL bound gives false."""
    return F.coalesce(moment(as_of).between(as_column(start), as_column(end)), F.lit(False))


def guarded_ratio(numerator: Column, denominator: Column) -> Column:
    """Ratio that is NULL for a zero denominator."""
    return numerator / F.nullif(denominator, F.lit(0))


def not_blank(col: str | Column) -> Column:
    """The trimmed text, or NULL where nothing is left."""
    return F.nullif(F.trim(as_column(col)), F.lit(""))
