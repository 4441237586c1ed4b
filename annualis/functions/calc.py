"""Arithmetic and predicate helpers with explicit null behaviour.

Expressions generated over many columns or codes are SQL text: the same plan as Column calls,
but one call into the JVM each.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def div(c: Column | str, n: int) -> Column:
    """Integer division (bigint)."""
    return F.call_function("div", _col(c), F.lit(n))


def date_year(c: Column | str) -> Column:
    """Year of a YYYYMMDD integer; a year outside 16 bits is an error."""
    return div(c, 10000).cast("smallint")


def date_month(c: Column | str) -> Column:
    return div(_col(c) % 10000, 100).cast("int")


def date_day(c: Column | str) -> Column:
    return (_col(c) % 100).cast("int")


def clamp(c: Column, low=None, high=None) -> Column:
    """Limit to [low, high]; null stays null (greatest/least would skip it)."""
    out = c
    if low is not None:
        out = F.when(c < low, F.lit(low)).otherwise(out)
    if high is not None:
        out = F.when(c > high, F.lit(high)).otherwise(out)
    return out


def null_if(c: Column | str, value) -> Column:
    return F.nullif(_col(c), F.lit(value))


def fill(c: Column | str, value) -> Column:
    return F.coalesce(_col(c), F.lit(value))


def flag(condition: Column) -> Column:
    """Three-valued 1/0/null flag."""
    return condition.cast("tinyint")


def in_ranges(c: str, ranges) -> Column:
    """True inside any inclusive (low, high) range; null for null."""
    return F.expr(" OR ".join(f"{c} BETWEEN {low} AND {high}" for low, high in ranges))


def row_total(columns: list[str]) -> Column:
    """Sum across columns of one row, nulls counting as zero."""
    return F.expr(" + ".join(f"coalesce({c}, 0)" for c in columns))
