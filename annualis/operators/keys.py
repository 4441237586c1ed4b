"""Row identity: conflicts, deduplication, first of group.

All three are aggregates with a partial step before the shuffle, so a key that holds a large
share of the rows leaves each map task as one row and never gathers in a single task.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def drop_conflicting_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct rows, without every key that still has more than one row.

    A key has one distinct row exactly when its smallest and largest row are equal, so neither
    a distinct nor a second pass is needed.
    """
    rest = [c for c in df.columns if c not in keys]
    row = F.struct(*rest)
    bounds = df.groupBy(*keys).agg(F.min(row).alias("_lo"), F.max(row).alias("_hi"))
    same = bounds.filter(F.col("_lo").eqNullSafe(F.col("_hi")))
    return same.select(*keys, "_lo.*").select(*df.columns)


def dedup_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key: the smallest by all other columns in order, nulls first."""
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.distinct()
    first = df.groupBy(*keys).agg(F.min(F.struct(*rest)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)


def keep_top(df: DataFrame, keys: list[str], order: list[str | Column]) -> DataFrame:
    """First row of each key under an ascending order (nulls first); descending numbers are
    ordered by their negative. The order must not tie for the result to be well defined."""
    rest = [c for c in df.columns if c not in keys]
    first = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return first.select(*keys, "_row.*").select(*df.columns)
