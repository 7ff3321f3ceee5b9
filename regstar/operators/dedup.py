"""Deduplication: keep-latest per key, distinct rows, distinct on a key subset.

Both keyed forms are aggregations or top-1 windows, so Spark reduces rows
map-side before the shuffle: a key that holds a third of all rows leaves one
row per map task, not a third of the data in one reducer.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def keep_latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column],
                method: str = "window") -> DataFrame:
    """One row per ``keys``: the first row under ``order`` (sort expressions).

    ``order`` should end with tie-break columns that make it total; otherwise
    ties are resolved by the remaining columns (``aggregate``) or arbitrarily
    (``window``).

    method="window": ``row_number() <= 1``. Catalyst plans a partial
    ``WindowGroupLimit`` before the shuffle, so each map task forwards at most
    one row per key.
    method="aggregate": ``max`` of a struct of (descending-encoded order,
    row). A partial aggregate collapses hot keys map-side. Only for orders
    built by :func:`latest_first`, which are ascending-comparable structs.
    """
    keys = list(keys)
    if method == "window":
        w = Window.partitionBy(*keys).orderBy(*order)
        return (df.withColumn("_rn", F.row_number().over(w))
                .filter(F.col("_rn") <= 1).drop("_rn"))
    if method == "aggregate":
        rest = [c for c in df.columns if c not in keys]
        best = F.max(F.struct(F.struct(*order).alias("o"), F.struct(*rest).alias("r"))).alias("_best")
        return df.groupBy(*keys).agg(best).select(*keys, "_best.r.*").select(*df.columns)
    raise ValueError(f"unknown method {method!r}")


def latest_first(*cols) -> list[Column]:
    """Sort spec "largest first, NULLs last" for each column (window method)."""
    return [_as_col(c).desc_nulls_last() for c in cols]


def keep_latest_by(df: DataFrame, keys: Sequence[str], cols: Sequence, method: str = "window") -> DataFrame:
    """Keep the row with the largest ``cols`` (compared in order, NULL smallest)."""
    cols = [_as_col(c) for c in cols]
    if method == "window":
        return keep_latest(df, keys, latest_first(*cols), "window")
    # max(struct) orders NULL below any value: the same as "desc, nulls last".
    return keep_latest(df, keys, [c.alias(f"_k{i}") for i, c in enumerate(cols)], "aggregate")


def distinct_rows(df: DataFrame) -> DataFrame:
    """All distinct rows (hash aggregate with a partial step)."""
    return df.distinct()


def distinct_on(df: DataFrame, keys: Sequence[str], pick: str = "min") -> DataFrame:
    """One row per ``keys``; the other columns come from the smallest (or largest) row.

    Unlike ``dropDuplicates(keys)``, which keeps an arbitrary row, the choice is
    fixed, and it is still a partial (map-side) aggregation.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.select(*keys).distinct()
    agg = F.min if pick == "min" else F.max
    return (df.groupBy(*keys).agg(agg(F.struct(*rest)).alias("_row"))
            .select(*keys, "_row.*").select(*df.columns))
