"""Small literal tables (reference data) and generated sequences."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def literal_table(spark: SparkSession, rows: Sequence[tuple], names: Sequence[str]) -> DataFrame:
    """A fixed table shipped from the driver; only for bounded reference data."""
    return spark.createDataFrame(list(rows), list(names))


def date_sequence(spark: SparkSession, start: str, end: str, name: str = "d") -> DataFrame:
    """One row per day from ``start`` to ``end`` (inclusive)."""
    return spark.range(1).select(F.explode(F.sequence(
        F.lit(start).cast("date"), F.lit(end).cast("date"), F.expr("interval 1 day"))).alias(name))
