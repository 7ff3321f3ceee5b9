"""Detect and repair shifted or swapped office/date columns (row-local, no shuffle)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from regstar.domain import registrations as R

def null_string() -> Column:
    return F.lit(None).cast("string")


def is_swapped(office: Column, fromdate: Column) -> Column:
    """The office holds a date and the from-date holds an office code."""
    return F.trim(office).rlike(R.DATE_LIKE) & F.upper(F.trim(fromdate)).rlike(R.OFFICE_CODE_LIKE)


def is_shifted(office: Column, fromdate: Column, todate: Column) -> Column:
    """Office empty or code-like, from-date holds a word, to-date holds a date."""
    office_free = F.trim(office).rlike(R.OFFICE_CODE_LIKE) | office.isNull() | (F.trim(office) == "")
    return office_free & F.trim(fromdate).rlike(R.HAS_WORD) & F.trim(todate).rlike(R.DATE_LIKE)


def repair_columns(df: DataFrame, office: str = "OfficeCd", fromdate: str = "fromdate",
                   todate: str = "todate") -> DataFrame:
    """Move values back to their columns; a shift wins over a swap.

    shifted: office <- from-date, from-date <- to-date (to-date kept);
    swapped: office <- from-date, from-date <- office, to-date <- NULL.
    """
    o, f, t = F.col(office), F.col(fromdate), F.col(todate)
    shifted, swapped = is_shifted(o, f, t), is_swapped(o, f)
    return df.withColumns({
        office: F.when(shifted | swapped, F.trim(f)).otherwise(o),
        fromdate: F.when(shifted, t).when(swapped, o).otherwise(f),
        todate: F.when(shifted, t).when(swapped, null_string()).otherwise(t),
    })


def backfill_office(office: Column, reg_key: Column, pattern: str = R.OFFICE_FROM_KEY) -> Column:
    """Empty, NULL or "NULL" office -> office prefix of the registration key ('' if none)."""
    empty = office.isNull() | (F.trim(office) == "") | (office == "NULL")
    return F.when(empty, F.regexp_extract(reg_key, pattern, 0)).otherwise(office)
