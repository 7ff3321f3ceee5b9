"""Silver cleaning: bronze registrations -> cleaned, typed, classified rows.

The steps are order-sensitive (each reads what the previous one wrote). They
are split in two phases: Phase A computes only what deduplication needs (the
key and the repaired, parsed dates); Phase B does the rest. The silver table
runs Phase B after keep-latest, so the costly text rules run once per
surviving registration, not once per duplicate, and on the shuffle's
partitions. Every step is a batch of built-in expressions in one
``withColumns``, compiled by whole-stage codegen; no UDFs.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.functions import classify as C
from regstar.functions import dates as D
from regstar.functions import text as T
from regstar.operators import repair

SILVER_COLUMNS = [
    "slno", "modelDesc", "makerName", "OfficeCd", "tempRegistrationNumber",
    "fromdate", "todate", "fuel", "colour", "vehicleClass",
    "makeYear", "seatCapacity", "category", "secondVehicle",
    "fromdate_preclean", "todate_preclean", "isTrailer", "isElectric",
    "modelName_canonical", "variant", "fromdate_parsed", "todate_parsed",
    "REGISTRATION_YEAR", "REGISTRATION_MONTH", "REGISTRATION_DATE_ID",
    "fuel_clean", "OWNERSHIP_TYPE", "TRANSPORT_TYPE", "OfficeCd_STD",
]


@dataclass(frozen=True)
class CleanOptions:
    """Switches for the decided quirks (see README, "Semantics")."""

    date_formats: tuple = tuple(R.DATE_FORMATS)
    # Truncate only date-like text to 10 characters (False = every long value, as the source does).
    truncate_date_like_only: bool = False
    # Back-fill the office after rejecting maker words (False = before, as the source does).
    backfill_last: bool = False
    # "TG014" becomes "TS14" (False = "TG14", as the source's rules leave it).
    fix_code_prefix: bool = False
    # Two-digit make years above it are of the last century (None = all of this one, as the source does).
    year_pivot: int | None = None


def dedup_columns(df: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Phase A: only what keep-latest needs (key and repaired, parsed dates).

    Office placeholder and trim, date truncation and trim, shift/swap repair,
    office words in dates, then date parsing. Everything else waits for
    :func:`finish_clean`, so it runs after deduplication on surviving rows.
    """
    c = F.col
    if opts.truncate_date_like_only:
        trunc = {d: F.when(c(d).rlike(r"^\s*\d"), T.truncate_text(c(d))).otherwise(c(d)) for d in ("fromdate", "todate")}
    else:
        trunc = {d: T.truncate_text(c(d)) for d in ("fromdate", "todate")}
    df = df.withColumns({
        "OfficeCd": T.trim_text(T.null_if_matches(c("OfficeCd"), R.OFFICE_PLACEHOLDER)),
        "tempRegistrationNumber": T.trim_text(T.normalize_reg_key(c("tempRegistrationNumber"))),
        **{d: T.trim_text(e) for d, e in trunc.items()},
    })
    df = repair.repair_columns(df)
    df = df.withColumns({
        "fromdate_preclean": T.null_where(F.lower(F.trim(c("fromdate"))).rlike(R.OFFICE_IN_DATE), c("fromdate")),
        "todate_preclean": T.null_where(F.lower(F.trim(c("todate"))).rlike(R.OFFICE_IN_DATE), c("todate")),
    })
    return D.with_parsed_dates(df, {"fromdate_parsed": "fromdate_preclean", "todate_parsed": "todate_preclean"},
                               opts.date_formats)


def finish_clean(df: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """Phase B: maker, model, seats, office codes, classes. Output: ``SILVER_COLUMNS``.

    Every step is row-local and reads only raw columns or Phase A results, so
    running it after deduplication gives the same rows as running it before.
    """
    c = F.col
    maker = T.trim_text(T.strip_business_words(T.collapse_whitespace(c("makerName"))))
    model = T.trim_text(T.collapse_whitespace(c("modelDesc")))
    df = df.withColumns({
        "makerName": T.clean_maker(maker),
        "modelDesc": model,
        "seatCapacity": T.floor_numeric_text(c("seatCapacity")),
        **{name: T.trim_text(c(name)) for name in ("fuel", "colour", "vehicleClass", "category", "makeYear", "secondVehicle")},
    })
    backfill = repair.backfill_office(c("OfficeCd"), c("tempRegistrationNumber"))
    if opts.backfill_last:
        office = repair.backfill_office(T.null_if_matches(c("OfficeCd"), R.MAKER_IN_OFFICE), c("tempRegistrationNumber"))
    else:
        office = T.null_if_matches(backfill, R.MAKER_IN_OFFICE)
    df = df.withColumns({"OfficeCd": office, "_model_clean": T.model_clean(c("modelDesc"))})
    df = df.withColumns({
        "isTrailer": T.keyword_flag(c("_model_clean"), R.TRAILER_WORDS),
        "isElectric": T.keyword_flag(c("_model_clean"), R.ELECTRIC_WORDS),
        "modelName_canonical": T.model_canonical(T.model_tokens(c("_model_clean"))),
    })
    eff = D.effective_date(c("fromdate_parsed"), c("todate_parsed"))
    df = df.withColumns({
        "variant": T.model_variant(c("_model_clean"), c("modelName_canonical"), c("isTrailer")),
        "REGISTRATION_YEAR": F.year(eff),
        "REGISTRATION_MONTH": F.month(eff),
        "REGISTRATION_DATE_ID": D.date_id(eff),
        "fuel_clean": C.classify_fuel(c("fuel"), c("modelDesc")),
        "makeYear": T.infer_make_year(c("makeYear"), c("modelDesc"), pivot=opts.year_pivot),
        "OWNERSHIP_TYPE": C.classify_ownership(c("secondVehicle")),
        "TRANSPORT_TYPE": C.classify_transport(c("category"), c("vehicleClass")),
        "OfficeCd": C.map_office_name(c("OfficeCd")),
    })
    df = df.withColumns({"OfficeCd_STD": C.standardize_code(c("OfficeCd"), fix_prefix=opts.fix_code_prefix)})
    return df.select(*SILVER_COLUMNS)


def clean_registrations(df: DataFrame, opts: CleanOptions = CleanOptions()) -> DataFrame:
    """All row-local cleaning steps, in order, on every row. Output: ``SILVER_COLUMNS``."""
    return finish_clean(dedup_columns(df, opts), opts)
