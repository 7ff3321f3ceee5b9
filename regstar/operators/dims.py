"""Dimensions: date, manufacturer, vehicle, office; and the simpler star's dimensions.

A dimension is: distinct natural keys (partial aggregate), a dense surrogate
key (``keys.dense_key``), and optionally one literal "unknown" member.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.functions import text as T
from regstar.operators.dedup import distinct_on
from regstar.operators.keys import KeyRegistry, dense_key
from regstar.session import materialize
from regstar.sources.inline import date_sequence, literal_table


def with_unknown(dim: DataFrame, unknown_row: dict) -> DataFrame:
    """Append one literal member, typed like the dimension's columns."""
    fields = {f.name: f.dataType for f in dim.schema.fields}
    row = dim.sparkSession.range(1).select(
        *[F.lit(unknown_row.get(name)).cast(dt).alias(name) for name, dt in fields.items()])
    return dim.unionByName(row)


def dimension(df: DataFrame, natural: Sequence[str], key_col: str, prefix: str | None = None,
              unknown_row: dict | None = None, attrs: Sequence[str] = (), key_method: str = "range",
              order: Sequence | None = None, registry: KeyRegistry | None = None) -> DataFrame:
    """Distinct ``natural`` keys (+ fixed-choice ``attrs``), dense key, unknown member.

    With a ``registry`` the keys are those it has given out or now gives.
    """
    cols = list(natural) + list(attrs)
    base = distinct_on(df.select(*cols), natural) if attrs else df.select(*cols).distinct()
    if registry is not None:
        keyed = registry.keyed(base, natural, key_col, prefix)
    else:
        keyed = dense_key(base, order or list(natural), key_col, prefix=prefix, method=key_method, natural=natural)
    return with_unknown(keyed, unknown_row) if unknown_row is not None else keyed


# --- date -------------------------------------------------------------------

def dim_date(spark: SparkSession, start: str = R.DATE_DIM_START, end: str = R.DATE_DIM_END,
             extra: Sequence[str] = (R.DEFAULT_DATE,)) -> DataFrame:
    """One row per day in [start, end] plus ``extra`` days; id yyyyMMdd, parts."""
    days = date_sequence(spark, start, end, "full_date")
    if extra:
        days = days.unionByName(spark.createDataFrame([(d,) for d in extra], ["d"])
                                .select(F.col("d").cast("date").alias("full_date")))
    d = F.col("full_date")
    return days.withColumns({
        "DATE_ID": F.date_format(d, "yyyyMMdd").cast("int"),
        "YEAR": F.year(d), "MONTH": F.month(d), "DAY": F.dayofmonth(d), "QUARTER": F.quarter(d),
    })


# --- manufacturer -------------------------------------------------------------

UNKNOWN_MAKER = {"MANUFACTURER_NAME": R.UNKNOWN_MANUFACTURER, "MANUFACTURER_KEY": "-1"}


def maker_names(silver: DataFrame) -> DataFrame:
    names = silver.select(F.col("makerName").alias("MANUFACTURER_NAME"))
    return names.filter(F.col("MANUFACTURER_NAME").isNotNull() & (F.col("MANUFACTURER_NAME") != R.UNKNOWN_MANUFACTURER))


def dim_manufacturer(silver: DataFrame, key_method: str = "range", registry: KeyRegistry | None = None) -> DataFrame:
    return dimension(maker_names(silver), ["MANUFACTURER_NAME"], "MANUFACTURER_KEY", prefix="M",
                     unknown_row=UNKNOWN_MAKER, key_method=key_method, registry=registry)


# --- vehicle ------------------------------------------------------------------

def vehicle_normalize(silver: DataFrame, null_as_unknown: bool = False) -> DataFrame:
    """Normal forms of the vehicle attributes.

    ``isin`` never matches NULL, so a NULL fuel or colour stays NULL unless
    ``null_as_unknown`` is set.
    """
    c = F.col
    model = F.regexp_replace(F.regexp_replace(T.upper_trim(c("modelName_canonical")), r"[^A-Z0-9]", " "), r"\s+", " ")
    variant = F.regexp_replace(F.regexp_replace(T.upper_trim(c("variant")), r"[^A-Z0-9]", ""), R.VARIANT_SUFFIX, "")

    def placeholder(col, values):
        hit = col.isin(*values)
        if null_as_unknown:
            hit = hit | col.isNull()
        return F.when(hit, F.lit(R.UNKNOWN)).otherwise(T.upper_trim(col))

    return silver.select(
        model.alias("MODEL_NAME"), variant.alias("VARIANT"),
        placeholder(c("fuel"), R.FUEL_PLACEHOLDERS).alias("FUEL"),
        placeholder(c("colour"), R.COLOUR_PLACEHOLDERS).alias("COLOUR"),
        T.upper_trim(c("vehicleClass")).alias("VEHICLE_CLASS"),
    )


VEHICLE_NAME = ["MODEL_NAME", "VARIANT", "FUEL"]


def valid_vehicles(silver: DataFrame, null_as_unknown: bool = False) -> DataFrame:
    """The normal forms that have a model and a variant."""
    norm = vehicle_normalize(silver, null_as_unknown)
    return norm.filter(F.col("MODEL_NAME").isNotNull() & F.col("VARIANT").isNotNull() & (F.trim(F.col("MODEL_NAME")) != ""))


UNKNOWN_VEHICLE = {"VEHICLE_KEY": -1, "MODEL_NAME": R.UNKNOWN, "VARIANT": R.UNKNOWN,
                   "FUEL": R.UNKNOWN, "COLOUR": R.UNKNOWN, "VEHICLE_CLASS": R.UNKNOWN}


def dim_vehicle(silver: DataFrame, key_method: str = "range", null_as_unknown: bool = False,
                registry: KeyRegistry | None = None) -> DataFrame:
    """One row per (model, variant, fuel); colour and class from the smallest such row."""
    return dimension(valid_vehicles(silver, null_as_unknown), VEHICLE_NAME, "VEHICLE_KEY",
                     attrs=["COLOUR", "VEHICLE_CLASS"], unknown_row=UNKNOWN_VEHICLE, key_method=key_method,
                     registry=registry)


# --- office -------------------------------------------------------------------

def office_master(spark: SparkSession, rows: Sequence[tuple] = R.OFFICE_MASTER) -> DataFrame:
    return literal_table(spark, rows, ["MAP_CODE", "DISTRICT_NAME"])


UNKNOWN_OFFICE = {"RTA_ID": R.UNKNOWN, "RTA_OFFICE_CODE": R.UNKNOWN_OFFICE_CODE, "RTA_NAME": R.UNKNOWN_RTA_NAME}


def dim_office(silver: DataFrame, master: DataFrame | None = None, key_method: str = "range") -> DataFrame:
    """Office codes seen in the data that the master knows; keys R1.. by name.

    The distinct codes are stored before the join. The code is a long CASE over
    the office name, and the optimizer's search for join filters would put it
    into itself again and again (minutes of planning). The built-in master is a
    fixed table of 70 rows and broadcast; a master of the caller's is not hinted.
    """
    own = office_master(silver.sparkSession) if master is None else None
    codes = materialize(silver.select(F.col("OfficeCd_STD").alias("RTA_CODE")).distinct(), "office-codes")
    known = (codes.join(F.broadcast(own) if own is not None else master, F.col("RTA_CODE") == F.col("MAP_CODE"), "inner")
             .select(F.col("RTA_CODE").alias("RTA_OFFICE_CODE"), F.col("DISTRICT_NAME").alias("RTA_NAME")))
    one_per_name = distinct_on(known, ["RTA_NAME"])
    keyed = dense_key(one_per_name, ["RTA_NAME"], "RTA_ID", prefix="R", method=key_method)
    return with_unknown(keyed.select("RTA_OFFICE_CODE", "RTA_NAME", "RTA_ID"), UNKNOWN_OFFICE)


# --- the simpler star schema ----------------------------------------------------

def as_transport_silver(silver: DataFrame) -> DataFrame:
    """Our silver under the simpler star's column names."""
    return silver.withColumnRenamed("makerName", "MAKER_NAME_CLEAN")


def v_dim_office(silver: DataFrame, junk: str = R.SIMPLE_JUNK, key_method: str = "range") -> DataFrame:
    names = silver.select(T.upper_trim(F.col("OfficeCd")).alias("RTA_NAME")).distinct()
    names = names.filter(~F.col("RTA_NAME").rlike(junk))
    return dense_key(names, ["RTA_NAME"], "RTA_ID", method=key_method)


def v_dim_maker(silver: DataFrame, junk: str = R.SIMPLE_JUNK, key_method: str = "range") -> DataFrame:
    names = silver.select(F.col("MAKER_NAME_CLEAN").alias("MANUFACTURER_NAME")).distinct()
    names = names.filter(~F.col("MANUFACTURER_NAME").rlike(junk))
    return dense_key(names, ["MANUFACTURER_NAME"], "MANUFACTURER_ID", method=key_method)


def vehicle_natural_key(model, variant):
    return F.concat_ws(" | ", T.upper_trim(model), T.upper_trim(variant))


def v_dim_vehicle(silver: DataFrame) -> DataFrame:
    c = F.col
    rows = silver.select(
        vehicle_natural_key(c("modelName_canonical"), c("variant")).alias("VEHICLE_NATURAL_KEY"),
        c("modelName_canonical").alias("MODEL_NAME"), c("variant").alias("VARIANT"),
        c("fuel_clean").alias("FUEL"), c("colour").alias("COLOUR"), c("vehicleClass").alias("VEHICLE_CLASS"),
        F.when(F.lower(c("fuel_clean")) == "electric", True).otherwise(False).alias("IS_ELECTRIC"),
        c("OWNERSHIP_TYPE"), c("TRANSPORT_TYPE"), c("REGISTRATION_YEAR").cast("int").alias("REGISTRATION_YEAR"),
    )
    return distinct_on(rows, ["VEHICLE_NATURAL_KEY"]).withColumn("VEHICLE_KEY", c("VEHICLE_NATURAL_KEY"))


def v_dim_date(silver: DataFrame, key_method: str = "range") -> DataFrame:
    days = silver.select(F.col("fromdate_parsed").alias("DATE")).filter(F.col("DATE").isNotNull()).distinct()
    keyed = dense_key(days, ["DATE"], "DATE_KEY", method=key_method)
    return keyed.withColumns({"YEAR": F.year("DATE"), "MONTH": F.month("DATE")})
