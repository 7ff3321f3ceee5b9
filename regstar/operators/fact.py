"""Star facts: the resolved registration fact and the simpler star's fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.operators import resolve as M
from regstar.operators.dims import vehicle_natural_key

FACT_COLUMNS = [
    "TEMP_REGISTRATION_NUMBER", "VEHICLE_KEY", "RTA_ID", "MANUFACTURER_KEY", "REGISTRATION_DATE_ID",
    "REGISTRATION_YEAR", "REGISTRATION_MONTH", "makeYear", "SEAT_CAPACITY", "CATEGORY", "FUEL",
    "OWNERSHIP_TYPE", "TRANSPORT_TYPE", "RTA_OFFICE_CODE", "RTA_NAME", "MATCH_STATUS",
]


def spread_key(key, row_id, *nothing):
    """``key`` as text, with a value of the row's own where it is NULL or one of ``nothing``.

    Such rows match nothing; without it a left join would send all of them to
    one task. No key begins with the character NUL.
    """
    key = key.cast("string")
    none = key.isNull() | key.isin(*nothing) if nothing else key.isNull()
    return F.when(none, F.concat(F.lit("\0"), F.coalesce(row_id, F.lit("")))).otherwise(key)


def star_fact(silver: DataFrame, dim_vehicle: DataFrame, dim_office: DataFrame, dim_maker: DataFrame,
              exact_multi: str = "min", max_dist: int = R.LEVENSHTEIN_BOUND,
              hot_block: int | None = M.HOT_BLOCK, bucketed: tuple[str, int] | None = None) -> DataFrame:
    """Registrations with vehicle, office and maker keys; unknown defaults.

    * Vehicle keys are resolved per distinct match key and joined on that key
      (silver is unique per registration, so this equals a per-registration
      resolution); records of a heavy match key are dealt to several tasks.
    * ``bucketed`` (table name, number): silver and resolution are first stored as
      catalog tables bucketed alike, which join without a shuffle.
    * The office dimension is bounded by the 70-row master: broadcast.
    * The maker dimension grows with the data: no hint; AQE broadcasts it at
      run time only if its measured size is under the threshold, else it stays
      a shuffle join.
    * The date dimension cannot change any output column (its id equals the
      registration's date id, which is the fallback), so it is not joined.
    """
    recs = M.match_keys(silver, "modelName_canonical", "variant")
    keys = recs.select("KEY", "BLOCK").distinct()
    resolution = M.resolve_keys(keys, M.dim_keys(dim_vehicle), max_dist, exact_multi, hot_block)
    office = dim_office.select("RTA_OFFICE_CODE", "RTA_ID", F.col("RTA_NAME").alias("_rta_name"))
    maker = dim_maker.select(F.col("MANUFACTURER_NAME").alias("_maker"), "MANUFACTURER_KEY")
    if bucketed:
        left, right = M.bucketed_sides(recs, resolution, "tempRegistrationNumber", *bucketed)
        resolved = left.join(right, ["KEY", "_piece"], "left")
    else:
        resolved = M.join_resolution(recs, resolution, "tempRegistrationNumber")
    joined = (resolved
              .join(F.broadcast(office), F.col("OfficeCd_STD") == F.col("RTA_OFFICE_CODE"), "left")
              .join(maker, spread_key(F.col("makerName"), F.col("tempRegistrationNumber"), R.UNKNOWN_MANUFACTURER) == F.col("_maker"), "left"))
    c = F.col
    return joined.select(
        c("tempRegistrationNumber").alias("TEMP_REGISTRATION_NUMBER"),
        F.coalesce(c("VEHICLE_KEY"), F.lit(-1)).cast("int").alias("VEHICLE_KEY"),
        F.coalesce(c("RTA_ID"), F.lit(R.UNKNOWN)).alias("RTA_ID"),
        F.coalesce(c("MANUFACTURER_KEY"), F.lit("-1")).alias("MANUFACTURER_KEY"),
        c("REGISTRATION_DATE_ID"),
        c("REGISTRATION_YEAR"), c("REGISTRATION_MONTH"), c("makeYear"),
        c("seatCapacity").alias("SEAT_CAPACITY"), c("category").alias("CATEGORY"),
        c("fuel_clean").alias("FUEL"), c("OWNERSHIP_TYPE"), c("TRANSPORT_TYPE"),
        c("OfficeCd_STD").alias("RTA_OFFICE_CODE"),
        F.coalesce(c("_rta_name"), F.lit(R.UNKNOWN)).alias("RTA_NAME"),
        F.coalesce(c("MATCH_STATUS"), F.lit(M.UNMATCHED)).alias("MATCH_STATUS"),
    )


def v_fact(silver: DataFrame, dim_vehicle: DataFrame, dim_office: DataFrame, dim_maker: DataFrame,
           dim_date: DataFrame) -> DataFrame:
    """The simpler star: four left joins; unmatched keys stay NULL."""
    c = F.col
    s = silver.withColumn("_vkey", vehicle_natural_key(c("modelName_canonical"), c("variant")))
    fact = (s.join(dim_vehicle.select(c("VEHICLE_NATURAL_KEY"), "VEHICLE_KEY"),
                   c("_vkey") == c("VEHICLE_NATURAL_KEY"), "left")
            .join(dim_office.select(c("RTA_NAME").alias("_rta"), "RTA_ID"),
                  spread_key(F.upper(F.trim(c("OfficeCd"))), c("tempRegistrationNumber")) == c("_rta"), "left")
            .join(dim_maker.select(c("MANUFACTURER_NAME").alias("_maker"), "MANUFACTURER_ID"),
                  spread_key(c("MAKER_NAME_CLEAN"), c("tempRegistrationNumber")) == c("_maker"), "left")
            .join(dim_date.select(c("DATE").cast("string").alias("_date"), "DATE_KEY"),
                  spread_key(c("fromdate_parsed"), c("tempRegistrationNumber")) == c("_date"), "left"))
    return fact.select(
        c("tempRegistrationNumber").alias("TEMP_REGISTRATION_NUMBER"),
        c("VEHICLE_KEY"), c("RTA_ID"), c("MANUFACTURER_ID").alias("MANUFACTURER_KEY"), c("DATE_KEY"),
        c("makeYear").try_cast("int").alias("MAKE_YEAR"), c("category").alias("CATEGORY"),
    )
