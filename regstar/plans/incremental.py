"""Gold kept current by the registrations that changed.

``update_gold`` takes the stored gold of the last load, silver before and after,
and the registration numbers whose records came in. It works out which rows of
the dimensions and the fact these touch, makes those anew and keeps the others:

* a vehicle or maker is touched if a changed registration had or has its name;
* a fact row is touched if its registration changed, if a vehicle with its match
  key came or went, if its key has no equal among the vehicles and one within the
  edit bound came or went, or if its office has another id or name.

Keys come from a ``KeyRegistry``, so names that stay keep theirs. The result
equals a full build with the same registry. Other rows of silver are read for
their names and match keys only; the full resolution runs for touched rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from regstar.domain import registrations as R
from regstar.operators import dims as Dm
from regstar.operators import fact as Fa
from regstar.operators import resolve as M
from regstar.operators.keys import KeyRegistry
from regstar.plans.medallion import REG_KEY, GoldOptions
from regstar.session import materialize, shuffled


def _same(left: DataFrame, right: DataFrame, names: list[str]) -> Column:
    cond = F.lit(True)
    for n in names:
        cond = cond & left[n].eqNullSafe(right[n])
    return cond


def _refreshed(old: DataFrame, rows: DataFrame, touched: DataFrame, natural: list[str], key_col: str, unknown: dict,
               registry: KeyRegistry, prefix: str | None = None, attrs: tuple = ()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(dimension, its old rows that are touched, their new form); ``rows`` are those of all silver."""
    touched = shuffled(touched)
    own = old.filter(F.col(key_col).cast("string") != str(unknown[key_col]))
    before = materialize(own.join(touched, _same(own, touched, natural), "left_semi"), "touched-before")
    rows = rows.distinct()  # the dimension needs no repeats, and a name of many records would fill one task
    still = rows.join(touched, _same(rows, touched, natural), "left_semi")
    after = materialize(Dm.dimension(still, natural, key_col, prefix=prefix, attrs=attrs, registry=registry), "touched-after")
    kept = own.join(touched, _same(own, touched, natural), "left_anti")
    return materialize(Dm.with_unknown(kept.unionByName(after), unknown), f"dim-{key_col.lower()}"), before, after


def touched_registrations(silver: DataFrame, changed: DataFrame, dim_vehicle: DataFrame, moved: DataFrame, offices: DataFrame,
                          max_dist: int = R.LEVENSHTEIN_BOUND) -> DataFrame:
    """The registration numbers whose fact rows may differ; ``moved`` are the keys
    (KEY2, BLOCK2, VEHICLE_KEY) of vehicles that came or went, ``offices`` the codes of changed offices."""
    recs = M.match_keys(silver.select(REG_KEY, "modelName_canonical", "variant"), "modelName_canonical", "variant")
    keys = recs.select("KEY", "BLOCK").distinct()
    equal = moved.select(F.col("KEY2").alias("KEY")).distinct()
    near = M.candidate_pairs(M.unresolved_keys(keys, M.dim_keys(dim_vehicle)), moved, max_dist).select("KEY")
    by_key = recs.join(equal.unionByName(near).distinct(), "KEY", "left_semi").select(REG_KEY)
    by_office = silver.join(F.broadcast(offices), F.col("OfficeCd_STD") == F.col("RTA_OFFICE_CODE"), "left_semi").select(REG_KEY)
    return changed.unionByName(by_key).unionByName(by_office).distinct()


def update_gold(spark: SparkSession, old: dict[str, DataFrame], old_silver: DataFrame, new_silver: DataFrame, changed: DataFrame,
                opts: GoldOptions) -> dict[str, DataFrame]:
    """The gold tables after a load, from stored tables of the load before.

    ``changed`` holds the registration numbers of the load's records, repeats and
    unknown numbers included; ``opts`` names the registry and this load's number.
    The fact is kept rows and new ones; write it as a new table.
    """
    if not opts.registry_path:
        raise ValueError("gold can only be updated with keys that last: give a registry")
    registry = KeyRegistry(spark, opts.registry_path, opts.load)
    changed = shuffled(materialize(changed.select(REG_KEY).filter(F.col(REG_KEY).isNotNull()).distinct(), "changed"))
    records = materialize(old_silver.join(changed, REG_KEY, "left_semi").unionByName(new_silver.join(changed, REG_KEY, "left_semi")), "changed-records")

    vehicles = materialize(Dm.valid_vehicles(records, opts.null_as_unknown).select(*Dm.VEHICLE_NAME).distinct(), "touched-vehicles")
    dim_vehicle, went, came = _refreshed(old["dim_vehicle"], Dm.valid_vehicles(new_silver, opts.null_as_unknown), vehicles, Dm.VEHICLE_NAME,
                                         "VEHICLE_KEY", Dm.UNKNOWN_VEHICLE, registry, attrs=("COLOUR", "VEHICLE_CLASS"))
    makers = materialize(Dm.maker_names(records).distinct(), "touched-makers")
    dim_maker, _, _ = _refreshed(old["dim_manufacturer"], Dm.maker_names(new_silver), makers, ["MANUFACTURER_NAME"], "MANUFACTURER_KEY",
                                 Dm.UNKNOWN_MAKER, registry, prefix="M")
    dim_office = materialize(Dm.dim_office(new_silver, key_method=opts.key_method), "dim-office")  # at most one row per office of the master
    offices = old["dim_office"].exceptAll(dim_office).unionByName(dim_office.exceptAll(old["dim_office"])).select("RTA_OFFICE_CODE").distinct()

    went, came = M.dim_keys(went), M.dim_keys(came)
    moved = materialize(went.exceptAll(came).unionByName(came.exceptAll(went)), "moved-vehicles")
    touched = shuffled(materialize(touched_registrations(new_silver, changed, dim_vehicle, moved, offices), "touched-registrations"))
    rows = Fa.star_fact(new_silver.join(touched, REG_KEY, "left_semi"), dim_vehicle, dim_office, dim_maker, opts.exact_multi)
    kept = old["fact"].join(touched, F.col("TEMP_REGISTRATION_NUMBER") == F.col(REG_KEY), "left_anti")
    return {"dim_date": old["dim_date"], "dim_manufacturer": dim_maker, "dim_vehicle": dim_vehicle, "dim_office": dim_office,
            "fact": kept.unionByName(rows)}
