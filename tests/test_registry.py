"""Key registries over loads, heavy match keys, the office dimension's plan."""

import time

from pyspark.sql import functions as F

from conftest import SF_SMALL
from regstar.operators import dims as Dm
from regstar.operators import resolve as M
from regstar.operators.keys import KeyRegistry
from regstar.plans import medallion as Md
from regstar.session import scratch_path
from regstar.sources.fixtures import dirty_registrations


def test_keys_last_over_loads_and_repeats(spark):
    path = scratch_path(spark, "reg")

    def load(k, names):
        df = spark.createDataFrame([(n, len(n or "")) for n in names], "name string, size int")
        return {r.name: (r.size, r.key) for r in KeyRegistry(spark, path, k).keyed(df, ["name"], "key", "K").collect()}

    assert load(0, ["b", "d", None]) == {None: (0, "K1"), "b": (1, "K2"), "d": (1, "K3")}
    second = load(1, ["a", "b", "c", None])
    assert second == {None: (0, "K1"), "b": (1, "K2"), "a": (1, "K4"), "c": (1, "K5")}
    assert load(1, ["a", "b", "c", None]) == second  # a repeated load gives the same keys
    assert load(2, ["d", "e"]) == {"d": (1, "K3"), "e": (1, "K6")}
    assert load(3, []) == {}


def test_gold_with_a_registry_keeps_the_first_loads_keys(spark):
    silver = Md.silver(dirty_registrations(spark, SF_SMALL))
    path = scratch_path(spark, "reg")
    half = silver.filter(F.xxhash64("tempRegistrationNumber") % 2 == 0)
    first = Md.gold(spark, half, Md.GoldOptions(registry_path=path, load=0))["dim_manufacturer"].collect()
    second = Md.gold(spark, silver, Md.GoldOptions(registry_path=path, load=1))
    later = {r.MANUFACTURER_NAME: r.MANUFACTURER_KEY for r in second["dim_manufacturer"].collect()}
    assert all(later[r.MANUFACTURER_NAME] == r.MANUFACTURER_KEY for r in first)
    keys = sorted(int(k.removeprefix("M")) for k in later.values())
    assert keys == [-1, *range(1, len(later))] and len(later) >= len(first)
    # the fact's makers and vehicles are those of the plain build
    plain = Md.gold(spark, silver)

    def named(g):
        f = g["fact"].join(g["dim_manufacturer"], "MANUFACTURER_KEY").join(g["dim_vehicle"].select("VEHICLE_KEY", "MODEL_NAME"), "VEHICLE_KEY")
        return sorted(map(repr, f.select("TEMP_REGISTRATION_NUMBER", "MANUFACTURER_NAME", "MODEL_NAME", "MATCH_STATUS").collect()))

    assert len(named(plain)) > 0 and [r.split("MODEL")[0] for r in named(second)] == [r.split("MODEL")[0] for r in named(plain)]


def test_a_heavy_match_key_is_dealt_to_several_tasks(spark):
    rows = [(f"r{k}", "hot one" if k % 3 else f"key {k}") for k in range(6000)]
    recs = spark.createDataFrame(rows, "id string, KEY string").repartition(4)
    resolution = recs.select("KEY").distinct().select("KEY", F.length("KEY").alias("VEHICLE_KEY"), F.lit("EXACT").alias("MATCH_STATUS"))
    heavy = M.heavy_keys(recs, 20).collect()
    assert [(r["_heavy"], r["_pieces"]) for r in heavy] == [("hot one", 14)]
    left, right = M.salted(recs, resolution, M.heavy_keys(recs, 20), "id")
    largest = left.groupBy("KEY", "_piece").count().agg(F.max("count")).first()[0]
    assert largest <= 6000 / 20 * 1.3  # of 4000 rows with one key
    assert right.count() == resolution.count() + 13
    out = M.join_resolution(recs, resolution, "id", share=20)
    assert sorted((r.id, r.KEY, r.VEHICLE_KEY) for r in out.collect()) == sorted((i, k, len(k)) for i, k in rows)
    assert M.join_resolution(recs.limit(0), resolution, "id").count() == 0


def test_records_without_resolution_stay(spark):
    recs = spark.createDataFrame([("a", "x"), ("b", None), ("c", "y")], "id string, KEY string")
    resolution = spark.createDataFrame([("x", 1), ("x", 2)], "KEY string, VEHICLE_KEY int")
    got = sorted((r.id, r.VEHICLE_KEY) for r in M.join_resolution(recs, resolution, "id").collect() if r.VEHICLE_KEY is not None)
    assert got == [("a", 1), ("a", 2)]
    assert M.join_resolution(recs, resolution, "id").count() == 4


def test_the_office_dimension_plans_in_seconds(spark):
    silver = Md.silver(dirty_registrations(spark, SF_SMALL))
    began = time.time()
    office = Dm.dim_office(silver)
    plan = office._jdf.queryExecution().executedPlan().toString()
    assert time.time() - began < 40
    assert "OfficeCd" not in plan  # read from the stored codes
    assert Dm.dim_office(silver, master=Dm.office_master(spark)).count() == office.count() > 1
