"""Bronze -> silver -> gold, as plain functions over DataFrames.

Each stage is a function; a job materialises bronze, silver and the
dimensions as tables (``sources.sinks.write_table``) so the gold stage reads
a durable copy instead of recomputing the lineage.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.operators import dims as Dm
from regstar.operators import fact as Fa
from regstar.operators.clean import CleanOptions, clean_registrations, dedup_columns, finish_clean
from regstar.operators.dedup import keep_latest_by
from regstar.operators.harmonize import harmonize_columns
from regstar.operators.keys import KeyRegistry
from regstar.operators.quality import expect, expect_or_drop
from regstar.session import materialize
from regstar.sources.sinks import write_table

REG_KEY = "tempRegistrationNumber"
SILVER_EXPECTATIONS = {
    "valid_registration": f"{REG_KEY} IS NOT NULL AND length(trim({REG_KEY})) > 3",
}


@dataclass(frozen=True)
class GoldOptions:
    key_method: str = "range"     # dense keys: "range" (distributed), "plain" (one task), "hash"
    exact_multi: str = "min"       # "min": one vehicle per registration; "all": fan-out
    null_as_unknown: bool = False  # NULL fuel/colour -> UNKNOWN in the vehicle dimension
    registry_path: str | None = None  # keys of vehicles and manufacturers that last over loads
    load: int = 0                  # number of this load in that registry
    bucketed: tuple[str, int] | None = None  # silver and resolution stored as tables (name, number of buckets)


def bronze(df: DataFrame) -> DataFrame:
    """Raw records with any header layout -> the 14 golden string columns."""
    return harmonize_columns(df)


def latest_order():
    """Newest registration date first, then the highest serial number, then the whole row.

    Serial numbers restart in every source file, so the remaining columns
    decide ties: any partitioning, batch or stream picks the same row.
    """
    rest = ["slno", *(c for c in R.GOLDEN_COLUMNS if c not in (REG_KEY, "slno"))]
    return [F.coalesce(F.col("fromdate_parsed"), F.col("todate_parsed")), F.col("slno").try_cast("long"), *map(F.col, rest)]


def silver(bronze_df: DataFrame, opts: CleanOptions = CleanOptions(), dedup_method: str = "window") -> DataFrame:
    """Clean, keep the latest row per registration, then drop invalid keys.

    The expectation only reads the partition key, so Catalyst pushes it below
    the deduplication; the result is the same as filtering afterwards.
    """
    keyed = dedup_columns(bronze_df, opts)
    latest = keep_latest_by(keyed, [REG_KEY], latest_order(), method=dedup_method)
    return finish_clean(expect_or_drop(latest, SILVER_EXPECTATIONS), opts)


def silver_with_metrics(bronze_df: DataFrame, opts: CleanOptions = CleanOptions(),
                        dedup_method: str = "window"):
    """Silver plus an Observation of the expectation's pass/fail counts.

    The counts are gathered while the silver table is written (no extra pass);
    read ``obs.get`` after the write.
    """
    keyed = dedup_columns(bronze_df, opts)
    latest = keep_latest_by(keyed, [REG_KEY], latest_order(), method=dedup_method)
    kept, obs = expect(latest, SILVER_EXPECTATIONS, "drop", name="silver_expectations")
    return finish_clean(kept, opts), obs


def silver_eager(bronze_df: DataFrame, opts: CleanOptions = CleanOptions(), dedup_method: str = "window") -> DataFrame:
    """The same rows, cleaning every record before deduplication (the source's order)."""
    latest = keep_latest_by(clean_registrations(bronze_df, opts), [REG_KEY], latest_order(), method=dedup_method)
    return expect_or_drop(latest, SILVER_EXPECTATIONS)


def gold(spark: SparkSession, silver_df: DataFrame, opts: GoldOptions = GoldOptions(),
         materialize_silver: bool = True) -> dict[str, DataFrame]:
    """Dimensions and the fact from one silver table.

    Silver is read four times (three dimensions and the fact), so it is first
    written once to the shared checkpoint folder unless the caller already
    passes a stored table; each dimension is stored once as well.
    """
    if materialize_silver:
        silver_df = materialize(silver_df, "silver")
    # Each dimension is stored once: the fact stage reads the vehicle dimension
    # three times (exact tier, unresolved keys, candidates).
    registry = KeyRegistry(spark, opts.registry_path, opts.load) if opts.registry_path else None
    dim_vehicle = materialize(Dm.dim_vehicle(silver_df, opts.key_method, opts.null_as_unknown, registry), "dim-vehicle")
    dim_office = materialize(Dm.dim_office(silver_df, key_method=opts.key_method), "dim-office")
    dim_maker = materialize(Dm.dim_manufacturer(silver_df, opts.key_method, registry), "dim-manufacturer")
    return {
        "dim_date": Dm.dim_date(spark),
        "dim_manufacturer": dim_maker,
        "dim_vehicle": dim_vehicle,
        "dim_office": dim_office,
        "fact": Fa.star_fact(silver_df, dim_vehicle, dim_office, dim_maker, opts.exact_multi, bucketed=opts.bucketed),
    }


def simple_star(silver_df: DataFrame, key_method: str = "range") -> dict[str, DataFrame]:
    """The simpler star schema (no unknown members; unmatched keys stay NULL)."""
    s = Dm.as_transport_silver(silver_df)
    dims = {
        "dim_rta": Dm.v_dim_office(s, key_method=key_method),
        "dim_manufacturer": Dm.v_dim_maker(s, key_method=key_method),
        "dim_vehicle": Dm.v_dim_vehicle(s),
        "dim_date": Dm.v_dim_date(s, key_method=key_method),
    }
    dims["fact"] = Fa.v_fact(s, dims["dim_vehicle"], dims["dim_rta"], dims["dim_manufacturer"], dims["dim_date"])
    return dims


def build_tables(spark: SparkSession, source: str, target: str | None = None, opts: GoldOptions = GoldOptions(),
                 clean: CleanOptions = CleanOptions(), schema: str | None = None) -> dict:
    """The whole job: CSV folder -> bronze, silver, dimensions and fact tables.

    The tables go under the folder ``target``, or into the catalog's ``schema``
    (``catalog.schema`` or ``schema``, made if it is missing). Each table is
    written once and the next stage reads the stored copy. Returns the
    expectation counts gathered while silver was written.
    """
    from regstar.sources.csv_ingest import ingest_csv

    if (target is None) == (schema is None):
        raise ValueError("give a target folder or a catalog schema")
    if schema is not None:
        spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}")

    def store(df: DataFrame, name: str) -> DataFrame:
        if schema is not None:
            write_table(df, table=f"{schema}.{name}")
            return spark.table(f"{schema}.{name}")
        path = f"{target.rstrip('/')}/{name}"
        write_table(df, path=path)
        return spark.read.parquet(path)

    bronze_df = store(ingest_csv(spark, source), "bronze_registrations")
    silver_df, obs = silver_with_metrics(bronze_df, clean)
    stored = store(silver_df, "silver_registrations")
    metrics = obs.get
    tables = gold(spark, stored, opts, materialize_silver=False)
    names = {"dim_date": "dim_date", "dim_manufacturer": "dim_manufacturer", "dim_vehicle": "dim_vehicle",
             "dim_office": "dim_office", "fact": "fact_registrations"}
    for key, name in names.items():
        store(tables[key], name)
    return metrics


SOURCE_CONF = "regstar.source_path"
TARGET_CONF = "regstar.target_path"
SCHEMA_CONF = "regstar.target_schema"


def main(argv: list[str] | None = None) -> None:
    """``python -m regstar.plans.medallion [SOURCE_DIR TARGET_DIR]``

    Without arguments the folders come from the session settings
    ``regstar.source_path`` and ``regstar.target_path`` or, for catalog tables,
    ``regstar.target_schema`` (e.g. ``--conf`` on spark-submit), read with
    ``spark.conf.get``.
    """
    import sys

    args = sys.argv[1:] if argv is None else argv
    spark = SparkSession.builder.appName("regstar").getOrCreate()
    schema = None
    if len(args) == 2:
        source, target = args
    else:
        source, target = spark.conf.get(SOURCE_CONF, None), spark.conf.get(TARGET_CONF, None)
        schema = spark.conf.get(SCHEMA_CONF, None)
    if not source or not (target or schema):
        raise SystemExit(f"usage: python -m regstar.plans.medallion SOURCE_DIR TARGET_DIR "
                         f"(or set {SOURCE_CONF} and {TARGET_CONF} or {SCHEMA_CONF})")
    print(build_tables(spark, source, None if schema else target, schema=schema))


if __name__ == "__main__":
    main()
