"""Registered queries: one per operator, each with its DuckDB reference SQL.

Every query reads the driver tables (or frames Spark derives from them) in
full. Most run on view R, dirty registrations derived from ``orders`` and
``part`` (``sources.fixtures``).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from regstar.domain import registrations as R
from regstar.functions import classify as C
from regstar.functions import dates as D
from regstar.functions import text as T
from regstar.operators import dims as Dm
from regstar.operators import repair as Rp
from regstar.operators import resolve as M
from regstar.operators.clean import dedup_columns
from regstar.operators.dedup import distinct_on, distinct_rows, keep_latest_by
from regstar.operators.harmonize import harmonize_columns
from regstar.operators.keys import KeyRegistry, dense_key
from regstar.operators.quality import StreamCounts, expect_on_stream, expect_or_drop, expectation_counts
from regstar.plans import medallion as Md
from regstar.plans import oracles as O
from regstar.plans.incremental import update_gold
from regstar.session import ensure_checkpoint_dir, materialize, scratch_path
from regstar.sources.csv_ingest import ingest_csv, write_csv_parts
from regstar.sources.fixtures import dirty_registrations
from regstar.sources.tables import read_table
from regstar.streaming.ingest import ingest_known, ingest_stream, read_bronze, read_evolved
from regstar.streaming.refresh import read_silver, refresh_stream, rewrite

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return deco


def on_r(select_sql: str) -> str:
    return f"WITH {O.r_cte()} SELECT slno, {select_sql} FROM r"


def on_silver(body: str, extra: str = "") -> str:
    return f"WITH {O.silver_ctes()}{(',' + extra) if extra else ''}\n{body}"


def _r(spark, sf):
    return dirty_registrations(spark, sf)


def _silver(spark, sf):
    return Md.silver(_r(spark, sf))


def _stored_silver(spark, sf, *cols):
    """The named silver columns, stored once for queries that read them several times."""
    return materialize(_silver(spark, sf).select(*cols), "silver")


_VEHICLE_COLUMNS = ("modelName_canonical", "variant", "fuel", "colour", "vehicleClass")


c = F.col


# --- text cleaning (T1-T8) ------------------------------------------------------------

@register("collapse_whitespace", on_r(
    f"{O.sql_collapse('makerName')} AS makerName_ws, {O.sql_collapse('modelDesc')} AS modelDesc_ws, trim(colour) AS colour_trim"))
def q_collapse_whitespace(spark, sf):
    return _r(spark, sf).select("slno", T.collapse_whitespace(c("makerName")).alias("makerName_ws"),
                                T.collapse_whitespace(c("modelDesc")).alias("modelDesc_ws"),
                                T.trim_text(c("colour")).alias("colour_trim"))


@register("strip_business_words", on_r(f"{O.sql_strip_business(O.sql_collapse('makerName'))} AS maker_stripped"))
def q_strip_business_words(spark, sf):
    return _r(spark, sf).select("slno", T.strip_business_words(T.collapse_whitespace(c("makerName"))).alias("maker_stripped"))


@register("null_placeholders", on_r(f"{O.sql_null_if('OfficeCd', R.OFFICE_PLACEHOLDER)} AS office_clean"))
def q_null_placeholders(spark, sf):
    return _r(spark, sf).select("slno", T.null_if_matches(c("OfficeCd"), R.OFFICE_PLACEHOLDER).alias("office_clean"))


@register("truncate_text", on_r(f"{O.sql_truncate('fromdate')} AS fromdate_10, {O.sql_truncate('todate')} AS todate_10"))
def q_truncate_text(spark, sf):
    return _r(spark, sf).select("slno", T.truncate_text(c("fromdate")).alias("fromdate_10"),
                                T.truncate_text(c("todate")).alias("todate_10"))


@register("normalize_reg_key", on_r(f"{O.sql_reg_key('tempRegistrationNumber')} AS reg_key"))
def q_normalize_reg_key(spark, sf):
    return _r(spark, sf).select("slno", T.normalize_reg_key(c("tempRegistrationNumber")).alias("reg_key"))


@register("floor_numeric_text", on_r(f"{O.sql_floor_text('seatCapacity')} AS seats"))
def q_floor_numeric_text(spark, sf):
    return _r(spark, sf).select("slno", T.floor_numeric_text(c("seatCapacity")).alias("seats"))


@register("clean_maker", on_r(
    f"{O.sql_clean_maker('trim(' + O.sql_strip_business(O.sql_collapse('makerName')) + ')')} AS maker"))
def q_clean_maker(spark, sf):
    m = F.trim(T.strip_business_words(T.collapse_whitespace(c("makerName"))))
    return _r(spark, sf).select("slno", T.clean_maker(m).alias("maker"))


# --- repair (T9-T14) ---------------------------------------------------------------

@register("detect_swap", on_r(f"{O.sql_is_swapped('OfficeCd', 'fromdate')} AS is_swapped"))
def q_detect_swap(spark, sf):
    return _r(spark, sf).select("slno", Rp.is_swapped(c("OfficeCd"), c("fromdate")).alias("is_swapped"))


@register("detect_shift", on_r(f"{O.sql_is_shifted('OfficeCd', 'fromdate', 'todate')} AS is_shifted"))
def q_detect_shift(spark, sf):
    return _r(spark, sf).select("slno", Rp.is_shifted(c("OfficeCd"), c("fromdate"), c("todate")).alias("is_shifted"))


@register("repair_shifted", f"""WITH {O.r_cte()},
f AS (SELECT *, {O.sql_is_shifted('OfficeCd', 'fromdate', 'todate')} AS _sh, {O.sql_is_swapped('OfficeCd', 'fromdate')} AS _sw FROM r)
SELECT slno, CASE WHEN _sh OR _sw THEN trim(fromdate) ELSE OfficeCd END AS OfficeCd,
  CASE WHEN _sh THEN todate WHEN _sw THEN OfficeCd ELSE fromdate END AS fromdate,
  CASE WHEN _sh THEN todate WHEN _sw THEN NULL ELSE todate END AS todate FROM f""")
def q_repair_shifted(spark, sf):
    return Rp.repair_columns(_r(spark, sf)).select("slno", "OfficeCd", "fromdate", "todate")


@register("backfill_office", on_r(f"{O.sql_backfill('OfficeCd', O.sql_reg_key('tempRegistrationNumber'))} AS office"))
def q_backfill_office(spark, sf):
    return _r(spark, sf).select("slno", Rp.backfill_office(
        c("OfficeCd"), T.normalize_reg_key(c("tempRegistrationNumber"))).alias("office"))


@register("null_misplaced", on_r(
    f"{O.sql_null_if('OfficeCd', R.MAKER_IN_OFFICE)} AS office_no_maker, "
    f"CASE WHEN {O.rx('lower(trim(fromdate))', R.OFFICE_IN_DATE)} THEN NULL ELSE fromdate END AS fromdate_preclean, "
    f"CASE WHEN {O.rx('lower(trim(todate))', R.OFFICE_IN_DATE)} THEN NULL ELSE todate END AS todate_preclean"))
def q_null_misplaced(spark, sf):
    def pre(x):
        return T.null_where(F.lower(F.trim(c(x))).rlike(R.OFFICE_IN_DATE), c(x))
    return _r(spark, sf).select("slno", T.null_if_matches(c("OfficeCd"), R.MAKER_IN_OFFICE).alias("office_no_maker"),
                                pre("fromdate").alias("fromdate_preclean"), pre("todate").alias("todate_preclean"))


# --- model text (T15-T19), make year (T24) ------------------------------------------------

_MC_SQL = O.sql_model_clean(O.sql_collapse("modelDesc"))
_CANON_SQL = O.sql_canonical(O.sql_tokens(_MC_SQL))


def _model_frame(spark, sf):
    r = _r(spark, sf).withColumn("_mc", T.model_clean(T.collapse_whitespace(c("modelDesc"))))
    return r.withColumns({"isTrailer": T.keyword_flag(c("_mc"), R.TRAILER_WORDS),
                          "isElectric": T.keyword_flag(c("_mc"), R.ELECTRIC_WORDS),
                          "modelName_canonical": T.model_canonical(T.model_tokens(c("_mc")))})


@register("model_canonical", on_r(f"{_CANON_SQL} AS modelName_canonical"))
def q_model_canonical(spark, sf):
    return _model_frame(spark, sf).select("slno", "modelName_canonical")


@register("model_variant", f"""WITH {O.r_cte()},
m AS (SELECT slno, {_MC_SQL} AS _mc FROM r),
m2 AS (SELECT *, {O.sql_canonical(O.sql_tokens('_mc'))} AS modelName_canonical, {O.rx('lower(_mc)', R.TRAILER_WORDS)} AS _tr FROM m)
SELECT slno, modelName_canonical, {O.sql_variant('_mc', 'modelName_canonical', '_tr')} AS variant FROM m2""")
def q_model_variant(spark, sf):
    m = _model_frame(spark, sf)
    return m.select("slno", "modelName_canonical",
                    T.model_variant(c("_mc"), c("modelName_canonical"), c("isTrailer")).alias("variant"))


@register("keyword_flags", on_r(
    f"{O.rx('lower(' + _MC_SQL + ')', R.TRAILER_WORDS)} AS isTrailer, {O.rx('lower(' + _MC_SQL + ')', R.ELECTRIC_WORDS)} AS isElectric"))
def q_keyword_flags(spark, sf):
    return _model_frame(spark, sf).select("slno", "isTrailer", "isElectric")


@register("infer_make_year", on_r(f"{O.sql_make_year('trim(makeYear)', 'trim(' + O.sql_collapse('modelDesc') + ')')} AS makeYear"))
def q_infer_make_year(spark, sf):
    return _r(spark, sf).select("slno", T.infer_make_year(
        F.trim(c("makeYear")), F.trim(T.collapse_whitespace(c("modelDesc")))).alias("makeYear"))


# --- dates (T20-T22) ---------------------------------------------------------------

@register("parse_dates", on_r(
    f"{O.sql_parse_date(O.sql_truncate('fromdate'))} AS fromdate_parsed, {O.sql_parse_date(O.sql_truncate('todate'))} AS todate_parsed"))
def q_parse_dates(spark, sf):
    return _r(spark, sf).select("slno", D.parse_dates_fixed(T.truncate_text(c("fromdate"))).alias("fromdate_parsed"),
                                D.parse_dates_fixed(T.truncate_text(c("todate"))).alias("todate_parsed"))


_EFF_SQL = (f"coalesce({O.sql_parse_date(O.sql_truncate('fromdate'))}, {O.sql_parse_date(O.sql_truncate('todate'))}, "
            f"DATE '1900-01-01')")


@register("effective_date", f"""WITH {O.r_cte()}, e AS (SELECT slno, {_EFF_SQL} AS d FROM r)
SELECT slno, CAST(year(d) AS INTEGER) AS REGISTRATION_YEAR, CAST(month(d) AS INTEGER) AS REGISTRATION_MONTH,
  CAST(year(d) * 10000 + month(d) * 100 + day(d) AS INTEGER) AS REGISTRATION_DATE_ID FROM e""")
def q_effective_date(spark, sf):
    eff = D.effective_date(D.parse_dates_fixed(T.truncate_text(c("fromdate"))),
                           D.parse_dates_fixed(T.truncate_text(c("todate"))))
    return _r(spark, sf).select("slno", F.year(eff).alias("REGISTRATION_YEAR"), F.month(eff).alias("REGISTRATION_MONTH"),
                                D.date_id(eff).alias("REGISTRATION_DATE_ID"))


# --- classification (T23, T25-T28) ---------------------------------------------------------

@register("classify_fuel", on_r(f"{O.sql_fuel('trim(fuel)', 'trim(' + O.sql_collapse('modelDesc') + ')')} AS fuel_clean"))
def q_classify_fuel(spark, sf):
    return _r(spark, sf).select("slno", C.classify_fuel(
        F.trim(c("fuel")), F.trim(T.collapse_whitespace(c("modelDesc")))).alias("fuel_clean"))


@register("classify_ownership", on_r(f"{O.sql_ownership('secondVehicle')} AS OWNERSHIP_TYPE"))
def q_classify_ownership(spark, sf):
    return _r(spark, sf).select("slno", C.classify_ownership(c("secondVehicle")).alias("OWNERSHIP_TYPE"))


@register("classify_transport", on_r(f"{O.sql_transport('category', 'vehicleClass')} AS TRANSPORT_TYPE"))
def q_classify_transport(spark, sf):
    return _r(spark, sf).select("slno", C.classify_transport(c("category"), c("vehicleClass")).alias("TRANSPORT_TYPE"))


@register("map_office_name", on_r(f"{O.sql_office_name('trim(OfficeCd)')} AS office_code"))
def q_map_office_name(spark, sf):
    return _r(spark, sf).select("slno", C.map_office_name(F.trim(c("OfficeCd"))).alias("office_code"))


@register("standardize_code", on_r(f"{O.sql_code_std(O.sql_office_name('trim(OfficeCd)'))} AS OfficeCd_STD"))
def q_standardize_code(spark, sf):
    return _r(spark, sf).select("slno", C.standardize_code(C.map_office_name(F.trim(c("OfficeCd")))).alias("OfficeCd_STD"))


# --- harmonise, quality, dedup ----------------------------------------------------------

def _drifted(spark, sf):
    """View R under other header spellings, a split column and an unknown column."""
    r = _r(spark, sf)
    odd = c("slno").cast("long") % 2 == 1
    return r.select(
        c("slno").alias("SL_NO"), F.when(odd, c("modelDesc")).alias("Model.Description"),
        F.when(~odd, c("modelDesc")).alias("modelDesc"), c("makerName").alias(" Manufacturer "),
        c("OfficeCd").alias("office.code"), c("tempRegistrationNumber").alias("regno"),
        c("fromdate").alias("regn_date"), c("todate").alias("regn_to_date"), c("fuel").alias("fuel_used"),
        c("colour").alias("Color"), c("vehicleClass").alias("classofveh"), c("makeYear").alias("mfg_year"),
        c("seatCapacity").alias("seat_cap"), c("category").alias("veh.category"),
        c("secondVehicle").alias("issecondvehicle"), F.lit("x").alias("unknown_col"))


@register("harmonize_columns", f"WITH {O.r_cte()} SELECT * FROM r")
def q_harmonize_columns(spark, sf):
    return harmonize_columns(_drifted(spark, sf))


_VALID_KEY_SQL = "tempRegistrationNumber IS NOT NULL AND length(trim(tempRegistrationNumber)) > 3"


@register("expect_or_drop", f"""WITH {O.r_cte()}, k AS (SELECT slno, {O.sql_reg_key('tempRegistrationNumber')} AS tempRegistrationNumber FROM r)
SELECT slno, tempRegistrationNumber FROM k WHERE coalesce({_VALID_KEY_SQL}, false)""")
def q_expect_or_drop(spark, sf):
    k = _r(spark, sf).select("slno", T.normalize_reg_key(c("tempRegistrationNumber")).alias("tempRegistrationNumber"))
    return expect_or_drop(k, Md.SILVER_EXPECTATIONS)


@register("expect_metrics", f"""WITH {O.r_cte()}, k AS (SELECT {O.sql_reg_key('tempRegistrationNumber')} AS tempRegistrationNumber FROM r)
SELECT CAST(count(*) AS BIGINT) AS rows,
  CAST(coalesce(sum(CASE WHEN coalesce({_VALID_KEY_SQL}, false) THEN 1 ELSE 0 END), 0) AS BIGINT) AS passed_valid_registration,
  CAST(coalesce(sum(CASE WHEN coalesce({_VALID_KEY_SQL}, false) THEN 0 ELSE 1 END), 0) AS BIGINT) AS failed_valid_registration FROM k""")
def q_expect_metrics(spark, sf):
    k = _r(spark, sf).select(T.normalize_reg_key(c("tempRegistrationNumber")).alias("tempRegistrationNumber"))
    return expectation_counts(k, Md.SILVER_EXPECTATIONS)


@register("keep_latest", on_silver(
    "SELECT tempRegistrationNumber, slno, fromdate_parsed, todate_parsed FROM silver"))
def q_keep_latest(spark, sf):
    return _silver(spark, sf).select("tempRegistrationNumber", "slno", "fromdate_parsed", "todate_parsed")


@register("silver", on_silver("SELECT * FROM silver"))
def q_silver(spark, sf):
    return _silver(spark, sf)


@register("keep_latest_events", """SELECT user_id, event_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) AS _rn FROM events)
WHERE _rn = 1""")
def q_keep_latest_events(spark, sf):
    ev = read_table(spark, sf, "events").select("user_id", "event_id", "event_type", "value", "ts")
    return keep_latest_by(ev, ["user_id"], [c("ts"), c("event_id")]).drop("ts")


@register("dedup_on_keys", """SELECT o_custkey, o_orderdate, o_orderkey, o_totalprice FROM (
  SELECT o_custkey, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderkey, o_totalprice, row_number() OVER (
    PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) NULLS FIRST, o_orderkey NULLS FIRST, o_totalprice NULLS FIRST) AS _rn
  FROM orders) WHERE _rn = 1""")
def q_dedup_on_keys(spark, sf):
    o = read_table(spark, sf, "orders").select("o_custkey", c("o_orderdate").cast("date").alias("o_orderdate"),
                                               "o_orderkey", "o_totalprice")
    return distinct_on(o, ["o_custkey"])


@register("distinct_values", f"WITH {O.r_cte()} SELECT DISTINCT fuel, colour, vehicleClass FROM r")
def q_distinct_values(spark, sf):
    return distinct_rows(_r(spark, sf).select("fuel", "colour", "vehicleClass"))


# --- surrogate keys ------------------------------------------------------------------

@register("surrogate_key", """SELECT p_name, CAST(row_number() OVER (ORDER BY p_name NULLS FIRST) AS INTEGER) AS name_key
FROM (SELECT DISTINCT p_name FROM part)""")
def q_surrogate_key(spark, sf):
    names = read_table(spark, sf, "part").select("p_name").distinct()
    return dense_key(names, ["p_name"], "name_key")


@register("surrogate_key_customers", """SELECT c_custkey, c_mktsegment, c_name, 'C' || CAST(row_number() OVER (
  ORDER BY c_mktsegment NULLS FIRST, c_name NULLS FIRST, c_custkey NULLS FIRST) AS VARCHAR) AS customer_key FROM customer""")
def q_surrogate_key_customers(spark, sf):
    cust = read_table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_name")
    return dense_key(cust, ["c_mktsegment", "c_name", "c_custkey"], "customer_key", prefix="C")


@register("surrogate_key_registry", """WITH a AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer WHERE c_custkey % 5 = 1),
b AS (SELECT DISTINCT c_mktsegment, c_nationkey FROM customer EXCEPT SELECT * FROM a)
SELECT c_mktsegment, c_nationkey, CAST(row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, c_nationkey NULLS FIRST) AS INTEGER) AS group_key FROM a
UNION ALL SELECT c_mktsegment, c_nationkey, CAST(row_number() OVER (ORDER BY c_mktsegment NULLS FIRST, c_nationkey NULLS FIRST) +
  (SELECT count(*) FROM a) AS INTEGER) FROM b""")
def q_surrogate_key_registry(spark, sf):
    """Keys of two loads: those of the first stay, new names get the next ones."""
    cust = read_table(spark, sf, "customer")
    path, names = scratch_path(spark, "key-registry"), ["c_mktsegment", "c_nationkey"]
    KeyRegistry(spark, path, 0).keyed(cust.filter("c_custkey % 5 = 1").select(*names).distinct(), names, "group_key")
    return KeyRegistry(spark, path, 1).keyed(cust.select(*names).distinct(), names, "group_key")


# --- dimensions -----------------------------------------------------------------------

@register("dim_date", on_silver("""SELECT full_date, CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER) AS DATE_ID,
  CAST(year(full_date) AS INTEGER) AS YEAR, CAST(month(full_date) AS INTEGER) AS MONTH, CAST(day(full_date) AS INTEGER) AS DAY,
  CAST(quarter(full_date) AS INTEGER) AS QUARTER, coalesce(n, 0) AS n_registrations
FROM (SELECT CAST(d AS DATE) AS full_date FROM generate_series(DATE '2000-01-01', DATE '2030-12-31', INTERVAL 1 DAY) t(d)
      UNION ALL SELECT DATE '1900-01-01')
LEFT JOIN (SELECT REGISTRATION_DATE_ID AS id, count(*) AS n FROM silver GROUP BY 1)
  ON id = CAST(year(full_date) * 10000 + month(full_date) * 100 + day(full_date) AS INTEGER)"""))
def q_dim_date(spark, sf):
    """The whole calendar with the registrations of each day."""
    used = _silver(spark, sf).groupBy(c("REGISTRATION_DATE_ID").alias("DATE_ID")).agg(F.count(F.lit(1)).alias("n"))
    return (Dm.dim_date(spark).join(used, "DATE_ID", "left")
            .withColumn("n_registrations", F.coalesce("n", F.lit(0).cast("long"))).drop("n"))


@register("dim_manufacturer", on_silver("SELECT * FROM dim_manufacturer", O.dims_ctes()))
def q_dim_manufacturer(spark, sf):
    return Dm.dim_manufacturer(_silver(spark, sf))


@register("vehicle_normalize", on_silver("SELECT * FROM vehicle_norm", O.dims_ctes()))
def q_vehicle_normalize(spark, sf):
    return Dm.vehicle_normalize(_silver(spark, sf))


@register("dim_vehicle", on_silver("SELECT * FROM dim_vehicle", O.dims_ctes()))
def q_dim_vehicle(spark, sf):
    return Dm.dim_vehicle(_silver(spark, sf))


@register("dim_office", on_silver("SELECT * FROM dim_office", O.dims_ctes()))
def q_dim_office(spark, sf):
    return Dm.dim_office(_silver(spark, sf))


# --- matching and fact -------------------------------------------------------------------

_MATCH = O.dims_ctes() + "," + O.match_ctes("min")


def _resolved(spark, sf, multi="min"):
    s = _stored_silver(spark, sf, "tempRegistrationNumber", *_VEHICLE_COLUMNS)
    return M.resolve(s, materialize(Dm.dim_vehicle(s), "dim-vehicle"), exact_multi=multi)


@register("match_keys", on_silver("SELECT tempRegistrationNumber, KEY, BLOCK FROM stg", _MATCH))
def q_match_keys(spark, sf):
    return M.match_keys(_silver(spark, sf).select("tempRegistrationNumber", "modelName_canonical", "variant"),
                        "modelName_canonical", "variant").select("tempRegistrationNumber", "KEY", "BLOCK")


@register("match_exact", on_silver("SELECT * FROM exact", _MATCH))
def q_match_exact(spark, sf):
    return M.tier(_resolved(spark, sf), M.EXACT)


@register("match_candidates", on_silver(f"""SELECT u.KEY, d.KEY2, d.VEHICLE_KEY, CAST(levenshtein(u.KEY, d.KEY2) AS INTEGER) AS LEV
FROM (SELECT DISTINCT KEY, BLOCK FROM unresolved) u
JOIN (SELECT KEY2, BLOCK2, CAST(min(VEHICLE_KEY) AS INTEGER) AS VEHICLE_KEY FROM dkeys GROUP BY KEY2, BLOCK2) d
  ON u.BLOCK = d.BLOCK2 AND abs(length(u.KEY) - length(d.KEY2)) <= {R.LEVENSHTEIN_BOUND}
WHERE levenshtein(u.KEY, d.KEY2) <= {R.LEVENSHTEIN_BOUND}""", _MATCH))
def q_match_candidates(spark, sf):
    s = _stored_silver(spark, sf, *_VEHICLE_COLUMNS)
    keys = M.match_keys(s.select("modelName_canonical", "variant"), "modelName_canonical", "variant") \
        .select("KEY", "BLOCK").distinct()
    dk = M.dim_keys(materialize(Dm.dim_vehicle(s), "dim-vehicle"))
    return M.candidate_pairs(M.unresolved_keys(keys, dk), dk)


_PART_KEYS = f"""SELECT DISTINCT concat_ws(' ', {O.sql_normalize('p_brand')}, {O.sql_normalize('p_name')}) AS KEY,
  substring({O.sql_normalize('p_brand')}, 1, {R.BLOCK_LENGTH}) AS BLOCK"""


@register("match_candidates_hot", f"""WITH u AS ({_PART_KEYS} FROM (SELECT p_brand, reverse(substring(reverse(p_name), 2)) AS p_name FROM part)),
d AS (SELECT KEY AS KEY2, BLOCK AS BLOCK2, CAST(min(p_partkey) AS INTEGER) AS VEHICLE_KEY FROM ({_PART_KEYS}, p_partkey FROM part) GROUP BY 1, 2)
SELECT u.KEY, d.KEY2, d.VEHICLE_KEY, CAST(levenshtein(u.KEY, d.KEY2) AS INTEGER) AS LEV FROM u JOIN d
  ON u.BLOCK = d.BLOCK2 AND abs(length(u.KEY) - length(d.KEY2)) <= {R.LEVENSHTEIN_BOUND} WHERE levenshtein(u.KEY, d.KEY2) <= {R.LEVENSHTEIN_BOUND}""")
def q_match_candidates_hot(spark, sf):
    """Candidates among parts by brand and name: all brands begin alike, so all keys are one hot block."""
    p = read_table(spark, sf, "part").select("p_partkey", "p_brand", "p_name")
    cut = p.withColumn("p_name", F.reverse(F.substring(F.reverse("p_name"), 2, 1 << 20)))
    dk = M.dim_keys(p, "p_partkey", "p_brand", "p_name")
    return M.candidate_pairs(M.match_keys(cut, "p_brand", "p_name").select("KEY", "BLOCK").distinct(), dk)


@register("match_fuzzy", on_silver("SELECT * FROM fuzzy", _MATCH))
def q_match_fuzzy(spark, sf):
    return M.tier(_resolved(spark, sf), M.FUZZY)


@register("match_unmatched", on_silver("SELECT * FROM unmatched", _MATCH))
def q_match_unmatched(spark, sf):
    return M.tier(_resolved(spark, sf), M.UNMATCHED)


@register("match_tiers", on_silver("SELECT * FROM resolved", _MATCH))
def q_match_tiers(spark, sf):
    return _resolved(spark, sf)


@register("match_exact_all", on_silver("SELECT * FROM resolved", O.dims_ctes() + "," + O.match_ctes("all")))
def q_match_exact_all(spark, sf):
    return _resolved(spark, sf, "all")


@register("fact_star", on_silver(O.fact_select(), _MATCH))
def q_fact_star(spark, sf):
    g = Md.gold(spark, _silver(spark, sf))
    return g["fact"]


@register("fact_fanout", on_silver(O.fact_select(), O.dims_ctes() + "," + O.match_ctes("all")))
def q_fact_fanout(spark, sf):
    g = Md.gold(spark, _silver(spark, sf), Md.GoldOptions(exact_multi="all"))
    return g["fact"]


@register("fact_bucketed", on_silver(O.fact_select(), _MATCH))
def q_fact_bucketed(spark, sf):
    """The fact from silver and resolution stored as tables that are bucketed alike."""
    tables = (f"regstar_{uuid.uuid4().hex}", int(spark.conf.get("spark.sql.shuffle.partitions")))
    return Md.gold(spark, _silver(spark, sf), Md.GoldOptions(bucketed=tables))["fact"]


_FIRST = "SELECT * FROM r WHERE CAST(slno AS BIGINT) % 8 <> 0"
_TWO_LOADS = f"""
first_vehicle AS (WITH {O.silver_ctes(O.r_cte() + f", r1 AS ({_FIRST})", "r1")},{O.dims_ctes()}
  SELECT MODEL_NAME, VARIANT, FUEL, VEHICLE_KEY FROM dim_vehicle WHERE VEHICLE_KEY > 0),
first_maker AS (WITH {O.silver_ctes(O.r_cte() + f", r1 AS ({_FIRST})", "r1")},{O.dims_ctes()}
  SELECT MANUFACTURER_NAME, MANUFACTURER_KEY FROM dim_manufacturer WHERE MANUFACTURER_KEY <> '-1'),
{O.dims_ctes().replace("dim_vehicle AS (", "now_vehicle AS (").replace("dim_manufacturer AS (", "now_maker AS (")},
dim_vehicle AS (SELECT n.MODEL_NAME, n.VARIANT, n.FUEL, n.COLOUR, n.VEHICLE_CLASS, CAST(CASE WHEN n.VEHICLE_KEY = -1 THEN -1
    WHEN f.VEHICLE_KEY IS NOT NULL THEN f.VEHICLE_KEY ELSE (SELECT count(*) FROM first_vehicle) +
    row_number() OVER (PARTITION BY n.VEHICLE_KEY = -1, f.VEHICLE_KEY IS NULL ORDER BY n.VEHICLE_KEY) END AS INTEGER) AS VEHICLE_KEY
  FROM now_vehicle n LEFT JOIN first_vehicle f ON n.VEHICLE_KEY > 0 AND n.MODEL_NAME = f.MODEL_NAME AND n.VARIANT = f.VARIANT
    AND n.FUEL IS NOT DISTINCT FROM f.FUEL),
dim_manufacturer AS (SELECT n.MANUFACTURER_NAME, CASE WHEN n.MANUFACTURER_KEY = '-1' THEN '-1'
    WHEN f.MANUFACTURER_KEY IS NOT NULL THEN f.MANUFACTURER_KEY ELSE 'M' || CAST((SELECT count(*) FROM first_maker) +
    row_number() OVER (PARTITION BY n.MANUFACTURER_KEY = '-1', f.MANUFACTURER_KEY IS NULL ORDER BY n.MANUFACTURER_NAME) AS VARCHAR)
    END AS MANUFACTURER_KEY
  FROM now_maker n LEFT JOIN first_maker f ON n.MANUFACTURER_KEY <> '-1' AND n.MANUFACTURER_NAME = f.MANUFACTURER_NAME),
{O.match_ctes("min")}"""


@register("gold_incremental", on_silver(O.fact_select(), _TWO_LOADS))
def q_gold_incremental(spark, sf):
    """Gold of seven eighths of the records, then updated by the registrations of the rest; the fact."""
    r = _r(spark, sf)
    later = F.coalesce(c("slno").cast("long") % 8 == 0, F.lit(False))
    before, after = materialize(Md.silver(r.filter(~later)), "silver"), materialize(Md.silver(r), "silver")
    keys = scratch_path(spark, "gold-keys")
    old = Md.gold(spark, before, Md.GoldOptions(registry_path=keys, load=0), materialize_silver=False)
    old["fact"] = materialize(old["fact"], "fact")
    # numbers as silver has them: the key is repaired while cleaning
    changed = dedup_columns(r.filter(later)).select(Md.REG_KEY)
    return update_gold(spark, old, before, after, changed, Md.GoldOptions(registry_path=keys, load=1))["fact"]


# --- the simpler star schema ----------------------------------------------------------------

_J = O.q(R.SIMPLE_JUNK)
_V_DIMS = f"""
v_dim_office AS (SELECT RTA_NAME, CAST(row_number() OVER (ORDER BY RTA_NAME NULLS FIRST) AS INTEGER) AS RTA_ID
  FROM (SELECT DISTINCT upper(trim(OfficeCd)) AS RTA_NAME FROM silver) WHERE NOT regexp_matches(RTA_NAME, {_J})),
v_dim_maker AS (SELECT MANUFACTURER_NAME, CAST(row_number() OVER (ORDER BY MANUFACTURER_NAME NULLS FIRST) AS INTEGER) AS MANUFACTURER_ID
  FROM (SELECT DISTINCT makerName AS MANUFACTURER_NAME FROM silver) WHERE NOT regexp_matches(MANUFACTURER_NAME, {_J})),
v_rows AS (SELECT concat_ws(' | ', upper(trim(modelName_canonical)), upper(trim(variant))) AS VEHICLE_NATURAL_KEY,
  modelName_canonical AS MODEL_NAME, variant AS VARIANT, fuel_clean AS FUEL, colour AS COLOUR, vehicleClass AS VEHICLE_CLASS,
  coalesce(lower(fuel_clean) = 'electric', false) AS IS_ELECTRIC, OWNERSHIP_TYPE, TRANSPORT_TYPE,
  CAST(REGISTRATION_YEAR AS INTEGER) AS REGISTRATION_YEAR FROM silver),
v_dim_vehicle AS (SELECT * EXCLUDE (_rn), VEHICLE_NATURAL_KEY AS VEHICLE_KEY FROM (SELECT *, row_number() OVER (
  PARTITION BY VEHICLE_NATURAL_KEY ORDER BY MODEL_NAME NULLS FIRST, VARIANT NULLS FIRST, FUEL NULLS FIRST, COLOUR NULLS FIRST,
  VEHICLE_CLASS NULLS FIRST, IS_ELECTRIC NULLS FIRST, OWNERSHIP_TYPE NULLS FIRST, TRANSPORT_TYPE NULLS FIRST,
  REGISTRATION_YEAR NULLS FIRST) AS _rn FROM v_rows) WHERE _rn = 1),
v_dim_date AS (SELECT DATE, CAST(row_number() OVER (ORDER BY DATE NULLS FIRST) AS INTEGER) AS DATE_KEY,
  CAST(year(DATE) AS INTEGER) AS YEAR, CAST(month(DATE) AS INTEGER) AS MONTH
  FROM (SELECT DISTINCT fromdate_parsed AS DATE FROM silver WHERE fromdate_parsed IS NOT NULL))"""


def _transport(spark, sf):
    return Dm.as_transport_silver(_silver(spark, sf))


@register("v_dim_office", on_silver("SELECT * FROM v_dim_office", _V_DIMS))
def q_v_dim_office(spark, sf):
    return Dm.v_dim_office(_transport(spark, sf))


@register("v_dim_maker", on_silver("SELECT * FROM v_dim_maker", _V_DIMS))
def q_v_dim_maker(spark, sf):
    return Dm.v_dim_maker(_transport(spark, sf))


@register("v_dim_vehicle", on_silver("SELECT * FROM v_dim_vehicle", _V_DIMS))
def q_v_dim_vehicle(spark, sf):
    return Dm.v_dim_vehicle(_transport(spark, sf))


@register("v_dim_date", on_silver("SELECT * FROM v_dim_date", _V_DIMS))
def q_v_dim_date(spark, sf):
    return Dm.v_dim_date(_transport(spark, sf))


@register("v_fact", on_silver("""SELECT s.tempRegistrationNumber AS TEMP_REGISTRATION_NUMBER, v.VEHICLE_KEY, o.RTA_ID,
  m.MANUFACTURER_ID AS MANUFACTURER_KEY, d.DATE_KEY, TRY_CAST(s.makeYear AS INTEGER) AS MAKE_YEAR, s.category AS CATEGORY
FROM silver s
LEFT JOIN v_dim_vehicle v ON concat_ws(' | ', upper(trim(s.modelName_canonical)), upper(trim(s.variant))) = v.VEHICLE_NATURAL_KEY
LEFT JOIN v_dim_office o ON upper(trim(s.OfficeCd)) = o.RTA_NAME
LEFT JOIN v_dim_maker m ON s.makerName = m.MANUFACTURER_NAME
LEFT JOIN v_dim_date d ON s.fromdate_parsed = d.DATE""", _V_DIMS))
def q_v_fact(spark, sf):
    cols = ["tempRegistrationNumber", "makerName", "OfficeCd", "fromdate_parsed", "makeYear", "category", "fuel_clean",
            "OWNERSHIP_TYPE", "TRANSPORT_TYPE", "REGISTRATION_YEAR", *_VEHICLE_COLUMNS]
    return Md.simple_star(_stored_silver(spark, sf, *cols))["fact"]


# --- scalar families on other tables ------------------------------------------------------

@register("normalize_text", f"SELECT p_partkey, {O.sql_normalize('p_name')} AS p_name_norm, "
                            f"{O.sql_normalize('p_brand')} AS p_brand_norm FROM part")
def q_normalize_text(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", T.normalize_text(c("p_name")).alias("p_name_norm"),
                    T.normalize_text(c("p_brand")).alias("p_brand_norm"))


@register("scalar_strings", """SELECT p_partkey, upper(p_name) AS name_upper, lower(p_brand) AS brand_lower,
  CAST(length(p_name) AS INTEGER) AS name_len, substring(p_name, 1, 4) AS name_head, p_brand || '-' || p_type AS brand_type,
  concat_ws(' ', p_name, p_brand) AS name_brand, contains(p_name, 'an') AS has_an,
  regexp_extract(p_name, '^[a-z]+', 0) AS first_word, trim('  ' || p_type || '  ') AS type_trim FROM part""")
def q_scalar_strings(spark, sf):
    p = read_table(spark, sf, "part")
    return p.select("p_partkey", F.upper("p_name").alias("name_upper"), F.lower("p_brand").alias("brand_lower"),
                    F.length("p_name").alias("name_len"), F.substring("p_name", 1, 4).alias("name_head"),
                    F.concat(c("p_brand"), F.lit("-"), c("p_type")).alias("brand_type"),
                    F.concat_ws(" ", c("p_name"), c("p_brand")).alias("name_brand"),
                    c("p_name").contains("an").alias("has_an"),
                    F.regexp_extract("p_name", "^[a-z]+", 0).alias("first_word"),
                    F.trim(F.concat(F.lit("  "), c("p_type"), F.lit("  "))).alias("type_trim"))


@register("scalar_dates", """SELECT o_orderkey, CAST(o_orderdate AS DATE) AS order_date,
  CAST(year(o_orderdate) AS INTEGER) AS y, CAST(month(o_orderdate) AS INTEGER) AS m, CAST(day(o_orderdate) AS INTEGER) AS d,
  CAST(quarter(o_orderdate) AS INTEGER) AS q,
  CAST(year(o_orderdate) * 10000 + month(o_orderdate) * 100 + day(o_orderdate) AS INTEGER) AS date_id,
  CAST(CAST(o_orderdate AS DATE) + INTERVAL 1 MONTH AS DATE) AS next_month FROM orders""")
def q_scalar_dates(spark, sf):
    o = read_table(spark, sf, "orders").select("o_orderkey", c("o_orderdate").cast("date").alias("order_date"))
    d = c("order_date")
    return o.select("o_orderkey", "order_date", F.year(d).alias("y"), F.month(d).alias("m"),
                    F.dayofmonth(d).alias("d"), F.quarter(d).alias("q"), D.date_id(d).alias("date_id"),
                    F.add_months(d, 1).alias("next_month"))


@register("scalar_arrays", """SELECT p_partkey, CAST(len(string_split(p_name, ' ')) AS INTEGER) AS n_tokens,
  array_to_string(list_slice(string_split(p_name, ' '), 1, 1), ' ') AS head_token,
  array_to_string(list_filter(string_split(p_name, ' '), lambda x: length(x) > 3), ' ') AS long_tokens FROM part""")
def q_scalar_arrays(spark, sf):
    p = read_table(spark, sf, "part")
    toks = F.split(c("p_name"), " ")
    return p.select("p_partkey", F.size(toks).alias("n_tokens"),
                    F.array_join(F.slice(toks, 1, 1), " ").alias("head_token"),
                    F.array_join(F.filter(toks, lambda x: F.length(x) > 3), " ").alias("long_tokens"))


@register("normalize_text_documents", f"SELECT doc_id, {O.sql_normalize('text')} AS text_norm FROM documents")
def q_normalize_text_documents(spark, sf):
    return read_table(spark, sf, "documents").select("doc_id", T.normalize_text(c("text")).alias("text_norm"))


# --- ingest (S1-S3) ----------------------------------------------------------------------

_LAYOUTS = [
    (R.GOLDEN_COLUMNS, R.GOLDEN_COLUMNS),
    (["slno", "maker", "model.description", "office.code", "regno", "regn_date", "regn_to_date", "color",
      "fuel_used", "classofveh", "seat_cap", "mfg_year", "issecondvehicle", "veh.category"],
     ["slno", "makerName", "modelDesc", "OfficeCd", "tempRegistrationNumber", "fromdate", "todate", "colour",
      "fuel", "vehicleClass", "seatCapacity", "makeYear", "secondVehicle", "category"]),
    (["slno", "modelDesc", "model_desc", "makerName", "OfficeCd", "tempRegistrationNumber", "fromdate", "todate",
      "fuel", "vehicleClass", "makeYear", "seatCapacity", "category", "secondVehicle", "extra_notes"],
     ["slno", "_md_even", "_md_odd", "makerName", "OfficeCd", "tempRegistrationNumber", "fromdate", "todate",
      "fuel", "vehicleClass", "makeYear", "seatCapacity", "category", "secondVehicle", "slno"]),
]


def _write_dirty_csv(spark, sf) -> str:
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/csv-{uuid.uuid4().hex}"
    r = _r(spark, sf)
    even = c("slno").cast("long") % 2 == 0
    r = r.withColumns({"_md_even": F.when(even, c("modelDesc")), "_md_odd": F.when(~even, c("modelDesc"))})
    write_csv_parts(r, path, _LAYOUTS, "slno")
    return path


_INGEST_SQL = f"WITH {O.r_cte()} {O.ingest_select('r')}"


@register("ingest_csv", _INGEST_SQL)
def q_ingest_csv(spark, sf):
    return ingest_csv(spark, _write_dirty_csv(spark, sf))


@register("ingest_stream", _INGEST_SQL)
def q_ingest_stream(spark, sf):
    src = _write_dirty_csv(spark, sf)
    out, ckpt = f"{src}-bronze", f"{src}-checkpoint"
    ingest_stream(spark, src, out, ckpt)
    return read_bronze(spark, out).drop("batch_id")


@register("ingest_known", _INGEST_SQL)
def q_ingest_known(spark, sf):
    """The three layouts as three CSV streams with known headers, harmonised on the stream, into Spark's Parquet sink."""
    src = _write_dirty_csv(spark, sf)
    out = scratch_path(spark, "known-bronze")
    ingest_known(spark, {f"{src}/layout={i}": ",".join(names) for i, (names, _) in enumerate(_LAYOUTS)}, out, scratch_path(spark, "known-ckpt"))
    return spark.read.parquet(out)


@register("ingest_evolving", f"""WITH {O.r_cte()}, bronze AS ({O.ingest_select('r')})
SELECT bronze.*, CASE WHEN CAST(slno AS BIGINT) % 3 = 2 THEN slno END AS extra_notes FROM bronze""")
def q_ingest_evolving(spark, sf):
    """Three runs of the stream, a layout each; the last brings a column that is kept, NULL in the earlier files."""
    src = _write_dirty_csv(spark, sf)
    out, ckpt, schema = (scratch_path(spark, n) for n in ("evolving-bronze", "evolving-ckpt", "evolving-schema"))
    for i in range(len(_LAYOUTS)):
        ingest_stream(spark, f"{src}/layout=[0-{i}]", out, ckpt, schema_path=schema)
    return read_evolved(spark, out, schema).drop("batch_id")


#: Fields that a line of the CSV files of ``ingest_malformed`` lacks or has too many, by its serial number.
_SHORT, _LONG, _FILES = 7, 11, 8


def _write_malformed_csv(spark, sf) -> str:
    """View R as CSV lines in ``_FILES`` folders, some lines a field short, some with two too many.

    A folder has as many files, each with the header, as there are shuffle
    partitions for it, so a task sorts and writes no more than its partition.
    """
    pieces = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // _FILES)
    n = c("slno").cast("long")
    line = F.to_csv(F.struct(*R.GOLDEN_COLUMNS[:-1]))
    last = F.coalesce(R.GOLDEN_COLUMNS[-1], F.lit(""))  # Y or N: nothing to quote
    line = F.when(n % _SHORT == 0, line).when(n % _LONG == 0, F.concat(line, F.lit(","), last, F.lit(",x,y"))).otherwise(F.concat(line, F.lit(","), last))
    piece = F.coalesce(F.pmod(F.xxhash64(n), F.lit(pieces)), F.lit(0))
    lines = _r(spark, sf).select((n % _FILES).alias("file"), piece.alias("piece"), F.lit(1).alias("o"), line.alias("value"))
    heads = spark.range(_FILES * pieces).select((c("id") % _FILES).alias("file"), F.floor(c("id") / _FILES).alias("piece"),
                                                F.lit(0).alias("o"), F.lit(",".join(R.GOLDEN_COLUMNS)).alias("value"))
    path = scratch_path(spark, "malformed-csv")
    (heads.unionByName(lines).repartition(_FILES * pieces, "file", "piece").sortWithinPartitions("file", "piece", "o")
     .select("file", "piece", "value").write.partitionBy("file", "piece").text(path))
    return path


@register("ingest_malformed", f"""WITH {O.r_cte()} SELECT CAST(slno AS BIGINT) % {_FILES} AS file, count(*) AS n_rows,
  count(*) FILTER (CAST(slno AS BIGINT) % {_SHORT} = 0 OR CAST(slno AS BIGINT) % {_LONG} = 0) AS n_malformed,
  count(*) FILTER (CAST(slno AS BIGINT) % {_SHORT} <> 0 AND CAST(slno AS BIGINT) % {_LONG} = 0) AS n_longer,
  CAST(sum(CAST(slno AS BIGINT)) AS BIGINT) AS sum_slno FROM r GROUP BY 1""")
def q_ingest_malformed(spark, sf):
    """Rows and malformed rows per file, from bronze that carries both."""
    bronze = ingest_csv(spark, _write_malformed_csv(spark, sf), malformed=True)
    bad = c("_malformed").isNotNull()
    return bronze.groupBy(F.regexp_extract("_source_file", "file=([0-9]+)", 1).cast("long").alias("file")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(bad).alias("n_malformed"),
        F.count_if(bad & c("_malformed").endswith(",x,y")).alias("n_longer"), F.sum(c("slno").cast("long")).alias("sum_slno"))


@register("expect_metrics_stream", ORACLES["expect_metrics"])
def q_expect_metrics_stream(spark, sf):
    """The expectation's counts observed in four micro-batches and summed by a listener."""
    k = _r(spark, sf).select(T.normalize_reg_key(c("tempRegistrationNumber")).alias("tempRegistrationNumber"))
    src, out, ckpt = (scratch_path(spark, n) for n in ("keys-files", "valid-keys", "valid-ckpt"))
    k.repartition(4).write.parquet(src)
    counts = StreamCounts("valid_keys")
    spark.streams.addListener(counts)
    try:
        valid = expect_on_stream(spark.readStream.schema(k.schema).option("maxFilesPerTrigger", "1").parquet(src), Md.SILVER_EXPECTATIONS, "valid_keys")
        (valid.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt)
         .trigger(availableNow=True).start().awaitTermination())
        total = counts.wait()
    finally:
        spark.streams.removeListener(counts)
    rows, failed = total["rows"], total["failed_valid_registration"]
    return spark.createDataFrame([(rows, rows - failed, failed)], "rows long, passed_valid_registration long, failed_valid_registration long")


@register("silver_incremental", on_silver("SELECT * FROM silver"))
def q_silver_incremental(spark, sf):
    """Silver built by the streaming refresh in four micro-batches, its state rewritten after three; equals the batch build."""
    r = _r(spark, sf)
    src, n = scratch_path(spark, "bronze-files"), int(spark.conf.get("spark.sql.shuffle.partitions"))
    r.filter(c("slno").cast("long") % 4 > 0).repartition(3 * n).write.parquet(src)  # a batch takes n of the files
    state, later, ckpt = (scratch_path(spark, n) for n in ("silver-state", "silver-state", "silver-ckpt"))
    refresh_stream(spark, src, r.schema, state, ckpt, max_files_per_trigger=n)
    rewrite(spark, state, later)
    r.filter(F.coalesce(c("slno").cast("long") % 4 <= 0, F.lit(True))).repartition(n).write.mode("append").parquet(src)
    refresh_stream(spark, src, r.schema, later, ckpt, max_files_per_trigger=n)
    return read_silver(spark, later)


@register("fact_full", f"WITH {O.silver_ctes(O.r_cte() + ', r2 AS (' + O.ingest_select('r') + ')', 'r2')}, "
                       f"{O.dims_ctes()}, {O.match_ctes('min')} {O.fact_select()}")
def q_fact_full(spark, sf):
    """End to end: CSV files in three header layouts -> bronze -> silver -> dimensions -> fact."""
    bronze = ingest_csv(spark, _write_dirty_csv(spark, sf))
    return Md.gold(spark, Md.silver(bronze))["fact"]
