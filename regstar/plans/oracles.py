"""Reference SQL (DuckDB dialect) for every registered query.

This is an independent second implementation used only for checking: the
Spark side is built from DataFrame operators, this side from plain SQL over
the same parquet tables. Dialect differences handled here:

* DuckDB's ``regexp_replace`` replaces the first match unless given 'g';
  back-references are ``\\1`` instead of ``$1``.
* DuckDB's ``strptime`` is lenient about digit counts; Spark's ``dd``/``MM``
  need two digits and ``yyyy`` four, so every format is guarded by a regex on
  the text's shape. Two-digit years are rebuilt as 20yy (Spark's base 2000).
* ``row_number``, ``year`` and ``levenshtein`` give BIGINT in DuckDB; cast to
  match Spark's INT.
"""

from __future__ import annotations

from regstar.domain import registrations as R
from regstar.sources.fixtures import dirty_registrations_sql_for


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def rx(col: str, pattern: str) -> str:
    return f"regexp_matches({col}, {q(pattern)})"


def rr(col: str, pattern: str, rep: str) -> str:
    return f"regexp_replace({col}, {q(pattern)}, {q(rep)}, 'g')"


def sql_collapse(c: str) -> str:
    return f"trim({rr(c, r'\s+', ' ')})"


def sql_null_if(c: str, pattern: str) -> str:
    return f"CASE WHEN {rx(c, pattern)} THEN NULL ELSE {c} END"


def sql_strip_business(c: str) -> str:
    return (f"CASE WHEN {rx(c, R.BUSINESS_WORDS)} THEN trim({rr(c, R.BUSINESS_WORDS, '')}) "
            f"WHEN {rx(c, R.DIGITS_ONLY)} OR {rx(c, R.NO_ALNUM)} THEN {q(R.UNKNOWN_MANUFACTURER)} ELSE {c} END")


def sql_truncate(c: str, n: int = 10) -> str:
    return f"CASE WHEN length({c}) > {n} THEN substring({c}, 1, {n}) ELSE {c} END"


def sql_reg_key(c: str) -> str:
    return rr(f"upper(trim({c}))", R.REG_KEY_PREFIX, r"\1")


def sql_floor_text(c: str) -> str:
    return f"CAST(CAST(floor(TRY_CAST({c} AS DOUBLE)) AS BIGINT) AS VARCHAR)"


def sql_clean_maker(c: str) -> str:
    tidy = f"upper({rr(rr(c, r'\s+', ' '), r'[.,]+$', '')})"
    return (f"CASE WHEN {rx(c, R.MAKER_JUNK)} OR {c} = '' OR {c} IS NULL "
            f"THEN {q(R.UNKNOWN_MANUFACTURER)} ELSE {tidy} END")


def sql_is_swapped(o: str, f: str) -> str:
    return f"({rx(f'trim({o})', R.DATE_LIKE)} AND {rx(f'upper(trim({f}))', R.OFFICE_CODE_LIKE)})"


def sql_is_shifted(o: str, f: str, t: str) -> str:
    free = f"({rx(f'trim({o})', R.OFFICE_CODE_LIKE)} OR {o} IS NULL OR trim({o}) = '')"
    return f"({free} AND {rx(f'trim({f})', R.HAS_WORD)} AND {rx(f'trim({t})', R.DATE_LIKE)})"


def sql_backfill(o: str, key: str) -> str:
    return (f"CASE WHEN {o} IS NULL OR trim({o}) = '' OR {o} = 'NULL' "
            f"THEN regexp_extract({key}, {q(R.OFFICE_FROM_KEY)}, 0) ELSE {o} END")


def sql_model_clean(c: str) -> str:
    return f"trim({rr(f"coalesce({c}, '')", R.MODEL_KEEP_CHARS, ' ')})"


def sql_tokens(clean: str) -> str:
    stripped = rr(f"upper({clean})", R.model_stop_words_pattern(), "")
    collapsed = rr(f"trim({stripped})", r"\s+", " ")
    return f"list_filter(string_split({collapsed}, ' '), lambda x: x <> '')"


def sql_canonical(tokens: str) -> str:
    head = f"upper(array_to_string(list_slice({tokens}, 1, 2), ' '))"
    return f"trim({rr(head, r'[^A-Z0-9\s]', '')})"


def sql_variant(clean: str, canonical: str, trailer: str) -> str:
    rest = f"trim(replace(upper({clean}), {canonical}, ''))"
    rest = f"(CASE WHEN {trailer} THEN {q(R.TRAILER_VARIANT)} ELSE {rest} END)"
    return f"CASE WHEN {rest} = '' OR {rest} IS NULL THEN {q(R.UNKNOWN)} ELSE {rest} END"


_DATE_GUARDS = {
    "dd/MM/yyyy": (r"\d{2}/\d{2}/\d{4}", "%d/%m/%Y", None),
    "d/M/yyyy": (r"\d{1,2}/\d{1,2}/\d{4}", "%d/%m/%Y", None),
    "yyyy/MM/dd": (r"\d{4}/\d{2}/\d{2}", "%Y/%m/%d", None),
    "MM/dd/yyyy": (r"\d{2}/\d{2}/\d{4}", "%m/%d/%Y", None),
    "M/d/yyyy": (r"\d{1,2}/\d{1,2}/\d{4}", "%m/%d/%Y", None),
    "yyyyMMdd": (r"\d{8}", "%Y%m%d", None),
    "dd/MM/yy": (r"\d{2}/\d{2}/\d{2}", "%d/%m/%Y", "yy"),
    "MM/dd/yy": (r"\d{2}/\d{2}/\d{2}", "%m/%d/%Y", "yy"),
}


def sql_parse_date(c: str, formats=R.DATE_FORMATS) -> str:
    n = rr(f"trim(CAST({c} AS VARCHAR))", R.DATE_SEPARATORS, "/")
    parts = []
    for f in formats:
        guard, fmt, kind = _DATE_GUARDS[f]
        text = f"(substring({n}, 1, 6) || '20' || substring({n}, 7, 2))" if kind == "yy" else n
        parts.append(f"CASE WHEN regexp_full_match({n}, {q(guard)}) THEN CAST(try_strptime({text}, {q(fmt)}) AS DATE) END")
    d = "coalesce(" + ", ".join(parts) + ")"
    return f"(CASE WHEN year({d}) < 100 THEN CAST({d} + INTERVAL 2000 YEAR AS DATE) ELSE {d} END)"


def sql_fuel(fuel: str, model: str) -> str:
    whens = " ".join(f"WHEN {rx(fuel, p)} THEN {q(label)}" for p, label in R.FUEL_RULES)
    return (f"CASE {whens} WHEN {fuel} IS NULL AND {rx(f'lower({model})', R.TRAILER_FUEL_WORDS)} "
            f"THEN 'DIESEL' ELSE {q(R.UNKNOWN)} END")


def sql_make_year(my: str, model: str) -> str:
    year = lambda text: f"list_extract(regexp_extract_all({text}, {q(R.YEAR_IN_TEXT)}), 1)"
    text = f"CASE WHEN regexp_full_match(coalesce({my}, ''), ' *(unknown)? *', 'i') THEN {year(model)} ELSE {my} END"
    return (f"(SELECT CASE WHEN regexp_matches(t, {q(R.YEAR_IN_TEXT)}) THEN {year('t')} "
            f"WHEN regexp_full_match(t, '[^0-9]*[0-9][^0-9]*[0-9][^0-9]*') THEN '20' || array_to_string(regexp_extract_all(t, '[0-9]'), '') END "
            f"FROM (SELECT {text} AS t))")


def sql_ownership(c: str) -> str:
    vals = ", ".join(q(v) for v in R.SECOND_VEHICLE_YES)
    return f"CASE WHEN lower(trim(coalesce({c}, ''))) IN ({vals}) THEN 'PRE_OWNED' ELSE 'NEW' END"


def sql_transport(cat: str, cls: str) -> str:
    lc = f"lower(trim({cat}))"
    return (f"CASE WHEN {rx(lc, R.NON_TRANSPORT_CATEGORY)} THEN 'NON_TRANSPORT' "
            f"WHEN {rx(lc, R.TRANSPORT_CATEGORY)} THEN 'TRANSPORT' "
            f"WHEN {rx(cls, R.TRANSPORT_CLASS)} THEN 'TRANSPORT' ELSE 'NON_TRANSPORT' END")


def sql_office_name(c: str) -> str:
    u = f"upper(trim({c}))"
    whens = []
    for rule in R.OFFICE_NAME_RULES:
        kind, arg, code = rule[0], rule[1], rule[2]
        cond = f"contains({u}, {q(arg)})" if kind == "contains" else f"{u} = {q(arg)}"
        if len(rule) > 3:
            cond = f"({cond} AND NOT contains({u}, {q(rule[3])}))"
        whens.append(f"WHEN {cond} THEN {q(code)}")
    return f"CASE {' '.join(whens)} ELSE {c} END"


def _pg_rep(rep: str) -> str:
    return rep.replace("$1", "\\1")


def sql_code_std(c: str) -> str:
    u = f"upper(trim({c}))"
    whens = []
    for pattern, result in R.OFFICE_CODE_RULES:
        val = rr(u, result[1], _pg_rep(result[2])) if isinstance(result, tuple) else q(result)
        whens.append(f"WHEN {rx(u, pattern)} THEN {val}")
    d = R.OFFICE_CODE_DEFAULT
    return f"CASE {' '.join(whens)} ELSE {rr(u, d[1], _pg_rep(d[2]))} END"


def sql_normalize(c: str) -> str:
    return rr(f"lower(trim({c}))", "[^a-z0-9]", "")


# --- composed CTEs ------------------------------------------------------------------

def r_cte() -> str:
    return f"r AS ({dirty_registrations_sql_for('orders', 'part')})"


def clean_ctes(src: str = "r") -> str:
    """CTEs c1..c9 turning ``src`` (bronze columns) into the cleaned rows ``clean``."""
    trims = ", ".join(f"trim(CAST({c} AS VARCHAR)) AS {c}" for c in R.TRIMMED_COLUMNS)
    return f"""
c1 AS (SELECT * REPLACE ({sql_collapse('makerName')} AS makerName, {sql_collapse('modelDesc')} AS modelDesc) FROM {src}),
c2 AS (SELECT * REPLACE ({sql_strip_business('makerName')} AS makerName, {sql_null_if('OfficeCd', R.OFFICE_PLACEHOLDER)} AS OfficeCd) FROM c1),
c3 AS (SELECT * REPLACE ({sql_truncate('fromdate')} AS fromdate, {sql_truncate('todate')} AS todate,
        {sql_reg_key('tempRegistrationNumber')} AS tempRegistrationNumber, {sql_floor_text('seatCapacity')} AS seatCapacity) FROM c2),
c4 AS (SELECT * REPLACE ({trims}) FROM c3),
c5 AS (SELECT * REPLACE ({sql_clean_maker('makerName')} AS makerName) FROM c4),
c5f AS (SELECT *, {sql_is_shifted('OfficeCd', 'fromdate', 'todate')} AS _sh, {sql_is_swapped('OfficeCd', 'fromdate')} AS _sw FROM c5),
c6 AS (SELECT * EXCLUDE (_sh, _sw) REPLACE (
        CASE WHEN _sh OR _sw THEN trim(fromdate) ELSE OfficeCd END AS OfficeCd,
        CASE WHEN _sh THEN todate WHEN _sw THEN OfficeCd ELSE fromdate END AS fromdate,
        CASE WHEN _sh THEN todate WHEN _sw THEN NULL ELSE todate END AS todate) FROM c5f),
c7 AS (SELECT * REPLACE ({sql_backfill('OfficeCd', 'tempRegistrationNumber')} AS OfficeCd) FROM c6),
c8 AS (SELECT * REPLACE ({sql_null_if('OfficeCd', R.MAKER_IN_OFFICE)} AS OfficeCd),
        CASE WHEN {rx('lower(trim(fromdate))', R.OFFICE_IN_DATE)} THEN NULL ELSE fromdate END AS fromdate_preclean,
        CASE WHEN {rx('lower(trim(todate))', R.OFFICE_IN_DATE)} THEN NULL ELSE todate END AS todate_preclean,
        {sql_model_clean('modelDesc')} AS _mc FROM c7),
c9 AS (SELECT *, {rx('lower(_mc)', R.TRAILER_WORDS)} AS isTrailer, {rx('lower(_mc)', R.ELECTRIC_WORDS)} AS isElectric,
        {sql_canonical(sql_tokens('_mc'))} AS modelName_canonical FROM c8),
c10 AS (SELECT *, {sql_variant('_mc', 'modelName_canonical', 'isTrailer')} AS variant,
        {sql_parse_date('fromdate_preclean')} AS fromdate_parsed, {sql_parse_date('todate_preclean')} AS todate_parsed FROM c9),
c11 AS (SELECT *, coalesce(fromdate_parsed, todate_parsed, DATE '1900-01-01') AS _eff FROM c10),
clean AS (SELECT slno, modelDesc, makerName, {sql_office_name('OfficeCd')} AS OfficeCd, tempRegistrationNumber,
        fromdate, todate, fuel, colour, vehicleClass, {sql_make_year('makeYear', 'modelDesc')} AS makeYear,
        seatCapacity, category, secondVehicle, fromdate_preclean, todate_preclean, isTrailer, isElectric,
        modelName_canonical, variant, fromdate_parsed, todate_parsed,
        CAST(year(_eff) AS INTEGER) AS REGISTRATION_YEAR, CAST(month(_eff) AS INTEGER) AS REGISTRATION_MONTH,
        CAST(year(_eff) * 10000 + month(_eff) * 100 + day(_eff) AS INTEGER) AS REGISTRATION_DATE_ID,
        {sql_fuel('fuel', 'modelDesc')} AS fuel_clean, {sql_ownership('secondVehicle')} AS OWNERSHIP_TYPE,
        {sql_transport('category', 'vehicleClass')} AS TRANSPORT_TYPE FROM c11),
clean2 AS (SELECT *, {sql_code_std('OfficeCd')} AS OfficeCd_STD FROM clean)"""


def silver_ctes(prelude: str | None = None, source: str = "r") -> str:
    """r -> clean -> keep latest per registration -> expectation = ``silver``.

    ``prelude`` replaces the CTE list that defines ``source`` (default: view R).
    """
    return f"""{prelude or r_cte()},
{clean_ctes(source)},
latest AS (SELECT * EXCLUDE (_rn) FROM (SELECT *, row_number() OVER (PARTITION BY tempRegistrationNumber
        ORDER BY coalesce(fromdate_parsed, todate_parsed) DESC NULLS LAST, TRY_CAST(slno AS BIGINT) DESC NULLS LAST) AS _rn
        FROM clean2) WHERE _rn = 1),
silver AS (SELECT * FROM latest WHERE coalesce(tempRegistrationNumber IS NOT NULL AND length(trim(tempRegistrationNumber)) > 3, false))"""


def dims_ctes() -> str:
    """silver -> dim_manufacturer, dim_vehicle, dim_office."""
    model = rr(rr("upper(trim(modelName_canonical))", "[^A-Z0-9]", " "), r"\s+", " ")
    variant = rr(rr("upper(trim(variant))", "[^A-Z0-9]", ""), R.VARIANT_SUFFIX, "")
    fuel_ph = ", ".join(q(v) for v in R.FUEL_PLACEHOLDERS)
    col_ph = ", ".join(q(v) for v in R.COLOUR_PLACEHOLDERS)
    master = ", ".join(f"({q(c)}, {q(n)})" for c, n in R.OFFICE_MASTER)
    return f"""
dim_manufacturer AS (
  SELECT MANUFACTURER_NAME, 'M' || CAST(row_number() OVER (ORDER BY MANUFACTURER_NAME NULLS FIRST) AS VARCHAR) AS MANUFACTURER_KEY
  FROM (SELECT DISTINCT makerName AS MANUFACTURER_NAME FROM silver
        WHERE makerName IS NOT NULL AND makerName <> {q(R.UNKNOWN_MANUFACTURER)})
  UNION ALL SELECT {q(R.UNKNOWN_MANUFACTURER)}, '-1'),
vehicle_norm AS (
  SELECT {model} AS MODEL_NAME, {variant} AS VARIANT,
    CASE WHEN fuel IN ({fuel_ph}) THEN 'UNKNOWN' ELSE upper(trim(fuel)) END AS FUEL,
    CASE WHEN colour IN ({col_ph}) THEN 'UNKNOWN' ELSE upper(trim(colour)) END AS COLOUR,
    upper(trim(vehicleClass)) AS VEHICLE_CLASS FROM silver),
dim_vehicle AS (
  SELECT MODEL_NAME, VARIANT, FUEL, COLOUR, VEHICLE_CLASS,
    CAST(row_number() OVER (ORDER BY MODEL_NAME NULLS FIRST, VARIANT NULLS FIRST, FUEL NULLS FIRST) AS INTEGER) AS VEHICLE_KEY
  FROM (SELECT MODEL_NAME, VARIANT, FUEL, COLOUR, VEHICLE_CLASS, row_number() OVER (
          PARTITION BY MODEL_NAME, VARIANT, FUEL ORDER BY COLOUR NULLS FIRST, VEHICLE_CLASS NULLS FIRST) AS _rn
        FROM vehicle_norm WHERE MODEL_NAME IS NOT NULL AND VARIANT IS NOT NULL AND trim(MODEL_NAME) <> '') WHERE _rn = 1
  UNION ALL SELECT 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', 'UNKNOWN', -1),
office_master(MAP_CODE, DISTRICT_NAME) AS (VALUES {master}),
dim_office AS (
  SELECT RTA_OFFICE_CODE, RTA_NAME, 'R' || CAST(row_number() OVER (ORDER BY RTA_NAME NULLS FIRST) AS VARCHAR) AS RTA_ID
  FROM (SELECT min(c.RTA_CODE) AS RTA_OFFICE_CODE, m.DISTRICT_NAME AS RTA_NAME
        FROM (SELECT DISTINCT OfficeCd_STD AS RTA_CODE FROM silver) c JOIN office_master m ON c.RTA_CODE = m.MAP_CODE
        GROUP BY m.DISTRICT_NAME)
  UNION ALL SELECT {q(R.UNKNOWN_OFFICE_CODE)}, {q(R.UNKNOWN_RTA_NAME)}, {q(R.UNKNOWN)})"""


def match_ctes(exact_multi: str = "min") -> str:
    """silver + dim_vehicle -> per-registration resolution ``resolved``."""
    k = R.LEVENSHTEIN_BOUND
    b = R.BLOCK_LENGTH
    exact_pick = ("SELECT KEY2, min(VEHICLE_KEY) AS VEHICLE_KEY FROM dkeys GROUP BY KEY2"
                  if exact_multi == "min" else "SELECT KEY2, VEHICLE_KEY FROM dkeys")
    return f"""
stg AS (SELECT tempRegistrationNumber, concat_ws(' ', {sql_normalize('modelName_canonical')}, {sql_normalize('variant')}) AS KEY,
        substring({sql_normalize('modelName_canonical')}, 1, {b}) AS BLOCK FROM silver),
dkeys AS (SELECT VEHICLE_KEY, concat_ws(' ', {sql_normalize('MODEL_NAME')}, {sql_normalize('VARIANT')}) AS KEY2,
        substring({sql_normalize('MODEL_NAME')}, 1, {b}) AS BLOCK2 FROM dim_vehicle),
exact AS (SELECT s.tempRegistrationNumber, d.VEHICLE_KEY, 'EXACT' AS MATCH_STATUS
        FROM stg s JOIN ({exact_pick}) d ON s.KEY = d.KEY2),
unresolved AS (SELECT * FROM stg WHERE tempRegistrationNumber NOT IN (SELECT tempRegistrationNumber FROM exact)),
candidates AS (SELECT u.tempRegistrationNumber, u.KEY, d.KEY2, d.VEHICLE_KEY, CAST(levenshtein(u.KEY, d.KEY2) AS INTEGER) AS LEV
        FROM unresolved u JOIN dkeys d ON u.BLOCK = d.BLOCK2 AND abs(length(u.KEY) - length(d.KEY2)) <= {k}),
fuzzy AS (SELECT tempRegistrationNumber, VEHICLE_KEY, 'FUZZY' AS MATCH_STATUS FROM (
        SELECT *, row_number() OVER (PARTITION BY tempRegistrationNumber ORDER BY LEV, VEHICLE_KEY) AS _rn
        FROM candidates WHERE LEV <= {k}) WHERE _rn = 1),
unmatched AS (SELECT tempRegistrationNumber, -1 AS VEHICLE_KEY, 'UNMATCHED' AS MATCH_STATUS FROM unresolved
        WHERE tempRegistrationNumber NOT IN (SELECT tempRegistrationNumber FROM fuzzy)),
resolved AS (SELECT tempRegistrationNumber, CAST(VEHICLE_KEY AS INTEGER) AS VEHICLE_KEY, MATCH_STATUS FROM exact
        UNION ALL SELECT tempRegistrationNumber, CAST(VEHICLE_KEY AS INTEGER), MATCH_STATUS FROM fuzzy
        UNION ALL SELECT tempRegistrationNumber, CAST(VEHICLE_KEY AS INTEGER), MATCH_STATUS FROM unmatched)"""


def fact_select() -> str:
    return """
SELECT s.tempRegistrationNumber AS TEMP_REGISTRATION_NUMBER,
  CAST(coalesce(r.VEHICLE_KEY, -1) AS INTEGER) AS VEHICLE_KEY, coalesce(o.RTA_ID, 'UNKNOWN') AS RTA_ID,
  coalesce(m.MANUFACTURER_KEY, '-1') AS MANUFACTURER_KEY, s.REGISTRATION_DATE_ID, s.REGISTRATION_YEAR, s.REGISTRATION_MONTH,
  s.makeYear, s.seatCapacity AS SEAT_CAPACITY, s.category AS CATEGORY, s.fuel_clean AS FUEL, s.OWNERSHIP_TYPE,
  s.TRANSPORT_TYPE, s.OfficeCd_STD AS RTA_OFFICE_CODE, coalesce(o.RTA_NAME, 'UNKNOWN') AS RTA_NAME,
  coalesce(r.MATCH_STATUS, 'UNMATCHED') AS MATCH_STATUS
FROM silver s LEFT JOIN resolved r ON s.tempRegistrationNumber = r.tempRegistrationNumber
  LEFT JOIN dim_office o ON s.OfficeCd_STD = o.RTA_OFFICE_CODE
  LEFT JOIN dim_manufacturer m ON s.makerName = m.MANUFACTURER_NAME"""


def ingest_select(src: str = "r") -> str:
    """View R as it reads back from the CSV layouts: empty text is NULL; layout 2 has no colour."""
    cols = []
    for x in R.GOLDEN_COLUMNS:
        if x == "colour":
            cols.append("CASE WHEN CAST(slno AS BIGINT) % 3 = 2 OR colour = '' THEN NULL ELSE colour END AS colour")
        else:
            cols.append(f"CASE WHEN {x} = '' THEN NULL ELSE {x} END AS {x}")
    return f"SELECT {', '.join(cols)} FROM {src}"
