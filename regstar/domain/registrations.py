"""Rule tables for dirty vehicle-registration records.

Everything in this module is data. The operators in ``regstar.functions`` and
``regstar.operators`` are generic and take these tables as parameters, so a
different domain only needs a different table module.
"""

from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES. These must equal the source pipeline's values for identical
# results. They are stated as given, in their original order.
# ---------------------------------------------------------------------------

UNKNOWN = "UNKNOWN"
UNKNOWN_MANUFACTURER = "UNKNOWN_MANUFACTURER"
UNKNOWN_RTA_NAME = "Unknown / Unmapped RTA"
UNKNOWN_OFFICE_CODE = "UNK"
TRAILER_VARIANT = "TRAILER/TIPPER/TRACTOR/TANKER"
LEVENSHTEIN_BOUND = 3
BLOCK_LENGTH = 4
DEFAULT_DATE = "1900-01-01"
DATE_DIM_START = "2000-01-01"
DATE_DIM_END = "2030-12-31"

# Lower-cased, stripped source header -> golden column.
HEADER_ALIASES = {
    "slno": "slno", "sl_no": "slno",
    "modeldesc": "modelDesc", "model.description": "modelDesc", "model_desc": "modelDesc",
    "maker": "makerName", "makername": "makerName", "manufacturername": "makerName",
    "manufacturer_name": "makerName", "manufacturer": "makerName",
    "tempregnno": "tempRegistrationNumber", "regnno": "tempRegistrationNumber",
    "regno": "tempRegistrationNumber", "tempregistrationnumber": "tempRegistrationNumber",
    "registration_no": "tempRegistrationNumber", "reg_id": "tempRegistrationNumber",
    "officecode": "OfficeCd", "office_cd": "OfficeCd", "office": "OfficeCd",
    "officecd": "OfficeCd", "officecd.1": "OfficeCd", "office.cd": "OfficeCd",
    "office.code": "OfficeCd",
    "vehicleregndate": "fromdate", "vehregnvaliddate": "todate",
    "from_date": "fromdate", "to_date": "todate", "fromdate": "fromdate", "todate": "todate",
    "regn_date": "fromdate", "regn.date": "fromdate", "regn_to_date": "todate",
    "colour": "colour", "color": "colour",
    "fueltype": "fuel", "fuel_used": "fuel", "fuel": "fuel", "fuel.type": "fuel",
    "vehicleclass": "vehicleClass", "classofveh": "vehicleClass", "vehicle.class": "vehicleClass",
    "seatingcapacity": "seatCapacity", "seat_cap": "seatCapacity",
    "seatcapacity": "seatCapacity", "seat_capacity": "seatCapacity", "seating.capacity": "seatCapacity",
    "makeyear": "makeYear", "make_year": "makeYear", "mfg_year": "makeYear",
    "secondvehicle": "secondVehicle", "issecondvehicle": "secondVehicle", "second.vehicle": "secondVehicle",
    "category": "category", "veh.category": "category",
}

GOLDEN_COLUMNS = [
    "slno", "modelDesc", "makerName", "OfficeCd", "tempRegistrationNumber",
    "fromdate", "todate", "fuel", "colour", "vehicleClass",
    "makeYear", "seatCapacity", "category", "secondVehicle",
]

# Columns trimmed (and cast to string) in the cleaning stage, in order.
TRIMMED_COLUMNS = [
    "modelDesc", "makerName", "OfficeCd", "tempRegistrationNumber",
    "fuel", "colour", "vehicleClass", "category", "fromdate", "todate", "makeYear", "secondVehicle",
]

MAKER_JUNK = r"(?i)\b(TEST|DUMMY|SAMPLE|JUNK|ABCD|XXXX|NA|N/A|NULL|UNKNOWN|NONE)\b"
MAKER_IN_OFFICE = (
    r"(?i)(MOTORS|LTD|PVT|AGENCY|MARUTI|HONDA|HERO|TOYOTA|MAHINDRA|TATA|HYUNDAI|KIA|SUZUKI|FORD|YAMAHA|"
    r"BAJAJ|VOLKSWAGEN|NISSAN|RENAULT|BMW|MERCEDES|AUDI|SKODA|JEEP|MG|ISUZU|FORCE|ASHOK|EICHER|PIAGGIO)"
)
OFFICE_IN_DATE = (
    r"(?i)\b(ADILABAD|NIRMAL|MANCHERIAL|KARIMNAGAR|JAGTIAL|WARANGAL|NALGONDA|HYDERABAD|SECUNDERABAD|MEDAK|"
    r"NIZAMABAD|MAHBUBNAGAR|KHAMMAM|SURYAPET|SIDDIPET|MEDCHAL|RANGAREDDY|SANGAREDDY|KAMAREDDY|NAGARKURNOOL|"
    r"GADWAL|WANAPARTHY|NARAYANPET|VIKARABAD|RTA|OFFICE|TRANSPORT)\b"
)
MODEL_STOP_WORDS = ["LIMITED", "LTD", "PVT", "PRIVATE", "MOTORS", "INDIA", "AUTO", "INTERNATIONAL", "ENTERPRISES", "AGENCY"]
BUSINESS_WORDS = (
    r"(?i)\b(M/S\.?|M\sS|MS|MOTORS?|AGENCIES|SHOWROOM|LTD|LIMITED|PVT|PRIVATE|LLP|WORKS|SERVICE|ENGG|AGRO|"
    r"INDUSTRIES|TRACTORS|ENGINEERING|FRANKLIN\sEV|ESCORTS|PROMOTIONS)\b"
)
OFFICE_PLACEHOLDER = r"(?i)^(ONLINE|NA|OTHERS|N/A|NULL)$"
DIGITS_ONLY = r"^\d+$"
NO_ALNUM = r"^[^a-zA-Z0-9]+$"
DATE_LIKE = r"^\s*(\d{1,2}[/-]\d{1,2}[/-]\d{2,4}|[12]\d{3}[01]\d{1}[0-3]\d{1})\s*$"
OFFICE_CODE_LIKE = r"^(TS|TG)?\d{1,4}$"
HAS_WORD = r"(?i)[A-Z]{3,}"
REG_KEY_PREFIX = r"^(TS|TG|AP)-?"
OFFICE_FROM_KEY = r"^(TS|TG)\d{1,3}"
MODEL_KEEP_CHARS = r"[^A-Za-z0-9\s\+\-\(\)\./]"
TRAILER_WORDS = r"trailer|trailor|tipper|tractor|tanker"
ELECTRIC_WORDS = r"\b(ev|bov|electric|hybrid)\b"
TRAILER_FUEL_WORDS = r"trailer|tipper|tanker|tractor"
YEAR_IN_TEXT = r"(19\d{2}|20\d{2})"
DATE_SEPARATORS = r"[-.\\]"

# Date formats tried in order (day-first before month-first). The source list
# also holds "yyyy-MM-dd", which can never match after '-' becomes '/'.
DATE_FORMATS = ["dd/MM/yyyy", "d/M/yyyy", "yyyy/MM/dd", "MM/dd/yyyy", "M/d/yyyy",
                "yyyyMMdd", "dd/MM/yy", "MM/dd/yy"]

# Fuel classes: (pattern, class), first match wins; then the NULL-fuel trailer
# rule gives DIESEL; anything else is UNKNOWN.
FUEL_RULES = [
    (r"(?i)HYBRID|AHYBRID|((PETROL|CNG|LPG|DIESEL).*(ELECTRIC|BATTERY))|((ELECTRIC|BATTERY).*(PETROL|CNG|LPG|DIESEL))", "HYBRID"),
    (r"(?i)BATTERY|ELECTRIC", "ELECTRIC"),
    (r"(?i)PETROL|GASOLINE", "PETROL"),
    (r"(?i)DIESEL", "DIESEL"),
    (r"(?i)CNG", "CNG"),
    (r"(?i)LPG", "LPG"),
]
SECOND_VEHICLE_YES = ["y", "yes", "1"]
NON_TRANSPORT_CATEGORY = r"(?i)non.*transport"
TRANSPORT_CATEGORY = r"(?i)transport"
TRANSPORT_CLASS = r"(?i)CONTRACT|STAGE|GOODS|BUS|TAXI|AUTORICKSHAW|TRANSPORT"

# Office name -> office code. (kind, argument, code[, unless-contains]);
# kind "contains" or "equals", compared on upper(trim(value)); first match wins,
# no match keeps the value.
OFFICE_NAME_RULES = [
    ("contains", "ADILAB", "TS01"), ("contains", "NIRMAL", "TS02"), ("contains", "MANCHERIAL", "TS03"),
    ("contains", "KARIMNAGAR", "TS04"), ("equals", "RTA JAGITYAL", "TS05"), ("contains", "JAGTIAL", "TS05"),
    ("equals", "RTA PEDDAPALLI", "TS06"), ("contains", "RAMAGUNDAM", "TS07", "UNIT"),
    ("equals", "RTA HANUMAKONDA", "TS08"), ("equals", "RTA WARANGAL", "TS08"), ("equals", "RTA WARANGAL URBAN", "TS08"),
    ("equals", "RTA WARANGAL RURAL", "TS09"), ("contains", "MAHABUBABAD", "TS10"), ("contains", "JANGOAN", "TS11"),
    ("equals", "RTA KHAMMAM", "TS13"), ("contains", "NALGONDA", "TS15"), ("contains", "SURYAPET", "TS16"),
    ("contains", "YADADRI", "TS17"), ("contains", "BHONGIR", "TS17"), ("equals", "RTA HUZURNAGAR", "TS18"),
    ("contains", "MAHABOOBNAGAR", "TS29"), ("contains", "MAHBUBNAGAR", "TS29"), ("contains", "WANAPARTHY", "TS30"),
    ("contains", "NAGARKURNOOL", "TS31"), ("contains", "GADWAL", "TS32"), ("equals", "RTA JOGULAMBA", "TS42"),
    ("contains", "NARAYANPET", "TS33"), ("equals", "RTA MEDAK", "TS34"), ("contains", "SIDDIPET", "TS35"),
    ("equals", "RTA ZAHEERABAD", "TS36"), ("equals", "RTA NIZAMABAD", "TS37"), ("contains", "KAMAREDDY", "TS38"),
    ("contains", "KOMRAMBHEEM", "TS39"), ("contains", "JAYASHANKAR", "TS40"), ("contains", "BHUPALPALLY", "TS40"),
    ("contains", "MULUG", "TS41"), ("contains", "SIRCILLA", "TS43"), ("equals", "RTA RAJANNA", "TS43"),
    ("equals", "RTA VIKARABAD", "TS44"), ("equals", "RTA SANGAREDDY", "TS26"), ("equals", "RTA MEDCHAL", "TS27"),
    ("equals", "RTA BHADRADRI", "TS48"),
    ("contains", "HYDERABAD-CZ", "TS19"), ("contains", "HYDERABAD-NZ", "TS20"),
    ("contains", "HYDERABAD-EZ", "TS21"), ("contains", "HYDERABAD-SZ", "TS22"),
    ("contains", "HYDERABAD-WZ", "TS23"), ("contains", "TRANSPORT OFFICER, HYDERABAD", "TS19"),
    ("equals", "RTA RANGAREDDY", "TS28"),
    ("contains", "KODAD", "TS129"),
]

# Office code standardisation: (regex on upper(trim(code)), result). The result
# is a literal code, or ("replace", pattern, replacement) applied to the value.
# No match: a leading TG becomes TS.
OFFICE_CODE_RULES = [
    (r"^(TS|TG)009$", "TS19"), (r"^(TS|TG)010$", "TS20"),
    (r"^(TS|TG)011$", "TS21"), (r"^(TS|TG)012$", "TS22"),
    (r"^(TS|TG)013$", "TS23"), (r"^(TS|TG)020$", "TS20"),
    (r"^(TS|TG)021$", "TS21"), (r"^(TS|TG)022$", "TS22"),
    (r"^(TS|TG)023$", "TS23"), (r"^(TS|TG)024$", "TS24"),
    (r"^(TS|TG)025$", "TS25"), (r"^(TS|TG)026$", "TS26"),
    (r"^(TS|TG)027$", "TS27"), (r"^(TS|TG)028$", "TS28"),
    (r"^(TS|TG)029$", "TS29"), (r"^(TS|TG)038$", "TS38"),
    (r"^(TS|TG)00[1-8]$", ("replace", "00", "0")),
    (r"^(TS|TG)0[1-9][0-9]$", ("replace", "(TS|TG)0", "$1")),
]
OFFICE_CODE_DEFAULT = ("replace", "^TG", "TS")

# Office master: (code, name), 70 rows.
OFFICE_MASTER = [
    ("TS01", "Adilabad"), ("TS02", "Nirmal"), ("TS03", "Mancherial"), ("TS04", "Karimnagar"),
    ("TS05", "Jagtial"), ("TS06", "Peddapalli"), ("TS07", "Ramagundam (Godavarikhani)"),
    ("TS08", "Warangal Urban (Hanamkonda)"), ("TS09", "Warangal Rural (Parkal)"),
    ("TS10", "Mahabubabad"), ("TS11", "Jangaon"), ("TS12", "Kothagudem"), ("TS13", "Khammam"),
    ("TS14", "Khammam (Wyra)"), ("TS15", "Nalgonda"), ("TS16", "Suryapet"),
    ("TS17", "Bhongir / Yadadri Bhuvanagiri"), ("TS18", "Huzurnagar"),
    ("TS19", "Hyderabad Central"), ("TS20", "Hyderabad North"), ("TS21", "Hyderabad East"),
    ("TS22", "Hyderabad West"), ("TS23", "Hyderabad South"), ("TS24", "Hyderabad Secunderabad"),
    ("TS25", "Ranga Reddy (Vikarabad)"), ("TS26", "Ranga Reddy (Sanga Reddy)"),
    ("TS27", "Ranga Reddy (Medchal)"), ("TS28", "Ranga Reddy (Balanagar)"),
    ("TS29", "Mahbubnagar"), ("TS30", "Wanaparthy"), ("TS31", "Nagarkurnool"),
    ("TS32", "Gadwal"), ("TS33", "Narayanpet"), ("TS34", "Medak"), ("TS35", "Siddipet"),
    ("TS36", "Zaheerabad"), ("TS37", "Nizamabad"), ("TS38", "Kamareddy"),
    ("TS39", "Komaram Bheem (Asifabad)"), ("TS40", "Jayashankar Bhupalpally"),
    ("TS41", "Mulugu"), ("TS42", "Jogulamba Gadwal"), ("TS43", "Rajanna Sircilla"),
    ("TS44", "Vikarabad"), ("TS45", "Sanga Reddy (Patancheru)"),
    ("TS46", "Shameerpet (Medchal-Malkajgiri)"), ("TS47", "Cherial (Siddipet)"),
    ("TS48", "Bhadradri Kothagudem"), ("TS49", "Warangal (Parvathagiri)"),
    ("TS50", "Peddapalli (Sulthanabad)"), ("TS51", "Nizamabad (Bodhan)"),
    ("TS102", "Unit Office Huzurabad"), ("TS107", "RTA Ibrahimpatnam"),
    ("TS108", "RTA Uppal"), ("TS116", "Unit Office Armoor"),
    ("TS121", "Unit Office Korutla"), ("TS122", "Unit Office Ramagundam"),
    ("TS128", "Unit Office Bhadrachalam"), ("TS129", "Unit Office Kodad"),
    ("TS131", "Unit Office Kalwakurthy"), ("TS132", "Unit Office Pebbair"),
    ("TS134", "Unit Office Pargi"), ("TS207", "Unit Office Shadnagar"),
    ("TS208", "Unit Office Kukatpally"), ("TS215", "Unit Office Zahirabad"),
    ("TS216", "Unit Office Bhodan"), ("TS304", "Unit Office Sattupalli"),
    ("TS305", "Unit Office Miryalaguda"), ("TS404", "Unit Office Wyra"),
    ("TS415", "Unit Office Patancheruvu"),
]

# Vehicle dimension normalisation.
VARIANT_SUFFIX = r"(?:PLUS|\+|O|OPT|OPTIONAL)$"
FUEL_PLACEHOLDERS = ["", "NA", "N/A"]
COLOUR_PLACEHOLDERS = ["", "NA"]

# Simpler star schema (the unit-test gold layer): junk filter on dimension names.
SIMPLE_JUNK = "(?i)NA|N/A|NULL|NONE|JUNK"

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------


def model_stop_words_pattern() -> str:
    """Word-bounded alternation of the model stop words, any case."""
    return r"(?i)\b(" + "|".join(MODEL_STOP_WORDS) + r")\b"
