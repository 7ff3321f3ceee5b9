import pytest
from pyspark.sql import functions as F

from conftest import one_col
from regstar.functions import classify as C
from regstar.operators import repair as Rp
from regstar.operators.clean import CleanOptions, clean_registrations


def repair(spark, office, frm, to):
    df = spark.createDataFrame([(office, frm, to)], "OfficeCd string, fromdate string, todate string")
    return tuple(Rp.repair_columns(df).first())


def test_swap(spark):
    # office holds a date, from-date holds an office code
    assert repair(spark, "01/02/2023", "TS09", "x") == ("TS09", "01/02/2023", None)


def test_shift_sets_both_dates_to_todate(spark):
    # K8: the shifted row's to-date is kept and also becomes the from-date
    assert repair(spark, None, "NIRMAL", "01/02/2023") == ("NIRMAL", "01/02/2023", "01/02/2023")


def test_month_name_counts_as_shift(spark):
    # K7: three letters anywhere in the from-date
    assert repair(spark, "TS09", "01-JAN-23", "01/02/2023")[0] == "01-JAN-23"


def test_no_repair(spark):
    assert repair(spark, "TS09", "01/02/2023", None) == ("TS09", "01/02/2023", None)


def test_backfill(spark):
    df = spark.createDataFrame([(None, "TS09X1"), ("", "TG123ABC"), ("NULL", "AP12"), ("TS01", "TS09")],
                               "o string, k string")
    got = [r[0] for r in df.select(Rp.backfill_office(F.col("o"), F.col("k"))).collect()]
    assert got == ["TS09", "TG123", "", "TS01"]


@pytest.mark.parametrize("name,code", [
    ("rta warangal", "TS08"),
    ("RTA WARANGAL RURAL", "TS09"),
    ("RAMAGUNDAM", "TS07"),
    ("UNIT OFFICE RAMAGUNDAM", "UNIT OFFICE RAMAGUNDAM"),  # vetoed by "UNIT", kept as is
    ("HYDERABAD-SZ", "TS22"),                                # K11: data as given
    ("KODAD", "TS129"),
    ("TS09", "TS09"),
    (None, None),
])
def test_office_name_map(spark, name, code):
    assert [r[0] for r in one_col(spark, [name]).select(C.map_office_name(F.col("v"))).collect()] == [code]


@pytest.mark.parametrize("code,std", [
    ("TS009", "TS19"), ("tg013", "TS23"),  # K27: old codes map forward
    ("TS001", "TS01"), ("TG001", "TG01"),  # K10: TG kept by the source's rule
    ("TG014", "TG14"), ("TS031", "TS31"),
    ("TG05", "TS05"), ("TS129", "TS129"), (" ts09 ", "TS09"),
])
def test_standardize_code(spark, code, std):
    assert [r[0] for r in one_col(spark, [code]).select(C.standardize_code(F.col("v"))).collect()] == [std]


@pytest.mark.parametrize("fuel,model,expected", [
    ("PETROL+CNG", "x", "PETROL"),  # PETROL is tested before CNG
    ("Petrol/Battery", "x", "HYBRID"),
    ("battery petrol", "x", "HYBRID"),
    ("BATTERY", "x", "ELECTRIC"),
    ("diesel", "x", "DIESEL"),
    (None, "ashok tipper", "DIESEL"),
    (None, "x trailor", "UNKNOWN"),  # K30: "trailor" is not in the fuel rule
    ("", "tanker", "UNKNOWN"),
    ("NA", "x", "UNKNOWN"),
])
def test_fuel(spark, fuel, model, expected):
    df = spark.createDataFrame([(fuel, model)], "f string, m string")
    assert df.select(C.classify_fuel(F.col("f"), F.col("m"))).first()[0] == expected


def test_ownership_and_transport(spark):
    df = spark.createDataFrame([(" yes ", "Non-Transport", "BUS"), ("N", None, "MAXI TAXI"), (None, "x", "LMV")],
                               "s string, c string, v string")
    got = [tuple(r) for r in df.select(C.classify_ownership(F.col("s")),
                                       C.classify_transport(F.col("c"), F.col("v"))).collect()]
    assert got == [("PRE_OWNED", "NON_TRANSPORT"), ("NEW", "TRANSPORT"), ("NEW", "NON_TRANSPORT")]


BRONZE = ("slno string, modelDesc string, makerName string, OfficeCd string, tempRegistrationNumber string, "
          "fromdate string, todate string, fuel string, colour string, vehicleClass string, makeYear string, "
          "seatCapacity string, category string, secondVehicle string")


def test_truncation_before_repair_and_option(spark):
    # K6: "RTA WARANGAL" in the from-date is cut to "RTA WARANG" before the shift repair
    row = ("1", "x", "m", None, "TS09X1", "RTA WARANGAL", "01/02/2023", None, None, None, None, None, None, None)
    df = spark.createDataFrame([row], BRONZE)
    assert clean_registrations(df).first()["OfficeCd"] == "RTA WARANG"
    fixed = clean_registrations(df, CleanOptions(truncate_date_like_only=True)).first()
    assert fixed["OfficeCd"] == "TS08" and fixed["OfficeCd_STD"] == "TS08"


def test_backfill_order_option(spark):
    # K28: an office holding a maker word is rejected after the back-fill, so it stays NULL
    row = ("1", "x", "m", "HERO MOTORS", "TS09X1", "01/02/2023", None, None, None, None, None, None, None, None)
    df = spark.createDataFrame([row], BRONZE)
    assert clean_registrations(df).first()["OfficeCd"] is None
    assert clean_registrations(df, CleanOptions(backfill_last=True)).first()["OfficeCd"] == "TS09"
