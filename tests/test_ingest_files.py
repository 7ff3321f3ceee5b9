"""Files that ingest must not lose: odd names, odd headers, compression."""

import gzip
import os

import pytest

from regstar.sources.csv_ingest import ingest_csv


def write(folder, name, data: bytes):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(gzip.compress(data) if name.endswith(".gz") else data)


FILES = {
    "plain.csv": b"RegNo,fuel\nA1,PETROL\n",
    "blank-first.csv": b"\n  \n\nRegNo,fuel\nA2,CNG\n",
    "UPPER.CSV": b"RegNo,fuel\r\nA3,LPG\r\n",
    "packed.csv.gz": b"fuel,RegNo\nDIESEL,A4\n",
    "no-suffix": b"RegNo,fuel\nA5,EV\n",
    "odd #1?[x]{y}.txt": b"RegNo,fuel\nA6,X\n",
    "sub dir/deep.csv": b"RegNo,fuel\nA7,Y\n",
    "line-separator.csv": "RegNo,no\u2028te,fuel\nA8,n,Z\n".encode(),
    "bom.csv": "\ufeffRegNo,fuel\nA9,W\n".encode(),
    "long.csv": ("RegNo,fuel," + "x" * 1_500_000 + "\nB1,V,\n").encode(),
    "quoted.csv": b'"RegNo","fuel","two\nlines"\nB2,U,1\n',
    "empty.csv": b"",
}
ROWS = [("A1", "PETROL"), ("A2", "CNG"), ("A3", "LPG"), ("A4", "DIESEL"), ("A5", "EV"), ("A6", "X"), ("A7", "Y"), ("A8", "Z"),
        ("A9", "W"), ("B1", "V"), ("B2", "U")]


def test_no_file_is_lost(spark, tmp_path):
    for name, data in FILES.items():
        write(str(tmp_path), name, data)
    got = sorted((r.tempRegistrationNumber, r.fuel) for r in ingest_csv(spark, str(tmp_path)).collect())
    assert got == ROWS


def test_glob_is_opt_in(spark, tmp_path):
    for name in ("plain.csv", "UPPER.CSV"):
        write(str(tmp_path), name, FILES[name])
    assert ingest_csv(spark, str(tmp_path), glob="*.csv").count() == 1


def test_a_file_without_header_raises(spark, tmp_path):
    write(str(tmp_path), "blank.csv", b"\n \n")
    with pytest.raises(ValueError, match="no header"):
        ingest_csv(spark, str(tmp_path))


def test_job_into_catalog_tables(spark, tmp_path):
    from regstar.plans.medallion import build_tables

    write(str(tmp_path), "a.csv", b"RegNo,fromdate,maker,model_desc\nTS09AB1234,01/02/2020,TATA,NEXON XM\n")
    build_tables(spark, str(tmp_path), schema="regstar_job_test")
    try:
        assert spark.table("regstar_job_test.fact_registrations").count() == 1
        assert spark.table("regstar_job_test.bronze_registrations").count() == 1
    finally:
        spark.sql("DROP SCHEMA regstar_job_test CASCADE")
