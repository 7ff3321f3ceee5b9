import datetime as dt

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import one_col
from regstar.domain import registrations as R
from regstar.functions import dates as D


def parse(spark, values):
    return [r[0] for r in one_col(spark, values).select(D.parse_dates_fixed(F.col("v"))).collect()]


@pytest.mark.parametrize("text,expected", [
    ("02/03/2023", dt.date(2023, 3, 2)),    # K4: ambiguous -> day first
    ("03/25/2023", dt.date(2023, 3, 25)),   # month first only when day > 12
    ("2-3-2023", dt.date(2023, 3, 2)),
    ("2023-03-02", dt.date(2023, 3, 2)),
    ("2023.03.02", dt.date(2023, 3, 2)),
    ("20230302", dt.date(2023, 3, 2)),
    ("02/03/23", dt.date(2023, 3, 2)),
    ("01/02/0023", dt.date(2023, 2, 1)),    # K5: four-digit year below 100 is moved
    ("01/02/75", dt.date(2075, 2, 1)),      # two-digit years are 20yy
    ("31/02/2023", None),
    ("garbage", None),
    ("01-JAN-23", None),
    (None, None),
])
def test_parse_dates(spark, text, expected):
    assert parse(spark, [text]) == [expected]


def test_shape_guard_shapes():
    assert D.shape_guard("dd/MM/yyyy") == r"^\+?\d{2}/\+?\d{2}/\+?\d{4,}$"
    assert D.shape_guard("d/M/yyyy") == r"^\+?\d+/\+?\d+/\+?\d{4,}$"
    assert D.shape_guard("dd-MMM-yyyy") is None


texts = st.text(alphabet="0123456789/+ ", min_size=1, max_size=12)


@settings(max_examples=25, deadline=None)
@given(st.lists(texts, min_size=1, max_size=40))
def test_guarded_parse_equals_unguarded(spark, values):
    """The shape guard only skips texts the parser would reject."""
    df = one_col(spark, values)
    norm = D.normalize_date_text(F.col("v"))
    plain = F.coalesce(*[F.try_to_date(norm, f) for f in R.DATE_FORMATS])
    got = df.select(D.parse_normalized(norm).alias("g"), plain.alias("p")).collect()
    assert [r.g for r in got] == [r.p for r in got]


def test_effective_date_default(spark):
    df = spark.createDataFrame([(None, None)], "a date, b date")
    eff = D.effective_date(F.col("a"), F.col("b"))
    assert df.select(D.date_id(eff)).first()[0] == 19000101
