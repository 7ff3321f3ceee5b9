import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from regstar.operators.dedup import distinct_on, keep_latest_by
from regstar.operators.keys import dense_key
from regstar.operators.quality import expect, expect_or_drop, expectation_counts


def test_keep_latest_methods_agree(spark):
    rnd = random.Random(7)
    data = [(rnd.choice(["a", "b", None, "c"]), rnd.choice([None, 1, 2, 3]), i) for i in range(300)]
    df = spark.createDataFrame(data, "k string, d int, s int")
    w = sorted((tuple(r) for r in keep_latest_by(df, ["k"], [F.col("d"), F.col("s")], "window").collect()), key=repr)
    a = sorted((tuple(r) for r in keep_latest_by(df, ["k"], [F.col("d"), F.col("s")], "aggregate").collect()), key=repr)
    assert w == a
    # brute force: largest d (NULL lowest), then largest s
    best = {}
    for k, d, s in data:
        key = (d is not None, d or 0, s)
        if k not in best or key > best[k][0]:
            best[k] = (key, (k, d, s))
    assert w == sorted((v[1] for v in best.values()), key=repr)


def test_distinct_on_is_deterministic(spark):
    df = spark.createDataFrame([("x", "b", 2), ("x", "a", 9), ("y", None, 1), ("y", "c", 0)], "k string, a string, n int")
    got = sorted((tuple(r) for r in distinct_on(df, ["k"]).collect()), key=repr)
    assert got == [("x", "a", 9), ("y", None, 1)]


names = st.lists(st.one_of(st.none(), st.text(alphabet="abcXYZ 1", max_size=4)), min_size=0, max_size=60, unique=True)


@settings(max_examples=10, deadline=None)
@given(names, st.integers(min_value=1, max_value=7))
def test_dense_key_range_equals_plain(spark, values, parts):
    df = spark.createDataFrame([(v,) for v in values], "name string")
    plain = sorted(((r[0], r[1]) for r in dense_key(df, ["name"], "k", method="plain").collect()), key=repr)
    ranged = sorted(((r[0], r[1]) for r in dense_key(df, ["name"], "k", method="range", num_partitions=parts).collect()),
                    key=repr)
    assert plain == ranged
    assert sorted(k for _, k in ranged) == list(range(1, len(values) + 1))


def test_default_dense_key_uses_no_single_task(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,)], "n string")
    keyed = dense_key(df, ["n"], "k")
    assert "SinglePartition" not in keyed.select("n", "k").drop("k")._jdf.queryExecution().toString()
    assert sorted((tuple(r) for r in keyed.collect()), key=repr) == [("a", 2), ("b", 3), (None, 1)]
    assert dense_key(df, ["n"], "k", as_int=False).schema["k"].dataType.simpleString() == "bigint"


def test_dense_key_prefix_and_hash(spark):
    df = spark.createDataFrame([("b",), ("a",)], "n string")
    assert sorted(tuple(r) for r in dense_key(df, ["n"], "k", prefix="M").collect()) == [("a", "M1"), ("b", "M2")]
    h = dense_key(df, ["n"], "k", method="hash")
    assert h.schema["k"].dataType.simpleString() == "bigint"


def test_expectations(spark):
    df = spark.createDataFrame([("TS09X1",), (None,), ("TS1",), ("AB12",)], "k string")
    rule = {"valid": "k IS NOT NULL AND length(trim(k)) > 3"}
    assert [r[0] for r in expect_or_drop(df, rule).collect()] == ["TS09X1", "AB12"]
    kept, obs = expect(df, rule, "warn")
    assert kept.count() == 4
    assert obs.get["failed_valid"] == 2
    counts = expectation_counts(df, rule).first()
    assert (counts["rows"], counts["passed_valid"], counts["failed_valid"]) == (4, 2, 2)


def test_expect_fail_raises(spark):
    import pytest
    df = spark.createDataFrame([("TS09X1",), (None,)], "k string")
    failing, _ = expect(df, {"valid": "k IS NOT NULL"}, "fail")
    with pytest.raises(Exception, match="expectation failed"):
        failing.collect()


def test_silver_metrics_ride_along(spark):
    from conftest import SF_SMALL
    from regstar.plans import medallion as Md
    from regstar.sources.fixtures import dirty_registrations
    silver, obs = Md.silver_with_metrics(dirty_registrations(spark, SF_SMALL))
    n = silver.count()
    m = obs.get
    assert n == m["rows"] - m["failed_valid_registration"] and m["failed_valid_registration"] > 0
    assert n == Md.silver(dirty_registrations(spark, SF_SMALL)).count()
