import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import keys, quality as q
from ledgerlens.plans import model

TS0 = dt.datetime(2020, 1, 1)


def test_row_number_dense_unique(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("v"))
    out = keys.with_row_number(df, ["v"], "k")
    r = out.agg(F.min("k"), F.max("k"), F.countDistinct("k")).first()
    assert tuple(r) == (1, 5000, 5000)
    assert out.filter(F.col("k") != F.col("v") + 1).count() == 0


def test_running_sum_global_both_ways(spark):
    df = spark.range(1, 101).select(F.col("id").alias("k"), F.col("id").alias("x"))
    fwd = {r["k"]: r["c"] for r in keys.running_sum_global(df, ["k"], "x", "c").collect()}
    rev = {r["k"]: r["c"] for r in keys.running_sum_global(df, ["k"], "x", "c", reverse=True).collect()}
    assert fwd[100] == 5050 and rev[1] == 5050 and all(fwd[k] + rev[k] - k == 5050 for k in fwd)


def test_keep_first(spark):
    df = spark.createDataFrame([("m", 2, "late"), ("m", 1, "early"), ("n", 5, "only")], "k string, t int, v string")
    got = {r["k"]: r["v"] for r in keys.keep_first(df, "k", ["t"]).collect()}
    assert got == {"m": "early", "n": "only"}


def _raw(spark, rows):
    cols = ("trans_num string, trans_date_trans_time timestamp_ntz, cc_num bigint, merchant string, category string,"
            " amt double, first string, last string, gender string, street string, city string, state string,"
            " zip string, lat double, long double, city_pop bigint, job string, dob date, merch_lat double,"
            " merch_long double, is_fraud int, merch_zipcode string")
    return spark.createDataFrame(rows, cols)


def _row(i, city="A", pop=100, merchant="fraud_X", mlat=1.0, zipc="1", first="Ann", street="s1", fraud=0):
    return (f"t{i}", TS0 + dt.timedelta(hours=i), 10 + (first == "Bob"), merchant, "c", 5.0, first, "L", "F",
            street, city, "S", "00001", 1.0, 2.0, pop, "job", dt.date(1990, 1, 1), mlat, 2.0, fraud, zipc)


def test_fanout_and_keys(spark):
    raw = _raw(spark, [_row(0), _row(1, pop=200), _row(2, first="Bob", street="s2", merchant="fraud_Y")])
    cities = model.dim_city(raw)
    assert cities.count() == 2 and sorted(r[0] for r in cities.select("city_id").collect()) == [1, 2]
    users = model.dim_user(raw, cities)
    assert users.count() == 4   # Ann (city A listed twice) fans out; Bob too
    assert model.dim_user(raw, cities, on_fanout="first").count() == 2
    with pytest.raises(ValueError):
        model.dim_user(raw, cities, on_fanout="error")


def test_merchant_dupes_keep_first(spark):
    raw = _raw(spark, [_row(0, mlat=1.5, zipc=None), _row(1, mlat=9.0), _row(2, merchant="fraud_Z")])
    m = {r["merch_name"]: (r["merch_lat"], r["merch_zipcode"], r["merch_id"]) for r in model.dim_merchant(raw).collect()}
    assert m == {"X": (1.5, None, 1), "Z": (1.0, "1", 2)}
    fact = model.fact_transaction(raw, model.dim_merchant(raw))
    assert sorted(r["merchant_id"] for r in fact.collect()) == [1, 1, 2]


def test_null_safe_lookup(spark):
    raw = _raw(spark, [_row(0, city=None)])
    users = model.dim_user(raw, model.dim_city(raw))
    assert users.first()["city_id"] == 1


def test_orphans(spark):
    raw = _raw(spark, [_row(0)])
    fact = model.fact_transaction(raw, model.dim_merchant(raw))
    other = spark.createDataFrame([(99,)], "merch_id long")
    assert model.orphans(fact, "merchant_id", other, "merch_id").count() == 1
    assert model.covered(fact, "merchant_id", model.dim_merchant(raw), "merch_id").count() == 1


def _bad_fact(spark):
    return spark.createDataFrame(
        [(None, 1, 3, 5.0, True), ("a", 1, 3, 0.0, False), ("a", 2, 3, 7.0, None), ("b", None, 3, 9.0, True)],
        "trx_id string, cc_number long, merchant_id long, amt double, is_fraud boolean")


def test_quality_fact_suite_failures(spark):
    res = {r["expectation_index"]: r for r in q.validate(_bad_fact(spark), q.FACT_SUITE).collect()}
    assert res[0]["unexpected_count"] == 1 and not res[0]["success"]
    assert res[1]["unexpected_count"] == 2 and res[1]["partial_unexpected_list"] == ["a"]
    assert res[1]["missing_count"] == 1
    assert res[2]["unexpected_count"] == 1
    assert res[4]["unexpected_count"] == 1 and res[4]["partial_unexpected_list"] == ["0.0"]
    assert res[5]["unexpected_count"] == 0 and res[5]["missing_count"] == 1 and res[5]["success"]
    st = q.statistics(q.validate(_bad_fact(spark), q.FACT_SUITE)).first()
    assert (st["evaluated_expectations"], st["successful_expectations"]) == (6, 2)
    with pytest.raises(q.QualityGateError):
        q.gate(q.validate(_bad_fact(spark), q.FACT_SUITE))


def test_mostly(spark):
    vals = [float(i) for i in range(999)] + [200000.0]
    df = spark.createDataFrame([(v,) for v in vals], "amt double")
    s = q.Suite("m", [q.Expectation(q.BETWEEN, {"column": "amt", "min_value": 0, "max_value": 100000,
                                                 "mostly": 0.999})])
    assert q.validate(df, s).first()["success"]
    df2 = spark.createDataFrame([(v,) for v in vals[:-2] + [200000.0, 300000.0]], "amt double")
    assert not q.validate(df2, s).first()["success"]


def test_suite_json_roundtrip(tmp_path):
    p = tmp_path / "s.json"
    q.RAW_SUITE.save(str(p))
    s = q.Suite.load(str(p))
    assert s.to_json() == q.RAW_SUITE.to_json()
    s.add_or_update(q.Expectation(q.NOT_NULL, {"column": "cc_num", "mostly": 0.9}))
    assert len(s.expectations) == 6 and json.loads(s.to_json())["expectations"][1]["kwargs"]["mostly"] == 0.9


def test_clean_quarantine(spark):
    df = spark.createDataFrame([("1", "x"), ("oops", "y"), (None, "z")], "amt string, k string")
    good, bad = q.clean(df, required=["amt"], casts={"amt": "double"})
    assert good.count() == 1
    fails = sorted(tuple(r["failures"]) for r in bad.collect())
    assert fails == [("cast:amt:double", "required:amt"), ("required:amt",)]
