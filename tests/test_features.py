import datetime as dt
import math

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx


def test_time_category_hours(spark):
    hours = [7, 8, 17, 18, 22, 23, 0, None]
    df = spark.createDataFrame([(h,) for h in hours], "h int")
    got = [r[0] for r in df.select(fx.time_category("h")).collect()]
    assert got == ["Late Night", "Business Hours", "Business Hours", "Non-Business Hours",
                   "Non-Business Hours", "Late Night", "Late Night", "Late Night"]


def test_city_category_thresholds(spark):
    pops = [4999, 5000, 29999, 30000, 99999, 100000, 499999, 500000, None]
    df = spark.createDataFrame([(p,) for p in pops], "p bigint")
    got = [r[0] for r in df.select(fx.city_category("p")).collect()]
    assert got == ["Rural", "Small Town", "Small Town", "Medium Town", "Medium Town", "Urban", "Urban",
                   "Metropolitan", "Metropolitan"]


def test_cut_right_closed_and_out_of_range(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 18.0, 18.5, 25.0, 101.0, None]], "v double")
    got = [r[0] for r in df.select(fx.cut("v", [0, 18, 25, 35], ["a", "b", "c"])).collect()]
    assert got == [None, "a", "b", "b", None, None]


def test_age_floors_negative(spark):
    df = spark.createDataFrame([(dt.datetime(2020, 1, 1), dt.date(2020, 6, 1)),
                                (dt.datetime(2020, 1, 1), dt.date(1990, 1, 2))], "ts timestamp_ntz, dob date")
    got = [r[0] for r in df.select(fx.age_365("ts", "dob")).collect()]
    assert got == [-1, 30]


def test_round_half_even(spark):
    df = spark.createDataFrame([(v,) for v in [0.125, 0.285, 1.005, 2.675]], "v double")
    got = [r[0] for r in df.select(F.bround("v", 2)).collect()]
    assert got[0] == 0.12


def test_merchant_prefix(spark):
    df = spark.createDataFrame([("fraud_A fraud_B",)], "m string")
    assert df.select(fx.clean_merchant("m")).first()[0] == "A B"
    assert df.select(fx.clean_merchant("m", prefix_only=True)).first()[0] == "A fraud_B"


def test_proxy_id_nan(spark):
    df = spark.createDataFrame([("a", None, "F", "x")], "f string, l string, g string, c string")
    assert df.select(fx.proxy_user_id("f", "l", "g", "c")).first()[0] == "a_nan_F_x"


def test_haversine_matches_numpy(spark):
    lat1, lon1, lat2, lon2 = 36.0788, -81.1781, 36.011293, -82.048315
    r = 3958.8
    p1, p2 = math.radians(lat1), math.radians(lat2)
    a = math.sin((p2 - p1) / 2) ** 2 + math.cos(p1) * math.cos(p2) * math.sin(math.radians(lon2 - lon1) / 2) ** 2
    want = round(r * 2 * math.asin(math.sqrt(a)), 2)
    df = spark.createDataFrame([(lat1, lon1, lat2, lon2)], "a double, b double, c double, d double")
    assert df.select(fx.haversine_miles("a", "b", "c", "d")).first()[0] == want


def test_weekday_and_date_id(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 7),)], "d date")   # a Sunday
    r = df.select(fx.iso_weekday("d"), fx.day_name("d"), fx.date_id("d"), fx.month_key("d")).first()
    assert tuple(r) == (7, "Sunday", 20240107, "2024-01")
