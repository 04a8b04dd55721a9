"""M8: all history features in one pass equal the operators one by one."""

import datetime
import random

import __spark_entry__ as entry
from ledgerlens.operators import behaviour as bh

TS = "trans_date_trans_time"
NAMES = ["avg_amt_30d", "txn_count_7d", "minutes_since_last", "user_fraud_history", "merchant_rate_history"]


def _chained(df):
    out = bh.rolling_avg(df, "cc_num", TS, "amt", 30, "avg_amt_30d")
    out = bh.rolling_count(out, "cc_num", TS, 7, "txn_count_7d")
    out = bh.minutes_since_last(out, "cc_num", TS, "trans_num")
    out = bh.fraud_history(out, "cc_num", TS)
    return bh.rate_history(out, "merchant", TS)


def _rows(df):
    # amounts are whole numbers, so that sums are exact in any order
    return sorted(tuple((v is not None, v if v is not None else 0) for v in
                        (r["trans_num"], r["extra"], *[r[n] for n in NAMES])) for r in df.collect())


def test_one_pass_equals_the_chain(spark):
    rnd = random.Random(7)
    start = datetime.datetime(2021, 1, 1)
    steps = [0, 1, 59, 3600, 86_400, 7 * 86_400, 30 * 86_400]  # ties and exact window borders
    rows, t = [], start
    for i in range(400):
        t = start + datetime.timedelta(seconds=sum(rnd.choices(steps, k=rnd.randint(0, 3))) + rnd.randint(0, 2))
        user = rnd.choice([1, 1, 1, 2, 3, None])  # 1 is hot
        rows.append((f"t{i:04d}", t, user, rnd.choice(["a", "a", "b", None]), float(rnd.randint(1, 99))
                     if rnd.random() > .1 else None, rnd.choice([0, 0, 1, None]), f"x{i}"))
    df = spark.createDataFrame(rows, f"trans_num string, {TS} timestamp_ntz, cc_num long, merchant string, "
                                     "amt double, is_fraud int, extra string")
    got, want = bh.behaviour_features(df), _chained(df)
    assert got.columns == [*df.columns, *NAMES]
    assert _rows(got) == _rows(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], f"trans_num string, {TS} timestamp_ntz, cc_num long, merchant string, "
                                   "amt double, is_fraud int")
    assert bh.behaviour_features(df).count() == 0


def test_rows_are_scanned_once_besides_the_totals(spark):
    plan = entry.queries()["ml_feature_table"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan()
    assert plan.toString().count("events.parquet") == 1  # the hourly totals were the other scan
