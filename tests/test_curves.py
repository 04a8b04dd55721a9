"""Exact threshold curves and changes along one global order, against brute force."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from ledgerlens.operators import curves, keys, rates


def _brute(rows):
    rows = [(s, y) for s, y in rows if s is not None and s == s and y is not None]
    p = sum(y for _, y in rows)
    return {t: (sum(s >= t for s, _ in rows), sum(y for s, y in rows if s >= t), p) for t in {s for s, _ in rows}}


def test_curve_and_summary_equal_brute_force(spark):
    rnd = random.Random(5)
    rows = [(rnd.choice([0.0, round(rnd.random(), 2)]), int(rnd.random() < .3)) for _ in range(600)]  # 0.0 is hot
    rows += [(None, 1), (float("nan"), 1), (0.5, None)]
    df = spark.createDataFrame(rows, "s double, is_fraud int").repartition(7)
    c = curves.threshold_curve(df, "s").checkpoint()
    got = {r["score"]: (r["flagged"], r["tp"], r["all_positives"]) for r in c.collect()}
    assert got == _brute(rows)
    clean = [(s, y) for s, y in rows if s is not None and s == s and y is not None]
    pos, neg = [s for s, y in clean if y], [s for s, y in clean if not y]
    auc = sum((a > b) + (a == b) / 2 for a in pos for b in neg) / len(pos) / len(neg)
    best = max((2 * tp / (fl + p), t) for t, (fl, tp, p) in got.items())
    r = curves.curve_summary(c).first()
    assert r["roc_auc"] == pytest.approx(auc, rel=1e-12) and (r["best_f1"], r["best_threshold"]) == best
    assert (r["n"], r["positives"]) == (len(clean), len(pos))


def test_curve_without_a_class_or_rows(spark):
    none = spark.createDataFrame([], "s double, is_fraud int")
    r = curves.curve_summary(curves.threshold_curve(none, "s")).first()
    assert (r["n"], r["positives"], r["roc_auc"], r["best_threshold"]) == (0, 0, None, None)
    neg = spark.createDataFrame([(1.0, 0), (2.0, 0)], "s double, is_fraud int")
    c = curves.threshold_curve(neg, "s")
    assert [x["recall"] for x in c.collect()] == [None, None]
    assert curves.curve_summary(c).first()["roc_auc"] is None


def test_change_over_a_long_order_equals_the_window(spark):
    df = spark.range(100_000).select(((F.col("id") * 7919) % 100_000).alias("t"),
                                     F.when(F.col("id") % 11 > 0, F.xxhash64("id") % 1000).alias("v"))
    got = rates.period_change(df, "t", "v", bounded_key=False)
    want = df.withColumn("w", F.col("v") - F.lag("v").over(Window.orderBy("t")))
    both = got.join(want.select("t", "w"), "t")
    assert both.count() == 100_000 and both.filter(~F.col("v_change").eqNullSafe(F.col("w"))).count() == 0


def test_no_window_over_the_whole_table(spark):
    df = spark.range(1000).select("id", F.col("id").alias("v"))
    plan = keys.lag_global(df, ["id"], "v", "p")._jdf.queryExecution().executedPlan().toString()
    rows_side = plan[:plan.index("BroadcastExchange")]
    assert "SinglePartition" not in rows_side  # only the table with a row per partition


def test_lag_of_an_empty_table(spark):
    assert keys.lag_global(spark.createDataFrame([], "a int, v int"), ["a"], "v", "p").count() == 0
