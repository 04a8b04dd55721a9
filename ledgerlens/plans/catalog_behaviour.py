"""Registered queries: per-user and per-merchant history features."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import behaviour as bh
from ledgerlens.operators import curves, rates
from ledgerlens.plans import ml
from ledgerlens.plans.catalog_profile import DIST
from ledgerlens.plans.catalog_rates import AGE, HOUR, TS
from ledgerlens.plans.registry import register, round_doubles, with_events
from ledgerlens.sources.bindings import event_ledger

R = round_doubles
US = f"epoch_us({TS})"
DAY = 86_400_000_000


def _ev(spark, sf, extra=()):
    return event_ledger(spark, sf, ["trans_num", TS, "cc_num", "amt", "is_fraud", *extra])


@register("rolling_avg_30d", with_events(f"""
SELECT trans_num, {TS}, cc_num, amt, is_fraud,
  round(sum(amt) OVER w, 2) AS sum_amt_30d, count(amt) OVER w AS n_30d,
  round(round(sum(amt) OVER w, 2) / count(amt) OVER w, 6) AS avg_amt_30d
FROM ev WINDOW w AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {30 * DAY} PRECEDING AND 1 PRECEDING)"""))
def rolling_avg_30d(spark, sf):
    # money has two decimals: the window sum is compared at cents, the mean derived from it
    out = bh.rolling_stats(_ev(spark, sf), "cc_num", TS, "amt", 30, sum_name="sum_amt_30d", count_name="n_30d")
    out = out.withColumn("sum_amt_30d", F.when(F.col("n_30d") > 0, F.round("sum_amt_30d", 2)))
    return R(out.withColumn("avg_amt_30d", F.try_divide(F.col("sum_amt_30d"), F.col("n_30d"))))


@register("rolling_count_7d", with_events(f"""
SELECT trans_num, {TS}, cc_num, amt, is_fraud,
  count(*) OVER (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING)
    AS txn_count_7d FROM ev"""), bench=True)
def rolling_count_7d(spark, sf):
    return bh.rolling_count(_ev(spark, sf), "cc_num", TS, 7, "txn_count_7d")


@register("minutes_since_last", with_events(f"""
SELECT trans_num, {TS}, cc_num, amt, is_fraud,
  round(CAST({US} - lag({US}) OVER (PARTITION BY cc_num ORDER BY {US}, trans_num) AS DOUBLE)
    / CAST(60000000 AS DOUBLE), 8)
    AS minutes_since_last FROM ev"""))
def minutes_since_last(spark, sf):
    # 8 decimals: minutes are micros / 6e7, whose decimal form ends within 8 digits or never
    out = bh.minutes_since_last(_ev(spark, sf), "cc_num", TS, "trans_num")
    return out.withColumn("minutes_since_last", F.round("minutes_since_last", 8))


@register("user_fraud_history", with_events(f"""
SELECT trans_num, {TS}, cc_num, amt, is_fraud,
  CAST(coalesce(sum(is_fraud) OVER (PARTITION BY cc_num ORDER BY {US}
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS user_fraud_history FROM ev"""))
def user_fraud_history(spark, sf):
    return bh.fraud_history(_ev(spark, sf), "cc_num", TS)


@register("merchant_rate_history", with_events(f"""
SELECT trans_num, {TS}, merchant, amt, is_fraud,
  round(avg(CAST(is_fraud AS DOUBLE)) OVER (PARTITION BY merchant ORDER BY {US}
    RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 6) AS merchant_rate_history FROM ev"""))
def merchant_rate_history(spark, sf):
    df = event_ledger(spark, sf, ["trans_num", TS, "merchant", "amt", "is_fraud"])
    return R(bh.rate_history(df, "merchant", TS))


# every feature of the proposed model at once; a mean of cents is rounded at 8 decimals,
# where no mean of fewer than 128 rows lies halfway
@register("ml_feature_table", with_events(f"""
SELECT trans_num, {TS}, cc_num, merchant, category, is_fraud, {AGE} AS age, {HOUR} AS trans_hour, round(amt, 8) AS amt,
  round({DIST}, 8) AS distance_miles, city_pop,
  coalesce(round(round(sum(amt) OVER d30, 2) / count(amt) OVER d30, 8), 0) AS avg_amt_30d,
  count(*) OVER d7 AS txn_count_7d,
  coalesce(round(CAST({US} - lag({US}) OVER o AS DOUBLE) / CAST(60000000 AS DOUBLE), 8), 0) AS minutes_since_last,
  CAST(lag({US}) OVER o IS NULL AS INTEGER) AS is_first_txn,
  CAST(coalesce(sum(is_fraud) OVER u, 0) AS BIGINT) AS user_fraud_history,
  coalesce(round(avg(CAST(is_fraud AS DOUBLE)) OVER m, 8), 0) AS merchant_rate_history
FROM ev WINDOW
  d30 AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {30 * DAY} PRECEDING AND 1 PRECEDING),
  d7 AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING),
  u AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  m AS (PARTITION BY merchant ORDER BY {US} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  o AS (PARTITION BY cc_num ORDER BY {US}, trans_num)"""))
def ml_feature_table(spark, sf):
    raw = event_ledger(spark, sf, ["trans_num", TS, "cc_num", "merchant", "category", "is_fraud", "dob", "amt",
                                   "lat", "long", "merch_lat", "merch_long", "city_pop"])
    out = ml.feature_table(raw)
    return R(out.select("trans_num", TS, "cc_num", "merchant", "category", "is_fraud", *ml.NUMERIC), 8)


# M10 on a deterministic score: age, 25 points for a late hour, a point per 100 of the amount
_CURVE = f"""x AS (SELECT {AGE} + CASE WHEN {HOUR} >= 22 THEN 25 ELSE 0 END + amt / 100 AS score, is_fraud FROM ev),
per_score AS (SELECT score, count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS positives FROM x
  WHERE score IS NOT NULL AND is_fraud IS NOT NULL GROUP BY score),
c AS (SELECT *, sum(n) OVER w AS flagged, sum(positives) OVER w AS tp, sum(n) OVER () AS all_n, sum(positives) OVER () AS all_p
  FROM per_score WINDOW w AS (ORDER BY score DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


def _points(spark, sf):
    df = event_ledger(spark, sf, [TS, "dob", "amt", "is_fraud"])
    late = F.when(F.hour(TS) >= 22, 25).otherwise(0)
    return df.withColumn("score", fx.age_365(TS, "dob") + late + F.col("amt") / 100)


@register("threshold_curve_points", with_events(f"""WITH {_CURVE}
SELECT round(score, 8) AS score, n, positives, CAST(flagged AS BIGINT) AS flagged, CAST(tp AS BIGINT) AS tp,
  CAST(flagged - tp AS BIGINT) AS fp,
  CAST(all_p AS BIGINT) AS all_positives, round(tp / flagged, 8) AS precision, round(tp / all_p, 8) AS recall,
  round(flagged / all_n, 8) AS flagged_share, round((tp / flagged) / (all_p / all_n), 8) AS lift FROM c"""))
def threshold_curve_points(spark, sf):
    return R(curves.threshold_curve(_points(spark, sf), "score"), 8)


@register("threshold_summary_points", with_events(f"""WITH {_CURVE},
r AS (SELECT is_fraud, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2.0 AS rk FROM x
  WHERE score IS NOT NULL AND is_fraud IS NOT NULL),
u AS (SELECT sum(rk * is_fraud) AS r1, CAST(sum(is_fraud) AS DOUBLE) AS p, CAST(count(*) AS DOUBLE) AS m FROM r),
f AS (SELECT *, 2.0 * tp / (flagged + all_p) AS f1 FROM c)
SELECT CAST(m AS BIGINT) AS n, CAST(p AS BIGINT) AS positives, round((r1 - p * (p + 1) / 2) / (p * (m - p)), 8) AS roc_auc,
  round((SELECT sum(positives * (tp / flagged)) FROM c) / p, 8) AS average_precision,
  round((SELECT max(f1) FROM f), 8) AS best_f1,
  round((SELECT score FROM f ORDER BY f1 DESC, score DESC LIMIT 1), 8) AS best_threshold FROM u"""))
def threshold_summary_points(spark, sf):
    return R(curves.curve_summary(curves.threshold_curve(_points(spark, sf), "score")), 8)


@register("amount_step", with_events(f"""
SELECT trans_num, {TS}, amt, round(amt - lag(amt) OVER (ORDER BY {TS}, trans_num), 6) AS amt_step FROM ev"""))
def amount_step(spark, sf):
    """W1 over every transaction: its amount less that of the one before."""
    df = event_ledger(spark, sf, ["trans_num", TS, "amt"])
    return R(rates.period_change(df, [TS, "trans_num"], "amt", name="amt_step", bounded_key=False))
