"""Registered queries: streaming scorer, windowed rate and micro-batch gate
(each drains the events file stream with an availableNow trigger)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import quality as q
from ledgerlens.plans.catalog_quality import RAW_SUITE_EVENTS_SQL, flat_results
from ledgerlens.plans.catalog_behaviour import DAY, US
from ledgerlens.plans.catalog_rates import AGE, HOUR, TS
from ledgerlens.plans.registry import register, round_doubles, with_events
from ledgerlens.sources.bindings import event_ledger, read_events_stream
from ledgerlens.streaming import history, scoring

R = round_doubles


def _stream(spark, sf, cols):
    return event_ledger(spark, sf, cols, source=read_events_stream(spark, sf))


@register("stream_risk_score", with_events(f"""
SELECT trans_num, {TS}, dob, is_fraud, {AGE} AS age, {HOUR} AS trans_hour,
  coalesce({AGE} BETWEEN 61 AND 95, false) AS age_rule, coalesce({HOUR} BETWEEN 22 AND 23, false) AS night_rule,
  coalesce({AGE} >= 61, false) OR coalesce({HOUR} BETWEEN 22 AND 23, false) AS otp_trigger,
  CASE WHEN coalesce({AGE} >= 61, false) AND coalesce({HOUR} BETWEEN 22 AND 23, false) THEN 'HIGH_RISK'
       WHEN coalesce({AGE} >= 61, false) OR coalesce({HOUR} BETWEEN 22 AND 23, false) THEN 'MEDIUM_RISK'
       ELSE 'LOW_RISK' END AS risk_tier
FROM ev"""))
def stream_risk_score(spark, sf):
    return scoring.score_stream(_stream(spark, sf, ["trans_num", TS, "dob", "is_fraud"]))


@register("stream_hourly_rate", with_events(f"""
SELECT date_trunc('hour', {TS}) AS window_start, date_trunc('hour', {TS}) + INTERVAL 1 HOUR AS window_end,
  count(*) AS transactions, CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
  round(CAST(sum(is_fraud) AS DOUBLE) / count(*) * 100, 6) AS fraud_pct
FROM ev GROUP BY 1, 2"""))
def stream_hourly_rate(spark, sf):
    return R(scoring.hourly_rate_stream(_stream(spark, sf, [TS, "is_fraud"])))


@register("stream_quality_gate", RAW_SUITE_EVENTS_SQL)
def stream_quality_gate(spark, sf):
    res = scoring.gate_stream(_stream(spark, sf, ["trans_num", "cc_num", "amt", "is_fraud"]), q.RAW_SUITE)
    return flat_results(res)


@register("stream_history_features", with_events(f"""
SELECT trans_num, {TS}, cc_num, merchant, is_fraud, round(amt, 8) AS amt,
  round(round(sum(amt) OVER d30, 2) / count(amt) OVER d30, 8) AS avg_amt_30d, count(*) OVER d7 AS txn_count_7d,
  round(CAST({US} - lag({US}) OVER o AS DOUBLE) / CAST(60000000 AS DOUBLE), 8) AS minutes_since_last,
  CAST(coalesce(sum(is_fraud) OVER u, 0) AS BIGINT) AS user_fraud_history,
  round(avg(CAST(is_fraud AS DOUBLE)) OVER m, 8) AS merchant_rate_history
FROM ev WINDOW
  d30 AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {30 * DAY} PRECEDING AND 1 PRECEDING),
  d7 AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN {7 * DAY} PRECEDING AND 1 PRECEDING),
  u AS (PARTITION BY cc_num ORDER BY {US} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  m AS (PARTITION BY merchant ORDER BY {US} RANGE BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING),
  o AS (PARTITION BY cc_num ORDER BY {US}, trans_num)"""))
def stream_history_features(spark, sf):
    """ST1 with W8–W12: every event of the drained stream with its history."""
    src = _stream(spark, sf, ["trans_num", TS, "cc_num", "merchant", "is_fraud", "amt"])
    return R(history.history_stream(src, finish=True), 8)
