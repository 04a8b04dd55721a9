"""Registered queries: budget curves and rule analytics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import rules
from ledgerlens.plans.catalog_rates import AGE, HOUR, TS
from ledgerlens.plans.registry import register, round_doubles, with_events, with_ledger
from ledgerlens.sources.bindings import event_ledger, ledger

R = round_doubles


def _curve_sql(src: str, key_expr: str, key: str, count_name: str, rev: bool) -> str:
    frame = ("ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING" if rev
             else "ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW")
    w = f"OVER (ORDER BY {key} {frame})"
    return f"""
WITH s AS (SELECT {key_expr} AS {key}, count(is_fraud) AS {count_name},
    CAST(sum(is_fraud) AS BIGINT) AS fraud_count FROM {src} WHERE {key_expr} IS NOT NULL GROUP BY 1),
c AS (SELECT *, {count_name} - fraud_count AS user_validated,
    CAST(sum(fraud_count) {w} AS BIGINT) AS fraud_cumsum,
    CAST(sum({count_name}) {w} AS BIGINT) AS {count_name}_cumsum,
    CAST(sum({count_name} - fraud_count) {w} AS BIGINT) AS user_validated_cumsum,
    CAST(sum(fraud_count) OVER () AS BIGINT) AS F_, CAST(sum({count_name}) OVER () AS BIGINT) AS N_,
    CAST(sum({count_name} - fraud_count) OVER () AS BIGINT) AS V_ FROM s)
SELECT {key}, {count_name}, fraud_count, user_validated, fraud_cumsum, {count_name}_cumsum,
  user_validated_cumsum, fraud_cumsum AS fraud_handled_cumsum,
  round(CAST(fraud_cumsum AS DOUBLE) / F_ * 100, 6) AS fraud_cumsum_pct,
  round(CAST(fraud_cumsum AS DOUBLE) / F_ * 100, 6) AS fraud_handled_cumsum_pct,
  round(CAST(user_validated_cumsum AS DOUBLE) / V_ * 100, 6) AS user_validated_cumsum_pct,
  round(CAST((F_ - fraud_cumsum) * 100 AS DOUBLE) / (N_ - fraud_cumsum), 6) AS actual_fraud_rate
FROM c"""


def _ages(spark, sf, extra=()):
    return ledger(spark, sf, [TS, "dob", "is_fraud", *extra]).withColumn("age", fx.age_365(TS, "dob"))


def _hours(spark, sf, extra=()):
    return event_ledger(spark, sf, [TS, "is_fraud", *extra]).withColumn("trans_hour", F.hour(TS))


@register("age_budget_curve_asc", with_ledger(_curve_sql("ledger", AGE, "age", "total_users", False)),
          bench=True)
def age_budget_curve_asc(spark, sf):
    return R(rules.budget_curve(_ages(spark, sf), "age", direction="asc"))


@register("age_budget_curve_desc", with_ledger(_curve_sql("ledger", AGE, "age", "total_users", True)),
          bench=True)
def age_budget_curve_desc(spark, sf):
    return R(rules.budget_curve(_ages(spark, sf), "age", direction="desc"))


@register("hour_budget_curve", with_events(_curve_sql("ev", HOUR, "trans_hour", "users_count", False)))
def hour_budget_curve(spark, sf):
    return R(rules.budget_curve(_hours(spark, sf), "trans_hour", direction="asc", count_name="users_count"))


@register("age_budget_past_threshold", with_ledger(
    f"SELECT * FROM ({_curve_sql('ledger', AGE, 'age', 'total_users', False)}) "
    "WHERE user_validated_cumsum_pct > 19"))
def age_budget_past_threshold(spark, sf):
    curve = rules.budget_curve(_ages(spark, sf), "age", direction="asc")
    return R(rules.past_threshold(curve, 19.0))


def _nearest_sql(rev: bool) -> str:
    return (f"SELECT * FROM ({_curve_sql('ledger', AGE, 'age', 'total_users', rev)}) "
            "ORDER BY abs(user_validated_cumsum_pct - 20.0), age LIMIT 1")


@register("nearest_budget", with_ledger(_nearest_sql(False)))
def nearest_budget(spark, sf):
    curve = R(rules.budget_curve(_ages(spark, sf), "age", direction="asc"))
    return rules.nearest_budget(curve, "age", 20.0)


@register("rule_comparison", with_ledger(f"""
WITH a AS ({_nearest_sql(False)}), d AS ({_nearest_sql(True)}),
b AS (SELECT avg(CAST(is_fraud AS DOUBLE)) * 100 AS base_fraud_rate FROM ledger),
r AS (SELECT 'Youngest 20%' AS rule, 0 AS rule_ord, user_validated_cumsum_pct AS coverage_pct,
        actual_fraud_rate AS fraud_rate_after FROM a
      UNION ALL SELECT 'Oldest 20%', 1, user_validated_cumsum_pct, actual_fraud_rate FROM d),
r2 AS (SELECT * FROM r UNION ALL
       SELECT '10% Young + 10% Old', 2, avg(coverage_pct), avg(fraud_rate_after) FROM r)
SELECT rule, CAST(rule_ord AS INTEGER) AS rule_ord, round(coverage_pct, 6) AS coverage_pct,
  round(fraud_rate_after, 6) AS fraud_rate_after, round(b.base_fraud_rate, 6) AS base_fraud_rate,
  round(b.base_fraud_rate - fraud_rate_after, 6) AS fraud_reduction,
  round((b.base_fraud_rate - fraud_rate_after) / b.base_fraud_rate * 100, 6) AS fraud_uplift_pct
FROM r2, b"""))
def rule_comparison(spark, sf):
    df = _ages(spark, sf)
    asc = R(rules.budget_curve(df, "age", direction="asc"))
    desc = R(rules.budget_curve(df, "age", direction="desc"))
    picks = {"Youngest 20%": rules.nearest_budget(asc, "age"), "Oldest 20%": rules.nearest_budget(desc, "age")}
    return R(rules.compare_rules(df, picks, mixed_name="10% Young + 10% Old"))


_EVAL_COLS = """count(*) AS total_rows, CAST(sum(is_fraud) AS BIGINT) AS total_fraud,
  count(CASE WHEN {p} THEN 1 END) AS flagged_rows,
  CAST(coalesce(sum(CASE WHEN {p} THEN is_fraud END), 0) AS BIGINT) AS flagged_fraud"""
_EVAL_SELECT = """SELECT *, round(CAST(flagged_fraud AS DOUBLE) / total_fraud * 100, 6) AS fraud_captured_pct,
  round(CAST(flagged_rows - flagged_fraud AS DOUBLE) / (total_rows - total_fraud) * 100, 6) AS legit_impacted_pct,
  round(CAST(flagged_rows AS DOUBLE) / total_rows * 100, 6) AS coverage_pct FROM t"""


@register("night_rule", with_events(f"""
WITH t AS (SELECT {_EVAL_COLS.format(p=f'{HOUR} BETWEEN 22 AND 23')} FROM ev) {_EVAL_SELECT}"""))
def night_rule(spark, sf):
    return R(rules.evaluate_rule(_hours(spark, sf), rules.night_rule("trans_hour")))


@register("age_rule", with_ledger(f"""
WITH t AS (SELECT {_EVAL_COLS.format(p=f'{AGE} BETWEEN 61 AND 95')} FROM ledger) {_EVAL_SELECT}"""))
def age_rule(spark, sf):
    return R(rules.evaluate_rule(_ages(spark, sf), rules.age_rule("age")))


@register("risk_tier_eval", with_events(f"""
WITH x AS (SELECT is_fraud, CASE WHEN coalesce({AGE} >= 61, false) AND coalesce({HOUR} BETWEEN 22 AND 23, false)
    THEN 'HIGH_RISK' WHEN coalesce({AGE} >= 61, false) OR coalesce({HOUR} BETWEEN 22 AND 23, false)
    THEN 'MEDIUM_RISK' ELSE 'LOW_RISK' END AS tier FROM ev),
t AS (SELECT count(*) AS n, CAST(sum(is_fraud) AS BIGINT) AS f FROM x)
SELECT tier, count(*) AS "rows", CAST(sum(is_fraud) AS BIGINT) AS fraud_rows,
  round(CAST(sum(is_fraud) AS DOUBLE) / max(t.f) * 100, 6) AS fraud_captured_pct,
  round(CAST(count(*) - sum(is_fraud) AS DOUBLE) / max(t.n - t.f) * 100, 6) AS legit_impacted_pct,
  round(CAST(sum(is_fraud) AS DOUBLE) / count(*) * 100, 6) AS fraud_rate_pct
FROM x, t GROUP BY tier"""))
def risk_tier_eval(spark, sf):
    df = _hours(spark, sf, ["dob"]).withColumn("age", fx.age_365(TS, "dob"))
    df = df.withColumn("risk", rules.risk_tier("age", "trans_hour")).withColumn("tier", F.col("risk.tier"))
    return R(rules.tier_evaluation(df))
