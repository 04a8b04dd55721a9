"""Registered queries: star schema, keys, referential integrity, features."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import summaries
from ledgerlens.plans import layout, model
from ledgerlens.plans.catalog_profile import DIST
from ledgerlens.plans.catalog_rates import AGE, AGE_GROUP, CITY_CAT, HOUR, MONTH, PROXY_USER, TIME_CAT, TS
from ledgerlens.plans.registry import register, round_doubles, with_ledger
from ledgerlens.session import scratch_path
from ledgerlens.sources.bindings import ledger

R = round_doubles
NF = "NULLS FIRST"

_CITY_SQL = f"""dc AS (SELECT city AS city_name, state, city_pop AS population,
    CAST(row_number() OVER (ORDER BY ts, tid, city {NF}, state {NF}, city_pop {NF}) AS BIGINT) AS city_id
  FROM (SELECT city, state, city_pop, {TS} AS ts, trans_num AS tid, row_number() OVER (
    PARTITION BY city, state, city_pop ORDER BY {TS}, trans_num) AS rn FROM ledger) WHERE rn = 1)"""

_UCOLS = ["first", "last", "dob", "job", "gender", "street", "zip", "city", "state"]
_UQ = ", ".join(f'"{c}"' for c in _UCOLS)
_UQNF = ", ".join(f'u."{c}" {NF}' for c in _UCOLS)

_USER_SQL = f"""du AS (SELECT u."first" AS first_name, u."last" AS last_name, u.dob, u.job, u.gender, u.street,
    u.zip AS zip_code, dc.city_id,
    CAST(row_number() OVER (ORDER BY u.ts, u.tid, {_UQNF}, dc.city_id {NF}) AS BIGINT) AS user_id
  FROM (SELECT {_UQ}, {TS} AS ts, trans_num AS tid, row_number() OVER (
      PARTITION BY {_UQ} ORDER BY {TS}, trans_num) AS rn FROM ledger) u
  LEFT JOIN dc ON u.city IS NOT DISTINCT FROM dc.city_name AND u.state IS NOT DISTINCT FROM dc.state
  WHERE u.rn = 1)"""

_MERCH_SQL = f"""dm AS (SELECT merchant AS merch_name, merch_lat, merch_long, merch_zipcode,
    CAST(row_number() OVER (ORDER BY ts, tid, merchant {NF}, merch_lat {NF}, merch_long {NF},
      merch_zipcode {NF}) AS BIGINT) AS merch_id
  FROM (SELECT replace(merchant, 'fraud_', '') AS merchant, merch_lat, merch_long, merch_zipcode,
      {TS} AS ts, trans_num AS tid, row_number() OVER (PARTITION BY replace(merchant, 'fraud_', '')
      ORDER BY {TS}, trans_num, merch_lat {NF}, merch_long {NF}, merch_zipcode {NF}) AS rn FROM ledger)
  WHERE rn = 1)"""


def _raw(spark, sf):
    return ledger(spark, sf)


@register("dim_date", with_ledger("""
span AS (SELECT min(CAST(trans_date_trans_time AS DATE)) AS lo, max(CAST(trans_date_trans_time AS DATE)) AS hi
  FROM ledger),
d AS (SELECT CAST(g.d AS DATE) AS d FROM span, range(span.lo, span.hi + 1, INTERVAL 1 DAY) g(d))
SELECT d AS full_date, CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_id, dayname(d) AS day_name,
  CAST(isodow(d) AS INTEGER) AS day_of_week, CAST(dayofmonth(d) AS INTEGER) AS day_of_month,
  monthname(d) AS month_name, CAST(month(d) AS INTEGER) AS month, CAST(year(d) AS INTEGER) AS year,
  CAST(quarter(d) AS INTEGER) AS quarter, isodow(d) IN (6, 7) AS is_weekend FROM d""".replace(
    "\nspan AS", "WITH span AS", 1)))
def dim_date(spark, sf):
    return model.data_calendar(ledger(spark, sf, [TS]))


@register("dim_city", with_ledger(f"WITH {_CITY_SQL} SELECT * FROM dc"))
def dim_city(spark, sf):
    return model.dim_city(ledger(spark, sf, ["city", "state", "city_pop", TS, "trans_num"]))


@register("dim_user", with_ledger(f"WITH {_CITY_SQL}, {_USER_SQL} SELECT * FROM du"))
def dim_user(spark, sf):
    raw = ledger(spark, sf, [*_UCOLS, "city_pop", TS, "trans_num"])
    return model.dim_user(raw, model.dim_city(raw))


@register("dim_merchant", with_ledger(f"WITH {_MERCH_SQL} SELECT * FROM dm"))
def dim_merchant(spark, sf):
    return model.dim_merchant(ledger(spark, sf, ["merchant", "merch_lat", "merch_long", "merch_zipcode",
                                                 TS, "trans_num"]))


@register("dim_card", with_ledger(f"""WITH {_CITY_SQL}, {_USER_SQL}
SELECT c.cc_num AS cc_number, du.user_id FROM (SELECT DISTINCT cc_num, "first", "last", dob FROM ledger) c
LEFT JOIN du ON c."first" IS NOT DISTINCT FROM du.first_name AND c."last" IS NOT DISTINCT FROM du.last_name
  AND c.dob IS NOT DISTINCT FROM du.dob"""))
def dim_card(spark, sf):
    raw = ledger(spark, sf, [*_UCOLS, "city_pop", "cc_num", TS, "trans_num"])
    return model.dim_card(raw, model.dim_user(raw, model.dim_city(raw)))


_FACT_SQL = f"""SELECT l.trans_num AS trx_id, l.{TS} AS trx_timestamp,
  CAST(strftime(l.{TS}, '%Y%m%d') AS INTEGER) AS date_id, l.cc_num AS cc_number, dm.merch_id AS merchant_id,
  l.amt, CAST(l.is_fraud AS INTEGER) <> 0 AS is_fraud, l.category, l.lat AS latitude, l.long AS longitude
FROM ledger l LEFT JOIN dm ON replace(l.merchant, 'fraud_', '') IS NOT DISTINCT FROM dm.merch_name"""


# the columns the fact and the merchant dimension read (no customer-side joins needed)
FACT_INPUT = ["trans_num", TS, "cc_num", "merchant", "amt", "is_fraud", "category", "lat", "long",
              "merch_lat", "merch_long", "merch_zipcode"]
# those that number the merchants (no join with orders)
MERCHANT_KEYS = ["merchant", TS, "trans_num"]


@register("fact_transaction", with_ledger(f"WITH {_MERCH_SQL} {_FACT_SQL}"), bench=True)
def fact_transaction(spark, sf):
    raw = ledger(spark, sf, FACT_INPUT)
    return model.fact_transaction(raw, model.dim_merchant(raw, names=ledger(spark, sf, MERCHANT_KEYS)))


@register("fact_integrity", with_ledger(f"""WITH {_CITY_SQL}, {_USER_SQL}, {_MERCH_SQL},
f AS ({_FACT_SQL}),
dd AS (SELECT CAST(strftime(CAST(g.d AS DATE), '%Y%m%d') AS INTEGER) AS date_id
  FROM range(DATE '2019-01-01', DATE '2027-01-01', INTERVAL 1 DAY) g(d)),
dcard AS (SELECT c.cc_num AS cc_number, du.user_id FROM (SELECT DISTINCT cc_num, "first", "last", dob FROM ledger) c
  LEFT JOIN du ON c."first" IS NOT DISTINCT FROM du.first_name AND c."last" IS NOT DISTINCT FROM du.last_name
  AND c.dob IS NOT DISTINCT FROM du.dob)
SELECT 'dim_user' AS child, 'city_id' AS "column", 'dim_city' AS parent,
  (SELECT count(*) FROM du WHERE city_id IS NULL OR city_id NOT IN (SELECT city_id FROM dc)) AS orphan_rows
UNION ALL SELECT 'dim_card', 'user_id', 'dim_user',
  (SELECT count(*) FROM dcard WHERE user_id IS NULL OR user_id NOT IN (SELECT user_id FROM du))
UNION ALL SELECT 'fact_transaction', 'merchant_id', 'dim_merchant',
  (SELECT count(*) FROM f WHERE merchant_id IS NULL OR merchant_id NOT IN (SELECT merch_id FROM dm))
UNION ALL SELECT 'fact_transaction', 'date_id', 'dim_date',
  (SELECT count(*) FROM f WHERE date_id IS NULL OR date_id NOT IN (SELECT date_id FROM dd))
UNION ALL SELECT 'fact_transaction', 'cc_number', 'dim_card',
  (SELECT count(*) FROM f WHERE cc_number IS NULL OR cc_number NOT IN (SELECT cc_number FROM dcard))"""))
def fact_integrity(spark, sf):
    return model.integrity_report(model.build_star(ledger(spark, sf)))


@register("features_full", with_ledger(f"""
SELECT *, CAST({TS} AS DATE) AS trans_date, {AGE} AS age, {HOUR} AS trans_hour,
  {TIME_CAT} AS transaction_time_category, CAST(month({TS}) AS INTEGER) AS trans_month,
  dayname({TS}) AS trans_day_of_week, {PROXY_USER} AS user_id, {CITY_CAT} AS city_category,
  {DIST} AS distance_miles, {MONTH} AS month, {AGE_GROUP} AS age_group, merch_zipcode IS NULL AS zip_missing
FROM ledger""".replace("SELECT *,", "SELECT * REPLACE (replace(merchant, 'fraud_', '') AS merchant),", 1)))
def features_full(spark, sf):
    return fx.add_features(ledger(spark, sf))


@register("spend_by_user_bucketed", with_ledger(f"""WITH {_CITY_SQL}, {_USER_SQL},
dcard AS (SELECT c.cc_num AS cc_number, du.user_id FROM (SELECT DISTINCT cc_num, "first", "last", dob FROM ledger) c
  LEFT JOIN du ON c."first" IS NOT DISTINCT FROM du.first_name AND c."last" IS NOT DISTINCT FROM du.last_name
  AND c.dob IS NOT DISTINCT FROM du.dob)
SELECT d.user_id, count(*) AS transactions, CAST(sum(l.is_fraud) AS BIGINT) AS fraud_transactions, round(sum(l.amt), 2) AS amount
FROM ledger l JOIN dcard d ON l.cc_num = d.cc_number GROUP BY d.user_id"""))
def spend_by_user_bucketed(spark, sf):
    """Fact and card dimension bucketed on the card number, joined without a
    shuffle of either, then totalled per user."""
    raw = ledger(spark, sf, list(dict.fromkeys([*FACT_INPUT, *_UCOLS, "city_pop", TS])))
    base = scratch_path(spark, f"processed/{uuid.uuid4().hex[:8]}")
    n = layout.buckets_for(ledger(spark, sf, ["trans_num"]).count())  # a row count, without the joins
    fact = layout.write_bucketed(model.fact_transaction(raw, model.dim_merchant(raw, names=ledger(spark, sf, MERCHANT_KEYS))), f"{base}/fact", "cc_number", n)
    cards = layout.write_bucketed(model.dim_card(raw, model.dim_user(raw, model.dim_city(raw))), f"{base}/card", "cc_number", n)
    j = fact.join(cards.select("cc_number", "user_id").hint("merge"), "cc_number")
    return j.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(F.col("is_fraud").cast("long")).alias("fraud_transactions"),
        F.round(F.sum("amt"), 2).alias("amount"))


# sketches of single months, merged over a range, within their stated error of the exact numbers
@register("merged_month_summary", with_ledger(f"""
SELECT '1996-03' AS first_month, '1997-06' AS last_month, count(*) AS transactions, count(DISTINCT cc_num) AS cards,
  true AS transactions_equal, true AS cards_close, true AS median_close
FROM ledger WHERE {MONTH} BETWEEN '1996-03' AND '1997-06'"""))
def merged_month_summary(spark, sf):
    df = ledger(spark, sf, [TS, "cc_num", "amt"]).withColumn("month", F.date_format(TS, "yyyy-MM"))
    path = scratch_path(spark, f"summaries/{uuid.uuid4().hex[:8]}")
    summaries.store(summaries.summarise(df, "month", distinct=["cc_num"], quantiles=["amt"]), path)
    est = summaries.estimates(summaries.merged(spark, path, "1996-03", "1997-06"))
    q = est.select("amt_p50").scalar()
    exact = df.filter(F.col("month").between("1996-03", "1997-06")).agg(
        F.count(F.lit(1)).alias("transactions"), F.countDistinct("cc_num").alias("cards"),
        F.avg((F.col("amt") < q).cast("double")).alias("_below"), F.avg((F.col("amt") <= q).cast("double")).alias("_upto"))
    return exact.select(
        F.lit("1996-03").alias("first_month"), F.lit("1997-06").alias("last_month"), "transactions", "cards",
        (F.col("transactions") == est.select("n").scalar()).alias("transactions_equal"),
        (F.abs(est.select("distinct_cc_num").scalar() / F.col("cards") - 1) < 0.05).alias("cards_close"),
        ((F.col("_below") < 0.53) & (F.col("_upto") > 0.47)).alias("median_close"))
