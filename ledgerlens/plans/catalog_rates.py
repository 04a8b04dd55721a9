"""Registered queries: grouped rates, shares, distributions, top-k."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import keys, rates
from ledgerlens.plans.registry import register, round_doubles, with_events, with_ledger
from ledgerlens.sources.bindings import event_ledger, ledger

TS = "trans_date_trans_time"
R = round_doubles

# SQL fragments shared by the oracle texts (DuckDB dialect)
MONTH = f"strftime({TS}, '%Y-%m')"
HOUR = f"CAST(hour({TS}) AS INTEGER)"
AGE = f"CAST(floor(datediff('day', dob, CAST({TS} AS DATE)) / 365) AS INTEGER)"
CLEAN_MERCHANT = "replace(merchant, 'fraud_', '')"
TIME_CAT = f"""CASE WHEN {HOUR} BETWEEN 8 AND 17 THEN 'Business Hours'
  WHEN {HOUR} BETWEEN 18 AND 22 THEN 'Non-Business Hours' ELSE 'Late Night' END"""
CITY_CAT = """CASE WHEN city_pop < 5000 THEN 'Rural' WHEN city_pop < 30000 THEN 'Small Town'
  WHEN city_pop < 100000 THEN 'Medium Town' WHEN city_pop < 500000 THEN 'Urban' ELSE 'Metropolitan' END"""
AGE_GROUP = f"""CASE WHEN {AGE} > 0 AND {AGE} <= 18 THEN 'Underage (<=18)'
  WHEN {AGE} > 18 AND {AGE} <= 25 THEN '19–25' WHEN {AGE} > 25 AND {AGE} <= 35 THEN '26–35'
  WHEN {AGE} > 35 AND {AGE} <= 50 THEN '36–50' WHEN {AGE} > 50 AND {AGE} <= 100 THEN '50+' END"""
PROXY_USER = """coalesce("first", 'nan') || '_' || coalesce("last", 'nan') || '_' || coalesce(gender, 'nan')
  || '_' || coalesce(city, 'nan')"""


def _rate_sql(src_with, src, key_expr: str, key: str, extra: str = "") -> str:
    return src_with(f"""SELECT {key_expr} AS {key}, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate,
  count(is_fraud) AS transaction_count FROM {src} WHERE {key_expr} IS NOT NULL GROUP BY 1 {extra}""")


# ---------------------------------------------------------------- G4 / O3
@register("rate_by_hour", _rate_sql(with_events, "ev", HOUR, "trans_hour"), bench=True)
def rate_by_hour(spark, sf):
    df = event_ledger(spark, sf, [TS, "is_fraud"]).withColumn("trans_hour", F.hour(TS))
    return R(rates.rate_by(df, "trans_hour"))


@register("rate_by_weekday", with_events(f"""
SELECT dayname({TS}) AS trans_day_of_week, CAST(isodow({TS}) AS INTEGER) AS day_ord,
  round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate, count(is_fraud) AS transaction_count
FROM ev GROUP BY 1, 2"""))
def rate_by_weekday(spark, sf):
    df = event_ledger(spark, sf, [TS, "is_fraud"]).withColumn("trans_day_of_week", fx.day_name(TS))
    out = rates.rate_by(df, "trans_day_of_week")
    return R(out.withColumn("day_ord", fx.weekday_ordinal("trans_day_of_week")).orderBy("day_ord"))


@register("rate_by_time_category", _rate_sql(with_events, "ev", TIME_CAT, "transaction_time_category"))
def rate_by_time_category(spark, sf):
    df = event_ledger(spark, sf, [TS, "is_fraud"]).withColumn(
        "transaction_time_category", fx.time_category(F.hour(TS)))
    return R(rates.rate_by(df, "transaction_time_category"))


# ---------------------------------------------------------------- G3
@register("rate_by_merchant_top10", with_ledger(f"""
SELECT {CLEAN_MERCHANT} AS merchant, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate,
  count(is_fraud) AS transaction_count FROM ledger WHERE merchant IS NOT NULL GROUP BY 1
ORDER BY avg(CAST(is_fraud AS DOUBLE)) DESC, merchant LIMIT 10"""), bench=True)
def rate_by_merchant_top10(spark, sf):
    df = ledger(spark, sf, ["merchant", "is_fraud"]).withColumn("merchant", fx.clean_merchant("merchant"))
    out = rates.rate_by(df, "merchant")
    return R(rates.top_k(out, [F.col("fraud_rate").desc(), F.col("merchant")], 10))


for _name, _col in [("category", "category"), ("gender", "gender"), ("state", "state")]:
    register(f"rate_by_{_name}", _rate_sql(with_ledger, "ledger", _col, _col))(
        (lambda c: lambda spark, sf: R(rates.rate_by(ledger(spark, sf, [c, "is_fraud"]), c)))(_col))


@register("rate_by_city_category", _rate_sql(with_ledger, "ledger", CITY_CAT, "city_category"))
def rate_by_city_category(spark, sf):
    df = ledger(spark, sf, ["city_pop", "is_fraud"]).withColumn("city_category", fx.city_category("city_pop"))
    return R(rates.rate_by(df, "city_category"))


@register("rate_by_zip_missing", _rate_sql(with_ledger, "ledger", "merch_zipcode IS NULL", "zip_missing"))
def rate_by_zip_missing(spark, sf):
    df = ledger(spark, sf, ["merch_zipcode", "is_fraud"]).withColumn(
        "zip_missing", F.col("merch_zipcode").isNull())
    return R(rates.rate_by(df, "zip_missing"))


# ---------------------------------------------------------------- P13 + O2
@register("rate_by_job_min_volume", with_ledger("""
SELECT job, round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate, count(is_fraud) AS transaction_count
FROM ledger WHERE job IS NOT NULL GROUP BY job HAVING count(is_fraud) >= 500
ORDER BY avg(CAST(is_fraud AS DOUBLE)) DESC, job LIMIT 10"""))
def rate_by_job_min_volume(spark, sf):
    out = rates.rate_by(ledger(spark, sf, ["job", "is_fraud"]), "job", min_count=500)
    return R(rates.top_k(out, [F.col("fraud_rate").desc(), F.col("job")], 10))


# ---------------------------------------------------------------- F13 + J7
@register("rate_by_age_group", with_ledger(f"""
WITH dom(age_group, age_group_ord) AS (VALUES ('Underage (<=18)', 0), ('19–25', 1), ('26–35', 2),
  ('36–50', 3), ('50+', 4)),
g AS (SELECT {AGE_GROUP} AS age_group, count(is_fraud) AS n, sum(is_fraud) AS f FROM ledger GROUP BY 1)
SELECT dom.age_group, CAST(dom.age_group_ord AS INTEGER) AS age_group_ord,
  CAST(coalesce(g.n, 0) AS BIGINT) AS total_txn, CAST(coalesce(g.f, 0) AS BIGINT) AS fraud_txn,
  round(CAST(g.f AS DOUBLE) / g.n * 100, 6) AS fraud_rate_pct
FROM dom LEFT JOIN g ON dom.age_group = g.age_group"""), bench=True)
def rate_by_age_group(spark, sf):
    df = ledger(spark, sf, [TS, "dob", "is_fraud"]).withColumn(
        "age_group", fx.cut(fx.age_365(TS, "dob"), fx.AGE_BINS, fx.AGE_LABELS))
    dom = fx.bin_domain(spark, fx.AGE_LABELS, "age_group")
    out = rates.prevalence_by(df, "age_group", domain=dom, total_name="total_txn",
                              positive_name="fraud_txn", pct_name="fraud_rate_pct")
    return R(out)


# ---------------------------------------------------------------- G2
@register("monthly_prevalence", with_ledger(f"""
SELECT {MONTH} AS month, count(is_fraud) AS total_transactions,
  CAST(sum(is_fraud) AS BIGINT) AS fraud_transactions,
  round(CAST(sum(is_fraud) AS DOUBLE) / count(is_fraud) * 100, 6) AS fraud_pct
FROM ledger GROUP BY 1"""), bench=True)
def monthly_prevalence(spark, sf):
    df = ledger(spark, sf, [TS, "is_fraud"]).withColumn("month", fx.month_key(TS))
    return R(rates.prevalence_by(df, "month"))


# ---------------------------------------------------------------- G10 / P5
@register("label_share", with_ledger("""
SELECT CASE is_fraud WHEN 0 THEN 'Non-Fraud' WHEN 1 THEN 'Fraud' END AS transaction_type,
  count(*) AS transaction_count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS transaction_pct
FROM ledger WHERE is_fraud IS NOT NULL GROUP BY 1"""))
def label_share(spark, sf):
    names = F.create_map(F.lit(0), F.lit("Non-Fraud"), F.lit(1), F.lit("Fraud"))
    df = ledger(spark, sf, ["is_fraud"]).withColumn("transaction_type", names[F.col("is_fraud")])
    return R(rates.value_share(df, "transaction_type"))


for _col in ["category", "gender"]:
    register(f"{_col}_share", with_ledger(f"""
SELECT {_col}, count(*) AS transaction_count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS transaction_pct
FROM ledger WHERE {_col} IS NOT NULL GROUP BY 1"""))(
        (lambda c: lambda spark, sf: R(rates.value_share(ledger(spark, sf, [c]), c)))(_col))


# ---------------------------------------------------------------- G17 / W5 / W7
@register("monthly_merchant_counts", with_ledger(f"""
SELECT {MONTH} AS month, {CLEAN_MERCHANT} AS merchant, count(*) AS transaction_count
FROM ledger GROUP BY 1, 2"""))
def monthly_merchant_counts(spark, sf):
    df = ledger(spark, sf, [TS, "merchant"]).select(
        fx.month_key(TS).alias("month"), fx.clean_merchant("merchant").alias("merchant"))
    return rates.group_count(df, ["month", "merchant"]).orderBy("month", F.desc("transaction_count"), "merchant")


@register("top_merchant_monthly", with_ledger(f"""
WITH c AS (SELECT {MONTH} AS month, {CLEAN_MERCHANT} AS merchant, count(*) AS transaction_count
  FROM ledger GROUP BY 1, 2),
t AS (SELECT *, sum(transaction_count) OVER (PARTITION BY month) AS total_transactions,
  row_number() OVER (PARTITION BY month ORDER BY transaction_count DESC, merchant) AS rn FROM c)
SELECT month, merchant, transaction_count, CAST(total_transactions AS BIGINT) AS total_transactions,
  round(transaction_count * 100.0 / total_transactions, 6) AS transaction_pct FROM t WHERE rn = 1"""))
def top_merchant_monthly(spark, sf):
    df = ledger(spark, sf, [TS, "merchant"]).select(
        fx.month_key(TS).alias("month"), fx.clean_merchant("merchant").alias("merchant"))
    return R(rates.top_per_period(df, "month", "merchant"))


@register("monthly_gender_share", with_ledger(f"""
SELECT {MONTH} AS month, gender, count(*) AS transaction_count,
  CAST(sum(count(*)) OVER (PARTITION BY {MONTH}) AS BIGINT) AS period_total,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY {MONTH}), 6) AS pct
FROM ledger WHERE gender IS NOT NULL GROUP BY 1, 2"""))
def monthly_gender_share(spark, sf):
    df = ledger(spark, sf, [TS, "gender"]).withColumn("month", fx.month_key(TS))
    return R(rates.class_share_by_period(df, "month", "gender"))


@register("monthly_fraud_gender_share", with_ledger(f"""
SELECT {MONTH} AS month, gender, count(*) AS transaction_count,
  CAST(sum(count(*)) OVER (PARTITION BY {MONTH}) AS BIGINT) AS period_total,
  round(count(*) * 100.0 / sum(count(*)) OVER (PARTITION BY {MONTH}), 6) AS pct
FROM ledger WHERE is_fraud = 1 AND gender IS NOT NULL GROUP BY 1, 2"""))
def monthly_fraud_gender_share(spark, sf):
    df = ledger(spark, sf, [TS, "gender", "is_fraud"]).withColumn("month", fx.month_key(TS))
    return R(rates.class_share_by_period(df, "month", "gender", label="is_fraud"))


# ---------------------------------------------------------------- J5
@register("class_share_attached", with_ledger(f"""
WITH s AS (SELECT {MONTH} AS month, count(*) FILTER (WHERE gender = 'F') AS k, count(*) AS n
  FROM ledger WHERE gender IS NOT NULL GROUP BY 1),
r AS (SELECT trans_num, gender, {MONTH} AS month FROM ledger)
SELECT trans_num, gender, r.month AS month,
  CASE WHEN k > 0 THEN round(k * 100.0 / n, 6) END AS female_pct
FROM r LEFT JOIN s ON r.month IS NOT DISTINCT FROM s.month"""))
def class_share_attached(spark, sf):
    df = ledger(spark, sf, ["trans_num", TS, "gender"]).select("trans_num", "gender", fx.month_key(TS).alias("month"))
    return R(rates.with_class_share(df, "month", "gender", "F", name="female_pct"))


# ---------------------------------------------------------------- G5 / W1
@register("monthly_avg_amount", with_ledger(f"""
SELECT {MONTH} AS month, round(avg(amt), 6) AS avg_amt FROM ledger GROUP BY 1"""))
def monthly_avg_amount(spark, sf):
    df = ledger(spark, sf, [TS, "amt"]).withColumn("month", fx.month_key(TS))
    return R(df.groupBy("month").agg(F.avg("amt").alias("avg_amt")))


@register("monthly_age_change", with_ledger(f"""
WITH m AS (SELECT {MONTH} AS month, avg({AGE}) AS avg_user_age FROM ledger GROUP BY 1)
SELECT month, round(avg_user_age, 6) AS avg_user_age,
  round(avg_user_age - lag(avg_user_age) OVER (ORDER BY month), 6) AS avg_user_age_change FROM m"""))
def monthly_age_change(spark, sf):
    df = ledger(spark, sf, [TS, "dob"]).select(fx.month_key(TS).alias("month"), fx.age_365(TS, "dob").alias("age"))
    m = df.groupBy("month").agg(F.avg("age").alias("avg_user_age"))
    return R(rates.period_change(m, "month", "avg_user_age"))


# ---------------------------------------------------------------- G7 / G13 / G9
@register("merchant_ever_fraud", with_ledger(f"""
WITH m AS (SELECT {CLEAN_MERCHANT} AS merchant, max(is_fraud) AS ever_fraud FROM ledger
  WHERE merchant IS NOT NULL GROUP BY 1),
d AS (SELECT ever_fraud, count(*) AS merchant_count FROM m GROUP BY 1)
SELECT ever_fraud, merchant_count,
  CASE ever_fraud WHEN 0 THEN 'Never Experienced Fraud' WHEN 1 THEN 'Experienced Fraud' END AS status,
  round(merchant_count * 100.0 / sum(merchant_count) OVER (), 6) AS percentage FROM d"""))
def merchant_ever_fraud(spark, sf):
    df = ledger(spark, sf, ["merchant", "is_fraud"]).withColumn("merchant", fx.clean_merchant("merchant"))
    return R(rates.ever_flag(df, "merchant"))


@register("fraud_user_pct", with_ledger(f"""
SELECT count(DISTINCT {PROXY_USER}) AS users,
  count(DISTINCT CASE WHEN is_fraud = 1 THEN {PROXY_USER} END) AS fraud_users,
  round(count(DISTINCT CASE WHEN is_fraud = 1 THEN {PROXY_USER} END) * 100.0
        / count(DISTINCT {PROXY_USER}), 6) AS fraud_user_pct
FROM ledger"""))
def fraud_user_pct(spark, sf):
    df = ledger(spark, sf, ["first", "last", "gender", "city", "is_fraud"]).withColumn(
        "user_id", fx.proxy_user_id("first", "last", "gender", "city"))
    out = df.agg(F.countDistinct("user_id").alias("users"),
                 F.countDistinct(F.when(F.col("is_fraud") == 1, F.col("user_id"))).alias("fraud_users"))
    return R(out.withColumn("fraud_user_pct", rates.pct(F.col("fraud_users"), F.col("users"))))


@register("cards_per_user", with_ledger(f"""
WITH u AS (SELECT {PROXY_USER} AS user_id, count(DISTINCT cc_num) AS n_distinct FROM ledger GROUP BY 1)
SELECT n_distinct, count(*) AS entity_count FROM u GROUP BY 1"""))
def cards_per_user(spark, sf):
    df = ledger(spark, sf, ["first", "last", "gender", "city", "cc_num"]).withColumn(
        "user_id", fx.proxy_user_id("first", "last", "gender", "city"))
    return rates.distinct_count_distribution(df, "user_id", "cc_num")


# ---------------------------------------------------------------- G18
def _users(spark, sf, cols):
    base = ["first", "last", "gender", "city", TS, "trans_num"]
    df = ledger(spark, sf, base + [c for c in cols if c not in base]).withColumn(
        "user_id", fx.proxy_user_id("first", "last", "gender", "city"))
    return keys.keep_first(df, "user_id", [TS, "trans_num"], columns=["user_id", *cols])


_USER_FIRST = f"""WITH u AS (SELECT * FROM (SELECT {PROXY_USER} AS user_id, job, state, city,
  row_number() OVER (PARTITION BY {PROXY_USER} ORDER BY {TS}, trans_num) AS rn FROM ledger) WHERE rn = 1)"""


@register("job_distribution_top10", with_ledger(f"""{_USER_FIRST},
c AS (SELECT job, count(*) AS user_count FROM u WHERE job IS NOT NULL GROUP BY 1)
SELECT job, user_count, round(user_count * 100.0 / sum(user_count) OVER (), 6) AS user_pct FROM c
ORDER BY user_count DESC, job LIMIT 10"""))
def job_distribution_top10(spark, sf):
    u = _users(spark, sf, ["job"])
    return R(rates.value_share(u, "job", top=10, count_name="user_count", pct_name="user_pct"))


for _col, _name in [("state", "top_states"), ("city", "top_cities")]:
    register(_name, with_ledger(f"""{_USER_FIRST},
c AS (SELECT {_col}, count(*) AS user_count FROM u WHERE {_col} IS NOT NULL GROUP BY 1
  ORDER BY user_count DESC, {_col} LIMIT 5)
SELECT {_col}, user_count, round(user_count * 100.0 / sum(user_count) OVER (), 6) AS user_pct FROM c"""))(
        (lambda c: lambda spark, sf: R(rates.value_share(
            _users(spark, sf, [c]), c, top=5, denominator="shown",
            count_name="user_count", pct_name="user_pct")))(_col))


# ---------------------------------------------------------------- G12
@register("duplicate_keys", with_ledger("""
SELECT trans_num, count(*) AS row_count FROM ledger WHERE trans_num IS NOT NULL
GROUP BY 1 HAVING count(*) > 1"""))
def duplicate_keys(spark, sf):
    return rates.duplicate_keys(ledger(spark, sf, ["trans_num"]), "trans_num")


@register("duplicate_summary", with_ledger("""
WITH g AS (SELECT trans_num, count(*) AS n FROM ledger GROUP BY 1)
SELECT CAST(sum(n) AS BIGINT) AS total_rows, count(trans_num) AS distinct_keys,
  CAST(coalesce(sum(CASE WHEN n > 1 AND trans_num IS NOT NULL THEN n END), 0) AS BIGINT) AS duplicated_rows
FROM g"""))
def duplicate_summary(spark, sf):
    return rates.duplicate_summary(ledger(spark, sf, ["trans_num"]), "trans_num")


# ---------------------------------------------------------------- G14 / G15
_LABEL_SUMMARY = """SELECT is_fraud, count(amt) AS "count", round(avg(amt), 6) AS mean,
  round(quantile_cont(amt, 0.5), 6) AS median, round(quantile_cont(amt, 0.9), 6) AS p90,
  round(quantile_cont(amt, 0.99), 6) AS p99, round(max(amt), 6) AS "max"
FROM ledger WHERE is_fraud IS NOT NULL GROUP BY is_fraud"""


@register("amount_by_label", with_ledger(_LABEL_SUMMARY))
def amount_by_label(spark, sf):
    return R(rates.label_summary(ledger(spark, sf, ["amt", "is_fraud"]), "amt"))


@register("amount_by_label_distributed", with_ledger(_LABEL_SUMMARY), bench=True)
def amount_by_label_distributed(spark, sf):
    """G14 with exact quantiles computed by prefix counts (no per-label map)."""
    return R(rates.label_summary(ledger(spark, sf, ["amt", "is_fraud"]), "amt"))


@register("amount_class_ratio", with_ledger(f"""
WITH s AS (SELECT is_fraud, avg(amt) AS mean, quantile_cont(amt, 0.5) AS median,
  quantile_cont(amt, 0.9) AS p90, max(amt) AS "max" FROM ledger WHERE is_fraud IS NOT NULL GROUP BY 1),
u AS (SELECT is_fraud, stat, v FROM s UNPIVOT (v FOR stat IN (median, mean, p90, "max")))
SELECT p.stat, round(p.v, 6) AS positive_value, round(n.v, 6) AS negative_value,
  round(p.v / n.v, 6) AS ratio
FROM (SELECT * FROM u WHERE is_fraud = 1) p FULL JOIN (SELECT * FROM u WHERE is_fraud = 0) n
  ON p.stat = n.stat"""))
def amount_class_ratio(spark, sf):
    s = rates.label_summary(ledger(spark, sf, ["amt", "is_fraud"]), "amt")
    return R(rates.class_ratio(s))


# ---------------------------------------------------------------- G20 / G21 / G22
@register("dataset_kpis", with_ledger("""
SELECT count(*) AS total_rows, round(sum(amt), 2) AS total_amount, count(DISTINCT cc_num) AS entities,
  count(DISTINCT CASE WHEN is_fraud = 1 THEN cc_num END) AS entities_with_fraud,
  CAST(sum(is_fraud) AS BIGINT) AS fraud_rows, round(avg(CAST(is_fraud AS DOUBLE)) * 100, 6) AS fraud_rate_pct,
  round(count(DISTINCT CASE WHEN is_fraud = 1 THEN cc_num END) * 100.0 / count(DISTINCT cc_num), 6)
    AS entities_with_fraud_pct
FROM ledger"""))
def dataset_kpis(spark, sf):
    out = rates.scalar_kpis(ledger(spark, sf, ["amt", "cc_num", "is_fraud"]))
    return R(out.withColumn("total_amount", F.round("total_amount", 2)))


@register("fraud_share_by_hour", with_events(f"""
SELECT {HOUR} AS trans_hour, count(*) AS fraud_count,
  round(count(*) * 100.0 / sum(count(*)) OVER (), 6) AS fraud_share_pct
FROM ev WHERE is_fraud = 1 GROUP BY 1"""))
def fraud_share_by_hour(spark, sf):
    df = event_ledger(spark, sf, [TS, "is_fraud"]).filter(F.col("is_fraud") == 1).withColumn("trans_hour", F.hour(TS))
    return R(rates.value_share(df, "trans_hour", count_name="fraud_count", pct_name="fraud_share_pct"))


AMOUNT_BANDS = [0, 50, 100, 250, 500, 1000, float("inf")]
AMOUNT_LABELS = ["0-50", "50-100", "100-250", "250-500", "500-1000", "1000+"]


@register("rate_by_amount_band", with_events("""
SELECT CASE WHEN amt > 0 AND amt <= 50 THEN '0-50' WHEN amt > 50 AND amt <= 100 THEN '50-100'
  WHEN amt > 100 AND amt <= 250 THEN '100-250' WHEN amt > 250 AND amt <= 500 THEN '250-500'
  WHEN amt > 500 AND amt <= 1000 THEN '500-1000' WHEN amt > 1000 THEN '1000+' END AS amount_band,
  round(avg(CAST(is_fraud AS DOUBLE)), 6) AS fraud_rate, count(is_fraud) AS transaction_count
FROM ev GROUP BY 1 HAVING amount_band IS NOT NULL"""))
def rate_by_amount_band(spark, sf):
    df = event_ledger(spark, sf, ["amt", "is_fraud"]).withColumn(
        "amount_band", fx.cut("amt", AMOUNT_BANDS, AMOUNT_LABELS))
    return R(rates.rate_by(df, "amount_band"))


# ---------------------------------------------------------------- G11 / G8
@register("distinct_categories", with_ledger("""
SELECT category, count(DISTINCT cc_num) AS customers, count(DISTINCT replace(merchant, 'fraud_', '')) AS merchants
FROM ledger WHERE category IS NOT NULL GROUP BY category"""))
def distinct_categories(spark, sf):
    df = ledger(spark, sf, ["category", "cc_num", "merchant"]).withColumn("merchant", fx.clean_merchant("merchant"))
    return (df.filter(F.col("category").isNotNull()).groupBy("category")
              .agg(F.countDistinct("cc_num").alias("customers"), F.countDistinct("merchant").alias("merchants")))
