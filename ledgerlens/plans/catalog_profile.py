"""Registered queries: profiling and statistical tests."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import profile, rates, stats
from ledgerlens.plans.catalog_rates import AGE, HOUR, MONTH, TS
from ledgerlens.plans.registry import register, round_doubles, with_events, with_ledger
from ledgerlens.sources.bindings import RAW_COLUMNS, event_ledger, ledger

R = round_doubles

DIST = """round_even(3958.8 * 2 * asin(sqrt(least(1.0,
  power(sin((radians(merch_lat) - radians(lat)) / 2), 2)
  + cos(radians(lat)) * cos(radians(merch_lat)) * power(sin((radians(merch_long) - radians(long)) / 2), 2)))), 2)"""


def _univariate_sql(src: str, expr: str, name: str, full: bool, digits: int = 6) -> str:
    """DuckDB text of the univariate profile of one expression."""
    r = lambda e, d=digits: f"round({e}, {d})"
    outl = "" if not full else f""",
  {r('q1 - 1.5 * (q3 - q1)')} AS lower_bound, {r('q3 + 1.5 * (q3 - q1)')} AS upper_bound,
  (SELECT count(*) FROM x WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1)) AS outlier_count,
  round((SELECT count(*) FROM x WHERE value < q1 - 1.5 * (q3 - q1) OR value > q3 + 1.5 * (q3 - q1))
        / CAST("count" AS DOUBLE) * 100, 6) AS outlier_pct"""
    full_cols = "" if not full else f""", {r('"mode"')} AS "mode", {r('"max" - "min"')} AS "range",
  {r('variance', 2)} AS variance"""
    return f"""
WITH x AS (SELECT CAST({expr} AS DOUBLE) AS value FROM {src} WHERE {expr} IS NOT NULL),
mu AS (SELECT avg(value) AS m FROM x),
mo AS (SELECT value AS "mode" FROM x GROUP BY value ORDER BY count(*) DESC, value LIMIT 1),
s AS (SELECT count(value) AS "count", avg(value) AS mean, quantile_cont(value, 0.5) AS median,
    min(value) AS "min", max(value) AS "max", quantile_cont(value, 0.25) AS q1,
    quantile_cont(value, 0.75) AS q3, var_samp(value) AS variance, stddev_samp(value) AS std_dev,
    avg(power(value - mu.m, 3)) / power(avg(power(value - mu.m, 2)), 1.5) AS skewness,
    avg(power(value - mu.m, 4)) / power(avg(power(value - mu.m, 2)), 2) - 3 AS kurtosis
  FROM x, mu)
SELECT '{name}' AS "column", "count", {r('mean', 5)} AS mean, {r('median')} AS median, {r('"min"')} AS "min",
  {r('"max"')} AS "max", {r('q1')} AS q1, {r('q3')} AS q3, {r('q3 - q1')} AS iqr,
  {r('std_dev', 4)} AS std_dev, {r('skewness')} AS skewness, {r('kurtosis')} AS kurtosis{full_cols}{outl}
FROM s, mo"""


def _round_profile(df):
    """Oracle rounding: 6 decimals; fewer where sums of many rows meet
    (float summation order differs between engines)."""
    special = {"std_dev": 4, "variance": 2, "mean": 5}
    return df.select(*[F.round(c, special.get(c, 6)).alias(c)
                       if c not in ("column", "count", "outlier_count") else F.col(c) for c in df.columns])


@register("amount_univariate", with_events(_univariate_sql("ev", "amt", "amt", True)), bench=True)
def amount_univariate(spark, sf):
    df = event_ledger(spark, sf, ["amt"])
    return _round_profile(profile.univariate(df, ["amt"]))


@register("amount_univariate_distributed", with_events(_univariate_sql("ev", "amt", "amt", True)))
def amount_univariate_distributed(spark, sf):
    df = event_ledger(spark, sf, ["amt"])
    return _round_profile(profile.univariate(df, ["amt"]))


@register("distance_univariate", with_ledger(_univariate_sql("ledger", DIST, "distance_miles", False)))
def distance_univariate(spark, sf):
    df = ledger(spark, sf, ["lat", "long", "merch_lat", "merch_long"]).withColumn(
        "distance_miles", fx.haversine_miles("lat", "long", "merch_lat", "merch_long"))
    return _round_profile(profile.univariate(df, ["distance_miles"], stats=profile.SHORT_STATS))


@register("age_univariate", with_ledger(_univariate_sql("ledger", AGE, "age", False)))
def age_univariate(spark, sf):
    df = ledger(spark, sf, [TS, "dob"]).withColumn("age", fx.age_365(TS, "dob"))
    return _round_profile(profile.univariate(df, ["age"], stats=profile.SHORT_STATS))


# A2 over an aggregated table: the monthly mean age and its change
_MONTHLY_AGE = f"(SELECT {MONTH} AS month, avg({AGE}) AS v FROM ledger GROUP BY 1)"


def _monthly_age(spark, sf):
    df = ledger(spark, sf, [TS, "dob"]).select(fx.month_key(TS).alias("month"), fx.age_365(TS, "dob").alias("age"))
    return df.groupBy("month").agg(F.avg("age").alias("avg_user_age"))


@register("monthly_age_profile", with_ledger(_univariate_sql(f"{_MONTHLY_AGE} AS a", "v", "avg_user_age", False)))
def monthly_age_profile(spark, sf):
    return _round_profile(profile.univariate(_monthly_age(spark, sf), ["avg_user_age"], stats=profile.SHORT_STATS))


@register("monthly_age_change_profile", with_ledger(_univariate_sql(
    f"(SELECT v - lag(v) OVER (ORDER BY month) AS v FROM {_MONTHLY_AGE} AS a) AS b", "v", "avg_user_age_change", False)))
def monthly_age_change_profile(spark, sf):
    change = rates.period_change(_monthly_age(spark, sf), "month", "avg_user_age")
    return _round_profile(profile.univariate(change, ["avg_user_age_change"], stats=profile.SHORT_STATS))


@register("amount_log_univariate", with_events(_univariate_sql(
    "ev", "CASE WHEN amt > 0 THEN ln(1 + amt) END", "amt_log1p", False)))
def amount_log_univariate(spark, sf):
    df = event_ledger(spark, sf, ["amt"]).withColumn("amt_log1p", fx.positive_log1p("amt"))
    return _round_profile(profile.univariate(df, ["amt_log1p"], stats=profile.SHORT_STATS))


def _profile_sql(cols):
    parts = []
    for i, c in enumerate(cols):
        parts.append(f"""SELECT {i} AS position, '{c}' AS "column", count("{c}") AS non_null,
  count(*) - count("{c}") AS nulls, round((count(*) - count("{c}")) / CAST(count(*) AS DOUBLE) * 100, 6) AS null_pct
FROM ledger""")
    return "\nUNION ALL\n".join(parts)


_TYPES = {"trans_date_trans_time": "timestamp_ntz", "cc_num": "bigint", "amt": "double", "lat": "double",
          "long": "double", "city_pop": "bigint", "dob": "date", "merch_lat": "double",
          "merch_long": "double", "is_fraud": "int"}


@register("schema_profile", with_ledger(
    "SELECT CAST(position AS INTEGER) AS position, \"column\", CASE \"column\" "
    + " ".join(f"WHEN '{c}' THEN '{_TYPES.get(c, 'string')}'" for c in RAW_COLUMNS)
    + " END AS data_type, non_null, nulls, null_pct FROM (" + _profile_sql(RAW_COLUMNS) + ")"))
def schema_profile(spark, sf):
    return R(profile.schema_profile(ledger(spark, sf)))


@register("missing_rates", with_ledger("SELECT \"column\", nulls AS null_count, null_pct AS missing_pct FROM ("
                                       + _profile_sql(RAW_COLUMNS) + ")"))
def missing_rates(spark, sf):
    return R(profile.missing(ledger(spark, sf)))


@register("amount_histogram", with_events("""
WITH x AS (SELECT amt FROM ev WHERE amt IS NOT NULL AND amt < 500),
b AS (SELECT min(amt) AS lo, max(amt) AS hi FROM x),
c AS (SELECT CAST(least(floor((amt - lo) / ((hi - lo) / 100)), 99) AS INTEGER) AS bin, count(*) AS n
  FROM x, b GROUP BY 1),
d AS (SELECT CAST(range AS INTEGER) AS bin FROM range(100))
SELECT d.bin, round(lo + d.bin * ((hi - lo) / 100), 6) AS bin_start,
  round(lo + (d.bin + 1) * ((hi - lo) / 100), 6) AS bin_end, coalesce(c.n, 0) AS "count"
FROM d CROSS JOIN b LEFT JOIN c ON d.bin = c.bin"""))
def amount_histogram(spark, sf):
    df = event_ledger(spark, sf, ["amt"])
    return R(profile.histogram(df, "amt", 100, where=F.col("amt") < 500))


@register("amount_box_by_label", with_events("""
WITH f AS (SELECT is_fraud, quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.5) AS median,
    quantile_cont(amt, 0.75) AS q3 FROM ev WHERE amt IS NOT NULL GROUP BY 1),
g AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS lower_fence, q3 + 1.5 * (q3 - q1) AS upper_fence FROM f),
a AS (SELECT g.is_fraud, min(CASE WHEN amt BETWEEN lower_fence AND upper_fence THEN amt END) AS whisker_low,
    max(CASE WHEN amt BETWEEN lower_fence AND upper_fence THEN amt END) AS whisker_high,
    count(CASE WHEN NOT (amt BETWEEN lower_fence AND upper_fence) THEN 1 END) AS outlier_count,
    count(amt) AS "count"
  FROM ev JOIN g ON ev.is_fraud = g.is_fraud WHERE amt IS NOT NULL GROUP BY 1)
SELECT g.is_fraud, round(q1, 6) AS q1, round(median, 6) AS median, round(q3, 6) AS q3, round(iqr, 6) AS iqr,
  round(lower_fence, 6) AS lower_fence, round(upper_fence, 6) AS upper_fence,
  round(whisker_low, 6) AS whisker_low, round(whisker_high, 6) AS whisker_high, outlier_count, "count"
FROM g JOIN a ON g.is_fraud = a.is_fraud"""))
def amount_box_by_label(spark, sf):
    return R(profile.box_stats(event_ledger(spark, sf, ["amt", "is_fraud"]), "amt", by=["is_fraud"]))


@register("amount_percentiles", with_ledger("""
SELECT round(quantile_cont(amt, 0.25), 6) AS p25, round(quantile_cont(amt, 0.5), 6) AS p50,
  round(quantile_cont(amt, 0.75), 6) AS p75, round(quantile_cont(amt, 0.9), 6) AS p90 FROM ledger"""))
def amount_percentiles(spark, sf):
    return R(profile.percentile_set(ledger(spark, sf, ["amt"]), "amt"))


@register("amount_percentiles_distributed", with_ledger("""
SELECT round(quantile_cont(amt, 0.25), 6) AS p25, round(quantile_cont(amt, 0.5), 6) AS p50,
  round(quantile_cont(amt, 0.75), 6) AS p75, round(quantile_cont(amt, 0.9), 6) AS p90 FROM ledger"""))
def amount_percentiles_distributed(spark, sf):
    return R(profile.percentile_set(ledger(spark, sf, ["amt"]), "amt"))


@register("fraud_per_user_cv", with_ledger("""
WITH u AS (SELECT cc_num, count(*) AS n FROM ledger WHERE is_fraud = 1 GROUP BY 1)
SELECT round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std_dev,
  round(stddev_samp(n) / avg(n) * 100, 6) AS cv_pct FROM u"""))
def fraud_per_user_cv(spark, sf):
    df = ledger(spark, sf, ["cc_num", "is_fraud"]).filter(F.col("is_fraud") == 1)
    per = df.groupBy("cc_num").agg(F.count(F.lit(1)).alias("n"))
    return R(profile.coefficient_of_variation(per, "n"))


def _describe_sql(inner: str) -> str:
    return f"""WITH u AS ({inner})
SELECT 'n' AS "column", count(n) AS "count", round(avg(n), 6) AS mean, round(stddev_samp(n), 6) AS std,
  round(min(n), 6) AS "min", round(quantile_cont(n, 0.25), 6) AS p25, round(quantile_cont(n, 0.5), 6) AS p50,
  round(quantile_cont(n, 0.75), 6) AS p75, round(max(n), 6) AS "max" FROM u"""


@register("fraud_per_user_describe", with_ledger(_describe_sql(
    "SELECT cc_num, count(*) AS n FROM ledger WHERE is_fraud = 1 GROUP BY 1")))
def fraud_per_user_describe(spark, sf):
    df = ledger(spark, sf, ["cc_num", "is_fraud"]).filter(F.col("is_fraud") == 1)
    return R(profile.describe(df.groupBy("cc_num").agg(F.count(F.lit(1)).alias("n")), ["n"]))


@register("txn_per_user_describe", with_ledger(_describe_sql(
    "SELECT cc_num, count(*) AS n FROM ledger GROUP BY 1")))
def txn_per_user_describe(spark, sf):
    df = ledger(spark, sf, ["cc_num"])
    return R(profile.describe(df.groupBy("cc_num").agg(F.count(F.lit(1)).alias("n")), ["n"]))


@register("amount_iqr_filtered", with_events("""
WITH f AS (SELECT quantile_cont(amt, 0.25) AS q1, quantile_cont(amt, 0.75) AS q3 FROM ev WHERE amt IS NOT NULL)
SELECT trans_num, amt, is_fraud FROM ev, f
WHERE amt BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)"""))
def amount_iqr_filtered(spark, sf):
    return profile.iqr_filter(event_ledger(spark, sf, ["trans_num", "amt", "is_fraud"]), "amt")


@register("amount_p99_capped", with_events("""
SELECT trans_num, amt, is_fraud FROM ev WHERE amt <= (SELECT quantile_cont(amt, 0.99) FROM ev)"""))
def amount_p99_capped(spark, sf):
    return profile.percentile_cap(event_ledger(spark, sf, ["trans_num", "amt", "is_fraud"]), "amt", 0.99)


@register("period_filter", with_ledger(f"""
SELECT trans_num, CAST({TS} AS DATE) AS trans_date, amt, is_fraud FROM ledger
WHERE CAST({TS} AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1997-06-30'"""))
def period_filter(spark, sf):
    df = ledger(spark, sf, ["trans_num", TS, "amt", "is_fraud"]).withColumn("trans_date", fx.trans_date(TS))
    return (df.filter(F.col("trans_date").between(F.lit("1996-01-01").cast("date"), F.lit("1997-06-30").cast("date")))
              .select("trans_num", "trans_date", "amt", "is_fraud"))


# ---------------------------------------------------------------- A9 / A10 / A13
def _mw_sql(src: str, expr: str) -> str:
    return f"""
WITH x AS (SELECT CAST({expr} AS DOUBLE) AS v, is_fraud FROM {src} WHERE {expr} IS NOT NULL AND is_fraud IS NOT NULL),
g AS (SELECT v, count(*) AS t, count(CASE WHEN is_fraud = 1 THEN 1 END) AS t1 FROM x GROUP BY v),
r AS (SELECT *, sum(t) OVER (ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - t + (t + 1) / 2.0 AS rk FROM g),
s AS (SELECT sum(rk * t1) AS rank_sum_1, CAST(sum(t1) AS DOUBLE) AS n1, CAST(sum(t) AS DOUBLE) AS n,
  sum(CAST(t AS DOUBLE) * t * t - t) AS ties FROM r)
SELECT CAST(n - n1 AS BIGINT) AS n2, CAST(n1 AS BIGINT) AS n1, round(rank_sum_1, 4) AS rank_sum_1,
  round(rank_sum_1 - n1 * (n1 + 1) / 2, 4) AS u_statistic,
  round((greatest(rank_sum_1 - n1 * (n1 + 1) / 2, n1 * (n - n1) - (rank_sum_1 - n1 * (n1 + 1) / 2))
     - n1 * (n - n1) / 2 - 0.5) / sqrt(n1 * (n - n1) / 12 * ((n + 1) - ties / (n * (n - 1)))), 6) AS z_score
FROM s"""


def _mw_round(df):
    return df.select(*[F.round(c, 4).alias(c) if c in ("rank_sum_1", "u_statistic")
                       else F.round(c, 6).alias(c) if c == "z_score" else F.col(c) for c in df.columns])


@register("mannwhitney_amount", with_events(_mw_sql("ev", "amt")))
def mannwhitney_amount(spark, sf):
    return _mw_round(stats.rank_sum_stats(event_ledger(spark, sf, ["amt", "is_fraud"]), "amt", "is_fraud"))


@register("mannwhitney_distance", with_ledger(_mw_sql("ledger", DIST)))
def mannwhitney_distance(spark, sf):
    df = ledger(spark, sf, ["lat", "long", "merch_lat", "merch_long", "is_fraud"]).withColumn(
        "distance_miles", fx.haversine_miles("lat", "long", "merch_lat", "merch_long"))
    return _mw_round(stats.rank_sum_stats(df, "distance_miles", "is_fraud"))


# 2·P(Z > z) as one minus Simpson's integral of the density over 20,000 steps
def _normal_p_sql(z: str) -> str:
    return f"""(SELECT 1 - sum(CASE WHEN i IN (0, 20000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
  * exp(-power(h * i, 2) / 2)) * any_value(h) / 3 * 2 / sqrt(2 * pi())
  FROM (SELECT abs({z}) / 20000 AS h) CROSS JOIN range(0, 20001) g(i))"""


def _p_round(df):
    return _mw_round(df).withColumn("p_value", F.round("p_value", 8))


@register("mannwhitney_amount_test", with_events(f"""WITH mw AS ({_mw_sql("ev", "amt").replace("), 6) AS z_score", "), 12) AS z_score")})
SELECT n2, n1, rank_sum_1, u_statistic, round(z_score, 6) AS z_score, round(p, 8) AS p_value,
  'asymptotic' AS method, p < 0.05 AS significant FROM (SELECT *, {_normal_p_sql("(SELECT z_score FROM mw)")} AS p FROM mw)"""))
def mannwhitney_amount_test(spark, sf):
    return _p_round(stats.mann_whitney_u(event_ledger(spark, sf, ["amt", "is_fraud"]), "amt"))


# exact p: the oracle lists every choice of ranks of the smaller group
_QUARTERS = f"""q AS (SELECT date_trunc('quarter', {TS}) AS quarter, avg(amt) AS v,
  CAST(any_value(quarter({TS})) = 1 AS INTEGER) AS y FROM ledger GROUP BY 1),
r AS (SELECT y, row_number() OVER (ORDER BY v) AS rk FROM q),
s AS (SELECT count(*) AS n, sum(y) AS n1, sum(rk * y) AS r1, sum(rk * y) - sum(y) * (sum(y) + 1) / 2 AS u FROM r),
c AS (SELECT 0 AS last, 0 AS k, 0 AS total UNION ALL
  SELECT p, k + 1, total + p FROM c, range(1, (SELECT n + 1 FROM s)) g(p) WHERE p > last AND k < (SELECT n1 FROM s)),
e AS (SELECT total - n1 * (n1 + 1) / 2 AS w, greatest(u, n1 * (n - n1) - u) AS big FROM c, s WHERE k = n1)"""


@register("mannwhitney_quarter_exact", with_ledger(f"""WITH {_QUARTERS}
SELECT CAST(n1 AS BIGINT) AS n1, CAST(n - n1 AS BIGINT) AS n2, CAST(u AS DOUBLE) AS u_statistic,
  round(least(1, p), 8) AS p_value, 'exact' AS method, p < 0.05 AS significant
FROM s, (SELECT 2 * avg(CASE WHEN w >= big THEN 1.0 ELSE 0.0 END) AS p FROM e)""").replace("WITH", "WITH RECURSIVE", 1))
def mannwhitney_quarter_exact(spark, sf):
    """Do first quarters have other mean amounts than the rest of the year? A
    handful of quarters on each side, so p is counted."""
    q = ledger(spark, sf, [TS, "amt"]).groupBy(F.date_trunc("quarter", TS).alias("quarter")).agg(F.avg("amt").alias("v"))
    q = q.withColumn("is_fraud", (F.quarter("quarter") == 1).cast("int"))
    out = stats.mann_whitney_u(q, "v").withColumns({"n1": F.col("n1").cast("long"), "n2": F.col("n2").cast("long")})
    return _p_round(out.drop("rank_sum_1", "z_score"))


# ---------------------------------------------------------------- A11 / A14
def _spearman_sql(pairs):
    parts = []
    for a_expr, a_name in pairs:
        parts.append(f"""SELECT '{a_name}' AS column_a, 'is_fraud' AS column_b, count(*) AS n,
  round(corr(ra, rb), 6) AS rho FROM (
  SELECT rank() OVER (ORDER BY a) + (count(*) OVER (PARTITION BY a) - 1) / 2.0 AS ra,
         rank() OVER (ORDER BY b) + (count(*) OVER (PARTITION BY b) - 1) / 2.0 AS rb
  FROM (SELECT CAST({a_expr} AS DOUBLE) AS a, CAST(is_fraud AS DOUBLE) AS b FROM ev
        WHERE {a_expr} IS NOT NULL AND is_fraud IS NOT NULL))""")
    return "\nUNION ALL\n".join(parts)


@register("spearman_features", with_events(_spearman_sql([(AGE, "age"), (HOUR, "trans_hour"), ("amt", "amt")])))
def spearman_features(spark, sf):
    df = event_ledger(spark, sf, [TS, "dob", "amt", "is_fraud"]).withColumns(
        {"age": fx.age_365(TS, "dob"), "trans_hour": F.hour(TS)})
    return R(stats.spearman(df, [("age", "is_fraud"), ("trans_hour", "is_fraud"), ("amt", "is_fraud")]))


# ---------------------------------------------------------------- G16 / A12
@register("crosstab_gender", with_ledger("""
SELECT gender, count(CASE WHEN is_fraud = 0 THEN 1 END) AS "0", count(CASE WHEN is_fraud = 1 THEN 1 END) AS "1"
FROM ledger WHERE gender IS NOT NULL AND is_fraud IS NOT NULL GROUP BY gender"""))
def crosstab_gender(spark, sf):
    return stats.crosstab(ledger(spark, sf, ["gender", "is_fraud"]), "gender", "is_fraud", [0, 1])


_CHI_CELLS = """WITH o AS (SELECT gender, is_fraud, count(*) AS observed FROM ledger
    WHERE gender IS NOT NULL AND is_fraud IS NOT NULL GROUP BY 1, 2),
cells AS (SELECT g.gender, v.is_fraud, coalesce(o.observed, 0) AS observed
  FROM (SELECT DISTINCT gender FROM o) g CROSS JOIN (VALUES (0), (1)) v(is_fraud)
  LEFT JOIN o ON o.gender = g.gender AND o.is_fraud = v.is_fraud),
e AS (SELECT *, sum(observed) OVER (PARTITION BY gender) AS row_total,
  sum(observed) OVER (PARTITION BY is_fraud) AS col_total, sum(observed) OVER () AS n FROM cells)"""


@register("chi2_gender_expected", with_ledger(f"""{_CHI_CELLS}
SELECT gender, CAST(is_fraud AS INTEGER) AS is_fraud, CAST(observed AS BIGINT) AS observed,
  CAST(row_total AS BIGINT) AS row_total, CAST(col_total AS BIGINT) AS col_total,
  round(CAST(row_total * col_total AS DOUBLE) / n, 6) AS expected FROM e"""))
def chi2_gender_expected(spark, sf):
    return R(stats.contingency_long(ledger(spark, sf, ["gender", "is_fraud"]), "gender", "is_fraud", [0, 1]))


@register("chi2_gender", with_ledger(f"""{_CHI_CELLS}
SELECT round(sum(power(greatest(abs(observed - CAST(row_total * col_total AS DOUBLE) / n) - 0.5, 0), 2)
  / (CAST(row_total * col_total AS DOUBLE) / n)), 6) AS chi2,
  CAST((count(DISTINCT gender) - 1) * (count(DISTINCT is_fraud) - 1) AS INTEGER) AS dof,
  CAST(sum(observed) AS BIGINT) AS n FROM e"""))
def chi2_gender(spark, sf):
    out = stats.chi2_independence(ledger(spark, sf, ["gender", "is_fraud"]), "gender", "is_fraud", [0, 1])
    return R(out.drop("p_value"))


@register("chi2_gender_test", with_ledger(f"""{_CHI_CELLS},
x AS (SELECT sum(power(greatest(abs(observed - CAST(row_total * col_total AS DOUBLE) / n) - 0.5, 0), 2)
  / (CAST(row_total * col_total AS DOUBLE) / n)) AS chi2,
  CAST((count(DISTINCT gender) - 1) * (count(DISTINCT is_fraud) - 1) AS INTEGER) AS dof,
  CAST(sum(observed) AS BIGINT) AS n FROM e)
SELECT round(chi2, 6) AS chi2, dof, n, round({_normal_p_sql("(SELECT sqrt(chi2) FROM x)")}, 8) AS p_value FROM x"""))
def chi2_gender_test(spark, sf):
    out = stats.chi2_independence(ledger(spark, sf, ["gender", "is_fraud"]), "gender", "is_fraud", [0, 1])
    return R(out, 8).withColumn("chi2", F.round("chi2", 6))
