"""Rule analytics: budget curves, rule evaluation, comparison and risk tiers
(R1–R11, W2–W4).

A budget curve answers "if we verify every transaction of the first k key
values, how much fraud do we catch and how many legitimate rows do we
bother?". It is an aggregate per key value followed by running totals over
the key order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.keys import running_sum_global
from ledgerlens.operators.rates import pct

# Fixed values of the reference rules.
AGE_RULE = (61, 95)          # R8: verify customers aged 61..95
NIGHT_RULE = (22, 23)        # R9: verify transactions between 22:00 and 23:59
HIGH_RISK, MEDIUM_RISK, LOW_RISK = "HIGH_RISK", "MEDIUM_RISK", "LOW_RISK"


def key_summary(df: DataFrame, key: str, label: str = "is_fraud", *,
                count_name: str = "total_users") -> DataFrame:
    """Rows and positives per key value (nulls dropped)."""
    return (df.filter(F.col(key).isNotNull())
              .groupBy(key).agg(F.count(label).alias(count_name),
                                F.sum(F.col(label).cast("bigint")).alias("fraud_count")))


def budget_curve(df: DataFrame, key: str, label: str = "is_fraud", *, direction: str = "asc",
                 count_name: str = "total_users", bounded_key: bool = True) -> DataFrame:
    """Cumulative fraud and legitimate coverage along ``key``.

    ``direction='asc'`` accumulates from the smallest key value (W2),
    ``'desc'`` from the largest (W3); rows stay in ascending key order.

    ``bounded_key=True`` states that the key has a small domain (age, hour):
    the aggregated table then has at most that many rows and the running
    totals are plain ordered windows over it. For a key of unbounded
    cardinality pass ``False`` and the running totals use the range-partition
    prefix method, with whole-table totals as scalar subqueries."""
    if direction not in ("asc", "desc"):
        raise ValueError("direction must be 'asc' or 'desc'")
    s = key_summary(df, key, label, count_name=count_name).withColumn(
        "user_validated", F.col(count_name) - F.col("fraud_count"))
    rev = direction == "desc"
    cum_cols = {"fraud_count": "fraud_cumsum", count_name: f"{count_name}_cumsum",
                "user_validated": "user_validated_cumsum"}
    if bounded_key:
        o = Window.orderBy(key)
        frame = o.rowsBetween(0, Window.unboundedFollowing) if rev else \
            o.rowsBetween(Window.unboundedPreceding, 0)
        whole = Window.partitionBy()
        s = s.withColumns({dst: F.sum(src).over(frame) for src, dst in cum_cols.items()})
        s = s.withColumns({"_F": F.sum("fraud_count").over(whole),
                           "_N": F.sum(count_name).over(whole),
                           "_V": F.sum("user_validated").over(whole)})
    else:
        for src, dst in cum_cols.items():
            s = running_sum_global(s, [key], src, dst, reverse=rev)
        s = s.withColumns({"_F": s.agg(F.sum("fraud_count")).scalar(),
                           "_N": s.agg(F.sum(count_name)).scalar(),
                           "_V": s.agg(F.sum("user_validated")).scalar()})
    s = s.withColumns({
        "fraud_handled_cumsum": F.col("fraud_cumsum"),
        "fraud_cumsum_pct": pct(F.col("fraud_cumsum"), F.col("_F")),
        "fraud_handled_cumsum_pct": pct(F.col("fraud_cumsum"), F.col("_F")),
        "user_validated_cumsum_pct": pct(F.col("user_validated_cumsum"), F.col("_V")),
        # fixed formula of the reference: (F - cumF) * 100 / (N - cumF)
        "actual_fraud_rate": F.try_divide((F.col("_F") - F.col("fraud_cumsum")) * 100,
                                          F.col("_N") - F.col("fraud_cumsum")),
    })
    return s.drop("_F", "_N", "_V")


def past_threshold(curve: DataFrame, threshold: float = 19.0,
                   col: str = "user_validated_cumsum_pct") -> DataFrame:
    """Curve rows whose coverage is above ``threshold`` percent."""
    return curve.filter(F.col(col) > threshold)


def nearest_budget(curve: DataFrame, key: str, target_pct: float = 20.0,
                   col: str = "user_validated_cumsum_pct") -> DataFrame:
    """The curve row whose coverage is closest to the budget (first key on ties)."""
    return curve.orderBy(F.abs(F.col(col) - F.lit(float(target_pct))), F.col(key)).limit(1)


def base_rate(df: DataFrame, label: str = "is_fraud") -> Column:
    """Overall positive rate in percent, as a scalar subquery."""
    return df.agg(F.avg(F.col(label).cast("double")) * 100).scalar()


def compare_rules(df: DataFrame, picks: dict[str, DataFrame], *, label: str = "is_fraud",
                  mixed_name: str | None = None) -> DataFrame:
    """Coverage, rate after, reduction and uplift for chosen curve rows.

    ``picks`` maps a rule name to a one-row curve (e.g. ``nearest_budget``).
    With ``mixed_name`` a last rule spends half of the budget on each of the
    first two picks: its coverage and reduction are the averages."""
    rows = None
    for i, (name, one) in enumerate(picks.items()):
        r = one.select(F.lit(name).alias("rule"), F.lit(i).alias("rule_ord"),
                       F.col("user_validated_cumsum_pct").alias("coverage_pct"),
                       F.col("actual_fraud_rate").alias("fraud_rate_after"))
        rows = r if rows is None else rows.unionByName(r)
    base = base_rate(df, label)
    rows = rows.withColumn("base_fraud_rate", base)
    if mixed_name:
        mixed = rows.filter(F.col("rule_ord") < 2).agg(
            F.lit(mixed_name).alias("rule"), F.lit(len(picks)).alias("rule_ord"),
            F.avg("coverage_pct").alias("coverage_pct"),
            F.avg("fraud_rate_after").alias("fraud_rate_after"),
            F.first("base_fraud_rate").alias("base_fraud_rate"))
        rows = rows.unionByName(mixed)
    return rows.withColumns({
        "fraud_reduction": F.col("base_fraud_rate") - F.col("fraud_rate_after"),
        "fraud_uplift_pct": F.try_divide(F.col("base_fraud_rate") - F.col("fraud_rate_after"),
                                         F.col("base_fraud_rate")) * 100,
    })


def evaluate_rule(df: DataFrame, predicate: Column, label: str = "is_fraud") -> DataFrame:
    """Share of all fraud the rule flags and share of legitimate rows it
    bothers, in one aggregate over any predicate."""
    y = F.col(label).cast("bigint")
    hit = F.coalesce(predicate, F.lit(False))
    out = df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(y).alias("total_fraud"),
        F.count(F.when(hit, 1)).alias("flagged_rows"),
        F.coalesce(F.sum(F.when(hit, y)), F.lit(0).cast("bigint")).alias("flagged_fraud"),
    )
    return out.withColumns({
        "fraud_captured_pct": pct(F.col("flagged_fraud"), F.col("total_fraud")),
        "legit_impacted_pct": pct(F.col("flagged_rows") - F.col("flagged_fraud"),
                                  F.col("total_rows") - F.col("total_fraud")),
        "coverage_pct": pct(F.col("flagged_rows"), F.col("total_rows")),
    })


def age_rule(age, lo: int = AGE_RULE[0], hi: int = AGE_RULE[1]) -> Column:
    """R8."""
    return (F.col(age) if isinstance(age, str) else age).between(lo, hi)


def night_rule(hour, lo: int = NIGHT_RULE[0], hi: int = NIGHT_RULE[1]) -> Column:
    """R9."""
    return (F.col(hour) if isinstance(hour, str) else hour).between(lo, hi)


def risk_tier(age, hour, *, min_age: int = AGE_RULE[0]) -> Column:
    """Both signals HIGH_RISK, one MEDIUM_RISK, none LOW_RISK; with the
    trigger flag. Returns struct(trigger boolean, tier string)."""
    a = F.coalesce((F.col(age) if isinstance(age, str) else age) >= min_age, F.lit(False))
    t = F.coalesce(night_rule(hour), F.lit(False))
    tier = F.when(a & t, F.lit(HIGH_RISK)).when(a | t, F.lit(MEDIUM_RISK)).otherwise(F.lit(LOW_RISK))
    return F.struct((a | t).alias("trigger"), tier.alias("tier"))


def tier_evaluation(df: DataFrame, tier_col: str = "tier", label: str = "is_fraud") -> DataFrame:
    """R10 + R7 per tier: rows, fraud, fraud share captured and legitimate
    share impacted for each tier."""
    y = F.col(label).cast("bigint")
    per = df.groupBy(tier_col).agg(F.count(F.lit(1)).alias("rows"), F.sum(y).alias("fraud_rows"))
    tot = df.agg(F.count(F.lit(1)).alias("n"), F.sum(y).alias("f"))
    n, f = tot.select("n").scalar(), tot.select("f").scalar()
    return per.withColumns({
        "fraud_captured_pct": pct(F.col("fraud_rows"), f),
        "legit_impacted_pct": pct(F.col("rows") - F.col("fraud_rows"), n - f),
        "fraud_rate_pct": pct(F.col("fraud_rows"), F.col("rows")),
    })
