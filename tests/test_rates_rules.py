from pyspark.sql import functions as F

from ledgerlens.operators import rates, rules


def test_null_keys_dropped(spark):
    df = spark.createDataFrame([("a", 1), ("a", 0), ("b", 1), (None, 1)], "k string, y int")
    got = {r["k"]: (r["fraud_rate"], r["transaction_count"]) for r in rates.rate_by(df, "k", "y").collect()}
    assert got == {"a": (0.5, 2), "b": (1.0, 1)}


def test_value_share_denominators(spark):
    df = spark.createDataFrame([(k,) for k in "aaaabbbccd"], "k string")
    allp = {r["k"]: r["transaction_pct"] for r in rates.value_share(df, "k", top=2).collect()}
    shown = {r["k"]: r["transaction_pct"] for r in rates.value_share(df, "k", top=2, denominator="shown").collect()}
    assert allp == {"a": 40.0, "b": 30.0}
    assert round(shown["a"], 6) == round(400 / 7, 6) and round(sum(shown.values()), 9) == 100.0


def test_domain_reports_empty_bins(spark):
    df = spark.createDataFrame([("x", 1)], "g string, y int")
    dom = spark.createDataFrame([("x",), ("z",)], "g string")
    got = {r["g"]: (r["total_transactions"], r["fraud_pct"]) for r in rates.prevalence_by(df, "g", "y", domain=dom).collect()}
    assert got == {"x": (1, 100.0), "z": (0, None)}


def _curve_input(spark):
    rows = []
    for age, n, f in [(20, 10, 2), (30, 20, 1), (40, 30, 0), (50, 40, 3)]:
        rows += [(age, 1)] * f + [(age, 0)] * (n - f)
    return spark.createDataFrame(rows, "age int, is_fraud int")


def test_budget_curve_by_hand(spark):
    df = _curve_input(spark)
    asc = {r["age"]: r for r in rules.budget_curve(df, "age").collect()}
    assert asc[20]["fraud_cumsum"] == 2 and asc[30]["total_users_cumsum"] == 30
    assert abs(asc[20]["user_validated_cumsum_pct"] - 8 / 94 * 100) < 1e-9
    assert abs(asc[30]["actual_fraud_rate"] - (6 - 3) * 100 / (100 - 3)) < 1e-9
    assert asc[50]["fraud_cumsum_pct"] == 100.0
    desc = {r["age"]: r for r in rules.budget_curve(df, "age", direction="desc").collect()}
    for a in (20, 30, 40, 50):  # forward + reverse - own = total
        assert asc[a]["fraud_cumsum"] + desc[a]["fraud_cumsum"] - asc[a]["fraud_count"] == 6


def test_budget_curve_unbounded_key_path_matches(spark):
    df = _curve_input(spark)
    a = sorted(tuple(r) for r in rules.budget_curve(df, "age").collect())
    b = sorted(tuple(r) for r in rules.budget_curve(df, "age", bounded_key=False).select(
        *rules.budget_curve(df, "age").columns).collect())
    assert a == b


def test_risk_tiers(spark):
    df = spark.createDataFrame([(61, 22), (61, 10), (40, 23), (40, 10)], "age int, h int")
    got = [tuple(r[0]) for r in df.select(rules.risk_tier("age", "h")).collect()]
    assert got == [(True, "HIGH_RISK"), (True, "MEDIUM_RISK"), (True, "MEDIUM_RISK"), (False, "LOW_RISK")]


def test_evaluate_rule(spark):
    df = spark.createDataFrame([(22, 1), (23, 0), (10, 1), (10, 0)], "h int, is_fraud int")
    r = rules.evaluate_rule(df, F.col("h").between(22, 23)).first()
    assert r["fraud_captured_pct"] == 50.0 and r["legit_impacted_pct"] == 50.0
