"""Tail functions as Column expressions and exact p-values, against plain Python."""

import itertools
import math

import pytest
from pyspark.sql import functions as F

from ledgerlens.functions import special as sp
from ledgerlens.operators import stats


def test_erfc_and_lgamma(spark):
    xs = [-6.0, -2.0, -0.5, 0.0, 1e-9, 0.3, 1.0, 1.999999, 2.0, 2.1, 3.5, 6.0, 12.0, 27.5]
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for r in df.select("x", sp.erfc(F.col("x")).alias("y")).collect():
        assert r.y == pytest.approx(math.erfc(r.x), rel=2e-12, abs=1e-300)
    gs = [(a,) for a in (0.5, 1.0, 1.5, 2.0, 7.5, 40.0, 1e3, 1e6)]
    for r in spark.createDataFrame(gs, "a double").select("a", sp.lgamma(F.col("a")).alias("y")).collect():
        assert r.y == pytest.approx(math.lgamma(r.a), rel=1e-13, abs=2e-12)


def test_chi2_survival_over_its_range(spark):
    cases = [(x, dof) for dof in (1, 2, 3, 10, 57, 400, 20_000, 2_000_000, 2_100_000)
             for x in (0.0, 1e-3, dof * .5, dof * .97, float(dof), dof + 1.9, dof + 2.1, dof * 1.03, dof * 2.0)]
    df = spark.createDataFrame([(float(x), float(d)) for x, d in cases], "x double, d double")
    for r in df.select("x", "d", sp.chi2_sf(F.col("x"), F.col("d")).alias("p")).collect():
        assert r.p == pytest.approx(sp.chi2_sf_value(r.x, r.d), rel=1e-7, abs=1e-11), (r.x, r.d)


def test_tails_of_null_and_nan(spark):
    df = spark.createDataFrame([(None, 1.0), (1.0, None), (float("nan"), 1.0), (-1.0, 1.0)], "x double, d double")
    p = [r.p for r in df.select(sp.chi2_sf(F.col("x"), F.col("d")).alias("p")).collect()]
    assert p[:2] == [None, None] and all(math.isnan(v) for v in p[2:])
    assert spark.createDataFrame([(None,)], "z double").select(sp.normal_two_sided_p(F.col("z"))).first()[0] is None


def _exact(a, b):
    """Two-sided p by listing every choice of ranks."""
    u = lambda g, rest: sum(x > y for x in g for y in rest)
    big = max(u(a, b), len(a) * len(b) - u(a, b))
    n, m = len(a) + len(b), len(a)
    us = [sum(c) - m * (m + 1) // 2 for c in itertools.combinations(range(1, n + 1), m)]
    return min(1.0, 2 * sum(v >= big for v in us) / len(us))


@pytest.mark.parametrize("n1,n2", [(1, 1), (1, 6), (3, 4), (5, 2), (8, 8), (4, 11)])
def test_exact_p_equals_enumeration(spark, n1, n2):
    vals = [(i * 37) % 101 + i / 1000 for i in range(n1 + n2)]
    df = spark.createDataFrame([(v, int(i < n1)) for i, v in enumerate(vals)], "x double, is_fraud int")
    r = stats.mann_whitney_u(df, "x").first()
    assert r["method"] == "exact" and r["p_value"] == pytest.approx(_exact(vals[:n1], vals[n1:]), rel=1e-12)


def test_counts_stay_exact_at_the_limits(spark):
    m, n = stats.EXACT_SMALL, stats.EXACT_LARGE
    p = spark.range(1).select(stats.exact_u_p(F.lit(m), F.lit(n), F.lit(m * n)).alias("p")).first()["p"]
    assert p == pytest.approx(2 / math.comb(m + n, m), rel=1e-12)


def test_ties_sizes_and_empty_groups_take_the_normal_form(spark):
    make = lambda rows: stats.mann_whitney_u(spark.createDataFrame(rows, "x double, is_fraud int"), "x").first()
    assert make([(1.0, 0), (1.0, 1), (2.0, 0)])["method"] == "asymptotic"
    many = make([(float(i), i % 2) for i in range(40)])
    assert many["method"] == "asymptotic"
    assert many["p_value"] == pytest.approx(math.erfc(many["z_score"] / math.sqrt(2)), rel=1e-12)
    one = make([(1.0, 0), (2.0, 0)])
    assert one["p_value"] is None and one["significant"] is None
