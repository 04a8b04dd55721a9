import math

import numpy as np
import pandas as pd
from pyspark.sql import functions as F

from ledgerlens.functions.special import chi2_sf_value
from ledgerlens.operators import profile, stats


def test_moments_fixture(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, 10.0]], "x double")
    r = profile.univariate(df, ["x"]).first()
    assert round(r["skewness"], 10) == 1.0182337649
    assert round(r["kurtosis"], 4) == -0.7696
    assert round(r["variance"], 4) == 16.6667
    assert r["q1"] == 1.75 and r["median"] == 2.5


def test_mode_smallest_tie(spark):
    df = spark.createDataFrame([(v,) for v in [3.0, 1.0, 1.0, 3.0, 2.0]], "x double")
    assert profile.univariate(df, ["x"]).first()["mode"] == 1.0


def test_histogram_last_bin_closed(spark):
    df = spark.createDataFrame([(float(v),) for v in range(11)], "x double")
    h = {r["bin"]: r["count"] for r in profile.histogram(df, "x", 5).collect()}
    assert h == {0: 2, 1: 2, 2: 2, 3: 2, 4: 3}


def test_iqr_filter_and_cap(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 2, 3, 4, 100]], "x double")
    assert sorted(r[0] for r in profile.iqr_filter(df, "x").collect()) == [1.0, 2.0, 3.0, 4.0]
    assert profile.percentile_cap(df, "x", 0.5).count() == 3


def _mw_brute(x, y):
    allv = np.concatenate([x, y])
    ranks = pd.Series(allv).rank(method="average").to_numpy()
    n1, n2 = len(x), len(y)
    u1 = ranks[:n1].sum() - n1 * (n1 + 1) / 2
    _, t = np.unique(allv, return_counts=True)
    n = n1 + n2
    sigma = math.sqrt(n1 * n2 / 12 * ((n + 1) - (t ** 3 - t).sum() / (n * (n - 1))))
    z = (max(u1, n1 * n2 - u1) - n1 * n2 / 2 - 0.5) / sigma
    return u1, min(1.0, math.erfc(z / math.sqrt(2)))


def test_mann_whitney_brute_force(spark):
    rng = np.random.default_rng(7)
    x = np.round(rng.normal(5, 2, 60), 1)
    y = np.round(rng.normal(4, 2, 90), 1)
    rows = [(float(v), 1) for v in x] + [(float(v), 0) for v in y]
    df = spark.createDataFrame(rows, "v double, y int")
    r = stats.mann_whitney_u(df, "v", "y").first()
    u, p = _mw_brute(x, y)
    assert abs(r["u_statistic"] - u) < 1e-6 and abs(r["p_value"] - p) < 1e-9
    assert r["significant"] == (p < 0.05)


def test_spearman_matches_pandas(spark):
    rng = np.random.default_rng(3)
    a = rng.integers(0, 10, 200).astype(float)
    b = a + rng.integers(0, 5, 200)
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    rho = stats.spearman(df, [("a", "b")]).first()["rho"]
    ra, rb = pd.Series(a).rank(), pd.Series(b).rank()   # average ranks, then Pearson
    assert abs(rho - float(np.corrcoef(ra, rb)[0, 1])) < 1e-12


def test_chi2_two_by_two_yates(spark):
    obs = {("F", 0): 30, ("F", 1): 10, ("M", 0): 20, ("M", 1): 20}
    rows = [(g, y) for (g, y), n in obs.items() for _ in range(n)]
    df = spark.createDataFrame(rows, "g string, y int")
    r = stats.chi2_independence(df, "g", "y", [0, 1]).first()
    n = 80
    rt = {"F": 40, "M": 40}
    ct = {0: 50, 1: 30}
    want = sum((max(abs(o - rt[g] * ct[y] / n) - 0.5, 0) ** 2) / (rt[g] * ct[y] / n) for (g, y), o in obs.items())
    assert abs(r["chi2"] - want) < 1e-9 and r["dof"] == 1
    assert abs(r["p_value"] - math.erfc(math.sqrt(want / 2))) < 1e-9
    r2 = stats.chi2_independence(df, "g", "y", [0, 1], correction=False).first()
    assert r2["chi2"] > r["chi2"]


def test_chi2_sf_known_values():
    assert abs(chi2_sf_value(3.841458820694124, 1) - 0.05) < 1e-9
    assert abs(chi2_sf_value(5.991464547107979, 2) - 0.05) < 1e-9
    assert abs(chi2_sf_value(18.307038053275146, 10) - 0.05) < 1e-9


def test_distributed_quantiles_equal_percentile(spark):
    rng = np.random.default_rng(11)
    rows = [(int(g), float(v)) for g, v in zip(rng.integers(0, 3, 3000), np.round(rng.gamma(2, 50, 3000), 1))]
    df = spark.createDataFrame(rows, "g int, x double")
    ps = [0.0, 0.25, 0.5, 0.9, 0.99, 1.0]
    a = {r["g"]: [round(r[f"p{int(round(p * 100))}"], 9) for p in ps]
         for r in profile.distributed_quantiles(df, "x", ps, by=["g"]).collect()}
    b = {r["g"]: [round(v, 9) for v in r["q"]] for r in df.groupBy("g").agg(F.percentile("x", ps).alias("q")).collect()}
    assert a == b
    one = profile.distributed_quantiles(df, "x", [0.5]).first()["p50"]
    assert round(one, 9) == round(df.agg(F.percentile("x", 0.5)).first()[0], 9)
