"""Rank and contingency statistics.

Ranks are computed over *distinct values*: one aggregate gives the multiplicity
of each value, a global running count over the value order gives the number of
smaller values, and the mid-rank of a value is that count plus (t + 1) / 2.
The running count uses the range-partition prefix method, so no step puts all
distinct values into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.functions.special import chi2_sf, normal_two_sided_p
from ledgerlens.operators.keys import running_sum_global


def mid_ranks(df: DataFrame, value: str, *, extra_aggs: Sequence[Column] = (),
              rank_name: str = "rank") -> DataFrame:
    """Distinct values of ``value`` with multiplicity ``t`` and average rank
    (ties share the mean of their positions, as pandas/scipy do)."""
    g = (df.filter(F.col(value).isNotNull()).groupBy(value)
           .agg(F.count(F.lit(1)).alias("t"), *extra_aggs))
    g = running_sum_global(g, [value], "t", "_cum")
    return g.withColumn(rank_name, (F.col("_cum") - F.col("t")).cast("double")
                        + (F.col("t").cast("double") + 1) / 2).drop("_cum")


EXACT_SMALL, EXACT_LARGE = 8, 200  # sizes of the two groups up to which p is counted, not approximated


def rank_sum_stats(df: DataFrame, value: str, label: str, positive=1) -> DataFrame:
    """n1 (positives), n2, the positives' rank sum, U1 and the normal
    approximation z with tie and continuity corrections — one row."""
    return _rank_sums(df, value, label, positive).drop("ties")


def _rank_sums(df: DataFrame, value: str, label: str, positive) -> DataFrame:
    d = df.filter(F.col(value).isNotNull() & F.col(label).isNotNull())
    r = mid_ranks(d, value, extra_aggs=[F.count(F.when(F.col(label) == positive, 1)).alias("t1")])
    t = F.col("t").cast("double")
    s = r.agg(F.sum(F.col("rank") * F.col("t1")).alias("rank_sum_1"),
              F.sum("t1").alias("n1"), F.sum("t").alias("n"),
              F.sum(t * t * t - t).alias("_ties"))
    n1, n = F.col("n1").cast("double"), F.col("n").cast("double")
    n2 = n - n1
    u1 = F.col("rank_sum_1") - n1 * (n1 + 1) / 2
    sigma = F.sqrt(n1 * n2 / 12 * ((n + 1) - F.try_divide(F.col("_ties"), n * (n - 1))))
    big_u = F.greatest(u1, n1 * n2 - u1)
    return s.select((F.col("n") - F.col("n1")).alias("n2"), "n1", "rank_sum_1",
                    u1.alias("u_statistic"),
                    F.try_divide(big_u - n1 * n2 / 2 - 0.5, sigma).alias("z_score"), F.col("_ties").alias("ties"))


def exact_u_p(n1: Column, n2: Column, u: Column) -> Column:
    """Two-sided exact p of Mann–Whitney's U without ties: 2·P(U >= the larger
    U). The number of rankings with each U is the coefficient of a Gaussian
    binomial, built up one member of the smaller group at a time: with the
    i-th member, each count becomes the sum of the counts i, 2i, … below it, less
    those a further n + i below. For a smaller group of at most EXACT_SMALL and
    a larger one of at most EXACT_LARGE the counts fit a long."""
    m, n = F.least(n1, n2).cast("int"), F.greatest(n1, n2).cast("int")
    last = m * n
    zero = F.lit(0).cast("long")
    at = lambda c, i: F.coalesce(F.when(i >= 0, F.get(c, i)), zero)
    step = lambda c, i: F.transform(F.sequence(F.lit(0), last), lambda v: F.aggregate(
        F.sequence(v, v % i, -i), zero, lambda s, j: s + at(c, j) - at(c, j - n - i)))
    none = F.transform(F.sequence(F.lit(0), last), lambda v: F.when(v == 0, F.lit(1)).otherwise(F.lit(0)).cast("long"))
    counts = F.aggregate(F.sequence(F.lit(1), m), none, step)
    big_u = F.greatest(u, n1 * n2 - u).cast("int")
    total = lambda c: F.aggregate(c, zero, lambda s, k: s + k)
    upper = F.aggregate(F.sequence(big_u, last), zero, lambda s, j: s + at(counts, j))
    return F.least(F.lit(1.0), F.try_divide(2 * upper, total(counts)).cast("double"))


def mann_whitney_u(df: DataFrame, value: str, label: str = "is_fraud", *, positive=1,
                   alpha: float = 0.05) -> DataFrame:
    """Two-sided Mann–Whitney U of the positive class against the rest,
    with a ``significant`` verdict at ``alpha``. Without ties, and with groups of
    at most EXACT_SMALL and EXACT_LARGE values, p is exact; else it is the normal
    approximation with tie and continuity corrections (``method`` says which).
    Null when a group is empty or all values are equal."""
    s = _rank_sums(df, value, label, positive)
    n1, n2 = F.col("n1"), F.col("n2")
    counted = ((F.col("ties") == 0) & (F.least(n1, n2) >= 1) & (F.least(n1, n2) <= EXACT_SMALL)
               & (F.greatest(n1, n2) <= EXACT_LARGE))
    p = F.when(counted, exact_u_p(n1, n2, F.col("u_statistic"))).otherwise(normal_two_sided_p(F.col("z_score")))
    return s.withColumns({"p_value": p, "method": F.when(counted, F.lit("exact")).otherwise(F.lit("asymptotic"))}
                         ).withColumn("significant", F.col("p_value") < alpha).drop("ties")


def rank_column(df: DataFrame, col: str, name: str) -> DataFrame:
    """Attach the mid-rank of ``col`` to every row (join on the value; AQE
    splits a hot value's partition on the row side)."""
    r = mid_ranks(df, col, rank_name=name).select(col, name)
    return df.join(r, col, "left")


def spearman(df: DataFrame, pairs: Sequence[tuple[str, str]]) -> DataFrame:
    """Spearman's rho (Pearson correlation of mid-ranks) for each
    pair, over the rows where both values are present."""
    out = None
    for a, b in pairs:
        d = df.select(F.col(a).cast("double").alias("_a"), F.col(b).cast("double").alias("_b")).dropna()
        d = rank_column(rank_column(d, "_a", "_ra"), "_b", "_rb")
        one = d.agg(F.lit(a).alias("column_a"), F.lit(b).alias("column_b"),
                    F.count(F.lit(1)).alias("n"),
                    F.var_pop("_ra").alias("_va"), F.var_pop("_rb").alias("_vb"),
                    F.covar_pop("_ra", "_rb").alias("_cov"))
        # guard a constant column: correlation is undefined, report null
        one = one.select("column_a", "column_b", "n",
                         F.when((F.col("_va") > 0) & (F.col("_vb") > 0),
                                F.col("_cov") / F.sqrt(F.col("_va") * F.col("_vb"))).alias("rho"))
        out = one if out is None else out.unionByName(one)
    return out


def crosstab(df: DataFrame, a: str, b: str, values: Sequence | None = None) -> DataFrame:
    """Contingency table, one row per ``a`` value and one count column per
    ``b`` value, zero-filled. Without ``values`` the distinct ``b`` values are
    found by Spark (bounded by spark.sql.pivotMaxValues)."""
    src = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    wide = src.groupBy(a).pivot(b, list(values) if values is not None else None).count()
    return wide.fillna(0)


def contingency_long(df: DataFrame, a: str, b: str, values: Sequence) -> DataFrame:
    """Observed counts for every (a, b) cell, zeros included, with the
    expected count r·c/n under independence. The source is read once: row totals
    come from the wide row itself, the other totals from windows over the
    table of cells (one row per ``a`` and declared ``b`` value)."""
    wide = crosstab(df, a, b, values)
    vcols = [F.col(f"`{v}`").cast("long") for v in values]
    row_total = vcols[0]
    for c in vcols[1:]:
        row_total = row_total + c
    cells = F.array(*[F.struct(F.lit(v).alias(b), c.alias("observed")) for v, c in zip(values, vcols)])
    long = (wide.select(a, row_total.alias("row_total"), F.explode(cells).alias("_c"))
                .select(a, f"_c.{b}", "_c.observed", "row_total"))
    return (long.withColumn("col_total", F.sum("observed").over(Window.partitionBy(b)))
                .withColumn("_n", F.sum("observed").over(Window.partitionBy()))
                .withColumn("expected", F.col("row_total") * F.col("col_total") / F.col("_n")).drop("_n"))


def chi2_independence(df: DataFrame, a: str, b: str, values: Sequence, *,
                      correction: bool = True) -> DataFrame:
    """Chi-square test of independence — statistic, dof, p-value. With
    one degree of freedom the Yates continuity correction is applied (N20)."""
    long = contingency_long(df, a, b, values)
    # every ``a`` value has a cell per ``b`` value
    long = long.withColumn("dof", ((F.count(F.lit(1)).over(Window.partitionBy()) / len(values) - 1)
                                   * (len(values) - 1)).cast("int"))
    dof = F.col("dof")
    adj = F.when((dof == 1) & F.lit(bool(correction)), F.lit(0.5)).otherwise(F.lit(0.0))
    o, e = F.col("observed"), F.col("expected")
    term = F.when(e > 0, F.pow(F.greatest(F.abs(o - e) - adj, F.lit(0.0)), 2) / e)
    s = long.agg(F.sum(term).alias("chi2"), F.sum("observed").alias("n"), F.max("dof").alias("dof"))
    return s.select("chi2", "dof", "n", chi2_sf(F.col("chi2"), F.col("dof").cast("double")).alias("p_value"))
