"""Profiling: univariate statistics, describe, missing values, histograms,
box statistics and outlier fences (A1–A8, P11, P12, S15).

Many columns are profiled in one job: the columns are unpivoted into
(column, value) pairs and aggregated per column, so every statistic of every
column comes from one scan with map-side partial aggregation. Fences (which
need the quartiles first) take a second pass against a table with one row per
profiled column.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.keymap import null_safe_join

FULL_STATS = ["count", "mean", "median", "mode", "min", "max", "range", "q1", "q3", "iqr",
              "variance", "std_dev", "skewness", "kurtosis", "lower_bound", "upper_bound",
              "outlier_count", "outlier_pct"]
SHORT_STATS = ["count", "mean", "median", "min", "max", "q1", "q3", "iqr", "std_dev", "skewness", "kurtosis"]
DESCRIBE_STATS = ["count", "mean", "std", "min", "p25", "p50", "p75", "max"]


def melt(df: DataFrame, cols: Sequence[str], *, by: Sequence[str] = (),
         name: str = "column", value: str = "value") -> DataFrame:
    """Unpivot numeric columns into (column, value) rows, nulls dropped."""
    pairs = F.array(*[F.struct(F.lit(c).alias(name), F.col(c).cast("double").alias(value)) for c in cols])
    return (df.select(*by, F.explode(pairs).alias("_p"))
              .select(*by, f"_p.{name}", f"_p.{value}")
              .filter(F.col(value).isNotNull()))


def quantile_table(df: DataFrame, col: str, ps: Sequence[float], names: Sequence[str], *, by: Sequence[str] = (),
                   approx: bool = False, accuracy: int = 10000) -> DataFrame:
    """One row per group with the quantiles as columns: exact by
    ``distributed_quantiles``, or the bounded sketch on request."""
    if not approx:
        return distributed_quantiles(df, col, ps, by=by, names=names)
    out = df.groupBy(*by).agg(F.percentile_approx(F.col(col), list(ps), accuracy).alias("_q"))
    return out.select(*by, *[F.col("_q")[i].alias(n) for i, n in enumerate(names)])


def univariate(df: DataFrame, cols: Sequence[str], *, stats: Sequence[str] = FULL_STATS,
               by: Sequence[str] = (), fence: float = 1.5, approx: bool = False,
               accuracy: int = 10000, decimals: int | None = None) -> DataFrame:
    """A1/A2: one row per profiled column (and ``by`` group) with the chosen
    statistics. Exact linear-interpolated quartiles by default (N5), the
    smallest of tied modes (N6), sample variance (N4), population skewness and
    excess kurtosis (N3). Quartiles and mode are exact without holding any
    column's distinct values in one task: quartiles by prefix counts, the mode
    from (column, value) counts."""
    by = list(by)
    long = melt(df, cols, by=by)
    v = F.col("value")
    keys = [*by, "column"]
    moments = [F.count(v).alias("count"), F.avg(v).alias("mean"), F.min(v).alias("min"), F.max(v).alias("max"),
               F.var_samp(v).alias("variance"), F.stddev_samp(v).alias("std_dev"),
               F.skewness(v).alias("skewness"), F.kurtosis(v).alias("kurtosis")]
    base = long.groupBy(*keys).agg(*moments)
    qs = quantile_table(long, "value", [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=keys, approx=approx,
                        accuracy=accuracy)
    base = null_safe_join(base, qs, keys, "left")
    if "mode" in stats:  # the smallest value among the most frequent
        vc = long.groupBy(*keys, "value").agg(F.count(F.lit(1)).alias("_k"))
        top = vc.groupBy(*keys).agg(F.max("_k").alias("_top"))
        mode = (null_safe_join(vc, top, keys).filter(F.col("_k") == F.col("_top"))
                  .groupBy(*keys).agg(F.min("value").alias("mode")))
        base = null_safe_join(base, mode, keys, "left")
    base = base.withColumn("range", F.col("max") - F.col("min")).withColumn("iqr", F.col("q3") - F.col("q1"))
    base = base.withColumns({"lower_bound": F.col("q1") - fence * F.col("iqr"),
                             "upper_bound": F.col("q3") + fence * F.col("iqr")})
    if {"outlier_count", "outlier_pct"} & set(stats):
        # one row per profiled column/group: a bounded build side
        fences = base.select(*keys, "lower_bound", "upper_bound")
        out = (null_safe_join(long, F.broadcast(fences) if not by else fences, keys)
               .groupBy(*keys).agg(F.count(F.when((v < F.col("lower_bound")) | (v > F.col("upper_bound")), 1))
                                   .alias("outlier_count")))
        base = null_safe_join(base, out, keys, "left").withColumn(
            "outlier_pct", F.try_divide(F.col("outlier_count"), F.col("count")) * 100)
    out = base.select(*keys, *stats)
    if decimals is not None:
        out = out.select(*[F.round(c, decimals).alias(c) if c in stats and c != "count" and c != "outlier_count"
                           else F.col(c) for c in out.columns])
    return out


def describe(df: DataFrame, cols: Sequence[str], *, by: Sequence[str] = (), approx: bool = False,
             accuracy: int = 10000) -> DataFrame:
    """A3: count, mean, std, min, 25/50/75 % and max per column, exact
    percentiles by default (``DataFrame.summary`` is approximate)."""
    by = list(by)
    long = melt(df, cols, by=by)
    v = F.col("value")
    keys = [*by, "column"]
    out = long.groupBy(*keys).agg(F.count(v).alias("count"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
                                  F.min(v).alias("min"), F.max(v).alias("max"))
    qs = quantile_table(long, "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"], by=keys, approx=approx,
                        accuracy=accuracy)
    return null_safe_join(out, qs, keys, "left").select(*keys, "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def percentile_set(df: DataFrame, col: str, ps: Sequence[float] = (0.25, 0.5, 0.75, 0.9), *,
                   by: Sequence[str] = (), approx: bool = False) -> DataFrame:
    """A set of percentiles as columns p25, p50, … (exact, see ``distributed_quantiles``)."""
    return quantile_table(df, col, ps, [f"p{int(round(p * 100))}" for p in ps], by=by, approx=approx)


def coefficient_of_variation(df: DataFrame, col: str, *, by: Sequence[str] = ()) -> DataFrame:
    """Sample standard deviation / mean, in percent."""
    return df.groupBy(*by).agg(F.avg(col).alias("mean"), F.stddev_samp(col).alias("std_dev")).withColumn(
        "cv_pct", F.try_divide(F.col("std_dev"), F.col("mean")) * 100)


def missing(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Null count and missing share per column, one aggregate."""
    cols = list(cols or df.columns)
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.when(F.col(c).isNull(), 1)).alias(f"_m{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"_m{i}").alias("null_count"))
                      for i, c in enumerate(cols)])
    return (agg.select("_n", F.explode(pairs).alias("p"))
               .select("p.column", "p.null_count",
                       (F.try_divide(F.col("p.null_count"), F.col("_n")) * 100).alias("missing_pct")))


def schema_profile(df: DataFrame) -> DataFrame:
    """Column, type, non-null count, nulls and null share — ``df.info()``."""
    cols = df.columns
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    agg = df.agg(F.count(F.lit(1)).alias("_n"),
                 *[F.count(F.col(c)).alias(f"_c{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(i).alias("position"), F.lit(c).alias("column"),
                               F.lit(types[c]).alias("data_type"), F.col(f"_c{i}").alias("non_null"))
                      for i, c in enumerate(cols)])
    return (agg.select("_n", F.explode(pairs).alias("p"))
               .select(F.col("p.position").cast("int").alias("position"), "p.column", "p.data_type",
                       "p.non_null", (F.col("_n") - F.col("p.non_null")).alias("nulls"),
                       (F.try_divide(F.col("_n") - F.col("p.non_null"), F.col("_n")) * 100).alias("null_pct")))


def histogram(df: DataFrame, col: str, bins: int = 100, *, lo: float | None = None,
              hi: float | None = None, where: Column | None = None) -> DataFrame:
    """A5: equal-width bin counts over [lo, hi] (data min/max by default); the
    last bin is closed so the maximum lands in it; every bin is reported."""
    src = df.filter(where) if where is not None else df
    src = src.select(F.col(col).cast("double").alias("x")).filter(F.col("x").isNotNull())
    if lo is not None and hi is not None:
        src = src.filter(F.col("x").between(lo, hi))
    if lo is None or hi is None:  # both ends from one aggregate
        ends = src.agg(F.struct(F.min("x").alias("lo"), F.max("x").alias("hi"))).scalar()
    lo_c = F.lit(float(lo)) if lo is not None else ends["lo"]
    hi_c = F.lit(float(hi)) if hi is not None else ends["hi"]
    width = (hi_c - lo_c) / bins
    idx = F.least(F.floor((F.col("x") - lo_c) / width), F.lit(bins - 1)).cast("int")
    counts = src.groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    # the bin domain has exactly ``bins`` rows
    dom = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    out = dom.join(counts, "bin", "left").fillna(0, ["count"])
    return out.select("bin", (lo_c + F.col("bin") * width).alias("bin_start"),
                      (lo_c + (F.col("bin") + 1) * width).alias("bin_end"), "count")


def fences(df: DataFrame, col: str, *, by: Sequence[str] = (), k: float = 1.5,
           approx: bool = False) -> DataFrame:
    """q1, q3, iqr and the k·iqr fences (per group when ``by`` is given)."""
    out = quantile_table(df.filter(F.col(col).isNotNull()), col, [0.25, 0.5, 0.75], ["q1", "median", "q3"], by=by,
                         approx=approx)
    out = out.withColumn("iqr", F.col("q3") - F.col("q1"))
    return out.withColumns({"lower_fence": F.col("q1") - k * F.col("iqr"),
                            "upper_fence": F.col("q3") + k * F.col("iqr")})


def iqr_filter(df: DataFrame, col: str, *, by: Sequence[str] = (), k: float = 1.5,
               approx: bool = False) -> DataFrame:
    """Keep rows with q1 − k·iqr ≤ x ≤ q3 + k·iqr (nulls dropped).
    Global fences are scalar subqueries; grouped fences join on the group key."""
    by = list(by)
    f = fences(df, col, by=by, k=k, approx=approx)
    if not by:
        lf, uf = f.select("lower_fence").scalar(), f.select("upper_fence").scalar()
        return df.filter(F.col(col).between(lf, uf))
    return (null_safe_join(df, f.select(*by, "lower_fence", "upper_fence"), by)
              .filter(F.col(col).between(F.col("lower_fence"), F.col("upper_fence")))
              .drop("lower_fence", "upper_fence"))


def percentile_cap(df: DataFrame, col: str, p: float = 0.99, *, approx: bool = False) -> DataFrame:
    """Keep rows at or below the p-th percentile."""
    cap = quantile_table(df, col, [p], ["cap"], approx=approx).scalar()
    return df.filter(F.col(col) <= cap)


def box_stats(df: DataFrame, col: str, *, by: Sequence[str] = (), k: float = 1.5,
              approx: bool = False) -> DataFrame:
    """Quartiles, fences, whiskers (extreme values inside the fences) and
    outlier counts, per group."""
    by = list(by)
    f = fences(df, col, by=by, k=k, approx=approx)
    x = F.col(col)
    inside = x.between(F.col("lower_fence"), F.col("upper_fence"))
    joined = df.filter(x.isNotNull())
    if by:   # one fence row per group, joined on the group key
        joined = null_safe_join(joined, f, by)
    else:    # global fences are scalar subqueries
        joined = joined.withColumns({c: f.select(c).scalar() for c in ["lower_fence", "upper_fence"]})
    agg = joined.groupBy(*by).agg(F.min(F.when(inside, x)).alias("whisker_low"),
                                  F.max(F.when(inside, x)).alias("whisker_high"),
                                  F.count(F.when(~inside, 1)).alias("outlier_count"),
                                  F.count(x).alias("count"))
    return null_safe_join(f, agg, by, "left") if by else f.withColumns(
        {c: agg.select(c).scalar() for c in ["whisker_low", "whisker_high", "outlier_count", "count"]})


def distributed_quantiles(df: DataFrame, col: str, ps: Sequence[float], *, by: Sequence[str] = (),
                          names: Sequence[str] | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles without a per-group value map.

    ``percentile`` merges a value→count map of each group in one task; for a
    continuous column of a very large group that map is unbounded. Here the
    distinct (group, value) counts come from a hash aggregate, their running
    count over the global (group, value) order uses the range-partition
    prefix method (``running_sum_global``), and each quantile is read off the
    row whose cumulative count covers its position — only aggregates and
    joins on one-row-per-group tables, so a hot group is spread over tasks.
    Same definition as ``percentile``: position p·(n−1), linear between the
    neighbouring order statistics."""
    from ledgerlens.operators.keys import running_sum_global

    by = list(by)
    names = list(names or [f"p{int(round(p * 100))}" for p in ps])
    x = F.col(col).cast("double")
    counts = df.groupBy(*by, x.alias("_v")).agg(F.count(F.lit(1)).alias("_c"))
    g = counts.filter(F.col("_v").isNotNull())
    g = running_sum_global(g, [*by, "_v"], "_c", "_cum")
    if by:
        start = g.groupBy(*by).agg(F.min(F.col("_cum") - F.col("_c")).alias("_s"), F.sum("_c").alias("_n"))
        g = null_safe_join(g, start, by).withColumn("_cum", F.col("_cum") - F.col("_s"))
    else:
        g = g.withColumn("_n", g.agg(F.sum("_c")).scalar())
    aggs = []
    for i, p in enumerate(ps):
        pos = (F.col("_n") - 1) * float(p)
        lo, hi = F.floor(pos), F.ceil(pos)
        covers = lambda r: ((F.col("_cum") - F.col("_c")) <= r) & (r < F.col("_cum"))
        aggs += [F.min(F.when(covers(lo), F.col("_v"))).alias(f"_lo{i}"),
                 F.min(F.when(covers(hi), F.col("_v"))).alias(f"_hi{i}"),
                 F.first(pos - lo).alias(f"_f{i}")]
    out = g.groupBy(*by).agg(*aggs)
    if by:  # a group without a value keeps its row
        out = null_safe_join(counts.select(*by).distinct(), out, by, "left")
    return out.select(*by, *[(F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}"))
                             .alias(nm) for i, nm in enumerate(names)])
