"""Mergeable summaries (G8, G9, A8 beside their exact forms): one row of
sketches per period, stored once, merged over any range of periods without
reading the rows again.

Distinct counts are HyperLogLog sketches (standard error about 1.04 / 2^(lg_k/2),
1.6 % at 12), quantiles KLL sketches (rank error about 1.3 % at k = 200), both
Spark's own aggregates, combined on the map side: a hot period costs one sketch
per task. Nulls count for neither.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LG_K, K = 12, 200


def summarise(df: DataFrame, period: str, *, distinct: Sequence[str] = (), quantiles: Sequence[str] = (),
              lg_k: int = LG_K, k: int = K) -> DataFrame:
    """A row per period: ``period``, rows ``n``, a sketch ``hll_<c>`` per column
    of ``distinct`` and ``kll_<c>`` per column of ``quantiles``."""
    return df.groupBy(F.col(period).cast("string").alias("period")).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.hll_sketch_agg(F.col(c).cast("string"), lg_k).alias(f"hll_{c}") for c in distinct],
        *[F.kll_sketch_agg_double(F.col(c).cast("double"), k).alias(f"kll_{c}") for c in quantiles])


def store(summaries: DataFrame, path: str) -> None:
    """Write the periods at hand; a period that is there already is replaced,
    the others stay. A null period is not stored."""
    (summaries.filter("period IS NOT NULL")
     .withColumn("_p", F.concat(F.lit("p"), "period"))  # a letter, so that it is never read as a date
     .repartition("_p").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("_p").parquet(path))


def merged(spark: SparkSession, path: str, first: str, last: str) -> DataFrame:
    """One row for the stored periods from ``first`` to ``last`` (as text, both
    included): ``n`` and the merged sketches. Other periods are not read."""
    t = spark.read.parquet(path).filter(F.col("_p").between(f"p{first}", f"p{last}"))
    return t.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[
        (F.hll_union_agg(c) if c.startswith("hll_") else F.kll_merge_agg_double(c)).alias(c)
        for c in t.columns if c.startswith(("hll_", "kll_"))])


def estimates(sketches: DataFrame, probabilities: Sequence[float] = (0.5,)) -> DataFrame:
    """Numbers from merged sketches: ``n``, ``distinct_<c>`` and ``<c>_p<percent>``.
    A quantile is null where there is no value."""
    out = [F.col("n")]
    for c in sketches.columns:
        if c.startswith("hll_"):
            out.append(F.hll_sketch_estimate(c).alias(f"distinct_{c[4:]}"))
        elif c.startswith("kll_"):
            out += [F.when(F.kll_sketch_get_n_double(c) > 0, F.kll_sketch_get_quantile_double(c, F.lit(float(p))))
                    .alias(f"{c[4:]}_p{round(p * 100)}") for p in probabilities]
    return sketches.select(*out)
