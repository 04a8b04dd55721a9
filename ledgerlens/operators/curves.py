"""Exact threshold curves of a score (M10): every distinct score is a
threshold, rows at or above it are flagged.

One aggregate per distinct score (a score with a third of all rows is reduced
before the shuffle) and one range-partition prefix pass give the whole curve;
its summary is one more aggregate over the curve. Rows with a null or NaN
score, or a null label, are left out.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.keys import running_sums_global


def threshold_curve(df: DataFrame, score: str, label: str = "is_fraud") -> DataFrame:
    """A row per distinct score: ``n`` rows and ``positives`` at it; flagged, tp
    and fp at or above it; all_positives of the table; precision, recall, share flagged, and lift (precision
    over the share of positives). Null where there is no positive at all."""
    s, y = F.col(score).cast("double"), F.col(label).cast("long")
    rows = df.select(s.alias("score"), y.alias("_y")).filter(
        F.col("score").isNotNull() & ~F.isnan("score") & F.col("_y").isNotNull())
    at = rows.groupBy("score").agg(F.count(F.lit(1)).alias("n"), F.sum("_y").alias("positives"))
    c = running_sums_global(at, ["score"], {"n": "flagged", "positives": "tp"}, reverse=True,
                            totals={"n": "_n", "positives": "all_positives"})
    precision = F.col("tp") / F.col("flagged")
    return c.select(
        "score", "n", "positives", "flagged", "tp", (F.col("flagged") - F.col("tp")).alias("fp"), "all_positives",
        precision.alias("precision"), F.try_divide(F.col("tp"), F.col("all_positives")).alias("recall"),
        (F.col("flagged") / F.col("_n")).alias("flagged_share"),
        F.try_divide(precision, F.col("all_positives") / F.col("_n")).alias("lift"))


def curve_summary(curve: DataFrame) -> DataFrame:
    """One row: rows and positives, ROC AUC by mid-ranks (a tie counts half),
    average precision, and the threshold of the best F1 (the largest of equals).
    Null where a class is missing."""
    pos, neg = F.col("positives"), F.col("n") - F.col("positives")
    f1 = F.try_divide(2 * F.col("tp"), F.col("flagged") + F.col("all_positives"))
    a = curve.select("*", f1.alias("_f1")).agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum(pos), F.lit(0)).alias("positives"),
        # negatives at or above the score, those at it counted half
        F.sum(pos.cast("double") * (F.col("fp") - neg / 2)).alias("_above"),
        F.sum(F.col("precision") * pos).alias("_ap"), F.max(F.struct("_f1", "score")).alias("_best"))
    p, q = F.col("positives").cast("double"), (F.col("n") - F.col("positives")).cast("double")
    return a.select("n", "positives", (1 - F.try_divide(F.col("_above"), p * q)).alias("roc_auc"),
                    F.try_divide(F.col("_ap"), p).alias("average_precision"),
                    F.col("_best._f1").alias("best_f1"),
                    F.when(F.col("_best._f1").isNotNull(), F.col("_best.score")).alias("best_threshold"))
