"""Baseline fraud classifiers and their evaluation (M8–M10) with Spark ML.

Features are the row features and the leak-free history features; the
classes are re-weighted by inverse frequency (fraud is rare). Training and
test sets are split by time, so a model is judged on later transactions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import OneHotEncoder, StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import behaviour, curves

TS = "trans_date_trans_time"
NUMERIC = ["age", "trans_hour", "amt", "distance_miles", "city_pop", "avg_amt_30d", "txn_count_7d",
           "minutes_since_last", "is_first_txn", "user_fraud_history", "merchant_rate_history"]
# the columns that the features, the split and the models read
INPUT = [TS, "trans_num", "cc_num", "merchant", "category", "amt", "dob", "lat", "long", "merch_lat", "merch_long",
         "city_pop", "is_fraud"]


def feature_table(raw: DataFrame) -> DataFrame:
    """M8: row features + history features, nulls (no history yet) as 0."""
    df = raw.withColumns({"age": fx.age_365(TS, "dob"), "trans_hour": F.hour(TS),
                          "distance_miles": fx.haversine_miles("lat", "long", "merch_lat", "merch_long")})
    df = behaviour.behaviour_features(df)
    # "no earlier transaction" is a feature of its own: 0 minutes would mean "just now"
    df = df.withColumn("is_first_txn", F.col("minutes_since_last").isNull().cast("int"))
    return df.fillna(0, subset=[c for c in NUMERIC if c in df.columns])


def with_class_weights(df: DataFrame, label: str = "is_fraud", name: str = "weight") -> DataFrame:
    """Inverse-frequency weights; the positive share is a scalar subquery."""
    p = df.agg(F.avg(F.col(label).cast("double"))).scalar()
    return df.withColumn(name, F.when(F.col(label) == 1, 0.5 / p).otherwise(0.5 / (1 - p)))


def time_split(df: DataFrame, frac: float = 0.8, ts: str = TS) -> tuple[DataFrame, DataFrame]:
    """Train on the first ``frac`` of the time range, test on the rest."""
    bounds = df.agg(F.min(F.unix_micros(F.col(ts).cast("timestamp"))).alias("lo"),
                    F.max(F.unix_micros(F.col(ts).cast("timestamp"))).alias("hi"))
    cut = bounds.select(F.col("lo") + (F.col("hi") - F.col("lo")) * frac).scalar()
    t = F.unix_micros(F.col(ts).cast("timestamp"))
    return df.filter(t < cut), df.filter(t >= cut)


def _models(seed: int, categories: int):
    bins = max(32, categories + 1)  # a tree needs a bin per category value
    return {
        "logistic_regression": LogisticRegression(featuresCol="features_scaled", labelCol="label",
                                                  weightCol="weight", maxIter=50, regParam=0.01),
        "random_forest": RandomForestClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                                numTrees=30, maxDepth=6, maxBins=bins, seed=seed),
        "gradient_boosted_trees": GBTClassifier(featuresCol="features", labelCol="label", weightCol="weight",
                                                maxIter=20, maxDepth=4, maxBins=bins, seed=seed),
    }


def train_baselines(train: DataFrame, *, features: Sequence[str] = NUMERIC, category: str | None = "category",
                    label: str = "is_fraud", seed: int = 42) -> dict:
    """M9: fit the three baseline pipelines; returns name → fitted model. The
    category is one-hot for the linear model and an index for the trees."""
    data = with_class_weights(train.withColumn("label", F.col(label).cast("double")), "label")
    cols, linear, stages, categories = list(features), list(features), [], 0
    if category:
        index = StringIndexer(inputCol=category, outputCol="category_idx", handleInvalid="keep").fit(data)
        categories = len(index.labels)
        stages = [index, OneHotEncoder(inputCol="category_idx", outputCol="category_vec")]
        cols, linear = [*cols, "category_idx"], [*linear, "category_vec"]
    stages += [VectorAssembler(inputCols=cols, outputCol="features", handleInvalid="keep"),
               VectorAssembler(inputCols=linear, outputCol="features_linear", handleInvalid="keep"),
               StandardScaler(inputCol="features_linear", outputCol="features_scaled")]
    return {name: Pipeline(stages=[*stages, m]).fit(data) for name, m in _models(seed, categories).items()}


def evaluate(models: dict, test: DataFrame, *, label: str = "is_fraud", threshold: float = 0.5) -> DataFrame:
    """Precision, recall, F1 (confusion counts in one aggregate), ROC AUC
    over all distinct scores, and the uplift: by how many percent verifying
    every flagged transaction lowers the rate of positives."""
    test = test.withColumn("label", F.col(label).cast("double"))
    out = None
    for name, m in models.items():
        pred = m.transform(test).withColumn("p1", vector_to_array("probability")[1])
        auc = curves.curve_summary(curves.threshold_curve(pred, "p1", "label")).select("roc_auc")
        hit = F.col("p1") >= threshold
        pos = F.col("label") == 1
        c = pred.agg(F.count(F.when(hit & pos, 1)).alias("tp"), F.count(F.when(hit & ~pos, 1)).alias("fp"),
                     F.count(F.when(~hit & pos, 1)).alias("fn"), F.count(F.when(~hit & ~pos, 1)).alias("tn"))
        prec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fp"))
        rec = F.try_divide(F.col("tp"), F.col("tp") + F.col("fn"))
        r = c.select(F.lit(name).alias("model"), "tp", "fp", "fn", "tn", prec.alias("precision"),
                     rec.alias("recall")).withColumn(
            "f1", F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
        ).withColumn("roc_auc", auc.scalar()).withColumn(
            # base rate − rate after, over the base rate: the share of positives that is caught
            "uplift_pct", 100.0 * F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")))
        out = r if out is None else out.unionByName(r)
    return out
