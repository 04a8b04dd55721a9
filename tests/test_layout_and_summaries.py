"""Bucketed tables joined without a shuffle, and mergeable monthly summaries."""

from pyspark.sql import functions as F

from ledgerlens.operators import summaries
from ledgerlens.plans import layout


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_join_of_bucketed_tables_has_no_exchange(spark, tmp_path):
    fact = spark.range(1000).select((F.col("id") % 50).alias("card"), F.col("id").alias("trx"), F.lit(2.0).alias("amt"))
    dim = spark.range(60).select(F.col("id").alias("card"), (F.col("id") % 7).alias("user"))
    f = layout.write_bucketed(fact, str(tmp_path / "f"), "card", 8)
    d = layout.write_bucketed(dim, str(tmp_path / "d"), "card", 8)
    j = f.join(d.hint("merge"), "card")
    assert "Exchange" not in _plan(j) and j.count() == 1000
    per_key = j.groupBy("card").agg(F.sum("amt").alias("s"))
    assert "Exchange" not in _plan(per_key) and {r.s for r in per_key.collect()} == {40.0}


def test_bucketed_table_is_replaced_and_read_by_a_new_session(spark, tmp_path):
    path = str(tmp_path / "t")
    make = lambda n: spark.range(n).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    layout.write_bucketed(make(10), path, "k", 4)
    t = layout.write_bucketed(make(7), path, "k", 4)
    assert t.count() == 7
    spark.sql(f"DROP TABLE {layout._name(path)}")  # external: the files stay
    assert layout.open_bucketed(spark, path, t.schema, "k", 4).count() == 7
    empty = layout.write_bucketed(make(0), str(tmp_path / "e"), "k", 4)
    assert empty.count() == 0


def _months(spark, n=60_000):
    return spark.range(n).select(F.format_string("2021-%02d", (F.col("id") % 12 + 1)).alias("month"),
                                 (F.xxhash64("id") % 5000).alias("card"), (F.col("id") % 1000).cast("double").alias("amt"))


def test_merged_months_are_within_the_stated_error(spark, tmp_path):
    df, path = _months(spark), str(tmp_path / "s")
    summaries.store(summaries.summarise(df, "month", distinct=["card"], quantiles=["amt"]), path)
    r = summaries.estimates(summaries.merged(spark, path, "2021-03", "2021-08"), [0.1, 0.5, 0.99]).first()
    part = df.filter("month BETWEEN '2021-03' AND '2021-08'")
    assert r["n"] == part.count()
    assert abs(r["distinct_card"] / part.select("card").distinct().count() - 1) < 0.05
    for p in (10, 50, 99):
        v = r[f"amt_p{p}"]
        below, upto = part.agg(F.avg((F.col("amt") < v).cast("int")), F.avg((F.col("amt") <= v).cast("int"))).first()
        assert below - 0.03 < p / 100 < upto + 0.03
    plan = _plan(summaries.merged(spark, path, "2021-03", "2021-08"))
    assert "PartitionFilters: [isnotnull(_p" in plan


def test_a_period_is_replaced_and_empty_ranges_are_defined(spark, tmp_path):
    path = str(tmp_path / "s")
    make = lambda df: summaries.store(summaries.summarise(df, "month", distinct=["card"], quantiles=["amt"]), path)
    make(_months(spark, 1200))
    make(_months(spark, 120).filter("month = '2021-05'"))
    n = lambda a, b: summaries.merged(spark, path, a, b).first()["n"]
    assert (n("2021-05", "2021-05"), n("2021-01", "2021-12"), n("2030-01", "2030-12")) == (10, 1110, 0)
    nulls = _months(spark, 12).withColumn("amt", F.lit(None).cast("double")).withColumn("month", F.lit("2022-01"))
    make(nulls)
    r = summaries.estimates(summaries.merged(spark, path, "2022-01", "2022-01")).first()
    assert r["n"] == 12 and r["amt_p50"] is None
    none = summaries.estimates(summaries.merged(spark, path, "2030-01", "2030-12")).first()
    assert (none["n"], none["distinct_card"], none["amt_p50"]) == (0, 0, None)
