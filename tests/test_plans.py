"""Plan checks: no Python UDF in the hot path, filters and columns pushed to
the scan, fixed-size dimensions broadcast."""

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udf_in_headline_queries(spark):
    from ledgerlens.plans.catalog import BENCH
    for name in BENCH:
        p = _plan(entry.queries()[name](spark, SF))
        assert "PythonUDF" not in p and "ArrowEvalPython" not in p and "BatchEvalPython" not in p, name


def test_filter_and_columns_pushed_down(spark):
    from ledgerlens.sources.bindings import ledger
    from pyspark.sql import functions as F
    df = ledger(spark, SF, ["amt", "is_fraud"]).filter(F.col("amt") > 1000)
    p = _plan(df)
    assert "PushedFilters: [IsNotNull(l_extendedprice), GreaterThan(l_extendedprice,1000.0)]" in p
    assert "orders" not in p          # no join needed for line-level columns


def test_fixed_size_dimensions_broadcast(spark):
    from ledgerlens.sources.bindings import ledger
    p = _plan(ledger(spark, SF, ["state", "amt"]))
    assert p.count("BroadcastExchange") >= 2
