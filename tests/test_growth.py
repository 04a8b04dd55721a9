"""Work per task and bytes moved do not outgrow the input: same rows, other layout."""

import datetime as dt

from pyspark.sql import functions as F

from ledgerlens.operators import behaviour
from ledgerlens.plans import catalog_model, layout, ml, model
from ledgerlens.sources import bindings, files

SF = "/root/testdata/sf0.001"


def _executed(df):
    return df._jdf.queryExecution().executedPlan().toString()


def _rows(df):
    return sorted(map(str, df.collect()))


def test_merchant_keys_read_apart_give_the_same_dimension(spark):
    t = [dt.datetime(2024, 1, d) for d in (1, 2, 3)]
    rows = [("fraud_b", t[0], "2", 1.0, 2.0, "z"), ("b", t[0], "1", 3.0, None, None), ("fraud_a", t[0], "1", 5.0, 6.0, "y"),
            ("a", t[0], "1", 4.0, 6.0, "y"), (None, None, "9", 7.0, 8.0, "x"), (None, t[1], "0", 9.0, 9.0, "w"),
            ("", t[2], None, 1.0, 1.0, "v"), ("c", t[2], "5", 2.0, 2.0, "u"), ("c", t[2], "5", 2.0, 2.0, "u")]
    raw = spark.createDataFrame(rows, f"merchant string, {model.TS} timestamp_ntz, trans_num string, merch_lat double, "
                                      "merch_long double, merch_zipcode string")
    names = raw.select("merchant", model.TS, "trans_num")
    for prefix_only in (False, True):
        want = model.dim_merchant(raw, prefix_only=prefix_only)
        got = model.dim_merchant(raw, names=names, prefix_only=prefix_only)
        assert got.columns == want.columns and _rows(got) == _rows(want)


def test_fact_looks_keys_up_without_reading_locations(spark):
    raw = bindings.ledger(spark, SF, catalog_model.FACT_INPUT)
    merchants = model.dim_merchant(raw, names=bindings.ledger(spark, SF, catalog_model.MERCHANT_KEYS))
    plan = model.fact_transaction(raw, merchants)._jdf.queryExecution().optimizedPlan().toString()
    assert "min(struct" not in plan and "l_shipdate" in plan
    assert "min(struct" in merchants._jdf.queryExecution().optimizedPlan().toString()


def test_buckets_grow_with_the_rows(spark, monkeypatch):
    assert [layout.buckets_for(n) for n in (0, 8_000_000, 36_000_000, 216_000_000)] == [8, 8, 36, 216]
    assert layout.buckets_for(10 ** 13) == layout.MAX_BUCKETS
    want = _rows(catalog_model.spend_by_user_bucketed(spark, SF))
    used, write = [], layout.write_bucketed
    monkeypatch.setattr(layout, "ROWS_PER_BUCKET", 500)
    monkeypatch.setattr(layout, "write_bucketed", lambda df, path, key, n: used.append(n) or write(df, path, key, n))
    assert _rows(catalog_model.spend_by_user_bucketed(spark, SF)) == want
    rows = bindings.read_table(spark, SF, "lineitem").count()
    assert used == [-(-rows // 500)] * 2 and used[0] > 8


def test_large_ledger_is_shuffled_into_tasks_of_bounded_rows(spark, monkeypatch):
    cols = ["trans_num", "cc_num", "first", "amt"]
    plain = bindings.ledger(spark, SF, cols)
    monkeypatch.setattr(bindings, "ROWS_PER_TASK", 150)
    rows = bindings.read_table(spark, SF, "lineitem").count()
    large = bindings.ledger(spark, SF, cols)
    assert "REPARTITION_BY_NUM" in _executed(large) and "REPARTITION_BY_NUM" not in _executed(plain)
    assert "hashpartitioning(l_orderkey" in _executed(large) and f", {-(-rows // 150)}), REPARTITION_BY_NUM" in _executed(large)
    assert _rows(large) == _rows(plain)


def test_compressed_csv_has_bounded_files_and_reads_back(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "ROWS_PER_FILE", 100)
    df = spark.range(450).select(F.col("id").alias("cc_num"), F.concat(F.lit('a "b", '), "id").alias("merchant")).coalesce(1)
    files.write_csv(df, str(tmp_path / "raw"), compression="gzip")
    written = sorted((tmp_path / "raw").glob("part-*"))
    assert len(written) == 5 and all(f.name.endswith(".csv.gz") for f in written)
    assert _rows(files.read_raw_csv(spark, str(tmp_path / "raw")).select("cc_num", "merchant")) == _rows(df)


def test_history_is_spread_by_user_and_hour_after_a_join_by_user(spark):
    raw = bindings.event_ledger(spark, SF, ml.INPUT)
    laid = raw.repartition(4, "cc_num")
    assert "hashpartitioning(cc_num" in _executed(laid)
    plan = _executed(behaviour.behaviour_features(laid))
    assert any("hashpartitioning(cc_num" in x and ", _d" in x for x in plan.splitlines())
    feats = ml.feature_table(raw)
    assert {*ml.NUMERIC, "category", "is_fraud", ml.TS} <= {*feats.columns} and "street" not in feats.columns
    whole = ml.feature_table(bindings.event_ledger(spark, SF)).select(*feats.columns)
    digits = lambda d: _rows(d.select(*[F.round(c, 6) if t in ("double", "float") else F.col(c) for c, t in d.dtypes]))
    assert digits(feats) == digits(whole)
