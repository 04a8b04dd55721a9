"""Pipeline: land → model → gate → JDBC load (in-process Derby, no port)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as q
from ledgerlens.plans import pipeline
from ledgerlens.sources import files
from ledgerlens.sources.bindings import event_ledger, ledger

SF = "/root/testdata/sf0.001"


def test_pipeline_passes_and_loads(spark, tmp_path):
    src = str(tmp_path / "events_csv")
    ev = event_ledger(spark, SF).withColumn("trans_date_trans_time",
                                            F.date_trunc("second", "trans_date_trans_time"))
    pipeline.ledger_as_raw_csv(ev, src)
    target = pipeline.JdbcTarget("jdbc:derby:memory:ll_ok;create=true",
                                 {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, num_partitions=2)
    out = pipeline.run_pipeline(spark, src, str(tmp_path / "work"), target=target)
    rep = {r["table"]: (r["rows"], r["status"]) for r in out["load_report"].collect()}
    assert rep["fact_transaction"] == (ev.count(), "loaded")
    back = spark.read.jdbc(target.url, "fact_transaction", properties=target.properties)
    assert back.count() == ev.count()
    # idempotent re-run: nothing new to add
    again = pipeline.load_star(spark, {"fact_transaction": spark.read.parquet(out["paths"]["fact_transaction"])},
                               target, mode="skip_existing", keys={"fact_transaction": ["trx_id"]})
    assert {r["table"]: r["rows"] for r in again.collect()}["fact_transaction"] == 0


def test_gate_stops_bad_data(spark, tmp_path):
    src = str(tmp_path / "ledger_csv")
    pipeline.ledger_as_raw_csv(ledger(spark, SF), src)   # trans_num repeats → unique check fails
    target = pipeline.JdbcTarget("jdbc:derby:memory:ll_bad;create=true",
                                 {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    with pytest.raises(q.QualityGateError):
        pipeline.run_pipeline(spark, src, str(tmp_path / "work"), target=target)
    assert not pipeline.table_exists(spark, target, "fact_transaction")
    hist = spark.read.parquet(str(tmp_path / "work" / "quality_results"))
    assert hist.filter(~F.col("success")).count() == 1


def test_missing_input_fails_fast(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        files.read_raw_csv(spark, str(tmp_path / "nope.csv"))


def test_typed_read_keeps_corrupt_rows(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text(",trans_date_trans_time,cc_num,amt\n0,2020-01-01 10:00:00,5,1.5\n1,not a date,x,2\n")
    sch = files.T.StructType([files.RAW_SCHEMA["_c0"], files.RAW_SCHEMA["trans_date_trans_time"],
                              files.RAW_SCHEMA["cc_num"], files.RAW_SCHEMA["amt"]])
    rows = files.read_raw_csv(spark, str(p), sch).collect()
    assert rows[0]["cc_num"] == 5 and rows[1]["_corrupt_record"] is not None
