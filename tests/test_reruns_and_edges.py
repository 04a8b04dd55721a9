"""Re-runs, replays, boundaries and null keys."""

import math

import pytest
from pyspark.sql import functions as F

from ledgerlens import session
from ledgerlens.functions.special import chi2_sf_value
from ledgerlens.operators import behaviour, keys
from ledgerlens.operators import quality as q
from ledgerlens.plans import pipeline
from ledgerlens.sources import files
from ledgerlens.streaming import scoring


# ---------------------------------------------------------------- streams
@pytest.fixture
def source(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.range(40).select("id", (F.col("id") % 7).alias("v")).repartition(4).write.parquet(path)
    return spark.readStream.schema("id long, v long").option("maxFilesPerTrigger", 1).parquet(path)


def test_stream_of_several_batches_equals_batch_and_resumes(spark, source, tmp_path):
    table, ckpt = str(tmp_path / "t"), str(tmp_path / "c")
    scoring.run_to_table(source, "x", path=table, checkpoint=ckpt)
    rows = spark.read.parquet(table)
    assert sorted(r.id for r in rows.collect()) == list(range(40))
    assert rows.select("_batch").distinct().count() == 4
    scoring.run_to_table(source, "x", path=table, checkpoint=ckpt)  # goes on: nothing new
    assert spark.read.parquet(table).count() == 40


def test_replayed_batch_replaces_its_earlier_attempt(spark, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(2):
        scoring._write_batch(spark.range(5), path, 3)
    assert spark.read.parquet(path).count() == 5


def test_stream_time_limit_raises(source):
    with pytest.raises(TimeoutError):
        scoring.run_to_table(source, "x", timeout=0.05)


def test_gate_stream_several_batches(spark, source, tmp_path):
    suite = q.Suite("s", [q.Expectation(q.NOT_NULL, {"column": "id"}), q.Expectation(q.UNIQUE, {"column": "id"})])
    sink = str(tmp_path / "ok")
    res = scoring.gate_stream(source, suite, sink=sink)
    assert res.count() == 8 and res.filter("not success").count() == 0
    assert spark.read.parquet(sink).count() == 40


# ----------------------------------------------------------------- quality
def _success(spark, values, exp, kind="double"):
    df = spark.createDataFrame([(v,) for v in values], f"x {kind}")
    return q.validate(df, q.Suite("s", [exp])).first()


def test_mostly_at_the_boundary(spark):
    for good, mostly in ((2, 0.2), (7, 0.7), (3, 0.3), (9, 0.9)):
        e = q.Expectation(q.BETWEEN, {"column": "x", "min_value": 0, "mostly": mostly})
        assert _success(spark, [1.0] * good + [-1.0] * (10 - good), e).success
        assert not _success(spark, [1.0] * (good - 1) + [-1.0] * (11 - good), e).success


def test_nan_is_missing(spark):
    r = _success(spark, [1.0, float("nan"), None], q.Expectation(q.BETWEEN, {"column": "x", "min_value": 0}))
    assert (r.missing_count, r.unexpected_count, r.success) == (2, 0, True)
    assert not _success(spark, [1.0, float("nan")], q.Expectation(q.NOT_NULL, {"column": "x"})).success


def test_clean_trims_and_keeps_one_of_equal_rows(spark):
    df = spark.createDataFrame([(" a ", "1"), ("a", "1"), (" ", "1"), ("b", "oops"), ("c", "nan")], "k string, v string")
    good, bad = q.clean(df, required=["k", "v"], casts={"v": "double"}, trim=["k"], unique=["k", "v"])
    assert [(r.k, r.v) for r in good.collect()] == [("a", 1.0)]
    assert sorted(r.k or "" for r in bad.collect()) == ["", "b", "c"]


def test_suite_file_round_trip(spark, tmp_path):
    path = f"file://{tmp_path}/suite.json"
    q.RAW_SUITE.save(path, spark)
    assert q.Suite.load(path, spark).to_json() == q.RAW_SUITE.to_json()


# --------------------------------------------------------------------- job
HEADER = ",".join(["", *files.RAW_SCHEMA.fieldNames()[1:]])


def _csv(path, amounts):
    row = ("{i},2020-01-0{d} 10:00:00,4{i},fraud_M{d},shop,{a},F{i},L{i},F,1 Street,City{d},TX,7500{d},30.0,-97.0,1000,Job,"
           "1980-01-01,t{i},1577872800,30.1,-97.1,0,75001")
    lines = [HEADER] + [row.format(i=i, d=1 + i % 5, a=a) for i, a in enumerate(amounts)]
    path.write_text("\n".join(lines + [lines[1]]) + "\n")  # the first row comes twice


def test_job_runs_twice_and_sets_bad_amounts_aside(spark, tmp_path):
    src = tmp_path / "raw.csv"
    _csv(src, ["10.5", "oops", "7.25", "NaN", "3"])
    target = pipeline.JdbcTarget("jdbc:derby:memory:ll_twice;create=true",
                                 {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}, num_partitions=2)
    for _ in range(2):
        out = pipeline.run_pipeline(spark, str(src), str(tmp_path / "work"), target=target, load_mode="skip_existing",
                                    ingest_date="2020-02-01")
        assert out["results"].filter("not success").count() == 0
    loaded = spark.read.jdbc(target.url, "fact_transaction", properties=target.properties)
    assert sorted(r.trx_id for r in loaded.select(F.col("trx_id")).collect()) == ["t0", "t2", "t4"]
    assert spark.read.parquet(str(tmp_path / "work" / "quarantine")).count() == 2
    assert spark.read.parquet(str(tmp_path / "work" / "raw")).count() == 6


def test_lost_target_is_an_error(spark):
    bad = pipeline.JdbcTarget("jdbc:derby:memory:ll_never_made", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"})
    with pytest.raises(Exception):
        pipeline.table_exists(spark, bad, "fact_transaction")


# ------------------------------------------------------- history and sums
def test_null_entity_is_one_entity(spark):
    df = spark.createDataFrame([(None, "2020-01-01 10:00:00", 1), (None, "2020-01-02 09:00:00", 1),
                                (None, "2020-01-02 10:30:00", 1), (7, "2020-01-02 10:00:00", 1)],
                               "k long, t string, y int").withColumn("t", F.col("t").cast("timestamp_ntz"))
    order = [r.n for r in behaviour.rolling_count(df, "k", "t", 7, "n").orderBy("k", "t").collect()]
    assert order == [0, 1, 2, 0]
    past = [r.h for r in behaviour.fraud_history(df, "k", "t", "y", "h").orderBy("k", "t").collect()]
    assert past == [0, 1, 2, 0]


def test_no_frame_runs_to_the_unbounded_end(spark):
    df = spark.createDataFrame([(1, 1.0)], "k long, v double").withColumn("t", F.lit("2020-01-01").cast("timestamp_ntz"))
    plan = behaviour.rolling_avg(df, "k", "t", "v", 30, "a")._jdf.queryExecution().toString().lower()
    assert "unboundedfollowing" not in plan
    s = keys.running_sum_global(df, ["k"], "v", "s", reverse=True)._jdf.queryExecution().toString().lower()
    assert "unboundedfollowing" not in s


def test_chi_square_tail_at_its_middle():
    for dof in (1e2, 1e4, 1e6, 1e8, 1e10):
        assert chi2_sf_value(dof, dof) == pytest.approx(0.5, abs=0.03)
    for dof in (1e4, 1e6, 1e8, 1e10):  # close to a normal tail at three deviations
        assert chi2_sf_value(dof + 3 * math.sqrt(2 * dof), dof) == pytest.approx(0.00135, abs=3e-4)
    assert chi2_sf_value(2.2e6, 2.1e6) == pytest.approx(chi2_sf_value(2.2e6, 2.1e6 - 1), abs=1e-6)


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return default

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())
