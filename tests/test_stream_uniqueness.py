"""Uniqueness over the micro-batches of a stream (ST2, Q2)."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import quality as q
from ledgerlens.streaming import scoring
from ledgerlens.streaming.seen_keys import SeenKeys

SUITE = q.Suite("s", [q.Expectation(q.NOT_NULL, {"column": "v"}), q.Expectation(q.UNIQUE, {"column": "id"})])


def _land(spark, folder, ids):
    spark.createDataFrame([(i, 1) for i in ids], "id long, v long").coalesce(1).write.mode("append").parquet(folder)


def _gate(spark, tmp_path, **kw):
    p = lambda n: str(tmp_path / n)
    src = spark.readStream.schema("id long, v long").option("maxFilesPerTrigger", 1).parquet(p("in"))
    return scoring.gate_stream(src, SUITE, sink=p("ok"), quarantine=p("bad"), results=p("res"), seen=p("seen"),
                               checkpoint=p("ckpt"), **kw)


def _ids(spark, path):
    return sorted(r.id for r in spark.read.schema("id long, v long").parquet(str(path)).collect())


def test_key_of_an_accepted_batch_fails_a_later_one(spark, tmp_path):
    src = str(tmp_path / "in")
    for ids in ([1, 2, 3], [4, 3, None, None], [5, 6], [4, 7]):
        _land(spark, src, ids)
        res = _gate(spark, tmp_path)
    uniq = {r["run_id"]: r for r in res.filter(F.col("column") == "id").collect()}
    assert [uniq[f"batch-{i}"]["success"] for i in range(4)] == [True, False, True, True]
    bad = uniq["batch-1"]
    assert (bad["unexpected_count"], bad["missing_count"], bad["partial_unexpected_list"]) == (1, 2, ["3"])
    # 4 came with a quarantined batch before: its second coming is the first accepted one
    assert _ids(spark, tmp_path / "ok") == [1, 2, 3, 4, 5, 6, 7]
    rows = spark.read.schema("id long, v long").parquet(str(tmp_path / "bad")).collect()
    assert sorted((r.id is None, r.id or 0) for r in rows) == [(False, 3), (False, 4), (True, 0), (True, 0)]


def test_replay_decides_and_stores_the_same(spark, tmp_path):
    keys = SeenKeys(spark, str(tmp_path / "seen"), buckets=4)
    one = spark.createDataFrame([(1, "a"), (1, "b")], "i int, value string")
    for _ in range(2):  # the second time is a replay
        assert keys.mark(one, 0).filter("seen").count() == 0
        keys.add(one, 0)
    assert keys.before(spark, 9).count() == 2
    two = spark.createDataFrame([(1, "b"), (2, "a"), (1, "c"), (-1, None)], "i int, value string")
    for _ in range(2):
        assert [tuple(r) for r in keys.mark(two, 1).filter("seen").collect()] == [(1, "b", True)]
        keys.add(two.filter("value = 'c'"), 1)
    keys.add(two.filter("i = 2"), 1)  # a replay with other rows replaces, it does not add
    assert {tuple(r) for r in keys.before(spark, 9).collect()} == {(1, "a"), (1, "b"), (2, "a")}


def test_merged_history_answers_the_same_and_survives_a_new_session(spark, tmp_path):
    path = str(tmp_path / "seen")
    keys = SeenKeys(spark, path, buckets=4)
    for b in range(6):
        keys.add(spark.createDataFrame([(0, f"k{b}"), (0, f"x{b}")], "i int, value string"), b)
        if b in (2, 4):
            keys.merge(spark, b + 1)
            keys.merge(spark, b + 1)  # again, after a failure
    want = {(0, f"{c}{b}") for b in range(6) for c in "kx"}
    assert {tuple(r) for r in keys.before(spark, 6).collect()} == want and keys.before(spark, 6).count() == 12
    assert spark.sql(f"SHOW PARTITIONS {keys.name}").count() == 2
    spark.sql(f"DROP TABLE {keys.name}")  # external: the files stay, as for another session
    again = SeenKeys(spark, path, buckets=4)
    assert {tuple(r) for r in again.before(spark, 6).collect()} == want


def test_history_is_not_shuffled(spark, tmp_path):
    keys = SeenKeys(spark, str(tmp_path / "seen"), buckets=16)
    ids = lambda a, b: spark.range(a, b).select((F.col("id") % 2).cast("int").alias("i"), F.col("id").cast("string").alias("value"))
    keys.add(ids(0, 100), 0)
    new = ids(50, 150)
    marked = keys.mark(new.groupBy("i", "value").agg(F.count(F.lit(1)).alias("count")), 1)
    assert marked.filter("seen").count() == 50
    plan = keys.mark(new.groupBy("i", "value").agg(F.count(F.lit(1)).alias("count")), 1)._jdf.queryExecution(
    ).executedPlan().toString()
    new_side, history = plan.split("Range (")
    assert "Exchange" in new_side and "Exchange" not in history and "Bucketed: true" in history


def test_checkpoint_without_its_paths_is_refused(spark, tmp_path):
    src = spark.readStream.schema("id long, v long").parquet(str(tmp_path))
    with pytest.raises(ValueError):
        scoring.run_to_table(src, "x", checkpoint=str(tmp_path / "c"))
    with pytest.raises(ValueError):
        scoring.gate_stream(src, SUITE, sink=str(tmp_path / "s"), checkpoint=str(tmp_path / "c"))
