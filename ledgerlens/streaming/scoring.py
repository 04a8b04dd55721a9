"""Structured Streaming forms of the rule scorer, the quality gate and the
hourly fraud rate (ST1–ST3).

The row rules are plain Column expressions, so the batch and the streaming
scorer are the same function. Streams write through ``foreachBatch``, one
folder per micro-batch, overwritten: a batch that is replayed after a lost
executor or driver replaces its earlier attempt. Given the same table and
checkpoint paths, a later run goes on from the last committed batch.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators import quality as q
from ledgerlens.operators import rules
from ledgerlens.session import scratch_path
from ledgerlens.streaming.seen_keys import SeenKeys

TS = "trans_date_trans_time"


def score(df: DataFrame, *, ts: str = TS, dob: str = "dob") -> DataFrame:
    """ST1/R11: age, hour, rule flags and risk tier for each transaction
    (works on a batch or a streaming DataFrame)."""
    out = df.withColumns({"age": fx.age_365(ts, dob), "trans_hour": F.hour(ts)})
    risk = rules.risk_tier("age", "trans_hour")
    return out.withColumns({"age_rule": F.coalesce(rules.age_rule("age"), F.lit(False)),
                            "night_rule": F.coalesce(rules.night_rule("trans_hour"), F.lit(False)),
                            "otp_trigger": risk["trigger"], "risk_tier": risk["tier"]})


def hourly_rate(df: DataFrame, *, ts: str = TS, label: str = "is_fraud", window: str = "1 hour",
                watermark: str | None = "2 hours") -> DataFrame:
    """ST3: rows, positives and positive share per event-time window. On a
    stream the watermark bounds the state kept for late rows."""
    ntz = df.schema[ts].dataType.simpleString() == "timestamp_ntz"
    # watermarks need TIMESTAMP: read a timestamp_ntz as session-time (UTC) and convert back at the end
    src = df.withColumn("_et", F.col(ts).cast("timestamp"))
    src = src.withWatermark("_et", watermark) if (watermark and df.isStreaming) else src
    agg = src.groupBy(F.window("_et", window).alias("w")).agg(
        F.count(F.lit(1)).alias("transactions"), F.sum(F.col(label).cast("long")).alias("fraud_transactions"))
    back = (lambda c: c.cast("timestamp_ntz")) if ntz else (lambda c: c)
    return agg.select(back(F.col("w.start")).alias("window_start"), back(F.col("w.end")).alias("window_end"),
                      "transactions", "fraud_transactions",
                      (F.try_divide(F.col("fraud_transactions"), F.col("transactions")) * 100).alias("fraud_pct"))


def _run(stream_writer, timeout: float | None = None) -> None:
    """Drain everything that is available. With a ``timeout`` the query is
    stopped and the call raises when it is not done by then; it never returns
    with part of the input."""
    query = stream_writer.trigger(availableNow=True).start()
    if timeout is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout):
        query.stop()
        raise TimeoutError(f"the stream was not drained within {timeout} s; a later run with the same "
                           "checkpoint goes on from its last committed micro-batch")
    if query.exception() is not None:
        raise query.exception()


def _write_batch(df: DataFrame, path: str, batch_id: int) -> None:
    """One folder per micro-batch, overwritten: a replayed batch replaces its
    earlier attempt. Read back, the folder name is the column ``_batch``."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/_batch={batch_id}")


def run_to_table(stream: DataFrame, name: str, *, mode: str = "append", path: str | None = None,
                 checkpoint: str | None = None, timeout: float | None = None) -> str:
    """Drain a stream (availableNow) into a parquet table, a folder per batch
    id. With the same ``path`` and ``checkpoint`` a later call goes on where
    this one ended; without them each call starts anew. Returns the table path.
    One of them alone is an error: batch ids of the checkpoint name the folders
    of the table."""
    if (path is None) != (checkpoint is None):
        raise ValueError("give path and checkpoint together, or neither")
    spark = stream.sparkSession
    tag = f"{name}-{uuid.uuid4().hex[:8]}"
    path = path or scratch_path(spark, f"streams/{tag}/table")
    ckpt = checkpoint or scratch_path(spark, f"streams/{tag}/checkpoint")
    # an empty folder of the right schema, so that a stream without data gives an empty table
    _write_batch(spark.createDataFrame([], stream.schema), path, -1)
    _run(stream.writeStream.outputMode(mode).option("checkpointLocation", ckpt).foreachBatch(
        lambda batch, batch_id: _write_batch(batch, path, batch_id)), timeout)
    return path


def latest_by_key(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Newest row per key of an update-mode stream table (the last micro-batch
    that touched the key wins)."""
    t = spark.read.parquet(path)
    w = Window.partitionBy(*keys).orderBy(F.desc("_batch"))
    return t.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn", "_batch")


def hourly_rate_stream(stream: DataFrame, **kw) -> DataFrame:
    """ST3 end to end: update-mode windowed aggregate → table → latest per window."""
    path = run_to_table(hourly_rate(stream, **kw), "hourly_rate", mode="update")
    return latest_by_key(stream.sparkSession, path, ["window_start", "window_end"])


def score_stream(stream: DataFrame) -> DataFrame:
    """ST1 end to end: score every arriving transaction; returns the scored table."""
    path = run_to_table(score(stream), "risk_score")
    return stream.sparkSession.read.parquet(path).drop("_batch")


def gate_stream(stream: DataFrame, suite: q.Suite, *, sink: str | None = None,
                quarantine: str | None = None, results: str | None = None,
                checkpoint: str | None = None, seen: str | None = None) -> DataFrame:
    """ST2: validate each micro-batch; batches that pass go to ``sink``,
    failing ones to ``quarantine`` (a folder per batch id in each, so a replay
    replaces its earlier attempt). A uniqueness check covers the batch and all
    batches accepted before it, whose keys are kept at ``seen``; the keys of a
    quarantined batch are not kept, so its repaired rows can come again.
    With a checkpoint, the four paths must be given too, and stay together.
    Returns the result rows of all batches."""
    paths = (sink, quarantine, results, seen)
    if checkpoint is not None and None in paths:
        raise ValueError("a kept checkpoint needs sink, quarantine, results and seen")
    spark = stream.sparkSession
    base = scratch_path(spark, f"streams/gate-{uuid.uuid4().hex[:8]}")
    sink, quarantine, results, seen = (p or f"{base}/{n}" for p, n in
                                       zip(paths, ("accepted", "quarantine", "results", "seen")))
    ckpt = checkpoint or f"{base}/checkpoint"
    unique = any(e.expectation_type == q.UNIQUE for e in suite.expectations)
    keys = SeenKeys(spark, seen) if unique else None
    _write_batch(spark.createDataFrame([], q.RESULT_SCHEMA), results, -1)

    def check(batch: DataFrame, batch_id: int) -> None:
        batch.persist()  # read by the checks and by the write
        try:
            if keys and batch_id and batch_id % keys.merge_every == 0:
                keys.merge(batch.sparkSession, batch_id)
            res = q.validate(batch, suite, run_id=f"batch-{batch_id}", checkpoint="stream",
                             seen=keys and (lambda k: keys.mark(k, batch_id)))
            ok = all(r["success"] for r in res.select("success").collect())
            _write_batch(batch, sink if ok else quarantine, batch_id)
            if keys and ok:
                keys.add(q.unique_keys(batch, suite), batch_id)
            _write_batch(res, results, batch_id)
        finally:
            batch.unpersist()

    _run(stream.writeStream.option("checkpointLocation", ckpt).foreachBatch(check))
    return spark.read.parquet(results)
