"""History features on a stream (ST1 with W8–W12): the columns of
``behaviour.behaviour_features`` for rows that arrive in micro-batches.

A row is final once the watermark (latest event time less ``delay_hours``,
rounded down to the hour) has passed it: no row that may still come is earlier.
Rows that are not final wait in a table. A micro-batch therefore finishes whole
hours, and its features come from the decomposition of the batch operator:
hourly totals of the entities before it, rows of the same hour, and the rows of
the hours 7 and 30 days back. A user with a large share of all rows is spread
over its hours here too, and no state of an entity is held in one task.

What a later batch needs is kept in tables with one folder per micro-batch:
rows that wait, hourly totals, (user, time, amount) of finished rows, and one
row of progress. Batch N reads folders before N and overwrites its own, so a
replay decides the same. Every ``merge_every`` batches totals and rows are
written together into one folder: totals older than 30 days become one row per
entity, rows that old are left out; earlier folders are not read again.

Defined cases: rows behind the watermark, and rows without a time, are in the
``late`` table and in no feature; a null entity is an entity of its own.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators import behaviour as bh
from ledgerlens.session import scratch_path
from ledgerlens.streaming.scoring import _run, _write_batch

_LONGEST = 30  # days that the widest feature looks back
PROGRESS = "high long, mark long, since long"  # latest event time, watermark, first folder to read


class HistoryStream:
    """The features of a stream whose state tables are below ``state``
    (shared storage). One stream writes them at a time."""

    def __init__(self, stream: DataFrame, path: str, state: str, late: str, *, delay_hours: int, merge_every: int,
                 user: str, merchant: str, ts: str, amount: str, label: str, tie: str):
        self.path, self.state, self.late = path, state, late
        self.delay, self.merge_every = delay_hours * bh.HOUR_US, merge_every
        self.names = (user, merchant, amount, label)
        self.user, self.ts, self.amount, self.tie = user, ts, amount, tie
        self.columns = stream.columns
        self.last = -1
        spark = stream.sparkSession
        none = spark.createDataFrame([], stream.schema)
        base = bh._prep(none, ts)
        totals = bh.hourly_totals(base, *self.names)
        self.schemas = {"waiting": none.schema, "hours": totals.schema, "rows": self._slim(base).schema}
        for name, empty in {"waiting": none, "hours": totals, "rows": self._slim(base)}.items():
            _write_batch(empty, f"{state}/{name}", -1)
        _write_batch(spark.createDataFrame([(None, None, -1)], PROGRESS), f"{state}/progress", -1)
        _write_batch(none, late, -1)
        _write_batch(bh.features_of(self._with_copies(base, self._slim(base), None, None), totals, self.columns,
                                    *self.names, tie), path, -1)

    def _slim(self, base: DataFrame) -> DataFrame:
        return base.select(F.col(self.user).alias("_user"), "_t", F.col(self.amount).alias("_amt"))

    def _kept(self, spark, name: str, first: int, last: int) -> DataFrame:
        """The folders of batches first to last."""
        return spark.read.schema(self.schemas[name]).parquet(
            *[f"{self.state}/{name}/_batch={i}" for i in range(first, last + 1)])

    def _with_copies(self, base: DataFrame, slim: DataFrame, low: int | None, high: int | None) -> DataFrame:
        """Own rows, and the copies that fall into the hours from low to high."""
        parts = [base.select(*self.columns, F.lit(0).alias("_s"), "_t", "_d",
                             F.lit(None).cast(slim.schema["_amt"].dataType).alias("_hv"))]
        for days in (7, _LONGEST):
            shift = days * bh.DAY_US
            copy = slim
            if low is not None:
                copy = copy.filter(F.col("_t") >= low - shift)
            if high is not None:
                copy = copy.filter(F.col("_t") < high - shift)
            parts.append(copy.select(
                F.col("_user").alias(self.user), F.lit(days).alias("_s"), (F.col("_t") + shift).alias("_t"),
                F.floor((F.col("_t") + shift) / bh.HOUR_US).alias("_d"),
                (F.col("_amt") if days == _LONGEST else F.lit(None).cast(slim.schema["_amt"].dataType)).alias("_hv")))
        return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)

    def step(self, batch: DataFrame, n: int, *, finish: bool = False) -> None:
        """Micro-batch ``n``; with ``finish`` every row that waits is final."""
        spark = batch.sparkSession
        before = spark.read.schema(PROGRESS).parquet(f"{self.state}/progress/_batch={n - 1}").first()
        batch = bh._prep(batch, self.ts).persist()  # read for the latest time, the late rows and the others
        latest = batch.agg(F.max("_t")).first()[0]
        high = max((x for x in (before.high, latest) if x is not None), default=None)
        mark = before.mark if high is None else (high - self.delay) // bh.HOUR_US * bh.HOUR_US
        on_time = F.col("_t").isNotNull()
        if before.mark is not None:
            on_time = on_time & (F.col("_t") >= before.mark)
        _write_batch(batch.filter(~on_time).select(*self.columns), self.late, n)

        waiting = bh._prep(self._kept(spark, "waiting", n - 1, n - 1), self.ts)
        open_rows = batch.filter(on_time).unionByName(waiting).persist()
        done = F.lit(True) if finish else F.lit(False) if mark is None else F.col("_t") < mark
        _write_batch(open_rows.filter(~done).select(*self.columns), f"{self.state}/waiting", n)
        final = open_rows.filter(done)

        merging = n > 0 and n % self.merge_every == 0
        old_hours = self._kept(spark, "hours", before.since, n - 1)
        old_rows = self._kept(spark, "rows", before.since, n - 1)
        hours = bh.hourly_totals(final, *self.names).persist()  # new hours only: an hour is finished once
        entity = ["_of", "_user", "_merchant"]
        touched = hours.select(*[F.col(c).alias(f"_x{c}") for c in entity]).distinct()
        same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_x{c}")) for c in entity])
        known = old_hours.join(touched, same, "left_semi").unionByName(hours)
        rows = self._with_copies(final, old_rows.unionByName(self._slim(final)), before.mark,
                                 None if finish else mark)
        _write_batch(bh.features_of(rows, known, self.columns, *self.names, self.tie), self.path, n)

        if merging and mark is not None:
            edge = mark - _LONGEST * bh.DAY_US
            old = F.col("_d") < edge // bh.HOUR_US
            all_hours = old_hours.unionByName(hours).withColumn("_g", F.when(~old, F.col("_d")))
            hours_out = all_hours.groupBy(*entity, "_g").agg(
                F.max("_d").alias("_d"), *[F.sum(c).alias(c) for c in ("_as", "_ac", "_n", "_ys", "_yc")],
                F.max("_dmax").alias("_dmax")).drop("_g")
            rows_out = old_rows.unionByName(self._slim(final)).filter(F.col("_t") >= edge)
        else:
            hours_out, rows_out = hours, self._slim(final)
        _write_batch(hours_out, f"{self.state}/hours", n)
        _write_batch(rows_out, f"{self.state}/rows", n)
        since = n if merging and mark is not None else before.since
        _write_batch(spark.createDataFrame([(high, mark, since)], PROGRESS), f"{self.state}/progress", n)
        self.last = n
        for held in (hours, open_rows, batch):
            held.unpersist()


def history_stream(stream: DataFrame, *, delay_hours: int = 2, finish: bool = False, path: str | None = None,
                   checkpoint: str | None = None, state: str | None = None, late: str | None = None,
                   merge_every: int = 64, timeout: float | None = None, user: str = "cc_num",
                   merchant: str = "merchant", ts: str = "trans_date_trans_time", amount: str = "amt",
                   label: str = "is_fraud", tie: str = "trans_num") -> DataFrame:
    """Drain a stream and return its finished rows with their history features,
    equal to ``behaviour_features`` of all rows that were not late.

    ``finish`` also closes the rows that still wait for the watermark; a stream
    with kept tables cannot be finished, as more may come. With the same four
    paths a later call goes on where this one ended; give all of them or none."""
    paths = (path, checkpoint, state, late)
    if any(paths) and None in paths:
        raise ValueError("give path, checkpoint, state and late together, or none of them")
    if finish and any(paths):
        raise ValueError("a stream with kept tables goes on: it cannot be finished")
    spark = stream.sparkSession
    base = scratch_path(spark, f"streams/history-{uuid.uuid4().hex[:8]}")
    path, checkpoint, state, late = (p or f"{base}/{n}" for p, n in
                                     zip(paths, ("table", "checkpoint", "state", "late")))
    run = HistoryStream(stream, path, state, late, delay_hours=delay_hours, merge_every=merge_every, user=user,
                        merchant=merchant, ts=ts, amount=amount, label=label, tie=tie)
    _run(stream.writeStream.option("checkpointLocation", checkpoint).foreachBatch(run.step), timeout)
    if finish:
        run.step(spark.createDataFrame([], stream.schema), run.last + 1, finish=True)
    return spark.read.parquet(path).drop("_batch")
