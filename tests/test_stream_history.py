"""History features on a stream equal those of the batch operator (ST1, W8–W12)."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import behaviour as bh
from ledgerlens.streaming import history

TS = "trans_date_trans_time"
SCHEMA = f"trans_num string, {TS} timestamp_ntz, cc_num long, merchant string, amt double, is_fraud int, extra string"
START = datetime.datetime(2021, 1, 1)


def _made(n, seed=5):
    """Rows in arrival order; some come up to two hours after later ones."""
    rnd = random.Random(seed)
    steps = [0, 1, 59, 1800, 3600, 86_400, 3 * 86_400]  # ties and window borders
    rows, t = [], 0
    for i in range(n):
        t += rnd.choice(steps[:5]) if rnd.random() < .8 else rnd.choice(steps)
        at = START + datetime.timedelta(seconds=t - rnd.choice([0, 0, 0, 60, 3600, 7200]))
        rows.append((f"t{i:04d}", at, rnd.choice([1, 1, 1, 2, 3, None]), rnd.choice(["a", "a", "b", None]),
                     float(rnd.randint(1, 99)) if rnd.random() > .1 else None, rnd.choice([0, 0, 1, None]), f"x{i}"))
    return rows


def _land(spark, rows, folder, parts):
    """One file per part; the names keep the order of arrival, the stream takes one a batch."""
    size = -(-len(rows) // parts)
    for k in range(parts):
        part = rows[k * size:(k + 1) * size]
        spark.createDataFrame(part, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def _stream(spark, folder):
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(folder)


def _rows(df):
    cols = sorted(df.columns)
    return sorted(tuple((r[c] is not None, r[c] if r[c] is not None else 0) for c in cols) for r in df.collect())


@pytest.mark.parametrize("merge_every", [64, 2])
def test_several_batches_equal_the_batch_operator(spark, tmp_path, merge_every):
    rows, folder = _made(360), str(tmp_path / "in")
    _land(spark, rows, folder, 6)
    got = history.history_stream(_stream(spark, folder), finish=True, merge_every=merge_every)
    want = bh.behaviour_features(spark.createDataFrame(rows, SCHEMA))
    assert set(got.columns) == set(want.columns)
    assert _rows(got) == _rows(want)


def test_goes_on_and_replays(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    rows, folder = _made(200, seed=9), p("in")
    kept = dict(path=p("t"), checkpoint=p("c"), state=p("s"), late=p("l"))
    _land(spark, rows[:100], folder, 2)
    history.history_stream(_stream(spark, folder), **kept)
    _land(spark, rows[100:], folder, 2)
    got = history.history_stream(_stream(spark, folder), **kept)
    # final: all rows before the last watermark, with the features of all rows
    high = max(r[1] for r in rows)
    edge = (high - datetime.timedelta(hours=2)).replace(minute=0, second=0, microsecond=0)
    want = bh.behaviour_features(spark.createDataFrame(rows, SCHEMA)).filter(F.col(TS) < F.lit(edge))
    done = _rows(got)
    assert done == _rows(want) and len(done) > 150
    # the last batch again, as after a lost driver, leaves the same tables
    stream = _stream(spark, folder)
    again = history.HistoryStream(stream, p("t"), p("s"), p("l"), delay_hours=2, merge_every=64, user="cc_num",
                                  merchant="merchant", ts=TS, amount="amt", label="is_fraud", tie="trans_num")
    again.step(spark.createDataFrame(rows[150:], SCHEMA), 3)
    assert _rows(spark.read.parquet(p("t")).drop("_batch")) == done


def test_rows_behind_the_watermark_are_late(spark, tmp_path):
    p = lambda n: str(tmp_path / n)
    at = lambda h: START + datetime.timedelta(hours=h)
    first = [("a", at(0), 1, "m", 5.0, 1, "x"), ("b", at(48), 1, "m", 7.0, 0, "x")]
    then = [("c", at(45), 1, "m", 9.0, 0, "x"), ("d", None, 1, "m", 9.0, 0, "x"), ("e", at(47), 1, "m", 9.0, 0, "x"),
            ("f", at(60), 1, "m", 1.0, 0, "x")]
    _land(spark, first, p("in"), 1)
    _land(spark, then, p("in"), 1)
    got = history.history_stream(_stream(spark, p("in")), path=p("t"), checkpoint=p("c"), state=p("s"), late=p("l"))
    assert sorted(r.trans_num for r in spark.read.parquet(p("l")).collect()) == ["c", "d"]
    rows = {r.trans_num: r for r in got.collect()}
    assert sorted(rows) == ["a", "b", "e"]  # f still waits
    assert rows["b"].avg_amt_30d == 7.0 and rows["b"].txn_count_7d == 2 and rows["b"].minutes_since_last == 60.0


def test_empty_stream_and_paths(spark, tmp_path):
    folder = str(tmp_path / "in")
    spark.createDataFrame([], SCHEMA).write.parquet(folder)
    got = history.history_stream(_stream(spark, folder), finish=True)
    assert got.count() == 0 and "merchant_rate_history" in got.columns
    with pytest.raises(ValueError, match="together"):
        history.history_stream(_stream(spark, folder), path=folder)
