"""Per-entity history features (W8–W12, M8) that stay parallel when one
entity holds a large share of all rows.

A plain ``Window.partitionBy(user)`` sends every row of a user to one task.
Here every window is partitioned by (entity, hour) instead, and what lies
before the hour comes from a per-(entity, hour) aggregate:

* history before the current hour = running totals over the entity's *hourly
  aggregates* (one row per active hour, so a small window even for a hot
  entity) — a join on (entity, hour) brings it back;
* the part of the current hour before the row = a window over (entity, hour);
* for a rolling window of N days, the partial first hour (the one N days
  back, from the current time on) is a copy of that hour's rows shifted
  forward by N days into the current (entity, hour) partition, summed from the
  current time onward. Each row is copied once.

Frames run from the unbounded start, in ascending or descending order, so
each is one pass over its partition. All end strictly before the current
timestamp, so a row never sees its own label (no leakage into model features).
Rows without an entity (null key) are one entity of their own.
"""

from __future__ import annotations

import datetime

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.session import checkpoint_dir

HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US
_UNB = Window.unboundedPreceding


_EPOCH = datetime.datetime(1970, 1, 1)


def micros(ts: str, ntz: bool = True) -> Column:
    """Microseconds since the epoch. A timestamp_ntz is measured as wall-clock
    time (independent of the session time zone, so no DST gaps)."""
    if ntz:
        return F.timestamp_diff("MICROSECOND", F.lit(_EPOCH).cast("timestamp_ntz"), F.col(ts))
    return F.unix_micros(F.col(ts))


def _prep(df: DataFrame, ts: str) -> DataFrame:
    ntz = df.schema[ts].dataType.simpleString() == "timestamp_ntz"
    return df.withColumn("_t", micros(ts, ntz)).withColumn("_d", F.floor(F.col("_t") / HOUR_US))


def _daily(df: DataFrame, key: str, value: str) -> DataFrame:
    return df.groupBy(key, "_d").agg(F.sum(value).alias("_ds"), F.count(value).alias("_dc"),
                                     F.max("_t").alias("_dmax"))


def _with_past(rows: DataFrame, past: DataFrame, key: str) -> DataFrame:
    """Left join on (entity, hour), null entities included."""
    past = past.withColumnsRenamed({key: "_pk", "_d": "_ph"})
    return rows.join(past, rows[key].eqNullSafe(past["_pk"]) & (rows["_d"] == past["_ph"]), "left").drop("_pk", "_ph")


def rolling_stats(df: DataFrame, key: str, ts: str, value: str, days: int, *,
                  sum_name: str, count_name: str) -> DataFrame:
    """Sum and count of ``value`` over the entity's rows in [t − days, t)."""
    base = _prep(df, ts)
    daily = _daily(base, key, value)
    wdays = Window.partitionBy(key).orderBy("_d").rangeBetween(-(24 * days - 1), -1)
    full = daily.select(key, "_d", F.sum("_ds").over(wdays).alias("_fs"), F.sum("_dc").over(wdays).alias("_fc"))
    halo = base.select(key, (F.col("_t") + days * DAY_US).alias("_t"), F.col(value).alias("_hv"))
    halo = halo.withColumn("_d", F.floor(F.col("_t") / HOUR_US)).withColumn("_halo", F.lit(True))
    u = base.withColumn("_halo", F.lit(False)).unionByName(halo, allowMissingColumns=True)
    w = Window.partitionBy(key, "_d").orderBy("_t")
    back = Window.partitionBy(key, "_d").orderBy(F.desc("_t")).rangeBetween(_UNB, 0)  # from the row's time on
    own = F.when(~F.col("_halo"), F.col(value))
    u = u.withColumns({
        "_ws": F.sum(own).over(w.rangeBetween(_UNB, -1)),
        "_wc": F.count(own).over(w.rangeBetween(_UNB, -1)),
        "_es": F.sum("_hv").over(back),
        "_ec": F.count("_hv").over(back),
    }).filter(~F.col("_halo"))
    out = _with_past(u, full, key)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = out.withColumns({sum_name: z("_fs") + z("_ws") + z("_es"),
                           count_name: (z("_fc") + z("_wc") + z("_ec")).cast("long")})
    return out.drop("_t", "_d", "_halo", "_hv", "_ws", "_wc", "_es", "_ec", "_fs", "_fc")


def rolling_avg(df: DataFrame, key: str, ts: str, value: str, days: int, name: str) -> DataFrame:
    """Mean of ``value`` over the entity's previous ``days`` days (null when none)."""
    out = rolling_stats(df, key, ts, value, days, sum_name="_rs", count_name="_rc")
    return out.withColumn(name, F.try_divide(F.col("_rs"), F.col("_rc"))).drop("_rs", "_rc")


def rolling_count(df: DataFrame, key: str, ts: str, days: int, name: str) -> DataFrame:
    """Number of the entity's rows in the previous ``days`` days."""
    out = rolling_stats(df.withColumn("_one", F.lit(1)), key, ts, "_one", days, sum_name="_rs", count_name=name)
    return out.drop("_rs", "_one")


def history_stats(df: DataFrame, key: str, ts: str, value: str, *, sum_name: str,
                  count_name: str) -> DataFrame:
    """Sum and count of ``value`` over all of the entity's strictly earlier rows."""
    base = _prep(df, ts)
    daily = _daily(base, key, value)
    wdays = Window.partitionBy(key).orderBy("_d").rowsBetween(_UNB, -1)
    before = daily.select(key, "_d", F.sum("_ds").over(wdays).alias("_fs"), F.sum("_dc").over(wdays).alias("_fc"))
    w = Window.partitionBy(key, "_d").orderBy("_t").rangeBetween(_UNB, -1)
    out = base.withColumns({"_ws": F.sum(value).over(w), "_wc": F.count(value).over(w)})
    out = _with_past(out, before, key)
    z = lambda c: F.coalesce(F.col(c), F.lit(0))
    out = out.withColumns({sum_name: z("_fs") + z("_ws"), count_name: (z("_fc") + z("_wc")).cast("long")})
    return out.drop("_t", "_d", "_ws", "_wc", "_fs", "_fc")


def fraud_history(df: DataFrame, key: str, ts: str, label: str = "is_fraud", name: str = "user_fraud_history") -> DataFrame:
    """Positives among the entity's earlier rows."""
    out = history_stats(df.withColumn("_y", F.col(label).cast("long")), key, ts, "_y",
                        sum_name=name, count_name="_hc")
    return out.drop("_hc", "_y")


def rate_history(df: DataFrame, key: str, ts: str, label: str = "is_fraud",
                 name: str = "merchant_rate_history") -> DataFrame:
    """Positive rate among the entity's earlier rows (null before the first)."""
    out = history_stats(df, key, ts, label, sum_name="_hs", count_name="_hc")
    return out.withColumn(name, F.try_divide(F.col("_hs").cast("double"), F.col("_hc"))).drop("_hs", "_hc")


def minutes_since_last(df: DataFrame, key: str, ts: str, tie: str, name: str = "minutes_since_last") -> DataFrame:
    """Minutes since the entity's previous row (rows ordered by
    timestamp, then ``tie``); null for the first row."""
    base = _prep(df, ts)
    daily = base.groupBy(key, "_d").agg(F.max("_t").alias("_dmax"))
    prev_day = daily.select(key, "_d", F.lag("_dmax").over(Window.partitionBy(key).orderBy("_d")).alias("_pd"))
    w = Window.partitionBy(key, "_d").orderBy("_t", tie)
    out = _with_past(base.withColumn("_pw", F.lag("_t").over(w)), prev_day, key)
    prev = F.coalesce(F.col("_pw"), F.col("_pd"))
    return out.withColumn(name, (F.col("_t") - prev) / 60_000_000.0).drop("_t", "_d", "_pw", "_pd")


def hourly_totals(base: DataFrame, user: str, merchant: str, amount: str, label: str) -> DataFrame:
    """One row per active (user, hour) and per active (merchant, hour), from one
    scan. ``_of`` tells them apart: 0 a user's hour, 1 a merchant's."""
    y = F.col(label).cast("long")
    slim = base.select(F.col(user).alias("_user"), F.col(merchant).alias("_merchant"), "_d", "_t",
                       F.col(amount).alias("_amt"), y.alias("_y"))
    g = slim.groupingSets([["_user", "_d"], ["_merchant", "_d"]], "_user", "_merchant", "_d")
    return g.agg(F.grouping("_user").alias("_of"), F.sum("_amt").alias("_as"), F.count("_amt").alias("_ac"),
                 F.count(F.lit(1)).alias("_n"), F.sum("_y").alias("_ys"), F.count("_y").alias("_yc"),
                 F.max("_t").alias("_dmax"))


def behaviour_features(df: DataFrame, *, user: str = "cc_num", merchant: str = "merchant",
                       ts: str = "trans_date_trans_time", amount: str = "amt", label: str = "is_fraud",
                       tie: str = "trans_num") -> DataFrame:
    """M8: the history features of the proposed model, added to each row.

    All of a user's features come from one partitioning by (user, hour): each
    row is there as itself and as two copies without payload, shifted by 7 and
    by 30 days, for the partial first hours of the rolling windows. The source
    is read twice, for the hourly totals and for the rows."""
    base = _prep(df, ts)
    checkpoint_dir(df.sparkSession)
    hours = hourly_totals(base, user, merchant, amount, label).checkpoint(eager=True)  # read from two sides
    own = F.col("_c.shift") == 0
    copies = F.array(*[F.struct(F.lit(n).alias("shift"), (F.col("_t") + n * DAY_US).alias("t")) for n in (0, 7, 30)])
    keep = [F.when(own, F.col(c)).alias(c) for c in df.columns if c != user]
    rows = base.withColumn("_c", F.explode(copies)).select(
        user, *keep, F.col("_c.shift").alias("_s"), F.col("_c.t").alias("_t"),
        F.floor(F.col("_c.t") / HOUR_US).alias("_d"), F.when(F.col("_c.shift") == 30, F.col(amount)).alias("_hv"))
    # by (user, hour) even where a join has laid the rows out by user: a hot user stays spread over its hours,
    # and a task gets its size in copied rows
    return features_of(rows.repartition(user, "_d"), hours, df.columns, user, merchant, amount, label, tie)


def features_of(rows: DataFrame, hours: DataFrame, columns: list[str], user: str, merchant: str, amount: str,
                label: str, tie: str) -> DataFrame:
    """The history features of the rows whose ``_s`` is 0, from the hourly
    totals of their entities and the copies (``_s`` 7 or 30, time ``_t`` and
    hour ``_d`` shifted by so many days, amount in ``_hv``) in their hours."""
    past = Window.partitionBy("_user").orderBy("_d")
    before_hour = past.rowsBetween(_UNB, -1)
    by_user = hours.filter("_of = 0").select(
        F.col("_user").alias(user), "_d",
        F.sum("_as").over(past.rangeBetween(-(24 * 30 - 1), -1)).alias("_fs30"),
        F.sum("_ac").over(past.rangeBetween(-(24 * 30 - 1), -1)).alias("_fc30"),
        F.sum("_n").over(past.rangeBetween(-(24 * 7 - 1), -1)).alias("_fn7"),
        F.sum("_ys").over(before_hour).alias("_fy"), F.lag("_dmax").over(past).alias("_fl"))
    past = Window.partitionBy("_merchant").orderBy("_d").rowsBetween(_UNB, -1)
    by_merchant = hours.filter("_of = 1").select(
        F.col("_merchant").alias(merchant), "_d", F.sum("_ys").over(past).alias("_my"),
        F.sum("_yc").over(past).alias("_mc"))

    own = F.col("_s") == 0
    y = F.col(label).cast("long")  # null in the copies, as all payload
    part = Window.partitionBy(user, "_d")
    before = part.orderBy("_t").rangeBetween(_UNB, -1)
    since = part.orderBy(F.desc("_t")).rangeBetween(_UNB, 0)  # copies from the row's time on
    rows = rows.withColumn("_wl", F.last(F.when(own, F.col("_t")), ignorenulls=True).over(
        part.orderBy("_t", tie).rowsBetween(_UNB, -1)))
    rows = rows.withColumns({"_ws": F.sum(amount).over(before), "_wc": F.count(amount).over(before),
                             "_wn": F.count(F.when(own, 1)).over(before), "_wy": F.sum(y).over(before)})
    rows = rows.withColumns({"_es": F.sum("_hv").over(since), "_ec": F.count("_hv").over(since),
                             "_en": F.count(F.when(F.col("_s") == 7, 1)).over(since)}).filter(own)

    out = _with_past(rows, by_user, user)
    z = lambda *cs: sum((F.coalesce(F.col(c), F.lit(0)) for c in cs), F.lit(0))
    out = out.withColumns({
        "avg_amt_30d": F.try_divide(z("_fs30", "_ws", "_es"), z("_fc30", "_wc", "_ec")),
        "txn_count_7d": z("_fn7", "_wn", "_en").cast("long"),
        "minutes_since_last": (F.col("_t") - F.coalesce("_wl", "_fl")) / 60_000_000.0,
        "user_fraud_history": z("_fy", "_wy").cast("long")})
    before = Window.partitionBy(merchant, "_d").orderBy("_t").rangeBetween(_UNB, -1)
    out = _with_past(out.withColumns({"_wmy": F.sum(y).over(before), "_wmc": F.count(y).over(before)}),
                     by_merchant, merchant)
    out = out.withColumn("merchant_rate_history",
                         F.try_divide(z("_my", "_wmy").cast("double"), z("_mc", "_wmc")))
    return out.select(*columns, "avg_amt_30d", "txn_count_7d", "minutes_since_last", "user_fraud_history",
                      "merchant_rate_history")
