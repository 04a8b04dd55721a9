"""Star-schema modelling of the raw transaction table.

Five dimensions and one fact, each a lazy plan over the raw table:

* surrogate keys are dense 1..n in *first-appearance* order (N10/K1): the
  first appearance of a dimension row is the smallest (timestamp, trans_num)
  among the raw rows that carry it, plus the row's own attributes as the last
  tie-break so the order is total;
  with a ``KeyStore`` they are kept from load to load, and only new members get
  new ids (after those given before);
* dimension lookups are null-safe (N2: pandas merges match null to null);
* the fact is joined to the merchant dimension on the cleaned name. The
  planner picks the join: AQE turns it into a broadcast hash join only when
  the measured dimension is under ``spark.sql.autoBroadcastJoinThreshold``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.functions import features as fx
from ledgerlens.operators.keymap import KeyStore
from ledgerlens.operators.keys import keep_first, with_row_number

TS = "trans_date_trans_time"
CALENDAR = ("2019-01-01", "2026-12-31")   # fixed calendar range of the warehouse


def _null_safe(left: DataFrame, right: DataFrame, pairs: Sequence[tuple[str, str]]) -> Column:
    cond = None
    for a, b in pairs:
        c = left[a].eqNullSafe(right[b])
        cond = c if cond is None else cond & c
    return cond


def _first_seen(df: DataFrame, keys: Sequence[str], ts: str = TS, tid: str = "trans_num") -> DataFrame:
    """Distinct ``keys`` with the (timestamp, id) of their first row —
    an aggregate with map-side partial minima, safe for hot keys."""
    return df.groupBy(*keys).agg(F.min(F.struct(F.col(ts).alias("ts"), F.col(tid).alias("tid"))).alias("_first"))


def _order(keys: Sequence[str]) -> list[Column]:
    return [F.col("_first.ts"), F.col("_first.tid"), *[F.col(k).asc_nulls_first() for k in keys]]


def dim_date(spark: SparkSession, start: str | Column = CALENDAR[0], end: str | Column = CALENDAR[1]) -> DataFrame:
    """M1: one row per calendar day from ``start`` to ``end`` (date text or a
    date Column such as a scalar subquery over the data's first and last day)."""
    s = F.to_date(F.lit(start)) if isinstance(start, str) else start
    e = F.to_date(F.lit(end)) if isinstance(end, str) else end
    d = spark.range(1).select(F.explode(F.sequence(s, e, F.expr("INTERVAL 1 DAY"))).alias("full_date"))
    dow = fx.iso_weekday("full_date")
    return d.select(
        "full_date",
        fx.date_id("full_date").alias("date_id"),
        fx.day_name("full_date").alias("day_name"),
        dow.alias("day_of_week"),
        F.dayofmonth("full_date").alias("day_of_month"),
        fx.month_name("full_date").alias("month_name"),
        F.month("full_date").alias("month"),
        F.year("full_date").alias("year"),
        F.quarter("full_date").alias("quarter"),
        dow.isin(6, 7).alias("is_weekend"),
    )


def _numbered(table: str, df: DataFrame, natural: Sequence[str], order: Sequence[Column], name: str, *,
              scalable: bool, store: KeyStore | None) -> DataFrame:
    """Surrogate keys: dense ones of this load, or the stored ones and new ones after them."""
    if store is None:
        return with_row_number(df, order, name, scalable=scalable)
    return store.assign(table, df, natural, order, name, scalable=scalable)


def dim_city(raw: DataFrame, *, scalable: bool = True, store: KeyStore | None = None) -> DataFrame:
    """M2: distinct (city, state, population) with a dense city_id."""
    keys = ["city", "state", "city_pop"]
    d = _first_seen(raw, keys)
    d = _numbered("dim_city", d, keys, _order(keys), "city_id", scalable=scalable, store=store)
    return d.select(F.col("city").alias("city_name"), "state", F.col("city_pop").alias("population"), "city_id")


USER_COLS = ["first", "last", "dob", "job", "gender", "street", "zip", "city", "state"]


def _fanout(df: DataFrame, keys: Sequence[str], order: Sequence[Column], on_fanout: str) -> DataFrame:
    if on_fanout == "keep":
        return df
    if on_fanout == "first":
        return keep_first(df.withColumn("_o", F.struct(*order)), list(keys), ["_o"]).drop("_o")
    if on_fanout == "error":
        dup = df.groupBy(*keys).count().filter("count > 1").limit(1).count()
        if dup:
            raise ValueError(f"lookup on {list(keys)} fans out")
        return df
    raise ValueError("on_fanout must be 'keep', 'first' or 'error'")


def dim_user(raw: DataFrame, cities: DataFrame, *, on_fanout: str = "keep", scalable: bool = True,
             store: KeyStore | None = None) -> DataFrame:
    """M3 + J1: distinct people with their city_id. The city lookup is on
    (city, state) only, so a city listed with two populations yields two
    rows for the person unless ``on_fanout`` says otherwise."""
    u = _first_seen(raw, USER_COLS)
    c = cities.select(F.col("city_name").alias("_c_city"), F.col("state").alias("_c_state"), "city_id")
    j = u.join(c, _null_safe(u, c, [("city", "_c_city"), ("state", "_c_state")]), "left")
    j = _fanout(j, USER_COLS, [F.col("city_id")], on_fanout)
    j = _numbered("dim_user", j, [*USER_COLS, "city_id"], [*_order(USER_COLS), F.col("city_id").asc_nulls_first()],
                  "user_id", scalable=scalable, store=store)
    return j.select(F.col("first").alias("first_name"), F.col("last").alias("last_name"), "dob", "job",
                    "gender", "street", F.col("zip").alias("zip_code"), "city_id", "user_id")


def dim_merchant(raw: DataFrame, *, names: DataFrame | None = None, prefix_only: bool = False, scalable: bool = True,
                 store: KeyStore | None = None) -> DataFrame:
    """M4: one row per cleaned merchant name, location of its first row (K2).

    ``names`` may give the merchant, timestamp and id columns of the same rows
    where they are cheaper to read than ``raw``: the keys come from them and the
    location is joined on, so that Spark leaves it out of a plan that only looks
    up keys."""
    m = raw.withColumn("merchant", fx.clean_merchant("merchant", prefix_only=prefix_only))
    cols = ["merchant", "merch_lat", "merch_long", "merch_zipcode"]
    if names is not None:
        # the merchant ends the order: there is one row of each
        first = _first_seen(names.withColumn("merchant", fx.clean_merchant("merchant", prefix_only=prefix_only)),
                            ["merchant"])
        d = _numbered("dim_merchant", first, ["merchant"], _order(["merchant"]), "merch_id", scalable=scalable,
                      store=store)
        # plain keys instead of a null-safe one: of a left join on the whole key of an aggregate
        # whose columns nobody reads, the optimizer drops the right side
        key = {"_name": F.coalesce("merchant", F.lit("")), "_none": F.col("merchant").isNull()}
        place = keep_first(m.withColumns(key), list(key), [TS, "trans_num", *cols[1:]],
                           columns=[*cols[1:], TS, "trans_num"]).select(*key, *cols[1:])
        return d.withColumns(key).join(place, list(key), "left").select(
            F.col("merchant").alias("merch_name"), *cols[1:], "merch_id")
    first = keep_first(m, "merchant", [TS, "trans_num", "merch_lat", "merch_long", "merch_zipcode"],
                       columns=[*cols, TS, "trans_num"])
    first = first.withColumn("_first", F.struct(F.col(TS).alias("ts"), F.col("trans_num").alias("tid")))
    d = _numbered("dim_merchant", first, ["merchant"], _order(cols), "merch_id", scalable=scalable, store=store)
    return d.select(F.col("merchant").alias("merch_name"), "merch_lat", "merch_long", "merch_zipcode", "merch_id")


def dim_card(raw: DataFrame, users: DataFrame, *, on_fanout: str = "keep") -> DataFrame:
    """M5 + J2: card number with the owner's user_id (lookup on first, last,
    dob; a person with two addresses fans out unless ``on_fanout``)."""
    keys = ["cc_num", "first", "last", "dob"]
    c = raw.select(*keys).distinct()
    j = c.join(users, _null_safe(c, users, [("first", "first_name"), ("last", "last_name"), ("dob", "dob")]),
               "left")
    j = _fanout(j, keys, [F.col("user_id")], on_fanout)
    return j.select(F.col("cc_num").alias("cc_number"), "user_id")


def fact_transaction(raw: DataFrame, merchants: DataFrame, *, prefix_only: bool = False) -> DataFrame:
    """M6: the fact table, merchant id looked up on the cleaned name.

    ``is_fraud`` becomes boolean; a null label stays null (N14 — the quality
    gate reports it instead of turning it into True)."""
    f = raw.withColumn("merchant", fx.clean_merchant("merchant", prefix_only=prefix_only))
    m = merchants.select("merch_name", "merch_id")
    j = f.join(m, f["merchant"].eqNullSafe(m["merch_name"]), "left")
    return j.select(
        F.col("trans_num").alias("trx_id"),
        F.col(TS).alias("trx_timestamp"),
        fx.date_id(TS).alias("date_id"),
        F.col("cc_num").alias("cc_number"),
        F.col("merch_id").alias("merchant_id"),
        "amt",
        (F.col("is_fraud").cast("int") != 0).alias("is_fraud"),
        "category",
        F.col("lat").alias("latitude"),
        F.col("long").alias("longitude"),
    )


def data_calendar(raw: DataFrame, ts: str = TS) -> DataFrame:
    """Calendar spanning the first to the last transaction day of ``raw``."""
    span = raw.agg(F.min(F.to_date(ts)).alias("lo"), F.max(F.to_date(ts)).alias("hi"))
    return dim_date(raw.sparkSession, span.select("lo").scalar(), span.select("hi").scalar())


def build_star(raw: DataFrame, *, calendar: tuple[str, str] = CALENDAR, on_fanout: str = "keep",
               prefix_only: bool = False, scalable: bool = True, store: KeyStore | None = None) -> dict[str, DataFrame]:
    """All six tables. The caller should hand in a raw table that is cheap to
    re-read (landed parquet), since six plans scan it. With ``store`` the ids of
    members that an earlier load has seen are the same."""
    spark = raw.sparkSession
    cities = dim_city(raw, scalable=scalable, store=store)
    users = dim_user(raw, cities, on_fanout=on_fanout, scalable=scalable, store=store)
    merchants = dim_merchant(raw, prefix_only=prefix_only, scalable=scalable, store=store)
    return {
        "dim_city": cities,
        "dim_merchant": merchants,
        "dim_date": dim_date(spark, *calendar),
        "dim_user": users,
        "dim_card": dim_card(raw, users, on_fanout=on_fanout),
        "fact_transaction": fact_transaction(raw, merchants, prefix_only=prefix_only),
    }


# parent tables before children
LOAD_ORDER = ["dim_city", "dim_merchant", "dim_date", "dim_user", "dim_card", "fact_transaction"]

FOREIGN_KEYS = [  # (child, column, parent, parent key)
    ("dim_user", "city_id", "dim_city", "city_id"),
    ("dim_card", "user_id", "dim_user", "user_id"),
    ("fact_transaction", "merchant_id", "dim_merchant", "merch_id"),
    ("fact_transaction", "date_id", "dim_date", "date_id"),
    ("fact_transaction", "cc_number", "dim_card", "cc_number"),
]


def orphans(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key has no parent row (null keys count as orphans)."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[column] == p["_pk"], "left_anti")


def covered(child: DataFrame, column: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows that do have a parent row."""
    p = parent.select(F.col(parent_key).alias("_pk")).distinct()
    return child.join(p, child[column] == p["_pk"], "left_semi")


def integrity_report(tables: dict[str, DataFrame]) -> DataFrame:
    """Q13: orphan counts for every foreign key of the star."""
    spark = next(iter(tables.values())).sparkSession
    out = None
    for child, col, parent, pk in FOREIGN_KEYS:
        o = orphans(tables[child], col, tables[parent], pk).agg(F.count(F.lit(1)).alias("orphan_rows"))
        o = o.select(F.lit(child).alias("child"), F.lit(col).alias("column"), F.lit(parent).alias("parent"),
                     "orphan_rows")
        out = o if out is None else out.unionByName(o)
    return out if out is not None else spark.createDataFrame([], "child string")
