"""Bindings of the driver tables to the card-transaction schema.

The analytics operate on the raw transaction columns (``trans_num``,
``trans_date_trans_time``, ``cc_num``, ``merchant``, ``amt``, ``is_fraud`` …).
Two bindings derive such a table from the given parquet tables:

* ``ledger`` — lineitem ⟕ orders ⟕ customer ⟕ nation ⟕ region ⟕ supplier ⟕ part
  (one transaction per line item, many months, daily timestamps);
* ``event_ledger`` — events ⟕ customer ⟕ nation ⟕ region (one transaction per
  event, all 24 hours of a month).

Both are defined with LEFT joins on primary keys, so a join whose columns a
query does not ask for can be dropped without changing any row: the builders
below only join the tables that the requested columns need (Catalyst prunes
columns but cannot drop a join by itself). ``LEDGER_SQL`` / ``EVENTS_SQL`` are
the same definitions in DuckDB SQL for the oracle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

RAW_COLUMNS = [
    "trans_date_trans_time", "cc_num", "merchant", "category", "amt", "first", "last",
    "gender", "street", "city", "state", "zip", "lat", "long", "city_pop", "job", "dob",
    "trans_num", "merch_lat", "merch_long", "is_fraud", "merch_zipcode",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------------------
# person attributes, all functions of the customer key
# ---------------------------------------------------------------------------

def _lat(ck: Column) -> Column:
    return F.lit(25.0) + ((ck * 7) % 2400).cast("double") / 100.0


def _long(ck: Column) -> Column:
    return F.lit(-120.0) + ((ck * 11) % 5000).cast("double") / 100.0


def _person(ck: Column) -> dict[str, Column]:
    return {
        "cc_num": ck.cast("bigint"),
        "last": F.concat(F.lit("Family"), (ck % 50).cast("string")),
        "gender": F.when(ck % 2 == 0, F.lit("F")).otherwise(F.lit("M")),
        "street": F.concat((ck % 9973).cast("string"), F.lit(" Market Street")),
        "zip": F.lpad((ck % 100000).cast("string"), 5, "0"),
        "lat": _lat(ck),
        "long": _long(ck),
        "dob": F.date_add(F.lit("1910-01-01").cast("date"), ((ck * 7919) % 27000).cast("int")),
    }


def customer_profile(spark: SparkSession, sf_dir: str, columns: Iterable[str]) -> DataFrame | None:
    """custkey plus the customer-table attributes that ``columns`` asks for.

    nation (25 rows) and region (5 rows) have a fixed size by the schema's
    definition, so broadcasting them is bounded at any scale factor; customer
    itself grows with the data and is left to the planner (AQE broadcasts it
    only when measured under the threshold)."""
    cols = set(columns)
    need_n = bool(cols & {"city", "city_pop", "state"})
    need_r = "state" in cols
    if not (cols & {"first", "job"} or need_n):
        return None
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment", "c_nationkey")
    if need_n:
        n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
        c = c.join(F.broadcast(n), c.c_nationkey == n.n_nationkey, "left")
    if need_r:
        r = read_table(spark, sf_dir, "region").select("r_regionkey", "r_name")
        c = c.join(F.broadcast(r), F.col("n_regionkey") == r.r_regionkey, "left")
    out = {"first": F.col("c_name"), "job": F.col("c_mktsegment")}
    if need_n:
        nk = F.col("n_nationkey").cast("bigint")
        out.update({"city": F.col("n_name"), "city_pop": ((nk + 1) * (nk + 1) * 1000).cast("bigint")})
    if need_r:
        out["state"] = F.col("r_name")
    return c.select(F.col("c_custkey").alias("_ck"),
                    *[v.alias(k) for k, v in out.items() if k in cols])


# Line items are narrow in the shuffle and wide after the join with orders, so the planner, which sizes
# tasks by shuffled bytes, gives a task more joined rows than it can sort in memory. A large table is
# shuffled into tasks of so many rows instead; a smaller one is left to the planner.
ROWS_PER_TASK = 750_000
MIN_PARTS = 32

_LINE_ONLY = {"trans_num", "trans_date_trans_time", "amt", "is_fraud", "merch_zipcode"}
_CUST_COLS = {"first", "job", "city", "city_pop", "state"}


def ledger(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Transactions from line items. Only joins what ``columns`` needs."""
    cols = list(columns) if columns is not None else list(RAW_COLUMNS)
    want = set(cols)
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate",
        "l_extendedprice", "l_returnflag")
    df = li
    need_o = bool(want - _LINE_ONLY - {"merchant", "category"})
    if need_o:
        o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
        # customer attributes go onto orders first (orders ⟕ customer shuffles
        # orders on custkey), so lineitem is shuffled once, on orderkey only —
        # the one big join (co-locate it by bucketing both tables on orderkey).
        prof = customer_profile(spark, sf_dir, want & _CUST_COLS)
        if prof is not None:
            o = o.join(prof, o.o_custkey == prof._ck, "left").drop("_ck")
        n = -(-li.count() // ROWS_PER_TASK)  # a count from the files' footers
        if n >= MIN_PARTS:
            # with fewer than the session's partitions the join would shuffle both sides again
            n = max(n, int(spark.conf.get("spark.sql.shuffle.partitions")))
            df, o = df.repartition(n, "l_orderkey"), o.repartition(n, "o_orderkey")
        df = df.join(o, df.l_orderkey == o.o_orderkey, "left")
    if "merchant" in want:
        s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
        df = df.join(s, df.l_suppkey == s.s_suppkey, "left")
    if "category" in want:
        p = read_table(spark, sf_dir, "part").select("p_partkey", "p_type")
        df = df.join(p, df.l_partkey == p.p_partkey, "left")
    exprs: dict[str, Column] = {
        "trans_num": F.concat(F.col("l_orderkey").cast("string"), F.lit("-"),
                              F.col("l_linenumber").cast("string")),
        "trans_date_trans_time": F.col("l_shipdate"),
        "amt": F.col("l_extendedprice"),
        "is_fraud": (F.col("l_returnflag") == "R").cast("int"),
        "merch_zipcode": F.when(F.col("l_orderkey") % 100 >= 15, F.col("l_suppkey").cast("string")),
    }
    if "merchant" in want:
        exprs["merchant"] = F.concat(F.lit("fraud_"), F.col("s_name"))
    if "category" in want:
        exprs["category"] = F.col("p_type")
    if need_o:
        ck = F.col("o_custkey")
        exprs.update(_person(ck))
        sk = F.col("l_suppkey")
        exprs["merch_lat"] = _lat(ck) + ((sk * 13) % 200 - 100).cast("double") / 100.0
        exprs["merch_long"] = _long(ck) + ((sk * 17) % 200 - 100).cast("double") / 100.0
    for c in want & _CUST_COLS:
        exprs[c] = F.col(c)
    return df.select(*[exprs[c].alias(c) for c in cols])


def read_events_stream(spark: SparkSession, sf_dir: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """The events table as a file stream (new files in the folder are new input)."""
    schema = read_table(spark, sf_dir, "events").schema
    r = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.parquet(sf_dir)


def event_ledger(spark: SparkSession, sf_dir: str, columns: Iterable[str] | None = None, *,
                 source: DataFrame | None = None) -> DataFrame:
    """Transactions from the events table; ``error`` events are the positive class.
    ``source`` replaces the batch scan (e.g. by ``read_events_stream``); the
    customer lookup is then a stream-static join."""
    cols = list(columns) if columns is not None else list(RAW_COLUMNS)
    want = set(cols)
    ev = (source if source is not None else read_table(spark, sf_dir, "events")).select(
        "event_id", "ts", "user_id", "event_type", "value", "props")
    df = ev
    prof = customer_profile(spark, sf_dir, want & _CUST_COLS)
    if prof is not None:
        df = df.join(prof, df.user_id == prof._ck, "left")
    ck = F.col("user_id")
    k = F.get_json_object(F.col("props"), "$.k").cast("bigint")
    exprs: dict[str, Column] = {
        "trans_num": F.col("event_id").cast("string"),
        "trans_date_trans_time": F.col("ts"),
        "amt": F.col("value"),
        "is_fraud": (F.col("event_type") == "error").cast("int"),
        "merchant": F.concat(F.lit("fraud_m"), k.cast("string")),
        "category": F.concat(F.lit("category_"), (k % 10).cast("string")),
        "merch_zipcode": F.when(F.col("event_id") % 100 >= 15, k.cast("string")),
        "merch_lat": _lat(ck) + ((k * 13) % 200 - 100).cast("double") / 100.0,
        "merch_long": _long(ck) + ((k * 17) % 200 - 100).cast("double") / 100.0,
        **_person(ck),
    }
    for c in want & _CUST_COLS:
        exprs[c] = F.col(c)
    return df.select(*[exprs[c].alias(c) for c in cols])


# ---------------------------------------------------------------------------
# The same bindings in DuckDB SQL (oracle side).
# ---------------------------------------------------------------------------

def _person_sql(ck: str) -> str:
    lat = f"(25.0 + CAST(({ck} * 7) % 2400 AS DOUBLE) / 100.0)"
    lon = f"(-120.0 + CAST(({ck} * 11) % 5000 AS DOUBLE) / 100.0)"
    return f"""
    CAST({ck} AS BIGINT) AS cc_num,
    'Family' || CAST({ck} % 50 AS VARCHAR) AS "last",
    CASE WHEN {ck} % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
    CAST({ck} % 9973 AS VARCHAR) || ' Market Street' AS street,
    lpad(CAST({ck} % 100000 AS VARCHAR), 5, '0') AS zip,
    {lat} AS lat,
    {lon} AS long,
    CAST(DATE '1910-01-01' + CAST(({ck} * 7919) % 27000 AS INTEGER) AS DATE) AS dob"""


_CUST_SQL = """
  LEFT JOIN customer c ON {ck} = c.c_custkey
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

_CUST_COLS_SQL = """
    c.c_name AS "first",
    c.c_mktsegment AS job,
    n.n_name AS city,
    CAST((n.n_nationkey + 1) * (n.n_nationkey + 1) * 1000 AS BIGINT) AS city_pop,
    r.r_name AS state"""

LEDGER_SQL = f"""ledger AS (
  SELECT
    CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS trans_num,
    l.l_shipdate AS trans_date_trans_time,
    l.l_extendedprice AS amt,
    CAST(l.l_returnflag = 'R' AS INTEGER) AS is_fraud,
    CASE WHEN l.l_orderkey % 100 >= 15 THEN CAST(l.l_suppkey AS VARCHAR) END AS merch_zipcode,
    'fraud_' || s.s_name AS merchant,
    p.p_type AS category,
    {_person_sql('o.o_custkey')},
    (25.0 + CAST((o.o_custkey * 7) % 2400 AS DOUBLE) / 100.0)
        + CAST((l.l_suppkey * 13) % 200 - 100 AS DOUBLE) / 100.0 AS merch_lat,
    (-120.0 + CAST((o.o_custkey * 11) % 5000 AS DOUBLE) / 100.0)
        + CAST((l.l_suppkey * 17) % 200 - 100 AS DOUBLE) / 100.0 AS merch_long,
    {_CUST_COLS_SQL}
  FROM lineitem l
  LEFT JOIN orders o ON l.l_orderkey = o.o_orderkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
  LEFT JOIN part p ON l.l_partkey = p.p_partkey
  {_CUST_SQL.format(ck='o.o_custkey')}
)"""

_K = "CAST(json_extract_string(e.props, '$.k') AS BIGINT)"

EVENTS_SQL = f"""ev AS (
  SELECT
    CAST(e.event_id AS VARCHAR) AS trans_num,
    e.ts AS trans_date_trans_time,
    e.value AS amt,
    CAST(e.event_type = 'error' AS INTEGER) AS is_fraud,
    'fraud_m' || CAST({_K} AS VARCHAR) AS merchant,
    'category_' || CAST({_K} % 10 AS VARCHAR) AS category,
    CASE WHEN e.event_id % 100 >= 15 THEN CAST({_K} AS VARCHAR) END AS merch_zipcode,
    (25.0 + CAST((e.user_id * 7) % 2400 AS DOUBLE) / 100.0)
        + CAST(({_K} * 13) % 200 - 100 AS DOUBLE) / 100.0 AS merch_lat,
    (-120.0 + CAST((e.user_id * 11) % 5000 AS DOUBLE) / 100.0)
        + CAST(({_K} * 17) % 200 - 100 AS DOUBLE) / 100.0 AS merch_long,
    {_person_sql('e.user_id')},
    {_CUST_COLS_SQL}
  FROM events e
  {_CUST_SQL.format(ck='e.user_id')}
)"""
