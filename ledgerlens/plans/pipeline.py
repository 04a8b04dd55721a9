"""Extract → transform → validate → load, and the warehouse sink.

``run_pipeline`` keeps the order of the reference job but makes each hand-over
a typed parquet table and each step strict:

1. land the raw CSV unchanged (all text) — S4;
2. type it, set rows that fail the business rules aside, and build the six star tables, written as parquet (the processed
   layer); every later step re-reads those files, so the model is computed
   once and lineage is cut at a stable, shared location;
3. validate the written fact with a suite; results are appended to the
   quality history and a failure raises ``QualityGateError`` — nothing loads;
4. load the tables parent-first over JDBC with bounded connections, each table by
   itself or, with ``merge``, through staging tables in one transaction.
"""

from __future__ import annotations

import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlens.operators import quality as q
from ledgerlens.operators.keymap import KeyStore
from ledgerlens.plans import model
from ledgerlens.sources import files


# key columns of the star tables, by which a re-run finds rows already loaded
LOAD_KEYS = {"dim_city": ["city_id"], "dim_merchant": ["merch_id"], "dim_date": ["date_id"], "dim_user": ["user_id"],
             "dim_card": ["cc_number"], "fact_transaction": ["trx_id"]}


@dataclass
class JdbcTarget:
    url: str
    properties: dict | None = None       # user, password, driver … supplied by the caller
    batchsize: int = 500
    num_partitions: int = 8              # bounds concurrent connections


# SQL states and words by which databases say that a table does not exist.
_ABSENT = re.compile(r"42X05|42P01|42S02|(table|view|relation)[^\n]{0,300}(does not exist|doesn't exist|not found)"
                     r"|no such table|unknown table", re.IGNORECASE)


def table_exists(spark: SparkSession, target: JdbcTarget, table: str) -> bool:
    """Is the table there? Any failure but "no such table" (a lost connection,
    a refused login) is raised: it must not pass for an empty target."""
    try:
        spark.read.jdbc(target.url, f"(SELECT 1 AS x FROM {table} WHERE 1 = 0) t",
                        properties=dict(target.properties or {})).collect()
        return True
    except Exception as e:
        if _ABSENT.search(str(e)):
            return False
        raise


def _column_types(df: DataFrame, keys: list[str], length: int = 255) -> str:
    """Text keys as VARCHAR: databases cannot compare their unbounded text types."""
    return ", ".join(f"{k} VARCHAR({length})" for k in keys if df.schema[k].dataType.simpleString() == "string")


def _write(df: DataFrame, target: JdbcTarget, table: str, keys: list[str]) -> None:
    w = df.write.mode("append").option("batchsize", target.batchsize)
    types = _column_types(df, keys)
    if types:
        w = w.option("createTableColumnTypes", types)
    w.jdbc(target.url, table, properties=dict(target.properties or {}))


def _connect(spark: SparkSession, target: JdbcTarget):
    jvm = spark.sparkContext._jvm
    props = jvm.java.util.Properties()
    for k, v in (target.properties or {}).items():
        props.setProperty(k, str(v))
    if "driver" in (target.properties or {}):
        jvm.java.lang.Class.forName(target.properties["driver"])
    return jvm.java.sql.DriverManager.getConnection(target.url, props)


def _execute(connection, *statements: str) -> list[int]:
    out = []
    for sql in statements:
        st = connection.createStatement()
        try:
            out.append(st.executeUpdate(sql))
        finally:
            st.close()
    return out


def merge_star(spark: SparkSession, tables: dict[str, DataFrame], target: JdbcTarget,
               keys: dict[str, list[str]]) -> DataFrame:
    """Load all tables or none: Spark writes each to a staging table of this run,
    their row counts are compared with what was to be written (a repeated task
    inserts twice), and one transaction moves the rows whose key the target does
    not have, parents first. A failure anywhere leaves the targets as before;
    staging tables go in any case. ``tables`` should be stored tables: they are
    read for the count and for the write. Returns the load report."""
    quote = spark.sparkContext._jvm.org.apache.spark.sql.jdbc.JdbcDialects.get(target.url).quoteIdentifier
    run = uuid.uuid4().hex[:8]
    names = [n for n in model.LOAD_ORDER if n in tables]
    staged: list[str] = []
    try:
        for name in names:
            stage = f"stage_{run}_{name}"
            df = tables[name]
            parts = df.coalesce(target.num_partitions) if target.num_partitions else df
            staged.append(stage)
            _write(parts, target, stage, keys[name])
            there = spark.read.jdbc(target.url, f"(SELECT COUNT(*) AS n FROM {stage}) t",
                                    properties=dict(target.properties or {})).first()[0]
            if there != df.count():
                raise RuntimeError(f"{stage} holds {there} rows: a task was repeated; nothing was loaded")
            if not table_exists(spark, target, name):
                _write(df.limit(0), target, name, keys[name])
        connection = _connect(spark, target)
        try:
            connection.setAutoCommit(False)
            report = []
            try:
                for name in names:
                    cols = ", ".join(quote(c) for c in tables[name].columns)
                    same = " AND ".join(f"t.{quote(k)} = s.{quote(k)}" for k in keys[name])
                    n, = _execute(connection, f"INSERT INTO {name} ({cols}) SELECT {cols} FROM stage_{run}_{name} s "
                                              f"WHERE NOT EXISTS (SELECT 1 FROM {name} t WHERE {same})")
                    report.append((name, n, "loaded", None))
                connection.commit()
            except Exception:
                connection.rollback()
                raise
        finally:
            connection.close()
    finally:
        connection = _connect(spark, target)
        try:
            for stage in staged:
                if table_exists(spark, target, stage):
                    _execute(connection, f"DROP TABLE {stage}")
        finally:
            connection.close()
    return spark.createDataFrame(report, "table string, rows long, status string, error string")


def load_star(spark: SparkSession, tables: dict[str, DataFrame], target: JdbcTarget, *,
              mode: str = "append", strict: bool = True, keys: dict[str, list[str]] | None = None) -> DataFrame:
    """Write the tables in dependency order. ``mode``: ``append``,
    ``overwrite``, ``skip_existing`` (append only rows whose key is not in
    the target yet, by a left-anti join — re-runs stay idempotent) or ``merge``
    (the same rows, all tables in one transaction: ``merge_star``). With
    ``strict=False`` a failing table is reported and the load goes on.
    Returns a load report (table, rows, status, error)."""
    if mode == "merge":
        return merge_star(spark, tables, target, keys or LOAD_KEYS)
    report = []
    for name in model.LOAD_ORDER:
        if name not in tables:
            report.append((name, None, "absent", None))
            continue
        df = tables[name]
        try:
            write_mode = "append"
            if mode == "overwrite":
                write_mode = "overwrite"
            elif mode == "skip_existing" and keys and name in keys and table_exists(spark, target, name):
                existing = spark.read.jdbc(target.url, name, properties=dict(target.properties or {}))
                df = df.join(existing.select(*keys[name]), keys[name], "left_anti")
            df = df.repartition(target.num_partitions) if target.num_partitions else df
            n = df.count()
            (df.write.mode(write_mode).option("batchsize", target.batchsize)
               .jdbc(target.url, name, properties=dict(target.properties or {})))
            report.append((name, n, "loaded", None))
        except Exception as e:  # noqa: BLE001
            if strict:
                raise
            report.append((name, None, "failed", str(e)))
    return spark.createDataFrame(report, "table string, rows long, status string, error string")


def run_pipeline(spark: SparkSession, source_csv: str, workdir: str, *, target: JdbcTarget | None = None,
                 suite: q.Suite = q.MINIMAL_SUITE, load_mode: str = "append", strict: bool = True,
                 ingest_date: str | None = None) -> dict:
    """The whole job; returns paths, validation results and the load report.
    Rows without a transaction number, card or amount (also where text did not
    parse) go to ``quarantine``, and of rows that are equal in all columns one is
    kept, before the model is built. ``strict=False`` reports a table that fails to
    load and goes on with the next. The same input can be run again: its files have
    landed (``files.land_raw``), quarantine and processed layer are replaced, and with
    ``load_mode="skip_existing"`` or ``"merge"`` rows already loaded are not loaded
    twice. A later input may overlap: surrogate keys are kept under ``workdir``/keys,
    so members of earlier loads have their ids and new ones get new ids."""
    raw_path = f"{workdir.rstrip('/')}/raw"
    landed = files.land_raw(spark, source_csv, raw_path, ingest_date=ingest_date)
    typed = files.type_raw(landed)
    typed, rejects = q.clean(typed, required=["trans_num", "cc_num", "amt"], unique=typed.columns)
    rejects.write.mode("overwrite").parquet(f"{workdir.rstrip('/')}/quarantine")
    star = model.build_star(typed, store=KeyStore(spark, f"{workdir.rstrip('/')}/keys"))
    paths = files.write_layer(star, f"{workdir.rstrip('/')}/processed")
    written = {k: spark.read.parquet(v) for k, v in paths.items()}
    results = q.run_checkpoint("fact_transaction_checkpoint", written["fact_transaction"], suite)
    q.store_results(results, f"{workdir.rstrip('/')}/quality_results")
    q.gate(results)                                   # raises before anything is loaded
    report = load_star(spark, written, target, mode=load_mode, strict=strict, keys=LOAD_KEYS) if target else None
    return {"paths": paths, "results": results, "load_report": report}


def ledger_as_raw_csv(ledger_df: DataFrame, path: str, *, compression: str | None = None) -> None:
    """Write a transaction table in the raw CSV layout (used to exercise the
    pipeline on the driver tables)."""
    df = ledger_df.withColumns({
        "_c0": F.monotonically_increasing_id(),
        "unix_time": F.unix_seconds(F.col("trans_date_trans_time").cast("timestamp")),
        "is_fraud": F.col("is_fraud").cast("int"),
    })
    files.write_csv(df.select(*files.RAW_SCHEMA.fieldNames()), path, compression=compression)
