"""Declarative data-quality suites evaluated as Spark aggregates.

A suite is a list of expectations (type + kwargs), stored as JSON. Evaluating
it never moves rows to the driver: all checks of a suite — row-level checks,
null counts and uniqueness — share one scan and one grouped aggregate, and
samples of unexpected values are bounded (``sample`` rows, smallest values
first so results are reproducible). The result is a small
DataFrame with one row per expectation; only ``gate`` collects it (a handful
of rows) to decide whether a pipeline may continue.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

NOT_NULL = "expect_column_values_to_not_be_null"
UNIQUE = "expect_column_values_to_be_unique"
OF_TYPE = "expect_column_values_to_be_of_type"
BETWEEN = "expect_column_values_to_be_between"
IN_SET = "expect_column_values_to_be_in_set"
SUPPORTED = (NOT_NULL, UNIQUE, OF_TYPE, BETWEEN, IN_SET)


@dataclass
class Expectation:
    expectation_type: str
    kwargs: dict
    meta: dict = field(default_factory=dict)

    def __post_init__(self):
        if self.expectation_type not in SUPPORTED:
            raise ValueError(f"unsupported expectation {self.expectation_type}")
        if "column" not in self.kwargs:
            raise ValueError("expectation needs a column")

    @property
    def column(self) -> str:
        return self.kwargs["column"]

    def kwargs_json(self) -> str:
        return json.dumps(self.kwargs, sort_keys=True)


@dataclass
class Suite:
    name: str
    expectations: list[Expectation] = field(default_factory=list)
    meta: dict = field(default_factory=dict)

    def add_or_update(self, exp: Expectation) -> Suite:
        """Replace the expectation of the same type and column, else append."""
        for i, e in enumerate(self.expectations):
            if e.expectation_type == exp.expectation_type and e.column == exp.column:
                self.expectations[i] = exp
                return self
        self.expectations.append(exp)
        return self

    def to_json(self) -> str:
        return json.dumps({"expectation_suite_name": self.name, "meta": self.meta,
                           "expectations": [{"expectation_type": e.expectation_type, "kwargs": e.kwargs,
                                             "meta": e.meta} for e in self.expectations]}, indent=2)

    @staticmethod
    def from_json(text: str) -> Suite:
        d = json.loads(text)
        return Suite(d["expectation_suite_name"],
                     [Expectation(e["expectation_type"], dict(e["kwargs"]), dict(e.get("meta") or {}))
                      for e in d["expectations"]], dict(d.get("meta") or {}))

    def save(self, path: str, spark: SparkSession | None = None) -> None:
        """Write the suite as one JSON file through Spark's file system layer
        (any store that Spark can reach)."""
        fs, p, jvm = _file(path, spark)
        out = fs.create(p, True)
        try:
            out.write(bytearray(self.to_json().encode("utf-8")))
        finally:
            out.close()

    @staticmethod
    def load(path: str, spark: SparkSession | None = None) -> Suite:
        fs, p, jvm = _file(path, spark)
        src = fs.open(p)
        try:
            return Suite.from_json(jvm.org.apache.commons.io.IOUtils.toString(src, "UTF-8"))
        finally:
            src.close()


def _file(path: str, spark: SparkSession | None):
    spark = spark or SparkSession.active()
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p, jvm


# ---------------------------------------------------------------------------
# The three suites of the reference warehouse (names, columns,
# types and bounds as the reference defines them).
# ---------------------------------------------------------------------------
MINIMAL_SUITE = Suite("expectation-transaction-dataset", [
    Expectation(NOT_NULL, {"column": "trx_id"}),
    Expectation(UNIQUE, {"column": "trx_id"}),
    Expectation(NOT_NULL, {"column": "cc_number"}),
    Expectation(OF_TYPE, {"column": "amt", "type_": "float"}),
])

FACT_SUITE = Suite("fact_transaction_suite", [
    Expectation(NOT_NULL, {"column": "trx_id"}),
    Expectation(UNIQUE, {"column": "trx_id"}),
    Expectation(NOT_NULL, {"column": "cc_number"}),
    Expectation(NOT_NULL, {"column": "merchant_id"}),
    Expectation(BETWEEN, {"column": "amt", "min_value": 0, "strict_min": True}),
    Expectation(IN_SET, {"column": "is_fraud", "value_set": [True, False]}),
])

RAW_SUITE = Suite("raw_transaction_expectation_suite", [
    Expectation(NOT_NULL, {"column": "trans_num"}),
    Expectation(NOT_NULL, {"column": "cc_num"}),
    Expectation(UNIQUE, {"column": "trans_num"}),
    Expectation(OF_TYPE, {"column": "amt", "type_": "float"}),
    Expectation(BETWEEN, {"column": "amt", "min_value": 0, "max_value": 100000, "mostly": 0.999}),
    Expectation(IN_SET, {"column": "is_fraud", "value_set": [0, 1, True, False]}),
])

SUITES = {s.name: s for s in (MINIMAL_SUITE, FACT_SUITE, RAW_SUITE)}

# type_ names accepted by the type check, mapped to Spark type names
_TYPE_FAMILIES = {
    "float": {"double", "float"}, "float64": {"double", "float"}, "double": {"double"},
    "int": {"int", "bigint", "smallint", "tinyint"}, "int64": {"bigint", "int", "smallint", "tinyint"},
    "str": {"string"}, "string": {"string"}, "object": {"string"},
    "bool": {"boolean"}, "boolean": {"boolean"},
    "datetime64": {"timestamp", "timestamp_ntz"}, "datetime64[ns]": {"timestamp", "timestamp_ntz"},
    "timestamp": {"timestamp", "timestamp_ntz"}, "date": {"date"},
}

RESULT_SCHEMA = T.StructType([
    T.StructField("run_id", T.StringType()), T.StructField("checkpoint", T.StringType()),
    T.StructField("suite", T.StringType()), T.StructField("expectation_index", T.IntegerType()),
    T.StructField("expectation_type", T.StringType()), T.StructField("column", T.StringType()),
    T.StructField("kwargs", T.StringType()), T.StructField("element_count", T.LongType()),
    T.StructField("missing_count", T.LongType()), T.StructField("missing_percent", T.DoubleType()),
    T.StructField("unexpected_count", T.LongType()), T.StructField("unexpected_percent", T.DoubleType()),
    T.StructField("unexpected_percent_nonmissing", T.DoubleType()),
    T.StructField("unexpected_percent_total", T.DoubleType()),
    T.StructField("partial_unexpected_list", T.ArrayType(T.StringType())),
    T.StructField("partial_unexpected_counts", T.ArrayType(T.StructType([
        T.StructField("value", T.StringType()), T.StructField("count", T.LongType())]))),
    T.StructField("observed_value", T.StringType()), T.StructField("success", T.BooleanType()),
])


def _aligned_set(values: list, dtype: T.DataType) -> list:
    """Make the value set comparable with the column type (True/False ↔ 1/0)."""
    out = []
    for v in values:
        if isinstance(dtype, T.BooleanType):
            out.append(bool(v) if isinstance(v, (bool, int)) else v)
        elif isinstance(dtype, (T.IntegerType, T.LongType, T.ShortType, T.ByteType)):
            out.append(int(v) if isinstance(v, (bool, int)) else v)
        else:
            out.append(v)
    seen, res = set(), []
    for v in out:
        if (type(v), v) not in seen:
            seen.add((type(v), v))
            res.append(v)
    return res


def is_missing(df: DataFrame, column: str) -> Column:
    """Null, or NaN in a floating column (which Spark orders above every number)."""
    c = F.col(column)
    return c.isNull() | F.isnan(c) if isinstance(df.schema[column].dataType, (T.DoubleType, T.FloatType)) else c.isNull()


def unexpected_condition(e: Expectation, df: DataFrame) -> Column:
    """Row-level failure of a scan check (missing values fail only the null check)."""
    c = F.col(e.column)
    k = e.kwargs
    missing = is_missing(df, e.column)
    if e.expectation_type == NOT_NULL:
        return missing
    if e.expectation_type == BETWEEN:
        ok = F.lit(True)
        if k.get("min_value") is not None:
            ok = ok & ((c > k["min_value"]) if k.get("strict_min") else (c >= k["min_value"]))
        if k.get("max_value") is not None:
            ok = ok & ((c < k["max_value"]) if k.get("strict_max") else (c <= k["max_value"]))
        return ~missing & ~ok
    if e.expectation_type == IN_SET:
        vals = _aligned_set(list(k["value_set"]), df.schema[e.column].dataType)
        return ~missing & ~c.isin(*vals)
    raise ValueError(e.expectation_type)


_ROWS, _MISSING = -1, 100000   # marker ids: the row counter, and offset of per-check null counters


def unique_keys(df: DataFrame, suite: Suite) -> DataFrame:
    """(i, value): the present keys of the suite's uniqueness checks, as
    ``_check_counts`` writes them."""
    entries = [F.when(~is_missing(df, e.column), F.struct(F.lit(i).alias("i"), F.col(e.column).cast("string").alias("value")))
               for i, e in enumerate(suite.expectations) if e.expectation_type == UNIQUE]
    if not entries:
        return df.sparkSession.createDataFrame([], "i int, value string")
    return df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("_e")).select("_e.i", "_e.value")


def _check_counts(df: DataFrame, suite: Suite, seen=None) -> DataFrame:
    """One scan, one shuffle for the whole suite: each row is exploded into
    a row marker, one (check, value) entry per failed row-level check, a
    null marker per checked column that is null, and its key for every
    uniqueness check; a single ``groupBy(check, value).count()`` then gives
    the row count, null counts, unexpected values and duplicate keys
    (map-side partial aggregation collapses the markers before the shuffle).
    Only duplicate keys of uniqueness checks are kept: those that occur twice
    here or that ``seen`` (keys → keys with the boolean ``seen``) knows from
    elsewhere."""
    entry = lambda i, v: F.struct(F.lit(i).alias("i"), v.cast("string").alias("value"))
    entries = [entry(_ROWS, F.lit(None))]
    uniques = []
    for i, e in enumerate(suite.expectations):
        t = e.expectation_type
        c = F.col(e.column)
        if t == OF_TYPE:
            continue
        missing = is_missing(df, e.column)
        entries.append(F.when(missing, entry(_MISSING + i, F.lit(None))))
        if t == UNIQUE:
            uniques.append(i)
            entries.append(F.when(~missing, entry(i, c)))
        else:
            entries.append(F.when(unexpected_condition(e, df), entry(i, c)))
    exploded = df.select(F.explode(F.filter(F.array(*entries), lambda x: x.isNotNull())).alias("_e"))
    g = exploded.groupBy("_e.i", "_e.value").agg(F.count(F.lit(1)).alias("count"))
    if not uniques:
        return g
    again = F.col("count") > 1
    if seen is not None:
        g, again = seen(g), again | F.col("seen")
    return g.filter(~F.col("i").isin(*uniques) | again).select("i", "value", "count")


def validate(df: DataFrame, suite: Suite, *, run_id: str = "", checkpoint: str = "",
             sample: int = 20, seen=None) -> DataFrame:
    """Q1–Q7: evaluate every expectation; one result row each. With ``seen``,
    a key that it knows counts as a repeated one (see ``_check_counts``).

    Evaluation is an action (a gate needs the verdict): ``_check_counts``
    reads the data once and shuffles once for the whole suite; its small
    result (counters, distinct unexpected values, duplicate keys) is
    checkpointed, and the driver reads totals and bounded top-``sample``
    lists from it to build one row per expectation."""
    from ledgerlens.session import checkpoint_dir

    spark = df.sparkSession
    checkpoint_dir(spark)
    counts = _check_counts(df, suite, seen).checkpoint(eager=True)
    totals = {r["i"]: r["u"] for r in counts.groupBy("i").agg(F.sum("count").alias("u")).collect()}
    n = int(totals.get(_ROWS, 0))
    lists, tops = {}, {}
    for i, e in enumerate(suite.expectations):
        if e.expectation_type == OF_TYPE or not totals.get(i):
            continue
        b = counts.filter(F.col("i") == i)
        lists[i] = sorted(r["value"] for r in b.orderBy(F.col("value").asc_nulls_first()).limit(sample)
                          .collect() if r["value"] is not None)
        tops[i] = [(r["value"], r["count"]) for r in
                   b.orderBy(F.desc("count"), F.col("value").asc_nulls_first()).limit(sample).collect()]
    pct = lambda a, b: (a / b * 100) if b else None
    rows = []
    for i, e in enumerate(suite.expectations):
        t = e.expectation_type
        row = {"run_id": run_id, "checkpoint": checkpoint, "suite": suite.name, "expectation_index": i,
               "expectation_type": t, "column": e.column, "kwargs": e.kwargs_json(), "element_count": None,
               "missing_count": None, "missing_percent": None, "unexpected_count": None,
               "unexpected_percent": None, "unexpected_percent_nonmissing": None,
               "unexpected_percent_total": None, "partial_unexpected_list": None,
               "partial_unexpected_counts": None, "observed_value": None, "success": None}
        if t == OF_TYPE:
            observed = df.schema[e.column].dataType.simpleString()
            want = _TYPE_FAMILIES.get(str(e.kwargs["type_"]).lower(), {str(e.kwargs["type_"]).lower()})
            row.update(observed_value=observed, success=observed in want)
            rows.append(row)
            continue
        mostly = float(e.kwargs.get("mostly", 1.0))
        u = int(totals.get(i, 0))
        miss = int(totals.get(_MISSING + i, 0))
        row.update(element_count=n, unexpected_count=u, partial_unexpected_list=lists.get(i, []),
                   partial_unexpected_counts=tops.get(i, []), unexpected_percent_total=pct(u, n))
        if t == NOT_NULL:
            row.update(unexpected_percent=pct(u, n), success=((n - u) / n >= mostly) if n else True)
        else:
            nm = n - miss
            row.update(missing_count=miss, missing_percent=pct(miss, n), unexpected_percent=pct(u, nm),
                       unexpected_percent_nonmissing=pct(u, nm), success=((nm - u) / nm >= mostly) if nm else True)
        rows.append(row)
    return spark.createDataFrame([tuple(r[f.name] for f in RESULT_SCHEMA.fields) for r in rows], RESULT_SCHEMA)


def statistics(results: DataFrame) -> DataFrame:
    """Q8: evaluated, successful, unsuccessful, success percent and overall
    success per run."""
    return (results.groupBy("run_id", "checkpoint", "suite")
            .agg(F.count(F.lit(1)).alias("evaluated_expectations"),
                 F.count(F.when(F.col("success"), 1)).alias("successful_expectations"),
                 F.count(F.when(~F.col("success"), 1)).alias("unsuccessful_expectations"))
            .withColumn("success_percent", F.try_divide(F.col("successful_expectations"),
                                                        F.col("evaluated_expectations")) * 100)
            .withColumn("success", F.col("unsuccessful_expectations") == 0))


class QualityGateError(RuntimeError):
    """A validation failed: the pipeline must stop before loading."""

    def __init__(self, failures: list[dict]):
        self.failures = failures
        names = ", ".join(f"{f['expectation_type']}({f['column']})" for f in failures)
        super().__init__(f"{len(failures)} expectation(s) failed: {names}")


def gate(results: DataFrame) -> DataFrame:
    """Q10: raise ``QualityGateError`` if any expectation failed; otherwise
    return the (small, one row per expectation) results for storage."""
    rows = results.select("expectation_type", "column", "success", "unexpected_count").collect()
    failures = [r.asDict() for r in rows if not r["success"]]
    if failures:
        raise QualityGateError(failures)
    return results


def run_checkpoint(name: str, df: DataFrame, suite: Suite, run_time: datetime | None = None,
                   *, sample: int = 20) -> DataFrame:
    """Q11: a named (suite, dataset) run stamped with its run time."""
    run_time = run_time or datetime.now(timezone.utc)
    run_id = f"{name}-{run_time.strftime('%Y%m%dT%H%M%S.%fZ')}"
    return validate(df, suite, run_id=run_id, checkpoint=name, sample=sample).withColumn(
        "run_time", F.lit(run_time.replace(tzinfo=None)).cast("timestamp_ntz"))


def store_results(results: DataFrame, path: str) -> None:
    """Append result rows to the quality history table."""
    results.write.mode("append").parquet(path)


def quality_history(history: DataFrame) -> DataFrame:
    """Per (suite, expectation): runs, failures, first/last run and the
    status of the latest run."""
    key = ["suite", "expectation_index", "expectation_type", "column"]
    latest = F.max_by(F.struct("success", "unexpected_count"), "run_time")
    return (history.groupBy(*key)
            .agg(F.count(F.lit(1)).alias("runs"), F.count(F.when(~F.col("success"), 1)).alias("failed_runs"),
                 F.min("run_time").alias("first_run"), F.max("run_time").alias("last_run"),
                 latest.alias("_l"))
            .select(*key, "runs", "failed_runs", "first_run", "last_run",
                    F.col("_l.success").alias("latest_success"),
                    F.col("_l.unexpected_count").alias("latest_unexpected_count")))


def clean(df: DataFrame, *, required: list[str] = (), casts: dict[str, str] | None = None,
          fill: dict | None = None, unique: list[str] = (), trim: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Q12: business-rule cleaning. Values are typed with ``try_cast`` (bad
    text becomes null instead of failing, N16), ``fill`` supplies defaults,
    and rows missing a ``required`` value (null or NaN) — or whose cast failed —
    go to a quarantine frame with the list of failed rules. ``trim`` columns lose
    outer white space, an empty rest being null; of rows that agree in all
    ``unique`` columns one stays. Returns (clean, rejects)."""
    casts = casts or {}
    if trim:
        df = df.withColumns({c: F.nullif(F.trim(F.col(c)), F.lit("")) for c in trim})
    cast_fail = [F.when(F.col(c).isNotNull() & F.col(c).try_cast(t).isNull(), F.lit(f"cast:{c}:{t}"))
                 for c, t in casts.items()]
    out = df.withColumn("_cast_fail", F.array(*cast_fail) if cast_fail else F.array().cast("array<string>"))
    if casts:
        out = out.withColumns({c: F.col(c).try_cast(t) for c, t in casts.items()})
    if fill:
        out = out.fillna(fill)
    req_fail = [F.when(is_missing(out, c), F.lit(f"required:{c}")) for c in required]
    all_fail = F.concat(F.col("_cast_fail"), F.array(*req_fail)) if req_fail else F.col("_cast_fail")
    out = out.withColumn("failures", F.filter(all_fail, lambda x: x.isNotNull())).drop("_cast_fail")
    good = out.filter(F.size("failures") == 0).drop("failures")
    return good.dropDuplicates(list(unique)) if unique else good, out.filter(F.size("failures") > 0)
