"""Registered queries: data-quality suites and their statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from ledgerlens.operators import quality as q
from ledgerlens.plans import model
from ledgerlens.plans.catalog_model import _FACT_SQL, _MERCH_SQL, FACT_INPUT, MERCHANT_KEYS
from ledgerlens.plans.registry import register, with_events, with_ledger
from ledgerlens.sources.bindings import EVENTS_SQL, LEDGER_SQL
from ledgerlens.sources.bindings import event_ledger, ledger

SAMPLE = 20


def flat_results(res):
    """Result rows with the samples as text (stable across engines)."""
    top = F.transform("partial_unexpected_counts",
                      lambda x: F.concat(F.coalesce(x["value"], F.lit("null")), F.lit(":"), x["count"].cast("string")))
    return res.select(
        "suite", "expectation_index", "expectation_type", "column", "kwargs", "element_count", "missing_count",
        *[F.round(c, 6).alias(c) for c in ("missing_percent", "unexpected_percent",
                                            "unexpected_percent_nonmissing", "unexpected_percent_total")],
        "unexpected_count",
        F.when(F.col("partial_unexpected_list").isNotNull(),
               F.concat_ws("|", "partial_unexpected_list")).alias("unexpected_sample"),
        F.when(F.col("partial_unexpected_counts").isNotNull(), F.concat_ws("|", top)).alias("unexpected_top"),
        "observed_value", "success")


# ---------------------------------------------------------------- oracle text
def _sql_literal(v) -> str:
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return repr(v)


def _suite_sql(suite: q.Suite, src: str, types: dict[str, str]) -> str:
    parts = []
    for i, e in enumerate(suite.expectations):
        c = f'"{e.column}"'
        kw = _sql_literal(e.kwargs_json())
        head = f"""SELECT '{suite.name}' AS suite, CAST({i} AS INTEGER) AS expectation_index,
  '{e.expectation_type}' AS expectation_type, '{e.column}' AS "column", {kw} AS kwargs"""
        if e.expectation_type == q.OF_TYPE:
            want = q._TYPE_FAMILIES.get(str(e.kwargs["type_"]).lower(), {str(e.kwargs["type_"])})
            obs = types[e.column]
            parts.append(f"""{head}, CAST(NULL AS BIGINT) AS element_count, CAST(NULL AS BIGINT) AS missing_count,
  CAST(NULL AS DOUBLE) AS missing_percent, CAST(NULL AS DOUBLE) AS unexpected_percent,
  CAST(NULL AS DOUBLE) AS unexpected_percent_nonmissing, CAST(NULL AS DOUBLE) AS unexpected_percent_total,
  CAST(NULL AS BIGINT) AS unexpected_count, CAST(NULL AS VARCHAR) AS unexpected_sample,
  CAST(NULL AS VARCHAR) AS unexpected_top, '{obs}' AS observed_value, {str(obs in want).lower()} AS success""")
            continue
        mostly = float(e.kwargs.get("mostly", 1.0))
        if e.expectation_type == q.UNIQUE:
            bad = f"""SELECT CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM {src} WHERE {c} IS NOT NULL
  GROUP BY {c} HAVING count(*) > 1"""
            ucount = "(SELECT coalesce(sum(cnt), 0) FROM bad)"
        else:
            k = e.kwargs
            if e.expectation_type == q.NOT_NULL:
                cond = f"{c} IS NULL"
            elif e.expectation_type == q.BETWEEN:
                ok = ["true"]
                if k.get("min_value") is not None:
                    ok.append(f"{c} {'>' if k.get('strict_min') else '>='} {k['min_value']}")
                if k.get("max_value") is not None:
                    ok.append(f"{c} {'<' if k.get('strict_max') else '<='} {k['max_value']}")
                cond = f"{c} IS NOT NULL AND NOT ({' AND '.join(ok)})"
            else:
                is_bool = types[e.column] == "boolean"
                vals = sorted({(bool(v) if is_bool else int(v)) if isinstance(v, (bool, int)) else v
                               for v in k["value_set"]}, key=repr)
                cond = f"{c} IS NOT NULL AND {c} NOT IN ({', '.join(_sql_literal(v) for v in vals)})"
            bad = f"SELECT CAST({c} AS VARCHAR) AS value, count(*) AS cnt FROM {src} WHERE {cond} GROUP BY 1"
            ucount = "(SELECT coalesce(sum(cnt), 0) FROM bad)"
        n = f"(SELECT count(*) FROM {src})"
        miss = f"(SELECT count(*) FROM {src} WHERE {c} IS NULL)"
        nm = f"({n} - {miss})"
        if e.expectation_type == q.NOT_NULL:
            metrics = f"""{n} AS element_count, CAST(NULL AS BIGINT) AS missing_count, CAST(NULL AS DOUBLE) AS missing_percent,
  round(CAST({ucount} AS DOUBLE) / {n} * 100, 6) AS unexpected_percent,
  CAST(NULL AS DOUBLE) AS unexpected_percent_nonmissing,
  round(CAST({ucount} AS DOUBLE) / {n} * 100, 6) AS unexpected_percent_total,
  CAST({ucount} AS BIGINT) AS unexpected_count,
  coalesce(CAST({n} - {ucount} AS DOUBLE) / nullif({n}, 0) >= {mostly}, true) AS success"""
        else:
            metrics = f"""{n} AS element_count, {miss} AS missing_count,
  round(CAST({miss} AS DOUBLE) / {n} * 100, 6) AS missing_percent,
  round(CAST({ucount} AS DOUBLE) / nullif({nm}, 0) * 100, 6) AS unexpected_percent,
  round(CAST({ucount} AS DOUBLE) / nullif({nm}, 0) * 100, 6) AS unexpected_percent_nonmissing,
  round(CAST({ucount} AS DOUBLE) / {n} * 100, 6) AS unexpected_percent_total,
  CAST({ucount} AS BIGINT) AS unexpected_count,
  coalesce(CAST(({nm}) - ({ucount}) AS DOUBLE) / nullif({nm}, 0) >= {mostly}, true) AS success"""
        parts.append(f"""SELECT * FROM (WITH bad AS ({bad})
{head}, {metrics},
  coalesce((SELECT string_agg(value, '|' ORDER BY value) FROM (SELECT value FROM bad ORDER BY value NULLS FIRST
    LIMIT {SAMPLE}) WHERE value IS NOT NULL), '') AS unexpected_sample,
  coalesce((SELECT string_agg(coalesce(value, 'null') || ':' || CAST(cnt AS VARCHAR), '|'
    ORDER BY cnt DESC, value NULLS FIRST) FROM (SELECT * FROM bad ORDER BY cnt DESC, value NULLS FIRST
    LIMIT {SAMPLE})), '') AS unexpected_top,
  CAST(NULL AS VARCHAR) AS observed_value)""")
    return "\nUNION ALL BY NAME\n".join(parts)


_FACT_TYPES = {"trx_id": "string", "cc_number": "bigint", "merchant_id": "bigint", "amt": "double",
               "is_fraud": "boolean"}
_RAW_TYPES = {"trans_num": "string", "cc_num": "bigint", "amt": "double", "is_fraud": "int"}


def _fact(spark, sf):
    raw = ledger(spark, sf, FACT_INPUT)
    return model.fact_transaction(raw, model.dim_merchant(raw, names=ledger(spark, sf, MERCHANT_KEYS)))


@register("quality_min_suite", with_ledger(f"WITH {_MERCH_SQL}, fact AS ({_FACT_SQL})\n"
                                           + _suite_sql(q.MINIMAL_SUITE, "fact", _FACT_TYPES)))
def quality_min_suite(spark, sf):
    return flat_results(q.validate(_fact(spark, sf), q.MINIMAL_SUITE, sample=SAMPLE))


@register("quality_fact_suite", with_ledger(f"WITH {_MERCH_SQL}, fact AS ({_FACT_SQL})\n"
                                            + _suite_sql(q.FACT_SUITE, "fact", _FACT_TYPES)), bench=True)
def quality_fact_suite(spark, sf):
    return flat_results(q.validate(_fact(spark, sf), q.FACT_SUITE, sample=SAMPLE))


@register("quality_raw_suite", with_ledger(_suite_sql(q.RAW_SUITE, "ledger", _RAW_TYPES)))
def quality_raw_suite(spark, sf):
    return flat_results(q.validate(ledger(spark, sf, ["trans_num", "cc_num", "amt", "is_fraud"]),
                                   q.RAW_SUITE, sample=SAMPLE))


RAW_SUITE_EVENTS_SQL = with_events(_suite_sql(q.RAW_SUITE, "ev", _RAW_TYPES))


@register("quality_events_raw_suite", RAW_SUITE_EVENTS_SQL)
def quality_events_raw_suite(spark, sf):
    return flat_results(q.validate(event_ledger(spark, sf, ["trans_num", "cc_num", "amt", "is_fraud"]),
                                   q.RAW_SUITE, sample=SAMPLE))


@register("quality_stats", with_ledger(f"""WITH {_MERCH_SQL}, fact AS ({_FACT_SQL}),
r AS ({_suite_sql(q.FACT_SUITE, "fact", _FACT_TYPES)})
SELECT suite, count(*) AS evaluated_expectations, count(CASE WHEN success THEN 1 END) AS successful_expectations,
  count(CASE WHEN NOT success THEN 1 END) AS unsuccessful_expectations,
  round(count(CASE WHEN success THEN 1 END) * 100.0 / count(*), 6) AS success_percent,
  count(CASE WHEN NOT success THEN 1 END) = 0 AS success FROM r GROUP BY suite"""))
def quality_stats(spark, sf):
    st = q.statistics(q.validate(_fact(spark, sf), q.FACT_SUITE, sample=SAMPLE))
    return st.select("suite", "evaluated_expectations", "successful_expectations", "unsuccessful_expectations",
                     F.round("success_percent", 6).alias("success_percent"), "success")


# ---------------------------------------------------------------- S12 / S13: quality history
_RUNS = [("ledger_raw", "2024-01-01 09:10:00"), ("events_raw", "2024-01-08 09:10:00")]


@register("quality_history", f"""WITH {LEDGER_SQL.strip()}, {EVENTS_SQL.strip()},
r1 AS ({_suite_sql(q.RAW_SUITE, "ledger", _RAW_TYPES)}),
r2 AS ({_suite_sql(q.RAW_SUITE, "ev", _RAW_TYPES)}),
h AS (SELECT *, TIMESTAMP '{_RUNS[0][1]}' AS run_time FROM r1
      UNION ALL BY NAME SELECT *, TIMESTAMP '{_RUNS[1][1]}' AS run_time FROM r2)
SELECT suite, expectation_index, expectation_type, "column", count(*) AS runs,
  count(CASE WHEN NOT success THEN 1 END) AS failed_runs, min(run_time) AS first_run, max(run_time) AS last_run,
  arg_max(success, run_time) AS latest_success, arg_max(unexpected_count, run_time) AS latest_unexpected_count
FROM h GROUP BY ALL""")
def quality_history(spark, sf):
    """Two checkpoint runs of the raw suite (line items, then events) appended
    to a history table in the shared folder, then summarised per expectation."""
    import datetime as dt
    import uuid

    from ledgerlens.session import scratch_path
    path = scratch_path(spark, f"quality_history/{uuid.uuid4().hex[:8]}")
    cols = ["trans_num", "cc_num", "amt", "is_fraud"]
    for (name, when), src in zip(_RUNS, (ledger(spark, sf, cols), event_ledger(spark, sf, cols))):
        run = q.run_checkpoint(name, src, q.RAW_SUITE, dt.datetime.fromisoformat(when))
        q.store_results(run, path)
    return q.quality_history(spark.read.parquet(path))


# ---------------------------------------------------------------- Q12: cleaning with quarantine
@register("clean_rejects", with_ledger("""
SELECT trans_num, merch_zipcode, 'required:merch_zipcode' AS failures FROM ledger WHERE merch_zipcode IS NULL"""))
def clean_rejects(spark, sf):
    df = ledger(spark, sf, ["trans_num", "merch_zipcode"])
    _, rejects = q.clean(df, required=["merch_zipcode"], casts={"merch_zipcode": "bigint"})
    return rejects.select("trans_num", F.col("merch_zipcode").cast("string").alias("merch_zipcode"),
                          F.concat_ws("|", "failures").alias("failures"))
