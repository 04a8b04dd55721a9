"""Loads that follow each other: landing, stable keys, all-or-nothing merges, headers by name, null groups."""

import pytest
from pyspark.sql import functions as F

from ledgerlens.operators import profile, rates
from ledgerlens.operators.keymap import KeyMap
from ledgerlens.plans import model, pipeline
from ledgerlens.sources import files

DRIVER = {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
HEADER = ["", *files.RAW_SCHEMA.fieldNames()[1:]]


def row(i, day, merchant, city="City", name=None):
    who = name or f"F{i}"
    return dict(zip(HEADER, [str(i), f"2020-01-{day:02d} 10:00:00", f"4{i}", f"fraud_{merchant}", "shop", "10.5", who, f"L{who}", "F",
                             "1 Street", city, "TX", "75001", "30.0", "-97.0", "1000", "Job", "1980-01-01", f"t{i}", "1577872800",
                             "30.1", "-97.1", "0", "75001"]))


def write(path, rows, header=HEADER):
    path.write_text("\n".join([",".join(header)] + [",".join(r[h] for h in header) for r in rows]) + "\n")
    return str(path)


# ------------------------------------------------------------------- CSV
def test_columns_are_bound_by_header_name(spark, tmp_path):
    swapped = list(HEADER)
    i, j = swapped.index("first"), swapped.index("last")
    swapped[i], swapped[j] = swapped[j], swapped[i]
    (tmp_path / "in").mkdir()
    write(tmp_path / "in" / "a.csv", [row(1, 1, "A")])
    write(tmp_path / "in" / "b.csv", [row(2, 2, "B")], swapped)
    write(tmp_path / "in" / "c.csv", [row(3, 3, "C")], [h for h in HEADER if h != "job"])
    got = {r.trans_num: r for r in files.read_raw_csv(spark, str(tmp_path / "in")).collect()}
    assert {k: (r["first"], r["last"], r.job, r.amt) for k, r in got.items()} == {
        "t1": ("F1", "LF1", "Job", 10.5), "t2": ("F2", "LF2", "Job", 10.5), "t3": ("F3", "LF3", None, 10.5)}
    assert "_c0" not in files.read_raw_csv(spark, str(tmp_path / "in")).columns
    text = {r.trans_num: (r["first"], r.job) for r in files.read_raw_text_csv(spark, str(tmp_path / "in")).collect()}
    assert text == {"t1": ("F1", "Job"), "t2": ("F2", "Job"), "t3": ("F3", None)}


# --------------------------------------------------------------- landing
def test_files_of_one_day_both_stay_and_none_lands_twice(spark, tmp_path):
    a, b, dest = write(tmp_path / "a.csv", [row(1, 1, "A")]), write(tmp_path / "b c.csv", [row(2, 2, "B"), row(3, 2, "B")]), str(tmp_path / "raw")
    assert files.land_raw(spark, a, dest, ingest_date="2020-02-01").count() == 1
    assert files.land_raw(spark, b, dest, ingest_date="2020-02-01").count() == 2
    again = files.land_raw(spark, a, dest, ingest_date="2020-02-05")
    assert [str(r._ingest_date) for r in again.collect()] == ["2020-02-01"]
    assert spark.read.parquet(dest).count() == 3 and files.manifest(spark, dest).count() == 2
    write(tmp_path / "a.csv", [row(1, 1, "A"), row(9, 1, "A")])  # the same name, other content
    assert files.land_raw(spark, a, dest, ingest_date="2020-02-05").count() == 2
    entries = files.manifest(spark, dest).collect()
    assert len(entries) == 3 and len({r.run for r in entries}) == 3 and all(r["size"] > 0 for r in entries)


def test_a_run_over_midnight_and_a_failed_one(spark, tmp_path, monkeypatch):
    a, dest = write(tmp_path / "a.csv", [row(1, 1, "A")]), str(tmp_path / "raw")
    day = spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    landed = files.land_raw(spark, a, dest)  # today, and read by that date whenever it is evaluated
    assert "current_date" not in landed._jdf.queryExecution().toString() and [str(r._ingest_date) for r in landed.collect()] == [day]
    # rows written by a run that failed before its manifest entry are not seen
    b = write(tmp_path / "b.csv", [row(2, 1, "A")])
    left = files.land_raw(spark, b, str(tmp_path / "other"), ingest_date="2020-01-31")
    left.write.mode("append").partitionBy("_ingest_date", "_file").parquet(dest)
    got = files.land_raw(spark, b, dest, ingest_date="2020-02-01").collect()
    assert [(r.trans_num, str(r._ingest_date)) for r in got] == [("t2", "2020-02-01")]


# ------------------------------------------------------------------ keys
def test_ids_are_kept_and_continued(spark, tmp_path):
    store = KeyMap(spark, str(tmp_path / "k"), ["a", "b"], "id")
    first = spark.createDataFrame([("x", 1, 5), (None, 1, 3), ("y", None, 4)], "a string, b int, o int")
    got = {(r.a, r.b): r.id for r in store.assign(first, ["o"]).collect()}
    assert got == {(None, 1): 1, ("y", None): 2, ("x", 1): 3}
    second = spark.createDataFrame([("w", 1, 1), ("x", 1, 2), (None, 1, 9), (None, None, 3)], "a string, b int, o int")
    for _ in range(2):  # the second time nothing is new
        later = {(r.a, r.b): r.id for r in store.assign(second, ["o"]).collect()}
        assert later == {("w", 1): 4, ("x", 1): 3, (None, 1): 1, (None, None): 5}
    assert store.table(second).count() == 5
    assert KeyMap(spark, str(tmp_path / "k"), ["a", "b"], "id").assign(first.limit(0), ["o"]).count() == 0


@pytest.mark.parametrize("mode", ["merge", "skip_existing"])
def test_overlapping_loads_keep_ids_and_leave_no_orphan(spark, tmp_path, mode):
    target = pipeline.JdbcTarget(f"jdbc:derby:memory:ll_inc_{mode};create=true", DRIVER, num_partitions=2)
    one = write(tmp_path / "one.csv", [row(1, 5, "A"), row(2, 6, "B", city="Town"), row(3, 7, "A")])
    # earlier days, an old and a new merchant, city and person
    two = write(tmp_path / "two.csv", [row(4, 1, "C", city="Village"), row(5, 2, "B", city="Town"), row(2, 6, "B", city="Town"), row(6, 3, "A", name="F1")])
    seen = []
    for src in (one, two, two, one):
        pipeline.run_pipeline(spark, src, str(tmp_path / "work"), target=target, load_mode=mode)
        back = {n: spark.read.jdbc(target.url, n, properties=DRIVER) for n in model.LOAD_ORDER}
        seen.append({n: sorted(map(str, back[n].collect())) for n in back})
        assert model.integrity_report(back).agg(F.sum("orphan_rows")).first()[0] == 0
    for n in model.LOAD_ORDER:
        assert set(seen[0][n]) <= set(seen[1][n]) and seen[1][n] == seen[2][n] == seen[3][n], n
    facts = spark.read.jdbc(target.url, "fact_transaction", properties=DRIVER)
    merchants = {r.merch_id: r.merch_name for r in spark.read.jdbc(target.url, "dim_merchant", properties=DRIVER).collect()}
    assert {r.trx_id: merchants[r.merchant_id] for r in facts.collect()} == {
        "t1": "A", "t2": "B", "t3": "A", "t4": "C", "t5": "B", "t6": "A"}
    assert sorted(merchants) == [1, 2, 3]


def test_a_load_that_fails_half_way_changes_nothing(spark, tmp_path):
    target = pipeline.JdbcTarget("jdbc:derby:memory:ll_atomic;create=true", DRIVER, num_partitions=2)
    src = write(tmp_path / "one.csv", [row(1, 5, "A"), row(2, 6, "B")])
    out = pipeline.run_pipeline(spark, src, str(tmp_path / "work"), target=target, load_mode="merge")
    before = {n: spark.read.jdbc(target.url, n, properties=DRIVER).count() for n in model.LOAD_ORDER}
    tables = {n: spark.read.parquet(p) for n, p in out["paths"].items()}
    more = tables["dim_city"].withColumn("city_id", F.col("city_id") + 100)

    # a task fails while the fact is written, after its parents are staged
    @F.udf("double")
    def broken(x):
        raise ValueError("lost")

    bad = {**tables, "dim_city": more, "fact_transaction": tables["fact_transaction"].withColumn("amt", broken("amt"))}
    with pytest.raises(Exception):
        pipeline.load_star(spark, bad, target, mode="merge")
    # the database refuses a row in the last statement of the transaction
    connection = pipeline._connect(spark, target)
    pipeline._execute(connection, 'ALTER TABLE fact_transaction ADD CONSTRAINT cheap CHECK ("amt" < 1000)')
    connection.close()
    dear = tables["fact_transaction"].withColumns({"trx_id": F.concat("trx_id", F.lit("x")), "amt": F.lit(5000.0)})
    with pytest.raises(Exception):
        pipeline.load_star(spark, {**tables, "dim_city": more, "fact_transaction": dear}, target, mode="merge")
    assert {n: spark.read.jdbc(target.url, n, properties=DRIVER).count() for n in model.LOAD_ORDER} == before
    report = pipeline.load_star(spark, {**tables, "dim_city": more}, target, mode="merge").collect()
    assert {r["table"]: r["rows"] for r in report} == {n: (before["dim_city"] if n == "dim_city" else 0) for n in model.LOAD_ORDER}
    staged = spark.read.jdbc(target.url, "(SELECT tablename FROM sys.systables WHERE tablename LIKE 'STAGE%') t", properties=DRIVER)
    assert staged.count() == 0


# ----------------------------------------------------------- null groups
def test_null_and_valueless_groups_keep_their_rows(spark):
    rows = [(None, float(v)) for v in range(1, 12)] + [(None, 500.0)] + [("a", float(v)) for v in range(5)] + [("b", None)] * 3
    df = spark.createDataFrame(rows, "g string, x double")
    exact = {r.g: (r.p25, r.p50) for r in df.groupBy("g").agg(F.percentile("x", F.lit(0.25)).alias("p25"),
                                                             F.percentile("x", F.lit(0.5)).alias("p50")).collect()}
    got = {r.g: (r.p25, r.p50) for r in profile.percentile_set(df, "x", (0.25, 0.5), by=["g"]).collect()}
    assert got == exact and got["b"] == (None, None)
    assert {r.g: r["count"] for r in profile.describe(df, ["x"], by=["g"]).collect()} == {None: 12, "a": 5}  # its rows are values
    uni = {r.g: r for r in profile.univariate(df, ["x"], by=["g"]).collect()}
    assert uni[None].outlier_count == 1 and uni["a"].median == 2.0 and uni[None]["median"] == exact[None][1]
    kept = profile.iqr_filter(df, "x", by=["g"])
    assert kept.columns == ["g", "x"] and {r.g for r in kept.collect()} == {None, "a"} and kept.filter("x = 500").count() == 0
    box = {r.g: (r.outlier_count, r.whisker_high) for r in profile.box_stats(df, "x", by=["g"]).collect()}
    assert box[None] == (1, 11.0) and box["a"] == (0, 4.0)
    assert rates.label_summary(df.withColumn("y", F.lit(1)), "x", "y").count() == 1
