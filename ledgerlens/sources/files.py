"""File sources and sinks of the raw and processed layers.

* raw CSV is read with an explicit schema (no inference pass over the data) bound
  to each file's header by name, dates parsed by format, malformed records kept in
  a corrupt-record column;
* the raw landing keeps the source text unchanged (every column a string)
  plus lineage columns, written as parquet; a manifest of the files that have
  landed decides what is new;
* processed tables are written one folder per table.
"""

from __future__ import annotations

import csv
import os
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

RAW_SCHEMA = T.StructType([
    T.StructField("_c0", T.LongType()),
    T.StructField("trans_date_trans_time", T.TimestampNTZType()),
    T.StructField("cc_num", T.LongType()),
    T.StructField("merchant", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("amt", T.DoubleType()),
    T.StructField("first", T.StringType()),
    T.StructField("last", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("street", T.StringType()),
    T.StructField("city", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("zip", T.StringType()),
    T.StructField("lat", T.DoubleType()),
    T.StructField("long", T.DoubleType()),
    T.StructField("city_pop", T.LongType()),
    T.StructField("job", T.StringType()),
    T.StructField("dob", T.DateType()),
    T.StructField("trans_num", T.StringType()),
    T.StructField("unix_time", T.LongType()),
    T.StructField("merch_lat", T.DoubleType()),
    T.StructField("merch_long", T.DoubleType()),
    T.StructField("is_fraud", T.IntegerType()),
    T.StructField("merch_zipcode", T.StringType()),
])

TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
DATE_FORMAT = "yyyy-MM-dd"


def require_path(spark: SparkSession, path: str) -> None:
    """S3: fail fast with a clear message when the input is missing."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(p):
        raise FileNotFoundError(f"Input file not found: {path}")


def _header(spark: SparkSession, path: str) -> list[str]:
    """Column names in the first line of a CSV file, as Spark names them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    stream = p.getFileSystem(conf).open(p)
    try:
        codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(p)
        lines = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(
            codec.createInputStream(stream) if codec else stream, "UTF-8"))
        line = lines.readLine()
    finally:
        stream.close()
    names = next(csv.reader([(line or "").lstrip("\ufeff")]), [])
    return [n or f"_c{i}" for i, n in enumerate(names)]


def _by_header(spark: SparkSession, path: str | list[str]) -> dict[tuple[str, ...], list[str]]:
    """The files of ``path`` by their header; the driver reads a line of each file."""
    files = sorted(unquote(f) for f in spark.read.text(path).inputFiles())
    out: dict[tuple[str, ...], list[str]] = {}
    for f in files:
        out.setdefault(tuple(_header(spark, f)), []).append(f)
    return {h: fs for h, fs in out.items() if h}


def read_raw_csv(spark: SparkSession, path: str, schema: T.StructType = RAW_SCHEMA, *,
                 corrupt_column: str = "_corrupt_record") -> DataFrame:
    """Header CSV with a declared schema, columns bound by the name in each
    file's header wherever they stand; a declared column that no header has is
    null, one that is not declared is left out. The leading index column (empty
    header) is dropped, bad rows keep their text in ``corrupt_column``."""
    require_path(spark, path)
    declared = {f.name: f for f in schema.fields}
    corrupt = T.StructField(corrupt_column, T.StringType())
    out = None
    for header, files in _by_header(spark, path).items():
        full = T.StructType([declared.get(n, T.StructField(n, T.StringType())) for n in header] + [corrupt])
        df = (spark.read.schema(full).option("header", True).option("mode", "PERMISSIVE")
              .option("columnNameOfCorruptRecord", corrupt_column)
              .option("timestampNTZFormat", TIMESTAMP_FORMAT).option("dateFormat", DATE_FORMAT)
              .option("enforceSchema", True).csv(files))
        part = df.select(*[n for n in header if n in declared], corrupt_column)
        missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields if f.name not in header]
        part = part.select("*", *missing).select(*declared, corrupt_column)
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], T.StructType([*schema.fields, corrupt]))
    return out.drop("_c0", "Unnamed: 0")


def read_raw_text_csv(spark: SparkSession, path: str | list[str], *, source_column: str | None = None) -> DataFrame:
    """All-string read: the source exactly as written, columns by header name;
    with ``source_column``, the path of each row's file."""
    if isinstance(path, str):
        require_path(spark, path)
    out = None
    for header, files in _by_header(spark, path).items():
        schema = T.StructType([T.StructField(n, T.StringType()) for n in header])
        df = spark.read.schema(schema).option("header", True).csv(files)
        if source_column:
            df = df.select("*", F.col("_metadata.file_path").alias(source_column))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        out = spark.createDataFrame([], T.StructType([T.StructField(n, T.StringType()) for n in RAW_SCHEMA.fieldNames()]))
    return out


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """(file, size, digest) of every file of ``path`` that has a line. The digest is
    made of the number of lines and of sums of their hashes, so that a large file
    is read in splits; equal files give equal digests."""
    lines = spark.read.text(path).select("_metadata.file_path", "_metadata.file_size", "value")
    return (lines.groupBy(F.col("file_path").alias("file"), F.col("file_size").alias("size"))
            .agg(F.sha2(F.concat_ws("|", F.count(F.lit(1)), F.sum(F.xxhash64("value").cast("decimal(38,0)")),
                                    F.sum(F.xxhash64("value", F.lit(1)).cast("decimal(38,0)"))), 256).alias("digest")))


_MANIFEST = "file string, size bigint, digest string, part string, ingest_date date, run string"


def manifest(spark: SparkSession, dest: str) -> DataFrame:
    """The ledger of landed files: file, size, digest, part, ingest_date, run."""
    path = f"{dest.rstrip('/')}_manifest"
    try:
        require_path(spark, f"{path}/_SUCCESS")
    except FileNotFoundError:
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).parquet(path)


def land_raw(spark: SparkSession, src: str, dest: str, *, ingest_date: str | None = None) -> DataFrame:
    """Store the files of ``src`` unmodified (all columns as text) as parquet
    with their names and the ingest date, a partition per date and file, and enter
    them in the manifest; a file of the same name, size and content that is there
    already is not landed again. Returns the rows of the files that ``src`` holds
    now, whenever they landed.

    The date is fixed once, so a run over midnight reads what it wrote. The
    manifest is written last and rows are read through it: what a failed run left
    behind is not seen, and the next run lands those files anew."""
    require_path(spark, src)
    day = ingest_date or spark.sql("SELECT CAST(current_date() AS STRING)").first()[0]
    listed = file_digests(spark, src).withColumn(
        "part", F.concat(F.lit("f"), F.substring(F.sha2(F.concat_ws("|", "file", "digest"), 256), 1, 24)))
    listed = spark.createDataFrame(listed.collect(), listed.schema)  # a row per file
    known = manifest(spark, dest)
    new = listed.join(known.select("part"), "part", "left_anti")
    paths = [unquote(r.file) for r in new.collect()]
    if paths:
        parts = new.select(F.col("file").alias("_source_file"), F.col("part").alias("_file"))
        rows = read_raw_text_csv(spark, paths, source_column="_source_file")
        (rows.join(F.broadcast(parts), "_source_file").withColumn("_ingest_date", F.lit(day).cast("date"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("_ingest_date", "_file").parquet(dest))
        entry = new.select("file", "size", "digest", "part", F.lit(day).cast("date").alias("ingest_date"),
                           F.lit(uuid.uuid4().hex).alias("run"))
        entry.coalesce(1).write.mode("append").parquet(f"{dest.rstrip('/')}_manifest")
    seen = (manifest(spark, dest).join(F.broadcast(listed.select("part")), "part", "left_semi")
            .select(F.col("ingest_date").alias("_ingest_date"), F.col("part").alias("_file")).distinct())
    if seen.isEmpty():
        return read_raw_text_csv(spark, src)
    return spark.read.parquet(dest).join(F.broadcast(seen), ["_ingest_date", "_file"], "left_semi")


def type_raw(df: DataFrame, schema: T.StructType = RAW_SCHEMA) -> DataFrame:
    """Type a landed all-string table with ``try_cast``/``try_to_timestamp``:
    bad text becomes null (N16) and is caught by the quality gate."""
    out = []
    for f in schema.fields:
        if f.name not in df.columns:
            continue
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.TimestampNTZType):
            # parsed as wall-clock time: no zone, so no shift at a clock change
            out.append(F.when(F.length(c) == len("2020-01-01 00:00:00"), c.try_cast("timestamp_ntz")).alias(f.name))
        elif isinstance(f.dataType, T.DateType):
            out.append(F.try_to_timestamp(c, F.lit(DATE_FORMAT)).cast("date").alias(f.name))
        else:
            out.append(c.try_cast(f.dataType).alias(f.name))
    return df.select(*out)


def calendar(spark: SparkSession, start: str, end: str) -> DataFrame:
    """One row per day."""
    return spark.range(1).select(F.explode(F.sequence(F.to_date(F.lit(start)), F.to_date(F.lit(end)),
                                                      F.expr("INTERVAL 1 DAY"))).alias("full_date"))


def write_layer(tables: dict[str, DataFrame], base: str, *, fmt: str = "parquet", mode: str = "overwrite",
                partition_by: dict[str, list[str]] | None = None) -> dict[str, str]:
    """One folder per table under ``base`` (created on demand)."""
    paths = {}
    for name, df in tables.items():
        path = os.path.join(base, name) if "://" not in base else f"{base.rstrip('/')}/{name}"
        w = df.write.mode(mode)
        if partition_by and name in partition_by:
            w = w.partitionBy(*partition_by[name])
        (w.option("header", True).csv(path) if fmt == "csv" else w.format(fmt).save(path))
        paths[name] = path
    return paths


ROWS_PER_FILE = 1_000_000  # a compressed file is read by one task


def write_csv(df: DataFrame, path: str, *, compression: str | None = None) -> None:
    """CSV with header, timestamps in the raw text format. A compressed file cannot
    be read in splits, so each then holds at most ``ROWS_PER_FILE`` rows."""
    w = (df.write.mode("overwrite").option("header", True).option("timestampNTZFormat", TIMESTAMP_FORMAT)
         .option("dateFormat", DATE_FORMAT))
    if compression:
        w = w.option("compression", compression).option("maxRecordsPerFile", ROWS_PER_FILE)
    w.csv(path)


def preview(df: DataFrame, n: int = 5) -> DataFrame:
    """The first rows (a limit is the feature here)."""
    return df.limit(n)
