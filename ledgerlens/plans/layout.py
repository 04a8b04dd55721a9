"""Processed tables laid out for their joins (S6, M6): bucketed and sorted on
the join key, read through the catalogue, so that a join or aggregate on the
key needs no shuffle of such a table.

Bucket on a key whose hottest value fits a task: a bucket is one task, which
adaptive execution does not split. For a hot key leave the table unbucketed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _name(path: str) -> str:
    return "processed_" + hashlib.md5(path.encode()).hexdigest()[:16]


def _keys(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def open_bucketed(spark: SparkSession, path: str, schema: T.StructType, key: str | Sequence[str],
                  buckets: int) -> DataFrame:
    """The table at ``path`` as the catalogue's: registered anew where this
    session's catalogue does not know it. Layout and schema must be those it
    was written with; tables joined without a shuffle have equal bucket counts."""
    cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    keys = ", ".join(f"`{k}`" for k in _keys(key))
    name = _name(path)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) "
              f"INTO {int(buckets)} BUCKETS LOCATION '{path}'")
    spark.catalog.refreshTable(name)
    return spark.table(name)


ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 100_000  # Spark's own bound (spark.sql.sources.bucketing.maxBuckets)


def buckets_for(rows: int, least: int = 8) -> int:
    """Buckets for a table of so many rows: a bucket, hence a task, keeps its
    size when the table grows. Tables joined without a shuffle need one count."""
    return min(MAX_BUCKETS, max(least, -(-rows // ROWS_PER_BUCKET)))


def write_bucketed(df: DataFrame, path: str, key: str | Sequence[str], buckets: int = 64) -> DataFrame:
    """Write (or replace) the table at ``path``, a file per bucket, and return
    it as read through the catalogue."""
    spark = df.sparkSession
    open_bucketed(spark, path, df.schema, key, buckets)
    keys = [F.col(k) for k in _keys(key)]
    df.repartition(buckets, *keys).sortWithinPartitions(*keys).write.insertInto(_name(path), overwrite=True)
    return open_bucketed(spark, path, df.schema, key, buckets)
