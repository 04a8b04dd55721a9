"""Keys that earlier micro-batches of a stream have brought (Q2 on a stream).

A table of (check, value), partitioned by the batch that brought the key and
bucketed by the key, so that a batch is compared with the whole history
without moving the history: only the batch's own keys are shuffled. A batch
reads the keys of batches before it and overwrites its own partition, hence a
replay finds what its first attempt found and leaves the same table.

Every ``merge_every`` batches the partitions so far are merged into one, which
bounds the number of files. A failure in between leaves keys twice at most,
which changes no answer, as only their presence is asked.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SeenKeys:
    """The store at ``path`` (shared storage). One stream writes it at a time;
    its bucket count is fixed when it is made: size it for the final history."""

    def __init__(self, spark: SparkSession, path: str, *, buckets: int = 64, merge_every: int = 64):
        self.buckets, self.merge_every = buckets, merge_every
        self.name = "seen_keys_" + hashlib.md5(path.encode()).hexdigest()[:16]
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.name} (check_id INT, value STRING, merged INT, batch BIGINT) "
                  f"USING parquet PARTITIONED BY (merged, batch) CLUSTERED BY (check_id, value) "
                  f"SORTED BY (check_id, value) INTO {buckets} BUCKETS LOCATION '{path}'")
        spark.createDataFrame([], "check_id int").write.mode("ignore").parquet(path)  # the folder, if new
        spark.catalog.recoverPartitions(self.name)  # what earlier sessions wrote

    def before(self, spark: SparkSession, batch: int) -> DataFrame:
        return spark.table(self.name).filter(F.col("batch") < batch).select("check_id", "value")

    def mark(self, keys: DataFrame, batch: int) -> DataFrame:
        """``keys`` (i, value, …), one row each, with the boolean ``seen``: whether a
        batch before ``batch`` brought the key. A key of the store that a failed
        merge left twice still counts once."""
        held = self.before(keys.sparkSession, batch).withColumn("seen", F.lit(True))
        held = held.groupBy("check_id", "value").agg(F.first("seen").alias("seen"))
        on = (keys["i"] == held["check_id"]) & (keys["value"] == held["value"])
        return keys.join(held.hint("merge"), on, "left").select(
            *[keys[c] for c in keys.columns], F.coalesce("seen", F.lit(False)).alias("seen"))

    def add(self, keys: DataFrame, batch: int) -> None:
        """Set the keys (i, value) that ``batch`` has brought, one file per bucket."""
        self._overwrite(keys.select(F.col("i").alias("check_id"), "value").distinct(), 0, batch)

    def merge(self, spark: SparkSession, batch: int) -> None:
        """Before ``batch``: merge all partitions of committed batches into one."""
        parts = [(r["merged"], r["batch"]) for r in spark.sql(f"SHOW PARTITIONS {self.name}").select(
            F.regexp_extract("partition", r"merged=(\d+)", 1).cast("int").alias("merged"),
            F.regexp_extract("partition", r"batch=(\d+)", 1).cast("long").alias("batch")).collect()]
        old = [p for p in parts if p[1] < batch and p != (1, batch - 1)]
        if not [p for p in old if p[0] == 0]:
            return
        held = spark.table(self.name).filter((F.col("batch") < batch)
                                             & ~((F.col("merged") == 1) & (F.col("batch") == batch - 1)))
        held = held.select("check_id", "value").distinct().checkpoint()  # a table that is read can't be overwritten
        self._overwrite(held, 1, batch - 1)
        none = spark.createDataFrame([], held.schema)
        for merged, b in old:
            self._overwrite(none, merged, b)  # frees its files
            spark.sql(f"ALTER TABLE {self.name} DROP PARTITION (merged={merged}, batch={b})")

    def _overwrite(self, keys: DataFrame, merged: int, batch: int) -> None:
        view = f"{self.name}_in"
        keys.repartition(self.buckets, "check_id", "value").createOrReplaceTempView(view)
        keys.sparkSession.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION (merged={merged}, batch={batch}) "
                              f"SELECT check_id, value FROM {view}")
        keys.sparkSession.catalog.dropTempView(view)
