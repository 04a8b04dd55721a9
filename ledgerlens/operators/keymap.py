"""Surrogate keys that stay the same from load to load (K1 with M2–M4).

A dense key by first appearance changes when a later input brings earlier rows or
new members. Here the pairs (natural key → id) are a stored table: a load joins its
members to it null-safely, members it does not know get the ids after the greatest
one given so far, in the load's own order, and are appended by one committed write.
A load that fails afterwards and runs again finds its members in the table.

One load at a time may assign ids of one table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.operators.keys import with_row_number


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on ``keys``, null matching null; the keys and other columns of
    ``left``, then the other columns of ``right``."""
    renamed = right.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    cond = None
    for k in keys:
        c = left[k].eqNullSafe(renamed[f"_r_{k}"])
        cond = c if cond is None else cond & c
    return left.join(renamed, cond, how).drop(*[f"_r_{k}" for k in keys])


class KeyMap:
    """The ids of one table, kept under ``path``."""

    def __init__(self, spark: SparkSession, path: str, natural: Sequence[str], id_name: str):
        self.spark, self.path, self.natural, self.id_name = spark, path, list(natural), id_name

    def _exists(self) -> bool:
        p = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/_SUCCESS")
        return p.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(p)

    def table(self, like: DataFrame) -> DataFrame:
        """The pairs assigned so far, with the types of ``like``."""
        schema = T.StructType([like.schema[k] for k in self.natural] + [T.StructField(self.id_name, T.LongType())])
        if not self._exists():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def assign(self, members: DataFrame, order: Sequence[Column | str], *, scalable: bool = True) -> DataFrame:
        """``members`` (one row per natural key) with their ids; new members are
        numbered in ``order`` after all known ones."""
        known = self.table(members)
        fresh = null_safe_join(members, known.select(*self.natural), self.natural, "left_anti")
        last = known.agg(F.max(self.id_name)).first()[0] or 0
        numbered = with_row_number(fresh, order, self.id_name, scalable=scalable, offset=last)
        numbered.select(*self.natural, self.id_name).write.mode("append").parquet(self.path)
        return null_safe_join(members, self.table(members), self.natural)


class KeyStore:
    """The key maps of a model, a folder each under ``base``."""

    def __init__(self, spark: SparkSession, base: str):
        self.spark, self.base = spark, base.rstrip("/")

    def assign(self, table: str, members: DataFrame, natural: Sequence[str], order: Sequence[Column | str],
               id_name: str, *, scalable: bool = True) -> DataFrame:
        return KeyMap(self.spark, f"{self.base}/{table}", natural, id_name).assign(members, order, scalable=scalable)
