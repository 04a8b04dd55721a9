"""Keys: keep-first de-duplication (K2) and dense surrogate keys (K1)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlens.session import checkpoint_dir


def _cols(x) -> list[str]:
    return [x] if isinstance(x, str) else list(x)


def keep_first(df: DataFrame, keys, order: Sequence[str], *, columns: Sequence[str] | None = None) -> DataFrame:
    """K2: one row per key — the first by ``order`` (N10: a declared order
    stands in for file order; make it total).

    Written as ``min(struct(order…, payload…))`` per key, an aggregate with a
    map-side partial step, so a key that holds a third of all rows is reduced
    inside every task before the shuffle instead of being sorted in one task
    (as a row_number window would). Nulls in order columns sort first."""
    keys = _cols(keys)
    order = list(order)
    payload = [c for c in (columns or df.columns) if c not in keys]
    packed = F.struct(*[F.col(c).alias(f"_o{i}") for i, c in enumerate(order)],
                      *[F.col(c).alias(c) for c in payload])
    out = df.groupBy(*keys).agg(F.min(packed).alias("_first"))
    return out.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in payload])


def with_row_number(df: DataFrame, order: Sequence[Column | str], name: str = "id", *,
                    scalable: bool = True, offset: int = 0) -> DataFrame:
    """K1: dense 1..n key in ``order`` (first-appearance order when the order
    is the first-seen timestamp). Give a total order, or ties are arbitrary.

    ``scalable=False`` is a plain ``row_number`` over one global window —
    every row goes through one task, fine for a table of bounded size (a
    calendar). ``scalable=True`` never does that: rows are range-partitioned
    on the order, checkpointed (so a lost executor cannot re-sample different
    range bounds), counted per partition (a table with one row per partition),
    and each row gets its partition's prefix offset plus its position inside
    the partition."""
    order_cols = [F.col(c) if isinstance(c, str) else c for c in order]
    if not scalable:
        return df.withColumn(name, (F.row_number().over(Window.orderBy(*order_cols)) + offset).cast("long"))
    spark = df.sparkSession
    checkpoint_dir(spark)
    ranged = df.repartitionByRange(*order_cols).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: bounded by the partition count, safe to window and broadcast
    offsets = sizes.select("_pid", (F.sum("_n").over(Window.orderBy("_pid").rowsBetween(
        Window.unboundedPreceding, -1))).alias("_off")).fillna(0, ["_off"])
    local = F.row_number().over(Window.partitionBy("_pid").orderBy(*order_cols))
    out = (ranged.join(F.broadcast(offsets), "_pid")
           .withColumn(name, (F.col("_off") + local + offset).cast("long")))
    return out.drop("_pid", "_off")


def running_sum_global(df: DataFrame, order: Sequence[str], value: str, name: str, *,
                       reverse: bool = False) -> DataFrame:
    """Cumulative sum of ``value`` over one global order without a
    single-partition window (same prefix-offset method as ``with_row_number``).
    ``reverse=True`` sums from the row to the end (W3)."""
    spark = df.sparkSession
    checkpoint_dir(spark)
    order_cols = [F.col(c) for c in order]
    ranged = df.repartitionByRange(*order_cols).withColumn("_pid", F.spark_partition_id())
    ranged = ranged.checkpoint(eager=True)
    sizes = ranged.groupBy("_pid").agg(F.sum(value).alias("_s"))
    # from the end: the same frames in descending order (a frame to the unbounded end is summed anew for every row)
    w = Window.orderBy(F.desc("_pid") if reverse else F.asc("_pid"))
    off = F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, -1))
    ordered = [c.desc() for c in order_cols] if reverse else order_cols
    frame = Window.partitionBy("_pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    offsets = sizes.select("_pid", off.alias("_off"))
    zero = F.lit(0).cast(df.schema[value].dataType if not isinstance(
        df.schema[value].dataType, (T.IntegerType, T.ShortType, T.ByteType)) else T.LongType())
    out = ranged.join(F.broadcast(offsets), "_pid").withColumn(
        name, F.coalesce(F.col("_off"), zero) + F.sum(value).over(frame))
    return out.drop("_pid", "_off")


def _by_range(df: DataFrame, order: Sequence[str]) -> DataFrame:
    """``df`` in range partitions of ``order`` (rows of equal order together),
    numbered in ``_pid``; checkpointed, so that a lost executor cannot re-sample
    other range bounds."""
    checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(*[F.col(c) for c in order])
    return ranged.withColumn("_pid", F.spark_partition_id()).checkpoint(eager=True)


def running_sums_global(df: DataFrame, order: Sequence[str], sums: dict[str, str], *, reverse: bool = False,
                        totals: dict[str, str] | None = None) -> DataFrame:
    """``running_sum_global`` for several values (value → name of its sum) in one
    pass. ``totals`` (value → name) also attaches whole-table sums, which the
    table of partition sums gives without reading the rows again."""
    totals = totals or {}
    ranged = _by_range(df, order)
    w = Window.orderBy(F.desc("_pid") if reverse else F.asc("_pid")).rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy()
    sizes = ranged.groupBy("_pid").agg(*[F.sum(v).alias(f"_s_{v}") for v in {**sums, **totals}])
    # one row per partition: bounded by the partition count, safe to window and broadcast
    offsets = sizes.select("_pid", *[F.coalesce(F.sum(f"_s_{v}").over(w), F.lit(0)).alias(f"_off_{v}") for v in sums],
                           *[F.sum(f"_s_{v}").over(whole).alias(name) for v, name in totals.items()])
    ordered = [F.col(c).desc() if reverse else F.col(c) for c in order]
    frame = Window.partitionBy("_pid").orderBy(*ordered).rowsBetween(Window.unboundedPreceding, 0)
    out = ranged.join(F.broadcast(offsets), "_pid")
    out = out.withColumns({name: F.col(f"_off_{v}") + F.sum(v).over(frame) for v, name in sums.items()})
    return out.drop("_pid", *[f"_off_{v}" for v in sums])


def lag_global(df: DataFrame, order: Sequence[str], value: str, name: str) -> DataFrame:
    """``value`` of the row before in one global (total) order; null for the
    first row. The first row of a range partition takes the last value of the
    partition before it, so no window goes over the whole table."""
    ranged = _by_range(df, order)
    cols = [F.col(c) for c in order]
    last = ranged.groupBy("_pid").agg(F.max_by(F.struct(value), F.struct(*cols)).alias("_last"))
    carried = last.select("_pid", F.lag("_last").over(Window.orderBy("_pid")).alias("_carried"))
    w = Window.partitionBy("_pid").orderBy(*cols)
    out = ranged.join(F.broadcast(carried), "_pid").withColumns(
        {"_rn": F.row_number().over(w), "_lag": F.lag(value).over(w)})
    out = out.withColumn(name, F.when(F.col("_rn") == 1, F.col("_carried")[value]).otherwise(F.col("_lag")))
    return out.drop("_pid", "_carried", "_rn", "_lag")
