"""Grouped event rates, shares, distributions and top-k.

All operators are lazy aggregates. Whole-table totals are one-row scalar
subqueries (``DataFrame.scalar()``), never a global window, so no step moves
an unbounded set of groups into a single task. Per-group totals use windows
partitioned by the group over already-aggregated rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlens.operators.keys import lag_global


def _list(x) -> list:
    if x is None:
        return []
    return [x] if isinstance(x, (str, Column)) else list(x)


def _not_null(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def pct(part, whole) -> Column:
    """part / whole * 100, null instead of an error when whole is 0."""
    return F.try_divide(part, whole) * 100


def total_of(df: DataFrame, col: str) -> Column:
    """Whole-table sum of ``col`` as a scalar-subquery Column (one row)."""
    return df.agg(F.sum(col)).scalar()


def with_group_total(df: DataFrame, by, col: str, name: str) -> DataFrame:
    """Attach the per-group sum of ``col`` (J4). An aggregate joined back on
    the group key instead of a window over the group, so no task has to
    buffer a whole group; the totals table has one row per group."""
    by = _list(by)
    tot = df.groupBy(*by).agg(F.sum(col).alias(name))
    return df.join(tot, by)


def group_count(df: DataFrame, keys, *, name: str = "transaction_count", dropna: bool = True) -> DataFrame:
    """G1: rows per group; null keys dropped like pandas."""
    keys = _list(keys)
    src = df.filter(_not_null(keys)) if dropna else df
    return src.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def rate_by(df: DataFrame, keys, label: str = "is_fraud", *, dropna: bool = True,
            min_count: int | None = None, domain: DataFrame | None = None,
            rate_name: str = "fraud_rate", count_name: str | None = "transaction_count") -> DataFrame:
    """Mean of a 0/1 label per group, with the group size.

    ``min_count`` keeps groups with at least that many rows (P13);
    ``domain`` (a DataFrame of key values) reports declared but empty groups
    with count 0 and rate null (J7)."""
    keys = _list(keys)
    src = df.filter(_not_null(keys)) if dropna else df
    aggs = [F.avg(F.col(label).cast("double")).alias(rate_name)]
    if count_name:
        aggs.append(F.count(label).alias(count_name))
    out = src.groupBy(*keys).agg(*aggs)
    if min_count is not None:
        out = out.filter(F.col(count_name) >= min_count)
    if domain is not None:
        out = domain.join(out, keys, "left")
        if count_name:
            out = out.withColumn(count_name, F.coalesce(F.col(count_name), F.lit(0).cast("bigint")))
    return out


def prevalence_by(df: DataFrame, keys, label: str = "is_fraud", *, dropna: bool = True,
                  domain: DataFrame | None = None, total_name: str = "total_transactions",
                  positive_name: str = "fraud_transactions", pct_name: str = "fraud_pct") -> DataFrame:
    """Rows, positives and positive share (%) per group."""
    keys = _list(keys)
    src = df.filter(_not_null(keys)) if dropna else df
    out = src.groupBy(*keys).agg(F.count(label).alias(total_name),
                                 F.sum(F.col(label).cast("bigint")).alias(positive_name))
    if domain is not None:
        out = (domain.join(out, keys, "left")
               .withColumn(total_name, F.coalesce(total_name, F.lit(0).cast("bigint")))
               .withColumn(positive_name, F.coalesce(positive_name, F.lit(0).cast("bigint"))))
    return out.withColumn(pct_name, pct(F.col(positive_name), F.col(total_name)))


def value_share(df: DataFrame, keys, *, within=None, denominator: str = "all", top: int | None = None,
                count_name: str = "transaction_count", pct_name: str = "transaction_pct",
                dropna: bool = True, tie_break: Sequence[str] | None = None) -> DataFrame:
    """Frequency table with percentage share.

    ``within`` computes the share inside each group of those columns;
    ``top`` keeps the k largest groups (per ``within`` group when given);
    ``denominator='shown'`` divides by the total of the kept rows only (N18)."""
    keys, within = _list(keys), _list(within)
    counts = group_count(df, keys, name=count_name, dropna=dropna)
    order = [F.col(count_name).desc()] + [F.col(k).asc() for k in (tie_break or keys)]

    def with_share(t: DataFrame) -> DataFrame:
        if within:
            return with_group_total(t, within, count_name, "_tot").withColumn(
                pct_name, pct(F.col(count_name), F.col("_tot"))).drop("_tot")
        return t.withColumn(pct_name, pct(F.col(count_name), total_of(t, count_name)))

    if denominator not in ("all", "shown"):
        raise ValueError("denominator must be 'all' or 'shown'")
    if denominator == "all":
        counts = with_share(counts)
    if top is not None:
        counts = top_k(counts, order, top, by=within or None)
    if denominator == "shown":
        counts = with_share(counts)
    return counts


def top_k(df: DataFrame, order: Sequence[Column], k: int, *, by=None, rank_name: str | None = None) -> DataFrame:
    """The k first rows by ``order`` (globally, or per ``by`` group).

    Global top-k plans as TakeOrderedAndProject (k rows per task); per group
    it is a row_number over the group, so ties are broken by ``order`` only —
    give it a total order."""
    by = _list(by)
    if not by:
        out = df.orderBy(*order).limit(k)
        return out.withColumn(rank_name, F.row_number().over(Window.orderBy(*order))) if rank_name else out
    rn = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    out = df.withColumn("_rn", rn).filter(F.col("_rn") <= k)
    return out.withColumnRenamed("_rn", rank_name) if rank_name else out.drop("_rn")


def ever_flag(df: DataFrame, entity: str, label: str = "is_fraud", *,
              flag_name: str = "ever_fraud", count_name: str = "merchant_count",
              status: dict | None = None) -> DataFrame:
    """Flag each entity that ever had a positive row, then count
    entities per flag with a status text and share."""
    status = status or {0: "Never Experienced Fraud", 1: "Experienced Fraud"}
    per_entity = (df.filter(F.col(entity).isNotNull())
                  .groupBy(entity).agg(F.max(F.col(label).cast("int")).alias(flag_name)))
    dist = per_entity.groupBy(flag_name).agg(F.count(F.lit(1)).alias(count_name))
    smap = F.create_map(*[x for k, v in status.items() for x in (F.lit(k), F.lit(v))])
    return (dist.withColumn("status", smap[F.col(flag_name)])
                .withColumn("percentage", pct(F.col(count_name), total_of(dist, count_name))))


def distinct_count(df: DataFrame, col: str, by=None, *, name: str | None = None,
                   approx: bool = False) -> DataFrame:
    """Distinct non-null values, globally or per group."""
    name = name or f"n_{col}"
    agg = (F.approx_count_distinct(col) if approx else F.countDistinct(col)).alias(name)
    by = _list(by)
    return df.groupBy(*by).agg(agg) if by else df.agg(agg)


def distinct_count_distribution(df: DataFrame, entity: str, col: str, *,
                                n_name: str = "n_distinct", count_name: str = "entity_count") -> DataFrame:
    """How many entities have 1, 2, … distinct values of ``col``."""
    per = df.filter(F.col(entity).isNotNull()).groupBy(entity).agg(F.countDistinct(col).alias(n_name))
    return per.groupBy(n_name).agg(F.count(F.lit(1)).alias(count_name))


def duplicate_keys(df: DataFrame, key: str, *, count_name: str = "row_count") -> DataFrame:
    """Key values that occur more than once, with their multiplicity."""
    return (df.filter(F.col(key).isNotNull()).groupBy(key)
              .agg(F.count(F.lit(1)).alias(count_name)).filter(F.col(count_name) > 1))


def duplicate_summary(df: DataFrame, key: str) -> DataFrame:
    """G12 summary: rows, distinct keys, rows whose key repeats."""
    per = df.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").cast("bigint").alias("total_rows"),
                   F.count(F.when(F.col(key).isNotNull(), 1)).alias("distinct_keys"),
                   F.coalesce(F.sum(F.when((F.col("n") > 1) & F.col(key).isNotNull(), F.col("n"))),
                              F.lit(0)).cast("bigint").alias("duplicated_rows"))


def label_summary(df: DataFrame, value: str, label: str = "is_fraud", *,
                  percentiles: Sequence[float] = (0.5, 0.9, 0.99), approx: bool = False,
                  accuracy: int = 10000) -> DataFrame:
    """Count, mean, median, p90, p99 and max of ``value`` per label.

    Percentiles are exact without a per-label value map
    (``profile.distributed_quantiles``); ``approx=True`` takes the bounded sketch."""
    from ledgerlens.operators.profile import quantile_table
    names = {0.5: "median"}
    ps = list(percentiles)
    cols = [names.get(p, f"p{int(round(p * 100))}") for p in ps]
    src = df.filter(F.col(label).isNotNull())
    base = src.groupBy(label).agg(F.count(value).alias("count"), F.avg(value).alias("mean"), F.max(value).alias("max"))
    qs = quantile_table(src, value, ps, cols, by=[label], approx=approx, accuracy=accuracy)
    return base.join(qs, label, "left").select(label, "count", "mean", *cols, "max")


def class_ratio(summary: DataFrame, label: str = "is_fraud",
                stats: Sequence[str] = ("median", "mean", "p90", "max"),
                positive=1, negative=0) -> DataFrame:
    """Positive-class ÷ negative-class for each statistic of a
    ``label_summary``; one row per statistic."""
    pos = summary.filter(F.col(label) == positive)
    neg = summary.filter(F.col(label) == negative)
    stack = lambda t, nm: t.select(F.explode(F.array(*[
        F.struct(F.lit(s).alias("stat"), F.col(s).cast("double").alias(nm)) for s in stats])).alias("s")
    ).select("s.*")
    return (stack(pos, "positive_value").join(stack(neg, "negative_value"), "stat", "full")
            .withColumn("ratio", F.try_divide(F.col("positive_value"), F.col("negative_value"))))


def period_change(df: DataFrame, period: str | Sequence[str], value: str, *, name: str | None = None,
                  bounded_key: bool = True) -> DataFrame:
    """Value minus the previous period's value. ``bounded_key=True`` states
    that there are few periods (months), one row each: one ordered window over
    them. With ``False`` the table may be as long as it likes (every second, every
    row): the previous value is carried over range partitions."""
    name = name or f"{value}_change"
    period = [period] if isinstance(period, str) else list(period)
    if not bounded_key:
        out = lag_global(df, period, value, "_before")
        return out.withColumn(name, F.col(value) - F.col("_before")).drop("_before")
    return df.withColumn(name, F.col(value) - F.lag(value).over(Window.orderBy(*period)))


def class_share_by_period(df: DataFrame, period: str, cls: str, *, label: str | None = None,
                          count_name: str = "transaction_count", pct_name: str = "pct") -> DataFrame:
    """Rows per (period, class) and the class share of the period.
    With ``label`` only positive rows are counted (class share of fraud)."""
    src = df.filter(F.col(label) == 1) if label else df
    counts = with_group_total(group_count(src, [period, cls], name=count_name), period, count_name, "period_total")
    return counts.withColumn(pct_name, pct(F.col(count_name), F.col("period_total")))


def with_class_share(df: DataFrame, period: str, cls: str, value, *, name: str = "class_pct") -> DataFrame:
    """The share of one class among its period's rows, attached to every
    row of the period; null where a period has no row of that class."""
    share = (df.filter(F.col(cls).isNotNull()).groupBy(F.col(period).alias("_period"))
             .agg(F.count(F.when(F.col(cls) == value, 1)).alias("_k"), F.count(F.lit(1)).alias("_n"))
             .select("_period", F.when(F.col("_k") > 0, pct(F.col("_k"), F.col("_n"))).alias(name)))
    return df.join(share, F.col(period).eqNullSafe(F.col("_period")), "left").drop("_period")


def top_per_period(df: DataFrame, period: str, entity: str, *, k: int = 1,
                   count_name: str = "transaction_count", pct_name: str = "transaction_pct") -> DataFrame:
    """W5 + J4: the k most frequent entities of each period and their share of
    the period total (total via a window over aggregated counts, no join)."""
    counts = group_count(df, [period, entity], name=count_name)
    if k == 1:
        # the leader of each period by aggregates only: the largest count, then
        # the smallest entity among those that reach it (no per-period sort)
        per = counts.groupBy(period).agg(F.max(count_name).alias("_top"),
                                         F.sum(count_name).alias("total_transactions"))
        lead = (counts.join(per, period).filter(F.col(count_name) == F.col("_top"))
                .groupBy(period, count_name, "total_transactions").agg(F.min(entity).alias(entity)))
        out = lead.select(period, entity, count_name, "total_transactions")
    else:
        counts = with_group_total(counts, period, count_name, "total_transactions")
        out = top_k(counts, [F.col(count_name).desc(), F.col(entity).asc()], k, by=period)
    return out.withColumn(pct_name, pct(F.col(count_name), F.col("total_transactions")))


def nearest(df: DataFrame, col: str, target: float, tie_break: Sequence[str]) -> DataFrame:
    """The row whose ``col`` is closest to ``target`` (first by tie_break)."""
    return df.orderBy(F.abs(F.col(col) - F.lit(target)), *[F.col(c) for c in tie_break]).limit(1)


def scalar_kpis(df: DataFrame, *, label: str = "is_fraud", amount: str = "amt",
                entity: str = "cc_num", approx: bool = False) -> DataFrame:
    """Dataset KPIs — rows, total amount, entities, positive rate and
    share of entities with at least one positive row, in one aggregate."""
    distinct = F.approx_count_distinct if approx else F.countDistinct
    return df.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.sum(amount).alias("total_amount"),
        distinct(entity).alias("entities"),
        distinct(F.when(F.col(label) == 1, F.col(entity))).alias("entities_with_fraud"),
        F.sum(F.col(label).cast("bigint")).alias("fraud_rows"),
        (F.avg(F.col(label).cast("double")) * 100).alias("fraud_rate_pct"),
    ).withColumn("entities_with_fraud_pct", pct(F.col("entities_with_fraud"), F.col("entities")))
