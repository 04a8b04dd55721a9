"""Row-level feature expressions (all native Catalyst expressions, no UDFs).

Each function returns a ``Column`` so it composes into one ``withColumns``
projection and stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference analysis (labels and thresholds).
# ---------------------------------------------------------------------------
BUSINESS_HOURS = "Business Hours"            # hours 8..17
NON_BUSINESS_HOURS = "Non-Business Hours"    # hours 18..22
LATE_NIGHT = "Late Night"                    # every other hour, and null

CITY_CLASSES = [                              # (upper bound exclusive, label)
    (5000, "Rural"),
    (30000, "Small Town"),
    (100000, "Medium Town"),
    (500000, "Urban"),
]
METROPOLITAN = "Metropolitan"                 # population >= 500000, and null

AGE_BINS = [0, 18, 25, 35, 50, 100]
AGE_LABELS = ["Underage (<=18)", "19–25", "26–35", "36–50", "50+"]

EARTH_RADIUS_MILES = 3958.8
MERCHANT_PREFIX = "fraud_"
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def to_timestamp_lenient(text, fmt: str | None = None) -> Column:
    """text to timestamp; malformed text becomes null instead of failing."""
    return F.try_to_timestamp(_c(text), F.lit(fmt)) if fmt else F.try_to_timestamp(_c(text))


def trans_date(ts) -> Column:
    """the transaction day (timestamp truncated to midnight)."""
    return F.to_date(_c(ts))


def age_365(ts, dob) -> Column:
    """whole 365-day years between birth and the transaction day (floor)."""
    return F.floor(F.datediff(F.to_date(_c(ts)), _c(dob)) / F.lit(365)).cast("int")


def time_category(hour) -> Column:
    """hour of day to an activity class; null falls to Late Night."""
    h = _c(hour)
    return (F.when(h.between(8, 17), F.lit(BUSINESS_HOURS))
             .when(h.between(18, 22), F.lit(NON_BUSINESS_HOURS))
             .otherwise(F.lit(LATE_NIGHT)))


def city_category(pop) -> Column:
    """population to a settlement class; null falls to Metropolitan."""
    p = _c(pop)
    expr = None
    for bound, label in CITY_CLASSES:
        expr = F.when(p < bound, F.lit(label)) if expr is None else expr.when(p < bound, F.lit(label))
    return expr.otherwise(F.lit(METROPOLITAN))


def cut(col, bins: Sequence[float], labels: Sequence[str], right: bool = True) -> Column:
    """bin a numeric column. Right-closed (a, b] by default; values
    outside every bin, and nulls, give null."""
    if len(labels) != len(bins) - 1:
        raise ValueError("need exactly len(bins) - 1 labels")
    x = _c(col)
    expr = None
    for lo, hi, label in zip(bins[:-1], bins[1:], labels):
        cond = (x > lo) & (x <= hi) if right else (x >= lo) & (x < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def bin_domain(spark, labels: Sequence[str], name: str = "label") -> DataFrame:
    """Declared domain of an ordered category: (label, ord). Tiny and fixed by
    the caller's label list, so it is safe to broadcast."""
    rows = F.array(*[F.struct(F.lit(lab).alias(name), F.lit(i).alias(f"{name}_ord"))
                     for i, lab in enumerate(labels)])
    return spark.range(1).select(F.inline(rows))   # a literal plan: the planner sees its tiny size


def haversine_miles(lat1, lon1, lat2, lon2, decimals: int = 2) -> Column:
    """great-circle distance in miles, rounded half-even."""
    la1, lo1, la2, lo2 = (F.radians(_c(c)) for c in (lat1, lon1, lat2, lon2))
    a = (F.pow(F.sin((la2 - la1) / 2), 2)
         + F.cos(la1) * F.cos(la2) * F.pow(F.sin((lo2 - lo1) / 2), 2))
    d = F.lit(EARTH_RADIUS_MILES) * 2 * F.asin(F.sqrt(F.least(F.lit(1.0), a)))
    return F.bround(d, decimals) if decimals is not None else d


def proxy_user_id(*cols) -> Column:
    """first_last_gender_city style id; a null part is spelled 'nan' (N13)."""
    return F.concat_ws("_", *[F.coalesce(_c(c).cast("string"), F.lit("nan")) for c in cols])


def clean_merchant(col, prefix: str = MERCHANT_PREFIX, prefix_only: bool = False) -> Column:
    """remove the marker text; every occurrence by default."""
    if prefix_only:
        return F.when(_c(col).startswith(prefix), F.substring(_c(col), len(prefix) + 1, 1 << 30)) \
                .otherwise(_c(col))
    return F.replace(_c(col), F.lit(prefix), F.lit(""))


def date_id(ts) -> Column:
    """F8: yyyyMMdd as an int."""
    return F.date_format(_c(ts), "yyyyMMdd").cast("int")


def month_key(ts) -> Column:
    """yyyy-MM period text."""
    return F.date_format(_c(ts), "yyyy-MM")


def day_name(ts) -> Column:
    """English weekday name."""
    return F.date_format(_c(ts), "EEEE")


def month_name(ts) -> Column:
    return F.date_format(_c(ts), "MMMM")


def iso_weekday(ts) -> Column:
    """1 = Monday .. 7 = Sunday."""
    return (F.weekday(_c(ts)) + 1).cast("int")


def weekday_ordinal(name) -> Column:
    """O3: position of a weekday name in Monday..Sunday order."""
    m = F.create_map(*[x for i, d in enumerate(WEEKDAYS) for x in (F.lit(d), F.lit(i + 1))])
    return m[_c(name)]


def label_int(col) -> Column:
    """Cast a 0/1/boolean label to int so sums and means work."""
    return _c(col).cast("int")


def positive_log1p(col) -> Column:
    """log1p of positive values, null otherwise."""
    return F.when(_c(col) > 0, F.log1p(_c(col)))


def add_features(df: DataFrame, *, ts: str = "trans_date_trans_time", dob: str = "dob",
                 user_cols: Sequence[str] = ("first", "last", "gender", "city"),
                 clean_merchant_name: bool = True) -> DataFrame:
    """M7: the analysis table — raw columns plus every derived feature in a
    single projection."""
    cols = {
        "trans_date": trans_date(ts),
        "age": age_365(ts, dob),
        "trans_hour": F.hour(ts),
        "transaction_time_category": time_category(F.hour(ts)),
        "trans_month": F.month(ts),
        "trans_day_of_week": day_name(ts),
        "user_id": proxy_user_id(*user_cols),
        "city_category": city_category("city_pop"),
        "distance_miles": haversine_miles("lat", "long", "merch_lat", "merch_long"),
        "month": month_key(ts),
        "age_group": cut(age_365(ts, dob), AGE_BINS, AGE_LABELS),
        "zip_missing": F.col("merch_zipcode").isNull(),
    }
    if clean_merchant_name:
        cols["merchant"] = clean_merchant("merchant")
    return df.withColumns(cols)
