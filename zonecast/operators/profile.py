"""Table profiles and exploratory summaries.

Each report is one aggregate over the table; wide reports (missing values,
anomalies, describe) read the table once and unpivot the single result row.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import clip
from zonecast.functions.quantiles import exact_percentiles, exact_percentiles_multi
from zonecast.functions.time import day_name, weekday0
from zonecast.operators.cleaning import nan_to_null
from zonecast.session import materialize


def demand_stats(df: DataFrame, y: str = "trip_count") -> DataFrame:
    """Rows, total, mean, median and max of the count."""
    df = materialize(df.select(y), "counts")  # read by each pass
    med = exact_percentiles(df, y, [0.5])[0]
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.sum(y).alias("total_trips"),
                  F.avg(y).alias("mean_trips"), F.max(y).alias("max_trips")) \
        .withColumn("median_trips", F.lit(med).cast("double"))


def monthly_profiles(df: DataFrame, month: str = "year_month", zone: str = "PULocationID",
                     time: str = "pickup_datetime", y: str = "trip_count", hll: int = 12, kll: int = 800) -> DataFrame:
    """One mergeable row per month (A6, A7): rows, time range, total and
    maximum, and sketches of the zones (HLL, relative error about
    ``1.04 / 2^(hll/2)``) and of the counts (KLL of this k). Written once a
    month, they answer :func:`merged_profile` for any months without another
    look at the rows."""
    return df.groupBy(month).agg(
        F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_ts"), F.max(time).alias("last_ts"),
        F.sum(y).alias("total_trips"), F.count(y).alias("n_counts"), F.max(y).alias("max_trips"),
        F.hll_sketch_agg(F.col(zone).cast("long"), F.lit(hll)).alias("zones"),
        F.kll_sketch_agg_bigint(F.col(y).cast("long"), F.lit(kll)).alias("counts"))


def merged_profile(profiles: DataFrame, months: Sequence[str] | None = None, month: str = "year_month") -> DataFrame:
    """The profile of some months (all by default) from their rows: exact
    figures, ``n_zones`` and ``median_trips`` from the merged sketches. No
    month gives no row."""
    p = profiles if months is None else profiles.where(F.col(month).isin(list(months)))
    one = p.agg(F.sum("n_rows").alias("n_rows"), F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"),
                F.sum("total_trips").alias("total_trips"), F.sum("n_counts").alias("n"), F.max("max_trips").alias("max_trips"),
                F.hll_union_agg("zones").alias("zones"), F.kll_merge_agg_bigint("counts").alias("counts"))
    return one.where("n_rows is not null").select(
        "n_rows", "first_ts", "last_ts", "total_trips", F.try_divide(F.col("total_trips"), F.col("n")).alias("mean_trips"), "max_trips",
        F.hll_sketch_estimate("zones").alias("n_zones"),
        F.when(F.col("n") > 0, F.kll_sketch_get_quantile_bigint("counts", F.lit(0.5))).alias("median_trips"))


def _present(df: DataFrame, col: str):
    """Neither NULL nor, in a floating column, NaN."""
    known = F.col(col).isNotNull()
    return known & ~F.isnan(col) if dict(df.dtypes)[col] in ("double", "float") else known


def value_counts(df: DataFrame, col: str, n: int | None = None, order: str = "count") -> DataFrame:
    """Counts per value: top ``n`` by count (ties by value) or all in value
    order (A9/A10). Missing values (NULL, NaN) are not counted."""
    c = df.where(_present(df, col)).groupBy(col).agg(F.count(F.lit(1)).alias("count"))
    c = c.orderBy(F.col("count").desc(), col) if order == "count" else c.orderBy(col)
    return c.limit(n) if n else c


# Weekday names in display order, Monday first.
WEEKDAYS = ["Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday"]


def counts_by_weekday(df: DataFrame, time: str) -> DataFrame:
    """Trips per weekday in Monday..Sunday order; absent days stay NULL."""
    spark = df.sparkSession
    days = spark.createDataFrame([(i, d) for i, d in enumerate(WEEKDAYS)], "dow int, day_name string")
    c = df.groupBy(weekday0(time).alias("dow")).agg(F.count(F.lit(1)).alias("trips"))
    return F.broadcast(days).join(c, "dow", "left").orderBy("dow")


def daily_counts(df: DataFrame, time: str) -> DataFrame:
    """Trips per calendar date with the day name."""
    return df.groupBy(F.to_date(time).alias("date")).agg(F.count(F.lit(1)).alias("trips")) \
        .withColumn("day_name", day_name("date"))


def daily_summary(df: DataFrame, time: str) -> DataFrame:
    """Mean, min and max of the daily trip counts."""
    d = daily_counts(df, time)
    return d.agg(F.count(F.lit(1)).alias("n_days"), F.avg("trips").alias("mean_daily"),
                 F.min("trips").alias("min_daily"), F.max("trips").alias("max_daily"))


def hourly_counts(df: DataFrame, time: str) -> DataFrame:
    """Trips per hour of day."""
    return df.groupBy(F.hour(time).alias("hour")).agg(F.count(F.lit(1)).alias("trips"))


def describe_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """count, mean, std (ddof 1, trap T22), min, quartiles, max per column,
    long form: one row per column (A14). NaN is missing, as NULL is (T1)."""
    df = materialize(df.select(*[nan_to_null(F.col(c).cast("double")).alias(c) for c in cols]), "numbers")  # read by each pass
    aggs = []
    for c in cols:
        x = F.col(c)
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"),
                 F.stddev_samp(x).alias(f"{c}__std"), F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    one = df.agg(*aggs)
    qs = dict(zip(cols, exact_percentiles_multi(df, list(cols), [0.25, 0.5, 0.75])))
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__count").alias("count"),
                              F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                              F.col(f"{c}__min").alias("min"),
                              F.lit(qs[c][0]).cast("double").alias("p25"),
                              F.lit(qs[c][1]).cast("double").alias("p50"),
                              F.lit(qs[c][2]).cast("double").alias("p75"),
                              F.col(f"{c}__max").alias("max")) for c in cols])
    return one.select(F.inline(rows))


def null_report(df: DataFrame, cols: Sequence[str] | None = None, only_missing: bool = False) -> DataFrame:
    """Missing values (NULL, or NaN for floating columns) per column, count
    and percent, in one pass (A15)."""
    cols = list(cols or df.columns)
    types = dict(df.dtypes)

    def miss(c):
        m = F.col(c).isNull()
        if types[c] in ("double", "float"):
            m = m | F.isnan(c)
        return F.count_if(m).alias(c)

    one = df.agg(F.count(F.lit(1)).alias("__n"), *[miss(c) for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias("n_missing")) for c in cols])
    out = one.select("__n", F.inline(rows)).select(
        "column", "n_missing", (100.0 * F.col("n_missing") / F.col("__n")).alias("pct_missing"))
    return out.where(F.col("n_missing") > 0) if only_missing else out


def anomaly_report(df: DataFrame, duration: str, fare: str, distance: str, passengers: str) -> DataFrame:
    """Counts of short (< 1 min, with percent) and long (> 1440 min) trips,
    non-positive fares, zero distances and zero passengers (A16)."""
    return df.agg(F.count(F.lit(1)).alias("n_rows"),
                  F.count_if(F.col(duration) < 1).alias("short_trips"),
                  (100.0 * F.count_if(F.col(duration) < 1) / F.count(F.lit(1))).alias("short_trips_pct"),
                  F.count_if(F.col(duration) > 1440).alias("long_trips"),
                  F.count_if(F.col(fare) <= 0).alias("nonpositive_fare"),
                  F.count_if(F.col(distance) == 0).alias("zero_distance"),
                  F.count_if(F.col(passengers) == 0).alias("zero_passengers"))


def histogram(df: DataFrame, col: str, lo: float, hi: float, bins: int = 50) -> DataFrame:
    """Equal-width histogram of ``col`` clipped to ``[lo, hi]``.

    Bin ``i`` covers ``[lo + i*w, lo + (i+1)*w)``; the last bin is closed on
    the right, so the clipped maximum lands in it. Empty bins are omitted.
    """
    w = (hi - lo) / bins
    x = clip(F.col(col).cast("double"), float(lo), float(hi))
    b = F.least(F.floor((x - F.lit(float(lo))) / F.lit(w)), F.lit(bins - 1)).cast("int")
    return (df.where(F.col(col).isNotNull() & ~F.isnan(F.col(col).cast("double")))
              .groupBy(b.alias("bin")).agg(F.count(F.lit(1)).alias("count"))
              .withColumn("bin_lo", F.lit(float(lo)) + F.col("bin") * F.lit(w))
              .withColumn("bin_hi", F.lit(float(lo)) + (F.col("bin") + 1) * F.lit(w)))
