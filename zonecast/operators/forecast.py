"""Forecasting as table jobs (P1-P6, J4, J5, J10) and the per-zone views
built on predictions (A19-A22, A24, F8-F10, E17).

The reference scores one (zone, hour) at a time and scans the history once
per lag; here every target of every zone is scored in one set-based plan.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions.calendar import temporal_features, with_holidays
from zonecast.functions.time import add_hours, floor_to, hour_number, ntz
from zonecast.operators.features import rolling_mean
from zonecast.schema import LAGS, ROLLING


def naive_forecast(panel: DataFrame, k: int = 3, zone: str = "PULocationID",
                   time: str = "pickup_datetime", y: str = "trip_count", col: str = "y_pred") -> DataFrame:
    """``y_pred`` = mean of the ``k`` previous hours of the zone, 0 when none.

    Leak-free, needs no fit, and is plain SQL -- the reference predictor for
    every metric and diagnostic that must be value-checked.
    """
    pre, c = rolling_mean(y, k, zone, time, include_current=False,
                          integral=dict(panel.dtypes)[y] in ("bigint", "int", "smallint", "tinyint"))
    base = panel.select("*", *[e.alias(n) for n, e in pre]) if pre else panel
    return base.select(*panel.columns, F.coalesce(c, F.lit(0.0)).alias(col))


def with_max_ts(df: DataFrame, time: str = "pickup_datetime", col: str = "max_ts") -> DataFrame:
    """Attach the global maximum timestamp to every row (J10) -- a scalar
    subquery: one small aggregate, its single value broadcast to the tasks."""
    return df.withColumn(col, df.agg(F.max(time)).scalar())


def recent_history(df: DataFrame, days: int = 14, zone: str = "PULocationID",
                   time: str = "pickup_datetime", y: str = "trip_count") -> DataFrame:
    """Rows with ``t >= max(t) - days`` (three columns), ordered."""
    m = df.agg(F.max(time)).scalar()
    return (df.where(F.col(time) >= F.timestamp_add("DAY", F.lit(-days), m))
              .select(zone, time, y).orderBy(zone, time))


def forecast_targets(zones: DataFrame, start, horizon: int = 24, zone: str = "PULocationID") -> DataFrame:
    """(zone, step, ts) for ``step`` = 0..horizon-1 from ``start``.

    The step offset and the clock time are both kept; joins use the time.
    """
    z = zones.select(zone).where(F.col(zone).isNotNull()).distinct()
    return (z.select(zone, F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("step"))
             .withColumn("ts", add_hours(ntz(start), F.col("step"))))


def series_arrays(history: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                  y: str = "trip_count") -> DataFrame:
    """One row per zone: ``first`` (its first hour, in hours since 1970),
    ``series`` (the value of every hour from there on, NULL where there is
    none; of several values of an hour the smallest), ``by_hour`` (the mean
    of each hour of day) and ``mean`` (of all rows). One grouping by zone; an
    array is as long as the history in hours."""
    at, v = hour_number(F.col(time)), F.col(y).cast("double")
    whole = F.col(time) == floor_to(time)
    one = history.where(F.col(zone).isNotNull()).groupBy(F.col(zone).alias("zone")).agg(
        F.sort_array(F.collect_list(F.when(whole & v.isNotNull(), F.struct(at.alias("h"), v.alias("v"))))).alias("held"),
        F.array(*[F.avg(F.when(F.hour(time) == h, v)) for h in range(24)]).alias("by_hour"), F.avg(v).alias("mean"))
    # the first entry of each hour has its smallest value
    held = F.filter("held", lambda e, i: (i == 0) | (F.try_element_at(F.col("held"), F.greatest(i, F.lit(1)))["h"] != e["h"]))
    one = one.withColumn("held", held)
    # between two entries as many NULLs as hours are missing
    gap = lambda e, i: F.when(i == 0, 0).otherwise(e["h"] - F.try_element_at(F.col("held"), F.greatest(i, F.lit(1)))["h"] - 1).cast("int")
    parts = F.transform("held", lambda e, i: F.concat(F.array_repeat(F.lit(None).cast("double"), gap(e, i)), F.array(e["v"])))
    return one.select("zone", F.try_element_at("held", F.lit(1))["h"].alias("first"), F.flatten(parts).alias("series"), "by_hour", "mean")


def _lags_from(arrays: str, lags: Sequence[int], time: str) -> list[Column]:
    """The lag columns of a row joined to its zone's :func:`series_arrays`."""
    out, own = [], F.col(arrays)
    whole = F.col(time) == floor_to(time)
    for k in lags:
        at = (hour_number(F.col(time)) - k - own["first"] + 1).cast("int")
        exact = F.when(whole & (at >= 1), F.try_element_at(own["series"], at))
        usual = F.try_element_at(own["by_hour"], F.hour(add_hours(F.col(time), -k)) + 1)
        out.append(F.coalesce(exact, usual, F.lit(0.0)).alias(f"lag_{k}h"))
    return out


def _with_arrays(targets: DataFrame, history: DataFrame, zone: str, h_time: str, y: str) -> DataFrame:
    arrays = series_arrays(history, zone, h_time, y).select(F.col("zone").alias("__z"), F.struct("first", "series", "by_hour", "mean").alias("__arrays"))
    return targets.join(arrays, F.col(zone) == F.col("__z"), "left")


def lookup_lags(targets: DataFrame, history: DataFrame, lags: Sequence[int] = LAGS,
                zone: str = "PULocationID", time: str = "ts", h_time: str = "pickup_datetime",
                y: str = "trip_count") -> DataFrame:
    """Lag values of targets from a history table.

    Exact value at ``t - k hours``, else the mean of the zone's history at
    that hour of day, else 0.0. The history holds hours, one row per zone and
    hour, as the panel does; of duplicates the smallest value counts, so the
    result does not depend on row order. Equal targets stay as they are.

    One join by zone with the history's :func:`series_arrays` answers all
    lags; every lag is an element of the zone's array.
    """
    joined = _with_arrays(targets, history, zone, h_time, y)
    return joined.select(*[F.col(c) for c in targets.columns], *_lags_from("__arrays", lags, time))


def future_features(targets: DataFrame, history: DataFrame, calendar: DataFrame,
                    zone: str = "PULocationID", time: str = "ts", h_time: str = "pickup_datetime",
                    y: str = "trip_count", windows: Sequence[int] = ROLLING) -> DataFrame:
    """The 17 features for (zone, time) targets.

    Calendar and holidays as in training; lags by :func:`lookup_lags`; every
    rolling mean is the zone's history mean (train/serve skew of the
    reference, trap T16). A zone without history gets 0.0 and
    ``has_history = 0`` instead of an undefined value (trap T17).
    """
    t = temporal_features(targets, time)
    t = with_holidays(t, calendar, time)
    own = [F.col(c) for c in t.columns if not c.startswith("__")]
    t = _with_arrays(t, history, zone, h_time, y)
    mean = F.col("__arrays")["mean"]
    return t.select(*own, *_lags_from("__arrays", LAGS, time), *[F.coalesce(mean, F.lit(0.0)).alias(f"rolling_mean_{k}h") for k in windows],
                    mean.isNotNull().cast("int").alias("has_history"))


def naive_from_features(df: DataFrame, col: str = "prediction") -> DataFrame:
    """Leak-free naive score of future features: mean of the last 3 lags."""
    return df.withColumn(col, (F.col("lag_1h") + F.col("lag_2h") + F.col("lag_3h")) / 3.0)


def compare_forecast(fc: DataFrame, actual: DataFrame, zone: str = "PULocationID",
                     time: str = "ts", a_time: str = "pickup_datetime", y: str = "trip_count") -> DataFrame:
    """Forecast left join actuals on (zone, clock time); missing actual -> 0."""
    a = actual.select(F.col(zone).alias("__z"), F.col(a_time).alias("__t"), F.col(y).alias("__y"))
    j = fc.join(a, (F.col(zone) == F.col("__z")) & (F.col(time) == F.col("__t")), "left")
    return j.select(*fc.columns, F.coalesce(F.col("__y"), F.lit(0)).alias(y))


def forecast_summary(fc: DataFrame, zone: str = "PULocationID", p: str = "prediction",
                     by: Sequence[str] = ()) -> DataFrame:
    """Max, min, mean and sum of a horizon's predictions per zone."""
    return fc.groupBy(zone, *by).agg(F.max(p).alias("max_pred"), F.min(p).alias("min_pred"),
                                     F.avg(p).alias("mean_pred"), F.sum(p).alias("total_pred"))


def daily_forecast_error(pred: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                         y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Daily actual and predicted totals per zone with error, plus the
    zone's daily MAE and daily MAPE(+1) (A19). Error sign here is p - y as
    in the notebook it comes from."""
    d = (pred.groupBy(zone, F.to_date(time).alias("date"))
             .agg(F.sum(F.col(y).cast("double")).alias("actual"), F.sum(p).alias("predicted"))
             .withColumn("error", F.col("predicted") - F.col("actual")))
    # Per-zone summaries as window aggregates: no self-join, so the
    # prediction table is read once.
    w = Window.partitionBy(zone)
    return d.select("*", F.avg(F.abs("error")).over(w).alias("daily_mae"),
                    (100.0 * F.avg(F.abs(F.col("actual") - F.col("predicted")) / (F.col("actual") + 1)).over(w))
                    .alias("daily_mape"))


def hourly_profile(pred: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                   y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Mean actual and predicted per hour of day per zone."""
    return pred.groupBy(zone, F.hour(time).alias("hour")).agg(
        F.avg(F.col(y).cast("double")).alias("mean_actual"), F.avg(p).alias("mean_pred"))


def first_per_hour(df: DataFrame, keys: Sequence[str], time: str = "pickup_datetime",
                   y: str = "trip_count", order: Sequence[str] = ()) -> DataFrame:
    """First value of each hour in time order (A21): ``min_by`` on the
    ordering struct -- deterministic, unlike ``first``."""
    o = F.struct(F.col(time), *[F.col(c) for c in order])
    return df.groupBy(*keys, F.to_date(time).alias("date"), F.hour(time).alias("hour")) \
        .agg(F.min_by(y, o).alias(y))


def recent_daily(df: DataFrame, target, days: int = 7, zone: str = "PULocationID",
                 time: str = "pickup_datetime", y: str = "trip_count") -> DataFrame:
    """Daily totals per zone from ``target - days`` on (A24). Like the
    reference there is no upper bound on the date."""
    lo = F.timestamp_add("DAY", F.lit(-days), ntz(target))
    return (df.where(F.col(time) >= lo)
              .groupBy(zone, F.to_date(time).alias("date")).agg(F.sum(y).alias("daily_total")))


def history_and_forecast(df: DataFrame, fc: DataFrame, target, days: int = 7, zone: str = "PULocationID",
                         time: str = "pickup_datetime", y: str = "trip_count",
                         p: str = "prediction") -> DataFrame:
    """Recent daily totals plus the forecast day's total."""
    hist = recent_daily(df, target, days, zone, time, y).select(
        zone, "date", F.col("daily_total").cast("double").alias("trips"), F.lit("actual").alias("kind"))
    f = fc.groupBy(zone).agg(F.sum(p).alias("trips")).select(
        zone, F.to_date(ntz(target)).alias("date"), "trips", F.lit("forecast").alias("kind"))
    return hist.unionByName(f)


#: Zones of a lookup that are pushed into the scan as a list.
PUSHED_ZONES = 1000


def prune_to_keys(df: DataFrame, keys: DataFrame, zone: str = "PULocationID", limit: int = PUSHED_ZONES) -> DataFrame:
    """``df`` filtered to the zones of ``keys`` if these are at most ``limit``
    (so many reach the driver): the list reaches the Parquet scan, where row
    groups without the zones are skipped. Otherwise ``df`` as it is; the join
    that follows has Spark's run-time filter."""
    few = [r[0] for r in keys.select(zone).where(F.col(zone).isNotNull()).distinct().limit(limit + 1).collect()]
    return df.where(F.col(zone).isin(few)) if len(few) <= limit else df


def lookup_actual(df: DataFrame, keys: DataFrame, zone: str = "PULocationID",
                  time: str = "pickup_datetime", y: str = "trip_count", pushed: int = 0) -> DataFrame:
    """Actual value for many (zone, time) keys at once (F8). A key that
    ``df`` holds more than once gets its smallest value, whatever the row
    order; only the rows that match a key are grouped. With ``pushed`` up to
    as many zones are pushed into the scan (:func:`prune_to_keys`)."""
    actual = (prune_to_keys(df, keys, zone, pushed) if pushed else df).select(zone, time, y)
    return keys.select(zone, time).distinct().join(actual, [zone, time], "left") \
        .groupBy(zone, time).agg(F.min(y).alias(y))


def filter_zones(df: DataFrame, zones, zone: str = "PULocationID") -> DataFrame:
    """Zone membership (F9): ``isin`` for a short list, else a left-semi join."""
    if isinstance(zones, DataFrame):
        return df.join(zones.select(F.col(zone)).distinct(), zone, "left_semi")
    return df.where(F.col(zone).isin(list(zones)))


def series_slice(df: DataFrame, zones, start, end, zone: str = "PULocationID",
                 time: str = "pickup_datetime") -> DataFrame:
    """Zones in ``[start, end]``, ordered by zone and time."""
    d = filter_zones(df, zones, zone)
    return d.where(F.col(time).between(ntz(start), ntz(end))).orderBy(zone, time)
