"""Lag and rolling features per zone (W1, W2, F11) and the feature table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from zonecast.functions.calendar import holiday_calendar, temporal_features, with_holidays
from zonecast.functions.time import hour_number
from zonecast.operators.grid import complete_grid, filter_range
from zonecast.operators.zonehour import consolidate
from zonecast.schema import FEATURES, LAGS, ROLLING
from zonecast.session import materialize

#: Hours of a chunk where the window stage is cut in time: a quarter of a year.
CHUNK_HOURS = 2190


def _zone_window(zone: str | Sequence[str], time: str):
    return Window.partitionBy(*([zone] if isinstance(zone, str) else zone)).orderBy(time)


def with_lags(df: DataFrame, lags: Sequence[int] = LAGS, zone: str = "PULocationID",
              time: str = "pickup_datetime", y: str = "trip_count", prefix: str = "lag_",
              method: str = "window") -> DataFrame:
    """``lag_{k}h`` = the value k rows earlier in the zone.

    On a complete grid a row is an hour, so k rows is k hours. Values are
    doubles with NULL for the first k rows of a zone. All lags share one
    window spec and therefore one shuffle by zone and one sort.

    ``method="join"`` takes the value at ``t - k hours`` by one equi-join on
    (zone, hour) instead -- for series too long, or zones too hot, for one
    window task per zone: the join keys are unique, so no task holds more
    than a hash share of the rows. On a complete grid both give the same
    table.
    """
    if method == "join":
        src = df.select(F.col(zone).alias("__z"), F.col(time).alias("__t"), F.col(y).cast("double").alias("__y"))
        x = df.select(zone, time, F.explode(F.array(*[F.lit(k) for k in lags])).alias("__k")) \
            .withColumn("__lt", F.timestamp_add("HOUR", -F.col("__k"), F.col(time)))
        j = x.join(src, (F.col(zone) == F.col("__z")) & (F.col("__lt") == F.col("__t")), "left")
        folded = j.groupBy(zone, time).agg(*[F.max(F.when(F.col("__k") == k, F.col("__y"))).alias(f"{prefix}{k}h")
                                             for k in lags])
        return df.join(folded, [zone, time], "left")
    w = _zone_window(zone, time)
    return df.select("*", *[F.lag(F.col(y).cast("double"), k).over(w).alias(f"{prefix}{k}h") for k in lags])


def rolling_mean(y: str, k: int, zone: str, time: str, include_current: bool = True,
                 integral: bool = True) -> tuple[list[tuple[str, Column]], Column]:
    """Column expression for a k-row trailing mean of ``y`` per zone.

    Integral ``y``: the running sum and running non-null count are taken once
    (O(n) frames) and the window sum is their difference with the value k
    rows back -- exact for integers and independent of k. Other types use the
    frame average directly. With ``include_current=False`` the frame is the k
    rows before the current one (leak-free variant, trap T15).
    """
    w = _zone_window(zone, time)
    if not integral:
        lo, hi = (-(k - 1), 0) if include_current else (-k, -1)
        return [], F.avg(F.col(y).cast("double")).over(w.rowsBetween(lo, hi))
    cs, cc = f"__cs_{y}", f"__cc_{y}"
    pre = [(cs, F.sum(F.col(y).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0))),
           (cc, F.count(F.col(y)).over(w.rowsBetween(Window.unboundedPreceding, 0)))]
    if include_current:
        s = F.col(cs) - F.coalesce(F.lag(cs, k).over(w), F.lit(0))
        n = F.col(cc) - F.coalesce(F.lag(cc, k).over(w), F.lit(0))
    else:
        s = F.lag(cs, 1).over(w) - F.coalesce(F.lag(cs, k + 1).over(w), F.lit(0))
        n = F.lag(cc, 1).over(w) - F.coalesce(F.lag(cc, k + 1).over(w), F.lit(0))
    return pre, F.when(n > 0, s.cast("double") / n)


def with_rolling_means(df: DataFrame, windows: Sequence[int] = ROLLING, zone: str = "PULocationID",
                       time: str = "pickup_datetime", y: str = "trip_count",
                       include_current: bool = True, prefix: str = "rolling_mean_") -> DataFrame:
    """``rolling_mean_{k}h``: mean of the last k rows of the zone, at least
    one row (W2). ``include_current=True`` reproduces the reference, whose
    window ends at the current row and so contains the target."""
    integral = isinstance(df.schema[y].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    pres, cols = {}, []
    for k in windows:
        pre, c = rolling_mean(y, k, zone, time, include_current, integral)
        pres.update(dict(pre))
        cols.append(c.alias(f"{prefix}{k}h"))
    base = df.select("*", *[c.alias(n) for n, c in pres.items()]) if pres else df
    return base.select(*df.columns, *cols)


def with_chunked_features(df: DataFrame, lags: Sequence[int] = LAGS, windows: Sequence[int] = ROLLING,
                          chunk_hours: int = CHUNK_HOURS, zone: str = "PULocationID", time: str = "pickup_datetime",
                          y: str = "trip_count", include_current: bool = True) -> DataFrame:
    """Lags and rolling means (W1, W2) of a complete grid, cut in time.

    Windows are partitioned by zone and chunk of ``chunk_hours``, so their
    number does not end at the number of zones. Each chunk also gets the last
    hours of the ones before that its lags and windows reach back to; these
    ghost rows are dropped afterwards. The result is that of the windows by
    zone. A row must be an hour, as on a complete grid.
    """
    halo = max(*lags, *windows, 0)
    h = hour_number(time)
    chunk = lambda hour: F.floor(hour / chunk_hours)
    copied = df.withColumns({"__own": chunk(h), "__chunk": F.explode(F.sequence(chunk(h), chunk(h + halo)))})
    parts = [zone, "__chunk"]
    out = with_rolling_means(with_lags(copied, lags, parts, time, y), windows, parts, time, y, include_current)
    return out.where(F.col("__own") == F.col("__chunk")).drop("__own", "__chunk")


def fill_features(df: DataFrame, cols: Sequence[str] = FEATURES, value=0) -> DataFrame:
    """Missing feature values -> 0."""
    return df.fillna(value, subset=list(cols))


def build_features(zone_hour: DataFrame, start, end, calendar: DataFrame | None = None,
                   zone: str = "PULocationID", time: str = "pickup_datetime",
                   y: str = "trip_count", lags: Sequence[int] = LAGS,
                   windows: Sequence[int] = ROLLING, include_current: bool = True,
                   mean_cols: Sequence[str] | None = None,
                   end_inclusive: str = "instant", consolidated: bool = False,
                   chunk_hours: int | None = None) -> DataFrame:
    """Zone-hour table -> complete panel with the 17 features.

    Range filter (F4) -> consolidate duplicates (A4) -> grid completion
    (J2/J3) -> calendar (C2) -> holidays (J6) -> lags (W1) -> rolling means
    (W2). Panel rows are zones x hours; lags and rolling means run in one
    window stage partitioned by zone.

    The consolidated zone-hour table -- the stage the reference writes to
    parquet -- is materialised in the shared checkpoint folder: the grid's
    zone list and the data side then read it instead of scanning the raw
    trips twice, and a lost executor restarts from it. ``consolidated`` says
    that ``zone_hour`` is such a table already; ``chunk_hours`` cuts the window
    stage in time as well (:func:`with_chunked_features`).
    """
    spark = zone_hour.sparkSession
    df = filter_range(zone_hour, start, end, time, end_inclusive)
    if not consolidated:
        df = materialize(consolidate(df, zone, time, y, mean_cols), "zone-hour")
    df = complete_grid(df, start, end, zone, time, end_inclusive=end_inclusive)
    df = temporal_features(df, time)
    if calendar is None:
        y0, y1 = int(str(start)[:4]), int(str(end)[:4])
        calendar = holiday_calendar(spark, y0 - 1, y1 + 1)
    df = with_holidays(df, calendar, time)
    if chunk_hours:
        return with_chunked_features(df, lags, windows, chunk_hours, zone, time, y, include_current)
    df = with_lags(df, lags, zone, time, y)
    return with_rolling_means(df, windows, zone, time, y, include_current)
