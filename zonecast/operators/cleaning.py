"""Trip cleaning."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zonecast.functions.time import minutes_between
from zonecast.schema import TripCols, require_columns


def nan_to_null(c) -> Column:
    """NaN -> NULL (trap T1): Spark orders NaN above every number, pandas
    compares it false, so a NaN must not survive into a ``> 0`` test."""
    c = F.col(c) if isinstance(c, str) else c
    return F.when(F.isnan(c), F.lit(None)).otherwise(c)


def with_duration(df: DataFrame, cols: TripCols = TripCols()) -> DataFrame:
    """Add the trip duration in minutes unless the column exists (F1)."""
    if cols.duration in df.columns:
        return df
    return df.withColumn(cols.duration, minutes_between(cols.pickup, cols.dropoff))


def clean_condition(cols: TripCols = TripCols(), max_zone: int = 265) -> Column:
    """The conjunctive cleaning predicate of F2.

    Comparisons on stored columns (fare, distance, zones, passengers) are
    pushed to the parquet scan; the duration is derived and is applied after
    the scan. A NULL or NaN in any tested column drops the row.
    """
    def ok(c):
        return F.col(c).isNotNull() & ~F.isnan(F.col(c))

    return (ok(cols.fare) & (F.col(cols.fare) > 0)
            & ok(cols.distance) & (F.col(cols.distance) > 0)
            & F.col(cols.pu_zone).between(1, max_zone)
            & F.col(cols.do_zone).between(1, max_zone)
            & ok(cols.passengers) & (F.col(cols.passengers) > 0)
            & (minutes_between(cols.pickup, cols.dropoff) >= 1))


def clean_trips(df: DataFrame, cols: TripCols = TripCols(), max_zone: int = 265) -> DataFrame:
    """Keep trips with fare > 0, distance > 0, duration >= 1 min, both zones
    in 1..max_zone and passengers > 0 (F2)."""
    require_columns(df, [cols.pickup, cols.dropoff, cols.pu_zone, cols.do_zone,
                         cols.fare, cols.distance, cols.passengers], "clean_trips")
    return with_duration(df.where(clean_condition(cols, max_zone)), cols)


def clean_report(df: DataFrame, cols: TripCols = TripCols(), max_zone: int = 265) -> DataFrame:
    """Rows before, removed, percent removed, after -- one pass.

    Zero input rows give a NULL percent (the reference divides by zero).
    """
    keep = clean_condition(cols, max_zone)
    return (df.agg(F.count(F.lit(1)).alias("rows_before"),
                   F.count_if(keep).alias("rows_after"))
              .select("rows_before",
                      (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
                      F.when(F.col("rows_before") > 0,
                             100.0 * (F.col("rows_before") - F.col("rows_after")) / F.col("rows_before"))
                       .alias("pct_removed"),
                      "rows_after"))
