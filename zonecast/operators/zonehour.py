"""Zone-hour demand tables.

All aggregations here are declared as one ``groupBy().agg`` each, so Spark
plans a partial (map-side) aggregate before the shuffle: a hot zone holding a
third of all trips is combined inside each scan task and only one row per
(task, zone, hour) crosses the network.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.numeric import round_half_even
from zonecast.functions.time import floor_minutes, floor_to
from zonecast.operators.cleaning import nan_to_null
from zonecast.schema import TripCols, require_columns


def aggregate_zone_hour(df: DataFrame, cols: TripCols = TripCols(), by: Sequence[str] = (),
                        zone_out: str = "PULocationID", time_out: str = "pickup_datetime",
                        unit: str = "hour", bucket_minutes: int | None = None) -> DataFrame:
    """Yellow-path zone-hour demand (A1).

    ``trip_count`` counts non-null vendor ids (trap T7); fare, distance and
    passenger means are rounded as pandas rounds, to 2 places (trap T3). NULL zones
    are dropped as pandas' group-by does (trap T4). ``by`` adds grouping
    columns ahead of zone and hour, e.g. the source month of each file, which
    reproduces per-file aggregation followed by :func:`consolidate` (T10).
    """
    require_columns(df, [cols.pickup, cols.pu_zone, cols.vendor, cols.fare,
                         cols.distance, cols.passengers, *by], "aggregate_zone_hour")
    keyed = df.where(F.col(cols.pu_zone).isNotNull() & F.col(cols.pickup).isNotNull())
    bucket = floor_minutes(cols.pickup, bucket_minutes) if bucket_minutes else floor_to(cols.pickup, unit)
    out = (keyed.groupBy(*by, F.col(cols.pu_zone).alias(zone_out), bucket.alias(time_out))
                .agg(F.count(cols.vendor).alias("trip_count"),
                     F.avg(nan_to_null(cols.fare)).alias("_fare"),
                     F.avg(nan_to_null(cols.distance)).alias("_dist"),
                     F.avg(nan_to_null(cols.passengers)).alias("_pax")))
    return out.select(*by, zone_out, time_out, "trip_count",
                      round_half_even("_fare", 2).alias("avg_fare"),
                      round_half_even("_dist", 2).alias("avg_trip_distance"),
                      round_half_even("_pax", 2).alias("avg_passenger_count"))


def normalize_trips(df: DataFrame, dataset: str, cols: TripCols = TripCols()) -> DataFrame:
    """Common schema ``pickup_datetime, PULocationID, trip_distance,
    passenger_count, dataset`` for one source (S6/S7).

    Yellow keeps distance and passengers; FHVHV has neither, so distance is
    the constant 0 and passengers the constant 1. Only the needed columns are
    selected, so the parquet scan reads just those (S5).
    """
    if dataset == "fhvhv":
        return df.select(F.col(cols.pickup).cast("timestamp_ntz").alias("pickup_datetime"),
                         F.col(cols.pu_zone).cast("bigint").alias("PULocationID"),
                         F.lit(0.0).alias("trip_distance"),
                         F.lit(1.0).alias("passenger_count"),
                         F.lit(dataset).alias("dataset"))
    return df.select(F.col(cols.pickup).cast("timestamp_ntz").alias("pickup_datetime"),
                     F.col(cols.pu_zone).cast("bigint").alias("PULocationID"),
                     F.col(cols.distance).cast("double").alias("trip_distance"),
                     F.col(cols.passengers).cast("double").alias("passenger_count"),
                     F.lit(dataset).alias("dataset"))


def normalize_mixed(df: DataFrame, cols: TripCols) -> DataFrame:
    """:func:`normalize_trips` for one table that holds both sources, told
    apart by its dataset column: one scan instead of one for each source."""
    yellow = F.col(cols.dataset) == "yellow"
    return df.where(F.col(cols.dataset).isin("yellow", "fhvhv")).select(
        F.col(cols.pickup).cast("timestamp_ntz").alias("pickup_datetime"),
        F.col(cols.pu_zone).cast("bigint").alias("PULocationID"),
        F.when(yellow, F.col(cols.distance).cast("double")).otherwise(F.lit(0.0)).alias("trip_distance"),
        F.when(yellow, F.col(cols.passengers).cast("double")).otherwise(F.lit(1.0)).alias("passenger_count"),
        F.col(cols.dataset).alias("dataset"))


def totals_zone_hour(df: DataFrame, by: Sequence[str] = (), unit: str = "hour") -> DataFrame:
    """Combined-path zone-hour totals from a normalised frame.

    Sum of distance, sum of passengers and the row count in one aggregate --
    the reference groups twice and merges; one pass gives the same table.
    Sums of all-missing groups are 0, as in pandas (trap T2).
    """
    keyed = df.where(F.col("PULocationID").isNotNull() & F.col("pickup_datetime").isNotNull())
    return (keyed.groupBy(floor_to("pickup_datetime", unit).alias("pickup_datetime"),
                          "PULocationID", *by)
                 .agg(F.coalesce(F.sum(nan_to_null("trip_distance")), F.lit(0.0)).alias("total_distance"),
                      F.coalesce(F.sum(nan_to_null("passenger_count")), F.lit(0.0)).alias("total_passengers"),
                      F.count(F.lit(1)).alias("trip_count"))
                 .select("pickup_datetime", "PULocationID", *by, "total_distance",
                         "total_passengers", "trip_count"))


def combine_sources(frames: Sequence[DataFrame]) -> DataFrame:
    """Union the per-source totals and re-sum per (hour, zone)."""
    u = frames[0]
    for f in frames[1:]:
        u = u.unionByName(f, allowMissingColumns=True)
    return (u.groupBy("pickup_datetime", "PULocationID")
             .agg(F.sum("trip_count").alias("trip_count"),
                  F.coalesce(F.sum("total_distance"), F.lit(0.0)).alias("total_distance"),
                  F.coalesce(F.sum("total_passengers"), F.lit(0.0)).alias("total_passengers")))


def consolidate(df: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                count_col: str = "trip_count", mean_cols: Sequence[str] | None = None) -> DataFrame:
    """Merge duplicate (zone, hour) rows: sum of counts, unweighted mean of
    the other numeric columns (A4/A5, traps T9/T10).

    ``mean_cols=None`` takes every column except the keys, the count and a
    ``dataset`` tag.
    """
    if mean_cols is None:
        mean_cols = [c for c in df.columns if c not in (zone, time, count_col, "dataset")]
    return (df.groupBy(zone, time)
              .agg(F.sum(count_col).alias(count_col),
                   *[F.avg(c).alias(c) for c in mean_cols]))


def profile_zone_hour(df: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                      approx: bool = False) -> DataFrame:
    """Row count, time range and distinct zones.

    ``approx=True`` uses a HyperLogLog++ sketch whose state is bounded, for
    tables where the exact distinct set per task would be large.
    """
    nz = F.approx_count_distinct(zone) if approx else F.count_distinct(zone)
    return df.agg(F.count(F.lit(1)).alias("n_rows"), F.min(time).alias("first_ts"),
                  F.max(time).alias("last_ts"), nz.alias("n_zones"))


def zone_stats(df: DataFrame, zone: str = "PULocationID", y: str = "trip_count") -> DataFrame:
    """Mean, max, min and number of records of the count per zone."""
    return df.groupBy(zone).agg(F.avg(y).alias("mean_demand"), F.max(y).alias("max_demand"),
                                F.min(y).alias("min_demand"), F.count(F.lit(1)).alias("n_records"))


def daily_totals(df: DataFrame, zone: str = "PULocationID", time: str = "pickup_datetime",
                 y: str = "trip_count") -> DataFrame:
    """Daily totals per zone."""
    return (df.groupBy(zone, F.to_date(time).alias("date"))
              .agg(F.sum(y).alias("daily_total")))


def distinct_zones(df: DataFrame, zone: str = "PULocationID") -> DataFrame:
    """Distinct zones in order."""
    return df.select(zone).where(F.col(zone).isNotNull()).distinct().orderBy(zone)
