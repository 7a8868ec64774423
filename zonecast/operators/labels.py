"""Row labels and the zone dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions.metrics import pct_error_eps
from zonecast.functions.time import ntz


def with_period(df: DataFrame, data_start, test_start, future_start, time: str = "pickup_datetime",
                col: str = "period") -> DataFrame:
    """``before_data`` / ``train`` / ``test`` / ``future`` by time."""
    t = F.col(time)
    return df.withColumn(col, F.when(t < ntz(data_start), "before_data")
                               .when(t < ntz(test_start), "train")
                               .when(t < ntz(future_start), "test")
                               .otherwise("future"))


def with_is_historical(df: DataFrame, reference: DataFrame, time: str = "ts",
                       ref_time: str = "pickup_datetime", col: str = "is_historical") -> DataFrame:
    """1 when ``t`` is at or before midnight of the reference table's last
    day, else 0 (F7). The bound is a scalar subquery over ``reference``."""
    last_midnight = reference.agg(F.date_trunc("day", F.max(ref_time)).cast("timestamp_ntz")).scalar()
    return df.withColumn(col, (F.col(time) <= last_midnight).cast("int"))


def with_band(df: DataFrame, p: str = "prediction", pct: float = 0.2) -> DataFrame:
    """Lower and upper bound at -/+ ``pct`` of the prediction."""
    return df.withColumn("lower", F.col(p) * (1 - pct)).withColumn("upper", F.col(p) * (1 + pct))


def with_severity(df: DataFrame, y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Percent error with +0.001 (E3) and its band: > 10 high, > 5 medium, else low."""
    e = pct_error_eps(y, p)
    return df.withColumn("error_pct", e).withColumn(
        "severity", F.when(F.col("error_pct") > 10, "high").when(F.col("error_pct") > 5, "medium").otherwise("low"))


def zone_dimension(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """A zone table ``LocationID, Borough, Zone, service_zone`` from a
    supplier/nation/region star: the driver tables stand in for the zone CSV."""
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    # No broadcast hint: AQE broadcasts a side whose measured size is under
    # spark.sql.autoBroadcastJoinThreshold and shuffles otherwise.
    return (supplier.select("s_suppkey", "s_name", "s_nationkey")
            .join(n, F.col("s_nationkey") == F.col("n_nationkey"), "left")
            .join(r, F.col("n_regionkey") == F.col("r_regionkey"), "left")
            .select(F.col("s_suppkey").cast("bigint").alias("LocationID"), F.col("n_name").alias("Borough"),
                    F.col("s_name").alias("Zone"), F.col("r_name").alias("service_zone")))


def zone_labels(zones: DataFrame) -> DataFrame:
    """Display label ``"%3d - name (borough)"`` in id order (F16)."""
    return zones.select("LocationID", F.format_string("%3d - %s (%s)", "LocationID", "Zone", "Borough")
                        .alias("label")).orderBy("LocationID")


def with_zone_name(df: DataFrame, zones: DataFrame, zone: str = "PULocationID", how: str = "left") -> DataFrame:
    """Zone name with the default ``Zone {id}`` (J7); ``how='inner'`` gives
    the zone attributes of known zones only (J8). Without a hint: adaptive
    execution broadcasts a dimension whose measured size allows it."""
    dim = zones.select(F.col("LocationID").alias("__id"), "Borough", "Zone", "service_zone")
    j = df.join(dim, F.col(zone) == F.col("__id"), how).drop("__id")
    if how == "left":
        j = j.withColumn("Zone", F.coalesce(F.col("Zone"), F.concat(F.lit("Zone "), F.col(zone).cast("string"))))
    return j
