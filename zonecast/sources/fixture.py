"""Map the driver's ``events`` table onto the trip schema.

The mapping is a pure projection, so it runs as a narrow stage on the scan;
every derived column follows the canonical definition of the test fixture
(FIXTURES.md section 3).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def events_to_trips(events: DataFrame) -> DataFrame:
    """``events(event_id, ts, user_id, event_type, value, props)`` -> trips."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.select(
        e.alias("trip_id"),
        F.when(e % 97 == 0, F.lit(None).cast("bigint")).otherwise(F.col("user_id") % 300).alias("pu_zone"),
        (e * 7 % 300).alias("do_zone"),
        F.col("ts").alias("pickup_ts"),
        F.timestamp_add("SECOND", F.round(F.col("value") * 60).cast("bigint"), F.col("ts")).alias("dropoff_ts"),
        (F.col("value") - 1.0).alias("fare"),
        (k.cast("double") / 10.0).alias("distance"),
        F.when(e % 50 == 0, F.lit(None).cast("bigint")).otherwise(k % 7).cast("double").alias("passengers"),
        F.when(F.col("event_type") == "error", F.lit(None).cast("bigint"))
         .otherwise(e % 2 + 1).alias("vendor_id"),
        F.when(F.col("event_type").isin("view", "click"), F.lit("fhvhv"))
         .otherwise(F.lit("yellow")).alias("dataset"),
        F.date_format("ts", "yyyy-MM").alias("year_month"),
    )


def read_fixture_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_trips(spark.read.parquet(f"{sf_dir}/events.parquet"))
