"""Column-name configuration and the canonical feature list."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# The 17 model features in the order used for training and
# scoring, and the target column.
FEATURES = [
    "hour", "day_of_week", "day_of_month", "month", "is_weekend", "hour_of_week",
    "is_holiday", "is_holiday_eve",
    "lag_1h", "lag_2h", "lag_3h", "lag_24h", "lag_168h",
    "rolling_mean_3h", "rolling_mean_12h", "rolling_mean_24h", "rolling_mean_168h",
]
TARGET = "trip_count"
LAGS = [1, 2, 3, 24, 168]
ROLLING = [3, 12, 24, 168]
TEMPORAL = FEATURES[:6]


@dataclass(frozen=True)
class TripCols:
    """Names of the raw trip columns (defaults: the yellow-taxi schema)."""

    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    pu_zone: str = "PULocationID"
    do_zone: str = "DOLocationID"
    fare: str = "fare_amount"
    distance: str = "trip_distance"
    passengers: str = "passenger_count"
    vendor: str = "VendorID"
    duration: str = "trip_duration_min"
    dataset: str = "dataset"


# Column names of the driver-fixture trips (events mapped to trips).
FIXTURE_TRIPS = TripCols(pickup="pickup_ts", dropoff="dropoff_ts", pu_zone="pu_zone",
                         do_zone="do_zone", fare="fare", distance="distance",
                         passengers="passengers", vendor="vendor_id")


@dataclass(frozen=True)
class PanelCols:
    """Names of the zone-hour panel columns."""

    zone: str = "PULocationID"
    time: str = "pickup_datetime"
    y: str = TARGET
    pred: str = "y_pred"


ZONES = T.StructType([
    T.StructField("LocationID", T.LongType()),
    T.StructField("Borough", T.StringType()),
    T.StructField("Zone", T.StringType()),
    T.StructField("service_zone", T.StringType()),
])


def require_columns(df, cols, where: str) -> None:
    """Fail early, naming the operator, when an input column is missing."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{where}: missing columns {missing}; have {df.columns}")
