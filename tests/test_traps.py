"""One test per semantic trap of the survey."""

import datetime as dt
import math

import numpy as np
from pyspark.sql import functions as F

from zonecast.functions.calendar import holiday_calendar
from zonecast.functions.numeric import round_half_even
from zonecast.functions.time import floor_to
from zonecast.operators import cleaning, diagnostics, grid, zonehour
from zonecast.operators.features import with_lags, with_rolling_means
from zonecast.operators.forecast import forecast_targets, future_features
from zonecast.schema import TripCols

D = dt.datetime
TRIP_SCHEMA = ("VendorID bigint, tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, "
               "PULocationID bigint, DOLocationID bigint, passenger_count double, trip_distance double, "
               "fare_amount double")


def trip(v=1, pu=10, do=20, pax=1.0, dist=1.0, fare=5.0, minutes=5, start=D(2024, 1, 1, 8, 15)):
    return (v, start, start + dt.timedelta(minutes=minutes), pu, do, pax, dist, fare)


def test_t1_nan_and_null_drop_rows(spark):
    rows = [trip(), trip(fare=0.0), trip(dist=0.0), trip(minutes=0), trip(pu=0), trip(do=266),
            trip(pax=0.0), trip(fare=float("nan")), trip(pax=None), trip(pu=None)]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    assert cleaning.clean_trips(df).count() == 1
    rep = cleaning.clean_report(df).first()
    assert (rep.rows_before, rep.rows_removed, rep.rows_after) == (10, 9, 1)
    assert math.isclose(rep.pct_removed, 90.0)


def test_clean_report_empty_gives_null_percent(spark):
    df = spark.createDataFrame([], TRIP_SCHEMA)
    assert cleaning.clean_report(df).first().pct_removed is None


def test_t2_sum_of_missing_is_zero(spark):
    df = spark.createDataFrame([(D(2024, 1, 1, 1), 5, None, None, "yellow")],
                               "pickup_datetime timestamp_ntz, PULocationID bigint, trip_distance double, "
                               "passenger_count double, dataset string")
    r = zonehour.totals_zone_hour(df).first()
    assert (r.total_distance, r.total_passengers, r.trip_count) == (0.0, 0.0, 1)


def test_t3_pandas_rounding(spark):
    df = spark.createDataFrame([(0.125,), (0.135,), (2.675,), (1.005,), (1.015,)], "x double")
    got = [r.y for r in df.select(round_half_even("x", 2).alias("y")).collect()]
    assert got == [float(np.round(v, 2)) for v in (0.125, 0.135, 2.675, 1.005, 1.015)]
    assert got[:4] == [0.12, 0.14, 2.68, 1.0]


def test_t4_null_zone_dropped_and_t7_vendor_count(spark):
    rows = [trip(v=None), trip(v=2), trip(pu=None)]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    out = zonehour.aggregate_zone_hour(df).collect()
    assert len(out) == 1 and out[0].trip_count == 1 and out[0].PULocationID == 10


def test_t5_floor_keeps_naive_type(spark):
    df = spark.createDataFrame([(D(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    out = df.select(floor_to("t").alias("h"))
    assert out.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert out.first().h == D(2024, 3, 10, 2, 0)


def test_t6_range_closed_at_instant(spark):
    z = spark.createDataFrame([(1,)], "PULocationID bigint")
    g = grid.zone_hour_grid(z, "2024-01-01 00:00:00", "2024-01-30 00:00:00")
    assert g.count() == 697
    g2 = grid.zone_hour_grid(z, "2024-01-01", "2025-03-31")
    assert g2.count() == 10921
    g3 = grid.zone_hour_grid(z, "2024-01-01", "2024-01-02", end_inclusive="day")
    assert g3.count() == 48


def test_t8_only_new_cells_are_filled(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1, 0), 3, None), (1, D(2024, 1, 1, 2), 1, 2.5),
                                (2, D(2024, 1, 1, 1), 4, 1.0)],
                               "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint, avg_fare double")
    out = {(r.PULocationID, r.pickup_datetime.hour): r for r in
           grid.complete_grid(df, "2024-01-01 00:00:00", "2024-01-01 04:00:00").collect()}
    assert len(out) == 10
    assert out[(1, 0)].avg_fare is None            # existing NULL kept
    assert out[(1, 1)].avg_fare == 0.0 and out[(1, 1)].trip_count == 0
    assert sum(r.trip_count for r in out.values()) == 8


def test_t9_t10_consolidate_means_of_means(spark):
    df = spark.createDataFrame([(1, D(2024, 1, 1), 1, 10.0, 2.0), (1, D(2024, 1, 1), 3, 20.0, None)],
                               "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint, "
                               "avg_fare double, total_distance double")
    r = zonehour.consolidate(df).first()
    assert (r.trip_count, r.avg_fare, r.total_distance) == (4, 15.0, 2.0)


def test_t11_autocorr_pairs_stay_in_zone(spark):
    rows = []
    for z, sign in ((1, 1.0), (2, -1.0)):
        for h in range(50):
            rows.append((z, D(2024, 1, 1) + dt.timedelta(hours=h), 0, sign * (h % 2)))
    df = spark.createDataFrame(rows, "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint, y_pred double")
    r = {x.lag: x.autocorr for x in diagnostics.residual_autocorr(df, lags=[2]).collect()}
    assert math.isclose(r[2], 1.0)


def test_t15_rolling_identity_and_t13_lags(spark):
    rows = [(7, D(2024, 1, 1) + dt.timedelta(hours=h), h) for h in range(200)]
    df = spark.createDataFrame(rows, "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint")
    f = with_rolling_means(with_lags(df)).orderBy("pickup_datetime").collect()
    for r in f[2:]:
        assert math.isclose(3 * r.rolling_mean_3h - r.lag_1h - r.lag_2h, r.trip_count, abs_tol=1e-9)
    assert f[0].lag_1h is None and f[0].rolling_mean_3h == 0.0
    assert f[199].lag_168h == 31.0
    assert f[199].rolling_mean_168h == np.mean(range(32, 200))
    lf = with_rolling_means(df, [1, 3], include_current=False).orderBy("pickup_datetime").collect()
    assert lf[0].rolling_mean_3h is None and lf[5].rolling_mean_3h == 3.0 and lf[5].rolling_mean_1h == 4.0


def test_rolling_double_path_matches_integral(spark):
    rows = [(1, D(2024, 1, 1) + dt.timedelta(hours=h), h % 5) for h in range(40)]
    df = spark.createDataFrame(rows, "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint")
    a = with_rolling_means(df, [3, 24]).orderBy("pickup_datetime").collect()
    b = with_rolling_means(df.withColumn("trip_count", F.col("trip_count").cast("double")), [3, 24]) \
        .orderBy("pickup_datetime").collect()
    assert all(math.isclose(x.rolling_mean_24h, y.rolling_mean_24h) for x, y in zip(a, b))


def test_t17_t19_zone_without_history(spark):
    hist = spark.createDataFrame([(1, D(2024, 1, 1, h), 5) for h in range(24)],
                                 "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint")
    zones = spark.createDataFrame([(1,), (2,)], "PULocationID bigint")
    tg = forecast_targets(zones, "2024-01-02 06:00:00", 3)
    cal = holiday_calendar(spark, 2023, 2025)
    ff = {(r.PULocationID, r.step): r for r in future_features(tg, hist, cal).collect()}
    assert ff[(2, 0)].has_history == 0 and ff[(2, 0)].rolling_mean_3h == 0.0 and ff[(2, 0)].lag_1h == 0.0
    assert ff[(1, 0)].has_history == 1 and ff[(1, 0)].lag_24h == 5.0 and ff[(1, 0)].lag_1h == 5.0
    assert ff[(1, 2)].ts == D(2024, 1, 2, 8) and ff[(1, 2)].hour == 8


def test_t20_observed_new_year_in_previous_year(spark):
    cal = {r.holiday_date for r in holiday_calendar(spark, 2021, 2022).collect()}
    assert dt.date(2021, 12, 31) in cal


def test_t21_t22_weekly_rows_and_std(spark):
    rows = [(1, D(2025, 3, 30, 23), 1, 0.0), (1, D(2025, 3, 31, 0), 3, 0.0)]
    df = spark.createDataFrame(rows, "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint, y_pred double")
    w = {(r.iso_year, r.week): r.n_rows for r in diagnostics.weekly_mae(df).collect()}
    assert w == {(2025, 13): 1, (2025, 14): 1}
    d = diagnostics.error_distribution(df).first()
    assert math.isclose(d.std, 1.0)  # population std of [1, 3]


def test_join_lags_equal_window_lags(spark):
    rows = [(z, D(2024, 1, 1) + dt.timedelta(hours=h), (h * 7 + z) % 11) for z in (1, 2) for h in range(60)]
    df = spark.createDataFrame(rows, "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint")
    a = with_lags(df, [1, 24]).orderBy("PULocationID", "pickup_datetime").collect()
    b = with_lags(df, [1, 24], method="join").orderBy("PULocationID", "pickup_datetime").collect()
    assert [(r.lag_1h, r.lag_24h) for r in a] == [(r.lag_1h, r.lag_24h) for r in b]


def test_thirty_minute_buckets(spark):
    rows = [trip(start=D(2024, 1, 1, 8, 10)), trip(start=D(2024, 1, 1, 8, 40)), trip(start=D(2024, 1, 1, 8, 29))]
    df = spark.createDataFrame(rows, TRIP_SCHEMA)
    out = {r.pickup_datetime: r.trip_count for r in zonehour.aggregate_zone_hour(df, bucket_minutes=30).collect()}
    assert out == {D(2024, 1, 1, 8, 0): 2, D(2024, 1, 1, 8, 30): 1}
