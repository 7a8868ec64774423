import datetime as dt

from zonecast.functions.calendar import holiday_calendar, temporal_features

D = dt.date


def test_us_federal_2023_2025(spark):
    cal = holiday_calendar(spark, 2023, 2025).collect()
    dates = {r.holiday_date for r in cal}
    assert len(dates) == 35
    assert {D(2023, 1, 2), D(2023, 11, 10), D(2024, 1, 1), D(2024, 1, 15), D(2024, 5, 27),
            D(2024, 11, 28), D(2025, 6, 19)} <= dates


def test_temporal_features_monday_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 7, 23),), (dt.datetime(2024, 1, 8, 5),)], "pickup_datetime timestamp_ntz")
    r = temporal_features(df).orderBy("pickup_datetime").collect()
    assert (r[0].day_of_week, r[0].is_weekend, r[0].hour_of_week) == (6, 1, 167)
    assert (r[1].day_of_week, r[1].is_weekend, r[1].hour_of_week, r[1].day_of_month, r[1].month) == (0, 0, 5, 8, 1)
