"""The fixture pipeline: driver ``events`` -> trips -> zone-hour panel ->
naive forecast. Shared stages of the registered queries; the time range and
the split come from the data.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.calendar import holiday_calendar
from zonecast.operators.cleaning import clean_trips
from zonecast.operators.features import build_features
from zonecast.operators.zonehour import aggregate_zone_hour, consolidate
from zonecast.schema import FIXTURE_TRIPS
from zonecast.session import materialize
from zonecast.sources.fixture import read_fixture_trips

HISTORY_DAYS = 14   # of the forecast history
TEST_DAYS = 8       # before the last day that the test period begins
HORIZON_DAYS = 1    # before the last day that the forecast begins


@dataclass(frozen=True)
class Span:
    """The time range of the data and the dates derived from it."""

    start: str           # first day
    end: str             # last hour
    cut: str             # first hour of the test period
    forecast_start: str
    first_year: int
    last_year: int


_spans: dict[tuple, Span] = {}


def version(spark: SparkSession, sf_dir: str) -> tuple:
    """What tells whether the events of a folder are the same as before:
    application, path, and length and time of each file."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{sf_dir}/events.parquet")
    files = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listStatus(p)
    return (spark.sparkContext.applicationId, sf_dir, *((f.getLen(), f.getModificationTime()) for f in files))


def span(spark: SparkSession, sf_dir: str) -> Span:
    """Range, split and forecast dates from the first and last event: one
    small aggregate, kept for as long as the files stay the same."""
    key = version(spark, sf_dir)
    if key not in _spans:
        r = spark.read.parquet(f"{sf_dir}/events.parquet").agg(F.min("ts").alias("a"), F.max("ts").alias("b")).first()
        if r["a"] is None:
            raise ValueError(f"{sf_dir}: no events")
        day = r["b"].replace(hour=0, minute=0, second=0, microsecond=0)
        form = "%Y-%m-%d %H:%M:%S"
        _spans[key] = Span(r["a"].strftime("%Y-%m-%d 00:00:00"), r["b"].strftime("%Y-%m-%d %H:00:00"),
                           (day - timedelta(days=TEST_DAYS)).strftime(form),
                           (day - timedelta(days=HORIZON_DAYS)).strftime(form), r["a"].year, r["b"].year)
    return _spans[key]


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_fixture_trips(spark, sf_dir)


def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_trips(trips(spark, sf_dir), FIXTURE_TRIPS)


def zone_hour(spark: SparkSession, sf_dir: str, by_source: bool = True) -> DataFrame:
    """Cleaned trips -> zone-hour demand, over all trips. With ``by_source``
    the aggregate is taken per dataset first, as the reference aggregates per
    file (T10)."""
    return aggregate_zone_hour(clean(spark, sf_dir), FIXTURE_TRIPS, by=["dataset"] if by_source else [])


def calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holidays of the years of the data and one either side."""
    s = span(spark, sf_dir)
    return holiday_calendar(spark, s.first_year - 1, s.last_year + 1)


def stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The consolidated zone-hour table, written once as parquet (K1) -- the
    stage that grids, panels and reports read instead of the raw trips."""
    return materialize(consolidate(zone_hour(spark, sf_dir).drop("dataset")), "zone-hour")


def features(spark: SparkSession, sf_dir: str, include_current: bool = True, zh: DataFrame | None = None,
             chunk_hours: int | None = None) -> DataFrame:
    """The flagship panel: complete zone x hour grid with the 17 features,
    from the zone-hour stage."""
    s = span(spark, sf_dir)
    return build_features(zh if zh is not None else stage(spark, sf_dir), s.start, s.end, calendar(spark, sf_dir),
                          include_current=include_current, consolidated=True, chunk_hours=chunk_hours)


def panel(spark: SparkSession, sf_dir: str, zh: DataFrame | None = None) -> DataFrame:
    """Feature panel with the naive forecast, residuals and the period label."""
    from zonecast.operators.forecast import naive_forecast
    from zonecast.operators.grid import with_split_period
    from zonecast.operators.metrics import with_residuals
    f = features(spark, sf_dir, zh=zh)
    return with_split_period(with_residuals(naive_forecast(f)), span(spark, sf_dir).cut)


def test_rows(spark: SparkSession, sf_dir: str, zh: DataFrame | None = None) -> DataFrame:
    return panel(spark, sf_dir, zh).where(F.col("period") == "test")


def busiest_zones(zh: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` zones with the most trips (ties: lower id) -- the zone list
    of the per-zone reports, summed from the zone-hour stage."""
    return (zh.groupBy("PULocationID").agg(F.sum("trip_count").alias("total"))
              .orderBy(F.col("total").desc(), "PULocationID").limit(n).select("PULocationID"))
