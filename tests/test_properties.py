"""Property tests on generated zone-hour tables."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from zonecast.operators import grid, metrics
from zonecast.operators.features import with_rolling_means

T0 = dt.datetime(2024, 1, 1)
cells = st.lists(st.tuples(st.integers(1, 6), st.integers(0, 47), st.integers(0, 9)), min_size=1, max_size=40,
                 unique_by=lambda c: (c[0], c[1]))
SETTINGS = settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))


def _df(spark, rows):
    return spark.createDataFrame([(z, T0 + dt.timedelta(hours=h), c) for z, h, c in rows],
                                 "PULocationID bigint, pickup_datetime timestamp_ntz, trip_count bigint")


@SETTINGS
@given(rows=cells)
def test_grid_size_and_totals(spark, rows):
    df = _df(spark, rows)
    g = grid.complete_grid(df, "2024-01-01 00:00:00", "2024-01-02 23:00:00")
    zones = len({z for z, _, _ in rows})
    assert g.count() == zones * 48
    assert g.agg(F.sum("trip_count")).first()[0] == sum(c for _, _, c in rows)


@SETTINGS
@given(rows=cells)
def test_rolling_one_is_identity(spark, rows):
    g = grid.complete_grid(_df(spark, rows), "2024-01-01 00:00:00", "2024-01-02 23:00:00")
    r = with_rolling_means(g, [1])
    assert r.where(F.col("rolling_mean_1h") != F.col("trip_count").cast("double")).count() == 0


@SETTINGS
@given(rows=cells, shift=st.floats(-2, 2, allow_nan=False))
def test_zone_mae_weighted_by_n_is_global_mae(spark, rows, shift):
    df = _df(spark, rows).withColumn("y_pred", F.col("trip_count") + F.lit(shift) * (F.col("PULocationID") % 3))
    df = df.withColumn("period", F.lit("test"))
    g = metrics.metrics(df).first()
    z = metrics.metrics_by_zone(df).collect()
    weighted = sum(r.mae * r.n_samples for r in z) / sum(r.n_samples for r in z)
    assert math.isclose(weighted, g.mae, rel_tol=1e-9, abs_tol=1e-12)
