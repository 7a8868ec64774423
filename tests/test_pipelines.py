from pyspark.sql import functions as F

from zonecast.plans import fixture as fx
from zonecast.plans import pipelines as pl
from zonecast.sources import sinks

from fixture_paths import SF001


def _raw(spark, tmp_path):
    t = fx.trips(spark, SF001)
    y = t.where(F.col("dataset") == "yellow").select(
        F.col("vendor_id").alias("VendorID"), F.col("pickup_ts").alias("tpep_pickup_datetime"),
        F.col("dropoff_ts").alias("tpep_dropoff_datetime"), F.col("pu_zone").alias("PULocationID"),
        F.col("do_zone").alias("DOLocationID"), F.col("passengers").alias("passenger_count"),
        F.col("distance").alias("trip_distance"), F.col("fare").alias("fare_amount"))
    h = t.where(F.col("dataset") == "fhvhv").select(F.col("pickup_ts").alias("pickup_datetime"),
                                                    F.col("pu_zone").alias("PULocationID"))
    sinks.write_table(y, str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    sinks.write_table(h, str(tmp_path / "fhvhv_tripdata_2024-01.parquet"))
    return t


def test_yellow_and_combined_paths(spark, tmp_path):
    t = _raw(spark, tmp_path)
    zh = pl.yellow_zone_hour(spark, str(tmp_path), ["2024-01", "2024-02"])
    yellow_clean = fx.clean(spark, SF001).where(F.col("dataset") == "yellow")
    assert zh.agg(F.sum("trip_count")).first()[0] == yellow_clean.where(F.col("vendor_id").isNotNull()).count()
    comb = pl.combined_zone_hour(spark, str(tmp_path), ["2024-01"])
    assert comb.agg(F.sum("trip_count")).first()[0] == t.where(F.col("pu_zone").isNotNull()).count()


def test_evaluate_and_save(spark, tmp_path):
    _raw(spark, tmp_path)
    zh = pl.yellow_zone_hour(spark, str(tmp_path), ["2024-01"])
    panel = pl.feature_table(zh, fx.span(spark, SF001).start, fx.span(spark, SF001).end)
    model = pl.save_final(panel, str(tmp_path / "model"), str(tmp_path / "history"))
    pred = pl.predictions(panel, model, fx.span(spark, SF001).cut)
    rep = pl.evaluate(pred)
    assert {r.period for r in rep["global"].collect()} == {"train", "test"}
    det = pl.detailed_tests(pred, pl.predictions(panel, model, fx.span(spark, SF001).cut))
    assert det["stability"].first().stable
    assert spark.read.parquet(str(tmp_path / "history")).count() > 0


def test_forecast_all_zones(spark, tmp_path):
    from zonecast.operators.forecast import recent_history
    _raw(spark, tmp_path)
    zh = pl.yellow_zone_hour(spark, str(tmp_path), ["2024-01"])
    panel = pl.feature_table(zh, fx.span(spark, SF001).start, fx.span(spark, SF001).end)
    model = pl.save_final(panel, str(tmp_path / "m"), str(tmp_path / "h"))
    fc = pl.forecast(model, panel, fx.span(spark, SF001).forecast_start, recent_history(panel), fx.calendar(spark, SF001), 6)
    n_zones = panel.select("PULocationID").distinct().count()
    assert fc.count() == 6 * n_zones
    assert fc.agg(F.min("prediction")).first()[0] >= 0.0
