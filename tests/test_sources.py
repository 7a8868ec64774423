import pytest
from pyspark.sql import functions as F

from zonecast.plans import fixture as fx, queries
from zonecast.sources import sinks, trips as src

from fixture_paths import SF001


def test_select_months():
    assert src.select_months([2024], [2, 1], ["2023-12", "2024-01"]) == ["2023-12", "2024-01", "2024-02"]
    with pytest.raises(ValueError):
        src.select_months(year_months=["2008-05"])
    with pytest.raises(ValueError):
        src.select_months([2024], [13])


def test_scan_skips_missing_month_and_tags_month(spark, tmp_path):
    t = fx.trips(spark, SF001).drop("year_month")
    sinks.write_table(t, str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    df = src.scan_trips(spark, str(tmp_path), "yellow", ["2023-11", "2024-01"], columns=["pickup_ts", "fare"])
    assert df.count() == t.count()
    assert [r.year_month for r in df.select("year_month").distinct().collect()] == ["2024-01"]
    assert set(df.columns) == {"pickup_ts", "fare", "year_month", "source_dataset"}
    with pytest.raises(FileNotFoundError):
        src.scan_trips(spark, str(tmp_path), "yellow", ["2020-01"])


def test_read_first_existing_and_report(spark, tmp_path):
    df = spark.range(5).withColumn("v", F.col("id") * 2)
    sinks.write_table(df, str(tmp_path / "b"))
    assert src.read_first_existing(spark, [str(tmp_path / "a"), str(tmp_path / "b")]).count() == 5
    sinks.write_report(df, str(tmp_path / "r"))
    back = spark.read.csv(str(tmp_path / "r"), header=True)
    assert back.count() == 5 and len(list((tmp_path / "r").glob("part-*.csv"))) == 1


def _month(spark, tmp_path, dataset, month, n, passenger_type):
    df = spark.range(n).select(F.lit("2024-01-05 10:00:00").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
                               F.lit("2024-01-05 10:30:00").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
                               F.lit(4).cast("bigint").alias("PULocationID"), F.lit(7).cast("bigint").alias("DOLocationID"),
                               F.lit(2).cast(passenger_type).alias("passenger_count"), F.lit(3.0).alias("trip_distance"),
                               F.lit(9.5).alias("fare_amount"), F.lit(1).cast("int" if passenger_type == "double" else "bigint").alias("VendorID"))
    if dataset == "fhvhv":
        df = df.select(F.col("tpep_pickup_datetime").alias("pickup_datetime"), "PULocationID")
    sinks.write_table(df, str(tmp_path / f"{dataset}_tripdata_{month}.parquet"))


def test_months_of_differing_types_all_count(spark, tmp_path):
    from zonecast.plans import pipelines as pl
    _month(spark, tmp_path, "yellow", "2024-01", 5, "double")
    _month(spark, tmp_path, "yellow", "2024-02", 7, "bigint")
    df = src.scan_trips(spark, str(tmp_path), "yellow")
    assert df.count() == 12 and dict(df.dtypes)["passenger_count"] == "double"
    assert pl.yellow_zone_hour(spark, str(tmp_path)).agg(F.sum("trip_count")).first()[0] == 12
    # one source missing altogether
    assert pl.combined_zone_hour(spark, str(tmp_path)).agg(F.sum("trip_count")).first()[0] == 12
    with pytest.raises(FileNotFoundError):
        pl.combined_zone_hour(spark, str(tmp_path / "nothing"))


def test_columns_that_a_month_lacks_are_null(spark, tmp_path):
    sinks.write_table(spark.range(2), str(tmp_path / "yellow_tripdata_2024-01.parquet"))
    sinks.write_table(spark.range(3).withColumn("fee", F.lit(1)), str(tmp_path / "yellow_tripdata_2024-02.parquet"))
    df = src.scan_trips(spark, str(tmp_path), "yellow")
    assert df.count() == 5 and df.where("fee is null").count() == 2
    with pytest.raises(ValueError):
        src.scan_trips(spark, str(tmp_path), "yellow", columns=["absent"])


def test_unreadable_month_fails_yellow_and_is_named_in_combined(spark, tmp_path):
    from zonecast.plans import pipelines as pl
    _month(spark, tmp_path, "yellow", "2024-01", 5, "double")
    _month(spark, tmp_path, "fhvhv", "2024-01", 3, "double")
    (tmp_path / "yellow_tripdata_2024-02.parquet").write_bytes(b"not a parquet file")
    with pytest.raises(Exception, match="(?i)footer|parquet"):
        pl.yellow_zone_hour(spark, str(tmp_path))
    skipped = []
    assert pl.combined_zone_hour(spark, str(tmp_path), unreadable=skipped).agg(F.sum("trip_count")).first()[0] == 8
    assert [p.rsplit("/", 1)[1] for p in skipped] == ["yellow_tripdata_2024-02.parquet"]


def test_report_keeps_the_partitions_of_its_plan(spark, tmp_path):
    """The one writing task takes result rows; the panel is not pulled into it."""
    sinks.write_report(spark.range(0, 1000, 1, 4).groupBy((F.col("id") % 3).alias("k")).count(), str(tmp_path / "r"))
    assert len(list((tmp_path / "r").glob("part-*.csv"))) == 1
    ids = spark.range(0, 1000, 1, 4).withColumn("p", F.spark_partition_id())
    sinks.write_report(ids, str(tmp_path / "p"))
    assert spark.read.csv(str(tmp_path / "p"), header=True).select("p").distinct().count() == 4


def test_zone_names_without_a_hint(spark):
    from zonecast.operators import labels
    from zonecast.plans.explain import plan_text
    r = spark.read.parquet
    zones = labels.zone_dimension(r(f"{SF001}/supplier.parquet"), r(f"{SF001}/nation.parquet"),
                                  r(f"{SF001}/region.parquet"))
    ids = spark.range(0, 30).withColumnRenamed("id", "PULocationID")
    named = labels.with_zone_name(ids, zones)
    assert "ResolvedHint" not in plan_text(named)
    assert named.orderBy("PULocationID").collect()[-1].Zone.startswith("Zone ") is (zones.count() < 30)


def test_queries_leave_the_callers_session_alone(spark):
    from zonecast.session import DEFAULT_CONF, own_session
    plain = spark.newSession()
    before = {k: plain.conf.get(k, None) for k in DEFAULT_CONF}
    plain.conf.set("spark.sql.shuffle.partitions", "3")
    own = own_session(plain)
    assert {k: plain.conf.get(k, None) for k in DEFAULT_CONF} == before
    assert own.conf.get("spark.sql.shuffle.partitions") == "3"
    assert all(own.conf.get(k) == v for k, v in DEFAULT_CONF.items())


def test_stages_are_parquet_in_the_checkpoint_folder(spark):
    from zonecast.plans.explain import plan_text
    from zonecast.session import materialize
    df = materialize(spark.range(10).withColumn("v", F.col("id") * 2).withColumn("w", F.lit(1)))
    assert "ReadSchema: struct<v:bigint>" in plan_text(df.select("v"))


def test_source_roundtrip_takes_the_months_of_the_data(spark, tmp_path):
    e = spark.read.parquet(f"{SF001}/events.parquet")
    later = e.withColumn("ts", F.when(F.col("event_id") % 3 == 0, F.col("ts")).otherwise(F.add_months("ts", 11) + (F.col("ts") - F.date_trunc("day", "ts"))))
    later.write.parquet(str(tmp_path / "events.parquet"))
    want = fx.trips(spark, str(tmp_path)).groupBy("dataset", "year_month").count().collect()
    got = queries.source_roundtrip(spark, str(tmp_path)).groupBy("dataset", "year_month").count().collect()
    assert {r.year_month for r in want} == {"2024-01", "2024-12"}
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_zone_csv_is_written_by_all_tasks(spark, tmp_path, monkeypatch):
    zones = queries._zones(spark, SF001).repartition(4).localCheckpoint()
    monkeypatch.setattr(queries, "_zones", lambda *_: zones)
    monkeypatch.setattr(queries, "scratch_path", lambda *_: str(tmp_path / "zones"))
    got = queries.zone_csv(spark, SF001)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, zones.select(got.columns).collect()))
    assert len(list((tmp_path / "zones").glob("part-*.csv"))) > 1
