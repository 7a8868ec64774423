"""Plan shape: pushdown, one window stage, broadcast joins, no Python UDF."""

from pyspark.sql import functions as F

from zonecast.plans import fixture as fx
from zonecast.plans.explain import plan_text

from fixture_paths import SF001


def test_time_filter_reaches_the_scan(spark):
    from zonecast.functions.time import ntz
    t = fx.clean(spark, SF001).where(F.col("pickup_ts") >= ntz(fx.span(spark, SF001).cut))
    p = plan_text(t)
    assert "PushedFilters" in p and "GreaterThanOrEqual(ts" in p
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_flagship_plan(spark):
    p = plan_text(fx.features(spark, SF001))
    head = p.split("\n\n")[0]
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p
    assert "events" not in p                      # raw trips read once, by the written stage
    assert "BroadcastHashJoin" in head            # holiday flags
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert head.count("Sort (") == 1              # lags and rolling means share one sort


def test_scan_prunes_columns(spark):
    from zonecast.operators.profile import hourly_counts
    p = plan_text(hourly_counts(fx.trips(spark, SF001), "pickup_ts"))
    assert "ReadSchema: struct<ts:timestamp_ntz>" in p


def test_panel_is_spread_over_partitions(spark):
    parts = fx.features(spark, SF001).select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts > 1


def test_partitioned_scan_prunes(spark, tmp_path):
    from zonecast.sources import sinks, trips as src
    sinks.write_table(fx.trips(spark, SF001), str(tmp_path / "t"), partition_by=["dataset", "year_month"])
    df = src.scan_partitioned(spark, str(tmp_path / "t"), "yellow", ["2024-01"]).select("pickup_ts")
    p = plan_text(df)
    line = [x for x in p.split("\n") if "PartitionFilters" in x][0]
    assert "= yellow" in line and "= 2024-01" in line
    assert df.count() == fx.trips(spark, SF001).where("dataset = 'yellow'").count()


def test_unbroadcast_grid_join_shares_zone_partitioning(spark):
    """At scale the zone-hour side is too big to broadcast: the grid join
    then shuffles only that side to the grid's zone partitioning, and the
    per-zone window reuses the join's partitioning and sort order."""
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        head = plan_text(fx.features(spark, SF001)).split("\n\n")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "SortMergeJoin LeftOuter" in head
    assert head.count("Exchange (") - head.count("BroadcastExchange (") == 2
    above_join = head.split("SortMergeJoin")[0]
    assert "Exchange" not in above_join.replace("BroadcastExchange", "") and "Sort (" not in above_join


def test_bucketed_table_needs_no_exchange(spark, tmp_path):
    """Windows and joins by zone read the buckets as they lie."""
    from zonecast.operators.features import with_lags, with_rolling_means
    from zonecast.sources import sinks
    df = spark.range(4000).select((F.col("id") % 40).alias("PULocationID"), F.timestamp_seconds("id").cast("timestamp_ntz").alias("pickup_datetime"),
                                  (F.col("id") % 9).alias("trip_count"))
    table = sinks.write_bucketed(df, "bucketed_panel", str(tmp_path / "b"), ["PULocationID"], ["PULocationID", "pickup_datetime"], 6)
    made = with_rolling_means(with_lags(table))
    plan = made._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan and "Exchange" not in plan
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = table.join(table.groupBy("PULocationID").agg(F.sum("trip_count").alias("total")), "PULocationID")
        assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert made.exceptAll(with_rolling_means(with_lags(df))).count() == 0


def _scanned(df):
    """Rows that the file scan of a finished query gave."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    leaf = plan.collectLeaves().head()
    return leaf.metrics().apply("numOutputRows").value()


def test_lookup_skips_row_groups(spark, tmp_path):
    """Of a table for lookups the scan reads few rows; the filter list is pushed."""
    from zonecast.operators import forecast as fc
    from zonecast.sources import sinks
    rows = 200_000
    df = spark.range(rows).select((F.col("id") % 500 * 2).alias("PULocationID"), F.timestamp_seconds(F.expr("id div 500")).cast("timestamp_ntz").alias("pickup_datetime"),
                                  F.xxhash64("id").alias("trip_count"))
    path = str(tmp_path / "lookup")
    sinks.write_lookup_table(df, path, "PULocationID", row_group_bytes=64 << 10)
    back = spark.read.parquet(path)
    keys = spark.createDataFrame([(z,) for z in (4, 100, 500, 700, 998)], "PULocationID long")
    pruned = fc.prune_to_keys(back, keys)
    assert "In(PULocationID" in pruned._jdf.queryExecution().executedPlan().toString()
    assert pruned.count() == 5 * 400
    assert _scanned(fc.prune_to_keys(back, keys)) < rows / 5
    # keys that no row has lie between the others: only the Bloom filters know
    absent = spark.createDataFrame([(z,) for z in (5, 101, 501)], "PULocationID long")
    assert _scanned(fc.prune_to_keys(back, absent)) == 0
    # more keys than the limit are joined instead
    assert fc.prune_to_keys(back, keys, limit=3) is back
    at = keys.select("PULocationID", F.lit("1970-01-01 00:00:07").cast("timestamp_ntz").alias("pickup_datetime"))
    few, all_ = (fc.lookup_actual(back, at, pushed=n) for n in (1000, 0))
    assert few.exceptAll(all_).count() == 0 and few.count() == 5
