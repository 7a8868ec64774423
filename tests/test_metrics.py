from pyspark.sql import functions as F
import math

import numpy as np

from zonecast.functions.quantiles import exact_percentiles
from zonecast.operators import diagnostics, metrics


def test_exact_percentiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    for data in (rng.normal(size=3000), np.r_[np.zeros(2000), rng.exponential(size=1000)], np.array([4.0])):
        df = spark.createDataFrame([(float(x),) for x in data], "x double")
        ps = [0, 0.01, 0.25, 0.5, 0.9, 0.99, 1]
        got = exact_percentiles(df, "x", ps, buckets=40)
        assert np.allclose(got, np.percentile(data, [p * 100 for p in ps]), atol=1e-12)


def test_empty_percentiles(spark):
    assert exact_percentiles(spark.createDataFrame([], "x double"), "x", [0.5]) == [None]


def _frame(spark, y, p):
    return spark.createDataFrame([("test", float(a), float(b)) for a, b in zip(y, p)],
                                 "period string, trip_count double, y_pred double")


def test_metrics_zero_and_constant_actuals(spark):
    y, p = [0, 2, 4, 0, 2, 4], [1, 2, 3, 0, 1, 5]
    r = metrics.metrics(_frame(spark, y, p)).first()
    yy, pp = np.array(y, float), np.array(p, float)
    assert math.isclose(r.mae, np.mean(np.abs(yy - pp)))
    assert math.isclose(r.rmse, math.sqrt(np.mean((yy - pp) ** 2)))
    nz = yy != 0
    assert math.isclose(r.mape, 100 * np.mean(np.abs((yy[nz] - pp[nz]) / yy[nz])))
    assert math.isclose(r.r2, 1 - np.sum((yy - pp) ** 2) / np.sum((yy - yy.mean()) ** 2))
    assert metrics.metrics(_frame(spark, [0, 0], [1, 1])).first().mape == 0.0
    assert metrics.metrics(_frame(spark, [3, 3], [3, 3])).first().r2 == 1.0
    assert metrics.metrics(_frame(spark, [3, 3], [2, 3])).first().r2 == 0.0


def test_decile_codes_like_qcut(spark):
    y = [0, 0, 0, 0, 0, 0, 1, 2, 3, 10]
    df = _frame(spark, y, [0] * 10)
    edges = diagnostics.decile_edges(df)
    codes = [r.decile for r in diagnostics.with_decile(df, edges).orderBy("trip_count").collect()]
    assert codes == [0, 0, 0, 0, 0, 0, 1, 2, 3, 4]


def test_normality_on_normal_data(spark):
    rng = np.random.default_rng(0)
    e = rng.normal(size=4000)
    df = _frame(spark, e, np.zeros_like(e))
    r = diagnostics.residual_normality(df).first()
    assert r.normal and r.n == 4000


def test_sample_n_exact_and_deterministic(spark):
    df = spark.range(1000).withColumnRenamed("id", "k")
    a = [r.k for r in diagnostics.sample_n(df, 50, ["k"]).collect()]
    b = [r.k for r in diagnostics.sample_n(df, 50, ["k"]).collect()]
    assert len(a) == 50 and a == b and len(set(a)) == 50


def test_exact_percentiles_with_refinement(spark):
    rng = np.random.default_rng(11)
    data = np.r_[rng.normal(size=4000), np.full(1500, 0.25), rng.exponential(size=500)]
    df = spark.createDataFrame([(float(x),) for x in data], "x double")
    ps = [0, 0.05, 0.3, 0.5, 0.77, 0.999, 1]
    got = exact_percentiles(df, "x", ps, buckets=4, max_distinct=20)
    assert np.allclose(got, np.percentile(data, [p * 100 for p in ps]), atol=1e-12)


def test_exact_percentiles_direct_and_multi_paths(spark):
    from zonecast.functions.quantiles import exact_percentiles_multi
    rng = np.random.default_rng(5)
    a = rng.normal(size=3000)
    b = rng.integers(0, 6, size=3000).astype(float)
    b[:3] = np.inf
    df = spark.createDataFrame([(float(x), float(y)) for x, y in zip(a, b)], "a double, b double")
    ps = [0, 0.2, 0.5, 0.999, 1]
    got = exact_percentiles_multi(df, ["a", "b"], ps, buckets=8, max_distinct=50)
    assert np.allclose(got[0], np.percentile(a, [p * 100 for p in ps]), atol=1e-12)
    with np.errstate(invalid="ignore"):
        exp_b = np.percentile(b, [p * 100 for p in ps])
    assert np.array_equal(np.array(got[1], dtype=float), exp_b, equal_nan=True)


def test_approx_option_close_to_exact(spark):
    rng = np.random.default_rng(2)
    e = rng.exponential(size=5000)
    df = spark.createDataFrame([(float(x), 0.0) for x in e], "trip_count double, y_pred double")
    ex = {r.percentile: r.abs_error for r in diagnostics.error_percentiles(df).collect()}
    ap = {r.percentile: r.abs_error for r in diagnostics.error_percentiles(df, accuracy=100000).collect()}
    assert all(abs(ex[k] - ap[k]) < 0.01 for k in ex)


def test_missing_values_are_not_counted(spark):
    nan = float("nan")
    df = spark.createDataFrame([(1.0,), (1.0,), (nan,), (None,), (2.0,)], "v double")
    from zonecast.operators import profile
    assert [(r.v, r["count"]) for r in profile.value_counts(df, "v").collect()] == [(1.0, 2), (2.0, 1)]
    assert [(r.v, r["count"]) for r in profile.value_counts(df, "v", n=1).collect()] == [(1.0, 2)]
    assert [r.v for r in profile.value_counts(df, "v", order="key").collect()] == [1.0, 2.0]


def test_describe_skips_nan(spark):
    import math
    from zonecast.operators import profile
    df = spark.createDataFrame([(1.0,), (2.0,), (float("nan"),), (None,)], "v double")
    r = profile.describe_numeric(df, ["v"]).first()
    assert (r["count"], r["mean"], r["min"], r["max"], r["p50"]) == (2, 1.5, 1.0, 2.0, 1.5)
    assert math.isclose(r["std"], 0.5 ** 0.5)


def test_lookups_do_not_depend_on_row_order(spark):
    from zonecast.operators import forecast as fc
    rows = [(1, "2024-01-01 00:00:00", v) for v in (5, 4, 3)] + [(1, "2024-01-01 01:00:00", 9)]
    schema = "PULocationID long, t string, trip_count long"
    for n in (1, 2, 3, 4):
        df = spark.createDataFrame(rows, schema).repartition(n).select(
            "PULocationID", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"), "trip_count")
        keys = df.select("PULocationID", "pickup_datetime").distinct()
        got = {(str(r.pickup_datetime), r.trip_count) for r in fc.lookup_actual(df, keys).collect()}
        assert got == {("2024-01-01 00:00:00", 3), ("2024-01-01 01:00:00", 9)}
        targets = keys.where("hour(pickup_datetime) = 1").select("PULocationID", F.col("pickup_datetime").alias("ts"))
        lag = fc.lookup_lags(targets, df, lags=[1, 2])
        assert lag.count() == 1 and tuple(lag.select("lag_1h", "lag_2h").first()) == (3.0, 0.0)


def test_equal_targets_stay(spark):
    """Two equal targets are two rows; gaps, odd minutes and missing zones
    fall back to the mean of the hour of day, then to 0."""
    from zonecast.operators import forecast as fc
    h = [(1, "2024-01-01 00:00:00", 5), (1, "2024-01-01 03:00:00", 7), (1, "2024-01-02 01:00:00", 4), (1, "2024-01-03 01:00:00", 8), (2, None, 1)]
    hist = spark.createDataFrame(h, "PULocationID long, t string, trip_count long").select(
        "PULocationID", F.col("t").cast("timestamp_ntz").alias("pickup_datetime"), "trip_count")
    t = [(1, "2024-01-01 04:00:00"), (1, "2024-01-01 04:00:00"), (1, "2024-01-01 02:00:00"), (1, "2024-01-01 04:30:00"), (3, "2024-01-01 04:00:00"), (1, None), (None, "2024-01-01 04:00:00")]
    targets = spark.createDataFrame(t, "PULocationID long, t string").select("PULocationID", F.col("t").cast("timestamp_ntz").alias("ts"))
    got = sorted(((r.PULocationID, str(r.ts), r.lag_1h, r.lag_2h) for r in fc.lookup_lags(targets, hist, lags=[1, 2]).collect()), key=str)
    # 03:00 exact, 02:00 unknown; 01:00 is not there on the first day: the mean of 4 and 8
    assert got == sorted([(1, "2024-01-01 04:00:00", 7.0, 0.0), (1, "2024-01-01 04:00:00", 7.0, 0.0), (1, "2024-01-01 02:00:00", 6.0, 5.0),
                          (1, "2024-01-01 04:30:00", 7.0, 0.0), (3, "2024-01-01 04:00:00", 0.0, 0.0), (1, "None", 0.0, 0.0),
                          (None, "2024-01-01 04:00:00", 0.0, 0.0)], key=str)
    plan = fc.lookup_lags(targets, hist)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join ") == 1
    empty = fc.lookup_lags(targets, hist.limit(0), lags=[1]).collect()
    assert len(empty) == len(t) and {r.lag_1h for r in empty} == {0.0}


def test_normal_quantile_and_tail(spark):
    from statistics import NormalDist
    from zonecast.functions.normal import normal_quantile, normal_upper_tail
    ps = [1e-300, 1e-20, 1e-6, 0.01, 0.07, 0.3, 0.5, 0.9, 0.99, 1 - 1e-9]
    zs = [-9.0, -3.0, -0.5, 0.0, 0.7, 3.0, 7.0, 7.2, 12.0]
    df = spark.createDataFrame([(float(p), float(z)) for p in ps for z in zs], "p double, z double")
    for r in df.select("p", "z", normal_quantile(F.col("p")).alias("q"), normal_upper_tail(F.col("z")).alias("t")).collect():
        assert math.isclose(r.q, NormalDist().inv_cdf(r.p), rel_tol=1e-13, abs_tol=1e-14)
        assert math.isclose(r.t, math.erfc(r.z / math.sqrt(2)) / 2, rel_tol=1e-8)


def _plain_shapiro(e):
    """Royston's W and p, one value after the other."""
    from statistics import NormalDist
    e, n = sorted(e), len(e)
    m = [NormalDist().inv_cdf((i - 0.375) / (n + 0.25)) for i in range(1, n + 1)]
    ss, u = sum(v * v for v in m), 1 / math.sqrt(n)

    def poly(c, x):
        return sum(v * x ** i for i, v in enumerate(c))
    d = diagnostics
    a = [0.0] * n
    a[-1] = m[-1] / math.sqrt(ss) + poly(d.OUTERMOST, u) if n > 3 else math.sqrt(0.5)
    k, left, rest = 1, ss - 2 * m[-1] ** 2, 1 - 2 * a[-1] ** 2
    if n > 5:
        a[-2] = m[-2] / math.sqrt(ss) + poly(d.SECOND, u)
        k, left, rest = 2, left - 2 * m[-2] ** 2, rest - 2 * a[-2] ** 2
    for i in range(k, n - k):
        a[i] = m[i] / math.sqrt(left / rest) if n > 3 else 0.0
    for i in range(k):
        a[i] = -a[-1 - i]
    mean = sum(e) / n
    w = sum(x * y for x, y in zip(a, e)) ** 2 / sum((v - mean) ** 2 for v in e)
    if n == 3:
        return w, max(0.0, 6 / math.pi * (math.asin(math.sqrt(w)) - math.asin(math.sqrt(0.75))))
    if n <= 11:
        z = (-math.log(poly(d.SMALL_SHIFT, n) - math.log(1 - w)) - poly(d.SMALL_MEAN, n)) / math.exp(poly(d.SMALL_SD, n))
    else:
        z = (math.log(1 - w) - poly(d.LARGE_MEAN, math.log(n))) / math.exp(poly(d.LARGE_SD, math.log(n)))
    return w, math.erfc(z / math.sqrt(2)) / 2


def test_shapiro_wilk(spark):
    def test(values, **kw):
        df = spark.createDataFrame([(i, float(v), 0.0) for i, v in enumerate(values)], "k long, trip_count double, y_pred double")
        return diagnostics.shapiro_wilk(df, ["k"], **kw).collect()

    # the weights of eleven men, the worked example of the test's first paper
    r = test([148, 154, 158, 160, 161, 162, 166, 170, 182, 195, 236])[0]
    assert r.n == 11 and math.isclose(r.w, 0.7888147, abs_tol=1e-6) and math.isclose(r.p_value, 0.006703814, abs_tol=1e-6) and not r.normal
    rng = np.random.default_rng(9)
    for n in (3, 5, 6, 12, 300):
        for x in (rng.exponential(size=n).round(2),):
            r = test(x)[0]
            w, p = _plain_shapiro(x)
            assert r.n == n and math.isclose(r.w, w, rel_tol=1e-9) and math.isclose(r.p_value, p, rel_tol=1e-6, abs_tol=1e-12)
    assert test([1.0, 2.0]) == [] and test([5.0] * 9) == []
    assert test(rng.normal(size=300), n=50)[0].n == 50


def test_global_lags(spark):
    from zonecast.functions.ordered import with_global_lags
    rng = np.random.default_rng(4)
    rows = [(int(z), i, float(rng.integers(0, 9))) for i, z in enumerate(rng.integers(0, 3, 300))]
    df = spark.createDataFrame(rows, "z long, t long, v double")
    order = sorted(rows)
    for parts in (1, 4, 40):
        got = {(r.z, r.t): (r.row, r.v_lag1, r.v_lag24) for r in with_global_lags(df, ["z", "t"], ["v"], [1, 24], parts).collect()}
        assert len(got) == 300
        for g, (z, t, _) in enumerate(order):
            assert got[(z, t)] == (g, order[g - 1][2] if g >= 1 else None, order[g - 24][2] if g >= 24 else None)
    assert with_global_lags(df.limit(0), ["z", "t"], ["v"], [1]).count() == 0


def test_chunked_windows_equal_those_by_zone(spark):
    from zonecast.operators.features import with_chunked_features, with_lags, with_rolling_means
    hours = spark.range(500).select(F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("1969-12-28 00:00:00").cast("timestamp_ntz")).alias("pickup_datetime"), "id")
    df = hours.select(F.explode(F.array(F.lit(1), F.lit(2))).alias("PULocationID"), "pickup_datetime",
                      (F.col("id") * 7 % 11).alias("trip_count"))
    want = with_rolling_means(with_lags(df))
    for size in (7, 168):
        got = with_chunked_features(df, chunk_hours=size)
        assert got.columns == want.columns
        assert got.exceptAll(want).count() == 0 and got.count() == 1000
    coalesce = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        busy = with_chunked_features(df, chunk_hours=20).groupBy(F.spark_partition_id().alias("p")).count().collect()
        assert len(busy) == 4 and max(r["count"] for r in busy) < 500  # two zones, four tasks
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", coalesce)


def test_merged_profiles_equal_the_direct_ones(spark):
    from zonecast.operators import profile, zonehour
    rng = np.random.default_rng(8)
    rows = [(f"2024-{m:02d}", int(z), f"2024-{m:02d}-01 00:00:00", int(c)) for m, z, c in zip(rng.integers(1, 7, 4000), rng.integers(0, 900, 4000), rng.integers(0, 5000, 4000))]
    df = spark.createDataFrame(rows, "year_month string, PULocationID long, t string, trip_count long").withColumn("pickup_datetime", F.col("t").cast("timestamp_ntz"))
    months = profile.monthly_profiles(df)
    for some in (None, ["2024-02", "2024-05"], ["2024-03"]):
        part = df if some is None else df.where(F.col("year_month").isin(some))
        got, direct, stats = profile.merged_profile(months, some).first(), zonehour.profile_zone_hour(part).first(), profile.demand_stats(part).first()
        assert (got.n_rows, got.first_ts, got.last_ts) == (direct.n_rows, direct.first_ts, direct.last_ts)
        assert (got.total_trips, got.mean_trips, got.max_trips) == (stats.total_trips, stats.mean_trips, stats.max_trips)
        assert abs(got.n_zones / direct.n_zones - 1) < 0.05
        assert abs(sum(c <= got.median_trips for m, _, _, c in rows if some is None or m in some) / got.n_rows - 0.5) < 0.02
    assert profile.merged_profile(months, ["2030-01"]).count() == 0
