"""Registered queries: one callable (spark, sf_dir) -> DataFrame per
operator of the inventory, each run over the whole fixture tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.functions.calendar import temporal_features as _temporal, with_holidays
from zonecast.operators import cleaning, grid, zonehour
from zonecast.operators.features import with_lags, with_rolling_means
from zonecast.plans import fixture as fx
from zonecast.plans.present import present
from zonecast.schema import FEATURES, FIXTURE_TRIPS, LAGS, TARGET
from zonecast.session import materialize, own_session, scratch_path
from zonecast.operators import profile, labels, metrics as mt, diagnostics as dg, forecast as fcst
from zonecast.operators.cleaning import with_duration
from zonecast.functions import time as tf
from zonecast.functions.numeric import round_half_even
from zonecast.operators import models as md
from zonecast.operators.linear import fit_all
from zonecast.plans import pipelines
from zonecast.sources import sinks, trips as src

REGISTRY: dict = {}


def register(fn):
    def run(spark, sf_dir, _f=fn):
        return present(_f(own_session(spark), sf_dir))
    REGISTRY[fn.__name__] = run
    return fn


# ---- flagship and feature stages ------------------------------------------

@register
def zone_hour_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The full feature panel."""
    return fx.features(spark, sf_dir)


@register
def chunked_features(spark, sf_dir):
    """W1, W2 in windows by zone and ten days: the flagship panel again."""
    return fx.features(spark, sf_dir, chunk_hours=240)


@register
def clean_trips(spark, sf_dir):
    return fx.clean(spark, sf_dir)


@register
def clean_report(spark, sf_dir):
    return cleaning.clean_report(fx.trips(spark, sf_dir), FIXTURE_TRIPS)


@register
def zone_hour_demand(spark, sf_dir):
    """A1 over all cleaned trips, one weighted group-by."""
    return zonehour.aggregate_zone_hour(fx.clean(spark, sf_dir), FIXTURE_TRIPS)


def _normalized(spark, sf_dir):
    return zonehour.normalize_mixed(fx.trips(spark, sf_dir), FIXTURE_TRIPS)


@register
def zone_hour_totals(spark, sf_dir):
    """S6/S7 + A2 per source (no cleaning on the combined path, T23)."""
    return zonehour.totals_zone_hour(_normalized(spark, sf_dir), by=["dataset"])


@register
def combined_demand(spark, sf_dir):
    """A3: both sources' totals, summed in one scan and one group-by."""
    return zonehour.totals_zone_hour(_normalized(spark, sf_dir))


@register
def consolidated_demand(spark, sf_dir):
    """A4 after per-source A1: sum of counts, mean of the averages."""
    zh = fx.zone_hour(spark, sf_dir)
    return zonehour.consolidate(zh, mean_cols=["avg_fare", "avg_trip_distance", "avg_passenger_count"])


@register
def zone_hour_grid(spark, sf_dir):
    """J2 + J3: complete zone x hour grid, new cells filled with 0."""
    s = fx.span(spark, sf_dir)
    return grid.complete_grid(fx.stage(spark, sf_dir), s.start, s.end)


def _panel(spark, sf_dir, zh=None):
    """The completed (zone, hour, trip_count) panel over the written
    zone-hour stage; branches of a query read the stage again."""
    s = fx.span(spark, sf_dir)
    zh = zh if zh is not None else fx.stage(spark, sf_dir)
    return grid.complete_grid(zh.select("PULocationID", "pickup_datetime", "trip_count"), s.start, s.end)


@register
def temporal_features(spark, sf_dir):
    return _temporal(_panel(spark, sf_dir))


@register
def holiday_calendar(spark, sf_dir):
    """C1 for the years the data covers, one either side."""
    from zonecast.functions.calendar import holiday_calendar_for
    return holiday_calendar_for(fx.trips(spark, sf_dir), "pickup_ts")


@register
def holiday_flags(spark, sf_dir):
    return with_holidays(_panel(spark, sf_dir), fx.calendar(spark, sf_dir))


@register
def lag_features(spark, sf_dir):
    return with_lags(_panel(spark, sf_dir))


@register
def rolling_features(spark, sf_dir):
    return with_rolling_means(_panel(spark, sf_dir))


@register
def rolling_features_leakfree(spark, sf_dir):
    return with_rolling_means(_panel(spark, sf_dir), include_current=False)


# ---- profiles ---------------------------------------------------------------


@register
def demand_profile(spark, sf_dir):
    return zonehour.profile_zone_hour(zonehour.consolidate(fx.zone_hour(spark, sf_dir).drop("dataset")))


@register
def demand_stats(spark, sf_dir):
    return profile.demand_stats(combined_demand(spark, sf_dir))


@register
def zone_stats(spark, sf_dir):
    return zonehour.zone_stats(_panel(spark, sf_dir))


@register
def describe_numeric(spark, sf_dir):
    return profile.describe_numeric(fx.clean(spark, sf_dir), ["fare", "distance", "passengers", "trip_duration_min"])


@register
def top_zones(spark, sf_dir):
    return profile.value_counts(fx.trips(spark, sf_dir), "pu_zone", 10)


@register
def passenger_counts(spark, sf_dir):
    return profile.value_counts(fx.trips(spark, sf_dir), "passengers", order="key")


@register
def weekday_counts(spark, sf_dir):
    return profile.counts_by_weekday(fx.trips(spark, sf_dir), "pickup_ts")


@register
def daily_counts(spark, sf_dir):
    return profile.daily_counts(fx.trips(spark, sf_dir), "pickup_ts")


@register
def daily_summary(spark, sf_dir):
    return profile.daily_summary(fx.trips(spark, sf_dir), "pickup_ts")


@register
def hourly_counts(spark, sf_dir):
    return profile.hourly_counts(fx.trips(spark, sf_dir), "pickup_ts")


@register
def histogram_fare(spark, sf_dir):
    return profile.histogram(fx.clean(spark, sf_dir), "fare", 0.0, 100.0, 50)


@register
def histogram_duration(spark, sf_dir):
    return profile.histogram(fx.clean(spark, sf_dir), "trip_duration_min", 0.0, 120.0, 50)


@register
def null_report(spark, sf_dir):
    return profile.null_report(fx.trips(spark, sf_dir))


@register
def anomaly_report(spark, sf_dir):
    t = with_duration(fx.trips(spark, sf_dir), FIXTURE_TRIPS)
    return profile.anomaly_report(t, "trip_duration_min", "fare", "distance", "passengers")


# ---- labels and zone dimension ---------------------------------------------

def _zones(spark, sf_dir):
    r = spark.read.parquet
    return labels.zone_dimension(r(f"{sf_dir}/supplier.parquet"), r(f"{sf_dir}/nation.parquet"),
                                 r(f"{sf_dir}/region.parquet"))


@register
def period_labels(spark, sf_dir):
    from zonecast.functions.time import floor_to
    s = fx.span(spark, sf_dir)
    hours = fx.trips(spark, sf_dir).select(floor_to("pickup_ts").alias("pickup_datetime")).distinct()
    # the last day of the data counts as the future, the first as not yet covered
    second = tf.add_days(tf.ntz(s.start), 1)
    return labels.with_period(hours, second, s.cut, tf.add_days(tf.ntz(s.forecast_start), 1))


def _targets(spark, sf_dir, panel):
    return fcst.forecast_targets(panel, fx.span(spark, sf_dir).forecast_start, 24)


@register
def historical_flag(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return labels.with_is_historical(_targets(spark, sf_dir, p), p)


@register
def zone_labels(spark, sf_dir):
    return labels.zone_labels(_zones(spark, sf_dir))


@register
def zone_names(spark, sf_dir):
    z = distinct_zones_df(spark, sf_dir)
    return labels.with_zone_name(z, _zones(spark, sf_dir)).select("PULocationID", "Zone")


@register
def zone_attributes(spark, sf_dir):
    return labels.with_zone_name(zonehour.zone_stats(_panel(spark, sf_dir)), _zones(spark, sf_dir), how="inner")


def distinct_zones_df(spark, sf_dir):
    return zonehour.distinct_zones(fx.clean(spark, sf_dir).withColumnRenamed("pu_zone", "PULocationID"))


@register
def distinct_zones(spark, sf_dir):
    return distinct_zones_df(spark, sf_dir)


def _future(spark, sf_dir, panel=None):
    p = panel if panel is not None else _panel(spark, sf_dir)
    hist = fcst.recent_history(p, fx.HISTORY_DAYS)
    ff = fcst.future_features(_targets(spark, sf_dir, p), hist, fx.calendar(spark, sf_dir))
    return fcst.naive_from_features(ff)


@register
def forecast_band(spark, sf_dir):
    return labels.with_band(_future(spark, sf_dir).select("PULocationID", "step", "ts", "prediction"))


@register
def error_severity(spark, sf_dir):
    p = fx.test_rows(spark, sf_dir).select("PULocationID", "pickup_datetime", "trip_count", "y_pred")
    return labels.with_severity(p)


# ---- metrics -----------------------------------------------------------------

@register
def residuals(spark, sf_dir):
    return fx.panel(spark, sf_dir).select("PULocationID", "pickup_datetime", "period", "trip_count",
                                          "y_pred", "error", "abs_error")


@register
def metrics_by_period(spark, sf_dir):
    return mt.metrics(fx.panel(spark, sf_dir))


@register
def metrics_by_zone(spark, sf_dir):
    return mt.metrics_by_zone(fx.panel(spark, sf_dir))


@register
def metrics_by_hour(spark, sf_dir):
    return mt.metrics_by_hour(fx.panel(spark, sf_dir))


@register
def metrics_degradation(spark, sf_dir):
    return mt.degradation(mt.metrics(fx.panel(spark, sf_dir)))


@register
def mape_variants(spark, sf_dir):
    return mt.mape_variants(fx.panel(spark, sf_dir))


@register
def metrics_pivot(spark, sf_dir):
    return mt.pivot_metric(mt.metrics_by_hour(fx.panel(spark, sf_dir)))


@register
def period_change_by_hour(spark, sf_dir):
    return mt.compare_periods(mt.metrics_by_hour(fx.panel(spark, sf_dir)))


# ---- diagnostics (test period) -------------------------------------------------

@register
def worst_zones(spark, sf_dir):
    z = mt.metrics_by_zone(fx.test_rows(spark, sf_dir))
    return dg.worst_zones(z, 10).select("zone", "mape", "mean_demand", "n_samples")


@register
def best_zones(spark, sf_dir):
    z = mt.metrics_by_zone(fx.test_rows(spark, sf_dir))
    return dg.worst_zones(z, 10, ascending=True).select("zone", "mape", "mean_demand", "n_samples")


@register
def worst_predictions(spark, sf_dir):
    return dg.worst_predictions(fx.test_rows(spark, sf_dir), 5)


@register
def sample_predictions(spark, sf_dir):
    t = fx.test_rows(spark, sf_dir).select("PULocationID", "pickup_datetime", "trip_count", "y_pred", "error")
    return dg.sample_n(t, 5000, ["PULocationID", "pickup_datetime"], seed=42)


@register
def error_distribution(spark, sf_dir):
    return dg.error_distribution(fx.test_rows(spark, sf_dir))


@register
def error_percentiles(spark, sf_dir):
    return dg.error_percentiles(fx.test_rows(spark, sf_dir))


@register
def calibration(spark, sf_dir):
    return dg.calibration(fx.test_rows(spark, sf_dir))


@register
def metrics_by_decile(spark, sf_dir):
    """E11 over trip fares: the prediction is the mean fare of the hour of
    day, so that the deciles have ten bins."""
    t = fx.clean(spark, sf_dir).select(F.hour("pickup_ts").alias("hour"), "fare")
    mean = t.groupBy("hour").agg(F.avg("fare").alias("y_pred"))
    return dg.metrics_by_decile(t.join(mean, "hour"), "fare")


@register
def weekly_mae(spark, sf_dir):
    return dg.weekly_mae(fx.test_rows(spark, sf_dir))


@register
def weekend_mae(spark, sf_dir):
    return dg.weekend_mae(fx.test_rows(spark, sf_dir))


@register
def negative_predictions(spark, sf_dir):
    """E14 on a local linear trend: the least-squares line through the three
    previous hours, drawn on to the hour; it does fall below 0."""
    f = fx.features(spark, sf_dir).where(F.col("pickup_datetime") >= tf.ntz(fx.span(spark, sf_dir).cut))
    trend = (4 * F.col("lag_1h") + F.col("lag_2h") - 2 * F.col("lag_3h")) / 3
    return dg.negative_predictions(f.select("PULocationID", "pickup_datetime", trend.alias("y_pred")))


@register
def residual_autocorr(spark, sf_dir):
    return dg.residual_autocorr(fx.test_rows(spark, sf_dir))


@register
def global_autocorr(spark, sf_dir):
    """W3 over the zones laid end to end."""
    return dg.global_autocorr(fx.test_rows(spark, sf_dir))


@register
def residual_shapiro(spark, sf_dir):
    """E16 on the seeded sample of O5."""
    return dg.shapiro_wilk(fx.test_rows(spark, sf_dir), ["PULocationID", "pickup_datetime"])


@register
def residual_normality(spark, sf_dir):
    # JB grows with n; 3 decimals keep the comparison inside double precision.
    return dg.residual_normality(fx.test_rows(spark, sf_dir)).withColumn("jb", F.round("jb", 3))


@register
def prediction_stability(spark, sf_dir):
    """The test rows scored by a fitted model and by the same model
    saved and loaded again."""
    tr, te = _split_assembled(spark, sf_dir)
    model, path = md.fit_linear(tr), scratch_path(spark, "model")
    sinks.save_model(model, path)
    return dg.prediction_stability(md.score(model, te), md.score(sinks.load_model(path), te),
                                   ["PULocationID", "pickup_datetime"])


# ---- forecast views ----------------------------------------------------------

@register
def recent_history(spark, sf_dir):
    return fcst.recent_history(_panel(spark, sf_dir), fx.HISTORY_DAYS)


@register
def max_timestamp(spark, sf_dir):
    return fcst.with_max_ts(_panel(spark, sf_dir)).select("PULocationID", "pickup_datetime", "max_ts")


@register
def lag_lookup(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return fcst.lookup_lags(_targets(spark, sf_dir, p), fcst.recent_history(p, fx.HISTORY_DAYS))


@register
def future_features(spark, sf_dir):
    return _future(spark, sf_dir)


@register
def compare_forecast(spark, sf_dir):
    p = _panel(spark, sf_dir)
    fc = _future(spark, sf_dir, p).select("PULocationID", "step", "ts", "prediction")
    return fcst.compare_forecast(fc, p)


@register
def forecast_summary(spark, sf_dir):
    return fcst.forecast_summary(_future(spark, sf_dir))


@register
def history_and_forecast(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return fcst.history_and_forecast(p, _future(spark, sf_dir, p), fx.span(spark, sf_dir).forecast_start)


@register
def recent_daily(spark, sf_dir):
    return fcst.recent_daily(_panel(spark, sf_dir), fx.span(spark, sf_dir).forecast_start, 7)


@register
def daily_totals(spark, sf_dir):
    return zonehour.daily_totals(_panel(spark, sf_dir))


@register
def daily_forecast_error(spark, sf_dir):
    return fcst.daily_forecast_error(fx.test_rows(spark, sf_dir))


@register
def hourly_profile(spark, sf_dir):
    return fcst.hourly_profile(fx.test_rows(spark, sf_dir))


@register
def first_per_hour(spark, sf_dir):
    zh = fx.zone_hour(spark, sf_dir)
    return fcst.first_per_hour(zh, ["PULocationID"], order=["dataset"])


@register
def actual_lookup(spark, sf_dir):
    p = _panel(spark, sf_dir)
    keys = _targets(spark, sf_dir, p).select("PULocationID", F.col("ts").alias("pickup_datetime"))
    return fcst.lookup_actual(p, keys)


@register
def zone_report(spark, sf_dir):
    """Error figures of the busiest zones with their names."""
    zh = fx.stage(spark, sf_dir)
    t = fcst.filter_zones(fx.test_rows(spark, sf_dir, zh), fx.busiest_zones(zh))
    return labels.with_zone_name(mt.zone_report(t), _zones(spark, sf_dir)).select("PULocationID", "Zone", "mae", "rmse",
                                                                                "mean_actual")


@register
def series_slice(spark, sf_dir):
    zh, s = fx.stage(spark, sf_dir), fx.span(spark, sf_dir)
    return fcst.series_slice(fx.panel(spark, sf_dir, zh), fx.busiest_zones(zh), s.cut, s.end) \
        .select("PULocationID", "pickup_datetime", "trip_count", "y_pred")


# ---- months, ordering, scalar functions ---------------------------------------


@register
def month_selection(spark, sf_dir):
    """S2, both forms: the months of the data's years as a table, marked
    where the argument form selects them too."""
    s = fx.span(spark, sf_dir)
    picked = src.select_months(range(s.first_year, s.last_year + 1), [1, 2, 3], [s.end[:7]])
    return src.month_table(fx.trips(spark, sf_dir), "pickup_ts").withColumn("selected", F.col("year_month").isin(picked))


@register
def head_rows(spark, sf_dir):
    return dg.head_rows(_panel(spark, sf_dir), 10, ["PULocationID", "pickup_datetime"])


@register
def range_and_split(spark, sf_dir):
    """F4 + F5: the zone-hour table from its second day on, cut at the split date."""
    s = fx.span(spark, sf_dir)
    zh = grid.filter_range(fx.zone_hour(spark, sf_dir), tf.add_days(tf.ntz(s.start), 1), s.end)
    tr, te = grid.split_by_time(zh, s.cut)
    both = tr.withColumn("part", F.lit("train")).unionByName(te.withColumn("part", F.lit("test")))
    return both.groupBy("part").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("trip_count").alias("trips"),
                                    F.min("pickup_datetime").alias("first_ts"),
                                    F.max("pickup_datetime").alias("last_ts"))


@register
def scalar_calendar(spark, sf_dir):
    """X1-X12 over every trip."""
    t = fx.trips(spark, sf_dir)
    ts = F.col("pickup_ts")
    fname = F.format_string("yellow_tripdata_%s.parquet", tf.year_month(ts))
    return t.select(
        "trip_id", tf.floor_to(ts).alias("hour_start"), F.hour(ts).alias("hour"),
        F.dayofmonth(ts).alias("day"), F.month(ts).alias("month"), tf.weekday0(ts).alias("weekday"),
        tf.is_weekend(ts).alias("is_weekend"), tf.hour_of_week(ts).alias("hour_of_week"),
        F.to_date(ts).alias("date"), tf.day_name(ts).alias("day_name"), tf.iso_week(ts).alias("iso_week"),
        tf.add_days(ts, 1).alias("next_day"), tf.add_hours(ts, -3).alias("minus_3h"),
        tf.seconds_between("pickup_ts", "dropoff_ts").alias("seconds"),
        round_half_even(F.col("fare") / 3.0, 2).alias("fare_third_r2"),
        F.abs(F.col("fare")).alias("abs_fare"), F.sqrt(F.abs(F.col("fare"))).alias("sqrt_abs_fare"),
        tf.year_month(ts).alias("year_month"), tf.month_from_path(fname).alias("month_from_file"))


# ---- models ---------------------------------------------------------------------
# Fits take all 17 features; the SQL solves least squares and ridge by its own
# elimination. The *_single_feature queries check closed forms on one feature.

ONE = ["lag_1h"]


def _split_assembled(spark, sf_dir, features=FEATURES):
    f = materialize(fx.features(spark, sf_dir), "panel")
    tr, te = grid.split_by_time(f, fx.span(spark, sf_dir).cut)
    return md.assemble(tr, features), md.assemble(te, features)


@register
def model_matrix(spark, sf_dir):
    """The 17 features as they are assembled, missing ones 0."""
    from pyspark.ml.functions import vector_to_array
    a = md.assemble(fx.features(spark, sf_dir)).withColumn("x", vector_to_array("features"))
    return a.select("PULocationID", "pickup_datetime", "trip_count",
                    *[F.col("x")[i].alias(f"x_{c}") for i, c in enumerate(FEATURES)])


@register
def ols_single_feature(spark, sf_dir):
    """M2 with one feature: slope and intercept of trip_count on lag_1h."""
    a = _split_assembled(spark, sf_dir, ONE)[0]
    m = md.fit_linear(a)
    return a.agg(F.lit(float(m.coefficients[0])).alias("slope"), F.lit(float(m.intercept)).alias("intercept"),
                 F.count(F.lit(1)).alias("n_rows"))


@register
def linear_scores(spark, sf_dir):
    """Test rows scored by the plain and by the scaled fit."""
    tr, te = _split_assembled(spark, sf_dir)
    fits = fit_all(tr, FEATURES, TARGET)
    both = fits.least_squares(scaled=True).model.transform(te, "y_scaled")
    return _shown(md.score(fits.least_squares().model, both)).select("PULocationID", "pickup_datetime", "trip_count", "y_pred", "y_scaled")


def _shown(df, cols=("y_pred", "y_scaled", "prediction", "error", "abs_error")):
    """Predictions of a fit row by row, to 4 places: two ways to solve the
    same system differ in the last digits."""
    return df.withColumns({c: F.round(c, 4) for c in cols if c in df.columns})


_trees: dict[tuple, object] = {}


def _gbt(spark, sf_dir, train):
    """The boosted trees of a folder, fitted once for as long as its files
    stay the same: three queries report on the same model."""
    key = fx.version(spark, sf_dir)
    if key not in _trees:
        _trees[key] = md.fit_gbt(train)
    return _trees[key]


@register
def gbt_scores(spark, sf_dir):
    tr, te = _split_assembled(spark, sf_dir)
    return md.score(_gbt(spark, sf_dir, tr), te).select("PULocationID", "pickup_datetime", "trip_count", "y_pred")


@register
def gbt_stump(spark, sf_dir):
    """M3 with one tree of one split on all rows and features, every value a
    bin of its own: the split has a closed form."""
    tr, te = _split_assembled(spark, sf_dir)
    stump = md.fit_gbt(tr, trees=1, depth=1, rows=1.0, cols=1.0, bins=65536)
    return md.score(stump, te).select("PULocationID", "pickup_datetime", "trip_count", "y_pred")


@register
def feature_importance(spark, sf_dir):
    tr, _ = _split_assembled(spark, sf_dir)
    return md.feature_importance(spark, _gbt(spark, sf_dir, tr))


@register
def fit_optimality(spark, sf_dir):
    """M2, M4-M7: how far each of the 15 fits on the 17 features is from its
    optimality condition, feature by feature, on the training rows."""
    t = md.Tuning(*_split_assembled(spark, sf_dir))
    t.add_least_squares()
    t.add_grid()
    return t.optimality()


@register
def lasso_single_feature(spark, sf_dir):
    """M6 with one feature, which has a closed form."""
    return md.leaderboard(spark, md.tune_lasso(*_split_assembled(spark, sf_dir, ONE)))


@register
def elastic_net_single_feature(spark, sf_dir):
    """M7 with one feature, which has a closed form."""
    return md.leaderboard(spark, md.tune_elastic_net(*_split_assembled(spark, sf_dir, ONE)))


@register
def single_feature_leaderboard(spark, sf_dir):
    """M8 with one feature: base OLS, scaled OLS and the best of each family."""
    return md.leaderboard(spark, md.tune_all(*_split_assembled(spark, sf_dir, ONE)))


@register
def ridge_tuning(spark, sf_dir):
    return md.leaderboard(spark, md.tune_ridge(*_split_assembled(spark, sf_dir)))


@register
def lasso_tuning(spark, sf_dir):
    return md.leaderboard(spark, md.tune_lasso(*_split_assembled(spark, sf_dir)))


@register
def elastic_net_tuning(spark, sf_dir):
    return md.leaderboard(spark, md.tune_elastic_net(*_split_assembled(spark, sf_dir)))


@register
def model_leaderboard(spark, sf_dir):
    """M4-M8: base OLS, scaled OLS and the best of each penalised family."""
    return md.leaderboard(spark, md.tune_all(*_split_assembled(spark, sf_dir)))


@register
def clamped_predictions(spark, sf_dir):
    """M2 + M11 + F13: OLS fitted on the training rows, scored on the test
    rows, floored at 0."""
    tr, te = _split_assembled(spark, sf_dir)
    return _shown(md.score(md.fit_linear(tr), te, clamp=True)).select("PULocationID", "pickup_datetime", "trip_count", "y_pred")


def _forecast(spark, sf_dir, zh=None, p=None):
    """P2-P4 with the final model."""
    zh = zh if zh is not None else fx.stage(spark, sf_dir)
    p = p if p is not None else _panel(spark, sf_dir, zh)
    model = md.fit_final(fx.features(spark, sf_dir, zh=zh))
    out = pipelines.predict_demand(model, _targets(spark, sf_dir, p), fcst.recent_history(p, fx.HISTORY_DAYS),
                                   fx.calendar(spark, sf_dir))
    return _shown(out).select("PULocationID", "step", "ts", "prediction", "has_history")


@register
def forecast_24h(spark, sf_dir):
    """24 hourly forecasts for every zone from the forecast start."""
    return _forecast(spark, sf_dir)


@register
def forecast_vs_actual(spark, sf_dir):
    """P5: the forecast joined to the actuals by clock time."""
    zh = fx.stage(spark, sf_dir)
    p = _panel(spark, sf_dir, zh)
    return fcst.compare_forecast(_forecast(spark, sf_dir, zh, p), p)


@register
def model_history_and_forecast(spark, sf_dir):
    """P6 with the fitted model's forecast."""
    zh = fx.stage(spark, sf_dir)
    p = _panel(spark, sf_dir, zh)
    return fcst.history_and_forecast(p, _forecast(spark, sf_dir, zh, p), fx.span(spark, sf_dir).forecast_start)


def _fitted(spark, sf_dir):
    """The final model, saved with the recent history, loaded
    again; the panel scored by it."""
    panel = materialize(fx.features(spark, sf_dir), "panel")
    path, history = scratch_path(spark, "model"), scratch_path(spark, "history")
    pipelines.save_final(panel, path, history, fx.HISTORY_DAYS)
    return pipelines.predictions(panel, sinks.load_model(path), fx.span(spark, sf_dir).cut), history


@register
def final_model_scores(spark, sf_dir):
    """M10 + K3 + E8: residuals of the saved and reloaded final model."""
    return _shown(_fitted(spark, sf_dir)[0].select("PULocationID", "pickup_datetime", "period", "trip_count", "y_pred",
                                                   "error", "abs_error"))


@register
def final_model_history(spark, sf_dir):
    """P1 as the final fit writes it beside the model."""
    return src.read_table(spark, _fitted(spark, sf_dir)[1]).select("PULocationID", "pickup_datetime", "trip_count")


@register
def fitted_metrics(spark, sf_dir):
    """E4 on the fitted model: figures per period."""
    return pipelines.evaluate(_fitted(spark, sf_dir)[0])["global"]


@register
def fitted_metrics_by_zone(spark, sf_dir):
    """E5 on the fitted model."""
    return pipelines.evaluate(_fitted(spark, sf_dir)[0])["by_zone"]


@register
def fitted_weekly_mae(spark, sf_dir):
    """E12 as one of the detailed tests of the fitted model."""
    return dg.weekly_mae(_fitted(spark, sf_dir)[0].where(F.col("period") == "test"))


@register
def fitted_calibration(spark, sf_dir):
    """E10 as one of the detailed tests of the fitted model."""
    return dg.calibration(_fitted(spark, sf_dir)[0].where(F.col("period") == "test"))


# ---- sources and sinks by round trip in the shared checkpoint folder -----------

@register
def source_roundtrip(spark, sf_dir):
    """K1 then S1/S3/S5 on the partitioned layout: one write partitioned by
    dataset and month, scanned back with partition pruning. The requested
    months are those of the data; for yellow also the one before, which is
    absent."""
    base, s = scratch_path(spark, "trips"), fx.span(spark, sf_dir)
    first, last = (12 * int(t[:4]) + int(t[5:7]) - 1 for t in (s.start, s.end))
    months = [f"{m // 12:04d}-{m % 12 + 1:02d}" for m in range(first - 1, last + 1)]
    sinks.write_table(fx.trips(spark, sf_dir), base, partition_by=["dataset", "year_month"])
    y = src.scan_partitioned(spark, base, "yellow", months).select("pickup_ts", "pu_zone", "fare",
                                                                                   "dataset", "year_month")
    h = src.scan_partitioned(spark, base, "fhvhv", months[1:]).select("pickup_ts", "pu_zone", "dataset",
                                                                        "year_month")
    return y.unionByName(h, allowMissingColumns=True)


@register
def bucketed_lags(spark, sf_dir):
    """The panel as a bucketed table, its lags taken from there
    without an exchange."""
    path = scratch_path(spark, "bucketed")
    table = sinks.write_bucketed(_panel(spark, sf_dir), "panel_" + path[-12:], path, ["PULocationID"],
                                 ["PULocationID", "pickup_datetime"], buckets=8)
    return with_lags(table).select("PULocationID", "pickup_datetime", "trip_count", *[f"lag_{k}h" for k in LAGS])


@register
def pruned_lookup(spark, sf_dir):
    """F8 on a table written for point lookups: the busiest zones' values of
    the last day, their list pushed into the scan."""
    path, zh = scratch_path(spark, "lookup"), fx.stage(spark, sf_dir)
    sinks.write_lookup_table(_panel(spark, sf_dir, zh), path, "PULocationID")
    panel = src.read_table(spark, path)
    keys = fcst.forecast_targets(fx.busiest_zones(zh), fx.span(spark, sf_dir).forecast_start).withColumnRenamed("ts", "pickup_datetime")
    return fcst.lookup_actual(panel, keys, pushed=fcst.PUSHED_ZONES)


@register
def merged_profiles(spark, sf_dir):
    """Profiles by day, written once and merged; the sketched median
    is left to a test."""
    path = scratch_path(spark, "profiles")
    by_day = fx.stage(spark, sf_dir).withColumn("day", F.date_format("pickup_datetime", "yyyy-MM-dd"))
    sinks.write_table(profile.monthly_profiles(by_day, month="day"), path)
    return profile.merged_profile(src.read_table(spark, path), month="day").drop("median_trips")


@register
def report_roundtrip(spark, sf_dir):
    """K2: a metrics report written as CSV and read back."""
    path = scratch_path(spark, "report")
    rep = mt.metrics_by_zone(fx.panel(spark, sf_dir))
    sinks.write_report(rep, path)
    return spark.read.csv(path, header=True, schema=rep.schema)


@register
def model_roundtrip(spark, sf_dir):
    """K3: a fitted model saved, loaded and used for scoring."""
    tr, te = _split_assembled(spark, sf_dir)
    path = scratch_path(spark, "model")
    sinks.save_model(md.fit_linear(tr), path)
    return _shown(md.score(sinks.load_model(path), te)).select("PULocationID", "pickup_datetime", "y_pred")


@register
def monthly_scan(spark, sf_dir):
    """One file per dataset and month, the passenger count stored
    as bigint in one month and as double in the other; a month that is not
    there is asked for too, and one file is not parquet."""
    base, t = scratch_path(spark, "months"), fx.trips(spark, sf_dir)
    # the fixture covers one month: every other day stands for a second one
    odd = F.dayofmonth("pickup_ts") % 2 == 1
    for ds in ("yellow", "fhvhv"):
        own = t.where(F.col("dataset") == ds).drop("dataset", "year_month")
        sinks.write_table(own.where(odd), f"{base}/{ds}_tripdata_2024-01.parquet")
        sinks.write_table(own.where(~odd).withColumn("passengers", F.col("passengers").cast("bigint")),
                          f"{base}/{ds}_tripdata_2024-02.parquet")
    spark.range(1).select(F.lit("no parquet").alias("value")).write.text(f"{base}/fhvhv_tripdata_2024-04.parquet")
    months, unreadable = ["2024-01", "2024-02", "2024-03", "2024-04"], []
    y = src.scan_trips(spark, base, "yellow", months[:3])
    h = src.scan_trips(spark, base, "fhvhv", months, unreadable=unreadable)
    n = len(unreadable)
    return y.unionByName(h).select("trip_id", "pu_zone", "pickup_ts", "fare", "passengers", "year_month",
                                   "source_dataset", F.lit(n).alias("n_unreadable"))


@register
def zone_csv(spark, sf_dir):
    """The zone dimension written as CSV and read with its declared schema."""
    path = scratch_path(spark, "zones")
    sinks.write_csv(_zones(spark, sf_dir), path)
    return src.read_zones(spark, path)


@register
def preferred_source(spark, sf_dir):
    """Of a combined table that is not there and a yellow one that is,
    the first that exists."""
    path = scratch_path(spark, "yellow")
    sinks.write_table(zonehour.totals_zone_hour(_normalized(spark, sf_dir).where("dataset = 'yellow'")), path)
    return src.read_first_existing(spark, [f"{path}-combined", path])


@register
def feature_nulls(spark, sf_dir):
    """A15 on the feature panel: the columns with missing values only."""
    return profile.null_report(fx.features(spark, sf_dir), FEATURES, only_missing=True)


@register
def parsed_timestamps(spark, sf_dir):
    """pickup times kept as text, parsed back to naive timestamps."""
    text = F.date_format("pickup_ts", "yyyy-MM-dd'T'HH:mm:ss")
    return fx.trips(spark, sf_dir).select("trip_id", tf.to_naive(text).alias("pickup_ts"))


@register
def streaming_combined_demand(spark, sf_dir):
    """A3 through the streaming ingest: fixture trips written as monthly
    files per dataset, streamed with availableNow, totals re-summed."""
    from zonecast.streaming.ingest import ingest_trip_files, read_ingested
    base = scratch_path(spark, "stream")
    t = fx.trips(spark, sf_dir)
    for ds in ("yellow", "fhvhv"):
        sinks.write_table(t.where(F.col("dataset") == ds), f"{base}/in/{ds}")
        q = ingest_trip_files(spark, f"{base}/in/{ds}", ds, t.schema, f"{base}/out",
                              f"{base}/ckpt/{ds}", FIXTURE_TRIPS)
        q.awaitTermination()
    return read_ingested(spark, f"{base}/out")


@register
def panel_write_order(spark, sf_dir):
    """O1 + K1: the panel written clustered by zone and sorted by time, read back."""
    path = scratch_path(spark, "panel")
    sinks.write_table(_panel(spark, sf_dir), path, cluster_by=["PULocationID"],
                      sort_by=["PULocationID", "pickup_datetime"])
    return src.read_table(spark, path)


@register
def model_comparison(spark, sf_dir):
    """M8: OLS against boosted trees on the test period, with the relative
    improvement of the trees."""
    tr, te = _split_assembled(spark, sf_dir)
    lin = md.evaluate(md.fit_linear(tr), te)
    gbt = md.evaluate(_gbt(spark, sf_dir, tr), te)
    imp = md.improvement(lin, gbt)
    rows = [("linear", lin["mae"], lin["rmse"], lin["r2"], None, None, None),
            ("gbt", gbt["mae"], gbt["rmse"], gbt["r2"], imp["mae_pct"], imp["rmse_pct"], imp["r2_pct"])]
    return spark.createDataFrame(rows, "model string, mae double, rmse double, r2 double, "
                                       "mae_improvement_pct double, rmse_improvement_pct double, "
                                       "r2_improvement_pct double")


@register
def combined_features(spark, sf_dir):
    """Combined path end to end: S6/S7 -> A2 -> A3 -> F4 -> A5 (mean of the
    total columns, T9) -> J2/J3 -> C2 -> J6 -> W1/W2."""
    from zonecast.operators.features import build_features
    comb, s = zonehour.totals_zone_hour(_normalized(spark, sf_dir)), fx.span(spark, sf_dir)
    return build_features(comb, s.start, s.end, fx.calendar(spark, sf_dir))
