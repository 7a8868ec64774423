"""End-to-end plans: the reference's batch stages as Spark jobs.

``yellow_zone_hour`` / ``combined_zone_hour`` read monthly trip files and
build the zone-hour table; ``feature_table`` builds the panel;
``compare_models``, ``evaluate`` and ``detailed_tests`` fit and measure;
``save_final`` writes the final model and the recent history. Each returns
DataFrames or small summaries; tables are written only by ``write_*`` and
``save_final``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from zonecast.operators import diagnostics as dg
from zonecast.operators import metrics as mt
from zonecast.operators import models as md
from zonecast.operators.cleaning import clean_trips
from zonecast.operators.features import build_features
from zonecast.operators.forecast import recent_history
from zonecast.operators.grid import split_by_time, with_split_period
from zonecast.operators.zonehour import aggregate_zone_hour, combine_sources, normalize_trips, totals_zone_hour
from zonecast.schema import FEATURES, TripCols
from zonecast.session import materialize
from zonecast.sources.sinks import save_model, write_table
from zonecast.sources.trips import scan_trips

YELLOW = TripCols()
FHVHV = TripCols(pickup="pickup_datetime")


def yellow_zone_hour(spark: SparkSession, raw_dir: str, months: Sequence[str] | None = None,
                     per_month: bool = True) -> DataFrame:
    """Yellow path: scan, clean (F2), zone-hour demand (A1). With
    ``per_month`` the aggregate is keyed by file month as well, as the
    reference aggregates each file; the feature step consolidates (T10)."""
    trips = clean_trips(scan_trips(spark, raw_dir, "yellow", months), YELLOW)
    zh = aggregate_zone_hour(trips, YELLOW, by=["year_month"] if per_month else [])
    return zh.drop("year_month")


def combined_zone_hour(spark: SparkSession, raw_dir: str, months: Sequence[str] | None = None,
                       unreadable: list[str] | None = None) -> DataFrame:
    """Combined path: yellow + FHVHV, no cleaning (T23), per-source totals
    (A2) united and re-summed (A3). A source without a month is left out, and
    unreadable files are skipped and logged; their paths are added to
    ``unreadable`` if a list is given (S3, S4)."""
    frames = []
    skipped = unreadable if unreadable is not None else []
    for ds, cols in (("yellow", YELLOW), ("fhvhv", FHVHV)):
        try:
            t = scan_trips(spark, raw_dir, ds, months, unreadable=skipped)
        except FileNotFoundError:
            continue
        frames.append(totals_zone_hour(normalize_trips(t, ds, cols)))
    if not frames:
        raise FileNotFoundError(f"no yellow or fhvhv month under {raw_dir}")
    return combine_sources(frames)


def feature_table(zone_hour: DataFrame, start, end, **kw) -> DataFrame:
    """The 17-feature panel (see :func:`build_features`), materialised:
    every later fit and report reads it."""
    return materialize(build_features(zone_hour, start, end, **kw))


def compare_models(panel: DataFrame, cut) -> tuple[DataFrame, dict]:
    """OLS vs boosted trees on a temporal split, their leaderboard, the
    relative improvement (M2, M3, M8)."""
    spark = panel.sparkSession
    tr, te = (md.assemble(x) for x in split_by_time(panel, cut))
    lin = {"model": "linear", "alpha": None, "l1_ratio": None, **md.evaluate(md.fit_linear(tr), te)}
    gbt = {"model": "gbt", "alpha": None, "l1_ratio": None, **md.evaluate(md.fit_gbt(tr), te)}
    return md.leaderboard(spark, [lin, gbt]), md.improvement(lin, gbt)


def tune_linear(panel: DataFrame, cut) -> DataFrame:
    """Base and scaled OLS and the best ridge, lasso and elastic net, ranked
    by MAE (M4-M8). ``panel`` is read several times: give a written table."""
    spark = panel.sparkSession
    tr, te = (md.assemble(x) for x in split_by_time(panel, cut))
    return md.leaderboard(spark, md.tune_all(tr, te))


def predictions(panel: DataFrame, model: PipelineModel, cut, features: Sequence[str] = FEATURES) -> DataFrame:
    """Scored panel with residuals and the train/test label, materialised
    once for the many reports read from it (M11, E8, F5)."""
    scored = md.score(model, md.assemble(panel, features)).drop("features")
    return materialize(with_split_period(mt.with_residuals(scored), cut))


def evaluate(pred: DataFrame) -> dict[str, DataFrame]:
    """Global, per-zone and per-hour metrics, degradation, top/bottom zones
    and the MAPE pivot (E4-E7, O2, A23, J9)."""
    by_zone = mt.metrics_by_zone(pred)
    by_hour = mt.metrics_by_hour(pred)
    test_zone = by_zone.where(F.col("period") == "test")
    glob = mt.metrics(pred)
    return {"global": glob, "by_zone": by_zone, "by_hour": by_hour, "degradation": mt.degradation(glob),
            "worst_zones": dg.worst_zones(test_zone, 10), "best_zones": dg.worst_zones(test_zone, 10, ascending=True),
            "mape_by_hour": mt.pivot_metric(by_hour), "hour_change": mt.compare_periods(by_hour)}


def detailed_tests(pred: DataFrame, rescored: DataFrame | None = None) -> dict[str, DataFrame]:
    """The reference's ten model checks on the test rows."""
    test = pred.where(F.col("period") == "test")
    out = {"error_distribution": dg.error_distribution(test), "calibration": dg.calibration(test),
           "error_percentiles": dg.error_percentiles(test), "by_decile": dg.metrics_by_decile(test),
           "weekly_mae": dg.weekly_mae(test), "weekend_mae": dg.weekend_mae(test),
           "normality": dg.residual_normality(test), "autocorr": dg.residual_autocorr(test),
           "worst": dg.worst_predictions(test), "negative": dg.negative_predictions(test)}
    if rescored is not None:
        out["stability"] = dg.prediction_stability(test, rescored.where(F.col("period") == "test"),
                                                   ["PULocationID", "pickup_datetime"])
    return out


def save_final(panel: DataFrame, model_path: str, history_path: str, days: int = 14,
               features: Sequence[str] = FEATURES) -> PipelineModel:
    """Fit on all rows (M10, in-sample for any later metric, T18), save the
    model (K3) and the recent history (P1, K1)."""
    model = md.fit_final(panel, features)
    save_model(model, model_path)
    write_table(recent_history(panel, days), history_path)
    return model


def predict_demand(model: PipelineModel, targets: DataFrame, history: DataFrame, calendar: DataFrame,
                   time: str = "ts", features: Sequence[str] = FEATURES) -> DataFrame:
    """Predictions for (zone, time) targets, clamped at 0 (P2 + M11 + F13 = P3)."""
    from zonecast.operators.forecast import future_features
    ff = future_features(targets, history, calendar, time=time)
    return md.score(model, md.assemble(ff, features), clamp=True).drop("features") \
        .withColumnRenamed("y_pred", "prediction")


def forecast(model: PipelineModel, zones: DataFrame, start, history: DataFrame, calendar: DataFrame,
             horizon: int = 24, features: Sequence[str] = FEATURES) -> DataFrame:
    """``horizon`` hourly predictions from ``start`` for every zone at once;
    each hour independent, ``step`` and clock time ``ts`` both kept (P4, T19)."""
    from zonecast.operators.forecast import forecast_targets
    return predict_demand(model, forecast_targets(zones, start, horizon), history, calendar, features=features)
