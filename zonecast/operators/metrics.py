"""Grouped forecast metrics.

The reference loops over zones and hours; here each table is one
``groupBy`` over the prediction table, grouped by period and the key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M


def with_residuals(df: DataFrame, y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """``error = y - p`` and ``abs_error``."""
    e = F.col(y) - F.col(p)
    return df.withColumn("error", e).withColumn("abs_error", F.abs(e))


def metrics(df: DataFrame, by: Sequence[str] = ("period",), y: str = "trip_count", p: str = "y_pred",
            with_r2: bool = True, with_mean_demand: bool = False) -> DataFrame:
    """MAE, RMSE, MAPE (zero actuals skipped), R^2 and row count per group.

    ``by=[period, zone]`` is the per-zone table (E5) and ``by=[period, hour]``
    the per-hour table (E6); both add ``mean_demand`` and drop R^2 there.
    """
    aggs = [M.mae(y, p).alias("mae"), M.rmse(y, p).alias("rmse"), M.mape_nonzero(y, p).alias("mape")]
    if with_r2:
        aggs.append(M.r2(y, p).alias("r2"))
    aggs.append(F.count(F.lit(1)).alias("n_samples"))
    if with_mean_demand:
        aggs.append(F.avg(F.col(y).cast("double")).alias("mean_demand"))
    return df.groupBy(*by).agg(*aggs)


def metrics_by_zone(df, zone: str = "PULocationID", period: str = "period", **kw) -> DataFrame:
    out = metrics(df, by=[period, zone], with_r2=False, with_mean_demand=True, **kw)
    return out.withColumnRenamed(zone, "zone")


def metrics_by_hour(df, hour: str = "hour", period: str = "period", **kw) -> DataFrame:
    return metrics(df, by=[period, hour], with_r2=False, with_mean_demand=True, **kw)


def degradation(period_metrics: DataFrame, base: str = "train", other: str = "test",
                period: str = "period") -> DataFrame:
    """Train -> test change: relative % for MAE and RMSE, points for MAPE."""
    def pick(m, per):
        return F.max(F.when(F.col(period) == per, F.col(m)))
    wide = period_metrics.agg(*[pick(m, per).alias(f"{m}_{per}")
                                for m in ("mae", "rmse", "mape", "r2") for per in (base, other)])
    return wide.select(
        "*",
        (100.0 * (F.col(f"mae_{other}") - F.col(f"mae_{base}")) / F.col(f"mae_{base}")).alias("mae_degradation_pct"),
        (100.0 * (F.col(f"rmse_{other}") - F.col(f"rmse_{base}")) / F.col(f"rmse_{base}")).alias("rmse_degradation_pct"),
        (F.col(f"mape_{other}") - F.col(f"mape_{base}")).alias("mape_change_pp"))


def pivot_metric(df: DataFrame, index: str = "hour", columns: str = "period", value: str = "mape",
                 levels: Sequence[str] = ("train", "test")) -> DataFrame:
    """Rows ``index``, one column per period level (A23). The level list is
    given, so the pivot needs no extra job to discover it."""
    return df.groupBy(index).pivot(columns, list(levels)).agg(F.first(value))


def compare_periods(df: DataFrame, key: str = "hour", value: str = "mape", base: str = "train",
                    other: str = "test", period: str = "period") -> DataFrame:
    """Train and test side by side per key, with the change.

    Keys present in both periods only, as the reference prints them.
    """
    a = df.where(F.col(period) == base).select(key, F.col(value).alias(f"{value}_{base}"))
    b = df.where(F.col(period) == other).select(key, F.col(value).alias(f"{value}_{other}"))
    return (a.join(b, key, "inner")
             .withColumn("change", F.col(f"{value}_{other}") - F.col(f"{value}_{base}")))


def mape_variants(df: DataFrame, by: Sequence[str] = ("period",), y: str = "trip_count",
                  p: str = "y_pred") -> DataFrame:
    """The three percent-error conventions side by side."""
    return df.groupBy(*by).agg(M.mape_nonzero(y, p).alias("mape_nonzero"),
                               M.mape_plus1(y, p).alias("mape_plus1"),
                               F.avg(M.pct_error_eps(y, p)).alias("mean_pct_error_eps"))


def zone_report(df: DataFrame, zone: str = "PULocationID", y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """MAE, RMSE and mean demand of each zone."""
    return df.groupBy(zone).agg(M.mae(y, p).alias("mae"), M.rmse(y, p).alias("rmse"),
                                F.avg(F.col(y).cast("double")).alias("mean_actual"))
