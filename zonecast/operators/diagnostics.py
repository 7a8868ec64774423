"""Residual diagnostics (E9-E17, W3) and ordered reports."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.normal import normal_quantile, normal_upper_tail, polynomial
from zonecast.functions.ordered import with_global_lags
from zonecast.functions.quantiles import exact_percentiles
from zonecast.functions.time import iso_week, iso_year, weekday0
from zonecast.session import materialize


# Royston's polynomials of the Shapiro-Wilk test, lowest power first.
OUTERMOST = [0.0, 0.221157, -0.147981, -2.07119, 4.434685, -2.706056]
SECOND = [0.0, 0.042981, -0.293762, -1.752461, 5.682633, -3.582633]
SMALL_SHIFT = [-2.273, 0.459]
SMALL_MEAN = [0.544, -0.39978, 0.025054, -0.0006714]
SMALL_SD = [1.3822, -0.77857, 0.062767, -0.0020322]
LARGE_MEAN = [-1.5861, -0.31082, -0.083751, 0.0038915]
LARGE_SD = [-0.4803, -0.082676, 0.0030302]


def _abs_err(y, p):
    return F.abs(F.col(y) - F.col(p))


def error_distribution(df: DataFrame, y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Absolute-error mean, median, std (ddof 0, trap T22), min, max, P25, P75."""
    ae = materialize(df.select(_abs_err(y, p).alias("ae")), "errors")  # read by each pass
    q25, med, q75 = exact_percentiles(ae, "ae", [0.25, 0.5, 0.75])
    return ae.agg(F.avg("ae").alias("mean"), F.stddev_pop("ae").alias("std"),
                  F.min("ae").alias("min"), F.max("ae").alias("max")) \
        .select("mean", F.lit(med).cast("double").alias("median"), "std", "min", "max",
                F.lit(q25).cast("double").alias("p25"), F.lit(q75).cast("double").alias("p75"))


def _percentiles(df: DataFrame, col: str, probs: Sequence[float], accuracy: int | None) -> list:
    """Exact by default; with ``accuracy`` one ``percentile_approx`` pass
    (relative rank error about 1/accuracy)."""
    if accuracy is None:
        return exact_percentiles(df, col, probs)
    r = df.agg(F.percentile_approx(col, list(probs), accuracy).alias("q")).first()["q"]
    return list(r) if r is not None else [None for _ in probs]


def error_percentiles(df: DataFrame, y: str = "trip_count", p: str = "y_pred",
                      pcts: Sequence[int] = (50, 75, 90, 95, 99), accuracy: int | None = None) -> DataFrame:
    """Absolute-error percentiles and the share of rows at or below each."""
    ae = materialize(df.select(_abs_err(y, p).alias("ae")), "errors")  # read by each pass
    th = _percentiles(ae, "ae", [q / 100 for q in pcts], accuracy)
    aggs = [(100.0 * F.count_if(F.col("ae") <= F.lit(t)) / F.count(F.lit(1))).alias(f"w{q}")
            for q, t in zip(pcts, th)]
    shares = ae.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(q).cast("int").alias("percentile"),
                              F.lit(t).cast("double").alias("abs_error"),
                              F.col(f"w{q}").alias("pct_within")) for q, t in zip(pcts, th)])
    return shares.select(F.inline(rows))


def calibration(df: DataFrame, y: str = "trip_count", p: str = "y_pred", tol: float = 0.05) -> DataFrame:
    """Mean actual, mean predicted, bias, bias % and the calibration verdict."""
    a = df.agg(F.avg(F.col(y).cast("double")).alias("mean_actual"), F.avg(p).alias("mean_pred"))
    bias = F.col("mean_actual") - F.col("mean_pred")
    return a.select("mean_actual", "mean_pred", bias.alias("bias"),
                    (100.0 * bias / F.col("mean_actual")).alias("bias_pct"),
                    (F.abs(bias) < F.col("mean_actual") * tol).alias("calibrated"))


def decile_edges(df: DataFrame, y: str = "trip_count", q: int = 10, accuracy: int | None = None) -> list[float]:
    """Quantile edges of ``y`` at 0, 1/q, .., 1 with duplicates dropped."""
    e = _percentiles(df, y, [i / q for i in range(q + 1)], accuracy)
    return sorted(set(v for v in e if v is not None))


def with_decile(df: DataFrame, edges: Sequence[float], y: str = "trip_count",
                col: str = "decile") -> DataFrame:
    """Bin index as ``pandas.qcut(labels=False, duplicates='drop')`` gives it:
    right-closed bins, lowest edge included (E11). ``ntile`` would split ties."""
    arr = F.array(*[F.lit(float(e)) for e in edges])
    k = F.size(F.filter(arr, lambda e: e < F.col(y)))
    return df.withColumn(col, F.greatest(k - 1, F.lit(0)))


def metrics_by_decile(df: DataFrame, y: str = "trip_count", p: str = "y_pred", q: int = 10,
                      accuracy: int | None = None) -> DataFrame:
    """Min, max, MAE and MAPE per demand decile."""
    df = materialize(df.select(y, p), "scored")  # read by each pass
    edges = decile_edges(df, y, q, accuracy)
    d = with_decile(df, edges, y)
    return d.groupBy("decile").agg(F.min(y).alias("min_demand"), F.max(y).alias("max_demand"),
                                   M.mae(y, p).alias("mae"), M.mape_nonzero(y, p).alias("mape"),
                                   F.count(F.lit(1)).alias("n_samples"))


def weekly_mae(df: DataFrame, time: str = "pickup_datetime", y: str = "trip_count",
               p: str = "y_pred") -> DataFrame:
    """MAE per ISO week with its row count (E12; the count shows T21)."""
    return df.groupBy(iso_year(time).alias("iso_year"), iso_week(time).alias("week")) \
        .agg(M.mae(y, p).alias("mae"), F.count(F.lit(1)).alias("n_rows"))


def weekend_mae(df: DataFrame, time: str = "pickup_datetime", y: str = "trip_count",
                p: str = "y_pred") -> DataFrame:
    """Weekday vs weekend MAE, rows, absolute difference and percent."""
    we = weekday0(time) >= 5
    ae = _abs_err(y, p)
    a = df.agg(F.avg(F.when(~we, ae)).alias("weekday_mae"), F.count_if(~we).alias("weekday_rows"),
               F.avg(F.when(we, ae)).alias("weekend_mae"), F.count_if(we).alias("weekend_rows"))
    diff = F.abs(F.col("weekend_mae") - F.col("weekday_mae"))
    return a.select("*", diff.alias("difference"), (100.0 * diff / F.col("weekday_mae")).alias("difference_pct"))


def negative_predictions(df: DataFrame, p: str = "y_pred") -> DataFrame:
    """Count and share of negative predictions, and the verdict."""
    a = df.agg(F.count_if(F.col(p) < 0).alias("n_negative"), F.count(F.lit(1)).alias("n_rows"))
    return a.select("n_negative", "n_rows", (100.0 * F.col("n_negative") / F.col("n_rows")).alias("pct_negative"),
                    (F.col("n_negative") == 0).alias("passed"))


def prediction_stability(a: DataFrame, b: DataFrame, keys: Sequence[str], p: str = "y_pred",
                         tol: float = 1e-10) -> DataFrame:
    """Max |difference| between two scorings of the same rows; pass below ``tol``."""
    j = a.select(*keys, F.col(p).alias("p1")).join(b.select(*keys, F.col(p).alias("p2")), list(keys))
    return j.agg(F.max(F.abs(F.col("p1") - F.col("p2"))).alias("max_abs_diff"),
                 F.count(F.lit(1)).alias("n_rows")) \
        .select("max_abs_diff", "n_rows", (F.coalesce("max_abs_diff", F.lit(0.0)) < tol).alias("stable"))


def residual_autocorr(df: DataFrame, lags: Sequence[int] = (1, 24), zone: str = "PULocationID",
                      time: str = "pickup_datetime", y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Pearson correlation of residuals with their value ``k`` hours earlier
    in the same zone, pooled over zones (W3). The reference lays all zones
    end to end, so its pairs cross zone borders (trap T11); a window without
    a partition would also run in a single task."""
    w = Window.partitionBy(zone).orderBy(time)
    e = F.col(y) - F.col(p)
    d = df.select(e.alias("e"), *[F.lag(e, k).over(w).alias(f"e{k}") for k in lags])
    a = d.agg(*[F.corr("e", f"e{k}").alias(f"r{k}") for k in lags])
    return a.select(F.inline(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"r{k}").alias("autocorr"))
                                        for k in lags])))


def global_autocorr(df: DataFrame, lags: Sequence[int] = (1, 24), zone: str = "PULocationID",
                    time: str = "pickup_datetime", y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """Pearson correlation of residuals with their value ``k`` rows earlier in
    the series of all zones laid end to end, zone by zone (W3 as the reference
    has it; pairs cross zone borders, trap T11)."""
    d = with_global_lags(df.select(zone, time, (F.col(y) - F.col(p)).alias("e")), [zone, time], ["e"], lags)
    a = d.agg(*[F.corr("e", f"e_lag{k}").alias(f"r{k}") for k in lags])
    return a.select(F.inline(F.array(*[F.struct(F.lit(k).alias("lag"), F.col(f"r{k}").alias("autocorr_global"))
                                        for k in lags])))


def shapiro_wilk(df: DataFrame, keys: Sequence[str], y: str = "trip_count", p: str = "y_pred", n: int = 5000,
                 seed: int = 42, alpha: float = 0.05) -> DataFrame:
    """Shapiro-Wilk test of the residuals of a seeded sample of up to ``n``
    rows (E16, O5): n, w, p_value and the verdict.

    Royston's approximation (AS R94, 3 to 5000 values): the weights of the
    ordered residuals come from normal scores, the two outermost at each end
    from polynomials in 1 / sqrt(n); W is turned into a normal deviate by
    polynomials in log(n) (or n, up to 11). The window over the sample is one
    task of at most 5000 rows. Fewer than 3 values, or equal ones, give NULL.
    """
    if n > 5000:
        raise ValueError("the approximation holds up to 5000 values")
    e = sample_n(df.select(*keys, (F.col(y) - F.col(p)).alias("e")).where(F.col("e").isNotNull()), n, keys, seed)
    every = Window.partitionBy(F.lit(1))
    d = e.select("e", F.row_number().over(every.orderBy("e", *keys)).alias("i"), F.count(F.lit(1)).over(every).alias("n"))
    d = d.withColumn("m", normal_quantile((F.col("i") - 0.375) / (F.col("n") + 0.25)))
    i, n_, m, e_ = (F.col(c) for c in ("i", "n", "m", "e"))
    of = lambda at, c: F.max(F.when(i == at, c))
    two = n_ > 5  # up to 5 values only the outermost weights are corrected
    inner = F.when(two, (i > 2) & (i < n_ - 1)).otherwise((i > 1) & (i < n_))
    one = d.agg(F.max("n").alias("n"), F.sum(m * m).alias("ss"), of(n_, m).alias("last"), of(n_ - 1, m).alias("before"),
                (of(n_, e_) - of(1, e_)).alias("range"), (of(n_ - 1, e_) - of(2, e_)).alias("inside"),
                F.sum(F.when(inner, m * e_)).alias("middle"), (F.var_pop("e") * F.count("e")).alias("spread"))
    last, before, ss, u = F.col("last"), F.col("before"), F.col("ss"), 1 / F.sqrt("n")
    one = one.withColumns({"a_last": F.when(n_ == 3, math.sqrt(0.5)).otherwise(last / F.sqrt(ss) + polynomial(OUTERMOST, u)),
                           "a_before": F.when(two, before / F.sqrt(ss) + polynomial(SECOND, u)).otherwise(0.0)})
    left = ss - 2 * last * last - F.when(two, 2 * before * before).otherwise(0.0)
    rest = 1 - 2 * F.pow("a_last", 2) - 2 * F.pow("a_before", 2)
    # three values have none between the outermost
    total = F.col("a_last") * F.col("range") + F.col("a_before") * F.col("inside") + F.when(n_ == 3, 0.0).otherwise(F.try_divide("middle", F.sqrt(F.try_divide(left, rest))))
    s = one.select("n", F.try_divide(total * total, F.col("spread")).alias("w"))
    ln, size = F.log(F.col("n").cast("double")), F.col("n").cast("double")
    left = F.log(1 - F.col("w"))  # of the value 1 NULL
    small = (-F.log(polynomial(SMALL_SHIFT, size) - left) - polynomial(SMALL_MEAN, size)) / F.exp(polynomial(SMALL_SD, size))
    large = (left - polynomial(LARGE_MEAN, ln)) / F.exp(polynomial(LARGE_SD, ln))
    three = F.greatest(6 / math.pi * (F.asin(F.sqrt("w")) - math.asin(math.sqrt(0.75))), F.lit(0.0))
    p_value = F.when(F.col("n") == 3, three).when(F.col("n") <= 11, normal_upper_tail(small)).otherwise(normal_upper_tail(large))
    return s.where("n >= 3 and w is not null").select("n", "w", p_value.alias("p_value")).withColumn("normal", F.col("p_value") > alpha)


def residual_normality(df: DataFrame, y: str = "trip_count", p: str = "y_pred",
                       alpha: float = 0.05) -> DataFrame:
    """Jarque-Bera test on all residuals.

    The reference runs Shapiro-Wilk on at most 5000 sampled residuals; the
    moment test answers the same question from one pass over all rows.
    Skewness and excess kurtosis are population moments; JB has 2 degrees
    of freedom, so p = exp(-JB / 2) exactly.
    """
    e = (F.col(y) - F.col(p)).alias("e")
    a = df.select(e).agg(F.count(F.lit(1)).alias("n"), F.skewness("e").alias("skewness"),
                         F.kurtosis("e").alias("kurtosis"))
    jb = F.col("n") / 6.0 * (F.pow("skewness", 2) + F.pow("kurtosis", 2) / 4.0)
    return a.select("n", "skewness", "kurtosis", jb.alias("jb"), F.exp(-jb / 2.0).alias("p_value")) \
        .withColumn("normal", F.col("p_value") > alpha)


def worst_zones(zone_metrics: DataFrame, n: int = 10, by: str = "mape", ascending: bool = False,
                zone: str = "zone") -> DataFrame:
    """Top (or bottom) ``n`` zones by a metric; the lower zone id wins ties (O2).
    Planned as ``TakeOrderedAndProject``: each task keeps ``n`` rows."""
    o = F.col(by).asc() if ascending else F.col(by).desc()
    return zone_metrics.orderBy(o, F.col(zone).asc()).limit(n)


def worst_predictions(df: DataFrame, n: int = 5, zone: str = "PULocationID",
                      time: str = "pickup_datetime", y: str = "trip_count", p: str = "y_pred") -> DataFrame:
    """The ``n`` largest absolute errors, ties by zone and time (O3)."""
    return (df.select(zone, time, y, p, _abs_err(y, p).alias("abs_error"))
              .orderBy(F.col("abs_error").desc(), zone, time).limit(n))


def head_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """First ``n`` rows in a stated order."""
    return df.orderBy(*order).limit(n)


def sample_n(df: DataFrame, n: int, keys: Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows without replacement, the same for the
    same seed (O5): the first ``n`` in the order of an MD5 of key and seed --
    one pass, ``n`` rows from each task."""
    h = F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys], F.lit(str(seed))))
    return df.withColumn("__h", h).orderBy("__h", *keys).limit(n).drop("__h")
