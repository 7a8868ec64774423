"""Forecast-error aggregate expressions (E1-E4). All are algebraic
aggregates, so grouped metrics run as partial + final hash aggregates."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.functions.time import col_


def mae(y, p) -> Column:
    return F.avg(F.abs(col_(y) - col_(p)))


def rmse(y, p) -> Column:
    return F.sqrt(F.avg(F.pow(col_(y) - col_(p), 2)))


def mape_nonzero(y, p) -> Column:
    """100 * mean |(y - p) / y| over rows with y != 0; no such row -> 0.0."""
    y, p = col_(y), col_(p)
    return F.coalesce(100.0 * F.avg(F.when(y != 0, F.abs((y - p) / y))), F.lit(0.0))


def mape_plus1(y, p) -> Column:
    """100 * mean |y - p| / (y + 1)."""
    y, p = col_(y), col_(p)
    return 100.0 * F.avg(F.abs(y - p) / (y + 1))


def pct_error_eps(y, p, eps: float = 0.001) -> Column:
    """Row-level percent error with ``eps`` in the denominator."""
    y, p = col_(y), col_(p)
    return F.abs(y - p) / (y + eps) * 100.0


def r2(y, p) -> Column:
    """Coefficient of determination; constant actuals give 1.0 for an exact
    fit and 0.0 otherwise, as scikit-learn does (E4)."""
    y, p = col_(y).cast("double"), col_(p).cast("double")
    ss_res = F.sum(F.pow(y - p, 2))
    ss_tot = F.count(y) * F.var_pop(y)
    return (F.when(ss_tot > 0, 1.0 - ss_res / ss_tot)
             .when(ss_res == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
