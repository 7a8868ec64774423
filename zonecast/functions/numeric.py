"""Numeric helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from zonecast.functions.time import col_


def round_half_even(c, places: int = 2) -> Column:
    """Round like pandas/numpy (trap T3): ``rint(x * 10^n) / 10^n``.

    Spark ``round`` is half-up; ``bround`` is half-even on the decimal string
    of the double, which differs from numpy on ties such as 1.015 (numpy
    1.01, ``bround`` 1.02). ``rint`` on the scaled double is numpy's rule.
    """
    scale = float(10 ** places)
    return F.rint(col_(c) * scale) / scale


def clamp_nonneg(c) -> Column:
    """``max(x, 0)``."""
    return F.greatest(col_(c), F.lit(0.0))


def clip(c, lo, hi) -> Column:
    """Clip to ``[lo, hi]`` (X11)."""
    return F.least(F.greatest(col_(c), F.lit(lo)), F.lit(hi))
