"""Exact percentiles (linear interpolation, numpy's default) in two passes,
without one task holding every distinct value.

Spark's exact ``percentile`` merges a value->count map of the whole column in
one final task. Here the work is split:

1. one aggregate builds a mergeable KLL sketch of each column (bounded state)
   and counts its rows; for each wanted rank the sketch gives a bracket of
   values, wide enough for its rank error;
2. the brackets cut the value range into segments. A second aggregate counts
   rows by segment, and inside brackets by value: a value held by a third of
   all rows becomes one row, everything outside a bracket one row per segment.

The counts before a bracket tell which of its values has the wanted rank; a
window over the bracket's distinct values finds it. A bracket of more than
``max_distinct`` values is first narrowed by ranges, on the table of distinct
values only. Should a rank fall outside its bracket (the error of the sketch
holds with 99 %, the margin is twice that), the brackets are widened and the
second pass runs again, so the result is exact in any case.

Like ``DataFrame.approxQuantile`` the function is eager and returns numbers.
The table is read by both passes: give a written table, not an expensive plan.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Most distinct values one task ranks; larger brackets are narrowed first.
MAX_DISTINCT = 1_000_000
SKETCH = 4096   # k of the KLL sketches


def exact_percentiles(df: DataFrame, col, probs: Sequence[float], buckets: int = 1000,
                      max_distinct: int = MAX_DISTINCT, sketch: int = SKETCH) -> list:
    """Exact linear-interpolated percentiles of ``col`` (NULL/NaN ignored).

    Returns one float per entry of ``probs`` (``None`` for an empty column).
    """
    return exact_percentiles_multi(df, [col], probs, buckets, max_distinct, sketch)[0]


def exact_percentiles_multi(df: DataFrame, cols: Sequence, probs: Sequence[float], buckets: int = 1000,
                            max_distinct: int = MAX_DISTINCT, sketch: int = SKETCH) -> list[list]:
    """:func:`exact_percentiles` of several columns with shared passes."""
    vals = []
    for i, c in enumerate(cols):
        x = (F.col(c) if isinstance(c, str) else c).cast("double")
        vals.append(F.when(~F.isnan(x), x).alias(f"c{i}"))
    return _exact(df.select(*vals), len(cols), [float(p) for p in probs], buckets, max_distinct, sketch)


def rank_error(k: int) -> float:
    """Normalised rank error of a KLL sketch of this k, with 99 % confidence."""
    return 2.296 / k ** 0.9021


def _brackets(base: DataFrame, k: int, probs: list[float], sketch: int, margin: float) -> list[tuple[int, list[tuple[float, float]]]]:
    """Per column its rows and, per probability, a bracket of values."""
    made = base.agg(*[F.count(f"c{i}").alias(f"n{i}") for i in range(k)],
                    *[F.kll_sketch_agg_double(F.col(f"c{i}"), F.lit(sketch)).alias(f"s{i}") for i in range(k)])

    def bounds(i: int, sign: int):
        ranks = F.array(*[F.lit(min(max(p + sign * margin, 0.0), 1.0)) for p in probs])
        return F.when(F.col(f"n{i}") > 0, F.kll_sketch_get_quantile_double(F.col(f"s{i}"), ranks))

    r = made.select(*[f"n{i}" for i in range(k)], *[bounds(i, s).alias(f"b{i}_{s}") for i in range(k) for s in (-1, 1)]).first()
    out = []
    for i in range(k):
        n, low, high = r[f"n{i}"], r[f"b{i}_-1"], r[f"b{i}_1"]
        # the two ranks beside p are within one row of it: few rows need no bracket
        few = n * margin < 2
        out.append((n, [(-math.inf if few or p - margin <= 0 else lo, math.inf if few or p + margin >= 1 else hi)
                        for p, lo, hi in zip(probs, low, high)] if n else []))
    return out


def _merged(brackets: list[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, overlapping ones made one."""
    out: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if out and lo <= out[-1][1]:
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def _exact(base: DataFrame, k: int, probs: list[float], buckets: int, max_distinct: int, sketch: int) -> list[list]:
    margin = 2 * rank_error(sketch)
    while True:
        found = _brackets(base, k, probs, sketch, margin)
        value = _ranked(base, found, probs, buckets, max_distinct)
        if value is not None:
            break
        margin *= 4
    out = []
    for i, (n, _) in enumerate(found):
        res = []
        for p in probs:
            if not n:
                res.append(None)
                continue
            pos = float(p) * (n - 1)
            lo = math.floor(pos)
            a, b = value[(i, lo)], value[(i, min(lo + 1, n - 1))]
            res.append(a + (b - a) * (pos - lo))
        out.append(res)
    return out


def _ranked(base: DataFrame, found: list, probs: list[float], buckets: int, max_distinct: int) -> dict | None:
    """The value of each wanted (column, rank); None if a bracket missed."""
    wanted, rows = {}, []
    for i, (n, raw) in enumerate(found):
        if not n:
            continue
        for p in probs:
            lo = math.floor(float(p) * (n - 1))
            wanted |= {(i, lo): None, (i, min(lo + 1, n - 1)): None}
        v = F.col(f"c{i}")
        # even segments lie between brackets, odd ones are brackets
        seg = F.lit(0)
        for lo, hi in _merged(raw):
            seg = seg + F.when(v >= F.lit(lo), 1).otherwise(0) + F.when(v > F.lit(hi), 1).otherwise(0)
        rows.append(F.struct(F.lit(i).alias("c"), F.when(v.isNotNull(), seg).alias("seg"), v.alias("v")))
    if not wanted:
        return {}
    long = base.select(F.inline(F.array(*rows))).where("seg is not null")
    held = long.groupBy("c", "seg", F.when(F.col("seg") % 2 == 1, F.col("v")).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    held = held.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        sizes: dict = {}
        for r in held.groupBy("c", "seg").agg(F.sum("n").alias("n"), F.count("v").alias("distinct")).collect():
            sizes.setdefault(r["c"], {})[r["seg"]] = (r["n"], r["distinct"])
        small, slots = F.lit(False), {}
        for i, rank in wanted:
            before, seg = 0, None
            for s in sorted(sizes[i]):
                if rank < before + sizes[i][s][0]:
                    seg = s
                    break
                before += sizes[i][s][0]
            if seg is None or seg % 2 == 0:
                return None
            slots[(i, rank)] = (seg, before)
        for i, seg in {(i, seg) for (i, _), (seg, _) in slots.items()}:
            if sizes[i][seg][1] <= max_distinct:
                small = small | ((F.col("c") == i) & (F.col("seg") == seg))
        w = Window.partitionBy("c", "seg").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
        placed = held.where(small).withColumn("end", F.sum("n").over(w))
        hit = F.lit(False)
        for (i, rank), (seg, before) in slots.items():
            at = rank - before
            hit = hit | ((F.col("c") == i) & (F.col("seg") == seg) & (F.col("end") > at) & (F.col("end") - F.col("n") <= at))
        got = placed.where(hit).collect()
        out = {}
        for (i, rank), (seg, before) in slots.items():
            at = rank - before
            one = [r["v"] for r in got if r["c"] == i and r["seg"] == seg and r["end"] - r["n"] <= at < r["end"]]
            out[(i, rank)] = one[0] if one else _narrowed(held.where((F.col("c") == i) & (F.col("seg") == seg)), at, buckets, max_distinct)
        return out
    finally:
        held.unpersist()


def _narrowed(values: DataFrame, rank: int, buckets: int, max_distinct: int) -> float:
    """The value of a 0-based rank in a table of many distinct values with
    their rows: ranges of about equal numbers of values, then the range that
    holds the rank, until one task can rank it."""
    while True:
        edges = values.agg(F.percentile_approx("v", [b / buckets for b in range(1, buckets)], 10 * buckets)).first()[0]
        edges = sorted(set(edges))
        array = F.array(*[F.lit(float(e)) for e in edges])
        part = F.size(F.filter(array, lambda e: e < F.col("v")))
        before = 0
        for r in sorted(values.groupBy(part.alias("b")).agg(F.sum("n").alias("n"), F.count("v").alias("distinct")).collect(), key=lambda r: r["b"]):
            if rank < before + r["n"]:
                break
            before += r["n"]
        values, rank = values.where(part == r["b"]), rank - before
        if r["distinct"] <= max(1, max_distinct):
            w = Window.partitionBy("c").orderBy("v").rowsBetween(Window.unboundedPreceding, 0)
            placed = values.withColumn("end", F.sum("n").over(w))
            return placed.where((F.col("end") > rank) & (F.col("end") - F.col("n") <= rank)).first()["v"]
