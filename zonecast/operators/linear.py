"""Linear models from one pass over the rows.

Every fit needs only the co-moments of the features and the target: their
number, means and centred cross products. Tasks compute them batch by batch
and merge them pairwise, the partial results are merged in groups of tasks,
and what reaches the driver is a handful of (k x k) matrices, whatever the
number of rows. All fits then solve small systems:

* least squares by symmetric elimination with pivoting, which leaves out
  features that depend on the others (``hour_of_week`` = 24 * day + hour, T13);
* ridge by the same elimination with a penalty on the diagonal;
* lasso and elastic net by cyclic coordinate descent in covariance form, from
  the solution of the penalty before, ended by an exact solve on the active
  set once its signs hold.

A fitted model scores with one column expression, so scoring stays in the
generated code of the scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: A feature is dependent if elimination leaves less than this share of its variance.
DEPENDENT = 1e-10
MERGED_TASKS = 256   # partial co-moments merged in one task
MAX_SWEEPS = 20_000  # of coordinate descent; an exact solve usually ends it within a hundred


# ---- co-moments ------------------------------------------------------------

@dataclass(frozen=True)
class CoMoments:
    """Number of rows, means, and centred cross products (sums) of columns."""

    columns: tuple[str, ...]
    n: int
    mean: np.ndarray
    scatter: np.ndarray

    def cov(self, rows: Sequence[str], cols: Sequence[str]) -> np.ndarray:
        """Population covariances."""
        at = {c: i for i, c in enumerate(self.columns)}
        return self.scatter[np.ix_([at[c] for c in rows], [at[c] for c in cols])] / max(1, self.n)

    def means(self, cols: Sequence[str]) -> np.ndarray:
        at = {c: i for i, c in enumerate(self.columns)}
        return self.mean[[at[c] for c in cols]]


Part = tuple[int, np.ndarray, np.ndarray]


def merge_moments(a: Part, b: Part) -> Part:
    """Co-moments of the rows of both."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return b if b[0] else a
    shift = b[1] - a[1]
    return n, a[1] + shift * (b[0] / n), a[2] + b[2] + np.outer(shift, shift) * (a[0] * b[0] / n)


def batch_moments(x: np.ndarray) -> Part:
    mean = x.mean(0) if len(x) else np.zeros(x.shape[1])
    centred = x - mean
    return len(x), mean, centred.T @ centred


_PART = "part int, n long, mean array<double>, scatter array<double>"


def _row(part: int, m: Part) -> dict:
    return {"part": [part], "n": [m[0]], "mean": [m[1].tolist()], "scatter": [m[2].ravel().tolist()]}


def co_moments(df: DataFrame, columns: Sequence[str]) -> CoMoments:
    """Co-moments of numeric columns; missing values (null, NaN) count as 0
    (F11). One pass; an empty table gives zeros."""
    k = len(columns)
    zero = F.lit(0.0)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Part = (0, np.zeros(k), np.zeros((k, k)))
        for b in batches:
            total = merge_moments(total, batch_moments(np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])))
        yield pa.RecordBatch.from_pydict(_row(TaskContext.get().partitionId(), total),
                                         pa.schema([("part", pa.int32()), ("n", pa.int64()), ("mean", pa.list_(pa.float64())), ("scatter", pa.list_(pa.float64()))]))

    def merged(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")  # the same sum whatever order they come in
        total: Part = (0, np.zeros(k), np.zeros((k, k)))
        for n, mean, scatter in zip(rows["n"], rows["mean"], rows["scatter"]):
            total = merge_moments(total, (int(n), np.array(mean), np.array(scatter).reshape(k, k)))
        return pd.DataFrame(_row(int(rows["part"].iloc[0]), total))

    clean = df.select(*[F.coalesce(F.nanvl(F.col(c).cast("double"), zero), zero).alias(f"c{i}") for i, c in enumerate(columns)])
    parts = clean.mapInArrow(partial, _PART).groupBy((F.col("part") / MERGED_TASKS).cast("int").alias("slot")).applyInPandas(merged, _PART)
    total: Part = (0, np.zeros(k), np.zeros((k, k)))
    for r in sorted(parts.collect(), key=lambda r: r["part"]):  # one row for MERGED_TASKS tasks
        total = merge_moments(total, (r["n"], np.array(r["mean"]), np.array(r["scatter"]).reshape(k, k)))
    return CoMoments(tuple(columns), *total)


# ---- models ----------------------------------------------------------------

@dataclass(frozen=True)
class LinearModel:
    """intercept + sum of coefficients * features; missing features count as 0."""

    features: tuple[str, ...]
    coefficients: tuple[float, ...]
    intercept: float

    def predictor(self) -> Column:
        out = F.lit(self.intercept)
        zero = F.lit(0.0)
        for f, c in zip(self.features, self.coefficients):
            if c:
                out = out + F.lit(c) * F.coalesce(F.nanvl(F.col(f).cast("double"), zero), zero)
        return out

    def transform(self, df: DataFrame, out: str = "y_pred") -> DataFrame:
        """Batch scoring (M11) in the scan's generated code."""
        return df.withColumn(out, self.predictor())

    def save(self, spark: SparkSession, path: str) -> None:
        """One row of parquet (K3)."""
        row = [(list(self.features), list(self.coefficients), self.intercept)]
        spark.createDataFrame(row, "features array<string>, coefficients array<double>, intercept double").coalesce(1).write.mode("overwrite").parquet(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> LinearModel:
        r = spark.read.parquet(path).first()
        return LinearModel(tuple(r["features"]), tuple(r["coefficients"]), r["intercept"])


def independent(a: np.ndarray) -> list[int]:
    """Rows of a positive semidefinite matrix in pivot order, without those
    that depend on the ones before."""
    left, whole, chosen = a.astype(float).copy(), np.diag(a).copy(), []
    while True:
        diag = np.where(np.diag(left) > DEPENDENT * whole, np.diag(left), 0.0)
        diag[chosen] = 0.0
        j = int(np.argmax(diag))
        if diag[j] <= 0:
            return chosen
        chosen.append(j)
        left = left - np.outer(left[:, j], left[j]) / left[j, j]


def solve(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A solution of a x = b for a positive semidefinite matrix: dependent
    rows get 0; one step of refinement."""
    x, keep = np.zeros(len(b)), independent(a)
    if keep:
        part = a[np.ix_(keep, keep)]
        x[keep] = np.linalg.solve(part, b[keep])
        x[keep] += np.linalg.solve(part, b[keep] - part @ x[keep])
    return x


def kkt(c: np.ndarray, b: np.ndarray, w: np.ndarray, l1: float, l2: float) -> float:
    """Largest violation of the optimality conditions of a penalised fit."""
    g = b - c @ w - l2 * w
    return float(np.max(np.where(w != 0, np.abs(g - l1 * np.sign(w)), np.maximum(np.abs(g) - l1, 0.0)), initial=0.0))


def _on_active(c: np.ndarray, b: np.ndarray, w: np.ndarray, l1: float, l2: float) -> np.ndarray | None:
    """The exact solution on the active set of ``w``, if its signs stay."""
    on = np.flatnonzero(w)
    x = np.zeros(len(b))
    if len(on):
        x[on] = solve(c[np.ix_(on, on)] + l2 * np.eye(len(on)), b[on] - l1 * np.sign(w[on]))
        on = np.flatnonzero(x)
    return x if (np.sign(x[on]) == np.sign(w[on])).all() else None


def descend(c: np.ndarray, b: np.ndarray, l1: float, l2: float, start: np.ndarray | None = None, tol: float = 1e-11) -> np.ndarray:
    """Weights that minimise w'cw/2 - b'w + l1 |w| + l2 w'w/2 by cyclic
    coordinate descent, to a violation of at most ``tol``."""
    w = np.zeros(len(b)) if start is None else start.copy()
    w[np.diag(c) <= 0] = 0.0
    live = np.flatnonzero(np.diag(c) > 0)
    for sweep in range(MAX_SWEEPS):
        for j in live:
            g = b[j] - c[j] @ w + c[j, j] * w[j]
            w[j] = np.sign(g) * max(abs(g) - l1, 0.0) / (c[j, j] + l2)
        if kkt(c, b, w, l1, l2) <= tol:
            return w
        if sweep % 10 == 9:
            exact = _on_active(c, b, w, l1, l2)
            if exact is not None and kkt(c, b, exact, l1, l2) <= tol:
                return exact
    raise RuntimeError(f"coordinate descent did not converge: {kkt(c, b, w, l1, l2)} left")


@dataclass(frozen=True)
class Fit:
    """A fitted variant: the model, its penalties per mean squared error on
    standardised features, and its weights on those."""

    model: LinearModel
    l1: float
    l2: float
    weights: tuple[float, ...]


class Fits:
    """All linear fits of one table, from its co-moments."""

    def __init__(self, moments: CoMoments, features: Sequence[str], target: str):
        self.moments, self.features, self.target = moments, tuple(features), target
        self.cov = moments.cov(features, features)
        self.with_target = moments.cov(features, [target])[:, 0]
        self.sd = np.sqrt(np.diag(self.cov))
        # correlations; a constant feature has none and gets no weight
        self.unit = np.divide(1.0, self.sd, out=np.zeros_like(self.sd), where=self.sd > 0)
        self.corr = self.cov * np.outer(self.unit, self.unit)
        self.b = self.with_target * self.unit

    def _fit(self, coefficients: np.ndarray, l1: float = 0.0, l2: float = 0.0) -> Fit:
        means = self.moments.means([*self.features, self.target])
        intercept = float(means[-1] - coefficients @ means[:-1])
        return Fit(LinearModel(self.features, tuple(map(float, coefficients)), intercept), l1, l2, tuple(coefficients * self.sd))

    def least_squares(self, scaled: bool = False) -> Fit:
        """M2; ``scaled`` eliminates among standardised features (M4): the
        predictions are the same, other dependent features may be left out."""
        return self._fit(solve(self.corr, self.b) * self.unit if scaled else solve(self.cov, self.with_target))

    def penalised(self, alpha: float, l1_ratio: float, start: Fit | None = None) -> Fit:
        """A fit on standardised features in scikit-learn's units (T12):
        ridge (``l1_ratio`` 0) adds alpha |w|^2 to the sum of squares, lasso and
        elastic net add alpha (r |w|_1 + (1 - r) |w|^2 / 2) to half its mean."""
        if l1_ratio == 0:
            l2 = alpha / max(1, self.moments.n)
            return self._fit(solve(self.corr + l2 * np.diag(np.diag(self.corr)), self.b) * self.unit, 0.0, l2)
        l1, l2 = alpha * l1_ratio, alpha * (1 - l1_ratio)
        w = descend(self.corr, self.b, l1, l2, np.array(start.weights) if start else None)
        return self._fit(w * self.unit, l1, l2)


def fit_all(df: DataFrame, features: Sequence[str], target: str) -> Fits:
    """Co-moments of a table, ready for every fit: one pass over its rows."""
    return Fits(co_moments(df, [*features, target]), features, target)


def violations(df: DataFrame, fits: Sequence[Fit], target: str) -> tuple[CoMoments, np.ndarray]:
    """How far each fit is from optimal on the rows of ``df``: per fit and
    feature the violation of its condition on the standardised feature, then
    the absolute mean residual. Measured on the residuals of the rows (one
    more pass), not on the co-moments that the fits were solved from."""
    features = fits[0].model.features
    names = [f"__r{i}" for i in range(len(fits))]
    zero = F.lit(0.0)
    residuals = df.select(*features, *[(F.coalesce(F.col(target).cast("double"), zero) - f.model.predictor()).alias(r) for f, r in zip(fits, names)])
    m = co_moments(residuals, [*features, *names])
    sd = np.sqrt(np.diag(m.cov(features, features)))
    unit = np.divide(1.0, sd, out=np.zeros_like(sd), where=sd > 0)
    gradient = m.cov(features, names) * unit[:, None]
    out = np.zeros((len(fits), len(features) + 1))
    for i, f in enumerate(fits):
        w = np.array(f.weights)
        g = gradient[:, i] - f.l2 * w
        out[i, :-1] = np.where(w != 0, np.abs(g - f.l1 * np.sign(w)), np.maximum(np.abs(g) - f.l1, 0.0))
        out[i, -1] = abs(m.means([names[i]])[0])
    return m, out
