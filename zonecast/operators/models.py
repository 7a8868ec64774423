"""Regression models on the feature panel.

Linear models are solved from one pass over the rows (``operators/linear.py``).
Callers materialise the feature panel once.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from zonecast.functions import metrics as M
from zonecast.functions.numeric import clamp_nonneg
from zonecast.operators import boosting
from zonecast.operators.boosting import BoostedTrees
from zonecast.operators.features import fill_features
from zonecast.operators.linear import Fit, Fits, LinearModel, fit_all, violations
from zonecast.schema import FEATURES, TARGET

# Regularisation grids of the tuning step.
RIDGE_ALPHAS = [0.001, 0.01, 0.1, 1.0, 10.0, 100.0]
LASSO_ALPHAS = [0.0001, 0.001, 0.01, 0.1]
ELASTIC_ALPHAS = [0.001, 0.01, 0.1]
ELASTIC_L1_RATIO = 0.5


def assemble(df: DataFrame, features: Sequence[str] = FEATURES, out: str = "features") -> DataFrame:
    """Missing features -> 0, then one vector column."""
    filled = fill_features(df, features)
    cast = filled.select(*[F.col(c).cast("double").alias(c) if c in features else F.col(c) for c in filled.columns])
    return VectorAssembler(inputCols=list(features), outputCol=out).transform(cast)


def _lr(**kw) -> LinearRegression:
    return LinearRegression(featuresCol="features", labelCol=TARGET, predictionCol="y_pred", **kw)


def feature_names(assembled: DataFrame) -> list[str]:
    """The columns that :func:`assemble` put into the vector, in its order."""
    attrs = assembled.schema["features"].metadata["ml_attr"]["attrs"]
    return [a["name"] for a in sorted((a for kind in attrs.values() for a in kind), key=lambda a: a["idx"])]


def fit_linear(train: DataFrame, scaled: bool = False) -> LinearModel:
    """Ordinary least squares (M2); ``scaled=True`` standardises first (M4).

    The 17 features are exactly collinear (hour_of_week = 24 * day_of_week +
    hour, trap T13): dependent features get the coefficient 0, predictions are
    those of any least-squares solution.
    """
    return fit_all(train, feature_names(train), TARGET).least_squares(scaled).model


def fit_gbt(train: DataFrame, trees: int = 100, depth: int = 6, rate: float = 0.1, rows: float = 0.8,
            cols: float = 0.8, seed: int = 42, bins: int = 256) -> BoostedTrees:
    """Boosted trees with the reference's settings (M3): 100 trees by
    histograms, depth 6, rate 0.1, 80 % of the rows and of the features drawn
    per tree, seed 42. Its draws are its own, so single trees differ."""
    return boosting.fit(train.drop("features"), feature_names(train), TARGET, trees, depth, rate, rows, cols, seed, bins)


def sk_to_spark_penalty(alpha: float, l1_ratio: float, n: int, s_y: float) -> tuple[float, float]:
    """(regParam, elasticNetParam) equal to scikit-learn's penalty.

    Spark divides its penalty by the label's sample std ``s_y`` and averages
    the loss over ``n`` rows. Ridge (l1_ratio 0): ``alpha * s_y / n``; Lasso
    (l1_ratio 1): ``alpha``; elastic net: ``lam = alpha * (rho + (1 - rho) * s_y)``
    with ``elasticNetParam = alpha * rho / lam``.
    """
    if l1_ratio == 0:
        return alpha * s_y / n, 0.0
    if l1_ratio == 1:
        return alpha, 1.0
    lam = alpha * (l1_ratio + (1 - l1_ratio) * s_y)
    return lam, alpha * l1_ratio / lam


def fit_penalized(train: DataFrame, alpha: float, l1_ratio: float, n: int, s_y: float,
                  population_std: bool = True) -> PipelineModel:
    """Standardised features + penalised least squares in scikit-learn's units.

    MLlib's scaler divides by the sample std, scikit-learn's by the
    population std (trap T14); ``population_std`` multiplies the scaled
    features by sqrt(n / (n - 1)) so the penalty acts on the same features.
    """
    reg, en = sk_to_spark_penalty(alpha, l1_ratio, n, s_y)
    stages = [StandardScaler(inputCol="features", outputCol="sfeatures", withMean=True, withStd=True)]
    if population_std and n > 1:
        attrs = train.schema["features"].metadata.get("ml_attr", {})
        d = attrs.get("num_attrs") or len(train.select("features").first()["features"])
        stages.append(ElementwiseProduct(scalingVec=Vectors.dense([math.sqrt(n / (n - 1))] * d),
                                         inputCol="sfeatures", outputCol="zfeatures"))
    else:
        stages[0].setOutputCol("zfeatures")
    lr = _lr(regParam=reg, elasticNetParam=en, standardization=False, solver="l-bfgs",
             maxIter=1000, tol=1e-9).setFeaturesCol("zfeatures")
    return Pipeline(stages=stages + [lr]).fit(train)


def score(model: LinearModel | BoostedTrees | PipelineModel, df: DataFrame, clamp: bool = False) -> DataFrame:
    """Batch scoring (M11); ``clamp`` floors predictions at 0."""
    out = model.transform(df)
    return out.withColumn("y_pred", clamp_nonneg("y_pred")) if clamp else out


def _measured(test: DataFrame, predictions: Sequence) -> list[dict]:
    """MAE, RMSE and R^2 of several predictions, one pass over the test rows."""
    scored = test.select(TARGET, *[p.alias(f"p{i}") for i, p in enumerate(predictions)])
    aggs = [f(TARGET, f"p{i}").alias(f"{k}{i}") for i in range(len(predictions))
            for k, f in (("mae", M.mae), ("rmse", M.rmse), ("r2", M.r2))]
    r = scored.agg(*aggs).first()
    return [{k: r[f"{k}{i}"] for k in ("mae", "rmse", "r2")} for i in range(len(predictions))]


def evaluate(model: LinearModel | BoostedTrees | PipelineModel, test: DataFrame) -> dict:
    """MAE, RMSE and R^2 of a model on a scored set (one aggregate)."""
    return _measured(score(model, test), [F.col("y_pred")])[0]


class Tuning:
    """Linear variants over one training set (M4-M7): one pass over its rows
    for all fits, one over the test rows for all figures."""

    def __init__(self, train: DataFrame, test: DataFrame):
        self.train, self.test = train, test
        self.fits: Fits = fit_all(train, feature_names(train), TARGET)
        self.variants: list[tuple[dict, Fit]] = []

    def _add(self, name: str, alpha: float | None, l1_ratio: float | None, fit: Fit) -> Fit:
        self.variants.append(({"model": name, "alpha": alpha, "l1_ratio": l1_ratio}, fit))
        return fit

    def add_least_squares(self) -> None:
        self._add("linear", None, None, self.fits.least_squares())
        self._add("linear_scaled", None, None, self.fits.least_squares(scaled=True))

    def add(self, alphas: Sequence[float], l1_ratio: float, name: str) -> None:
        """Fit each alpha of one family, the largest first, each from the one before."""
        found, last = {}, None
        for a in sorted(alphas, reverse=True):
            found[a] = last = self.fits.penalised(a, l1_ratio, last)
        for a in alphas:
            self._add(name, float(a), float(l1_ratio), found[a])

    def add_grid(self) -> None:
        """The 13 penalised variants of the tuning step."""
        self.add(RIDGE_ALPHAS, 0.0, "ridge")
        self.add(LASSO_ALPHAS, 1.0, "lasso")
        self.add(ELASTIC_ALPHAS, ELASTIC_L1_RATIO, "elastic_net")

    def results(self) -> list[dict]:
        """MAE, RMSE and R^2 of every variant."""
        figures = _measured(self.test, [f.model.predictor() for _, f in self.variants])
        return [{**what, **r} for (what, _), r in zip(self.variants, figures)]

    def optimality(self) -> DataFrame:
        """Per variant and feature how far the fit is from its optimality
        condition on the training rows, with the feature's deviation; the
        feature '' holds the mean residual."""
        m, found = violations(self.train, [f for _, f in self.variants], TARGET)
        names = self.variants[0][1].model.features
        sd = [*m.cov(names, names).diagonal() ** 0.5, None]
        rows = [(w["model"], w["alpha"], f, None if d is None else float(d), float(v), m.n)
                for (w, _), line in zip(self.variants, found) for f, d, v in zip([*names, ""], sd, line)]
        return self.train.sparkSession.createDataFrame(rows, "model string, alpha double, feature string, deviation double, violation double, n_rows long")


def tune(train: DataFrame, test: DataFrame, alphas: Sequence[float], l1_ratio: float, name: str) -> list[dict]:
    """Fit each alpha of one family on ``train``, measure on ``test`` (M5-M7)."""
    t = Tuning(train, test)
    t.add(alphas, l1_ratio, name)
    return t.results()


def tune_ridge(train, test, alphas=RIDGE_ALPHAS):
    return tune(train, test, alphas, 0.0, "ridge")


def tune_lasso(train, test, alphas=LASSO_ALPHAS):
    return tune(train, test, alphas, 1.0, "lasso")


def tune_elastic_net(train, test, alphas=ELASTIC_ALPHAS, l1_ratio=ELASTIC_L1_RATIO):
    return tune(train, test, alphas, l1_ratio, "elastic_net")


def tune_all(train: DataFrame, test: DataFrame) -> list[dict]:
    """Base and scaled OLS and the best variant of each penalised family
    (M4-M8): five entries from one pass over each set."""
    t = Tuning(train, test)
    t.add_least_squares()
    t.add_grid()
    found = t.results()
    return found[:2] + [best([r for r in found if r["model"] == name]) for name in ("ridge", "lasso", "elastic_net")]


def best(results: Sequence[dict]) -> dict | None:
    """The result with the least MAE, first one on ties (to 9 places)."""
    return min(results, key=lambda r: round(r["mae"], 9)) if results else None


def leaderboard(spark, results: Sequence[dict]) -> DataFrame:
    """All variants ranked by MAE (M8). ``results`` holds one small dict per
    fitted model -- summaries, not data."""
    rows = [(r["model"], r.get("alpha"), r.get("l1_ratio"), r["mae"], r["rmse"], r["r2"]) for r in results]
    df = spark.createDataFrame(rows, "model string, alpha double, l1_ratio double, mae double, rmse double, r2 double")
    return df.orderBy("mae", "model", "alpha")


def improvement(a: dict, b: dict) -> dict:
    """Relative improvement of model ``b`` over ``a`` in MAE, RMSE and R^2 (M8)."""
    return {"mae_pct": 100 * (a["mae"] - b["mae"]) / a["mae"],
            "rmse_pct": 100 * (a["rmse"] - b["rmse"]) / a["rmse"],
            "r2_pct": 100 * (b["r2"] - a["r2"]) / abs(a["r2"]) if a["r2"] else 0.0}


def feature_importance(spark, model: BoostedTrees, n: int = 10) -> DataFrame:
    """Top ``n`` features by the mean gain of their splits (M9)."""
    df = spark.createDataFrame(list(model.importance().items()), "feature string, importance double")
    return df.orderBy(F.col("importance").desc(), "feature").limit(n)


def fit_final(panel: DataFrame, features: Sequence[str] = FEATURES) -> LinearModel:
    """OLS on all rows, as the saved model of the reference (M10). Metrics
    measured with it on any subset are in-sample (trap T18)."""
    return fit_linear(assemble(panel, features))
