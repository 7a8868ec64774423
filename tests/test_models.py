import math

import numpy as np
from pyspark.sql import functions as F

from zonecast.operators import models as md


def _linear(spark, n=400, seed=7):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 2))
    y = 1.5 + 2.0 * x[:, 0] - 3.0 * x[:, 1] + rng.normal(scale=0.01, size=n)
    return spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)],
                                 "a double, b double, trip_count double"), x, y


def test_ols_recovers_coefficients(spark):
    df, x, y = _linear(spark)
    m = md.fit_linear(md.assemble(df, ["a", "b"]))
    assert np.allclose(m.coefficients, [2.0, -3.0], atol=0.01)
    assert math.isclose(m.intercept, 1.5, abs_tol=0.01)


def test_ridge_penalty_matches_closed_form(spark):
    df, x, y = _linear(spark)
    n, alpha = len(y), 10.0
    for pop, ddof in ((False, 1), (True, 0)):      # MLlib's sample std, or scikit-learn's population std
        z = (x - x.mean(0)) / x.std(0, ddof=ddof)
        zc, yc = z - z.mean(0), y - y.mean()
        w = np.linalg.solve(zc.T @ zc + alpha * np.eye(2), zc.T @ yc)
        m = md.fit_penalized(md.assemble(df, ["a", "b"]), alpha, 0.0, n, float(np.std(y, ddof=1)),
                             population_std=pop)
        assert np.allclose(m.stages[-1].coefficients.toArray(), w, rtol=1e-4)


def test_lasso_penalty_is_alpha(spark):
    assert md.sk_to_spark_penalty(0.1, 1.0, 100, 3.0) == (0.1, 1.0)
    reg, en = md.sk_to_spark_penalty(0.1, 0.5, 100, 3.0)
    assert math.isclose(reg, 0.1 * (0.5 + 0.5 * 3.0)) and math.isclose(en, 0.05 / reg)


def test_leaderboard_orders_by_mae(spark):
    res = [{"model": "b", "alpha": 1.0, "l1_ratio": 0.0, "mae": 2.0, "rmse": 1.0, "r2": 0.5},
           {"model": "a", "alpha": None, "l1_ratio": None, "mae": 1.0, "rmse": 1.0, "r2": 0.9}]
    assert [r.model for r in md.leaderboard(spark, res).collect()] == ["a", "b"]


def test_clamped_scores_nonnegative(spark):
    df, _, _ = _linear(spark)
    a = md.assemble(df, ["a", "b"])
    s = md.score(md.fit_linear(a), a, clamp=True)
    assert s.agg(F.min("y_pred")).first()[0] >= 0.0


def _panel17(spark, n=600, seed=3):
    """A panel of the 17 features, hour_of_week collinear as in the real one."""
    from zonecast.schema import FEATURES
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 17)) * rng.uniform(0.5, 20, 17)
    x[:, 0], x[:, 1] = rng.integers(0, 24, n), rng.integers(0, 7, n)
    x[:, 5] = 24 * x[:, 1] + x[:, 0]
    y = 3 + x[:, 8] * 0.7 - x[:, 12] * 0.2 + x[:, 0] * 0.1 + rng.normal(size=n)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)],
                               ", ".join(f"{f} double" for f in FEATURES) + ", trip_count double")
    return df, x, y


def test_fits_on_all_features_match_numpy(spark):
    """M2-M8 on 17 features: least squares, ridge in closed form, lasso and
    elastic net by coordinate descent, on the same standardised features."""
    df, x, y = _panel17(spark)
    df = df.coalesce(1)
    a = md.assemble(df)
    tr, xt, yt = a, x, y
    z, yc = (x - x.mean(0)) / x.std(0), y - y.mean()
    n = len(y)

    def mae(w):
        return float(np.abs(yc - z @ w).mean())

    def descent(l1, l2):
        w = np.zeros(17)
        for _ in range(4000):
            for j in range(17):
                c = z[:, j] @ (yc - z @ w + z[:, j] * w[j]) / n
                w[j] = np.sign(c) * max(abs(c) - l1, 0) / (1 + l2)
        return w

    want = {("ridge", al): mae(np.linalg.solve(z.T @ z + al * np.eye(17), z.T @ yc)) for al in md.RIDGE_ALPHAS}
    want |= {("lasso", al): mae(descent(al, 0.0)) for al in (0.01, 0.1)}
    want |= {("elastic_net", al): mae(descent(al / 2, al / 2)) for al in (0.01, 0.1)}
    t = md.Tuning(tr, a)
    t.add(md.RIDGE_ALPHAS, 0.0, "ridge")
    t.add([0.01, 0.1], 1.0, "lasso")
    t.add([0.01, 0.1], 0.5, "elastic_net")
    got = {(r["model"], r["alpha"]): r["mae"] for r in t.results()}
    assert got.keys() == want.keys() and all(math.isclose(got[k], want[k], rel_tol=2e-4) for k in want)
    w = np.linalg.lstsq(z, yc, rcond=None)[0]
    for scaled in (False, True):
        assert math.isclose(md.evaluate(md.fit_linear(a, scaled), a)["mae"], mae(w), rel_tol=1e-5)


def test_tuning_reads_the_training_plan_once(spark):
    """All fits come from one pass over the training rows."""
    df, _, _ = _linear(spark)
    seen = spark.sparkContext.accumulator(0)
    counted = spark.createDataFrame(df.rdd.map(lambda r: (seen.add(1), r)[1]), df.schema)
    a = md.assemble(counted, ["a", "b"])
    t = md.Tuning(a, a.limit(10))
    t.add_least_squares()
    t.add_grid()
    assert seen.value == 400
    assert len(t.results()) == 15


def test_fits_equal_the_gradient_solver(spark):
    """One-pass fits against MLlib's iterative fits of the same penalties."""
    df, x, y = _panel17(spark)
    a = md.assemble(df)
    n, s = len(y), float(np.std(y, ddof=1))
    t = md.Tuning(a, a)
    t.add([0.1, 10.0], 0.0, "ridge")
    t.add([0.01, 0.1], 1.0, "lasso")
    t.add([0.1], 0.5, "elastic_net")
    for what, fit in t.variants:
        other = md.fit_penalized(a, what["alpha"], what["l1_ratio"], n, s)
        both = md.score(other, a).withColumn("ours", fit.model.predictor())
        assert both.agg(F.max(F.abs(F.col("ours") - F.col("y_pred")))).first()[0] < 1e-4


def test_every_fit_is_optimal(spark):
    df, _, _ = _panel17(spark)
    a = md.assemble(df)
    t = md.Tuning(a, a)
    t.add_least_squares()
    t.add_grid()
    rows = t.optimality().collect()
    assert len(rows) == 15 * 18 and max(r["violation"] for r in rows) < 1e-9
    # a model that is not optimal is found out
    from dataclasses import replace
    what, fit = t.variants[0]
    t.variants = [(what, replace(fit, model=replace(fit.model, intercept=fit.model.intercept + 0.1)))]
    assert max(r["violation"] for r in t.optimality().collect()) > 0.09


def test_co_moments_do_not_depend_on_the_partitions(spark, monkeypatch):
    from zonecast.operators import linear
    df, x, y = _panel17(spark)
    whole = np.column_stack([x, y])
    monkeypatch.setattr(linear, "MERGED_TASKS", 3)
    for parts in (1, 13):
        m = linear.co_moments(df.repartition(parts), df.columns)
        assert m.n == len(y) and np.allclose(m.mean, whole.mean(0)) and np.allclose(m.scatter / m.n, np.cov(whole.T, ddof=0))
    far = df.select((F.col("lag_1h") + 1e9).alias("a"), "trip_count")
    assert np.allclose(linear.co_moments(far, ["a"]).scatter / len(y), np.var(x[:, 8]), rtol=1e-4)
    empty = linear.fit_all(df.limit(0), ["hour", "month"], "trip_count")
    assert empty.least_squares().model.coefficients == (0.0, 0.0)


def test_missing_and_constant_features(spark):
    rows = [(1.0, 5.0, 2.0), (None, 5.0, 0.0), (float("nan"), 5.0, 0.0), (3.0, 5.0, 6.0)]
    df = spark.createDataFrame(rows, "a double, b double, trip_count double")
    m = md.fit_linear(md.assemble(df, ["a", "b"]))
    assert np.allclose(m.coefficients, [2.0, 0.0]) and abs(m.intercept) < 1e-12
    assert np.allclose([r.y_pred for r in m.transform(df).collect()], [2.0, 0.0, 0.0, 6.0])


def test_best_of_each_family(spark):
    df, _, _ = _linear(spark)
    a = md.assemble(df, ["a", "b"])
    rows = md.tune_all(a, a)
    assert [r["model"] for r in rows] == ["linear", "linear_scaled", "ridge", "lasso", "elastic_net"]
    assert rows[2]["alpha"] == min(md.RIDGE_ALPHAS) and rows[3]["alpha"] == min(md.LASSO_ALPHAS)


def test_boosted_trees_beat_the_mean(spark):
    df, x, y = _linear(spark)
    a = md.assemble(df, ["a", "b"])
    m = md.fit_gbt(a, trees=20)
    assert md.evaluate(m, a)["rmse"] < 0.5 * float(np.std(y))
    top = md.feature_importance(spark, m).collect()
    assert [r.feature for r in top] == ["b", "a"] and math.isclose(sum(r.importance for r in top), 1.0, rel_tol=1e-6)


def _plain_tree(x, y, margin, depth, rate, columns):
    """Leaf values of one tree, every split tried on sorted values."""
    out = np.zeros(len(y))

    def split(rows, level):
        g = margin[rows] - y[rows]
        best = (1e-6, None, None)
        for f in columns if level < depth else ():
            for v in np.unique(x[rows, f])[:-1]:
                left = x[rows, f] <= v
                gain = sum(g[s].sum() ** 2 / (s.sum() + 1) for s in (left, ~left)) - g.sum() ** 2 / (len(g) + 1)
                if gain > best[0] + 1e-9 * abs(gain):
                    best = (gain, f, v)
        if best[1] is None:
            out[rows] = -rate * g.sum() / (len(g) + 1)
        else:
            left = x[rows, best[1]] <= best[2]
            split(rows[left], level + 1)
            split(rows[~left], level + 1)

    split(np.arange(len(y)), 0)
    return out


def test_trees_equal_a_plain_splitter(spark, monkeypatch):
    """500 rows, all values as bins, several partitions and stages."""
    from zonecast.operators import boosting
    monkeypatch.setattr(boosting, "STAGE_TREES", 2)
    monkeypatch.setattr(boosting, "FLAT_PARTITIONS", 2)
    rng = np.random.default_rng(5)
    x = np.column_stack([rng.integers(0, 24, 500), rng.normal(size=500).round(2), rng.integers(0, 3, 500), np.full(500, 7.0)])
    y = np.round(x[:, 0] % 5 + 3 * (x[:, 1] > 0.3) - x[:, 2] + rng.normal(size=500), 3)
    df = spark.createDataFrame([(*map(float, r), float(v)) for r, v in zip(x, y)], "a double, b double, c double, d double, trip_count double").repartition(5)
    m = md.fit_gbt(md.assemble(df, ["a", "b", "c", "d"]), trees=5, depth=3, rows=1.0, cols=1.0, bins=600)
    margin = np.full(500, y.mean())
    for _ in range(5):
        margin = margin + _plain_tree(x, y, margin, 3, 0.1, range(4))
    got = {(r.a, r.b, r.c): r.y_pred for r in m.transform(df).collect()}
    assert np.allclose([got[tuple(r[:3])] for r in x], margin, atol=1e-6)
    assert m.importance()["d"] == 0.0


def test_draws_are_per_tree_and_partitions_do_not_matter(spark, tmp_path):
    df, x, y = _panel17(spark)
    a = md.assemble(df)
    m = md.fit_gbt(a, trees=4, depth=3)
    assert all(len(set(t.feature[t.feature >= 0])) <= 13 for t in m.trees)
    again = md.fit_gbt(md.assemble(df.repartition(7)), trees=4, depth=3)
    for t, u in zip(m.trees, again.trees):
        assert (t.feature == u.feature).all() and (t.cut == u.cut).all() and (t.value == u.value).all()
    from zonecast.sources import sinks
    sinks.save_model(m, str(tmp_path / "gbt"))
    back = sinks.load_model(str(tmp_path / "gbt"))
    assert back.transform(df).exceptAll(m.transform(df)).count() == 0
    assert md.fit_gbt(a.limit(0)).transform(df).agg(F.max("y_pred")).first()[0] == 0.0


def test_few_bins_are_quantiles(spark):
    from zonecast.operators import boosting
    df = spark.range(10_000).select((F.col("id") % 1000).cast("double").alias("a"), (F.col("id") % 5).cast("double").alias("b"))
    wide, few = boosting.bin_edges(df, ["a", "b"], 16)
    assert few.tolist() == [0.0, 1.0, 2.0, 3.0] and len(wide) == 15 and abs(wide[7] - 500) < 10


def test_the_driver_gets_splits_not_histograms(spark, monkeypatch):
    """What a level sends is bounded by nodes x features, not by bins or partitions."""
    import pickle
    from pyspark import RDD
    sent, collect = [], RDD.collect

    def counted(self):
        got = collect(self)
        sent.append(len(pickle.dumps(got)))
        return got

    monkeypatch.setattr(RDD, "collect", counted)
    df, _, _ = _panel17(spark, 2000)
    md.fit_gbt(md.assemble(df.repartition(4)), trees=2, depth=4, bins=256)
    assert len(sent) == 8 and max(sent) < 8 * 13 * 100


def test_best_splits_equal_those_of_whole_histograms():
    """Ties between columns and bins, gains equal up to rounding, nodes without a split."""
    from zonecast.operators import boosting
    rng = np.random.default_rng(11)
    one = rng.integers(0, 3, 12)
    rows = np.stack([one, one[::-1], rng.permutation(one), np.where(np.arange(12) == 4, one.sum(), 0)])
    sums = np.zeros((3, 5, 12, 2), np.int64)   # nodes, columns, bins
    for node, spread in ((0, 0), (1, 1)):
        flat = rows * 2**20 * (1 if node else -1)
        sums[node, :4, :, 0], sums[node, :4, :, 1] = flat + spread * rng.integers(-1, 2, flat.shape), rows
        sums[node, :4, -1, 0] += flat[0].sum() - sums[node, :4, :, 0].sum(1)
        sums[node, 4] = sums[node, 0]
    sums[0, :4, 2, 0] += 2**23
    sums[0, :4, 9, 0] -= 2**23
    sums[0, 4] = sums[0, 0]
    found = [(c, boosting.column_splits(sums[:, c], 2.0**10)) for c in (3, 1, 4, 0, 2)]
    for node, (gain, c, b, left, whole) in zip(sums, boosting.best_splits(found, 3)):
        lg, lh = node[..., 0].cumsum(1) / 2.0**10, node[..., 1].cumsum(1)
        rg, rh = lg[:, -1:] - lg, lh[:, -1:] - lh
        with np.errstate(invalid="ignore"):
            gains = np.where((lh >= 1) & (rh >= 1), lg**2 / (lh + 1) + rg**2 / (rh + 1) - lg[:, -1:]**2 / (lh[:, -1:] + 1), -np.inf)
        assert gain == gains.max() or abs(gain - gains.max()) <= 1e-9 * abs(gains.max())
        assert whole == (lg[0, -1], lh[0, -1])
        if np.isfinite(gain):
            assert (c, b) == np.unravel_index(int(np.argmax(gains >= gains.max() - 1e-9 * abs(gains.max()))), gains.shape)
            assert left == (lg[c, b], lh[c, b])
