import itertools
import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor, RandomForestRegressor

from rentlens.operators import explain as X
from rentlens.operators import models as M

NAMES = ["a", "b", "c", "useless"]


@pytest.fixture(scope="module")
def feats(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 4)).round(2)
    y = 3 * (x[:, 0] > 0) + x[:, 1] * (x[:, 2] > 0.3) + 0.1 * x[:, 2]
    rows = [(i // 2, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y, strict=True))]  # every id twice
    df = spark.createDataFrame(rows, "listing_id long, a double, b double, c double, useless double, log_price double")
    return VectorAssembler(inputCols=NAMES, outputCol="features").transform(df).cache()


def _expected(paths, x, known):
    """The prediction where only the features in ``known`` count, leaf by leaf."""
    total = 0.0
    for i, v in enumerate(paths.value):
        for j in range(paths.share.shape[1]):
            splits = [k for k in range(paths.share.shape[1]) if paths.slot[i, k] == j and np.isfinite(paths.threshold[i, k])]
            if not splits:
                continue
            if paths.slot_feature[i, j] in known:
                v *= all((x[paths.feature[i, k]] <= paths.threshold[i, k]) == paths.left[i, k] for k in splits)
            else:
                v *= paths.share[i, j]
        total += v
    return total


@pytest.mark.parametrize("kind", ["boosted", "forest"])
def test_contributions_are_shapley_values(spark, feats, kind):
    options = {"featuresCol": "features", "labelCol": "log_price", "seed": 1}
    model = (GBTRegressor(maxIter=4, maxDepth=3, **options) if kind == "boosted" else RandomForestRegressor(numTrees=3, maxDepth=4, **options)).fit(feats)
    paths = X.tree_paths(model)
    rows = X.tree_contributions(model, feats, NAMES).collect()
    want = sorted(r["prediction"] for r in model.transform(feats).collect())
    got = sorted(r["base"] + sum(c["contribution"] for c in r["contributions"]) for r in rows)
    assert np.allclose(want, got, atol=1e-6)
    for r in rows[:5]:
        x = [c["value"] for c in r["contributions"]]
        for i in range(4):
            rest = [j for j in range(4) if j != i]
            phi = sum(math.factorial(k) * math.factorial(3 - k) / math.factorial(4) * (_expected(paths, x, {*s, i}) - _expected(paths, x, set(s)))
                      for k in range(4) for s in itertools.combinations(rest, k))
            assert math.isclose(r["contributions"][i]["contribution"], phi, abs_tol=1e-9)


def test_tables_are_made_where_they_are_used(feats):
    import pickle
    paths = X.tree_paths(GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=2, maxDepth=2).fit(feats))
    paths.tables()
    assert pickle.loads(pickle.dumps(paths)).table is None
    with pytest.raises(ValueError):
        X.tree_contributions(GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=1, maxDepth=1).fit(feats), feats, ["a"])


def test_permutation_importance(feats):
    model = GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=8, maxDepth=3, seed=1).fit(feats)
    one = {r["feature"]: r for r in X.permutation_importance(model, feats, NAMES).collect()}
    two = {r["feature"]: r for r in X.permutation_importance(model, feats, NAMES).collect()}
    assert set(one) == set(NAMES)
    assert one["a"]["rise"] > one["b"]["rise"] > abs(one["useless"]["rise"]) and abs(one["useless"]["rise"]) < 0.1
    assert all(math.isclose(one[n]["rmse"], two[n]["rmse"], rel_tol=1e-9) for n in NAMES)


def test_importance_and_drivers_of_trees(feats):
    model = GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=4, maxDepth=3, seed=1).fit(feats)
    c = X.tree_contributions(model, feats, NAMES)
    ranked = M.rank_contributions(c, NAMES).collect()
    assert ranked[0]["feature"] == "a" and ranked[0]["mean_abs_contribution"] > 0.5
    drivers = M.largest_contributions(c, 2).collect()
    assert {r["rank"] for r in drivers} == {1, 2} and len(drivers) == 600


def test_a_row_asks_each_split_once(spark, feats):
    """rows are looked up per group of leaves, not per leaf, with the sums of the leaves' own tables."""
    paths = X.tree_paths(GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=10, maxDepth=5, seed=1).fit(feats))
    x = np.array([[r[c] for c in NAMES] for r in feats.collect()])
    groups = paths.groups()
    assert len(groups) * 2 < len(paths.value) and all(1 <= len(f) <= X.GROUP_BITS for f, _, _, _ in groups)
    want = np.zeros((len(x), 4))
    table, d = paths.tables(), paths.share.shape[1]
    for i in range(len(paths.value)):
        differs = np.zeros(len(x), np.int64)
        for k in range(d):
            differs |= ((x[:, paths.feature[i, k]] <= paths.threshold[i, k]) != paths.left[i, k]).astype(np.int64) << paths.slot[i, k]
        for j in range(d):
            want[:, paths.slot_feature[i, j]] += table[i, ((1 << d) - 1) ^ differs][:, j]
    assert np.allclose(paths.contributions(x), want, atol=1e-12)
    assert np.allclose(paths.contributions(x[:1]), want[:1], atol=1e-12) and paths.contributions(x[:0]).shape == (0, 4)


def test_permuted_values_are_scored_without_rows_per_feature(spark, feats, monkeypatch):
    """errors equal those of the model itself on the dealt values, each value goes to one row, whatever the blocks."""
    model = GBTRegressor(featuresCol="features", labelCol="log_price", maxIter=6, maxDepth=4, seed=1).fit(feats)
    x = np.array([[r[c] for c in NAMES] for r in feats.collect()])
    n = len(x)
    dealt = [X._dealt(np.arange(n), n, 42000 + c) for c in range(4)]
    assert all(sorted(d) == list(range(n)) and (d != np.arange(n)).mean() > 0.9 for d in dealt) and len({tuple(d) for d in dealt}) == 4
    assert [sorted(X._dealt(np.arange(k), k, 1)) for k in (1, 2, 3)] == [[0], [0, 1], [0, 1, 2]]
    other = np.empty_like(x)
    for c in range(4):
        other[dealt[c], c] = x[:, c]
    whole, changed = X.Scores(X.tree_paths(model)).replaced(x, other)
    want = []
    for c in (None, 0, 1, 2, 3):
        z = x.copy()
        if c is not None:
            z[:, c] = other[:, c]
        df = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(z)], "i long, a double, b double, c double, useless double")
        want.append([r["prediction"] for r in model.transform(VectorAssembler(inputCols=NAMES, outputCol="features").transform(df)).orderBy("i").collect()])
    assert np.allclose(whole, want[0], atol=1e-9) and np.allclose(changed, want[1:], atol=1e-9)
    one = {r["feature"]: r["rmse"] for r in X.permutation_importance(model, feats, NAMES).collect()}
    monkeypatch.setattr(X, "DEALT_ROWS", 70)
    two = {r["feature"]: r["rmse"] for r in X.permutation_importance(model, feats, NAMES).collect()}
    assert set(one) == set(NAMES) and all(math.isclose(one[k], two[k], rel_tol=1e-12) for k in NAMES)
