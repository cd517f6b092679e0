"""Model invariants and exact TreeSHAP against brute-force Shapley values."""

import itertools
import math
import random

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, GBTRegressor
from pyspark.sql import functions as F

import __spark_entry__ as E
from policylens.operators import explain as EX
from policylens.operators import model as MD
from tests.conftest import SMOKE


def _toy(spark, n=300):
    rnd = random.Random(3)
    rows = []
    for i in range(n):
        a, b, c, d = (rnd.random() for _ in range(4))
        y = 3 * a + (2 if b > 0.5 else 0) + a * c * 4 + rnd.random() * 0.1
        rows.append((i, a, b, c, d, y))
    df = spark.createDataFrame(rows, "policy_id long, a double, b double, c double, d double, label double")
    return VectorAssembler(inputCols=["a", "b", "c", "d"], outputCol="features").transform(df)


def _goes_left(tree, j, x):
    v, cats = x[tree["feature"][j]], tree["left_cats"][j]
    return v in cats if cats is not None else v <= tree["threshold"][j]


def _cond_exp(tree, x, S, j=0):
    if tree["left"][j] < 0:
        return tree["value"][j]
    d = tree["feature"][j]
    lft, rgt = tree["left"][j], tree["right"][j]
    if d in S:
        return _cond_exp(tree, x, S, lft if _goes_left(tree, j, x) else rgt)
    cv = tree["cover"]
    return (cv[lft] * _cond_exp(tree, x, S, lft) + cv[rgt] * _cond_exp(tree, x, S, rgt)) / cv[j]


def _brute_shap(tree, x, m):
    phi = np.zeros(m)
    for i in range(m):
        others = [k for k in range(m) if k != i]
        for r in range(len(others) + 1):
            for S in itertools.combinations(others, r):
                w = math.factorial(len(S)) * math.factorial(m - len(S) - 1) / math.factorial(m)
                phi[i] += w * (_cond_exp(tree, x, set(S) | {i}) - _cond_exp(tree, x, set(S)))
    return phi


def test_treeshap_equals_brute_force(spark):
    data = _toy(spark)
    dt = DecisionTreeRegressor(maxDepth=4, seed=1).fit(data)
    trees, weights = EX.extract_trees(dt, spark)
    x = np.array([r["features"].toArray() for r in data.limit(15).collect()])
    pred, got = EX.shap_values(trees, weights, x)
    for row, p, phi in zip(x, pred, got):
        assert np.allclose(phi, _brute_shap(trees[0], row, 4), atol=1e-9)
        assert abs(p - _cond_exp(trees[0], row, {0, 1, 2, 3})) < 1e-9


def test_treeshap_with_categories_repeated_features_and_an_unreached_leaf():
    rnd = np.random.default_rng(5)
    # A full tree of depth 5 over 4 features: features repeat on paths; node 2 splits on categories.
    n, depth = 63, 5
    tree = {"left": np.array([2 * i + 1 if i < 31 else -1 for i in range(n)]),
            "right": np.array([2 * i + 2 if i < 31 else -1 for i in range(n)]),
            "feature": np.array([int(rnd.integers(4)) if i < 31 else -1 for i in range(n)]),
            "threshold": rnd.random(n), "value": rnd.normal(size=n), "cover": np.zeros(n), "left_cats": [None] * n}
    tree["feature"][2], tree["left_cats"][2] = 3, {0.0, 2.0}
    tree["cover"][31:] = rnd.integers(1, 50, 32)
    tree["cover"][40] = 0
    for i in range(30, -1, -1):
        tree["cover"][i] = tree["cover"][2 * i + 1] + tree["cover"][2 * i + 2]
    x = np.column_stack([rnd.random((20, 3)), rnd.integers(0, 3, 20)])
    phi = np.zeros(x.shape)
    EX.tree_shap(tree, x, phi)
    for row, got in zip(x, phi):
        assert np.allclose(got, _brute_shap(tree, row, 4), atol=1e-9)


def test_treeshap_local_accuracy_distributed(spark):
    data = _toy(spark)
    for est in (DecisionTreeRegressor(maxDepth=5, seed=1), GBTRegressor(maxDepth=3, maxIter=5, seed=1)):
        mdl = est.fit(data)
        out = EX.explain(spark, mdl, data.select("policy_id", "features"))
        preds = {r["policy_id"]: r["prediction"] for r in mdl.transform(data).collect()}
        for r in out.collect():
            assert abs(r["base_value"] + sum(r["contributions"]) - r["prediction"]) < 1e-6
            assert abs(r["prediction"] - preds[r["policy_id"]]) < 1e-6


def test_factory_rejects_unknown():
    try:
        MD.create_regressor("svm")
        raise AssertionError("expected ValueError")
    except ValueError:
        pass


def test_train_model_invariants(spark):
    row = E.queries()["train_model"](spark, SMOKE).first()
    assert row["importance_sum"] == 1.0 and row["better_than_mean"] and row["rmse_is_root"] and row["metrics_agree"]


def test_save_load_round_trip(spark, tmp_path):
    data = _toy(spark)
    tm, _ = MD.train(data.select("policy_id", "a", "b", "c", "d"),
                     data.select("policy_id", data["label"].alias("premium")), "decision_tree", maxDepth=4)
    path = MD.save(tm, str(tmp_path))
    back = MD.load(path)
    feats = data.select("policy_id", "a", "b", "c", "d")
    p1 = {r[0]: r[1] for r in MD.predict(tm, feats).collect()}
    p2 = {r[0]: r[1] for r in MD.predict(back, feats).collect()}
    assert p1 == p2 and back.name == tm.name


def test_explain_query_residuals(spark):
    rows = E.queries()["explain_predictions"](spark, SMOKE).collect()
    assert rows and all(r["adds_up"] and r["sorted_by_size"] and r["whole"] for r in rows)


def test_tune_with_other_fold_counts_and_unlimited_values(spark):
    feats = spark.range(300).select(F.col("id").alias("policy_id"), (F.col("id") % 17).cast("double").alias("x"),
                                    (F.col("id") % 5).cast("double").alias("y"))
    prem = feats.select("policy_id", (F.col("x") * 3 + F.col("y")).alias("premium"))
    for folds in (2, 5):
        res = MD.tune(feats, prem, "decision_tree", {"max_depth": [2, None]}, folds=folds)
        assert len(res["results"]) == 2 and res["best_params"]["max_depth"] is None
        assert abs(sum(res["importances"].values()) - 1) < 1e-9
        got = {r.policy_id: r.prediction for r in MD.predict(res["trained"], feats).collect()}
        assert all(abs(got[r.policy_id] - r.premium) < 1e-6 for r in prem.collect())  # an unlimited tree knows its rows
    res = MD.tune(feats, prem, "random_forest", {"n_estimators": [3], "max_features": [None, "sqrt"]}, folds=2)
    assert {r["params"]["max_features"] for r in res["results"]} == {None, "sqrt"}
    res = MD.tune(feats, prem, "decision_tree", {"min_samples_split": [2, 5, 200]}, folds=2, metric="mse")
    assert [r["params"]["min_samples_split"] for r in res["results"]] == [2, 5, 200] and res["results"][2]["mean"] > res["results"][0]["mean"]
    with pytest.raises(ValueError):
        MD.tune(feats, prem, "decision_tree", {"max_leaf_nodes": [2, 5]}, folds=2)
    res = MD.tune(feats, prem, "gradient_boosting", {"max_depth": [2], "n_estimators": [3]}, folds=2)
    assert res["best_params"] == {"max_depth": 2, "n_estimators": 3} and MD.predict(res["trained"], feats).count() == 300
    with pytest.raises(ValueError):
        MD.tune(feats, prem, "gradient_boosting", {"min_samples_split": [2]}, folds=2)
