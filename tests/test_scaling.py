"""Exact wide percentiles, and the scaler as an ML estimator."""

import json
import math

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.regression import DecisionTreeRegressor

from policylens.operators import scaling as S


@pytest.fixture(scope="module")
def wide(spark):
    rng = np.random.default_rng(5)
    rows = [(i, float(rng.normal()), float(10.0 ** -(i % 300)), float(i % 2), None, 7.0, None if i % 3 else float(i * i)) for i in range(5000)]
    return spark.createDataFrame(rows, "policy_id long, normal double, `many magnitudes` double, flag double, none double, same double, holes double").cache()


def test_wide_percentiles_equal_percentile(wide):
    cols, probs = wide.columns[1:], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]
    found = S.wide_percentiles(wide, cols, probs, buckets=16)
    assert "none" not in found
    for c in cols:
        if c != "none":
            want = wide.selectExpr(f"percentile(`{c}`, array({', '.join(map(str, probs))}))").first()[0]
            assert found[c] == pytest.approx(want, rel=1e-12, abs=0)


def test_wide_percentiles_of_endless_values(spark):
    values = [math.nan, math.inf, -math.inf, 0.0, -1e308, 1e308, 5e-324, 1.0, 2.0]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    found = S.wide_percentiles(df, ["x"], [k / 8 for k in range(9)], buckets=4)["x"]
    assert found[:8] == [-math.inf, -1e308, 0.0, 5e-324, 1.0, 2.0, 1e308, math.inf] and math.isnan(found[8])
    assert S.wide_percentiles(df.where("x > 1e308 and x < 0"), ["x"], [0.5]) == {}


def test_wide_percentiles_without_numbers_and_beside_the_rank(spark, monkeypatch):
    df = spark.range(1, 4001).selectExpr("double('NaN') AS nan", "CAST(id AS DOUBLE) AS x")
    assert all(math.isnan(v) for v in S.wide_percentiles(df, ["nan"], [0.0, 0.5])["nan"])
    monkeypatch.setattr(S, "_bracket", lambda n, grid, low, high, first, last: (high, high))
    assert S.wide_percentiles(df, ["x"], [0.0, 0.25, 1.0])["x"] == [1.0, 1000.75, 4000.0]


def test_estimator_fits_saves_and_loads(wide, tmp_path):
    cols = ["normal", "flag", "same"]
    for method in ("standard", "robust"):
        model = S.FeatureScaler(inputCols=cols, method=method, vocabulary='{"states": ["CA"]}').fit(wide)
        spec = model.feature_spec
        assert spec.vocabulary == {"states": ["CA"]} and spec.names == cols
        want = S.transform(wide, spec).orderBy("policy_id").limit(50).collect()
        got = model.transform(wide).orderBy("policy_id").limit(50).collect()
        assert [tuple(r["features"]) for r in got] == [tuple(r[c] for c in cols) for r in want]
        model.write().overwrite().save(str(tmp_path / method))
        again = S.FeatureScalerModel.load(str(tmp_path / method))
        assert json.loads(again.getOrDefault(again.spec)) == json.loads(spec.to_json())
    lacking = model.transform(wide.drop("same").limit(1)).first()["features"]
    assert lacking[2] == (0.0 - spec.center["same"]) / spec.scale["same"]


def test_estimator_in_a_pipeline(wide, tmp_path):
    rows = wide.selectExpr("policy_id", "normal", "flag", "normal * 2 + flag AS label")
    fitted = Pipeline(stages=[S.FeatureScaler(inputCols=["normal", "flag"]), DecisionTreeRegressor(maxDepth=3)]).fit(rows)
    fitted.write().overwrite().save(str(tmp_path / "pipe"))
    loaded = PipelineModel.load(str(tmp_path / "pipe"))
    assert loaded.transform(rows).select("prediction").collect() == fitted.transform(rows).select("prediction").collect()


def test_unknown_method(wide):
    with pytest.raises(ValueError):
        S.FeatureScaler(inputCols=["flag"], method="none").fit(wide)


def test_moments_equal_the_aggregates(wide):
    cols = wide.columns[1:]
    found = S.moments(wide.repartition(7), cols)
    for c, (n, mean, m2) in zip(cols, found, strict=True):
        want = wide.selectExpr(f"count(`{c}`)", f"avg(`{c}`)", f"stddev_pop(`{c}`)").first()
        assert n == want[0]
        if n:
            assert mean == pytest.approx(want[1], rel=1e-12, abs=1e-15)
            assert math.sqrt(m2 / n) == pytest.approx(want[2], rel=1e-9, abs=0)
    assert found[cols.index("same")][2] == 0.0 and S.fit_standard(wide, cols).scale["same"] == 1.0


def test_arrays_are_sorted_and_averaged_by_size(spark):
    from policylens.operators import metrics
    rows = spark.createDataFrame([(1, 0, [1.0, -3.0, 2.00004, 2.0]), (1, 1, [0.0, 0.0, 0.0, -0.00005]), (2, 0, [5.0, -7.0])], "model_id int, policy_id long, contributions array<double>").repartition(2)
    names = {1: ["a", "b", "c", "d"], 2: ["a", "z"]}
    got = {(r["model_id"], r["policy_id"]): [tuple(x) for x in r["features"]] for r in metrics.sort_arrays_by_abs(rows, names, by="model_id", digits=4).collect()}
    assert got == {(1, 0): [("b", -3.0), ("c", 2.0), ("d", 2.0), ("a", 1.0)], (1, 1): [("d", -0.0001), ("a", 0.0), ("b", 0.0), ("c", 0.0)], (2, 0): [("z", -7.0), ("a", 5.0)]}
    means = {(r["model_id"], r["feature"]): r["mean_abs"] for r in metrics.mean_abs_arrays(rows, names).collect()}
    assert means == pytest.approx({(1, "a"): 0.5, (1, "b"): 1.5, (1, "c"): 1.00002, (1, "d"): 1.000025, (2, "a"): 5.0, (2, "z"): 7.0})


def test_ensemble_makes_each_record_once(spark):
    from policylens.operators import explain
    rows = {m: spark.createDataFrame([(k, p + k, [("a", 1.0, p)]) for k in (1, 2)], "policy_id long, prediction double, features array<struct<name: string, value: double, contribution: double>>")
            .selectExpr("policy_id", "prediction", "0.0D AS base_value", "features") for m, p in (("x", 1.0), ("y", 5.0))}
    out = explain.ensemble_explanations(rows, {"x": 1.0, "y": 3.0})
    assert "Join" not in out._jdf.queryExecution().optimizedPlan().toString()
    got = {r["policy_id"]: r for r in out.collect()}
    assert got[2]["ensemble_prediction"] == pytest.approx(0.25 * 3 + 0.75 * 7) and [(e["model"], e["weight"]) for e in got[1]["explanations"]] == [("x", 0.25), ("y", 0.75)]


def test_wide_percentiles_makes_no_row_of_a_cell(spark, monkeypatch):
    """Values in a bracket are counted in the tasks: 20,000 rows of 3 values each give few rows to exchange."""
    df = spark.range(20_000).selectExpr(*[f"CAST(id % {3 + k} AS DOUBLE) AS c{k}" for k in range(4)], "CASE WHEN id % 2 = 0 THEN -0.0D END AS z").repartition(4)
    made = []
    monkeypatch.setattr(S, "settle", lambda rows, name: made.append(rows) or settle(rows, name))
    from policylens.session import settle
    found = S.wide_percentiles(df, df.columns, [0.25, 0.5, 0.75])
    assert found == {f"c{k}": df.selectExpr(f"percentile(c{k}, array(0.25, 0.5, 0.75))").first()[0] for k in range(4)} | {"z": [0.0, 0.0, 0.0]}
    plan = made[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" not in plan and "MapInArrow" in plan
