"""Train-and-register (G5), register-existing (G6) feed the registry state (G1);
ensemble explanations (M14)."""

import random

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from policylens.operators import explain as EX
from policylens.operators import model as MD
from policylens.operators import registry as R


def _toy(spark, n=200):
    rnd = random.Random(5)
    rows = [(i, rnd.random(), rnd.random()) for i in range(n)]
    df = spark.createDataFrame(rows, "policy_id long, a double, b double")
    return df, df.select("policy_id", (F.col("a") * 3 + F.col("b")).alias("premium"))


def test_train_register_and_activate(spark, tmp_path):
    feats, prem = _toy(spark)
    reg = str(tmp_path / "registry")
    t1 = MD.train_and_register(spark, feats, prem, str(tmp_path / "models"), reg, "decision_tree", maxDepth=3)
    path = MD.save(t1, str(tmp_path / "models2"))
    MD.register_existing(spark, path, reg, activate=False)
    state = R.register_state(spark.read.parquet(reg))
    active = R.active_model(state).collect()
    assert len(active) == 1 and active[0]["model_id"] == t1.name
    loaded = MD.load(path)
    assert loaded.metrics == t1.metrics


def test_ensemble_explanations(spark):
    feats, prem = _toy(spark)
    data = VectorAssembler(inputCols=["a", "b"], outputCol="features").transform(
        feats.join(prem, "policy_id")).withColumnRenamed("premium", "label")
    recs = {}
    for name, depth in (("shallow", 2), ("deep", 4)):
        m = DecisionTreeRegressor(maxDepth=depth, seed=1).fit(data)
        recs[name] = EX.explanation_records(EX.explain(spark, m, data.select("policy_id", "features")), ["a", "b"])
    out = EX.ensemble_explanations(recs, {"shallow": 1.0, "deep": 3.0})
    r = out.first()
    assert len(r["explanations"]) == 2
    assert abs(sum(e["weight"] for e in r["explanations"]) - 1.0) < 1e-12
    for e in r["explanations"]:
        assert abs(e["base_value"] + sum(f["contribution"] for f in e["features"]) - e["prediction"]) < 1e-6
        assert {f["name"] for f in e["features"]} == {"a", "b"} and all(f["value"] is not None for f in e["features"])
    assert abs(r["ensemble_prediction"] - sum(e["weight"] * e["prediction"] for e in r["explanations"])) < 1e-9
    preds = {k: v.select("policy_id", "prediction") for k, v in recs.items()}
    none = EX.ensemble_explanations({"deep": recs["deep"].limit(0)}, {"shallow": 1.0, "deep": 3.0}, preds).first()
    assert none["explanations"] is None and none["ensemble_prediction"] is None


def test_state_follows_time_not_id(spark):
    rows = [("random_forest_1", "random_forest", "1", True, "2025-01-01 00:00:00"), ("decision_tree_2", "decision_tree", "2", True, "2025-06-01 00:00:00"),
            ("random_forest_1", "random_forest", "1b", False, "2025-07-01 00:00:00")]
    events = spark.createDataFrame(rows, "model_id string, model_name string, model_version string, activate boolean, created_at string")
    state = {r.model_id: (r.model_version, r.is_active) for r in R.register_state(events).collect()}
    assert state == {"random_forest_1": ("1b", False), "decision_tree_2": ("2", True)}
    assert R.recent_versions(events, 1).first().model_version == "1b"


def test_concurrent_registrations_are_ordered(spark, tmp_path):
    """Writers at one time get different numbers, and the last number decides which model is active."""
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(8) as pool:
        numbers = list(pool.map(lambda _: R.next_sequence(spark, str(tmp_path / "numbers")), range(40)))
    assert sorted(numbers) == list(range(1, 41))
    feats, prem = _toy(spark)
    tm, _ = MD.train(feats, prem, "decision_tree", max_depth=2)
    paths = []
    for k in range(4):
        tm.version = f"2025010100000{k}"
        paths.append(MD.save(tm, str(tmp_path / "models")))
    reg = str(tmp_path / "registry")
    with ThreadPoolExecutor(4) as pool:
        list(pool.map(lambda p: MD.register_existing(spark, p, reg), paths))
    events = {r.model_id: r.seq for r in spark.read.parquet(reg).collect()}
    assert sorted(events.values()) == [1, 2, 3, 4]
    active = R.active_model(R.register_state(spark.read.parquet(reg))).collect()
    assert [r.model_id for r in active] == [max(events, key=events.get)]
