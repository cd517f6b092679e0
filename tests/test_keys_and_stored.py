"""A key that outlives watermark and restarts; tables stored so that per-policy work plans no exchange."""

import numpy as np
from pyspark.sql import functions as F

from policylens.operators import features
from policylens.plans.q_features import AS_OF
from policylens.plans.q_policy import vocab_for
from policylens.sources import stored
from policylens.sources.tables import Fixtures
from policylens.streaming import keys
from tests.conftest import SMOKE


def test_filters_never_miss_and_seldom_err():
    r = np.random.default_rng(1)
    held, other = r.integers(-2**62, 2**62, 5000), r.integers(-2**62, 2**62, 20_000)
    filters = [keys.bloom(held[:2000]), keys.bloom(held[2000:]), keys.bloom(held[:0])]
    assert keys.may_hold(filters, held).all() and keys.may_hold(filters, other).mean() < 0.05
    assert not keys.may_hold([], held).any()


def test_first_rows_of_keys(spark, tmp_path):
    table = keys.KeyTable(spark, str(tmp_path / "keys"), buckets=4)
    schema = "id string, at int, v int, _key string, bucket string"
    batches = [[("a", 2, 1), ("a", 1, 2), ("b", 5, 3), (None, 1, 4), (None, 1, 4)], [("a", 0, 5), ("c", 9, 6)], [("b", 1, 7), ("c", 1, 8), ("d", 1, 9)], []]
    want = [{("a", 2), ("b", 3), (None, 4)}, {("c", 6)}, {("d", 9)}, set()]
    run = lambda k: [(r.id, r.v) for r in keys.KeyTable(spark, str(tmp_path / "keys"), 4).first_seen(
        spark.createDataFrame([(*x, "x", "y") for x in batches[k]], schema), "id", "at", k).collect()]
    for k in range(4):
        assert set(run(k)) == want[k]
    assert set(run(1)) == want[1] and len(run(0)) == 4  # replays; every row without a key stays
    assert table._read("keys", "key string, batch int, bucket int", -1).count() == 4


def test_stored_tables_need_no_exchange(spark):
    fx = Fixtures(spark, SMOKE)
    flat = {"policies": fx.policies, "drivers": fx.drivers, "vehicles": fx.vehicles, "history": fx.history, "locations": fx.locations}
    kept = stored.store(flat, buckets=4)
    out = features.policy_features(**kept.read(spark), vocab=vocab_for(fx), as_of=AS_OF)
    small = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for tables beyond it
    try:
        plan = out._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", small)
    assert "Exchange" not in plan and "Bucketed: true" in plan
    assert out.agg(F.count(F.lit(1)), F.sum("num_drivers")).first() == features.policy_features(**flat, vocab=vocab_for(fx), as_of=AS_OF).agg(F.count(F.lit(1)), F.sum("num_drivers")).first()
    kept.drop(spark)
