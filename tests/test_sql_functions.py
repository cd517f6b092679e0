from pyspark.sql import functions as F

from policylens.functions import exprs as X
from policylens.functions.sql_functions import register_sql_functions


def test_sql_functions_match_column_functions(spark):
    register_sql_functions(spark)
    df = spark.range(0, 120).select(F.col("id").cast("int").alias("a"), (F.col("id") * 9).cast("double").alias("s"))
    got = df.selectExpr("a", "s", "age_risk(a) AS ar", "experience_risk(a) AS er", "credit_factor(s) AS cf",
                        "insurance_factor(s / 9) AS inf")
    want = df.select("a", "s", X.age_risk("a").alias("ar"), X.experience_risk("a").alias("er"),
                     X.credit_factor("s").alias("cf"), X.insurance_factor(F.col("s") / 9).alias("inf"))
    assert sorted(got.collect()) == sorted(want.collect())


def test_pca_invariants(spark):
    import __spark_entry__ as E
    from tests.conftest import SMOKE
    from policylens.operators import pca
    rows = E.queries()["policy_features"](spark, SMOKE)
    c = pca.fit(rows, [x for x in rows.columns if x != "policy_id"], 20)
    ev = c.explained.tolist()
    assert len(ev) == 20 and 0 < sum(ev) <= 1 + 1e-9 and ev == sorted(ev, reverse=True)
    assert all(c.axes[abs(c.axes[:, i]).argmax(), i] > 0 for i in range(20))
    one = pca.transform(rows, c)
    assert one.columns == [*rows.columns, "pca"] and len(one.first()["pca"]) == 20


def test_pca_in_one_pass_keeps_what_is_asked_for(spark):
    import numpy as np
    from policylens.operators import pca
    x = np.random.default_rng(3).normal(size=(500, 4)) * [1, 2, 3, 0.5] + [1e6, -5, 0, 7]
    rows = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(x)], "id long, a double, b double, c double, d double").repartition(5)
    c = pca.fit(rows, list("abcd"), 2)
    assert np.allclose(c.mean, x.mean(0), rtol=1e-12) and np.allclose(c.variances, np.linalg.eigvalsh(np.cov(x.T))[::-1][:2], rtol=1e-8)
    whole = pca.fit(rows, list("abcd"), 4)
    got = pca.transform(rows, c, "pca", ["id"], {"all_axes": whole, "own": None})
    assert got.columns == ["id", "pca", "all_axes", "own"]
    for r in got.collect():
        away = x[r["id"]] - x.mean(0)
        assert np.allclose(r["pca"], away @ c.axes) and abs(r["all_axes"] - away @ away) < 1e-8 and abs(r["own"] - away @ away) < 1e-8
    assert not pca.fit(rows.where("id < 0"), list("abcd"), 2).variances.any()


def test_policy_features_joins_sums_not_statistics(spark):
    from policylens.operators import features
    from policylens.plans.catalog import fixtures
    from policylens.plans.q_policy import vocab_for
    from tests.conftest import SMOKE
    fx = fixtures(spark, SMOKE)
    wide = features.policy_features(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, vocab_for(fx), "2002-01-01")
    shown = spark.conf.get("spark.sql.debug.maxToStringFields")
    spark.conf.set("spark.sql.debug.maxToStringFields", "2000")
    plan = wide._jdf.queryExecution().optimizedPlan().toString()
    spark.conf.set("spark.sql.debug.maxToStringFields", shown)
    above, below = plan[:plan.index("Join ")], plan[plan.index("Join "):]
    for c in ("driver_gender_male_max", "vehicle_vehicle_value_mean", "location_crime_rate_min"):
        assert f"AS {c}" in above and f"AS {c}" not in below
