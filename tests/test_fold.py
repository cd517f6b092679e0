"""The wide policy rows, folded after one exchange: plans, a policy over several batches, repeated, childless and null policies."""

import datetime as dt

from pyspark.sql import functions as F

from policylens.operators import enhanced, features, nested_features
from policylens.plans.q_policy import nested_files, vocab_for
from policylens.sources.tables import POLICY_AS_OF, Fixtures
from tests.conftest import SMOKE


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_wide_rows_take_one_exchange_of_raw_fields(spark):
    fx = Fixtures(spark, SMOKE)
    t = (fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations)
    plan = plan_of(enhanced.policy_features_enhanced(*t, vocab_for(fx), POLICY_AS_OF))
    assert plan.count("Exchange hashpartitioning(policy_id") == 1 and "Join" not in plan


def test_records_are_not_folded_column_by_column(spark):
    plan = plan_of(nested_features.policy_features(nested_files(spark, SMOKE), vocab_for(Fixtures(spark, SMOKE)), POLICY_AS_OF))
    assert "Exchange" not in plan and "lambdafunction" not in plan.split("posexplode")[0] and "array_max" not in plan


def test_policies_of_all_sizes_match_the_hash_aggregate(spark):
    day = dt.date(1990, 5, 17)
    policies = spark.createDataFrame([(k, day, day, 700.0, None) for k in (1, 2, 2, 3, None)],
                                     "policy_id long, effective_date date, expiration_date date, credit_score double, insurance_score double")
    # Policy 1 reaches over several Arrow batches, 2 has two rows, 3 no children, 9 no policy; null ids meet nothing.
    ids = F.when(F.col("id") < 30000, 1).when(F.col("id") < 30007, 2).when(F.col("id") < 30010, 9).cast("long")
    base = spark.range(30020).withColumn("policy_id", ids)
    drivers = base.select("policy_id", F.date_add(F.lit(day), (F.col("id") % 9000).cast("int") - 9000).alias("date_of_birth"), F.lit(day).alias("license_issue_date"),
                          F.when(F.col("id") % 3 > 0, F.when(F.col("id") % 3 == 1, "male").otherwise("female")).alias("gender"), F.lit(None).cast("string").alias("marital_status"),
                          F.lit("Pilot").alias("occupation"))
    vehicles = base.select("policy_id", F.lit("Ford").alias("make"), F.lit("F150").alias("model"), (F.col("id") % 30 + 1970).cast("int").alias("year"),
                           F.when(F.col("id") % 5 > 0, F.col("id") * 1.5).cast("double").alias("value"), F.lit("personal").alias("primary_use"),
                           F.when(F.col("id") == 7, float("nan")).otherwise(F.col("id")).cast("double").alias("annual_mileage"), (F.col("id") % 2 == 0).alias("anti_theft_device"))
    history = base.select("policy_id", F.lit("claim").alias("incident_type"), F.date_add(F.lit(day), (F.col("id") % 700).cast("int")).alias("incident_date"), F.lit("major").alias("severity"),
                          F.lit(2.0).alias("claim_amount"), F.lit(None).cast("boolean").alias("at_fault"))
    locations = base.select("policy_id", F.lit("CA").alias("state"), F.col("id").cast("string").alias("zip_code"))
    vocab = features.fit_vocabulary(drivers, vehicles, history, locations)
    rows = features.child_parts(features.stack_tables(policies, drivers, vehicles, history, locations), POLICY_AS_OF)
    got = features.fold_policies(rows, vocab, POLICY_AS_OF).collect()
    assert sorted(str(r.policy_id) for r in got) == ["1", "2", "2", "3", "None"]
    want = {}
    for child in (features.numeric_stats(features.driver_features(drivers, vocab, POLICY_AS_OF), "driver", "num_drivers"),
                  features.numeric_stats(features.vehicle_features(vehicles, vocab, POLICY_AS_OF), "vehicle", "num_vehicles"),
                  features.numeric_stats(features.location_features(locations, vocab), "location", "num_locations"), features.history_features(history, POLICY_AS_OF)):
        for r in child.where("policy_id IS NOT NULL").collect():
            want.setdefault(r.policy_id, {}).update(r.asDict())
    for r in got:
        for c, v in want.get(r.policy_id, {}).items():
            w = r[c]
            assert (v != v and w != w) or abs(v - w) <= 1e-9 * (1 + abs(v)), (r.policy_id, c, v, w)
        if r.policy_id in (3, None):
            assert r.num_drivers == 0 and r.driver_driver_age_mean == 0 and r.years_since_last_incident == 10 and r.credit_score == 700
