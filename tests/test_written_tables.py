"""Tables that a run writes for itself: whole, and compressed for what they repeat."""

import glob

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from policylens.sources import sinks


def codecs(path):
    files = glob.glob(f"{path}/*.parquet")
    return {pq.ParquetFile(f).metadata.row_group(0).column(i).compression for f in files for i in range(pq.ParquetFile(f).metadata.num_columns) if pq.ParquetFile(f).metadata.num_rows}


def test_training_data_is_compressed_and_whole(spark, tmp_path):
    nested = spark.range(50).select(F.col("id").alias("policy_id"), F.array(F.struct(F.lit("x").alias("first_name"))).alias("drivers"))
    rows = sinks.training_data(nested, spark.range(50).select(F.col("id").alias("policy_id"), F.lit(1.5).alias("premium")))
    path = str(tmp_path / "t")
    assert sinks.write_training_data(rows, path) == 50
    assert codecs(path) == {"ZSTD"}
    back = {r.policy_id: r.policy_data for r in spark.read.parquet(path).collect()}
    assert len(back) == 50 and back[7] == '{"policy_id":7,"drivers":[{"first_name":"x"}]}'


def test_settled_tables_are_compressed(spark):
    from policylens.session import settle
    t = settle(spark.range(100).select(F.lit("a long text that every row repeats").alias("c")), "codec")
    assert codecs(t.inputFiles()[0].replace("file://", "").rsplit("/", 1)[0]) == {"ZSTD"} and t.count() == 100


def test_category_cells_exchange_children_once(spark):
    from policylens.operators import sparse_features as SF
    d = spark.createDataFrame([(1, "m", "x"), (1, "f", None), (2, None, "x"), (2, "m", "x")], "policy_id long, gender string, marital_status string")
    v = spark.createDataFrame([(1, "u"), (3, None)], "policy_id long, primary_use string")
    loc = spark.createDataFrame([(1, "CA"), (1, None), (2, "NY")], "policy_id long, state string")
    children = {"drivers": d, "vehicles": v, "locations": loc}
    pairs = sorted(map(repr, SF._pairs(children).collect()))
    assert sorted(map(repr, SF._pairs_by_policy(children).collect())) == pairs and len(pairs) == 10
    spec = SF.SparseSpec.of(SF.fit_categories(d, v, loc), ["one"])
    plan = SF._category_cells(children, spec)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning(policy_id") == 1 and "Exchange hashpartitioning(policy_id#" in plan and plan.count("Exchange hashpartitioning") == 1


def test_sorted_names_are_joined_as_their_structs_would_be(spark):
    from policylens.operators import metrics as MT
    rows = spark.createDataFrame([("a", 1, [0.00001, -2.0, 1.0]), ("b", 1, [3.0, -4.0]), ("a", 2, [1.0, -1.0, 0.5])], "model_id string, policy_id long, contributions array<double>")
    names = {"a": ["x", "y", "z"], "b": ["y", "w"]}
    structs = MT.sort_arrays_by_abs(rows, names, by="model_id", digits=4, out="items")
    want = {(r.model_id, r.policy_id): ",".join(i.name for i in r["items"]) for r in structs.collect()}
    got = {(r.model_id, r.policy_id): r.text for r in MT.sort_arrays_by_abs(rows, names, by="model_id", digits=4, out="text", joined=",").collect()}
    assert got == want == {("a", 1): "y,z,x", ("b", 1): "w,y", ("a", 2): "x,y,z"}


def test_tasks_read_few_bytes_of_wide_rows(spark):
    from policylens.session import fast_builds
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128MB")
    fast_builds(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("32m", "33554432b")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16m")  # a session's own choice stays
    fast_builds(spark)
    assert spark.conf.get("spark.sql.files.maxPartitionBytes") in ("16m", "16777216b")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "32m")
