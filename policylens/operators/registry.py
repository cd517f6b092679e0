"""Model registry, audits and log statistics.

Plain Parquet has no UPDATE, so the registry is an append-only event table
(one row per registration, ``seq`` = registration order, claimed by ``next_sequence``). Current state is
derived: a model is active iff it was registered with ``activate`` and no
later registration activated another model (activation deactivates every
other model, across names).
"""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from policylens.functions import exprs as X


def next_sequence(spark: SparkSession, folder: str) -> int:
    """A number that no other caller gets, above all that were there: an empty file of that name is created if absent.

    Whoever creates it first has the number, the others try the next one, so registrations at one time are
    ordered without clocks. The file system must create files exclusively, as HDFS does; local files are created by ``java.nio``, which does too.
    """
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path
    fs = path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    fs.mkdirs(path(folder))
    n = max((int(f.getPath().getName()) for f in fs.listStatus(path(folder)) if f.getPath().getName().isdigit()), default=0)
    while True:
        n += 1
        at = path(folder, f"{n:012d}")
        try:
            if fs.getScheme() == "file":
                jvm.java.nio.file.Files.createFile(jvm.java.io.File(at.toUri().getPath()).toPath(), spark.sparkContext._gateway.new_array(jvm.java.nio.file.attribute.FileAttribute, 0))
            else:
                fs.create(at, False).close()
            return n
        except Py4JJavaError as e:
            if "FileAlreadyExists" not in e.java_exception.getClass().getName():
                raise


def _order(events: DataFrame, seq: str | None = None):
    """What orders events: their sequence number, then their time, where present, then the id."""
    return F.struct(*([seq] if seq else [c for c in ("seq", "created_at") if c in events.columns]), "model_id")


def register_state(events: DataFrame, seq: str | None = None) -> DataFrame:
    """G1: current registry state from registration events, one row per model.

    Names and versions are those of a model's last event; the model of the
    last activating event is active. ``seq`` names another ordering column.
    """
    at = _order(events, seq)
    last = events.where(F.col("activate")).agg(F.max_by("model_id", at).alias("_last")).withColumn("_k", F.lit(1))
    e = events.groupBy("model_id").agg(F.max_by(F.struct("model_name", "model_version"), at).alias("_e")).withColumn("_k", F.lit(1))
    e = e.join(F.broadcast(last), "_k", "left")  # one row
    return e.select("model_id", "_e.model_name", "_e.model_version",
                    F.coalesce(F.col("model_id") == F.col("_last"), F.lit(False)).alias("is_active"))


def active_model(state: DataFrame) -> DataFrame:
    """The active model (zero or one row)."""
    return state.where(F.col("is_active")).select("model_id", "model_name", "model_version")


def metrics_pivot(metrics: DataFrame, names=("mae", "mse", "r2", "rmse")) -> DataFrame:
    """One row per model with one column per metric; when a metric
    was written twice the later row (higher metric_id) wins."""
    latest = metrics.groupBy("model_id", "metric_name").agg(
        F.max_by("metric_value", "metric_id").alias("metric_value"))
    return latest.groupBy("model_id").pivot("metric_name", list(names)).agg(F.first("metric_value"))


def metrics_map(metrics: DataFrame) -> DataFrame:
    """A19 as a map column per model."""
    latest = metrics.groupBy("model_id", "metric_name").agg(
        F.max_by("metric_value", "metric_id").alias("metric_value"))
    return latest.groupBy("model_id").agg(
        F.map_from_entries(F.collect_list(F.struct("metric_name", "metric_value"))).alias("metrics"))


def fk_orphans(children: dict[str, DataFrame], parents: DataFrame, key: str = "model_id") -> DataFrame:
    """Per child table, keys with no parent row (left anti join) and their row counts."""
    p = parents.select(F.col(key).cast("string").alias(key)).distinct()
    out = None
    for name, df in children.items():
        o = (df.select(F.col(key).cast("string").alias(key)).join(p, key, "left_anti")
             .groupBy(key).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("source"), key, "n"))
        out = o if out is None else out.unionByName(o)
    return out


def unique_violations(tables: dict[str, tuple[DataFrame, list[str]]]) -> DataFrame:
    """Key values that occur more than once, per table."""
    out = None
    for name, (df, keys) in tables.items():
        k = F.concat_ws("|", *[F.col(c).cast("string") for c in keys])
        v = (df.groupBy(k.alias("key")).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
             .select(F.lit(name).alias("source"), "key", "n"))
        out = v if out is None else out.unionByName(v)
    return out


def model_id_by_version(versions: DataFrame, lookups: DataFrame, version_col: str = "model_version") -> DataFrame:
    """Resolve model ids by version string (equi-join; versions are unique)."""
    return lookups.join(versions.select(F.col("model_version").alias(version_col),
                                        F.col("model_id").alias("resolved_model_id")), version_col, "left")


def recent_versions(versions: DataFrame, limit: int = 10) -> DataFrame:
    """Newest versions first, by their time where present, at most ``limit`` (a top-k report)."""
    by = [c for c in ("created_at", "model_version", "model_id") if c in versions.columns]
    return versions.orderBy(*[F.col(c).desc() for c in by]).limit(limit)


def version_listing(events: DataFrame, metrics: DataFrame, limit: int = 10, root: str = "models") -> DataFrame:
    """W3 as the service lists it: the newest versions with path, flag, metrics and time, newest first (a top-k report)."""
    top = recent_versions(events.drop("activate"), limit)
    rows = top.join(register_state(events).select("model_id", "is_active"), "model_id").join(model_paths(top, root), "model_id")
    rows = rows.join(metrics_pivot(metrics), "model_id", "left")
    return rows.orderBy(F.desc("created_at"), F.desc("model_version"), F.desc("model_id"))


def model_paths(versions: DataFrame, root: str = "models") -> DataFrame:
    return versions.select("model_id", F.concat(F.lit(root + "/"), F.col("model_name"), F.lit("_"),
                                                F.col("model_version"), F.lit("/model")).alias("model_path"))


def parse_model_paths(paths: DataFrame) -> DataFrame:
    """F32: (name, version) parsed from saved model paths."""
    name, version = X.model_path_parts("model_path")
    return paths.select("model_id", "model_path", name.alias("parsed_name"), version.alias("parsed_version"))


def latest_model(paths: DataFrame) -> DataFrame:
    """Latest saved model per name (highest version)."""
    p = parse_model_paths(paths)
    return p.groupBy("parsed_name").agg(F.max("parsed_version").alias("latest_version"),
                                        F.max_by("model_path", "parsed_version").alias("latest_path"))


def importance_rows(importance: DataFrame) -> DataFrame:
    """One row per (model, feature) with its value as given; where it was written twice
    (which J10 reports) the later row, with the higher feature_id, wins."""
    return importance.groupBy("model_id", "feature_name").agg(F.max_by("importance", "feature_id").alias("importance"))


def top_features(importance: DataFrame, k: int = 20) -> DataFrame:
    """Top-k features per model by importance (ties by name)."""
    w = Window.partitionBy("model_id").orderBy(F.col("importance").desc(), F.col("feature_name"))
    return importance.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def pricing_statistics(history: DataFrame) -> DataFrame:
    """Daily request count and premium statistics per model."""
    day = F.date_trunc("day", F.col("created_at").cast("timestamp")).cast("date")
    return history.groupBy("model_id", day.alias("request_date")).agg(
        F.count(F.lit(1)).alias("request_count"), F.avg("final_premium").alias("avg_premium"),
        F.min("final_premium").alias("min_premium"), F.max("final_premium").alias("max_premium"),
        F.stddev_samp("final_premium").alias("stddev_premium"))
