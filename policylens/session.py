"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Settings every job relies on: UTC so dates and timestamps agree with the
# warehouse tables, AQE so shuffle partition counts and skewed joins are
# re-planned from runtime statistics.
BASE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Client-side call-site capture for error messages costs several JVM
    # round trips per Column function; plans here build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # HotSpot does not JIT methods above 8000 bytes of bytecode; whole-stage
    # code that large runs interpreted, so such stages fall back to
    # per-operator code (the value Spark documents for HotSpot).
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # After a shuffle, join by hash instead of sort when AQE has measured every
    # partition below this size (sort-merge stays the plan beyond it).
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64MB",
    # The driver keeps a description of every finished SQL execution; plans
    # here are wide, so keep few and cap the stored plan text.
    "spark.sql.ui.retainedExecutions": "20",
    "spark.sql.maxPlanStringLength": "100000",
    # Remove checkpoint files once the DataFrame that owns them is gone.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "policylens", extra: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(BASE_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    fast_builds(spark)
    checkpoint_dir(spark)
    return spark


def _set_if(spark: SparkSession, key: str, value: str, when) -> None:
    """Set a runtime SQL setting when ``when(current)`` holds; never fail."""
    try:
        if when(spark.conf.get(key, None)):
            spark.conf.set(key, value)
    except Exception:  # noqa: BLE001 - a setting we cannot change is left as is
        pass


def fast_builds(spark: SparkSession) -> None:
    """Settings for a session made elsewhere (e.g. by a test harness).

    Call-site capture is a static setting there, so it is switched off on
    the Python client itself (it only affects error messages). The codegen
    method limit, the stored plan text, the hash-join threshold and the bytes a task reads are
    runtime settings and are set only while they still have Spark's defaults.
    """
    import pyspark.errors.utils as _u
    if hasattr(_u, "_enable_debugging_cache"):
        _u._enable_debugging_cache = False
    _set_if(spark, "spark.sql.codegen.hugeMethodLimit", "8000", lambda v: v in (None, "65535"))
    _set_if(spark, "spark.sql.maxPlanStringLength", "100000",
            lambda v: v is None or (v.rstrip("b").isdigit() and int(v.rstrip("b")) > 100000))
    _set_if(spark, "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", "64MB",
            lambda v: v in (None, "0", "0b"))
    # Wide rows take some fifteen times the bytes of their files once they are read, and trainers keep a task's rows.
    _set_if(spark, "spark.sql.files.maxPartitionBytes", "32m", lambda v: v in (None, "134217728b", "134217728", "128MB", "128m"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; that value is used as is.
    Only a local session without that setting gets a scratch folder of this
    machine; elsewhere other machines could not see it, so that is an error.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = spark.sparkContext.getCheckpointDir()
    if not path:
        if not spark.sparkContext.master.startswith(("local[", "local-cluster[")) and spark.sparkContext.master != "local":
            raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")
        path = tempfile.mkdtemp(prefix="policylens-ckpt-")
        spark.conf.set("spark.checkpoint.dir", path)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)
    return path


def settle(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it back.

    This cuts lineage, and the planner then knows the table's size in bytes:
    it is broadcast below ``spark.sql.autoBroadcastJoinThreshold``, before
    anything is shuffled, and joined by shuffle beyond. Zstandard: wide rows repeat what Snappy leaves in.
    """
    path = os.path.join(checkpoint_dir(df.sparkSession), "tables", f"{name}-{uuid.uuid4().hex[:12]}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
