"""Stored policy tables, bucketed and sorted by ``policy_id``, so that per-policy work needs no shuffle.

All five tables have the same number of buckets. A task then reads the same
bucket of each: the per-policy aggregates and the joins between them find
their rows in place, and Spark plans no exchange. Buckets are sized by rows at
writing time; a table lies in the shared folder and its entry in the session's catalog.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from policylens.sources.sinks import new_path

NAMES = ("policies", "drivers", "vehicles", "history", "locations")


@dataclass(frozen=True)
class StoredTables:
    """Catalog names of the five tables, by their argument names of ``features.policy_features``."""

    names: dict[str, str]
    buckets: int

    def read(self, spark: SparkSession) -> dict[str, DataFrame]:
        return {k: spark.table(n) for k, n in self.names.items()}

    def drop(self, spark: SparkSession) -> None:
        for n in self.names.values():
            spark.sql(f"DROP TABLE IF EXISTS {n}")


def bucket_count(rows: int, per_bucket: int = 2_000_000, least: int = 8) -> int:
    """Buckets so that the longest table has about ``per_bucket`` rows in each."""
    return max(least, -(-rows // per_bucket))


def store(tables: dict[str, DataFrame], key: str = "policy_id", buckets: int | None = None, prefix: str = "stored") -> StoredTables:
    """Write the tables by ``key``: rows are dealt to buckets once, so each bucket is one sorted file."""
    spark = next(iter(tables.values())).sparkSession
    run = uuid.uuid4().hex[:12]
    n = buckets or bucket_count(max(t.count() for t in tables.values()))
    names = {}
    for name, rows in tables.items():
        names[name] = f"{prefix}_{name}_{run}"
        (rows.repartition(n, key).write.bucketBy(n, key).sortBy(key).format("parquet")
         .option("path", new_path(spark, names[name])).saveAsTable(names[name]))
    return StoredTables(names, n)
