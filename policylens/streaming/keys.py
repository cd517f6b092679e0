"""A primary key over a stream that is never forgotten (T4).

Keys seen are kept in a table of 64-bit key hashes and keys, in folders by
bucket; beside them lies, for each bucket and batch, a Bloom filter of the
keys it added. A batch asks the filters of its buckets first: most new keys are
told new by them alone, and only the others, true repeats and the filters' few errors, are
looked up in the key table, in their buckets. Every batch writes folders of
its own, so a replay after a restart replaces them and finds the same rows new.
"""

from __future__ import annotations

import os
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bits a key in a filter, and probes: one key in a hundred is told "maybe" wrongly.
BITS, PROBES = 10, 7


def _places(h: np.ndarray, size: int) -> np.ndarray:
    """The bits of each key hash in a filter of ``size`` bits."""
    u = h.view(np.uint64)
    step = (u >> np.uint64(32)) | np.uint64(1)
    return ((u[:, None] + np.arange(PROBES, dtype=np.uint64)[None, :] * step[:, None] * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(7)) % np.uint64(size)


def bloom(h: np.ndarray) -> bytes:
    bits = np.zeros(max(64, BITS * len(h)) + 7 & ~7, bool)
    bits[_places(h, len(bits)).ravel()] = True
    return np.packbits(bits).tobytes()


def may_hold(filters: list[bytes], h: np.ndarray) -> np.ndarray:
    """Whether any of the filters may hold each key."""
    out = np.zeros(len(h), bool)
    for f in filters:
        bits = np.unpackbits(np.frombuffer(f, np.uint8))
        out |= bits[_places(h, len(bits))].all(1)
    return out


@dataclass
class KeyTable:
    """The keys of one stream under ``root``; ``buckets`` never change once keys are stored."""

    spark: SparkSession
    root: str
    buckets: int = 64

    def _read(self, name: str, schema: str, batch: int) -> DataFrame:
        """Rows of other batches; none before the first."""
        path = os.path.join(self.root, name)
        jvm = self.spark._jvm
        at = jvm.org.apache.hadoop.fs.Path(path)
        if not at.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(at):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(path).where(F.col("batch") != batch)

    def first_seen(self, rows: DataFrame, key: str, order: str, batch: int) -> DataFrame:
        """The rows of a batch whose ``key`` was in no batch before, one a key: the first by ``order``. Their keys are stored.

        Rows with a null key have no identity and all stay, and nothing of them is stored.
        """
        cols = [F.col(f"`{c}`") for c in rows.columns]
        named = rows.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("_key")).agg(
            F.min_by(F.struct(*cols), F.struct(F.col(order), F.xxhash64(*cols))).alias("_row"))
        named = named.withColumn("_h", F.xxhash64("_key")).withColumn("bucket", F.pmod("_h", F.lit(self.buckets)).cast("int"))
        named = named.checkpoint(True)  # read for the filters, the lookup and the write

        def ask(asked: pa.Table, filters: pa.Table) -> pa.Table:
            h = asked.column("_h").to_numpy()
            maybe = may_hold(filters.column("bits").to_pylist(), h) if len(filters) else np.zeros(len(h), bool)
            return pa.table({"_h": asked.column("_h"), "maybe": pa.array(maybe)})

        filters = self._read("filters", "bits binary, batch int, bucket int", batch).join(named.select("bucket").distinct(), "bucket", "left_semi")
        asked = named.select("_h", "bucket")
        told = asked.groupBy("bucket").cogroup(filters.groupBy("bucket")).applyInArrow(ask, "_h bigint, maybe boolean")
        maybe = named.join(told.where("maybe").select("_h").distinct(), "_h", "left_semi").select("_key", "bucket")
        seen = self._read("keys", "key string, batch int, bucket int", batch)
        repeats = maybe.join(seen.select(F.col("key").alias("_key"), "bucket"), ["bucket", "_key"], "left_semi").select("_key")
        new = named.join(repeats, "_key", "left_anti").checkpoint(True)

        def build(table: pa.Table) -> pa.Table:
            return pa.table({"bits": pa.array([bloom(table.column("_h").to_numpy())], pa.binary()), "bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32())})

        new.select(F.col("_key").alias("key"), "bucket").write.mode("overwrite").partitionBy("bucket").parquet(os.path.join(self.root, "keys", f"batch={batch}"))
        new.select("_h", "bucket").groupBy("bucket").applyInArrow(build, "bits binary, bucket int").write.mode("overwrite").partitionBy("bucket").parquet(
            os.path.join(self.root, "filters", f"batch={batch}"))
        return new.select("_row.*").unionByName(rows.where(F.col(key).isNull()))
