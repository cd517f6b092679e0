"""Shared column rules for texts, row identity, checked broadcasts and scratch tables.

Words are maximal runs of characters other than space, tab, line feed,
vertical tab, form feed and carriage return. A null text has no words.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from policylens.session import checkpoint_dir

SPACES = " \t\n\x0b\x0c\r"
SPLIT = r"[ \t\n\x0B\f\r]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Rows of two or three numbers that may be broadcast; beyond, a shuffled join is used.
BROADCAST_ROWS = 500_000


def words(text: Column) -> Column:
    """The words of a text as an array; empty for a null or blank text."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPLIT, -1))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def text_key(text: Column) -> Column:
    """Identifies a row's text beside its doc_id, so that rows with one doc_id
    and different texts stay apart, and repeated rows share their result."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def internal(df: DataFrame, **cols: Column) -> DataFrame:
    """Only the given columns, so that columns of the input whose names clash with ours never meet them."""
    return df.select(*[c.alias(name) for name, c in cols.items()])


def same_row(a: DataFrame, b: DataFrame) -> Column:
    return a["doc_id"].eqNullSafe(b["doc_id"]) & (a["tkey"] == b["tkey"])


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` marked for broadcast where its counted ``rows`` are few enough; else as it is (a shuffled join)."""
    return F.broadcast(df) if rows <= limit else df


class Scratch:
    """Intermediate Parquet tables in the shared checkpoint folder.

    ``put`` writes a table once and rereads it, which cuts the lineage:
    a lost executor costs the running stage only. ``drop`` deletes tables
    that nothing will read again; ``keep`` is for the ones a returned, lazy
    result still needs, written by ``checkpoint()`` so that Spark's cleaner
    removes them together with that result.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
        self.paths: list[str] = []

    def path(self, name: str) -> str:
        self.paths.append(f"{self.base}/{name}")
        return self.paths[-1]

    def put(self, df: DataFrame, name: str) -> DataFrame:
        path = self.path(name)
        df.write.option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def keep(self, df: DataFrame) -> DataFrame:
        checkpoint_dir(self.spark)
        return df.checkpoint(True)

    def drop(self, name: str | None = None) -> None:
        """Delete one table, or all of them."""
        jvm, conf = self.spark._jvm, self.spark._jsc.hadoopConfiguration()
        at = jvm.org.apache.hadoop.fs.Path(self.base if name is None else f"{self.base}/{name}")
        at.getFileSystem(conf).delete(at, True)
        self.paths = [] if name is None else [p for p in self.paths if p != f"{self.base}/{name}"]
