"""What the two classifiers share: labelled samples of bounded size, and models fitted inside a task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo 3; 1 is held out, null ids too."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3, F.lit(1))


def sample(labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """(doc_id, label): at most ``per_class`` ids of each class (0, 1) outside the held-out fold, the first by a hash of the id.

    Null labels are none; an id labelled twice counts once, with its larger label.
    """
    rows = (labels.where(labels["doc_id"].isNotNull() & labels[label].isin(0, 1) & (fold_of(labels["doc_id"]) != 1))
            .groupBy(labels["doc_id"].cast("long").alias("doc_id")).agg(F.max(labels[label]).cast("int").alias("label")))
    parts = [rows.where(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(per_class) for k in (0, 1)]
    return parts[0].unionAll(parts[1])


def labelled(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """(text, label) of the picked ids; ``picked`` is bounded, so it is broadcast. One row for an id, the first text by order."""
    p = F.broadcast(picked.withColumnRenamed("doc_id", "_id"))
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].alias("text")).join(p, F.col("doc_id") == F.col("_id"))
    return rows.groupBy("doc_id").agg(F.min("text").alias("text"), F.first("label").alias("label")).orderBy(F.xxhash64("doc_id"), "doc_id")
