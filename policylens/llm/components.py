"""Connected components of an edge table, as (id, label) with the smallest id of each component."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.session import checkpoint_dir


def connected_components(edges: DataFrame) -> DataFrame:
    """Label every id of ``edges`` (a, b) with the smallest id that it reaches.

    Each round takes the least label among neighbours (a min aggregate,
    combined before the shuffle, so a hub is no hot task) and then the label
    of that label, which doubles the distance covered. The rounds end when no
    label changes. State is cut by ``checkpoint()``; only edges and labels
    move, never texts, and nothing but one count reaches the driver.
    """
    spark = edges.sparkSession
    checkpoint_dir(spark)
    both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct().checkpoint(True)
    state = both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select("id", F.least("id", "m").alias("label")).checkpoint(True)
    while True:
        near = (both.join(state.withColumnRenamed("id", "b"), "b").groupBy(F.col("a").alias("id")).agg(F.min("label").alias("m")))
        step = state.join(near, "id").select("id", F.col("label").alias("old"), F.least("label", "m").alias("label"))
        jump = step.select(F.col("id").alias("label"), F.col("label").alias("next"))
        step = step.join(jump, "label").select("id", "old", F.least("label", "next").alias("label")).checkpoint(True)
        moved = step.where(F.col("old") != F.col("label")).limit(1).count()
        state = step.select("id", "label")
        if not moved:
            return state
