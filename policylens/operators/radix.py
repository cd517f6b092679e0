"""Exact selection of text keys by their bytes, without ranking rows.

``kth_text`` finds, per group, the text of 0-based rank ``k`` in byte order
(the order of Spark's own text comparison). A pass looks at the two bytes that
follow the prefix settled so far: they are counted per group by a hash
aggregate (partial counts before the shuffle, at most 65,793 rows a group),
the pair that holds the rank joins the prefix, and so do the six bytes behind it
where all texts of that pair share them. Texts outside the prefix take no
further part. It ends when one text is left, or equal ones alone. A million
random ids take three or four passes; the passes grow with the logarithm of the
rows, and with the length of what ids share only by an eighth.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policylens.session import settle

STEP, AHEAD = 2, 6


def kth_text(values: DataFrame, group_cols: list[str], text_col: str, ranks: DataFrame) -> DataFrame:
    """Per group of ``ranks`` (group columns and ``k``): ``value``, the text of that rank among the group's non-null texts.

    One rank a group, under the group's count. ``values`` is read once a pass and should be narrow and settled.
    """
    g = list(group_cols)
    texts = values.where(F.col(text_col).isNotNull()).select(*g, F.col(text_col).cast("string").cast("binary").alias("_b"))
    empty = F.lit("").cast("binary")
    state = ranks.select(*g, F.col("k").cast("long").alias("_k"), empty.alias("_prefix"), F.lit(False).alias("_done"))
    turn, length = 0, F.length("_prefix")
    inside = F.substring("_b", 1, length) == F.col("_prefix")
    while True:
        state = settle(state, f"radix-{turn}")  # one row a group
        turn += 1
        if state.where("NOT _done").isEmpty():
            break
        tail = F.substring("_b", length + STEP + 1, F.lit(AHEAD))
        near = (texts.join(state.where("NOT _done"), g).where(inside)
                .select(*g, "_k", "_prefix", F.substring("_b", length + 1, F.lit(STEP)).alias("_next"), F.length(tail).alias("_size"),
                        F.conv(F.rpad(F.hex(tail), 2 * AHEAD, "0"), 16, 10).cast("long").alias("_tail")))
        counts = near.groupBy(*g, "_k", "_prefix", "_next").agg(
            F.count(F.lit(1)).alias("_n"), F.min("_tail").alias("_low"), F.max("_tail").alias("_high"), F.min("_size").alias("_size"))
        before = F.coalesce(F.sum("_n").over(Window.partitionBy(*g).orderBy("_next").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        chosen = counts.withColumn("_before", before).where((F.col("_before") <= F.col("_k")) & (F.col("_k") < F.col("_before") + F.col("_n")))
        shared = (F.col("_low") == F.col("_high")) & (F.col("_size") == AHEAD)
        grown = F.concat("_prefix", "_next", F.when(shared, F.unhex(F.lpad(F.hex("_low"), 2 * AHEAD, "0"))).otherwise(empty))
        step = chosen.select(*g, (F.col("_k") - F.col("_before")).alias("_k"), grown.alias("_prefix"),
                             ((F.col("_n") == 1) | (F.length("_next") < STEP)).alias("_done"))
        state = state.where("_done").unionByName(step)
    left = texts.join(state, g).where(inside)  # one text of each group, or equal ones, or the prefix itself
    return left.groupBy(*g).agg(F.min(F.struct(F.length("_b").alias("n"), F.col("_b").alias("b")))["b"].cast("string").alias("value"))
