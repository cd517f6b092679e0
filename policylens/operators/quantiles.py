"""Exact order statistics without sorting a whole group in one task.

``kth_smallest`` finds, per group, the value of 0-based rank ``k`` among the
non-null values of a numeric column, and never ranks a whole group. The values are written once as a narrow column, and that is read twice:

1. One aggregate gives each group's count, ends and a mergeable quantile sketch (KLL). The sketch brackets
   the rank: two values between which about ``2 * (MARGIN + 1 / GRID)`` of the group's values lie, at most.
2. One aggregate counts the values below the bracket and each value inside it. Equal values are one row.

The counts say for certain whether the bracket holds the rank, so the answer never depends on the sketch's
luck; a bracket that misses (or holds no number) is replaced by the group's whole range. What is left are the
bracket's different values: each further pass splits an interval that is still long into ``buckets`` buckets, of equal width and of equal ratio in
turn, so that values over many magnitudes are told apart as well as close ones, sums the counts by bucket, and keeps the one bucket
that holds the rank. The bucket function is monotone in the value, so the
next interval is exactly [min, max] of that bucket. Once an interval is a
single value, or holds at most ``finish_rows`` different values, these are ranked directly (a bounded window).

A group holding a third of all rows is sketched and counted on the map
side like any other. This serves medians and quartiles (exact, linear
interpolation like ``percentile``), the time-ordered split at row n//2
(W1) and the exact-size train/test split (W7).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from policylens.session import settle

BUCKETS = 4096
FINISH_ROWS = 50_000
SKETCH = 1024     # size of a sketch: at most some 30 KB, with ranks within 0.3 % in 99 of 100 cases
GRID = 512        # places of the sketch that are read
MARGIN = 0.0055   # how far a bracket reaches beyond the rank on each side, as a share of the values


def _scaled(v):
    """A value's signed logarithm: never falls as the value grows; infinities and NaN (the largest) included."""
    size = F.when(v == 0, F.lit(0.0)).when(F.isnan(v), F.lit(4000.0)).when(F.abs(v) == float("inf"), F.lit(2000.0)).otherwise(F.log(F.abs(v)) + 746.0)
    return F.when(v < 0, -size).otherwise(size)


def _share(v, lo, hi, by_ratio: bool):
    """Where v lies between lo and hi, 0 to 1; never falls as v grows. An endless interval is always taken by ratio."""
    plain = ~(F.isnan(hi) | (F.abs(hi) == float("inf")) | (F.abs(lo) == float("inf")))
    width, ratio = hi / 2 - lo / 2, _scaled(hi) - _scaled(lo)
    linear = F.when(width > 0, (v / 2 - lo / 2) / width).otherwise(F.when(v == hi, 1.0).otherwise(0.0))
    scaled = F.when(ratio > 0, (_scaled(v) - _scaled(lo)) / ratio).otherwise(0.0)
    return F.when(plain & F.lit(not by_ratio), linear).otherwise(scaled)


def bucket_of(v, lo, hi, by_ratio: bool, buckets: int = BUCKETS):
    """The bucket of v, 0 to buckets - 1; lo and hi, where they differ, are never in one bucket of a linear turn."""
    return F.least(F.floor(_share(v, lo, hi, by_ratio) * F.lit(float(buckets))), F.lit(buckets - 1)).cast("int")


def sketch_of(v):
    """Aggregate: the mergeable sketch of a column's values; nulls and NaN are not in it."""
    return F.kll_sketch_agg_double(v.cast("double"), SKETCH)


def grid_of(sketch):
    """The values at GRID + 1 evenly spaced ranks of a sketch that holds values."""
    return F.kll_sketch_get_quantile_double(sketch, F.array(*[F.lit(i / GRID) for i in range(GRID + 1)]))


def bracket(sketch, k, lo, hi):
    """Two values between which the value of rank ``k`` should lie; ``lo`` and ``hi`` are the least and the largest value."""
    n = F.kll_sketch_get_n_double(sketch)
    # The function takes constant ranks only: a grid of them, from which the places around the rank are taken.
    grid = grid_of(sketch)
    below, above = (k - 2) / n - F.lit(MARGIN), (k + 3) / n + F.lit(MARGIN)
    return (F.when((n == 0) | (below <= 0), lo).otherwise(F.get(grid, F.least(F.floor(below * GRID), F.lit(GRID)).cast("int"))),
            F.when((n == 0) | (above >= 1), hi).otherwise(F.get(grid, F.ceil(above * GRID).cast("int"))))


def counted(inside: DataFrame, key: list[str]) -> DataFrame:
    """Written counts of bracketed values: ``key`` + ``_v`` (null: below the bracket) + ``_c``. ``inside`` has ``_v`` and the brackets' ``_lo``, ``_hi``."""
    return settle(inside.where(F.col("_v") <= F.col("_hi")).groupBy(*key, F.when(F.col("_v") >= F.col("_lo"), F.col("_v")).alias("_v"))
                  .agg(F.count(F.lit(1)).alias("_c")), "brackets")


def rank_state(counts: DataFrame, asked: DataFrame, on: list[str], rank: str = "k") -> DataFrame:
    """For each row of ``asked``: the rank inside its bracket, the ends and number of different values there, and whether it holds the rank."""
    seen = counts.groupBy(*on).agg(F.sum(F.when(F.col("_v").isNull(), F.col("_c")).otherwise(0)).alias("_below"), F.sum("_c").alias("_upto"),
                                    F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("_v").alias("_n"))
    state = asked.join(seen, on, "left")
    held = F.coalesce((F.col(rank) >= F.col("_below")) & (F.col(rank) < F.col("_upto")), F.lit(False))
    return state.withColumn("_kr", F.col(rank) - F.col("_below")).withColumn("_held", held).drop("_below", "_upto")


def select_rank(counts: DataFrame, state: DataFrame, key: list[str], buckets: int = BUCKETS, finish_rows: int = FINISH_ROWS,
                on: list[str] | None = None) -> DataFrame:
    """``key`` + ``value`` + ``ties_before``: the value whose counts, added up in order, pass rank ``_kr`` of its key.

    ``counts``: ``on`` (columns of the key, by default all) + ``_v`` + ``_c``, written; ``state``: key + ``_lo``, ``_hi``, ``_kr``, ``_n``.
    """
    on = on or key
    settled_flag = (F.col("_lo") == F.col("_hi")) | (F.col("_n") <= finish_rows)
    done_parts = []
    turn = 0
    while True:
        # One row per key; written, so that lineage is cut and its size in bytes decides how it is joined.
        state = settle(state.select(*key, "_lo", "_hi", "_kr", "_n"), "ranks")
        done_parts.append(state.where(settled_flag))
        active = state.where(~settled_flag)
        if active.isEmpty():
            break
        b = bucket_of(F.col("_v"), F.col("_lo"), F.col("_hi"), turn % 2 == 1, buckets)
        turn += 1
        sums = (counts.join(active, on, "inner").where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi")))
                .groupBy(*key, "_kr", b.alias("_b"))
                .agg(F.sum("_c").alias("_c"), F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_mn"), F.max("_v").alias("_mx")))
        cum = sums.withColumn("_cum", F.sum("_c").over(Window.partitionBy(*key).orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)))
        chosen = cum.where((F.col("_cum") - F.col("_c") <= F.col("_kr")) & (F.col("_kr") < F.col("_cum")))
        state = chosen.select(*key, F.col("_mn").alias("_lo"), F.col("_mx").alias("_hi"), (F.col("_kr") - (F.col("_cum") - F.col("_c"))).alias("_kr"), "_n")
    settled = reduce(DataFrame.unionByName, done_parts)
    single = settled.where(F.col("_lo") == F.col("_hi")).select(*key, F.col("_lo").alias("value"), F.col("_kr").alias("ties_before"))
    # Rank the at most ``finish_rows`` different values left in each small interval.
    rows = (counts.join(settled.where(F.col("_lo") != F.col("_hi")), on, "inner")
            .where((F.col("_v") >= F.col("_lo")) & (F.col("_v") <= F.col("_hi"))))
    upto = F.sum("_c").over(Window.partitionBy(*key).orderBy("_v").rowsBetween(Window.unboundedPreceding, 0))
    less = F.col("_upto") - F.col("_c")
    picked = rows.withColumn("_upto", upto).where((less <= F.col("_kr")) & (F.col("_kr") < F.col("_upto"))).select(
        *key, F.col("_v").alias("value"), (F.col("_kr") - less).alias("ties_before"))
    return settle(single.unionByName(picked), "ranked")


def kth_smallest(values: DataFrame, group_cols: list[str], value_col: str, ranks: DataFrame,
                 buckets: int = BUCKETS, finish_rows: int = FINISH_ROWS) -> DataFrame:
    """Per group and requested rank: the k-th smallest value.

    ``values``: group columns + ``value_col`` (numeric; nulls ignored).
    ``ranks``: group columns + ``k`` (long, 0-based, must be < group count).
    Returns group columns + ``k`` + ``value`` (double) + ``ties_before``: how
    many values equal to ``value`` rank before position ``k``.
    """
    if not group_cols:  # one global group: a constant key keeps every join an equi-join
        out = kth_smallest(values.withColumn("_all", F.lit(0)), ["_all"], value_col,
                           ranks.withColumn("_all", F.lit(0)), buckets, finish_rows)
        return out.drop("_all")
    return _kth(_narrow(values, group_cols, value_col), list(group_cols), ranks, buckets, finish_rows)


def _narrow(values: DataFrame, g: list[str], value_col: str) -> DataFrame:
    """The values to read twice, written once: group columns + ``_v``. What they are computed from is read once, whatever it costs."""
    return settle(values.select(*g, F.col(value_col).cast("double").alias("_v")).where(F.col("_v").isNotNull()), "values")


def _kth(v: DataFrame, g: list[str], ranks: DataFrame, buckets: int = BUCKETS, finish_rows: int = FINISH_ROWS) -> DataFrame:
    key = [*g, "k"]
    bounds = v.groupBy(*g).agg(F.min("_v").alias("_min"), F.max("_v").alias("_max"), sketch_of(F.col("_v")).alias("_sketch"))
    asked = ranks.select(*g, F.col("k").cast("long").alias("k")).join(bounds, g, "inner")
    low, high = bracket(F.col("_sketch"), F.col("k"), F.col("_min"), F.col("_max"))
    asked = settle(asked.select(*key, low.alias("_lo"), high.alias("_hi"), "_min", "_max"), "bounds")
    counts = counted(v.join(asked.select(*key, "_lo", "_hi"), g), key)
    state = settle(rank_state(counts, asked.drop("_lo", "_hi"), key), "held")
    out = select_rank(counts, state.where("_held"), key, buckets, finish_rows)
    missed = state.where("NOT _held").select(*key, F.col("_min").alias("_lo"), F.col("_max").alias("_hi"))
    if not missed.isEmpty():
        whole = counted(v.join(missed, g), key)
        again = rank_state(whole, missed.select(*key), key).where("_held")
        out = out.unionByName(select_rank(whole, again, key, buckets, finish_rows))
    return out


def exact_percentiles(values: DataFrame, group_cols: list[str], value_col: str, probs: list[float],
                      names: list[str] | None = None) -> DataFrame:
    """Exact percentiles with linear interpolation (same as ``percentile``).

    Returns group columns + one column per probability.
    """
    if not group_cols:
        out = exact_percentiles(values.withColumn("_all", F.lit(0)), ["_all"], value_col, probs, names)
        return out.drop("_all")
    g = list(group_cols)
    names = names or [f"p{int(round(p * 100))}" for p in probs]
    v = _narrow(values, g, value_col)
    counts = v.groupBy(*g).agg(F.count(F.lit(1)).alias("_n"))
    pos = [(i, p) for i, p in enumerate(probs)]
    ranks = None
    for i, p in pos:
        x = F.lit(float(p)) * (F.col("_n") - 1).cast("double")
        part = counts.select(*g, F.lit(i).alias("_i"), x.alias("_pos"))
        ranks = part if ranks is None else ranks.unionByName(part)
    ranks = ranks.select(*g, "_i", "_pos", F.floor("_pos").cast("long").alias("_klo"),
                         F.ceil("_pos").cast("long").alias("_khi"))
    need = (ranks.select(*g, F.col("_klo").alias("k"))
            .unionByName(ranks.select(*g, F.col("_khi").alias("k"))).distinct())
    kv = _kth(v, g, need)
    lo = kv.select(*g, F.col("k").alias("_klo"), F.col("value").alias("_vlo"))
    hi = kv.select(*g, F.col("k").alias("_khi"), F.col("value").alias("_vhi"))
    r = ranks.join(lo, g + ["_klo"]).join(hi, g + ["_khi"])
    interp = F.col("_vlo") + (F.col("_pos") - F.col("_klo")) * (F.col("_vhi") - F.col("_vlo"))
    r = r.select(*g, "_i", F.when(F.col("_klo") == F.col("_khi"), F.col("_vlo")).otherwise(interp).alias("_q"))
    out = r.groupBy(*g).pivot("_i", list(range(len(probs)))).agg(F.first("_q"))
    return out.select(*g, *[F.col(str(i)).alias(n) for i, n in enumerate(names)])
