"""Accuracy metrics and column statistics.

Every metric is a grouped aggregate (one row per model or per column);
medians and quartiles use the exact distributed selection rather than a
per-group sort or an in-memory percentile buffer.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens.operators.quantiles import exact_percentiles, kth_smallest


def regression_metrics(df: DataFrame, group: str = "model_id", y: str = "y", p: str = "p") -> DataFrame:
    """M3 + M4 + A17: mse, rmse, mae, r2, mape (x100, zero actuals skipped), medae."""
    err = F.col(y) - F.col(p)
    g = df.groupBy(group).agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(F.try_divide(err, F.col(y)))) * F.lit(100.0)).alias("mape"),
        F.sum(err * err).alias("_sse"), (F.var_pop(F.col(y)) * F.count(F.col(y))).alias("_sst"),
        F.count(F.lit(1)).alias("n"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")))
    med = exact_percentiles(df.select(group, F.abs(err).alias("_ae")), [group], "_ae", [0.5], ["medae"])
    return g.select(group, "mse", F.sqrt("mse").alias("rmse"), "mae", r2.alias("r2"), "mape", "n").join(
        med, group, "left")


def column_summary(df: DataFrame, col: str) -> DataFrame:
    """Mean, median, min, max, population std of one column."""
    base = df.agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
                  F.stddev_pop(col).alias("std"), F.count(col).alias("n"))
    med = exact_percentiles(df.select(col), [], col, [0.5], ["median"])
    return base.withColumn("_k", F.lit(1)).join(F.broadcast(med.withColumn("_k", F.lit(1))), "_k").drop("_k")


def stack(df: DataFrame, cols: list[str], name: str = "column", value: str = "value") -> DataFrame:
    """Wide -> long (column name, value), no shuffle."""
    return df.select(F.explode(F.array(*[F.struct(F.lit(c).alias(name), F.col(f"`{c}`").cast("double").alias(value))
                                         for c in cols])).alias("_s")).select(f"_s.{name}", f"_s.{value}")


def describe(df: DataFrame, cols: list[str]) -> DataFrame:
    """Count, mean, sample std, min, exact quartiles, max per column."""
    long = stack(df, cols)
    base = long.groupBy("column").agg(F.count("value").alias("count"), F.avg("value").alias("mean"),
                                      F.stddev_samp("value").alias("std"), F.min("value").alias("min"),
                                      F.max("value").alias("max"))
    q = exact_percentiles(long, ["column"], "value", [0.25, 0.5, 0.75], ["p25", "p50", "p75"])
    return base.join(q, "column", "left")


def correlations(df: DataFrame, cols: list[str], target: str) -> DataFrame:
    """Pearson correlation of each column with the target (one pass)."""
    row = [F.struct(F.lit(c).alias("column"), F.corr(F.col(c), F.col(target)).alias("correlation")) for c in cols]
    return df.agg(F.array(*row).alias("_a")).select(F.explode("_a").alias("_s")).select("_s.*")


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """Equal-width bins on [min, max], last bin closed; every bin listed."""
    from policylens.operators.monitor import bin_index
    v = F.col(col)
    bounds = df.agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")).withColumn("_k", F.lit(1))
    vals = df.where(v.isNotNull()).withColumn("_k", F.lit(1)).join(F.broadcast(bounds), "_k")
    counts = vals.groupBy(bin_index(v, F.col("_lo"), F.col("_hi"), bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("count"))
    scaffold = bounds.select("_lo", "_hi", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    step = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    return scaffold.join(counts, "bin", "left").select(
        "bin", (F.col("bin").cast("double") * step + F.col("_lo")).alias("lower"),
        F.when(F.col("bin") == bins - 1, F.col("_hi")).otherwise((F.col("bin") + 1).cast("double") * step + F.col("_lo"))
        .alias("upper"), F.coalesce(F.col("count"), F.lit(0)).alias("count"))


def mean_abs(long: DataFrame, *by: str, value: str = "contribution") -> DataFrame:
    """Mean absolute value per feature (and the columns ``by``)."""
    return long.groupBy(*by, "feature").agg(F.avg(F.abs(F.col(value))).alias("mean_abs"))


def top_by_mean_abs(long: DataFrame, k: int = 20, by: str = "model_id", names: dict | None = None) -> DataFrame:
    """Per model, the k features with the largest mean |contribution|, listed ascending. ``names``: the rows hold arrays (``mean_abs_arrays``)."""
    w = Window.partitionBy(by)  # one row per feature
    m = (mean_abs(long, by) if names is None else mean_abs_arrays(long, names, by)).withColumn("_place", F.row_number().over(w.orderBy(F.col("mean_abs").desc(), "feature")))
    top = m.where(F.col("_place") <= k)
    return top.withColumn("position", F.row_number().over(w.orderBy(F.col("_place").desc()))).drop("_place")


def _of_each(b: pa.RecordBatch, names: dict, by: str, value: str) -> Iterator[tuple]:
    """(group, its rows, the places of their cells in the flattened arrays as rows x names) of every group in a batch of rows with arrays."""
    groups = b.column(by).to_pylist() if by else [None] * len(b)
    first = b.column(value).offsets.to_numpy()[:-1] - b.column(value).offsets[0].as_py()
    for g in dict.fromkeys(groups):
        rows = np.flatnonzero([x == g for x in groups])
        yield g, rows, first[rows][:, None] + np.arange(len(names[g]))


def _cells(b: pa.RecordBatch, value: str) -> np.ndarray:
    return b.column(value).flatten().to_numpy(zero_copy_only=False)  # a null is NaN


def mean_abs_arrays(rows: DataFrame, names: dict, by: str = "model_id", value: str = "contributions") -> DataFrame:
    """A16 of rows that hold a value for each of ``names[group]`` in an array: (by, feature, mean_abs), nulls skipped.

    Tasks add up their rows by group and feature, an aggregate adds up the tasks' sums; nothing is exploded.
    """
    groups = list(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, s = ({g: np.zeros(len(names[g]), t) for g in groups} for t in (np.int64, float))
        for b in batches:
            x, valid = np.abs(_cells(b, value)), b.column(value).flatten().is_valid().to_numpy(zero_copy_only=False)
            for g, _, at in _of_each(b, names, by, value):
                n[g] += valid[at].sum(0)
                s[g] += np.where(valid[at], x[at], 0.0).sum(0)
        for i, g in enumerate(groups):
            k = len(names[g])
            yield pa.RecordBatch.from_arrays([pa.array(np.full(k, i, np.int32)), pa.array(np.arange(k, dtype=np.int32)), pa.array(n[g]), pa.array(s[g])], ["g", "f", "n", "s"])
    sums = rows.select(by, value).mapInArrow(run, "g int, f int, n bigint, s double").groupBy("g", "f").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    named = rows.sparkSession.createDataFrame([(i, j, g, f) for i, g in enumerate(groups) for j, f in enumerate(names[g])],
                                              T.StructType([T.StructField("g", T.IntegerType()), T.StructField("f", T.IntegerType()), rows.schema[by], T.StructField("feature", T.StringType())]))
    return sums.where("n > 0").join(F.broadcast(named), ["g", "f"]).select(by, "feature", (F.col("s") / F.col("n")).alias("mean_abs"))


def by_abs(c: np.ndarray) -> np.ndarray:
    """The places of each row's values by size descending, NaN first, ties in order."""
    return np.argsort(np.where(np.isnan(c), -np.inf, -np.abs(c)), axis=1, kind="stable")


def sort_arrays_by_abs(rows: DataFrame, names, value: str = "contributions", beside: tuple = (), by: str | None = None, digits: int | None = None,
                       out: str = "features", labels: tuple = ("name", "contribution"), joined: str | None = None) -> DataFrame:
    """W6 of whole tables: the array ``value`` as structs (name, the arrays ``beside``, value) sorted by size descending, ties in the order of ``names``.

    A batch of rows is sorted at once, without a comparator called for every pair of elements. ``names``: those of the array's elements, by
    the group in column ``by`` if that is given. ``digits``: places to which values are rounded first, half away from zero.
    ``labels``: fields of name and value; those of ``beside`` are (column, field). ``joined``: the result is the names alone, as one text with this between
    them, so that no struct of an element leaves the task.
    """
    names = names if by else {None: list(names)}
    fields = [(labels[0], T.StringType()), *[(f, T.DoubleType()) for _, f in beside], (labels[1], T.DoubleType())]
    kept = [f for f in rows.schema.fields if f.name not in (value, *[c for c, _ in beside])]
    kind = T.StringType() if joined is not None else T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields]))
    schema = T.StructType([*kept, T.StructField(out, kind)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, len(whole), 2048):
                b = whole.slice(start, 2048)
                x, more = _cells(b, value), [_cells(b, c) for c, _ in beside]
                for g, own, at in _of_each(b, names, by, value):
                    c = x[at]
                    if digits is not None:
                        c = np.copysign(np.floor(np.abs(c) * 10.0 ** digits + 0.5) / 10.0 ** digits, c) + 0.0
                    order = by_abs(c)
                    ends = pa.array(np.arange(len(own) + 1, dtype=np.int32) * len(names[g]))
                    if joined is not None:
                        texts = pc.binary_join(pa.ListArray.from_arrays(ends, pa.array(names[g], pa.string()).take(pa.array(order.ravel()))), joined)
                        yield pa.RecordBatch.from_arrays([*[b.column(f.name).take(pa.array(own)) for f in kept], texts], [*[f.name for f in kept], out])
                        continue
                    there = np.take_along_axis(at, order, 1).ravel()
                    items = pa.StructArray.from_arrays([pa.array(names[g]).take(pa.array(order.ravel())), *[pa.array(m[there]) for m in more],
                                                        pa.array(np.take_along_axis(c, order, 1).ravel())], [n for n, _ in fields])
                    lists = pa.ListArray.from_arrays(ends, items)
                    yield pa.RecordBatch.from_arrays([*[b.column(f.name).take(pa.array(own)) for f in kept], lists], [*[f.name for f in kept], out])
    return rows.select(*[f.name for f in kept], *[c for c, _ in beside], value).mapInArrow(run, schema)


def split_key(id_col: Column, seed: int = 42) -> Column:
    """Deterministic pseudo-random key of a row id (md5 based, portable)."""
    h = F.md5(F.concat(F.lit(str(seed)), F.lit(":"), id_col.cast("string")))
    # 13 hex digits = 52 bits: exact as a double, which the selection works on.
    return F.conv(F.substring(h, 1, 13), 16, 10).cast("long")


def train_test_split(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                     exact: bool = True) -> DataFrame:
    """Mark rows as train/test by a seeded hash of the id.

    ``exact=True``: the test set is exactly ceil(test_size * n) rows (the
    smallest hash keys, ties by id), found by distributed selection;
    otherwise each row is in test with probability ``test_size``.
    """
    key = split_key(F.col(id_col), seed)
    d = df.withColumn("_key", key)
    if not exact:
        frac = F.col("_key").cast("double") / F.lit(float(16 ** 13))
        return d.withColumn("split", F.when(frac < test_size, "test").otherwise("train")).drop("_key")
    cut = _test_end(d, test_size)
    j = d.withColumn("_g", F.lit(0)).join(F.broadcast(cut), "_g", "left")
    kd = F.col("_key").cast("double")
    ties = j.where(kd == F.col("_cut"))
    rest = j.where((kd != F.col("_cut")) | F.col("_cut").isNull())
    w = Window.partitionBy("_g").orderBy(id_col)
    ties = ties.withColumn("split", F.when(F.row_number().over(w) <= F.col("_tb") + 1, "test").otherwise("train"))
    rest = rest.withColumn("split", F.when(kd < F.col("_cut"), "test").otherwise("train"))
    return ties.unionByName(rest).drop("_key", "_g", "_cut", "_tb")


def _test_end(keyed: DataFrame, test_size: float) -> DataFrame:
    """The largest ``_key`` of the test rows (``_cut``), and how many rows with that key are test rows before the last (``_tb``)."""
    n = keyed.groupBy(F.lit(0).alias("_g")).agg(F.count(F.lit(1)).alias("_n"))
    ranks = n.select("_g", (F.ceil(F.col("_n") * F.lit(float(test_size))) - 1).cast("long").alias("k")).where(
        F.col("k") >= 0)
    cut = kth_smallest(keyed.withColumn("_g", F.lit(0)), ["_g"], "_key", ranks)
    return cut.select("_g", F.col("value").alias("_cut"), F.col("ties_before").alias("_tb"))


def split_column(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42) -> Column | None:
    """W7 as an expression of the id, so that wide rows need not be written with their split: the exact split of ``train_test_split``.

    None where no expression can tell the rows apart: rows of one id, of which some are test rows and some are not.
    """
    keyed = df.select(id_col, split_key(F.col(id_col), seed).alias("_key"))
    end = _test_end(keyed, test_size).first()
    if end is None or end["_cut"] is None:
        return F.lit("train")
    key = split_key(F.col(id_col), seed).cast("double")
    # Rows with the last key: one, unless ids share a key or rows an id.
    last = keyed.where(F.col("_key").cast("double") == end["_cut"]).groupBy(id_col).agg(F.count(F.lit(1)).alias("_n"))
    upto = F.sum("_n").over(Window.orderBy(id_col))
    last = last.withColumn("_upto", upto).where(F.col("_upto") <= end["_tb"] + 1).orderBy(F.desc("_upto")).first()
    if last is None or last["_upto"] != end["_tb"] + 1:
        return None
    return F.when((key < end["_cut"]) | ((key == end["_cut"]) & (F.col(id_col) <= F.lit(last[id_col]))), "test").otherwise("train")


def explanation_sample(df: DataFrame, id_col: str, n: int = 100, seed: int = 42) -> DataFrame:
    """A deterministic sample of n rows (the n smallest hash keys)."""
    return df.withColumn("_key", split_key(F.col(id_col), seed)).orderBy("_key", id_col).limit(n).drop("_key")


def ensemble(predictions: DataFrame, weights: dict[str, float] | None = None, key: str = "row_id") -> DataFrame:
    """Weighted ensemble of per-model predictions (weights normalised to
    sum 1; default equal). ``predictions``: (key, model_id, prediction)."""
    models = weights or {}
    if not models:
        names = [r[0] for r in predictions.select("model_id").distinct().collect()]
        models = {m: 1.0 for m in names}
    tot = float(sum(models.values()))
    if tot <= 0:
        raise ValueError("weights must sum to a positive number")
    wmap = F.create_map(*[x for m, w in models.items() for x in (F.lit(m), F.lit(w / tot))])
    w = F.try_element_at(wmap, F.col("model_id"))
    return (predictions.where(w.isNotNull()).groupBy(key)
            .agg(F.sum(w * F.col("prediction")).alias("ensemble_prediction"),
                 F.count(F.lit(1)).alias("n_models")))
