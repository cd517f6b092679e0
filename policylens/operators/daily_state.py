"""Monitoring state by day: what D1-D5 and W2 need of the pricing log, kept in a form that merges.

Each batch of log rows leaves two small tables, by day: sums and moments of the
premiums (``perf``), and how often each value of each feature occurs
(``values``). Moments, ranges and exact bins of any window follow from them,
whatever its start, end or halves, so the log's old days are not parsed again. Rows are read from
the log for two days only: the day in which the window begins, unless that
is at midnight, and the day in which a model's reference half ends, where single
rows belong to either half.

A batch writes folders of its own (overwrite), so a replay changes nothing, and late rows of
an old day simply add to it.
"""

from __future__ import annotations

import os
from dataclasses import dataclass
from datetime import datetime, time, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from policylens.operators import monitor as M
from policylens.session import settle

PERF = ("dt date, model_id string, n long, n_err long, sse double, sae double, n_ape long, sape double, sbias double, n_actual long, mean_actual double, "
        "m2_actual double, first_ts timestamp_ntz, last_ts timestamp_ntz, batch string")
VALUES = "model_id string, feature string, kind string, value double, n long, dt date, source string, batch string"


def _day(ts: str = "created_at") -> Column:
    return F.to_date(F.col(ts))


def perf_of(rows: DataFrame, pred: str = "base_premium", actual: str = "final_premium") -> DataFrame:
    """Per (day, model): what D1 and W2 are made of, in sums and moments."""
    p, a = F.col(pred), F.col(actual)
    err, share = a - p, F.abs(F.try_divide(a - p, a))
    return rows.groupBy(_day().alias("dt"), "model_id").agg(
        F.count(F.lit(1)).alias("n"), F.count(err).alias("n_err"), F.sum(err * err).alias("sse"), F.sum(F.abs(err)).alias("sae"),
        F.count(share).alias("n_ape"), F.sum(share).alias("sape"), F.sum(p - a).alias("sbias"),
        F.count(a).alias("n_actual"), F.avg(a).alias("mean_actual"), (F.var_pop(a) * F.count(a)).alias("m2_actual"),
        F.min("created_at").cast("timestamp_ntz").alias("first_ts"), F.max("created_at").cast("timestamp_ntz").alias("last_ts"))


def performance(daily: DataFrame) -> DataFrame:
    """D1 per model from rows of ``perf_of``: sums add, and squares about the mean add with the days' distances from it."""
    w = Window.partitionBy("model_id")
    mean = F.sum(F.col("mean_actual") * F.col("n_actual")).over(w) / F.sum("n_actual").over(w)
    d = daily.withColumn("_sst", F.col("m2_actual") + F.col("n_actual") * (F.col("mean_actual") - mean) * (F.col("mean_actual") - mean))
    g = d.groupBy("model_id").agg(*[F.sum(c).alias(c) for c in ("n", "n_err", "sse", "sae", "n_ape", "sape", "sbias", "_sst")])
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))).otherwise(F.lit(1.0) - F.col("sse") / F.col("_sst")))
    mse = F.try_divide(F.col("sse"), F.col("n_err"))
    return g.select("model_id", mse.alias("mse"), F.sqrt(mse).alias("rmse"), F.try_divide(F.col("sae"), F.col("n_err")).alias("mae"),
                    (F.try_divide(F.col("sape"), F.col("n_ape")) * 100.0).alias("mape"), r2.alias("r2"),
                    F.try_divide(F.col("sbias"), F.col("n_err")).alias("bias"), F.col("n").alias("sample_size"))


def _predictions(rows: DataFrame, col: str = "final_premium") -> DataFrame:
    keys = [c for c in ("dt", "period") if c in rows.columns]
    return rows.select(*keys, "model_id", F.lit(col).alias("feature"), F.col(col).cast("double").alias("value"), F.lit("number").alias("kind"))


def _features(rows: DataFrame) -> DataFrame:
    keys = [c for c in ("dt", "period") if c in rows.columns]
    e = rows.select(F.struct(*keys, "model_id").alias("model_id"), "input_features")
    return M.feature_values(e).select(*[F.col("model_id")[k].alias(k) for k in keys], F.col("model_id.model_id").alias("model_id"), "feature", "value", "kind")


def drift(values: DataFrame) -> DataFrame:
    """D2-D4 per (model, feature) of numeric keys from counted values (model_id, feature, period, value, kind, n): two passes
    over the counts, first kinds, sums and ranges, then squares about the means together with the bins."""
    v, n = F.col("value"), F.col("n")
    halves, aggs = (("ref", "reference"), ("cur", "current")), []
    for name, period in halves:
        own = F.col("period") == period
        aggs += [F.sum(F.when(own & v.isNotNull(), n)).alias(f"{name}_n"), F.sum(F.when(own, v * n)).alias(f"{name}_sum"),
                 F.min(F.when(own, v)).alias(f"{name}_min"), F.max(F.when(own, v)).alias(f"{name}_max")]
    g = values.groupBy("model_id", "feature").agg(*M.kind_counts(n), *aggs, F.min(v).alias("_lo"), F.max(v).alias("_hi")).where(M.is_numeric())
    g = settle(g.select("model_id", "feature", "_lo", "_hi", *[c for name, _ in halves for c in (
        F.col(f"{name}_n"), (F.col(f"{name}_sum") / F.col(f"{name}_n")).alias(f"{name}_mean"), f"{name}_min", f"{name}_max")]), "value-stats")
    known = g.select("model_id", "feature", "_lo", "_hi", "ref_mean", "cur_mean")
    mean = F.when(F.col("period") == "reference", F.col("ref_mean")).otherwise(F.col("cur_mean"))
    b = M.bin_index(v, F.col("_lo"), F.col("_hi"))
    binned = settle(values.where(v.isNotNull()).join(known, ["model_id", "feature"]).withColumn("_sq", n * (v - mean) * (v - mean))
                    .groupBy("model_id", "feature", b.alias("bin")).agg(
                        *[F.coalesce(F.sum(F.when(F.col("period") == p, n)), F.lit(0)).alias(c) for p, c in (("reference", "_rc"), ("current", "_cc"))],
                        *[F.sum(F.when(F.col("period") == p, F.col("_sq"))).alias(f"_{name}_sq") for name, p in halves]), "bins")
    squares = binned.groupBy("model_id", "feature").agg(*[F.sum(f"_{name}_sq").alias(f"_{name}_sq") for name, _ in halves])
    std = lambda name: F.when(F.col(f"{name}_n") > 1, F.sqrt(F.col(f"_{name}_sq") / (F.col(f"{name}_n") - 1))).alias(f"{name}_std")
    stats = g.join(squares, ["model_id", "feature"], "left").select(
        "model_id", "feature", *[c for name, _ in halves for c in (F.col(f"{name}_mean"), std(name), F.col(f"{name}_min"), F.col(f"{name}_max"))])
    psi = M.psi_of_counts(g.where(F.col("_lo").isNotNull()).select("model_id", "feature"), binned.select("model_id", "feature", "bin", "_rc", "_cc"))
    return M.with_differences(stats).join(psi, ["model_id", "feature"], "left")


@dataclass
class Monitored:
    """The parts of a monitoring record of one window: D1, D2-D4, D5, W2."""

    performance: DataFrame
    features: DataFrame
    predictions: DataFrame
    bounds: DataFrame


@dataclass
class DailyState:
    """The state tables of one log under ``root``."""

    spark: SparkSession
    root: str

    def add(self, rows: DataFrame, batch: int | str) -> None:
        """Take in a batch of log rows; the same batch again replaces itself."""
        perf_of(rows).write.mode("overwrite").parquet(os.path.join(self.root, "perf", f"batch={batch}"))
        own = rows.withColumn("dt", _day())
        values = _features(own).withColumn("source", F.lit("feature")).unionByName(_predictions(own).withColumn("source", F.lit("prediction")))
        counted = values.groupBy("dt", "source", "model_id", "feature", "kind", "value").agg(F.count(F.lit(1)).alias("n"))
        counted.write.mode("overwrite").partitionBy("dt", "source").parquet(os.path.join(self.root, "values", f"batch={batch}"))

    def _read(self, name: str, schema: str, since: str) -> DataFrame:
        table = self.spark.read.schema(schema).parquet(os.path.join(self.root, name)).drop("batch")
        return table.where(F.col("dt") >= F.lit(since).cast("date"))

    def window(self, log: DataFrame, as_of: str | datetime, days: int = M.DEFAULT_WINDOW_DAYS) -> Monitored:
        """The window from ``days`` before ``as_of`` on, to the log's end (as S3 takes it), halved by W1.

        ``log`` is read for the edge days alone (by its day column ``dt`` if it has one).
        """
        at = as_of if isinstance(as_of, datetime) else datetime.fromisoformat(as_of)
        lower = at - timedelta(days=days)
        first, partial = lower.date(), lower.time() != time()
        whole_from = str(first + timedelta(days=1) if partial else first)

        def rows_of(on: list[str]) -> DataFrame:
            """Log rows of the given days that lie in the window, with their day."""
            spans = F.lit(False)
            for d in on:
                spans = spans | ((F.col("created_at") >= F.lit(d).cast("timestamp_ntz")) & (F.col("created_at") < F.lit(str(datetime.fromisoformat(d) + timedelta(days=1))).cast("timestamp_ntz")))
            rows = log.where(spans & (F.col("created_at") >= M.as_of_ts(lower)))
            if "dt" in log.columns:
                rows = rows.where(F.col("dt").cast("string").isin(on) if dict(log.dtypes)["dt"] == "string" else F.col("dt").isin([datetime.fromisoformat(d).date() for d in on]))
            return rows.withColumn("dt", _day())

        daily = self._read("perf", PERF, whole_from)
        if partial:
            daily = daily.unionByName(perf_of(rows_of([str(first)])))
        daily = settle(daily, "daily")  # a row per day, model and batch

        counts = daily.groupBy("model_id", "dt").agg(F.sum("n").alias("n"))
        own = Window.partitionBy("model_id")
        counts = counts.select("*", F.sum("n").over(own.orderBy("dt")).alias("upto"), F.floor(F.sum("n").over(own) / 2).cast("long").alias("half"))
        ends = counts.where((F.col("upto") - F.col("n") < F.col("half")) & (F.col("half") <= F.col("upto"))).select(
            "model_id", F.col("dt").alias("_day"), (F.col("half") - (F.col("upto") - F.col("n"))).alias("k"), (F.col("half") == F.col("upto")).alias("_all"))
        ends = settle(daily.select("model_id").distinct().join(ends, "model_id", "left"), "half-days")  # no day: one row alone, all current

        split_days = [str(r[0]) for r in ends.where(~F.col("_all")).select("_day").distinct().collect()]  # days of the window at most
        edges = sorted({*split_days, *([str(first)] if partial else [])})
        rows = rows_of(edges).join(ends, "model_id") if edges else log.limit(0).withColumn("dt", _day()).join(ends, "model_id")
        cut_day = ~F.col("_all") & (F.col("dt") == F.col("_day"))
        split = rows.where(cut_day)
        cuts = M.split_cuts(split, ends.where(~F.col("_all")).select("model_id", "k"))
        side = F.when(F.col("dt") < F.col("_day"), "reference").when((F.col("dt") == F.col("_day")) & F.col("_all"), "reference").otherwise("current")
        taken = cut_day | (F.lit(partial) & (F.col("dt") == F.lit(str(first)).cast("date")))
        rows = rows.where(F.coalesce(taken, F.lit(False))).join(cuts, "model_id", "left")
        rows = rows.withColumn("period", F.when(cut_day, F.when(M.before_cut(), "reference").otherwise("current")).otherwise(side))

        def whole(state: DataFrame) -> DataFrame:
            """State rows of the days that lie in one half, with their period."""
            s = state.join(ends, "model_id").where(F.coalesce(~cut_day, F.lit(True)) & (F.col("dt") >= F.lit(whole_from).cast("date")))
            return s.withColumn("period", side).drop("_day", "k", "_all")

        values = whole(self._read("values", VALUES, whole_from))
        cols = ["model_id", "feature", "period", "value", "kind", "n"]
        merged = lambda source, edge: drift(values.where(F.col("source") == source).select(*cols).unionByName(
            edge.withColumn("n", F.lit(1).cast("long")).select(*cols)))
        spans = whole(daily).select("model_id", "period", "first_ts", "last_ts", "n").unionByName(
            rows.select("model_id", "period", F.col("created_at").cast("timestamp_ntz").alias("first_ts"), F.col("created_at").cast("timestamp_ntz").alias("last_ts"), F.lit(1).cast("long").alias("n")))
        bounds = spans.groupBy("model_id", "period").agg(F.min("first_ts").alias("first_ts"), F.max("last_ts").alias("last_ts"), F.sum("n").alias("n"))
        return Monitored(performance(daily), merged("feature", _features(rows)), merged("prediction", _predictions(rows)).drop("feature"), bounds)
