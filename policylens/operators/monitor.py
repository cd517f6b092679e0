"""Model monitoring over the pricing log.

All models are monitored in one job: every statistic is grouped by
``model_id`` (and feature), so only one row per model (or model x feature)
ever leaves the executors.

The reference/current split (W1) puts the first n//2 rows of a model, in
(created_at, pricing_id) order, into the reference half. Instead of ranking
all rows of a model in one window task, the boundary row is found with the
exact distributed selection in ``quantiles.kth_smallest``; each row is then
classified by comparison with that boundary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from policylens.functions import dims
from policylens.operators.quantiles import kth_smallest
from policylens.operators.radix import kth_text
from policylens.session import settle

DEFAULT_WINDOW_DAYS = 30
BIN_COUNT = 10
PSI_FLOOR = 0.0001


def as_of_ts(value) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def history_window(history: DataFrame, as_of, days: int = DEFAULT_WINDOW_DAYS,
                   model_id: str | None = None) -> DataFrame:
    """Rows with created_at >= as_of - N days (one model or all).

    The predicate is on the raw column, so it reaches the Parquet scan as a
    pushed filter; a log partitioned by day ``dt`` is pruned by the same bound.
    """
    lower = as_of_ts(as_of) - F.make_interval(days=F.lit(days))
    out = history.where(F.col("created_at") >= lower)
    if "dt" in history.columns:
        day = lower.cast("date")
        out = out.where(F.col("dt") >= (F.date_format(day, "yyyy-MM-dd") if dict(history.dtypes)["dt"] == "string" else day))
    if model_id is not None:
        out = out.where(F.col("model_id") == F.lit(model_id))
    return out


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts.cast("timestamp"))


def _boundary_tie(ties: DataFrame, group: str, tie_col: str) -> DataFrame:
    """(group, _tie): the id of rank ``_tb - 1`` among rows (group, tie_col, _tb) that share a timestamp.

    An integer id is found by selection, its upper half first and then the
    lower among the ids of that upper half (a double holds either exactly); a
    text id by its bytes. No rows are ranked.
    """
    ranks = ties.groupBy(group).agg((F.first("_tb") - 1).alias("k"))
    if not isinstance(ties.schema[tie_col].dataType, T.IntegralType):
        return kth_text(ties, [group], tie_col, ranks).select(group, F.col("value").cast(ties.schema[tie_col].dataType).alias("_tie"))
    halves = ties.select(group, F.shiftright(F.col(tie_col).cast("long"), 32).alias("_high"),
                         F.col(tie_col).cast("long").bitwiseAND(F.lit(0xFFFFFFFF)).alias("_low"))
    high = kth_smallest(halves, [group], "_high", ranks).select(
        group, F.col("value").cast("long").alias("_h"), F.col("ties_before").alias("k"))
    low = kth_smallest(halves.join(high, group).where(F.col("_high") == F.col("_h")), [group], "_low", high)
    return high.drop("k").join(low, group).select(
        group, (F.shiftleft("_h", 32) + F.col("value").cast("long")).alias("_tie"))


def split_cuts(history: DataFrame, ranks: DataFrame, group: str = "model_id", order_col: str = "created_at",
               tie_col: str = "pricing_id") -> DataFrame:
    """(group, _cut, _tie): time in microseconds and id of the last row before rank ``k`` of each group of ``ranks`` (group, k)."""
    h = history.select(group, _micros(F.col(order_col)).alias("_t"), tie_col)
    cut = kth_smallest(h, [group], "_t", ranks).select(
        group, F.col("value").cast("long").alias("_cut"), F.col("ties_before").alias("_tb"))
    ties = settle(h.join(cut.where(F.col("_tb") > 0), group).where(F.col("_t") == F.col("_cut")).select(group, tie_col, "_tb"), "ties")
    return settle(cut.join(_boundary_tie(ties, group, tie_col), group, "left").drop("_tb"), "cuts")


def before_cut(order_col: str = "created_at", tie_col: str = "pricing_id") -> Column:
    """Whether a row lies before its group's cut; false where the group has no cut."""
    t = _micros(F.col(order_col))
    return F.coalesce((t < F.col("_cut")) | ((t == F.col("_cut")) & (F.col(tie_col) <= F.col("_tie"))), F.lit(False))


def period_split(history: DataFrame, group: str = "model_id", order_col: str = "created_at",
                 tie_col: str = "pricing_id") -> DataFrame:
    """Add ``period`` = 'reference' for the first n//2 rows of each group
    in (order_col, tie_col) order, else 'current'. ``tie_col`` is unique.

    Only the boundary (one row per group) is computed and written; the rows
    are classified by comparison wherever the result is read.
    """
    ranks = history.groupBy(group).agg((F.count(F.lit(1)) / 2).cast("long").alias("k"))
    cut = split_cuts(history, ranks, group, order_col, tie_col)
    return history.join(cut, group).withColumn(
        "period", F.when(before_cut(order_col, tie_col), "reference").otherwise("current")).drop("_cut", "_tie")


def period_bounds(split: DataFrame, group: str = "model_id") -> DataFrame:
    """first/last timestamp and row count of each period."""
    return split.groupBy(group, "period").agg(
        F.min("created_at").alias("first_ts"), F.max("created_at").alias("last_ts"),
        F.count(F.lit(1)).alias("n"))


def performance(history: DataFrame, pred: str = "base_premium", actual: str = "final_premium") -> DataFrame:
    """Mse, rmse, mae, mape, r2, bias, sample_size per model (one pass).

    r2 = 1 - SSE/SST with SST = n * var_pop(actual) (numerically stable
    merge); SST = 0 gives 1.0 when SSE = 0 else 0.0. mape skips zero actuals.
    """
    p, a = F.col(pred), F.col(actual)
    err = a - p
    g = history.groupBy("model_id").agg(
        F.avg(err * err).alias("mse"), F.avg(F.abs(err)).alias("mae"),
        (F.avg(F.abs(F.try_divide(err, a))) * F.lit(100.0)).alias("mape"),
        F.sum(err * err).alias("_sse"), (F.var_pop(a) * F.count(a)).alias("_sst"),
        F.avg(p - a).alias("bias"), F.count(F.lit(1)).alias("sample_size"))
    r2 = (F.when(F.col("_sst") == 0, F.when(F.col("_sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0)))
          .otherwise(F.lit(1.0) - F.col("_sse") / F.col("_sst")))
    return g.select("model_id", "mse", F.sqrt("mse").alias("rmse"), "mae", "mape", r2.alias("r2"), "bias",
                    "sample_size")


_NUMERIC_TYPES = r"^(BIGINT|INT|INTEGER|SMALLINT|TINYINT|DOUBLE|FLOAT|DECIMAL.*)$"


def feature_values(rows: DataFrame, col: str = "input_features") -> DataFrame:
    """F26 + explode: (model_id, period if the rows have one, feature, value, kind) from JSON text."""
    m = F.from_json(F.col(col), "map<string,variant>")
    keys = [c for c in ("model_id", "period") if c in rows.columns]
    e = rows.select(*keys, F.explode(m).alias("feature", "_v"))
    typ = F.schema_of_variant("_v")
    kind = (F.when(F.is_variant_null("_v"), "null").when(typ.rlike(_NUMERIC_TYPES), "number")
            .when(typ == "BOOLEAN", "boolean").otherwise("other"))
    return e.select(*keys, "feature", F.try_variant_get("_v", "$", "double").alias("value"), kind.alias("kind"))


def kind_counts(n: Column | None = None) -> list[Column]:
    """n_set, n_num, n_bool of rows that carry ``kind`` (and count for ``n``)."""
    one = F.lit(1) if n is None else n
    of = lambda kind: F.coalesce(F.sum(F.when(kind, one)), F.lit(0))
    return [of(F.col("kind") != "null").alias("n_set"), of(F.col("kind") == "number").alias("n_num"), of(F.col("kind") == "boolean").alias("n_bool")]


def is_numeric() -> Column:
    """P10: the key's non-null values are all numbers, or all booleans."""
    return (F.col("n_num") == F.col("n_set")) | (F.col("n_bool") == F.col("n_set"))


def numeric_features(values: DataFrame) -> DataFrame:
    """P10: keys whose non-null values are all numbers (or all booleans)."""
    return values.groupBy("model_id", "feature").agg(*kind_counts()).where(is_numeric()).select("model_id", "feature")


def _rel(cur: Column, ref: Column) -> Column:
    return F.when(ref != 0, (cur - ref) / ref).when(ref == 0, F.lit(0.0))


DIFFERENCES = ("mean_diff", "std_diff", "range_diff")


def with_differences(g: DataFrame) -> DataFrame:
    """D3: relative differences of both halves' statistics."""
    rr = F.col("ref_max") - F.col("ref_min")
    cr = F.col("cur_max") - F.col("cur_min")
    return g.select("*", _rel(F.col("cur_mean"), F.col("ref_mean")).alias("mean_diff"),
                    _rel(F.col("cur_std"), F.col("ref_std")).alias("std_diff"),
                    F.when(rr != 0, (cr - rr) / rr).when(rr == 0, F.lit(0.0)).alias("range_diff"))


def _half_stats() -> list[Column]:
    out, v = [], F.col("value")
    for name, period in (("ref", "reference"), ("cur", "current")):
        own = F.when(F.col("period") == period, v)
        out += [F.avg(own).alias(f"{name}_mean"), F.stddev_samp(own).alias(f"{name}_std"), F.min(own).alias(f"{name}_min"), F.max(own).alias(f"{name}_max")]
    return out


def drift_stats(long: DataFrame) -> DataFrame:
    """D2 + D3: per (model, feature) statistics of both halves and relative
    differences, by conditional aggregation in one grouped pass."""
    return with_differences(long.groupBy("model_id", "feature").agg(*_half_stats()))


def feature_stats(split: DataFrame) -> DataFrame:
    """D2 + D3 of the numeric keys (P10), with ``_lo`` and ``_hi`` over both halves: the log is parsed once, kinds and
    moments are counted together, and only one row per (model, feature) is written."""
    g = feature_values(split).groupBy("model_id", "feature").agg(*kind_counts(), *_half_stats(), F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    return settle(with_differences(g.where(is_numeric()).drop("n_set", "n_num", "n_bool")), "feature-stats")


def bin_index(v: Column, lo: Column, hi: Column, bins: int = BIN_COUNT) -> Column:
    """Equal-width bin of v in [lo, hi]; last bin closed; lo == hi -> last bin.
    Edge i is lo + i * ((hi - lo) / bins), compared like a sorted-edge search."""
    step = (hi - lo) / F.lit(float(bins))
    total = None
    for i in range(1, bins):
        term = (v >= F.lit(float(i)) * step + lo).cast("int")
        total = term if total is None else total + term
    return total


def psi_of_counts(bounds: DataFrame, counts: DataFrame, bins: int = BIN_COUNT) -> DataFrame:
    """D4 from ``bounds`` (one row per (model, feature)) and ``counts`` (model_id, feature, bin, _rc, _cc)."""
    scaffold = bounds.select("model_id", "feature", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = scaffold.join(counts, ["model_id", "feature", "bin"], "left").fillna(0, ["_rc", "_cc"])
    w = Window.partitionBy("model_id", "feature")
    rt, ct = F.sum("_rc").over(w), F.sum("_cc").over(w)
    props = full.select("model_id", "feature",
                        F.try_divide(F.col("_rc").cast("double"), rt).alias("_r"),
                        F.try_divide(F.col("_cc").cast("double"), ct).alias("_c"))
    floor = lambda c: F.when(c == 0, F.lit(PSI_FLOOR)).otherwise(c)
    props = props.select("model_id", "feature", floor(F.col("_r")).alias("_r"), floor(F.col("_c")).alias("_c"))
    term = (F.col("_c") - F.col("_r")) * F.ln(F.col("_c") / F.col("_r"))
    # A half without values has undefined proportions -> null PSI.
    return props.groupBy("model_id", "feature").agg(
        F.when(F.count_if(F.col("_r").isNull() | F.col("_c").isNull()) > 0, F.lit(None).cast("double"))
        .otherwise(F.sum(term)).alias("psi"))


def psi(long: DataFrame, bounds: DataFrame | None = None, bins: int = BIN_COUNT) -> DataFrame:
    """Population stability index per (model, feature); ``bounds`` (model_id, feature, _lo, _hi): those of the keys
    to take, found in one more pass if None."""
    v = F.col("value")
    vals = long.where(v.isNotNull())
    if bounds is None:
        # Written, so that its size in bytes decides the join: the values meet their bounds without a shuffle while those are small.
        bounds = settle(vals.groupBy("model_id", "feature").agg(F.min(v).alias("_lo"), F.max(v).alias("_hi")), "bounds")
    b = bin_index(v, F.col("_lo"), F.col("_hi"), bins)
    counts = (vals.join(bounds, ["model_id", "feature"])
              .groupBy("model_id", "feature", b.alias("bin"))
              .agg(F.count_if(F.col("period") == "reference").alias("_rc"),
                   F.count_if(F.col("period") == "current").alias("_cc")))
    return psi_of_counts(bounds, counts, bins)


def feature_psi(split: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """D4 of the numeric keys: the values are parsed again and only partial bin counts are exchanged."""
    stats = feature_stats(split) if stats is None else stats
    return psi(feature_values(split), stats.where(F.col("_lo").isNotNull()).select("model_id", "feature", "_lo", "_hi"))


def feature_drift(split: DataFrame) -> DataFrame:
    """D2-D4 combined per (model, feature): two passes over the log and no table of its values."""
    stats = feature_stats(split)
    return stats.drop("_lo", "_hi").join(feature_psi(split, stats), ["model_id", "feature"], "left")


def prediction_long(split: DataFrame, col: str = "final_premium") -> DataFrame:
    return split.select("model_id", "period", F.lit(col).alias("feature"), F.col(col).cast("double").alias("value"))


def prediction_drift(split: DataFrame, col: str = "final_premium") -> DataFrame:
    """D2-D4 on the final premium."""
    long = prediction_long(split, col)
    return drift_stats(long).join(psi(long), ["model_id", "feature"], "left").drop("feature")


def model_health(perf: DataFrame, fdrift: DataFrame, pdrift: DataFrame, limits: dict | None = None) -> DataFrame:
    """Statuses and issue texts per model; a missing metric is healthy."""
    lim = dict(dims.HEALTH_LIMITS, **(limits or {}))
    f2 = lambda c: F.format_string("%.2f", c)
    perf_issues = F.array_compact(F.array(
        F.when(F.col("mape") > lim["mape"], F.concat(F.lit("MAPE is "), f2(F.col("mape")),
                                                      F.lit(f"%, which is above the threshold of {lim['mape']}%"))),
        F.when(F.col("r2") < lim["r2"], F.concat(F.lit("R-squared is "), f2(F.col("r2")),
                                                  F.lit(f", which is below the threshold of {lim['r2']}"))),
        F.when(F.abs(F.col("bias")) > lim["bias"], F.concat(F.lit("Bias is $"), f2(F.abs(F.col("bias"))),
                                                             F.lit(f", which is above the threshold of ${lim['bias']}")))))
    p = perf.select("model_id", perf_issues.alias("performance_issues"))
    fi = F.array_compact(F.array(
        F.when(F.col("psi") > lim["psi"], F.concat(F.lit("Feature '"), F.col("feature"), F.lit("' has PSI of "),
                                                  f2(F.col("psi")),
                                                  F.lit(f", which is above the threshold of {lim['psi']}"))),
        F.when(F.abs(F.col("mean_diff")) > lim["mean_diff"],
               F.concat(F.lit("Feature '"), F.col("feature"), F.lit("' has mean difference of "),
                        f2(F.abs(F.col("mean_diff"))), F.lit(f", which is above the threshold of {lim['mean_diff']}")))))
    f = (fdrift.select("model_id", "feature", fi.alias("_i")).groupBy("model_id")
         .agg(F.flatten(F.array_sort(F.collect_list(F.struct("feature", "_i"))).getField("_i"))
              .alias("feature_drift_issues")))
    pi = F.array_compact(F.array(
        F.when(F.col("psi") > lim["psi"], F.concat(F.lit("Prediction PSI is "), f2(F.col("psi")),
                                                  F.lit(f", which is above the threshold of {lim['psi']}"))),
        F.when(F.abs(F.col("mean_diff")) > lim["mean_diff"],
               F.concat(F.lit("Prediction mean difference is "), f2(F.abs(F.col("mean_diff"))),
                        F.lit(f", which is above the threshold of {lim['mean_diff']}")))))
    d = pdrift.select("model_id", pi.alias("prediction_drift_issues"))
    j = p.join(f, "model_id", "full_outer").join(d, "model_id", "full_outer")
    empty = F.array().cast("array<string>")
    cols = {c: F.coalesce(F.col(c), empty) for c in
            ("performance_issues", "feature_drift_issues", "prediction_drift_issues")}
    status = lambda c: F.when(F.size(c) > 0, "degraded").otherwise("healthy")
    return j.select(
        "model_id",
        status(cols["performance_issues"]).alias("performance_status"),
        status(cols["feature_drift_issues"]).alias("feature_drift_status"),
        status(cols["prediction_drift_issues"]).alias("prediction_drift_status"),
        F.when((F.size(cols["performance_issues"]) + F.size(cols["feature_drift_issues"])
                + F.size(cols["prediction_drift_issues"])) > 0, "degraded").otherwise("healthy").alias("overall_status"),
        F.array_join(F.concat(cols["performance_issues"], cols["feature_drift_issues"],
                              cols["prediction_drift_issues"]), "; ").alias("issues"))
