"""Queries: pricing-log window, split, performance, drift, PSI, health, statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.operators import monitor as M
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.sources.tables import LOG_AS_OF, with_clause

WINDOW_DAYS = M.DEFAULT_WINDOW_DAYS
# The window query itself uses a one-week window so that the filter is selective.
WEEK = 7

_W = with_clause("fx_pricing_history")
_WINDOWED = (f"SELECT * FROM fx_pricing_history "
             f"WHERE created_at >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {WINDOW_DAYS} DAY")
_SPLIT = f"""SELECT *, CASE WHEN rn <= n // 2 THEN 'reference' ELSE 'current' END AS period FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY created_at, pricing_id) AS rn,
         count(*) OVER (PARTITION BY model_id) AS n FROM ({_WINDOWED}))"""
_FEATURE_LONG_ALL = f"""SELECT s.model_id, s.period, j.key AS feature, TRY_CAST(j.value AS DOUBLE) AS value,
  CASE WHEN json_type(j.value) = 'NULL' THEN 'null'
       WHEN json_type(j.value) IN ('UBIGINT', 'BIGINT', 'DOUBLE') THEN 'number'
       WHEN json_type(j.value) = 'BOOLEAN' THEN 'boolean' ELSE 'other' END AS kind
FROM ({_SPLIT}) s, json_each(s.input_features) j"""
_NUMERIC_KEYS = f"""SELECT model_id, feature FROM ({_FEATURE_LONG_ALL}) GROUP BY 1, 2
HAVING count_if(kind = 'number') = count_if(kind <> 'null') OR count_if(kind = 'boolean') = count_if(kind <> 'null')"""
_FEATURE_LONG = f"""SELECT l.model_id, l.period, l.feature, l.value FROM ({_FEATURE_LONG_ALL}) l
SEMI JOIN ({_NUMERIC_KEYS}) k ON l.model_id = k.model_id AND l.feature = k.feature"""


def _stats_sql(long_sql):
    r, c = "period = 'reference'", "period = 'current'"
    return f"""SELECT *,
  CASE WHEN ref_mean <> 0 THEN (cur_mean - ref_mean) / ref_mean WHEN ref_mean = 0 THEN 0.0 END AS mean_diff,
  CASE WHEN ref_std <> 0 THEN (cur_std - ref_std) / ref_std WHEN ref_std = 0 THEN 0.0 END AS std_diff,
  CASE WHEN ref_max - ref_min <> 0 THEN ((cur_max - cur_min) - (ref_max - ref_min)) / (ref_max - ref_min)
       WHEN ref_max - ref_min = 0 THEN 0.0 END AS range_diff
FROM (SELECT model_id, feature,
  avg(value) FILTER (WHERE {r}) AS ref_mean, stddev_samp(value) FILTER (WHERE {r}) AS ref_std,
  min(value) FILTER (WHERE {r}) AS ref_min, max(value) FILTER (WHERE {r}) AS ref_max,
  avg(value) FILTER (WHERE {c}) AS cur_mean, stddev_samp(value) FILTER (WHERE {c}) AS cur_std,
  min(value) FILTER (WHERE {c}) AS cur_min, max(value) FILTER (WHERE {c}) AS cur_max
  FROM ({long_sql}) GROUP BY model_id, feature)"""


def _psi_sql(long_sql):
    edges = " + ".join(f"CAST(value >= {i}.0 * ((hi - lo) / 10.0) + lo AS INTEGER)" for i in range(1, 10))
    return f"""SELECT model_id, feature,
  CASE WHEN bool_or(r IS NULL OR c IS NULL) THEN NULL ELSE sum((c - r) * ln(c / r)) END AS psi
FROM (SELECT model_id, feature,
        CASE WHEN rp = 0 THEN 0.0001 ELSE rp END AS r, CASE WHEN cp = 0 THEN 0.0001 ELSE cp END AS c
      FROM (SELECT s.model_id, s.feature, s.bin,
              CAST(COALESCE(k.rc, 0) AS DOUBLE) / NULLIF(sum(COALESCE(k.rc, 0)) OVER (PARTITION BY s.model_id, s.feature), 0) AS rp,
              CAST(COALESCE(k.cc, 0) AS DOUBLE) / NULLIF(sum(COALESCE(k.cc, 0)) OVER (PARTITION BY s.model_id, s.feature), 0) AS cp
            FROM (SELECT model_id, feature, unnest(range(0, 10)) AS bin FROM
                    (SELECT model_id, feature FROM ({long_sql}) WHERE value IS NOT NULL GROUP BY 1, 2)) s
            LEFT JOIN (SELECT model_id, feature, {edges} AS bin,
                              count_if(period = 'reference') AS rc, count_if(period = 'current') AS cc
                       FROM (SELECT l.*, b.lo, b.hi FROM ({long_sql}) l JOIN
                               (SELECT model_id, feature, min(value) AS lo, max(value) AS hi FROM ({long_sql})
                                WHERE value IS NOT NULL GROUP BY 1, 2) b USING (model_id, feature)
                             WHERE l.value IS NOT NULL)
                       GROUP BY 1, 2, 3) k USING (model_id, feature, bin)))
GROUP BY model_id, feature"""


_STAT_COLS = ["ref_mean", "ref_std", "ref_min", "ref_max", "cur_mean", "cur_std", "cur_min", "cur_max",
              "mean_diff", "std_diff", "range_diff"]


def _split(fx):
    return M.period_split(M.history_window(fx.pricing_history, LOG_AS_OF, WINDOW_DAYS))


@query("history_window", oracle=_W + f"""
SELECT pricing_id, policy_id, model_id, base_premium, final_premium, created_at FROM fx_pricing_history
WHERE created_at >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {WEEK} DAY""")
def q_history_window(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return M.history_window(fx.pricing_history, LOG_AS_OF, WEEK).select(
        "pricing_id", "policy_id", "model_id", "base_premium", "final_premium", "created_at")


@query("period_split", oracle=_W + f"SELECT pricing_id, model_id, period FROM ({_SPLIT})")
def q_period_split(spark, sf_dir):
    return _split(fixtures(spark, sf_dir)).select("pricing_id", "model_id", "period")


# Text ids, and one time for all requests of four hours, as a log has whose rows are stamped by the batch.
_TEXT_LOG = """SELECT md5(CAST(pricing_id AS STRING)) AS pricing_id, model_id,
  date_trunc('day', created_at) + INTERVAL 4 HOUR * CAST(floor(hour(created_at) / 4) AS INT) AS created_at FROM fx_pricing_history"""


@query("period_split_text_ids", oracle=_W + f"""
SELECT pricing_id, model_id, CASE WHEN rn <= n // 2 THEN 'reference' ELSE 'current' END AS period FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY created_at, pricing_id) AS rn, count(*) OVER (PARTITION BY model_id) AS n
  FROM ({_TEXT_LOG}) WHERE created_at >= TIMESTAMP '{LOG_AS_OF}' - INTERVAL {WINDOW_DAYS} DAY)""")
def q_period_split_text_ids(spark, sf_dir):
    """W1 where the boundary lies among thousands of equal timestamps and ids are texts."""
    fixtures(spark, sf_dir)
    log = spark.sql(_TEXT_LOG)
    return M.period_split(M.history_window(log, LOG_AS_OF, WINDOW_DAYS)).select("pricing_id", "model_id", "period")


@query("period_bounds", oracle=_W + f"""
SELECT model_id, period, min(created_at) AS first_ts, max(created_at) AS last_ts, count(*) AS n
FROM ({_SPLIT}) GROUP BY 1, 2""")
def q_period_bounds(spark, sf_dir):
    return M.period_bounds(_split(fixtures(spark, sf_dir)))


_PERF_COLS = ["mse", "rmse", "mae", "mape", "r2", "bias"]


@query("model_performance", oracle=rnd(_W + f"""
SELECT model_id, avg((a - p) * (a - p)) AS mse, sqrt(avg((a - p) * (a - p))) AS rmse, avg(abs(a - p)) AS mae,
  avg(abs((a - p) / NULLIF(a, 0))) * 100 AS mape,
  CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sse / sst END AS r2,
  avg(p - a) AS bias, count(*) AS sample_size
FROM (SELECT w.model_id, w.base_premium AS p, w.final_premium AS a,
        sum((w.final_premium - w.base_premium) * (w.final_premium - w.base_premium)) OVER (PARTITION BY w.model_id) AS sse,
        sum((w.final_premium - m.mu) * (w.final_premium - m.mu)) OVER (PARTITION BY w.model_id) AS sst
      FROM ({_WINDOWED}) w JOIN (SELECT model_id, avg(final_premium) AS mu FROM ({_WINDOWED}) GROUP BY 1) m
      USING (model_id))
GROUP BY model_id, sse, sst""", _PERF_COLS))
def q_model_performance(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(M.performance(M.history_window(fx.pricing_history, LOG_AS_OF, WINDOW_DAYS)))


@query("json_features", oracle=_W + """
SELECT h.pricing_id, j.key AS feature, TRY_CAST(j.value AS DOUBLE) AS value
FROM fx_pricing_history h, json_each(h.input_features) j""")
def q_json_features(spark, sf_dir):
    """JSON feature text parsed to (pricing_id, feature, value)."""
    fx = fixtures(spark, sf_dir)
    m = F.from_json(F.col("input_features"), "map<string,variant>")
    e = fx.pricing_history.select("pricing_id", F.explode(m).alias("feature", "_v"))
    return e.select("pricing_id", "feature", F.try_variant_get("_v", "$", "double").alias("value"))


@query("numeric_features", oracle=_W + _NUMERIC_KEYS)
def q_numeric_features(spark, sf_dir):
    """P10: needs the window's rows alone, not their halves."""
    return M.numeric_features(M.feature_values(M.history_window(fixtures(spark, sf_dir).pricing_history, LOG_AS_OF, WINDOW_DAYS)))


@query("feature_drift_stats", oracle=rnd(_W + _stats_sql(_FEATURE_LONG), _STAT_COLS))
def q_feature_drift_stats(spark, sf_dir):
    return rounded(M.feature_stats(_split(fixtures(spark, sf_dir))).drop("_lo", "_hi"))


@query("feature_psi", oracle=rnd(_W + _psi_sql(_FEATURE_LONG), ["psi"]))
def q_feature_psi(spark, sf_dir):
    return rounded(M.feature_psi(_split(fixtures(spark, sf_dir))))


_PRED_LONG = f"SELECT model_id, period, 'final_premium' AS feature, final_premium AS value FROM ({_SPLIT})"


@query("prediction_drift", oracle=rnd(_W + f"""
SELECT s.* EXCLUDE (feature), p.psi FROM ({_stats_sql(_PRED_LONG)}) s
LEFT JOIN ({_psi_sql(_PRED_LONG)}) p USING (model_id, feature)""", _STAT_COLS + ["psi"]))
def q_prediction_drift(spark, sf_dir):
    return rounded(M.prediction_drift(_split(fixtures(spark, sf_dir))))


def _fmt(x):
    return f"printf('%.2f', {x})"


@query("model_health", oracle=_W + f"""
SELECT model_id,
  CASE WHEN len(pi) > 0 THEN 'degraded' ELSE 'healthy' END AS performance_status,
  CASE WHEN len(fi) > 0 THEN 'degraded' ELSE 'healthy' END AS feature_drift_status,
  CASE WHEN len(di) > 0 THEN 'degraded' ELSE 'healthy' END AS prediction_drift_status,
  CASE WHEN len(pi) + len(fi) + len(di) > 0 THEN 'degraded' ELSE 'healthy' END AS overall_status,
  array_to_string(list_concat(list_concat(pi, fi), di), '; ') AS issues
FROM (
  SELECT p.model_id,
    list_filter([CASE WHEN p.mape > 15.0 THEN 'MAPE is ' || {_fmt('p.mape')} || '%, which is above the threshold of 15.0%' END,
                 CASE WHEN p.r2 < 0.7 THEN 'R-squared is ' || {_fmt('p.r2')} || ', which is below the threshold of 0.7' END,
                 CASE WHEN abs(p.bias) > 100.0 THEN 'Bias is $' || {_fmt('abs(p.bias)')} || ', which is above the threshold of $100.0' END],
                lambda x: x IS NOT NULL) AS pi,
    COALESCE(f.fi, []) AS fi,
    list_filter([CASE WHEN d.psi > 0.2 THEN 'Prediction PSI is ' || {_fmt('d.psi')} || ', which is above the threshold of 0.2' END,
                 CASE WHEN abs(d.mean_diff) > 0.1 THEN 'Prediction mean difference is ' || {_fmt('abs(d.mean_diff)')} || ', which is above the threshold of 0.1' END],
                lambda x: x IS NOT NULL) AS di
  FROM (SELECT model_id, CASE WHEN sst = 0 THEN CASE WHEN sse = 0 THEN 1.0 ELSE 0.0 END ELSE 1 - sse / sst END AS r2,
               mape, bias FROM (
          SELECT model_id, sum((a - p) * (a - p)) AS sse, avg(abs((a - p) / NULLIF(a, 0))) * 100 AS mape,
                 avg(p - a) AS bias, count(*) * var_pop(a) AS sst
          FROM (SELECT model_id, base_premium AS p, final_premium AS a FROM ({_WINDOWED})) GROUP BY 1)) p
  LEFT JOIN (SELECT model_id, flatten(list(i ORDER BY feature)) AS fi FROM (
      SELECT s.model_id, s.feature, list_filter([
          CASE WHEN k.psi > 0.2 THEN 'Feature ''' || s.feature || ''' has PSI of ' || {_fmt('k.psi')} || ', which is above the threshold of 0.2' END,
          CASE WHEN abs(s.mean_diff) > 0.1 THEN 'Feature ''' || s.feature || ''' has mean difference of ' || {_fmt('abs(s.mean_diff)')} || ', which is above the threshold of 0.1' END],
          lambda x: x IS NOT NULL) AS i
      FROM ({_stats_sql(_FEATURE_LONG)}) s LEFT JOIN ({_psi_sql(_FEATURE_LONG)}) k USING (model_id, feature))
    GROUP BY model_id) f USING (model_id)
  LEFT JOIN (SELECT s.model_id, s.mean_diff, p.psi FROM ({_stats_sql(_PRED_LONG)}) s
             LEFT JOIN ({_psi_sql(_PRED_LONG)}) p USING (model_id, feature)) d USING (model_id))""")
def q_model_health(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    hist = M.history_window(fx.pricing_history, LOG_AS_OF, WINDOW_DAYS)
    split = M.period_split(hist)
    return M.model_health(M.performance(hist), M.feature_drift(split), M.prediction_drift(split))


@query("pricing_statistics", oracle=rnd(_W + """
SELECT model_id, CAST(date_trunc('day', created_at) AS DATE) AS request_date, count(*) AS request_count,
  avg(final_premium) AS avg_premium, min(final_premium) AS min_premium, max(final_premium) AS max_premium,
  stddev_samp(final_premium) AS stddev_premium
FROM fx_pricing_history GROUP BY 1, 2""", ["avg_premium", "min_premium", "max_premium", "stddev_premium"]))
def q_pricing_statistics(spark, sf_dir):
    """Daily pricing statistics per model."""
    from policylens.operators import registry as R
    return rounded(R.pricing_statistics(fixtures(spark, sf_dir).pricing_history))
