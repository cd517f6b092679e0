"""Queries: training data rows, pricing-log rows, monitoring-log rows (read back)."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.operators import monitor as M
from policylens.operators import quote, rating, registry
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.plans.q_features import _SQL_PREMIUM, _WITH_ALL, AS_OF
from policylens.plans.q_monitor import (_FEATURE_LONG, _PRED_LONG, _SPLIT, _W, _WINDOWED, WINDOW_DAYS,
                                        _psi_sql, _stats_sql)
from policylens.plans.q_quote import _QUOTE
from policylens.plans.q_registry import _IMP_SQL
from policylens.sources import nested, sinks
from policylens.sources.tables import LOG_AS_OF, with_clause


@query("training_data_json", oracle=rnd(_WITH_ALL + f"""
SELECT p.policy_id, p.effective_date, CAST(COALESCE(d.n, 0) AS INTEGER) AS num_drivers, r.premium
FROM fx_policy p JOIN ({_SQL_PREMIUM}) r USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) AS n FROM fx_driver GROUP BY 1) d USING (policy_id)""", ["premium"], 4))
def q_training_data_json(spark, sf_dir):
    """Policy JSON + premium rows, written; fields read back from the JSON text."""
    fx = fixtures(spark, sf_dir)
    pn = nested.nest_policies(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations)
    prem = rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF)
    path = sinks.new_path(spark, "training-data")
    sinks.write_training_data(sinks.training_data(pn, prem), path)
    t = spark.read.parquet(path)
    back = t.select("policy_id", F.get_json_object("policy_data", "$.effective_date").cast("date")
                    .alias("effective_date"),
                    F.json_array_length(F.get_json_object("policy_data", "$.drivers")).alias("num_drivers"),
                    "premium")
    return rounded(back.groupBy("policy_id", "effective_date", "premium")
                   .agg(F.sum("num_drivers").cast("int").alias("num_drivers")), 4)


@query("pricing_log_append", oracle=rnd(_WITH_ALL + f"""
SELECT policy_id, 'rating_rules' AS model_id, base_premium, final_premium,
  CAST((credit_factor IS NOT NULL)::INT + (insurance_factor IS NOT NULL)::INT + (territory_factor IS NOT NULL)::INT
       AS INTEGER) AS n_adjustments
FROM ({_QUOTE})""", ["base_premium", "final_premium"], 2))
def q_pricing_log_append(spark, sf_dir):
    """Pricing-log rows for every quote, appended by day and read back (ids and times left out of the compare)."""
    fx = fixtures(spark, sf_dir)
    p = rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF)
    q = quote.quote(p.select("policy_id", F.col("premium").alias("prediction")), fx.policies)
    path = sinks.new_path(spark, "pricing-log")
    sinks.append_pricing_log(sinks.pricing_log_rows(q, "rating_rules"), path)
    rows = spark.read.parquet(path)
    return rounded(rows.select("policy_id", "model_id", "base_premium", "final_premium",
                               F.size(F.from_json("adjustments", "map<string,double>")).alias("n_adjustments")), 2)


_PERF_LONG = f"""SELECT model_id, 'performance' AS metric_type, metric_name, metric_value FROM (
  UNPIVOT (SELECT model_id, avg((a - p) * (a - p)) AS mse, sqrt(avg((a - p) * (a - p))) AS rmse,
                  avg(abs(a - p)) AS mae, avg(abs((a - p) / NULLIF(a, 0))) * 100 AS mape,
                  CASE WHEN count(*) * var_pop(a) = 0 THEN CASE WHEN sum((a - p) * (a - p)) = 0 THEN 1.0 ELSE 0.0 END
                       ELSE 1 - sum((a - p) * (a - p)) / (count(*) * var_pop(a)) END AS r2,
                  avg(p - a) AS bias, CAST(count(*) AS DOUBLE) AS sample_size
           FROM (SELECT model_id, base_premium AS p, final_premium AS a FROM ({_WINDOWED})) GROUP BY 1)
  ON mse, rmse, mae, mape, r2, bias, sample_size INTO NAME metric_name VALUE metric_value)"""
_DRIFT = ", ".join(f"s.{m}" for m in sinks.DRIFT_METRICS if m != "psi")
_FD_LONG = f"""SELECT model_id, 'feature_drift' AS metric_type, feature || '.' || metric_name AS metric_name,
  metric_value FROM (
  UNPIVOT (SELECT s.model_id, s.feature, {_DRIFT}, k.psi
           FROM ({_stats_sql(_FEATURE_LONG)}) s LEFT JOIN ({_psi_sql(_FEATURE_LONG)}) k USING (model_id, feature))
  ON {", ".join(sinks.DRIFT_METRICS)} INTO NAME metric_name VALUE metric_value)"""
_PD_LONG = f"""SELECT model_id, 'prediction_drift' AS metric_type, metric_name, metric_value FROM (
  UNPIVOT (SELECT s.model_id, {_DRIFT}, k.psi
           FROM ({_stats_sql(_PRED_LONG)}) s LEFT JOIN ({_psi_sql(_PRED_LONG)}) k USING (model_id, feature))
  ON {", ".join(sinks.DRIFT_METRICS)} INTO NAME metric_name VALUE metric_value)"""


_BOUNDS = f"""SELECT model_id, min(created_at) FILTER (period = 'reference') AS reference_start,
  max(created_at) FILTER (period = 'reference') AS reference_end, min(created_at) FILTER (period = 'current') AS current_start,
  max(created_at) FILTER (period = 'current') AS current_end FROM ({_SPLIT}) GROUP BY 1"""
_LOG_LONG = f"""SELECT l.*, b.reference_start, b.reference_end, b.current_start, b.current_end
FROM ({_PERF_LONG} UNION ALL {_FD_LONG} UNION ALL {_PD_LONG}) l
LEFT JOIN ({_BOUNDS}) b ON b.model_id = l.model_id AND l.metric_type <> 'performance'"""


@query("monitoring_log", oracle=rnd(_W + _LOG_LONG, ["metric_value"]))
def q_monitoring_log(spark, sf_dir):
    """S6 + F27/F28: monitoring rows as JSON, appended and read back as (model, type, name, value)."""
    fx = fixtures(spark, sf_dir)
    hist = M.history_window(fx.pricing_history, LOG_AS_OF, WINDOW_DAYS)
    split = M.period_split(hist)
    path = sinks.new_path(spark, "monitoring-log")
    sinks.append_monitoring_log(
        sinks.monitoring_rows(M.performance(hist), M.feature_drift(split), M.prediction_drift(split), M.period_bounds(split)), path)
    rows = spark.read.parquet(path)
    return rounded(sinks.monitoring_long(rows).where(F.col("metric_value").isNotNull()))


@query("importance_append", oracle=rnd(with_clause("fx_importance") + f"{_IMP_SQL}", ["importance"]))
def q_importance_append(spark, sf_dir):
    """Importance rows of every registered model, appended and read back (ids and times left out)."""
    path = sinks.new_path(spark, "importances")
    sinks.append_importances(registry.importance_rows(fixtures(spark, sf_dir).importances), path)
    return rounded(spark.read.parquet(path).select("model_id", "feature_name", "importance"))
