"""Queries: registry state, audits, lookups, top-k reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.operators import registry as R
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.sources.tables import with_clause

_STATE_SQL = """SELECT model_id, model_name, model_version,
  COALESCE(activate AND model_id = (SELECT arg_max(model_id, created_at) FROM fx_model_version WHERE activate), false) AS is_active
FROM fx_model_version"""


@query("register_model_state", oracle=with_clause("fx_model_version") + _STATE_SQL)
def q_register_model_state(spark, sf_dir):
    return R.register_state(fixtures(spark, sf_dir).model_versions)


@query("active_model", oracle=with_clause("fx_model_version") + f"""
SELECT model_id, model_name, model_version FROM ({_STATE_SQL}) WHERE is_active""")
def q_active_model(spark, sf_dir):
    return R.active_model(R.register_state(fixtures(spark, sf_dir).model_versions))


@query("model_metrics_pivot", oracle=rnd(with_clause("fx_metric") + """
SELECT model_id,
  max(CASE WHEN metric_name = 'mae' THEN v END) AS mae, max(CASE WHEN metric_name = 'mse' THEN v END) AS mse,
  max(CASE WHEN metric_name = 'r2' THEN v END) AS r2, max(CASE WHEN metric_name = 'rmse' THEN v END) AS rmse
FROM (SELECT model_id, metric_name, arg_max(metric_value, metric_id) AS v FROM fx_metric GROUP BY 1, 2)
GROUP BY model_id""", ["mae", "mse", "r2", "rmse"]))
def q_model_metrics_pivot(spark, sf_dir):
    return rounded(R.metrics_pivot(fixtures(spark, sf_dir).metrics))


@query("metrics_explode", oracle=rnd(with_clause("fx_metric") + """
SELECT model_id, metric_name, arg_max(metric_value, metric_id) AS metric_value FROM fx_metric GROUP BY 1, 2""",
                                     ["metric_value"]))
def q_metrics_explode(spark, sf_dir):
    """metrics JSON object per model back to (model, name, value) rows."""
    m = R.metrics_map(fixtures(spark, sf_dir).metrics)
    as_json = m.select("model_id", F.to_json("metrics").alias("metrics_json"))
    back = as_json.select("model_id", F.explode(F.from_json("metrics_json", "map<string,double>"))
                          .alias("metric_name", "metric_value"))
    return rounded(back)


@query("fk_orphans", oracle=with_clause("fx_model_version", "fx_importance", "fx_metric", "fx_pricing_history") + """
SELECT source, model_id, count(*) AS n FROM (
  SELECT 'feature_importance' AS source, CAST(model_id AS VARCHAR) AS model_id FROM fx_importance
  UNION ALL SELECT 'model_metrics', CAST(model_id AS VARCHAR) FROM fx_metric
  UNION ALL SELECT 'pricing_history', CAST(model_id AS VARCHAR) FROM fx_pricing_history) c
WHERE model_id NOT IN (SELECT CAST(model_id AS VARCHAR) FROM fx_model_version)
GROUP BY 1, 2""")
def q_fk_orphans(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return R.fk_orphans({"feature_importance": fx.importances, "model_metrics": fx.metrics,
                         "pricing_history": fx.pricing_history}, fx.model_versions)


@query("unique_violations", oracle=with_clause("fx_model_version", "fx_importance", "fx_metric") + """
SELECT 'model_versions' AS source, model_name || '|' || model_version AS key, count(*) AS n
FROM fx_model_version GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'feature_importance', CAST(model_id AS VARCHAR) || '|' || feature_name, count(*)
FROM fx_importance GROUP BY 1, 2 HAVING count(*) > 1
UNION ALL SELECT 'model_metrics', CAST(model_id AS VARCHAR) || '|' || metric_name, count(*)
FROM fx_metric GROUP BY 1, 2 HAVING count(*) > 1""")
def q_unique_violations(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return R.unique_violations({"model_versions": (fx.model_versions, ["model_name", "model_version"]),
                                "feature_importance": (fx.importances, ["model_id", "feature_name"]),
                                "model_metrics": (fx.metrics, ["model_id", "metric_name"])})


@query("model_id_by_version", oracle=with_clause("fx_model_version", "fx_metric") + """
SELECT m.metric_id, m.model_version, v.model_id AS resolved_model_id
FROM (SELECT metric_id, CAST(20250413000000 + CAST(model_id AS BIGINT) AS VARCHAR) AS model_version FROM fx_metric) m
LEFT JOIN fx_model_version v ON v.model_version = m.model_version""")
def q_model_id_by_version(spark, sf_dir):
    """Each metric row's model resolved through its version string."""
    fx = fixtures(spark, sf_dir)
    lookups = fx.metrics.select(
        "metric_id", (F.lit(20250413000000) + F.col("model_id").cast("long")).cast("string").alias("model_version"))
    return R.model_id_by_version(fx.model_versions, lookups).select("metric_id", "model_version", "resolved_model_id")


_PIVOT_SQL = """SELECT model_id,
  max(CASE WHEN metric_name = 'mae' THEN v END) AS mae, max(CASE WHEN metric_name = 'mse' THEN v END) AS mse,
  max(CASE WHEN metric_name = 'r2' THEN v END) AS r2, max(CASE WHEN metric_name = 'rmse' THEN v END) AS rmse
FROM (SELECT model_id, metric_name, arg_max(metric_value, metric_id) AS v FROM fx_metric GROUP BY 1, 2) GROUP BY model_id"""


@query("recent_versions", oracle=rnd(with_clause("fx_model_version", "fx_metric") + f"""
SELECT v.model_id, v.model_name, v.model_version, 'models/' || v.model_name || '_' || v.model_version || '/model' AS model_path, s.is_active,
  v.created_at, m.mae, m.mse, m.r2, m.rmse
FROM (SELECT * FROM fx_model_version ORDER BY created_at DESC LIMIT 10) v JOIN ({_STATE_SQL}) s USING (model_id)
LEFT JOIN ({_PIVOT_SQL}) m USING (model_id)""", ["mae", "mse", "r2", "rmse"]))
def q_recent_versions(spark, sf_dir):
    """The ten newest registrations (by time, which is not the order of ids) with path, flag and metrics."""
    fx = fixtures(spark, sf_dir)
    return rounded(R.version_listing(fx.model_versions, fx.metrics, 10))


_PATHS = "SELECT model_id, 'models/' || model_name || '_' || model_version || '/model' AS model_path FROM fx_model_version"


@query("model_path_parse", oracle=with_clause("fx_model_version") + f"""
SELECT model_id, model_path, regexp_extract(model_path, '([a-z_]+)_(\\d{{14}})', 1) AS parsed_name,
       regexp_extract(model_path, '([a-z_]+)_(\\d{{14}})', 2) AS parsed_version FROM ({_PATHS})""")
def q_model_path_parse(spark, sf_dir):
    return R.parse_model_paths(R.model_paths(fixtures(spark, sf_dir).model_versions))


@query("latest_model", oracle=with_clause("fx_model_version") + f"""
SELECT model_name AS parsed_name, max(model_version) AS latest_version,
       arg_max(model_path, model_version) AS latest_path
FROM (SELECT p.model_path, v.model_name, v.model_version FROM ({_PATHS}) p JOIN fx_model_version v USING (model_id))
GROUP BY 1""")
def q_latest_model(spark, sf_dir):
    return R.latest_model(R.model_paths(fixtures(spark, sf_dir).model_versions))


_IMP_SQL = "SELECT model_id, feature_name, arg_max(importance, feature_id) AS importance FROM fx_importance GROUP BY 1, 2"


@query("importance_rows", oracle=rnd(with_clause("fx_importance") + _IMP_SQL, ["importance"]))
def q_importance_rows(spark, sf_dir):
    return rounded(R.importance_rows(fixtures(spark, sf_dir).importances))


@query("top_features", oracle=rnd(with_clause("fx_importance") + f"""
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY importance DESC, feature_name) AS rank
               FROM ({_IMP_SQL})) WHERE rank <= 5""", ["importance"]))
def q_top_features(spark, sf_dir):
    """Top 5 features per model."""
    imp = R.importance_rows(fixtures(spark, sf_dir).importances)
    return rounded(R.top_features(imp, 5).withColumn("rank", F.col("rank").cast("long")))


@query("model_info", oracle=rnd(with_clause("fx_model_version", "fx_metric") + f"""
SELECT a.model_id, a.model_name, a.model_version, m.mae, m.mse, m.r2, m.rmse
FROM (SELECT model_id, model_name, model_version FROM ({_STATE_SQL}) WHERE is_active) a
LEFT JOIN (SELECT model_id,
             max(CASE WHEN metric_name = 'mae' THEN v END) AS mae, max(CASE WHEN metric_name = 'mse' THEN v END) AS mse,
             max(CASE WHEN metric_name = 'r2' THEN v END) AS r2, max(CASE WHEN metric_name = 'rmse' THEN v END) AS rmse
           FROM (SELECT model_id, metric_name, arg_max(metric_value, metric_id) AS v FROM fx_metric GROUP BY 1, 2)
           GROUP BY 1) m USING (model_id)""", ["mae", "mse", "r2", "rmse"]))
def q_model_info(spark, sf_dir):
    """The active model with its latest metrics (the service's model-info payload)."""
    fx = fixtures(spark, sf_dir)
    active = R.active_model(R.register_state(fx.model_versions))
    return rounded(active.join(R.metrics_pivot(fx.metrics), "model_id", "left"))
