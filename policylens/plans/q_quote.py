"""Queries: quotes, scaling, contributions, accuracy metrics, statistics, splits."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.operators import features, metrics, quote, rating, registry, scaling
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.plans.q_features import (_SQL_PREMIUM, _SQL_RATE_D, _SQL_RATE_H, _SQL_RATE_L, _SQL_RATE_V, _WITH_ALL,
                                         AS_OF)
from policylens.plans.q_policy import _PF_DOUBLES, _PF_SQL, vocab_for
from policylens.plans.q_registry import _IMP_SQL
from policylens.sources.tables import with_clause

def _premiums(fx):
    return rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF)


def _policy_features(fx):
    return features.policy_features(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations,
                                    vocab_for(fx), AS_OF)


def _importances(fx) -> dict[int, dict[str, float]]:
    """Every registered model's importance vector (bounded by models and features)."""
    out: dict[int, dict[str, float]] = {}
    for r in registry.importance_rows(fx.importances).collect():
        out.setdefault(r["model_id"], {})[r["feature_name"]] = float(r["importance"])
    return out


def _scaled(fx):
    pf = _policy_features(fx)
    return scaling.standard_scale(pf, features.feature_names(pf))


def _contribution_arrays(fx):
    """(model_id, policy_id, contributions): each policy's contributions under every model as an array, and the features in it by model."""
    scaled = _scaled(fx)
    each, names = [], {}
    for m, imp in sorted(_importances(fx).items()):
        held = [(n, w) for n, w in sorted(imp.items()) if n in scaled.columns]
        names[m] = [n for n, _ in held]
        each.append(F.struct(F.lit(m).alias("model_id"), F.array(*[F.col(n) * F.lit(w) for n, w in held]).alias("contributions")))
    return scaled.select("policy_id", F.inline(F.array(*each))), names


# ---- oracle pieces ---------------------------------------------------------------------

_PRED = f"SELECT policy_id, premium AS prediction FROM ({_SQL_PREMIUM})"
_BASE = ("CASE WHEN prediction > 100 THEN 1000.0 * prediction "
         "ELSE 1000.0 * least(greatest(prediction / 1000.0, 0.5), 2.0) END")
_CREDIT = ("CASE WHEN NULLIF(credit_score, 0) IS NULL THEN NULL WHEN credit_score >= 800 THEN 0.8 "
           "WHEN credit_score >= 740 THEN 0.9 WHEN credit_score >= 670 THEN 1.0 WHEN credit_score >= 580 THEN 1.2 "
           "ELSE 1.5 END")
_INSUR = ("CASE WHEN NULLIF(insurance_score, 0) IS NULL THEN NULL WHEN insurance_score >= 90 THEN 0.8 "
          "WHEN insurance_score >= 80 THEN 0.9 WHEN insurance_score >= 70 THEN 1.0 WHEN insurance_score >= 60 THEN 1.1 "
          "WHEN insurance_score >= 50 THEN 1.2 ELSE 1.3 END")
_QUOTE = f"""SELECT policy_id, prediction, base_premium,
  base_premium * COALESCE(credit_factor, 1) * COALESCE(insurance_factor, 1) * COALESCE(territory_factor, 1)
    AS final_premium, credit_factor, insurance_factor, territory_factor
FROM (SELECT q.policy_id, q.prediction, {_BASE} AS base_premium, CAST({_CREDIT} AS DOUBLE) AS credit_factor,
             CAST({_INSUR} AS DOUBLE) AS insurance_factor, NULLIF(p.territory_factor, 0) AS territory_factor
      FROM ({_PRED}) q LEFT JOIN fx_policy p USING (policy_id))"""

_SCALED_SQL = "SELECT policy_id, " + ", ".join(
    f'("{c}" - avg("{c}") OVER ()) / COALESCE(NULLIF(stddev_pop("{c}") OVER (), 0), 1) AS "{c}"'
    for c in _PF_DOUBLES) + f" FROM ({_PF_SQL})"
_CONTRIB_SQL = f"""SELECT i.model_id, u.policy_id, u.feature, u.v * i.importance AS contribution
FROM (UNPIVOT ({_SCALED_SQL}) ON {", ".join(f'"{c}"' for c in _PF_DOUBLES)} INTO NAME feature VALUE v) u
JOIN ({_IMP_SQL}) i ON u.feature = i.feature_name"""
_WITH_Q = with_clause("fx_policy", "fx_driver", "fx_vehicle", "fx_history", "fx_location", "fx_importance")


@query("quote_base", oracle=rnd(_WITH_ALL + f"SELECT policy_id, prediction, {_BASE} AS base_premium FROM ({_PRED})",
                                ["prediction", "base_premium"], 2))
def q_quote_base(spark, sf_dir):
    """M12 over the rated premium as the model prediction."""
    fx = fixtures(spark, sf_dir)
    p = _premiums(fx).select("policy_id", F.col("premium").alias("prediction"))
    return rounded(p.select("policy_id", "prediction", quote.base_premium(F.col("prediction")).alias("base_premium")),
                   2)


@query("quote_final", oracle=rnd(_WITH_ALL + f"SELECT policy_id, base_premium, final_premium FROM ({_QUOTE})",
                                 ["base_premium", "final_premium"], 2))
def q_quote_final(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    p = _premiums(fx).select("policy_id", F.col("premium").alias("prediction"))
    return rounded(quote.quote(p, fx.policies).select("policy_id", "base_premium", "final_premium"), 2)


@query("quote_factors", oracle=rnd(_WITH_ALL + f"""
SELECT policy_id, credit_factor, insurance_factor, territory_factor,
  concat_ws(',', CASE WHEN credit_factor IS NOT NULL THEN 'credit_factor' END,
                 CASE WHEN insurance_factor IS NOT NULL THEN 'insurance_factor' END,
                 CASE WHEN territory_factor IS NOT NULL THEN 'territory_factor' END) AS factor_keys
FROM ({_QUOTE})""", ["credit_factor", "insurance_factor", "territory_factor"]))
def q_quote_factors(spark, sf_dir):
    """Applied pricing factors; absent ones are not in the factors map."""
    fx = fixtures(spark, sf_dir)
    p = _premiums(fx).select("policy_id", F.col("premium").alias("prediction"))
    q = quote.quote(p, fx.policies)
    return rounded(q.select("policy_id", "credit_factor", "insurance_factor", "territory_factor",
                            F.array_join(F.array_sort(F.map_keys("factors")), ",").alias("factor_keys")))


_GROUP_SQL = f"""SELECT model_id, policy_id,
  CASE WHEN t > 0 THEN d / t ELSE 0.25 END AS driver_factor, CASE WHEN t > 0 THEN v / t ELSE 0.25 END AS vehicle_factor,
  CASE WHEN t > 0 THEN h / t ELSE 0.25 END AS history_factor, CASE WHEN t > 0 THEN l / t ELSE 0.25 END AS location_factor
FROM (SELECT *, d + v + h + l AS t FROM (
  SELECT model_id, policy_id,
    COALESCE(sum(contribution) FILTER (WHERE feature LIKE 'driver\\_%' ESCAPE '\\'), 0) AS d,
    COALESCE(sum(contribution) FILTER (WHERE feature LIKE 'vehicle\\_%' ESCAPE '\\'), 0) AS v,
    COALESCE(sum(contribution) FILTER (WHERE feature IN ('accident_count', 'violation_count', 'claim_count',
      'at_fault_count', 'total_claim_amount', 'years_since_last_incident', 'incident_severity_score')), 0) AS h,
    COALESCE(sum(contribution) FILTER (WHERE feature LIKE 'location\\_%' ESCAPE '\\'
      OR feature IN ('crime_rate', 'weather_risk', 'traffic_density')), 0) AS l
  FROM ({_CONTRIB_SQL}) GROUP BY model_id, policy_id))"""


# Shares divide by the group total, which can nearly cancel for a policy; two
# places keep the compare insensitive to summation order there.
@query("group_factors", oracle=rnd(_WITH_Q + _GROUP_SQL,
                                   ["driver_factor", "vehicle_factor", "history_factor", "location_factor"], 2))
def q_group_factors(spark, sf_dir):
    """M7: group shares of scaled value x importance of every policy under every registered model."""
    fx = fixtures(spark, sf_dir)
    return rounded(quote.group_factors_by_model(_scaled(fx), _importances(fx)), 2)


_ALL_FACTORS = [f"{g}_factor" for g in quote.GROUPS] + ["credit_factor", "insurance_factor", "territory_factor"]


@query("quote_batch", oracle=rnd(_WITH_Q + f"""
SELECT model_id, policy_id, base_premium, final_premium, {", ".join(_ALL_FACTORS)}
FROM ({_QUOTE}) JOIN ({_GROUP_SQL}) USING (policy_id)""", ["base_premium", "final_premium", *_ALL_FACTORS], 2))
def q_quote_batch(spark, sf_dir):
    """Features -> prediction -> group factors -> base -> final, as one job."""
    fx = fixtures(spark, sf_dir)
    p = _premiums(fx).select("policy_id", F.col("premium").alias("prediction"))
    gf = quote.group_factors_by_model(_scaled(fx), _importances(fx))
    q = quote.quote(gf.join(p, "policy_id"), fx.policies, grouped=True, keep=("model_id",))
    return rounded(q.select("model_id", "policy_id", "base_premium", "final_premium",
                            *[F.col("factors")[c].alias(c) for c in _ALL_FACTORS]), 2)


@query("mean_abs", oracle=rnd(_WITH_Q + f"""
SELECT model_id, feature, avg(abs(contribution)) AS mean_abs FROM ({_CONTRIB_SQL}) GROUP BY 1, 2""", ["mean_abs"]))
def q_mean_abs(spark, sf_dir):
    """Mean |contribution| per model and feature."""
    return rounded(metrics.mean_abs_arrays(*_contribution_arrays(fixtures(spark, sf_dir)), "model_id"))


@query("top_contributions", oracle=rnd(_WITH_Q + f"""
SELECT model_id, feature, mean_abs, row_number() OVER (PARTITION BY model_id ORDER BY place DESC) AS position FROM (
  SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY mean_abs DESC, feature) AS place FROM (
    SELECT model_id, feature, avg(abs(contribution)) AS mean_abs FROM ({_CONTRIB_SQL}) GROUP BY 1, 2))
WHERE place <= 5""", ["mean_abs"]))
def q_top_contributions(spark, sf_dir):
    """Per model, the 5 features with the largest mean |contribution|, ascending."""
    rows, names = _contribution_arrays(fixtures(spark, sf_dir))
    t = metrics.top_by_mean_abs(rows, 5, names=names)
    return rounded(t.withColumn("position", F.col("position").cast("long")))


@query("contribution_sort", oracle=_WITH_Q + f"""
SELECT model_id, policy_id, string_agg(feature, ',' ORDER BY round(abs(contribution), 4) DESC, feature) AS features_by_impact
FROM ({_CONTRIB_SQL}) GROUP BY 1, 2""")
def q_contribution_sort(spark, sf_dir):
    """Each policy's features under every model by |contribution| (to four places, ties by name), sorted in place."""
    rows, names = _contribution_arrays(fixtures(spark, sf_dir))
    sorted_ = metrics.sort_arrays_by_abs(rows, names, by="model_id", digits=4, out="features_by_impact", joined=",")
    return sorted_.select("model_id", "policy_id", "features_by_impact")


@query("standard_scale", oracle=rnd(_SCALED_SQL, _PF_DOUBLES))
def q_standard_scale(spark, sf_dir):
    """Every policy feature scaled by mean and population std (std 0 -> 1)."""
    pf = _policy_features(fixtures(spark, sf_dir))
    return rounded(scaling.standard_scale(pf, features.feature_names(pf)))


_ROBUST_STATS = ", ".join(
    f'quantile_cont("{c}", 0.5) AS "m_{c}", quantile_cont("{c}", 0.75) - quantile_cont("{c}", 0.25) AS "i_{c}"'
    for c in _PF_DOUBLES)
_ROBUST = (f"SELECT p.policy_id, " + ", ".join(
    f'(p."{c}" - s."m_{c}") / COALESCE(NULLIF(s."i_{c}", 0), 1) AS "{c}"' for c in _PF_DOUBLES)
    + f" FROM ({_PF_SQL}) p CROSS JOIN (SELECT {_ROBUST_STATS} FROM ({_PF_SQL})) s")


@query("robust_scale", oracle=rnd(_ROBUST, _PF_DOUBLES))
def q_robust_scale(spark, sf_dir):
    """X11: (x - median) / IQR per feature, exact quantiles (IQR 0 -> 1)."""
    pf = _policy_features(fixtures(spark, sf_dir))
    return rounded(scaling.robust_scale(pf, features.feature_names(pf)))


_EXTRA = ["location_state_WA_mean", "location_state_WA_max", "location_state_WA_min"]


@query("feature_align", oracle=rnd(
    f"SELECT *, {', '.join(f'0.0::DOUBLE AS {c}' for c in _EXTRA)} FROM ({_PF_SQL})", _PF_DOUBLES + _EXTRA))
def q_feature_align(spark, sf_dir):
    """Project to a frozen spec that also knows a state unseen here (-> 0)."""
    pf = _policy_features(fixtures(spark, sf_dir))
    names = features.feature_names(pf) + _EXTRA
    return rounded(scaling.align(pf, names))


# ---- accuracy metrics over the prediction log ---------------------------------------------

_METRIC_COLS = ["mse", "rmse", "mae", "r2", "mape", "medae"]
_METRIC_DIGITS = {"mse": 2, "rmse": 4, "mae": 4}


def _metrics_sql(src):
    return f"""SELECT model_id, avg((y - p) * (y - p)) AS mse, sqrt(avg((y - p) * (y - p))) AS rmse,
  avg(abs(y - p)) AS mae,
  CASE WHEN count(*) * var_pop(y) = 0 THEN CASE WHEN sum((y - p) * (y - p)) = 0 THEN 1.0 ELSE 0.0 END
       ELSE 1 - sum((y - p) * (y - p)) / (count(*) * var_pop(y)) END AS r2,
  avg(abs((y - p) / NULLIF(y, 0))) * 100 AS mape, count(*) AS n, median(abs(y - p)) AS medae
FROM ({src}) GROUP BY model_id"""


@query("regression_metrics", oracle=rnd(with_clause("fx_prediction") + _metrics_sql("SELECT * FROM fx_prediction"),
                                        _METRIC_COLS, per_col=_METRIC_DIGITS))
def q_regression_metrics(spark, sf_dir):
    """M3 + M4 + A17 per model."""
    return rounded(metrics.regression_metrics(fixtures(spark, sf_dir).predictions), big_digits=_METRIC_DIGITS)


_ENS_W = {"m1": 2.0, "m2": 1.0}
_PER_KEY = "SELECT row_id // 10 AS row_id, model_id, sum(y) AS y, sum(p) AS prediction FROM fx_prediction GROUP BY 1, 2"
_ENS_SQL = f"""SELECT row_id, sum(w * prediction) AS ensemble_prediction, count(*) AS n_models
FROM ({_PER_KEY}) JOIN (VALUES ('m1', 2.0 / 3.0), ('m2', 1.0 / 3.0)) wt(model_id, w) USING (model_id)
GROUP BY row_id"""


def _per_key(fx):
    p = fx.predictions
    return p.groupBy((F.col("row_id") / 10).cast("long").alias("row_id"), "model_id").agg(
        F.sum("y").alias("y"), F.sum("p").alias("prediction"))


@query("ensemble_predict", oracle=rnd(with_clause("fx_prediction") + _ENS_SQL, ["ensemble_prediction"], 4))
def q_ensemble_predict(spark, sf_dir):
    """Weighted ensemble (weights 2:1 normalised) per order."""
    return rounded(metrics.ensemble(_per_key(fixtures(spark, sf_dir)), _ENS_W), 4)


@query("model_comparison", oracle=rnd(with_clause("fx_prediction") + _metrics_sql(f"""
SELECT row_id, model_id, y, prediction AS p FROM ({_PER_KEY})
UNION ALL SELECT e.row_id, 'ensemble', t.y, e.ensemble_prediction FROM ({_ENS_SQL}) e
JOIN (SELECT row_id, max(y) AS y FROM ({_PER_KEY}) GROUP BY 1) t USING (row_id)"""),
                                      _METRIC_COLS, per_col=_METRIC_DIGITS))
def q_model_comparison(spark, sf_dir):
    """The same metrics for each model and the ensemble, side by side."""
    fx = fixtures(spark, sf_dir)
    pk = _per_key(fx)
    ens = metrics.ensemble(pk, _ENS_W)
    y = pk.groupBy("row_id").agg(F.max("y").alias("y"))
    long = pk.select("row_id", "model_id", "y", F.col("prediction").alias("p")).unionByName(
        ens.join(y, "row_id").select("row_id", F.lit("ensemble").alias("model_id"), "y",
                                     F.col("ensemble_prediction").alias("p")))
    return rounded(metrics.regression_metrics(long), big_digits=_METRIC_DIGITS)


# ---- statistics over rated premiums ---------------------------------------------------------

_FACTORS = list(rating.ALL_FACTORS)
def _rated(fx):
    return rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF,
                              with_factors=True)


@query("premium_summary", oracle=rnd(_WITH_ALL + f"""
SELECT avg(premium) AS mean, min(premium) AS min, max(premium) AS max, stddev_pop(premium) AS std,
       count(premium) AS n, median(premium) AS median FROM ({_SQL_PREMIUM})""",
                                     ["mean", "min", "max", "std", "median"], 4))
def q_premium_summary(spark, sf_dir):
    """Mean, median, min, max, population std of the premium."""
    return rounded(metrics.column_summary(_premiums(fixtures(spark, sf_dir)), "premium"), 4)


_FACTOR_SQL = f"""SELECT p.policy_id, {", ".join(f"COALESCE({c}, 1.0) AS {c}" for c in _FACTORS)}
FROM fx_policy p LEFT JOIN ({_SQL_RATE_D}) d USING (policy_id) LEFT JOIN ({_SQL_RATE_V}) v USING (policy_id)
LEFT JOIN ({_SQL_RATE_H}) h USING (policy_id) LEFT JOIN ({_SQL_RATE_L}) l USING (policy_id)"""


@query("factor_describe", oracle=rnd(_WITH_ALL + f"""
SELECT "column", count(value) AS count, avg(value) AS mean, stddev_samp(value) AS std, min(value) AS min,
       max(value) AS max, quantile_cont(value, 0.25) AS p25, quantile_cont(value, 0.5) AS p50,
       quantile_cont(value, 0.75) AS p75
FROM (UNPIVOT ({_FACTOR_SQL}) ON {", ".join(_FACTORS)} INTO NAME "column" VALUE value) GROUP BY 1""",
                                     ["mean", "std", "min", "max", "p25", "p50", "p75"]))
def q_factor_describe(spark, sf_dir):
    """describe() of the ten rating factors (exact quartiles)."""
    return rounded(metrics.describe(_rated(fixtures(spark, sf_dir)), _FACTORS))


@query("factor_correlation", oracle=rnd(_WITH_ALL + f"""
SELECT "column", corr(value, premium) AS correlation FROM (
  UNPIVOT (SELECT f.*, r.premium FROM ({_FACTOR_SQL}) f JOIN ({_SQL_PREMIUM}) r USING (policy_id))
  ON {", ".join(_FACTORS)} INTO NAME "column" VALUE value) GROUP BY 1""", ["correlation"]))
def q_factor_correlation(spark, sf_dir):
    """Pearson correlation of each factor with the premium."""
    return rounded(metrics.correlations(_rated(fixtures(spark, sf_dir)), _FACTORS, "premium"))


@query("histogram", oracle=rnd(_WITH_ALL + f"""
SELECT s.bin, s.bin * ((hi - lo) / 10.0) + lo AS lower,
       CASE WHEN s.bin = 9 THEN hi ELSE (s.bin + 1) * ((hi - lo) / 10.0) + lo END AS upper,
       COALESCE(c.n, 0) AS count
FROM (SELECT unnest(range(0, 10)) AS bin, lo, hi FROM (SELECT min(premium) AS lo, max(premium) AS hi
      FROM ({_SQL_PREMIUM}))) s
LEFT JOIN (SELECT {" + ".join(f"CAST(premium >= {i}.0 * ((hi - lo) / 10.0) + lo AS INTEGER)" for i in range(1, 10))}
             AS bin, count(*) AS n
           FROM ({_SQL_PREMIUM}) r, (SELECT min(premium) AS lo, max(premium) AS hi FROM ({_SQL_PREMIUM})) b
           GROUP BY 1) c USING (bin)""", ["lower", "upper"], 4))
def q_histogram(spark, sf_dir):
    """10 equal-width bins of the premium."""
    h = metrics.histogram(_premiums(fixtures(spark, sf_dir)), "premium", 10)
    return rounded(h.withColumn("count", F.col("count").cast("long")), 4)


_SPLIT_KEY = "CAST('0x' || substring(md5('42:' || CAST(policy_id AS VARCHAR)), 1, 13) AS BIGINT)"


@query("train_test_split", oracle=with_clause("fx_policy") + f"""
SELECT policy_id, CASE WHEN rn <= CAST(ceil(n * 0.2) AS BIGINT) THEN 'test' ELSE 'train' END AS split
FROM (SELECT policy_id, row_number() OVER (ORDER BY {_SPLIT_KEY}, policy_id) AS rn, count(*) OVER () AS n
      FROM fx_policy)""")
def q_train_test_split(spark, sf_dir):
    """Exactly ceil(0.2 n) policies in test, chosen by a seeded hash."""
    fx = fixtures(spark, sf_dir)
    return metrics.train_test_split(fx.policies.select("policy_id"), "policy_id", 0.2, 42)


@query("explanation_sample", oracle=with_clause("fx_policy") + f"""
SELECT policy_id, effective_date FROM fx_policy ORDER BY {_SPLIT_KEY}, policy_id LIMIT 100""")
def q_explanation_sample(spark, sf_dir):
    """A deterministic sample of 100 policies (the sample is the feature)."""
    fx = fixtures(spark, sf_dir)
    return metrics.explanation_sample(fx.policies.select("policy_id", "effective_date"), "policy_id", 100, 42)
