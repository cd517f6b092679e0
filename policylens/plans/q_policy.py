"""Queries: per-child feature frames, per-policy aggregates, the wide rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.functions import dims
from policylens.operators import enhanced, features
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.plans.q_features import (AS_OF, SQL_AGE_BAND, SQL_ENH_TERRITORY, SQL_MAKE_MODEL, SQL_TERRITORY,
                                         SQL_VCLASS, sql_case_map, sql_str_map, sql_years)
from policylens.sources.tables import with_clause


def vocab_for(fx):
    """The encoders, fitted on the query's own tables."""
    return features.fit_vocabulary(fx.drivers, fx.vehicles, fx.history, fx.locations)


# ---- oracle-side vocabulary: what the fixture rules can produce -------------------
O_GENDERS = ("female", "male", "other")
O_MARITAL = ("divorced", "married", "single", "widowed")
O_USES = ("business", "commute", "personal")
O_STATES = ("CA", "CO", "DC", "FL", "IA", "KS", "LA", "MT", "NJ", "NY", "OH", "TX", "UT", "ZZ")


def _onehot_null(col, v, name):
    return f"CASE WHEN {col} IS NULL THEN NULL WHEN {col} = '{v}' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS \"{name}\""


def _onehot_int(expr, v, name):
    return f"CAST(COALESCE(({expr}) = '{v}', false) AS INTEGER) AS \"{name}\""


_DRIVER_SRC = f"""(SELECT *, CAST({sql_years('date_of_birth')} AS INTEGER) AS a,
             CAST({sql_years('license_issue_date')} AS INTEGER) AS e FROM fx_driver)"""
_DRIVER_SEL = f"""a AS driver_age, e AS driver_experience,
  {", ".join(_onehot_int(SQL_AGE_BAND, b, "age_band_" + b) for b in dims.AGE_BAND_LABELS)},
  {", ".join(_onehot_null("gender", g, "gender_" + g) for g in O_GENDERS)},
  {", ".join(_onehot_null("marital_status", m, "marital_status_" + m) for m in O_MARITAL)},
  {sql_case_map('lower(occupation)', dims.OCCUPATION_RISK, 1.0)} AS occupation_risk"""
SQL_DRIVER_FRAME = f"SELECT policy_id, {_DRIVER_SEL} FROM {_DRIVER_SRC}"
DRIVER_COLS = (["driver_age", "driver_experience"] + [f"age_band_{b}" for b in dims.AGE_BAND_LABELS]
               + [f"gender_{g}" for g in O_GENDERS] + [f"marital_status_{m}" for m in O_MARITAL]
               + ["occupation_risk"])

SQL_VEHICLE_FRAME = f"""SELECT policy_id, CAST(year(DATE '{AS_OF}') - year AS INTEGER) AS vehicle_age,
  CAST(value AS DOUBLE) AS vehicle_value, annual_mileage, CAST(anti_theft_device AS INTEGER) AS anti_theft_device,
  {sql_case_map('mm', dims.MAKE_MODEL_RISK, 1.0)} AS make_model_risk,
  {", ".join(_onehot_int(SQL_VCLASS, c, "vehicle_class_" + c) for c in dims.VEHICLE_CLASSES)},
  {", ".join(_onehot_null("primary_use", u, "use_" + u) for u in O_USES)}
FROM (SELECT *, {SQL_MAKE_MODEL} AS mm FROM fx_vehicle)"""
VEHICLE_COLS = (["vehicle_age", "vehicle_value", "annual_mileage", "anti_theft_device", "make_model_risk"]
                + [f"vehicle_class_{c}" for c in dims.VEHICLE_CLASSES] + [f"use_{u}" for u in O_USES])

_terr = {k: v for k, v in dims.TERRITORY_RISK.items()}
_LOC_SRC = f"(SELECT *, {SQL_TERRITORY} AS t, {SQL_ENH_TERRITORY} AS et FROM fx_location)"
_LOC_SEL = f"""{sql_case_map('t', {k: v[0] for k, v in _terr.items()}, 1.0)} AS crime_rate,
  {sql_case_map('t', {k: v[1] for k, v in _terr.items()}, 1.0)} AS weather_risk,
  {sql_case_map('t', {k: v[2] for k, v in _terr.items()}, 1.0)} AS traffic_density,
  {", ".join(_onehot_int("t", x, "territory_" + x) for x in dims.TERRITORIES)},
  {", ".join(f"CAST(CAST(COALESCE(state = '{s}', false) AS INTEGER) AS DOUBLE) AS \"state_{s}\"" for s in O_STATES)}"""
SQL_LOCATION_FRAME = f"SELECT policy_id, {_LOC_SEL} FROM {_LOC_SRC}"
LOCATION_COLS = (["crime_rate", "weather_risk", "traffic_density"] + [f"territory_{t}" for t in dims.TERRITORIES]
                 + [f"state_{s}" for s in O_STATES])

SQL_HISTORY_AGG = f"""SELECT policy_id,
  CAST(count_if(incident_type = 'accident') AS DOUBLE) AS accident_count,
  CAST(count_if(incident_type = 'violation') AS DOUBLE) AS violation_count,
  CAST(count_if(incident_type = 'claim') AS DOUBLE) AS claim_count,
  CAST(count_if(at_fault) AS DOUBLE) AS at_fault_count,
  CAST(sum(COALESCE(claim_amount, 0)) AS DOUBLE) AS total_claim_amount,
  CAST({sql_years('max(incident_date)')} AS DOUBLE) AS years_since_last_incident,
  CAST(sum(CASE severity WHEN 'minor' THEN 1 WHEN 'moderate' THEN 2 WHEN 'major' THEN 3 ELSE 0 END) AS DOUBLE)
    AS incident_severity_score
FROM fx_history GROUP BY policy_id"""


def _stats_sql(cols, prefix):
    out = []
    for c in cols:
        v = f'CAST("{c}" AS DOUBLE)'
        out += [f'COALESCE(avg({v}), 0.0::DOUBLE) AS "{prefix}_{c}_mean"',
                f'COALESCE(max({v}), 0.0::DOUBLE) AS "{prefix}_{c}_max"',
                f'COALESCE(min({v}), 0.0::DOUBLE) AS "{prefix}_{c}_min"']
    return out


def _stat_names(cols, prefix):
    return [f"{prefix}_{c}_{s}" for c in cols for s in ("mean", "max", "min")]


def _agg_sql(frame_sql, cols, prefix, count_name):
    return (f"SELECT policy_id, {', '.join(_stats_sql(cols, prefix))}, count(*) AS {count_name} "
            f"FROM ({frame_sql}) GROUP BY policy_id")


HIST_DEFAULTS_SQL = ", ".join(f"COALESCE(h.{c}, {v}::DOUBLE) AS {c}" for c, v in features.HISTORY_DEFAULTS.items())


def policy_features_sql(d_cols, v_cols, l_cols, d_frame, v_frame, l_frame, modes=()):
    d_names, v_names, l_names = (_stat_names(d_cols, "driver"), _stat_names(v_cols, "vehicle"),
                                 _stat_names(l_cols, "location"))
    sel = ["p.policy_id",
           "CAST(p.expiration_date - p.effective_date AS DOUBLE) AS policy_duration_days",
           "CAST(COALESCE(d.num_drivers, 0) AS DOUBLE) AS num_drivers",
           "CAST(COALESCE(v.num_vehicles, 0) AS DOUBLE) AS num_vehicles",
           "CAST(COALESCE(l.num_locations, 0) AS DOUBLE) AS num_locations",
           "CAST(COALESCE(v.num_vehicles, 0) AS DOUBLE) / GREATEST(1, COALESCE(d.num_drivers, 0)) "
           "AS vehicle_per_driver_ratio"]
    sel += [f'COALESCE(d."{n}", 0.0::DOUBLE) AS "{n}"' for n in d_names]
    sel += [f'COALESCE(v."{n}", 0.0::DOUBLE) AS "{n}"' for n in v_names]
    sel += [HIST_DEFAULTS_SQL]
    sel += [f'COALESCE(l."{n}", 0.0::DOUBLE) AS "{n}"' for n in l_names]
    sel += [f"{alias}.{m}" for alias, m in modes]
    sel += ["COALESCE(NULLIF(p.credit_score, 0), 0.0::DOUBLE) AS credit_score",
            "COALESCE(NULLIF(p.insurance_score, 0), 0.0::DOUBLE) AS insurance_score"]
    sql = (with_clause("fx_policy", "fx_driver", "fx_vehicle", "fx_history", "fx_location")
           + f"SELECT {', '.join(sel)} FROM fx_policy p "
           f"LEFT JOIN ({_agg_sql(d_frame, d_cols, 'driver', 'num_drivers')}) d USING (policy_id) "
           f"LEFT JOIN ({_agg_sql(v_frame, v_cols, 'vehicle', 'num_vehicles')}) v USING (policy_id) "
           f"LEFT JOIN ({SQL_HISTORY_AGG}) h USING (policy_id) "
           f"LEFT JOIN ({_agg_sql(l_frame, l_cols, 'location', 'num_locations')}) l USING (policy_id)")
    doubles = (["policy_duration_days", "num_drivers", "num_vehicles", "num_locations", "vehicle_per_driver_ratio"]
               + d_names + v_names + list(features.HISTORY_DEFAULTS) + l_names + ["credit_score", "insurance_score"])
    return sql, doubles


# ---- X1-X4 frames ---------------------------------------------------------------------

@query("driver_features", oracle=rnd(with_clause("fx_driver") + SQL_DRIVER_FRAME, ["occupation_risk"]))
def q_driver_features(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.driver_features(fx.drivers, vocab_for(fx), AS_OF))


@query("vehicle_features", oracle=rnd(with_clause("fx_vehicle") + SQL_VEHICLE_FRAME,
                                      ["vehicle_value", "make_model_risk"]))
def q_vehicle_features(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.vehicle_features(fx.vehicles, vocab_for(fx), AS_OF))


@query("location_features", oracle=with_clause("fx_location") + SQL_LOCATION_FRAME)
def q_location_features(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return features.location_features(fx.locations, vocab_for(fx))


@query("history_features", oracle=rnd(with_clause("fx_policy", "fx_history") + f"""
SELECT p.policy_id, {HIST_DEFAULTS_SQL} FROM fx_policy p LEFT JOIN ({SQL_HISTORY_AGG}) h USING (policy_id)""",
                                      ["total_claim_amount"], 4))
def q_history_features(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.history_with_defaults(fx.policies, fx.history, AS_OF), 4)


# ---- A1 -------------------------------------------------------------------------------

@query("driver_agg", oracle=rnd(with_clause("fx_driver") + _agg_sql(SQL_DRIVER_FRAME, DRIVER_COLS, "driver",
                                                                     "num_drivers"),
                                _stat_names(DRIVER_COLS, "driver")))
def q_driver_agg(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.numeric_stats(features.driver_features(fx.drivers, vocab_for(fx), AS_OF),
                                          "driver", "num_drivers"))


@query("vehicle_agg", oracle=rnd(with_clause("fx_vehicle") + _agg_sql(SQL_VEHICLE_FRAME, VEHICLE_COLS, "vehicle",
                                                                       "num_vehicles"),
                                 _stat_names(VEHICLE_COLS, "vehicle")))
def q_vehicle_agg(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.numeric_stats(features.vehicle_features(fx.vehicles, vocab_for(fx), AS_OF),
                                          "vehicle", "num_vehicles"))


@query("location_agg", oracle=rnd(with_clause("fx_location") + _agg_sql(SQL_LOCATION_FRAME, LOCATION_COLS,
                                                                         "location", "num_locations"),
                                  _stat_names(LOCATION_COLS, "location")))
def q_location_agg(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.numeric_stats(features.location_features(fx.locations, vocab_for(fx)),
                                          "location", "num_locations"))


# ---- X5 (flagship) -----------------------------------------------------------------------

_PF_SQL, _PF_DOUBLES = policy_features_sql(DRIVER_COLS, VEHICLE_COLS, LOCATION_COLS,
                                           SQL_DRIVER_FRAME, SQL_VEHICLE_FRAME, SQL_LOCATION_FRAME)


@query("policy_features", oracle=rnd(_PF_SQL, _PF_DOUBLES))
def q_policy_features(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.policy_features(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations,
                                            vocab_for(fx), AS_OF))


@query("policy_features_sparse", oracle=f"""
SELECT policy_id, name, ROUND(value, 6) + CAST(0 AS DOUBLE) AS value
FROM (UNPIVOT ({_PF_SQL}) ON COLUMNS(* EXCLUDE (policy_id)) INTO NAME name VALUE value) WHERE ROUND(value, 6) <> 0""")
def q_policy_features_sparse(spark, sf_dir):
    """X5 with open vocabularies: every value other than 0 of the sparse rows, by the name of its slot."""
    from policylens.operators import sparse_features
    fx = fixtures(spark, sf_dir)
    rows = sparse_features.policy_vectors(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF,
                                          categories=sparse_features.fit_categories(fx.drivers, fx.vehicles, fx.locations))
    return rounded(rows.named_cells()).where("value <> 0")


# ---- A18 --------------------------------------------------------------------------------

@query("category_vocab", oracle=with_clause("fx_driver", "fx_vehicle", "fx_history", "fx_location") + """
SELECT DISTINCT encoder, category FROM (
  SELECT 'gender' AS encoder, gender AS category FROM fx_driver
  UNION ALL SELECT 'marital_status', marital_status FROM fx_driver
  UNION ALL SELECT 'use', primary_use FROM fx_vehicle
  UNION ALL SELECT 'state', state FROM fx_location
  UNION ALL SELECT 'incident_type', incident_type FROM fx_history
  UNION ALL SELECT 'severity', severity FROM fx_history) WHERE category IS NOT NULL""")
def q_category_vocab(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return features.category_vocab_frame(fx.drivers, fx.vehicles, fx.history, fx.locations)


# ---- X6-X8 ------------------------------------------------------------------------------

_DRIVER_RISK_SEL = """CASE WHEN a BETWEEN 16 AND 24 THEN 1.5::DOUBLE - 0.05::DOUBLE * (a - 16)
       WHEN a BETWEEN 25 AND 64 THEN 1.0::DOUBLE + 0.005::DOUBLE * LEAST(a - 25, 65 - a)
       WHEN a BETWEEN 65 AND 99 THEN 1.0::DOUBLE + 0.02::DOUBLE * (a - 65) ELSE 1.5::DOUBLE END AS age_risk_factor,
  CASE WHEN e BETWEEN 0 AND 2 THEN 1.5::DOUBLE - 0.1::DOUBLE * e
       WHEN e BETWEEN 3 AND 9 THEN 1.3::DOUBLE - 0.04::DOUBLE * (e - 3)
       WHEN e BETWEEN 10 AND 59 THEN 1.0::DOUBLE ELSE 1.5::DOUBLE END AS experience_risk_factor,
  CASE WHEN a > 0 THEN CAST(a - e AS DOUBLE) / a ELSE 1.0::DOUBLE END AS license_recency_factor,
  CAST(a AS DOUBLE) / GREATEST(1, e) AS age_experience_ratio"""
SQL_DRIVER_RISK = f"SELECT policy_id, a AS driver_age, e AS driver_experience, {_DRIVER_RISK_SEL} FROM {_DRIVER_SRC}"
DRIVER_RISK_DOUBLES = ["age_risk_factor", "experience_risk_factor", "license_recency_factor", "age_experience_ratio"]


@query("driver_risk", oracle=rnd(with_clause("fx_driver") + SQL_DRIVER_RISK, DRIVER_RISK_DOUBLES))
def q_driver_risk(spark, sf_dir):
    return rounded(enhanced.driver_risk(fixtures(spark, sf_dir).drivers, AS_OF))


_cat = dims.VEHICLE_CATEGORY
SQL_DEPRECIATION = """CASE WHEN va = 0 THEN 1.0::DOUBLE WHEN va = 1 THEN 0.8::DOUBLE WHEN va = 2 THEN 0.7::DOUBLE
  WHEN va = 3 THEN 0.65::DOUBLE WHEN va BETWEEN 4 AND 9 THEN 0.65::DOUBLE - 0.025::DOUBLE * (va - 3)
  WHEN va BETWEEN 10 AND 29 THEN 0.45::DOUBLE - 0.01::DOUBLE * (va - 10) ELSE 0.25::DOUBLE END"""
SQL_MILEAGE_STRICT = """CASE WHEN annual_mileage BETWEEN 0 AND 5999
  THEN 0.8::DOUBLE + 0.04::DOUBLE * floor(annual_mileage / 1000) ELSE 1.5::DOUBLE END"""
SQL_VEHICLE_RISK_COLS = f"""{sql_str_map('mm', {k: v[0] for k, v in _cat.items()}, 'standard')} AS vehicle_category,
  {sql_case_map('mm', {k: v[1] for k, v in _cat.items()}, 1.0)} AS category_risk_factor,
  {sql_case_map('mm', {k: v[2] for k, v in _cat.items()}, 1.0)}
    * CASE WHEN anti_theft_device THEN 0.7::DOUBLE ELSE 1.0::DOUBLE END AS theft_risk_factor,
  value * ({SQL_DEPRECIATION}) AS depreciated_value,
  {SQL_MILEAGE_STRICT} AS mileage_risk_factor,
  CAST(value AS DOUBLE) / GREATEST(1, va) AS value_age_ratio,
  (value / 10000.0::DOUBLE) * (annual_mileage / 10000.0::DOUBLE) AS value_mileage_factor"""
VEHICLE_RISK_DOUBLES = ["category_risk_factor", "theft_risk_factor", "depreciated_value", "mileage_risk_factor",
                        "value_age_ratio", "value_mileage_factor"]


@query("vehicle_risk", oracle=rnd(with_clause("fx_vehicle") + f"""
SELECT policy_id, mm AS make_model, {SQL_VEHICLE_RISK_COLS}
FROM (SELECT *, {SQL_MAKE_MODEL} AS mm, year(DATE '{AS_OF}') - year AS va FROM fx_vehicle)""",
                                 VEHICLE_RISK_DOUBLES))
def q_vehicle_risk(spark, sf_dir):
    return rounded(enhanced.vehicle_risk(fixtures(spark, sf_dir).vehicles, AS_OF))


_enh = dims.ENHANCED_TERRITORY_RISK
_enh_cols = ",\n  ".join(
    f"{sql_case_map('et', {k: v[i] for k, v in _enh.items()}, 1.0)} AS territory_{c}"
    for i, c in enumerate(dims.ENHANCED_RISK_COLUMNS))
_LOC_RISK_SEL = f"""{_enh_cols},
  {sql_case_map('state', dims.STATE_RISK, 1.0)} AS state_risk_factor"""
SQL_LOCATION_RISK = f"SELECT policy_id, state, zip_code, et AS enhanced_territory, {_LOC_RISK_SEL} FROM {_LOC_SRC}"
LOCATION_RISK_DOUBLES = [f"territory_{c}" for c in dims.ENHANCED_RISK_COLUMNS] + [
    "state_risk_factor", "location_combined_risk"]


@query("location_risk", oracle=rnd(with_clause("fx_location") + f"""
SELECT *, (territory_crime_rate * 0.3::DOUBLE + territory_weather_risk * 0.2::DOUBLE
           + territory_traffic_density * 0.2::DOUBLE + territory_parking_risk * 0.1::DOUBLE
           + territory_vandalism_risk * 0.1::DOUBLE + territory_flood_risk * 0.1::DOUBLE) * state_risk_factor
          AS location_combined_risk
FROM ({SQL_LOCATION_RISK})""", LOCATION_RISK_DOUBLES))
def q_location_risk(spark, sf_dir):
    return rounded(enhanced.location_risk(fixtures(spark, sf_dir).locations))


# ---- A2 ---------------------------------------------------------------------------------

def _mode_sql(frame, col, out):
    return f"""SELECT policy_id, v AS {out} FROM (
  SELECT policy_id, v, row_number() OVER (PARTITION BY policy_id ORDER BY n DESC, v ASC) AS r
  FROM (SELECT policy_id, {col} AS v, count(*) AS n FROM ({frame}) GROUP BY 1, 2)) WHERE r = 1"""


_V_CAT_FRAME = f"""SELECT policy_id, {sql_str_map('mm', {k: v[0] for k, v in _cat.items()}, 'standard')} AS c
FROM (SELECT *, {SQL_MAKE_MODEL} AS mm FROM fx_vehicle)"""
_L_ET_FRAME = f"SELECT policy_id, {SQL_ENH_TERRITORY} AS c FROM fx_location"


@query("categorical_mode", oracle=with_clause("fx_vehicle", "fx_location") + f"""
SELECT COALESCE(a.policy_id, b.policy_id) AS policy_id, a.vehicle_category_mode, b.enhanced_territory_mode
FROM ({_mode_sql(_V_CAT_FRAME, 'c', 'vehicle_category_mode')}) a
FULL OUTER JOIN ({_mode_sql(_L_ET_FRAME, 'c', 'enhanced_territory_mode')}) b ON a.policy_id = b.policy_id""")
def q_categorical_mode(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    v = enhanced.categorical_mode(enhanced.vehicle_risk(fx.vehicles, AS_OF), "vehicle_category",
                                  "vehicle_category_mode", enhanced.VEHICLE_CATEGORIES)
    loc = enhanced.categorical_mode(enhanced.location_risk(fx.locations), "enhanced_territory",
                                    "enhanced_territory_mode", enhanced.ENHANCED_TERRITORIES)
    return v.join(loc, "policy_id", "full_outer")


# ---- X9 ---------------------------------------------------------------------------------

_ED_FRAME = f"SELECT policy_id, {_DRIVER_SEL}, {_DRIVER_RISK_SEL} FROM {_DRIVER_SRC}"
_EV_FRAME = f"""SELECT policy_id, CAST(va AS INTEGER) AS vehicle_age, CAST(value AS DOUBLE) AS vehicle_value,
  annual_mileage, CAST(anti_theft_device AS INTEGER) AS anti_theft_device,
  {sql_case_map('mm', dims.MAKE_MODEL_RISK, 1.0)} AS make_model_risk,
  {", ".join(_onehot_int(SQL_VCLASS, c, "vehicle_class_" + c) for c in dims.VEHICLE_CLASSES)},
  {", ".join(_onehot_null("primary_use", u, "use_" + u) for u in O_USES)},
  {SQL_VEHICLE_RISK_COLS}
FROM (SELECT *, {SQL_MAKE_MODEL} AS mm, year(DATE '{AS_OF}') - year AS va FROM fx_vehicle)"""
_EL_FRAME = f"""SELECT *, (territory_crime_rate * 0.3::DOUBLE + territory_weather_risk * 0.2::DOUBLE
   + territory_traffic_density * 0.2::DOUBLE + territory_parking_risk * 0.1::DOUBLE
   + territory_vandalism_risk * 0.1::DOUBLE + territory_flood_risk * 0.1::DOUBLE) * state_risk_factor
   AS location_combined_risk
FROM (SELECT policy_id, {_LOC_SEL}, et AS enhanced_territory, {_LOC_RISK_SEL} FROM {_LOC_SRC})"""

_EPF_SQL, _EPF_DOUBLES = policy_features_sql(
    DRIVER_COLS + DRIVER_RISK_DOUBLES, VEHICLE_COLS + VEHICLE_RISK_DOUBLES, LOCATION_COLS + LOCATION_RISK_DOUBLES,
    _ED_FRAME, _EV_FRAME, _EL_FRAME)
_EPF_SQL = _EPF_SQL.replace(
    "SELECT p.policy_id,",
    "SELECT p.policy_id, vm.vehicle_vehicle_category_mode, lm.location_enhanced_territory_mode,", 1) + f"""
LEFT JOIN ({_mode_sql(_V_CAT_FRAME, 'c', 'vehicle_vehicle_category_mode')}) vm USING (policy_id)
LEFT JOIN ({_mode_sql(_L_ET_FRAME, 'c', 'location_enhanced_territory_mode')}) lm USING (policy_id)"""


# value x depreciation has up to 5 decimals; its mean over <= 13 vehicles ends
# by the 8th, so 8 places is exact there and free of rounding ties.
# Means that can end exactly half way at six places (of up to eight rows) are compared at eight.
_EPF_DIGITS = {f"{c}_{s}": 8 for c in ("vehicle_depreciated_value", "location_location_combined_risk")
               for s in ("mean", "max", "min")}


@query("policy_features_stored", oracle=rnd(_PF_SQL, _PF_DOUBLES))
def q_policy_features_stored(spark, sf_dir):
    """J7 over stored tables, bucketed by policy: no exchange between scan and feature row."""
    from policylens.sources import stored
    fx = fixtures(spark, sf_dir)
    kept = stored.store({"policies": fx.policies, "drivers": fx.drivers, "vehicles": fx.vehicles, "history": fx.history, "locations": fx.locations})
    return rounded(features.policy_features(**kept.read(spark), vocab=vocab_for(fx), as_of=AS_OF))


@query("policy_features_enhanced", oracle=rnd(_EPF_SQL, _EPF_DOUBLES, per_col=_EPF_DIGITS))
def q_policy_features_enhanced(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(enhanced.policy_features_enhanced(fx.policies, fx.drivers, fx.vehicles, fx.history,
                                                     fx.locations, vocab_for(fx), AS_OF), big_digits=_EPF_DIGITS)


@query("explode_children", oracle=with_clause("fx_driver", "fx_vehicle", "fx_history", "fx_location") + """
SELECT policy_id, kind, count(*) AS n FROM (
  SELECT policy_id, 'driver' AS kind FROM fx_driver UNION ALL SELECT policy_id, 'vehicle' FROM fx_vehicle
  UNION ALL SELECT policy_id, 'history' FROM fx_history UNION ALL SELECT policy_id, 'location' FROM fx_location)
GROUP BY 1, 2""")
def q_explode_children(spark, sf_dir):
    """Children of all nested policies flattened, counted per (policy, kind)."""
    pn = nested_files(spark, sf_dir)
    return features.explode_children(pn).groupBy(F.col("policy_id").cast("long").alias("policy_id"), "kind").agg(F.count(F.lit(1)).alias("n"))


def nested_files(spark, sf_dir):
    """The policies as files of nested records, read back by S1."""
    from policylens.sources import nested
    from policylens.sources.sinks import new_path
    fx = fixtures(spark, sf_dir)
    path = new_path(spark, "nested-policies")
    pn = nested.nest_policies(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations)
    pn.withColumn("policy_id", F.col("policy_id").cast("string")).write.parquet(path)
    return nested.read_policies(spark, path)


@query("policy_features_nested", oracle=rnd(_PF_SQL, _PF_DOUBLES))
def q_policy_features_nested(spark, sf_dir):
    """X5 of nested records read from files: folds over each record's arrays, no shuffle after the scan."""
    from policylens.operators import nested_features
    out = nested_features.policy_features(nested_files(spark, sf_dir), vocab_for(fixtures(spark, sf_dir)), AS_OF)
    return rounded(out.withColumn("policy_id", F.col("policy_id").cast("long")))


@query("policies_nested", oracle=with_clause("fx_policy", "fx_driver", "fx_vehicle", "fx_history",
                                             "fx_location") + """
SELECT p.policy_id, CAST(COALESCE(d.n, 0) AS BIGINT) AS num_drivers, CAST(COALESCE(v.n, 0) AS BIGINT) AS num_vehicles,
       CAST(COALESCE(h.n, 0) AS BIGINT) AS num_history, CAST(COALESCE(l.n, 0) AS BIGINT) AS num_locations
FROM fx_policy p
LEFT JOIN (SELECT policy_id, count(*) n FROM fx_driver GROUP BY 1) d USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) n FROM fx_vehicle GROUP BY 1) v USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) n FROM fx_history GROUP BY 1) h USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) n FROM fx_location GROUP BY 1) l USING (policy_id)""")
def q_policies_nested(spark, sf_dir):
    """Nested policy records (arrays of child structs), written, read back by the scan and counted."""
    from policylens.sources import nested
    return nested.nested_counts(nested_files(spark, sf_dir).withColumn("policy_id", F.col("policy_id").cast("long")))
