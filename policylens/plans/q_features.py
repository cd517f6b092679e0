"""Queries: scalar rules, child features, policy features and rating."""

from __future__ import annotations

from pyspark.sql import functions as F

from policylens.functions import dims
from policylens.functions import exprs as X
from policylens.operators import enhanced, features, rating
from policylens.plans.catalog import fixtures, query, rnd, rounded
from policylens.sources.tables import POLICY_AS_OF, with_clause

AS_OF = POLICY_AS_OF


# ---- SQL text helpers for the oracles (DuckDB dialect) -------------------------

def sql_years(col: str, as_of: str = f"DATE '{AS_OF}'") -> str:
    return (f"(year({as_of}) - year({col}) - CASE WHEN month({as_of}) * 100 + day({as_of}) "
            f"< month({col}) * 100 + day({col}) THEN 1 ELSE 0 END)")


def sql_case_map(key: str, mapping: dict, default) -> str:
    arms = " ".join(f"WHEN '{k}' THEN CAST({v} AS DOUBLE)" for k, v in mapping.items())
    return f"COALESCE(CASE {key} {arms} END, CAST({default} AS DOUBLE))"


def sql_str_map(key: str, mapping: dict, default: str) -> str:
    arms = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in mapping.items())
    return f"COALESCE(CASE {key} {arms} END, '{default}')"


SQL_TERRITORY = ("CASE WHEN substring(zip_code, 1, 1) IN ('1','2','3') THEN 'urban' "
                 "WHEN substring(zip_code, 1, 1) IN ('4','5','6') THEN 'suburban' "
                 "WHEN substring(zip_code, 1, 1) IN ('7','8','9') THEN 'rural' ELSE 'default' END")

_coastal = ", ".join(f"'{s}'" for s in dims.COASTAL_STATES)
_mountain = ", ".join(f"'{s}'" for s in dims.MOUNTAIN_STATES)
SQL_ENH_TERRITORY = f"""CASE
  WHEN state IN ({_coastal}) AND substring(zip_code, 2, 1) IN ('0','1','2') THEN 'coastal'
  WHEN state IN ({_mountain}) THEN 'mountain'
  WHEN substring(zip_code, 1, 1) IN ('0','1','2','3') THEN
    CASE WHEN substring(zip_code, 2, 1) IN ('0','1') THEN 'urban_high_density'
         WHEN substring(zip_code, 2, 1) IN ('2','3','4') THEN 'urban_medium_density' ELSE 'urban_low_density' END
  WHEN substring(zip_code, 1, 1) IN ('4','5','6') THEN
    CASE WHEN substring(zip_code, 2, 1) IN ('0','1','2') THEN 'suburban_high_income'
         WHEN substring(zip_code, 2, 1) IN ('3','4','5','6') THEN 'suburban_medium_income' ELSE 'suburban_low_income' END
  WHEN substring(zip_code, 1, 1) IN ('7','8','9') THEN
    CASE WHEN substring(zip_code, 2, 1) IN ('0','1','2','3') THEN 'rural_town' ELSE 'rural_remote' END
  ELSE 'default' END"""

SQL_MAKE_MODEL = "lower(make) || '_' || lower(model)"

SQL_AGE_BAND = ("CASE WHEN a >= 18 AND a < 25 THEN '18-24' WHEN a >= 25 AND a < 35 THEN '25-34' "
                "WHEN a >= 35 AND a < 45 THEN '35-44' WHEN a >= 45 AND a < 55 THEN '45-54' "
                "WHEN a >= 55 AND a < 65 THEN '55-64' WHEN a >= 65 AND a < 100 THEN '65+' END")

SQL_VCLASS = """CASE WHEN mm LIKE '%corvette%' OR mm LIKE '%mustang%' THEN 'sports'
  WHEN mm LIKE '%f150%' OR mm LIKE '%silverado%' THEN 'truck'
  WHEN mm LIKE '%5series%' OR mm LIKE '%eclass%' THEN 'luxury'
  WHEN mm LIKE '%model3%' OR mm LIKE '%modely%' THEN 'electric' ELSE 'standard' END"""


# ---- F1/F2, F3, F4/F5/A9, F6, F7 -----------------------------------------------

@query("driver_age", oracle=with_clause("fx_driver") + f"""
SELECT policy_id, date_of_birth, license_issue_date,
       CAST({sql_years('date_of_birth')} AS INTEGER) AS driver_age,
       CAST({sql_years('license_issue_date')} AS INTEGER) AS driver_experience
FROM fx_driver""")
def q_driver_age(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.drivers.select("policy_id", "date_of_birth", "license_issue_date",
                             *[c.alias(n) for n, c in features.driver_age_cols(AS_OF).items()])


@query("vehicle_age", oracle=with_clause("fx_vehicle") + f"""
SELECT policy_id, year, CAST(year(DATE '{AS_OF}') - year AS INTEGER) AS vehicle_age FROM fx_vehicle""")
def q_vehicle_age(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.vehicles.select("policy_id", "year", X.vehicle_age(X.as_date(AS_OF), "year").alias("vehicle_age"))


@query("policy_shape", oracle=rnd(with_clause("fx_policy", "fx_driver", "fx_vehicle", "fx_location") + """
SELECT p.policy_id, CAST(p.expiration_date - p.effective_date AS INTEGER) AS policy_duration_days,
       CAST(COALESCE(d.n, 0) AS BIGINT) AS num_drivers, CAST(COALESCE(v.n, 0) AS BIGINT) AS num_vehicles,
       CAST(COALESCE(l.n, 0) AS BIGINT) AS num_locations,
       CAST(COALESCE(v.n, 0) AS DOUBLE) / GREATEST(1, COALESCE(d.n, 0)) AS vehicle_per_driver_ratio
FROM fx_policy p
LEFT JOIN (SELECT policy_id, count(*) AS n FROM fx_driver GROUP BY 1) d USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) AS n FROM fx_vehicle GROUP BY 1) v USING (policy_id)
LEFT JOIN (SELECT policy_id, count(*) AS n FROM fx_location GROUP BY 1) l USING (policy_id)""",
    ["vehicle_per_driver_ratio"]))
def q_policy_shape(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(features.child_counts(fx.policies, fx.drivers, fx.vehicles, fx.locations))


@query("age_band", oracle=with_clause("fx_driver") + f"""
SELECT policy_id, a AS driver_age, {SQL_AGE_BAND} AS age_band
FROM (SELECT policy_id, CAST({sql_years('date_of_birth')} AS INTEGER) AS a FROM fx_driver)""")
def q_age_band(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    age = features.driver_age_cols(AS_OF)["driver_age"]
    return fx.drivers.select("policy_id", age.alias("driver_age")).select(
        "policy_id", "driver_age", X.age_band("driver_age").alias("age_band"))


_band_cols_sql = ", ".join(
    f"CAST(COALESCE(({SQL_AGE_BAND}) = '{b}', false) AS INTEGER) AS \"age_band_{b}\"" for b in dims.AGE_BAND_LABELS)


@query("onehot_fixed", oracle=with_clause("fx_driver") + f"""
SELECT policy_id, a AS driver_age, {_band_cols_sql}
FROM (SELECT policy_id, CAST({sql_years('date_of_birth')} AS INTEGER) AS a FROM fx_driver)""")
def q_onehot_fixed(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    age = features.driver_age_cols(AS_OF)["driver_age"]
    d = fx.drivers.select("policy_id", age.alias("driver_age"))
    band = X.age_band("driver_age")
    return d.select("policy_id", "driver_age",
                    *[X.one_hot(band, b).alias(f"age_band_{b}") for b in dims.AGE_BAND_LABELS])


# ---- F10, F11 --------------------------------------------------------------------

@query("territory", oracle=with_clause("fx_location") + f"""
SELECT policy_id, zip_code, {SQL_TERRITORY} AS territory FROM fx_location""")
def q_territory(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.locations.select("policy_id", "zip_code", X.territory("zip_code").alias("territory"))


@query("territory_enhanced", oracle=with_clause("fx_location") + f"""
SELECT policy_id, state, zip_code, {SQL_ENH_TERRITORY} AS enhanced_territory FROM fx_location""")
def q_territory_enhanced(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.locations.select("policy_id", "state", "zip_code",
                               X.enhanced_territory("zip_code", "state").alias("enhanced_territory"))


# ---- J1, X1 ------------------------------------------------------------------------

@query("occupation_risk", oracle=with_clause("fx_driver") + f"""
SELECT policy_id, occupation, {sql_case_map('lower(occupation)', dims.OCCUPATION_RISK, 1.0)} AS occupation_risk
FROM fx_driver""")
def q_occupation_risk(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return fx.drivers.select("policy_id", "occupation", X.occupation_risk("occupation").alias("occupation_risk"))


# ---- credit / insurance factors (F22, F23) ------------------------------------------

SQL_CREDIT = ("CASE WHEN s >= 800 THEN 0.8 WHEN s >= 740 THEN 0.9 WHEN s >= 670 THEN 1.0 "
              "WHEN s >= 580 THEN 1.2 ELSE 1.5 END")
SQL_INSURANCE = ("CASE WHEN s >= 90 THEN 0.8 WHEN s >= 80 THEN 0.9 WHEN s >= 70 THEN 1.0 "
                 "WHEN s >= 60 THEN 1.1 WHEN s >= 50 THEN 1.2 ELSE 1.3 END")


@query("credit_factor", oracle=with_clause("fx_policy") + f"""
SELECT policy_id, credit_score,
       CASE WHEN s IS NULL THEN NULL ELSE CAST({SQL_CREDIT} AS DOUBLE) END AS credit_factor
FROM (SELECT *, NULLIF(credit_score, 0) AS s FROM fx_policy)""")
def q_credit_factor(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    s = X.truthy("credit_score")
    return fx.policies.select("policy_id", "credit_score",
                              F.when(s.isNotNull(), X.credit_factor(s)).alias("credit_factor"))


@query("insurance_factor", oracle=with_clause("fx_policy") + f"""
SELECT policy_id, insurance_score,
       CASE WHEN s IS NULL THEN NULL ELSE CAST({SQL_INSURANCE} AS DOUBLE) END AS insurance_factor
FROM (SELECT *, NULLIF(insurance_score, 0) AS s FROM fx_policy)""")
def q_insurance_factor(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    s = X.truthy("insurance_score")
    return fx.policies.select("policy_id", "insurance_score",
                              F.when(s.isNotNull(), X.insurance_factor(s)).alias("insurance_factor"))


# ---- rating (R1-R6) -------------------------------------------------------------------

_SQL_DRIVER_MULT = f"""SELECT policy_id,
  CAST(CASE WHEN age < 25 THEN 1.5 WHEN age < 35 THEN 1.2 WHEN age > 65 THEN 1.3 ELSE 1.0 END AS DOUBLE) AS fa,
  CAST(CASE WHEN exp < 3 THEN 1.4 WHEN exp < 10 THEN 1.1 ELSE 1.0 END AS DOUBLE) AS fe,
  CAST(CASE WHEN occupation IN ('Driver', 'Pilot') THEN 1.2 WHEN occupation IN ('Student', 'Unemployed') THEN 1.1
       ELSE 1.0 END AS DOUBLE) AS fo
FROM (SELECT *, {sql_years('date_of_birth')} AS age, {sql_years('license_issue_date')} AS exp FROM fx_driver)"""

_SQL_VEHICLE_MULT = f"""SELECT policy_id,
  CAST(CASE WHEN va < 3 THEN 1.2 WHEN va > 10 THEN 1.1 ELSE 1.0 END AS DOUBLE) AS fa,
  CAST(CASE WHEN value > 30000 THEN 1.3 WHEN value > 20000 THEN 1.2 WHEN value > 10000 THEN 1.1 ELSE 1.0 END AS DOUBLE) AS fv,
  CAST(CASE WHEN primary_use = 'business' THEN 1.3 WHEN primary_use = 'commute' THEN 1.1 ELSE 1.0 END AS DOUBLE) AS fu
FROM (SELECT *, year(DATE '{AS_OF}') - year AS va FROM fx_vehicle)"""

_SQL_HISTORY_MULT = """SELECT policy_id,
  CAST(CASE WHEN incident_type <> 'accident' THEN 1.0 WHEN severity = 'major' THEN 1.5
            WHEN severity = 'moderate' THEN 1.3 ELSE 1.1 END AS DOUBLE) AS fa,
  CAST(CASE WHEN incident_type <> 'violation' THEN 1.0 WHEN severity = 'major' THEN 1.4
            WHEN severity = 'moderate' THEN 1.2 ELSE 1.1 END AS DOUBLE) AS fv,
  CAST(CASE WHEN incident_type <> 'claim' THEN 1.0 WHEN claim_amount > 5000 THEN 1.4
            WHEN claim_amount > 2000 THEN 1.2 ELSE 1.1 END AS DOUBLE) AS fc
FROM fx_history"""

_SQL_LOCATION_MULT = """SELECT policy_id,
  CAST(CASE WHEN substring(zip_code, 1, 1) IN ('1','2','3') THEN 1.2
            WHEN substring(zip_code, 1, 1) IN ('4','5','6') THEN 1.1 ELSE 1.0 END AS DOUBLE) AS fl
FROM fx_location"""

_SQL_RATE_D = f"""SELECT policy_id, product(fa) AS driver_age_factor, product(fe) AS driver_experience_factor,
  product(fo) AS driver_occupation_factor FROM ({_SQL_DRIVER_MULT}) GROUP BY policy_id"""
_SQL_RATE_V = f"""SELECT policy_id, product(fa) AS vehicle_age_factor, product(fv) AS vehicle_value_factor,
  product(fu) AS vehicle_use_factor FROM ({_SQL_VEHICLE_MULT}) GROUP BY policy_id"""
_SQL_RATE_H = f"""SELECT policy_id, product(fa) AS accident_factor, product(fv) AS violation_factor,
  product(fc) AS claim_factor FROM ({_SQL_HISTORY_MULT}) GROUP BY policy_id"""
_SQL_RATE_L = f"""SELECT policy_id, product(fl) AS location_factor FROM ({_SQL_LOCATION_MULT}) GROUP BY policy_id"""

_SQL_PREMIUM = f"""SELECT p.policy_id,
  1000.0::DOUBLE * COALESCE(d.driver_age_factor, 1) * COALESCE(d.driver_experience_factor, 1)
  * COALESCE(d.driver_occupation_factor, 1) * COALESCE(v.vehicle_age_factor, 1) * COALESCE(v.vehicle_value_factor, 1)
  * COALESCE(v.vehicle_use_factor, 1) * COALESCE(h.accident_factor, 1) * COALESCE(h.violation_factor, 1)
  * COALESCE(h.claim_factor, 1) * COALESCE(l.location_factor, 1) AS premium
FROM fx_policy p
LEFT JOIN ({_SQL_RATE_D}) d USING (policy_id) LEFT JOIN ({_SQL_RATE_V}) v USING (policy_id)
LEFT JOIN ({_SQL_RATE_H}) h USING (policy_id) LEFT JOIN ({_SQL_RATE_L}) l USING (policy_id)"""

_WITH_ALL = with_clause("fx_policy", "fx_driver", "fx_vehicle", "fx_history", "fx_location")


@query("rate_driver", oracle=rnd(with_clause("fx_driver") + _SQL_RATE_D, rating.DRIVER_FACTORS))
def q_rate_driver(spark, sf_dir):
    return rounded(rating.rate_driver(fixtures(spark, sf_dir).drivers, AS_OF))


@query("rate_vehicle", oracle=rnd(with_clause("fx_vehicle") + _SQL_RATE_V, rating.VEHICLE_FACTORS))
def q_rate_vehicle(spark, sf_dir):
    return rounded(rating.rate_vehicle(fixtures(spark, sf_dir).vehicles, AS_OF))


@query("rate_history", oracle=rnd(with_clause("fx_history") + _SQL_RATE_H, rating.HISTORY_FACTORS))
def q_rate_history(spark, sf_dir):
    return rounded(rating.rate_history(fixtures(spark, sf_dir).history))


@query("rate_location", oracle=rnd(with_clause("fx_location") + _SQL_RATE_L, rating.LOCATION_FACTORS))
def q_rate_location(spark, sf_dir):
    return rounded(rating.rate_location(fixtures(spark, sf_dir).locations))


@query("rate_policy", oracle=rnd(_WITH_ALL + _SQL_PREMIUM, ["premium"], 4))
def q_rate_policy(spark, sf_dir):
    fx = fixtures(spark, sf_dir)
    return rounded(rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF), 4)


@query("training_pairs", oracle=rnd(_WITH_ALL + f"""
SELECT r.policy_id, r.premium, CAST(p.expiration_date - p.effective_date AS DOUBLE) AS policy_duration_days
FROM ({_SQL_PREMIUM}) r JOIN fx_policy p USING (policy_id)""", ["premium"], 4))
def q_training_pairs(spark, sf_dir):
    """Pair each policy with its premium by id (not by position)."""
    fx = fixtures(spark, sf_dir)
    prem = rating.rate_policy(fx.policies, fx.drivers, fx.vehicles, fx.history, fx.locations, AS_OF)
    feats = fx.policies.select("policy_id", X.duration_days("effective_date", "expiration_date")
                               .cast("double").alias("policy_duration_days"))
    return rounded(rating.labelled_dataset(feats, prem), 4)
