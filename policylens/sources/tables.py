"""Raw test tables and the adapter views that shape them into policy tables.

The raw tables are TPC-H-like Parquet files. The adapter views below give
them the insurance schemas (policy, driver, vehicle, history, location,
pricing log, prediction log, registry events). The same SQL text is valid
in Spark SQL and in DuckDB, so every oracle query can carry it as a
leading ``WITH``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RAW_TABLES = ("region nation customer supplier part orders lineitem events documents "
              "embeddings pages benchmark labels conversations").split()

# Reference dates of the fixtures: policies are rated as of 2002-01-01, the
# pricing log is read as of 2024-01-31 00:00 (UTC).
POLICY_AS_OF = "2002-01-01"
LOG_AS_OF = "2024-01-31 00:00:00"

FX_POLICY = """
SELECT o_orderkey AS policy_id, CAST(o_orderdate AS DATE) AS effective_date,
       CAST(o_orderdate AS DATE) + CAST(365 + o_custkey % 2 AS INT) AS expiration_date,
       CASE WHEN o_custkey % 7 = 0 THEN NULL ELSE CAST(300 + o_custkey * 37 % 551 AS DOUBLE) END AS credit_score,
       CASE WHEN o_custkey % 5 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(o_orderkey * 13 % 101 AS DOUBLE) END AS insurance_score,
       CASE WHEN o_custkey % 3 = 0 THEN NULL ELSE CAST(8 + o_orderkey % 8 AS DOUBLE) / 10 END AS territory_factor
FROM orders
"""

# Every line item gives its policy a driver, a vehicle, an incident and a location.
FX_DRIVER = """
SELECT l_orderkey AS policy_id,
       DATE '1925-01-01' + CAST(l_partkey * 131 % 21900 AS INT) AS date_of_birth,
       LEAST(DATE '2002-01-01', DATE '1925-01-01' + CAST(l_partkey * 131 % 21900 + 5844 + l_suppkey * 97 % 9000 AS INT)) AS license_issue_date,
       CASE l_partkey % 4 WHEN 0 THEN 'male' WHEN 1 THEN 'female' WHEN 2 THEN 'other' END AS gender,
       CASE l_suppkey % 5 WHEN 0 THEN 'single' WHEN 1 THEN 'married' WHEN 2 THEN 'divorced' WHEN 3 THEN 'widowed' END AS marital_status,
       CASE l_partkey % 9 WHEN 0 THEN 'Driver' WHEN 1 THEN 'Pilot' WHEN 2 THEN 'Teacher' WHEN 3 THEN 'Student' WHEN 4 THEN 'Engineer'
            WHEN 5 THEN 'Unemployed' WHEN 6 THEN 'Baker' WHEN 7 THEN 'Retired' END AS occupation
FROM lineitem
"""

FX_VEHICLE = """
SELECT l_orderkey AS policy_id,
       CASE l_partkey % 8 WHEN 0 THEN 'Toyota' WHEN 1 THEN 'Honda' WHEN 2 THEN 'Ford' WHEN 3 THEN 'Ford' WHEN 4 THEN 'Chevrolet'
            WHEN 5 THEN 'BMW' WHEN 6 THEN 'Tesla' ELSE 'Chevrolet' END AS make,
       CASE l_partkey % 8 WHEN 0 THEN 'Camry' WHEN 1 THEN 'Civic' WHEN 2 THEN 'F150' WHEN 3 THEN 'Mustang' WHEN 4 THEN 'Corvette'
            WHEN 5 THEN '3 Series' WHEN 6 THEN 'Model3' ELSE 'Silverado' END AS model,
       CAST(1970 + l_partkey * 7 % 34 AS INT) AS year, l_extendedprice AS value,
       CASE l_suppkey % 3 WHEN 0 THEN 'personal' WHEN 1 THEN 'commute' ELSE 'business' END AS primary_use,
       CAST(l_partkey * 7919 % 25000 AS INT) AS annual_mileage, l_linestatus = 'F' AS anti_theft_device
FROM lineitem
"""

FX_HISTORY = """
SELECT l_orderkey AS policy_id,
       CASE l_returnflag WHEN 'A' THEN 'accident' WHEN 'R' THEN 'violation' ELSE 'claim' END AS incident_type,
       CAST(l_shipdate AS DATE) AS incident_date,
       CASE l_suppkey % 3 WHEN 0 THEN 'minor' WHEN 1 THEN 'moderate' ELSE 'major' END AS severity,
       CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_extendedprice / 10 END AS claim_amount, l_linestatus = 'F' AS at_fault
FROM lineitem
"""

FX_LOCATION = """
SELECT o_orderkey AS policy_id,
       CASE o_custkey % 10 WHEN 0 THEN 'CA' WHEN 1 THEN 'CO' WHEN 2 THEN 'NY' WHEN 3 THEN 'TX' WHEN 4 THEN 'LA' WHEN 5 THEN 'OH'
            WHEN 6 THEN 'FL' WHEN 7 THEN 'UT' WHEN 8 THEN 'IA' ELSE 'ZZ' END AS state,
       LPAD(CAST(o_custkey * 7919 % 100000 AS STRING), 5, '0') AS zip_code
FROM orders
UNION ALL
SELECT l_orderkey, CASE l_suppkey % 4 WHEN 0 THEN 'NJ' WHEN 1 THEN 'MT' WHEN 2 THEN 'KS' ELSE 'DC' END,
       LPAD(CAST(l_suppkey * 6151 % 100000 AS STRING), 5, '0')
FROM lineitem
"""

FX_PRICING_HISTORY = """
SELECT event_id AS pricing_id, user_id AS policy_id, event_type AS model_id, props AS input_features,
       value * (CAST(90 + event_id % 5 * 5 AS DOUBLE) / 100) AS base_premium, value AS final_premium, ts AS created_at
FROM events
"""

FX_PREDICTION = """
SELECT l_orderkey * 10 + l_linenumber AS row_id, 'm1' AS model_id, l_extendedprice AS y, l_extendedprice * (1 - l_discount) AS p FROM lineitem
UNION ALL
SELECT l_orderkey * 10 + l_linenumber, 'm2', l_extendedprice, l_extendedprice * (1 + l_tax) FROM lineitem
"""

FX_MODEL_VERSION = """
SELECT n_nationkey AS model_id, CASE n_regionkey % 3 WHEN 0 THEN 'decision_tree' WHEN 1 THEN 'random_forest' ELSE 'gradient_boosting' END AS model_name,
       CAST(20250413000000 + CAST(n_nationkey AS BIGINT) AS STRING) AS model_version, n_nationkey % 6 = 0 AS activate,
       DATE '2025-04-13' + CAST(n_nationkey * 7 % 25 AS INT) AS created_at
FROM nation
"""

# Feature importances per registered model: parts are spread over the
# feature names of the policy frame (several parts land on one name, which
# the uniqueness audit must report); importance is the part's retail price.
FX_IMPORTANCE = """
SELECT p_partkey AS feature_id, CAST(p_size % 3 AS INT) AS model_id,
       CASE WHEN p_partkey % 4 = 3 THEN
              CASE p_partkey % 15 WHEN 0 THEN 'accident_count' WHEN 1 THEN 'violation_count' WHEN 2 THEN 'claim_count'
                WHEN 3 THEN 'at_fault_count' WHEN 4 THEN 'total_claim_amount' WHEN 5 THEN 'years_since_last_incident'
                WHEN 6 THEN 'incident_severity_score' WHEN 7 THEN 'policy_duration_days' WHEN 8 THEN 'num_drivers'
                WHEN 9 THEN 'num_vehicles' WHEN 10 THEN 'num_locations' WHEN 11 THEN 'vehicle_per_driver_ratio'
                WHEN 12 THEN 'insurance_score' ELSE 'credit_score' END
            ELSE CONCAT(CASE p_partkey % 4
              WHEN 0 THEN CASE p_partkey % 5 WHEN 0 THEN 'driver_driver_age' WHEN 1 THEN 'driver_driver_experience'
                WHEN 2 THEN 'driver_gender_male' WHEN 3 THEN 'driver_marital_status_single' ELSE 'driver_occupation_risk' END
              WHEN 1 THEN CASE p_partkey % 5 WHEN 0 THEN 'vehicle_vehicle_age' WHEN 1 THEN 'vehicle_vehicle_value'
                WHEN 2 THEN 'vehicle_annual_mileage' WHEN 3 THEN 'vehicle_make_model_risk' ELSE 'vehicle_anti_theft_device' END
              ELSE CASE p_partkey % 5 WHEN 0 THEN 'location_crime_rate' WHEN 1 THEN 'location_weather_risk'
                WHEN 2 THEN 'location_traffic_density' WHEN 3 THEN 'location_state_CA' ELSE 'location_state_NY' END END,
              CASE p_partkey % 3 WHEN 0 THEN '_mean' WHEN 1 THEN '_max' ELSE '_min' END) END AS feature_name,
       p_retailprice AS importance
FROM part
"""

# Model metrics per registered model: one row per supplier, metric chosen by key.
FX_METRIC = """
SELECT s_suppkey AS metric_id, CAST(s_nationkey AS INT) AS model_id,
       CASE s_suppkey % 4 WHEN 0 THEN 'rmse' WHEN 1 THEN 'mae' WHEN 2 THEN 'r2' ELSE 'mse' END AS metric_name,
       s_acctbal AS metric_value
FROM supplier
"""

# Pricing requests as they arrive: dates as text, enums in any case, some
# unknown enum values, impossible dates, missing fields and values of the
# wrong type (rules keyed on policy_id).
FX_REQ_POLICY = """
SELECT policy_id,
       CASE WHEN policy_id % 101 = 0 THEN '2001-13-01' ELSE CAST(effective_date AS STRING) END AS effective_date,
       CAST(expiration_date AS STRING) AS expiration_date, credit_score, insurance_score, territory_factor
FROM fx_policy
"""

FX_REQ_DRIVER = """
SELECT policy_id, 'First' AS first_name, 'Last' AS last_name, 'CA' AS license_state,
       CASE WHEN policy_id % 89 <> 0 THEN CONCAT('L', CAST(policy_id AS STRING)) END AS license_number,
       CASE WHEN policy_id % 97 = 0 THEN '1990-02-30' ELSE CAST(date_of_birth AS STRING) END AS date_of_birth,
       CAST(license_issue_date AS STRING) AS license_issue_date,
       CASE WHEN policy_id % 11 = 0 THEN upper(gender) WHEN policy_id % 13 = 0 THEN 'unknown' ELSE gender END AS gender,
       CASE WHEN policy_id % 17 = 0 THEN upper(marital_status) ELSE marital_status END AS marital_status, occupation
FROM fx_driver
"""

FX_REQ_VEHICLE = """
SELECT policy_id, make, model, value, CASE WHEN policy_id % 83 <> 0 THEN CONCAT('V', CAST(policy_id AS STRING)) END AS vin,
       CASE WHEN policy_id % 79 = 0 THEN 'new' ELSE CAST(year AS STRING) END AS year,
       CASE WHEN policy_id % 7 = 0 THEN upper(primary_use) WHEN policy_id % 23 = 0 THEN 'racing' ELSE primary_use END
         AS primary_use,
       annual_mileage, anti_theft_device
FROM fx_vehicle
"""

FX_REQ_HISTORY = """
SELECT policy_id,
       CASE WHEN policy_id % 29 = 0 THEN 'speeding' WHEN policy_id % 3 = 0 THEN upper(incident_type) ELSE incident_type END
         AS incident_type,
       CAST(incident_date AS STRING) AS incident_date,
       CASE WHEN policy_id % 31 = 0 THEN 'severe' ELSE severity END AS severity,
       CASE WHEN policy_id % 73 = 0 THEN 'much' ELSE CAST(claim_amount AS STRING) END AS claim_amount, at_fault
FROM fx_history
"""

FX_REQ_LOCATION = """
SELECT policy_id, '1 Main St' AS address_line1, 'Town' AS city, state, CASE WHEN policy_id % 71 <> 0 THEN zip_code END AS zip_code
FROM fx_location
"""

FIXTURE_VIEWS = {
    "fx_policy": FX_POLICY,
    "fx_driver": FX_DRIVER,
    "fx_vehicle": FX_VEHICLE,
    "fx_history": FX_HISTORY,
    "fx_location": FX_LOCATION,
    "fx_pricing_history": FX_PRICING_HISTORY,
    "fx_prediction": FX_PREDICTION,
    "fx_model_version": FX_MODEL_VERSION,
    "fx_importance": FX_IMPORTANCE,
    "fx_metric": FX_METRIC,
    "fx_req_policy": FX_REQ_POLICY,
    "fx_req_driver": FX_REQ_DRIVER,
    "fx_req_vehicle": FX_REQ_VEHICLE,
    "fx_req_history": FX_REQ_HISTORY,
    "fx_req_location": FX_REQ_LOCATION,
}


def with_clause(*names: str) -> str:
    """The adapter views as a leading ``WITH`` for a DuckDB oracle query."""
    parts = [f"{n} AS ({FIXTURE_VIEWS[n].strip()})" for n in names]
    return "WITH " + ",\n".join(parts) + "\n"


def register_raw(spark: SparkSession, sf_dir: str, names=RAW_TABLES) -> None:
    for name in names:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").createOrReplaceTempView(name)


def register_fixtures(spark: SparkSession, sf_dir: str) -> None:
    """Register the raw Parquet tables and every adapter view as temp views."""
    register_raw(spark, sf_dir, ("nation", "supplier", "part", "orders", "lineitem", "events"))
    for name, sql in FIXTURE_VIEWS.items():
        spark.sql(sql).createOrReplaceTempView(name)


class Fixtures:
    """Typed handles on the adapter views for one scale-factor folder.

    Views are registered once per session and folder; later handles reuse
    them (the views are lazy plans, so nothing is read until a query runs).
    """

    _registered: dict = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        from policylens.session import checkpoint_dir, fast_builds
        fast_builds(spark)
        checkpoint_dir(spark)
        self.spark = spark
        self.sf_dir = sf_dir
        key = id(spark)
        if Fixtures._registered.get(key) != sf_dir or not spark.catalog.tableExists("fx_policy"):
            register_fixtures(spark, sf_dir)
            Fixtures._registered[key] = sf_dir

    def view(self, name: str) -> DataFrame:
        return self.spark.table(name)

    @property
    def policies(self) -> DataFrame:
        return self.view("fx_policy")

    @property
    def drivers(self) -> DataFrame:
        return self.view("fx_driver")

    @property
    def vehicles(self) -> DataFrame:
        return self.view("fx_vehicle")

    @property
    def history(self) -> DataFrame:
        return self.view("fx_history")

    @property
    def locations(self) -> DataFrame:
        return self.view("fx_location")

    @property
    def pricing_history(self) -> DataFrame:
        return self.view("fx_pricing_history")

    @property
    def predictions(self) -> DataFrame:
        return self.view("fx_prediction")

    @property
    def model_versions(self) -> DataFrame:
        return self.view("fx_model_version")

    @property
    def importances(self) -> DataFrame:
        return self.view("fx_importance")

    @property
    def metrics(self) -> DataFrame:
        return self.view("fx_metric")

    def request_tables(self) -> dict:
        return {"policies": self.view("fx_req_policy"), "drivers": self.view("fx_req_driver"),
                "vehicles": self.view("fx_req_vehicle"), "history": self.view("fx_req_history"),
                "locations": self.view("fx_req_location")}
