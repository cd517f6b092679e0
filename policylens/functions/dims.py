"""Dimension tables (S9): small rating lookups as DataFrames.

These tables are tiny and fixed (at most a few dozen rows), so joins against
them are broadcast; their size does not grow with the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES: these constants must equal the rating tables of the pricing
# rules they reproduce. Keep them verbatim and in this order.
# ---------------------------------------------------------------------------

OCCUPATION_RISK = {
    "driver": 1.5, "pilot": 1.3, "teacher": 0.9, "doctor": 0.8, "engineer": 0.85,
    "lawyer": 0.95, "accountant": 0.9, "student": 1.2, "retired": 1.0, "unemployed": 1.1,
}
OCCUPATION_DEFAULT = 1.0

MAKE_MODEL_RISK = {
    "toyota_camry": 0.9, "toyota_corolla": 0.85, "honda_civic": 0.9, "honda_accord": 0.95,
    "ford_f150": 1.1, "ford_mustang": 1.4, "chevrolet_silverado": 1.15, "chevrolet_corvette": 1.5,
    "bmw_3series": 1.2, "bmw_5series": 1.25, "mercedes_cclass": 1.2, "mercedes_eclass": 1.25,
    "tesla_model3": 1.1, "tesla_modely": 1.15,
}
MAKE_MODEL_DEFAULT = 1.0

# make_model -> (category, risk_factor, theft_risk)
VEHICLE_CATEGORY = {
    "toyota_corolla": ("economy", 0.9, 0.8),
    "toyota_camry": ("standard", 0.95, 0.85),
    "toyota_rav4": ("suv", 1.0, 0.9),
    "toyota_highlander": ("suv", 1.05, 0.9),
    "toyota_tacoma": ("truck", 1.1, 1.0),
    "honda_civic": ("economy", 0.9, 1.0),
    "honda_accord": ("standard", 0.95, 0.9),
    "honda_cr-v": ("suv", 1.0, 0.85),
    "honda_pilot": ("suv", 1.05, 0.9),
    "honda_odyssey": ("van", 1.0, 0.8),
    "ford_focus": ("economy", 0.95, 0.9),
    "ford_fusion": ("standard", 1.0, 0.9),
    "ford_escape": ("suv", 1.05, 0.95),
    "ford_explorer": ("suv", 1.1, 1.0),
    "ford_f-150": ("truck", 1.15, 1.1),
    "ford_mustang": ("sports", 1.4, 1.2),
    "chevrolet_spark": ("economy", 0.95, 0.85),
    "chevrolet_malibu": ("standard", 1.0, 0.9),
    "chevrolet_equinox": ("suv", 1.05, 0.95),
    "chevrolet_tahoe": ("suv", 1.15, 1.05),
    "chevrolet_silverado": ("truck", 1.2, 1.1),
    "chevrolet_corvette": ("sports", 1.5, 1.3),
    "bmw_3series": ("luxury", 1.2, 1.1),
    "bmw_5series": ("luxury", 1.3, 1.15),
    "bmw_x3": ("luxury_suv", 1.25, 1.1),
    "bmw_x5": ("luxury_suv", 1.35, 1.2),
    "mercedes_cclass": ("luxury", 1.25, 1.15),
    "mercedes_eclass": ("luxury", 1.35, 1.2),
    "mercedes_glc": ("luxury_suv", 1.3, 1.15),
    "mercedes_gle": ("luxury_suv", 1.4, 1.25),
    "tesla_model3": ("electric", 1.15, 1.0),
    "tesla_modely": ("electric_suv", 1.2, 1.05),
    "tesla_models": ("luxury_electric", 1.3, 1.1),
    "tesla_modelx": ("luxury_electric_suv", 1.35, 1.15),
}
VEHICLE_CATEGORY_DEFAULT = ("standard", 1.0, 1.0)

# territory -> (crime_rate, weather_risk, traffic_density)
TERRITORY_RISK = {
    "urban": (1.2, 1.0, 1.3),
    "suburban": (0.9, 1.0, 1.0),
    "rural": (0.7, 1.1, 0.8),
    "default": (1.0, 1.0, 1.0),
}

# enhanced territory -> (crime_rate, weather_risk, traffic_density,
#                        parking_risk, vandalism_risk, flood_risk)
ENHANCED_TERRITORY_RISK = {
    "urban_high_density": (1.3, 1.0, 1.4, 1.3, 1.25, 1.1),
    "urban_medium_density": (1.2, 1.0, 1.3, 1.2, 1.15, 1.05),
    "urban_low_density": (1.1, 1.0, 1.2, 1.1, 1.1, 1.0),
    "suburban_high_income": (0.8, 1.0, 1.0, 0.9, 0.85, 0.95),
    "suburban_medium_income": (0.9, 1.0, 1.0, 0.95, 0.9, 1.0),
    "suburban_low_income": (1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
    "rural_remote": (0.6, 1.2, 0.7, 0.7, 0.7, 1.1),
    "rural_town": (0.7, 1.1, 0.8, 0.8, 0.8, 1.05),
    "coastal": (1.0, 1.2, 1.0, 1.0, 1.0, 1.3),
    "mountain": (0.8, 1.3, 0.9, 0.9, 0.8, 1.1),
    "default": (1.0, 1.0, 1.0, 1.0, 1.0, 1.0),
}
ENHANCED_RISK_COLUMNS = ("crime_rate", "weather_risk", "traffic_density",
                         "parking_risk", "vandalism_risk", "flood_risk")

# State risk; Louisiana is listed twice in the rating table and the later
# value (1.1) is the one in force.
STATE_RISK = {
    "CA": 1.2, "NY": 1.15, "FL": 1.1, "TX": 1.05, "MI": 1.1, "NJ": 1.1, "IL": 1.05,
    "GA": 1.05, "PA": 1.0, "OH": 1.0, "NC": 1.0, "VA": 0.95, "WA": 1.0, "MA": 1.05, "AZ": 0.95,
    "IN": 0.95, "TN": 1.0, "MO": 0.95, "MD": 1.05, "WI": 1.0, "MN": 1.0, "CO": 1.0, "AL": 1.0,
    "SC": 1.0, "LA": 1.1, "KY": 0.95, "OR": 0.95, "OK": 1.0, "CT": 1.05, "IA": 0.9, "MS": 1.0,
    "AR": 0.95, "KS": 0.9, "UT": 0.9, "NV": 1.0, "NM": 0.95, "NE": 0.9, "WV": 0.95, "ID": 0.9,
    "HI": 1.0, "ME": 0.95, "NH": 0.95, "RI": 1.05, "MT": 0.9, "DE": 1.0, "SD": 0.9, "ND": 0.9,
    "AK": 1.05, "VT": 0.95, "WY": 0.9, "DC": 1.2,
}
STATE_RISK_DEFAULT = 1.0

COASTAL_STATES = ("CA", "OR", "WA", "TX", "LA", "MS", "AL", "FL", "GA", "SC", "NC", "VA", "MD",
                  "DE", "NJ", "NY", "CT", "RI", "MA", "NH", "ME", "HI", "AK")
MOUNTAIN_STATES = ("CO", "WY", "MT", "ID", "UT", "NV", "AZ", "NM")

AGE_BAND_LABELS = ("18-24", "25-34", "35-44", "45-54", "55-64", "65+")
AGE_BAND_EDGES = (18, 25, 35, 45, 55, 65, 100)
VEHICLE_CLASSES = ("sports", "truck", "luxury", "electric", "standard")
TERRITORIES = ("urban", "suburban", "rural", "default")
HISTORY_FEATURES = ("accident_count", "violation_count", "claim_count", "at_fault_count",
                    "total_claim_amount", "years_since_last_incident", "incident_severity_score")
SEVERITY_WEIGHT = {"minor": 1, "moderate": 2, "major": 3}

# Allowed enum values of the request schema.
GENDERS = ("male", "female", "other")
MARITAL_STATUSES = ("single", "married", "divorced", "widowed")
VEHICLE_USES = ("personal", "commute", "business")
INCIDENT_TYPES = ("accident", "violation", "claim")
SEVERITIES = ("minor", "moderate", "major")

# Health limits.
HEALTH_LIMITS = {"mape": 15.0, "r2": 0.7, "bias": 100.0, "psi": 0.2, "mean_diff": 0.1}

# ---------------------------------------------------------------------------


def occupation_risk_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(OCCUPATION_RISK.items()), "occupation_key string, occupation_risk double")


def make_model_risk_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MAKE_MODEL_RISK.items()), "make_model string, make_model_risk double")


def vehicle_category_df(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in VEHICLE_CATEGORY.items()]
    return spark.createDataFrame(
        rows, "make_model string, vehicle_category string, category_risk_factor double, theft_risk double")


def territory_risk_df(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in TERRITORY_RISK.items()]
    return spark.createDataFrame(
        rows, "territory string, crime_rate double, weather_risk double, traffic_density double")


def enhanced_territory_risk_df(spark: SparkSession) -> DataFrame:
    rows = [(k, *v) for k, v in ENHANCED_TERRITORY_RISK.items()]
    cols = ", ".join(f"territory_{c} double" for c in ENHANCED_RISK_COLUMNS)
    return spark.createDataFrame(rows, f"enhanced_territory string, {cols}")


def state_risk_df(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(STATE_RISK.items()), "state string, state_risk_factor double")


def dim_state_risk(spark: SparkSession) -> DataFrame:
    """S9 as a query: the state table with one row per state."""
    return state_risk_df(spark).select("state", "state_risk_factor")


def lookup(df: DataFrame, dim: DataFrame, on, how: str = "left") -> DataFrame:
    """Left lookup against a fixed dimension table (bounded size -> broadcast)."""
    return df.join(F.broadcast(dim), on=on, how=how)
