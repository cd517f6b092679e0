"""Hand-computed values from the rating and pricing rules."""

import datetime as dt

from pyspark.sql import functions as F

from policylens.functions import exprs as X
from policylens.operators import monitor, quote


def one(spark, col):
    return spark.range(1).select(col.alias("v")).first()["v"]


def test_feb29_birthday_age(spark):
    assert one(spark, X.whole_years(X.as_date("2021-02-28"), F.lit(dt.date(2004, 2, 29)))) == 16
    assert one(spark, X.whole_years(X.as_date("2021-03-01"), F.lit(dt.date(2004, 2, 29)))) == 17


def test_mileage_curve_strict_and_intended(spark):
    assert abs(one(spark, X.mileage_risk(F.lit(5999))) - 1.0) < 1e-12
    assert one(spark, X.mileage_risk(F.lit(6000))) == 1.5
    assert abs(one(spark, X.mileage_risk(F.lit(6000), strict_curve=False)) - 1.02) < 1e-12


def test_state_risk_la_and_unknown(spark):
    assert one(spark, X.state_risk(F.lit("LA"))) == 1.1
    assert one(spark, X.state_risk(F.lit("ZZ"))) == 1.0


def test_age_curve_peak_and_outside(spark):
    assert abs(one(spark, X.age_risk(F.lit(45))) - 1.1) < 1e-12
    assert one(spark, X.age_risk(F.lit(100))) == 1.5


def test_spaced_model_name_misses_lookup(spark):
    key = X.make_model_key(F.lit("BMW"), F.lit("3 Series"))
    assert one(spark, key) == "bmw_3 series"
    assert one(spark, X.make_model_risk(key)) == 1.0
    assert one(spark, X.vehicle_class(key)) == "standard"


def test_territory_rules(spark):
    assert one(spark, X.territory(F.lit("10001"))) == "urban"
    assert one(spark, X.territory(F.lit("00501"))) == "default"
    assert one(spark, X.enhanced_territory(F.lit("00501"), F.lit("OH"))) == "urban_high_density"
    assert one(spark, X.enhanced_territory(F.lit("90210"), F.lit("CA"))) == "coastal"
    assert one(spark, X.enhanced_territory(F.lit("80202"), F.lit("CO"))) == "mountain"


def _quote(spark, prediction, credit, insurance, territory=None):
    preds = spark.createDataFrame([(1, float(prediction))], "policy_id long, prediction double")
    pol = spark.createDataFrame([(1, credit, insurance, territory)],
                                "policy_id long, credit_score double, insurance_score double, territory_factor double")
    return quote.quote(preds, pol).first()


def test_quote_goldens(spark):
    r = _quote(spark, 1.2, 750.0, 85.0)
    assert abs(r["final_premium"] - 405.0) < 1e-9
    assert set(r["factors"]) == {"credit_factor", "insurance_factor"}
    r = _quote(spark, 1.2, None, None)
    assert r["final_premium"] == 500.0 and r["factors"] == {}
    r = _quote(spark, 3000, None, None)
    assert r["final_premium"] == 3_000_000.0


def test_zero_score_counts_as_absent(spark):
    r = _quote(spark, 1.2, 0.0, 0.0)
    assert r["final_premium"] == 500.0


def test_group_factors_non_positive_total(spark):
    df = spark.createDataFrame([(1, -1.0, -1.0)], "policy_id long, driver_a double, vehicle_b double")
    r = quote.group_factors(df, {"driver_a": 1.0, "vehicle_b": 1.0}).first()
    assert (r["driver_factor"], r["vehicle_factor"], r["history_factor"], r["location_factor"]) == (
        0.25, 0.25, 0.25, 0.25)


def test_psi_all_equal_is_zero(spark):
    rows = [("m", "reference" if i < 5 else "current", "k", 3.0) for i in range(10)]
    df = spark.createDataFrame(rows, "model_id string, period string, feature string, value double")
    assert monitor.psi(df).first()["psi"] == 0.0


def test_no_incidents_default_row(spark):
    from policylens.operators import features
    pol = spark.createDataFrame([(7,)], "policy_id long")
    hist = spark.createDataFrame([], "policy_id long, incident_type string, incident_date date, severity string, "
                                     "claim_amount double, at_fault boolean")
    r = features.history_with_defaults(pol, hist, "2002-01-01").first()
    assert tuple(r)[1:] == (0.0, 0.0, 0.0, 0.0, 0.0, 10.0, 0.0)
