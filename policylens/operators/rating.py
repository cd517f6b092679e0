"""Rule-based rating (R1-R6): premium = base x ten multiplicative factors.

Each child contributes a multiplier; a policy's factor is the product over
its children (A10, ``F.product``: partial aggregation on the map side, one
shuffle on ``policy_id``). Policies without children of a kind get 1.0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.functions import exprs as X

BASE_PREMIUM = 1000.0

DRIVER_FACTORS = ("driver_age_factor", "driver_experience_factor", "driver_occupation_factor")
VEHICLE_FACTORS = ("vehicle_age_factor", "vehicle_value_factor", "vehicle_use_factor")
HISTORY_FACTORS = ("accident_factor", "violation_factor", "claim_factor")
LOCATION_FACTORS = ("location_factor",)
ALL_FACTORS = DRIVER_FACTORS + VEHICLE_FACTORS + HISTORY_FACTORS + LOCATION_FACTORS


def _one(x: float) -> Column:
    return F.lit(float(x))


def driver_multipliers(as_of, get=F.col) -> dict[str, Column]:
    """R1 per driver (``get`` reads a field: a column, or a struct element
    inside ``transform``/``aggregate`` for nested policies)."""
    a = X.as_date(as_of)
    age = X.whole_years(a, get("date_of_birth"))
    exp = X.whole_years(a, get("license_issue_date"))
    occ = get("occupation")
    return {
        "driver_age_factor": F.when(age < 25, _one(1.5)).when(age < 35, _one(1.2))
        .when(age > 65, _one(1.3)).otherwise(_one(1.0)),
        "driver_experience_factor": F.when(exp < 3, _one(1.4)).when(exp < 10, _one(1.1)).otherwise(_one(1.0)),
        "driver_occupation_factor": F.when(occ.isin("Driver", "Pilot"), _one(1.2))
        .when(occ.isin("Student", "Unemployed"), _one(1.1)).otherwise(_one(1.0)),
    }


def vehicle_multipliers(as_of, get=F.col) -> dict[str, Column]:
    """R2 per vehicle."""
    age = X.vehicle_age(X.as_date(as_of), get("year"))
    v, use = get("value"), get("primary_use")
    return {
        "vehicle_age_factor": F.when(age < 3, _one(1.2)).when(age > 10, _one(1.1)).otherwise(_one(1.0)),
        "vehicle_value_factor": F.when(v > 30000, _one(1.3)).when(v > 20000, _one(1.2))
        .when(v > 10000, _one(1.1)).otherwise(_one(1.0)),
        "vehicle_use_factor": F.when(use == "business", _one(1.3)).when(use == "commute", _one(1.1))
        .otherwise(_one(1.0)),
    }


def history_multipliers(get=F.col) -> dict[str, Column]:
    """R3 per incident."""
    t, s, amt = get("incident_type"), get("severity"), get("claim_amount")
    by_sev = lambda major, moderate, other: (F.when(s == "major", _one(major))
                                             .when(s == "moderate", _one(moderate)).otherwise(_one(other)))
    return {
        "accident_factor": F.when(t == "accident", by_sev(1.5, 1.3, 1.1)).otherwise(_one(1.0)),
        "violation_factor": F.when(t == "violation", by_sev(1.4, 1.2, 1.1)).otherwise(_one(1.0)),
        "claim_factor": F.when(t == "claim", F.when(amt > 5000, _one(1.4)).when(amt > 2000, _one(1.2))
                               .otherwise(_one(1.1))).otherwise(_one(1.0)),
    }


def location_multipliers(get=F.col) -> dict[str, Column]:
    """R4 per location."""
    d = F.substring(get("zip_code"), 1, 1)
    return {"location_factor": F.when(d.isin("1", "2", "3"), _one(1.2))
            .when(d.isin("4", "5", "6"), _one(1.1)).otherwise(_one(1.0))}


def _product_per_policy(child: DataFrame, mults: dict[str, Column]) -> DataFrame:
    return child.groupBy("policy_id").agg(*[F.product(c).alias(n) for n, c in mults.items()])


def rate_driver(drivers: DataFrame, as_of) -> DataFrame:
    return _product_per_policy(drivers, driver_multipliers(as_of))


def rate_vehicle(vehicles: DataFrame, as_of) -> DataFrame:
    return _product_per_policy(vehicles, vehicle_multipliers(as_of))


def rate_history(history: DataFrame) -> DataFrame:
    return _product_per_policy(history, history_multipliers())


def rate_location(locations: DataFrame) -> DataFrame:
    return _product_per_policy(locations, location_multipliers())


def rate_policy(policies: DataFrame, drivers: DataFrame, vehicles: DataFrame, history: DataFrame,
                locations: DataFrame, as_of, base_premium: float = BASE_PREMIUM,
                with_factors: bool = False) -> DataFrame:
    """premium = base x product of all ten factors (noise-free)."""
    j = policies.select("policy_id")
    for part in (rate_driver(drivers, as_of), rate_vehicle(vehicles, as_of),
                 rate_history(history), rate_location(locations)):
        j = j.join(part, "policy_id", "left")
    factors = {n: F.coalesce(F.col(n), _one(1.0)) for n in ALL_FACTORS}
    premium = F.lit(float(base_premium))
    for n in ALL_FACTORS:
        premium = premium * factors[n]
    cols = [F.col("policy_id")]
    if with_factors:
        cols += [c.alias(n) for n, c in factors.items()]
    return j.select(*cols, premium.alias("premium"))


def rate_nested(policies: DataFrame, as_of, base_premium: float = BASE_PREMIUM) -> DataFrame:
    """R5 on nested policy records: each factor is a fold over the child array
    (``aggregate``), so a stream of requests is priced without any shuffle."""
    def fold(arr: str, mults_fn, name: str) -> Column:
        return F.aggregate(F.coalesce(F.col(arr), F.array()), F.lit(1.0),
                           lambda acc, x: acc * mults_fn(lambda f: x[f])[name])
    parts = {}
    for n in DRIVER_FACTORS:
        parts[n] = fold("drivers", lambda g: driver_multipliers(as_of, g), n)
    for n in VEHICLE_FACTORS:
        parts[n] = fold("vehicles", lambda g: vehicle_multipliers(as_of, g), n)
    for n in HISTORY_FACTORS:
        parts[n] = fold("driving_history", lambda g: history_multipliers(g), n)
    parts["location_factor"] = fold("locations", lambda g: location_multipliers(g), "location_factor")
    premium = F.lit(float(base_premium))
    for n in ALL_FACTORS:
        premium = premium * parts[n]
    return policies.select("*", premium.alias("premium"))


def labelled_dataset(features: DataFrame, premiums: DataFrame) -> DataFrame:
    """Each policy's features with its premium (inner join on id)."""
    return features.join(premiums.select("policy_id", "premium"), "policy_id", "inner")
