"""Enhanced features (X6-X9, A2): risk curves, categories and modes.

The enhanced policy row extends the base row: every child frame gains its
risk columns (aggregated as mean/max/min like the base ones) and each
categorical column becomes the per-policy mode (A2).

The mode uses ``F.mode(col, deterministic=True)`` (ties -> smallest). Its
buffer is a value->count map per policy, bounded by the category list, and
it merges partial buffers, so it keeps map-side aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.functions import dims
from policylens.functions import exprs as X
from policylens.operators import features as B


def driver_risk(drivers: DataFrame, as_of) -> DataFrame:
    """X6 (F12-F15), one row per driver."""
    ages = B.driver_age_cols(as_of)
    d = drivers.select("policy_id", *[c.alias(n) for n, c in ages.items()])
    a, e = F.col("driver_age"), F.col("driver_experience")
    return d.select("policy_id", "driver_age", "driver_experience",
                    X.age_risk(a).alias("age_risk_factor"),
                    X.experience_risk(e).alias("experience_risk_factor"),
                    X.license_recency(a, e).alias("license_recency_factor"),
                    X.ratio_at_least_one(a, e).alias("age_experience_ratio"))


def vehicle_risk(vehicles: DataFrame, as_of, strict_curve: bool = True) -> DataFrame:
    """X7 (J3, F16-F20), one row per vehicle."""
    key = X.make_model_key("make", "model")
    age = X.vehicle_age(X.as_date(as_of), "year")
    v = vehicles.select("policy_id", key.alias("make_model"), age.alias("vehicle_age"),
                        F.col("value").cast("double").alias("value"), "annual_mileage", "anti_theft_device")
    return v.select(
        "policy_id", "make_model",
        X.vehicle_category("make_model").alias("vehicle_category"),
        X.category_risk("make_model").alias("category_risk_factor"),
        X.theft_risk("make_model", "anti_theft_device").alias("theft_risk_factor"),
        (F.col("value") * X.depreciation_factor("vehicle_age")).alias("depreciated_value"),
        X.mileage_risk("annual_mileage", strict_curve).alias("mileage_risk_factor"),
        X.ratio_at_least_one("value", "vehicle_age").alias("value_age_ratio"),
        X.value_mileage_factor("value", "annual_mileage").alias("value_mileage_factor"))


def location_risk(locations: DataFrame) -> DataFrame:
    """X8 (F11, J5, J6, F21), one row per location."""
    t = X.enhanced_territory("zip_code", "state")
    loc = locations.select("policy_id", "state", "zip_code", t.alias("enhanced_territory"))
    et = F.col("enhanced_territory")
    return loc.select(
        "policy_id", "state", "zip_code", "enhanced_territory",
        *[X.enhanced_territory_risk(et, c).alias(f"territory_{c}") for c in dims.ENHANCED_RISK_COLUMNS],
        X.state_risk("state").alias("state_risk_factor"),
        X.combined_location_risk(et, "state").alias("location_combined_risk"))


VEHICLE_CATEGORIES = sorted({v[0] for v in dims.VEHICLE_CATEGORY.values()} | {dims.VEHICLE_CATEGORY_DEFAULT[0]})
ENHANCED_TERRITORIES = sorted(dims.ENHANCED_TERRITORY_RISK)


def mode_aggs(col: str, categories: list[str], tag: str):
    """A2 over a known, sorted category list: one count per category inside
    the caller's hash aggregate, and the argmax as a final expression (ties ->
    the smallest category, no value -> null). Plain long counters keep the
    aggregate on the code-generated hash path."""
    k = len(categories)
    aggs = [F.count_if(F.col(col) == F.lit(c)).alias(f"_c|{tag}|{i}") for i, c in enumerate(categories)]
    codes = [F.when(F.col(f"`_c|{tag}|{i}`") > 0, F.col(f"`_c|{tag}|{i}`") * F.lit(k) + F.lit(k - 1 - i))
             for i in range(k)]
    best = F.greatest(*codes) if k > 1 else codes[0]
    idx = F.lit(k - 1) - F.pmod(best, F.lit(k))
    final = F.element_at(F.array(*[F.lit(c) for c in categories]), (idx + 1).cast("int"))
    return aggs, final


def categorical_mode(child: DataFrame, col: str, out: str, categories: list[str] | None = None) -> DataFrame:
    """A2: most frequent value per policy; ties -> smallest value.

    With a known category list the counts stay in a code-generated hash
    aggregate; otherwise ``F.mode(deterministic=True)`` is used (its buffer
    is a value->count map, bounded by the distinct values per policy)."""
    if categories is None:
        return child.groupBy("policy_id").agg(F.mode(F.col(col), True).alias(out))
    aggs, final = mode_aggs(col, categories, out)
    return child.groupBy("policy_id").agg(*aggs).select("policy_id", final.alias(out))


DRIVER_EXTRA = ("age_risk_factor", "experience_risk_factor", "license_recency_factor", "age_experience_ratio")
VEHICLE_EXTRA = ("category_risk_factor", "theft_risk_factor", "depreciated_value", "mileage_risk_factor",
                 "value_age_ratio", "value_mileage_factor")
LOCATION_EXTRA = tuple(f"territory_{c}" for c in dims.ENHANCED_RISK_COLUMNS) + (
    "state_risk_factor", "location_combined_risk")


def _mode_of(name: str, category, categories: list[str]):
    """A2 for the folded row: the mode's name, a 0/1 column for each category, and the mode from their sums; null where no child has a category."""
    _, best = mode_aggs(category, categories, name)
    counts = [f"_c|{name}|{i}" for i in range(len(categories))]
    some = sum((F.col(c) for c in counts[1:]), F.col(counts[0])) > 0
    return name, [(n, X.one_hot(category, c)) for n, c in zip(counts, categories, strict=True)], F.when(some, best)


def policy_features_enhanced(policies, drivers, vehicles, history, locations, vocab, as_of,
                             strict_curve: bool = True) -> DataFrame:
    """Base policy row + enhanced child aggregates + categorical modes, folded with them after the same one exchange."""
    rows = B.child_parts(B.stack_tables(policies, drivers, vehicles, history, locations), as_of)
    v, loc = F.col("v"), F.col("l")
    rows = rows.select("*", X.vehicle_age(X.as_date(as_of), v["year"]).alias("_vage"), X.vehicle_category("_key").alias("_category"),
                       X.enhanced_territory(loc["zip_code"], loc["state"]).alias("_et"))
    a, e, risks = F.col("_age"), F.col("_years"), {f"territory_{c}": X.enhanced_territory_risk("_et", c) for c in dims.ENHANCED_RISK_COLUMNS}
    state = X.state_risk(loc["state"])
    more = {"d": (X.age_risk(a), X.experience_risk(e), X.license_recency(a, e), X.ratio_at_least_one(a, e)),
            "v": (X.category_risk("_key"), X.theft_risk("_key", v["anti_theft_device"]), v["value"] * X.depreciation_factor("_vage"), X.mileage_risk(v["annual_mileage"], strict_curve),
                  X.ratio_at_least_one(v["value"], "_vage"), X.value_mileage_factor(v["value"], v["annual_mileage"])),
            "l": (*risks.values(), state, X.weighted_location_risk(*risks.values(), state))}
    names = {"d": DRIVER_EXTRA, "v": VEHICLE_EXTRA, "l": LOCATION_EXTRA}
    modes = {"v": _mode_of("vehicle_vehicle_category_mode", "_category", VEHICLE_CATEGORIES),
             "l": _mode_of("location_enhanced_territory_mode", "_et", ENHANCED_TERRITORIES)}
    return B.fold_policies(rows, vocab, as_of, {k: dict(zip(names[k], cols, strict=True)) for k, cols in more.items()}, modes)
