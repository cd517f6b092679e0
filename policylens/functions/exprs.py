"""Column -> Column rating and feature expressions.

Each function takes and returns ``Column`` objects, so one definition serves
flat child tables (``select``) and nested arrays (``transform(arr, f)``).
All of them are native Catalyst expressions: they stay inside whole-stage
codegen and need no Python at run time.

Small fixed lookups (occupation, make/model, territory, state) are compiled
into map literals: a lookup is a hash probe inside the projection, with no
join and no exchange.
"""

from __future__ import annotations

import datetime as _dt
from pyspark.sql import Column
from pyspark.sql import functions as F

from policylens.functions import dims


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def as_date(value) -> Column:
    """A date parameter as a literal column (accepts str/date/Column)."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str):
        value = _dt.date.fromisoformat(value)
    return F.lit(value)


def ident(name: str) -> str:
    """A column name in SQL text; a backtick in it is doubled."""
    return "`" + name.replace("`", "``") + "`"


def sql_literal(v) -> str:
    """A Python constant as Spark SQL literal text (floats as DOUBLE)."""
    if v is None:
        return "NULL"
    if isinstance(v, bool):
        return "true" if v else "false"
    if isinstance(v, int):
        return str(v)
    if isinstance(v, float):
        return repr(v) + "D"
    return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"


def map_literal(mapping: dict) -> Column:
    """A constant map, built by one SQL expression (constant-folded)."""
    body = ", ".join(f"{sql_literal(k)}, {sql_literal(v)}" for k, v in mapping.items())
    return F.expr(f"map({body})")


def array_literal(values) -> Column:
    return F.expr("array(" + ", ".join(sql_literal(v) for v in values) + ")")


def is_in(col, values) -> Column:
    """``col IN (values)`` against a constant list (null col -> null)."""
    return F.array_contains(array_literal(values), _c(col))


def lookup(mapping: dict, key: Column, default=None) -> Column:
    """Dictionary lookup with default (null key -> default)."""
    found = F.try_element_at(map_literal(mapping), key)
    return found if default is None else F.coalesce(found, F.lit(default))


# ---- dates (F1-F4, F29-F31) ------------------------------------------------

def whole_years(as_of: Column, since) -> Column:
    """whole years between two dates; the year only counts once the
    (month, day) of ``as_of`` has reached that of ``since``."""
    since = _c(since)
    before = (F.month(as_of) * 100 + F.dayofmonth(as_of)) < (F.month(since) * 100 + F.dayofmonth(since))
    return (F.year(as_of) - F.year(since) - before.cast("int")).cast("int")


def vehicle_age(as_of: Column, year) -> Column:
    """year(as_of) - model year (may be negative)."""
    return (F.year(as_of) - _c(year)).cast("int")


def duration_days(start, end) -> Column:
    """policy duration in days."""
    return F.datediff(_c(end), _c(start))


def ratio_at_least_one(num, den) -> Column:
    """num / max(1, den)."""
    return _c(num).cast("double") / F.greatest(F.lit(1), _c(den)).cast("double")


def days_back(as_of_ts: Column, days: int) -> Column:
    """as_of - N days."""
    return as_of_ts - F.make_interval(days=F.lit(days))


# ---- bands and one-hot (F6, F7) ---------------------------------------------

def age_band(age) -> Column:
    """left-closed bins [18,25,35,45,55,65,100); outside -> null."""
    age = _c(age)
    edges, labels = dims.AGE_BAND_EDGES, dims.AGE_BAND_LABELS
    expr = None
    for lo, hi, label in zip(edges[:-1], edges[1:], labels):
        cond = (age >= lo) & (age < hi)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def one_hot(col, label: str) -> Column:
    """1 when the value equals ``label`` else 0 (null -> 0)."""
    return F.coalesce((_c(col) == F.lit(label)).cast("int"), F.lit(0))


def one_hot_nullable(col, label: str) -> Column:
    """Learned one-hot: null input stays null (absent category)."""
    return (_c(col) == F.lit(label)).cast("double")


# ---- vehicle (F8, F9, F16-F20, F25) -------------------------------------------

def make_model_key(make, model) -> Column:
    """F8: lower-cased ``make_model``; spaces are kept."""
    return F.concat_ws("_", F.lower(_c(make)), F.lower(_c(model)))


def vehicle_class(key) -> Column:
    """substring rules, first match wins."""
    key = _c(key)
    return (F.when(key.contains("corvette") | key.contains("mustang"), "sports")
            .when(key.contains("f150") | key.contains("silverado"), "truck")
            .when(key.contains("5series") | key.contains("eclass"), "luxury")
            .when(key.contains("model3") | key.contains("modely"), "electric")
            .otherwise("standard"))


def make_model_risk(key) -> Column:
    """make_model -> risk, default 1.0."""
    return lookup(dims.MAKE_MODEL_RISK, _c(key), dims.MAKE_MODEL_DEFAULT)


def vehicle_category(key) -> Column:
    """J3 (category column)."""
    cats = {k: v[0] for k, v in dims.VEHICLE_CATEGORY.items()}
    return lookup(cats, _c(key), dims.VEHICLE_CATEGORY_DEFAULT[0])


def category_risk(key) -> Column:
    risks = {k: v[1] for k, v in dims.VEHICLE_CATEGORY.items()}
    return lookup(risks, _c(key), dims.VEHICLE_CATEGORY_DEFAULT[1])


def theft_risk(key, anti_theft) -> Column:
    """J3 + F18: theft risk, x0.7 with an anti-theft device."""
    risks = {k: v[2] for k, v in dims.VEHICLE_CATEGORY.items()}
    base = lookup(risks, _c(key), dims.VEHICLE_CATEGORY_DEFAULT[2])
    return base * F.when(_c(anti_theft), F.lit(0.7)).otherwise(F.lit(1.0))


def depreciation_factor(age) -> Column:
    """F16: value depreciation by vehicle age."""
    a = _c(age)
    return (F.when(a == 0, F.lit(1.0)).when(a == 1, F.lit(0.8)).when(a == 2, F.lit(0.7))
            .when(a == 3, F.lit(0.65))
            .when((a >= 4) & (a <= 9), F.lit(0.65) - F.lit(0.025) * (a - 3))
            .when((a >= 10) & (a <= 29), F.lit(0.45) - F.lit(0.01) * (a - 10))
            .otherwise(F.lit(0.25)))


def mileage_risk(mileage, strict_curve: bool = True) -> Column:
    """mileage risk.

    ``strict_curve=True`` reproduces the rating table exactly: the mileage is
    floored to thousands and looked up by exact key; the table's keys above
    5000 are 5001, 6001, ... so every mileage from 6000 up misses and gets
    1.5. ``False`` gives the intended piecewise curve.
    """
    m = _c(mileage)
    k = F.floor(m / F.lit(1000))  # thousands, as an integer
    low = F.lit(0.8) + F.lit(0.04) * k
    if strict_curve:
        return F.when((m >= 0) & (m <= 5999), low).otherwise(F.lit(1.5))
    return (F.when((m >= 0) & (m < 6000), low)
            .when((m >= 6000) & (m < 16000), F.lit(1.0) + F.lit(0.02) * (k - 5))
            .when((m >= 16000) & (m < 51000), F.lit(1.2) + F.lit(0.01) * (k - 15))
            .otherwise(F.lit(1.5)))


def value_mileage_factor(value, mileage) -> Column:
    """F20."""
    return (_c(value) / F.lit(10000.0)) * (_c(mileage) / F.lit(10000.0))


# ---- territory and location (F10, F11, F21, J4-J6) ----------------------------

def territory(zip_code) -> Column:
    """by first ZIP digit; null/empty -> default."""
    d = F.substring(_c(zip_code), 1, 1)
    return (F.when(d.isin("1", "2", "3"), "urban").when(d.isin("4", "5", "6"), "suburban")
            .when(d.isin("7", "8", "9"), "rural").otherwise("default"))


def territory_risk(terr, which: str) -> Column:
    """Territory -> crime_rate / weather_risk / traffic_density."""
    idx = ("crime_rate", "weather_risk", "traffic_density").index(which)
    return lookup({k: v[idx] for k, v in dims.TERRITORY_RISK.items()}, _c(terr),
                  dims.TERRITORY_RISK["default"][idx])


def enhanced_territory(zip_code, state) -> Column:
    """ordered rules on state and the first two ZIP digits."""
    z, s = _c(zip_code), _c(state)
    d1, d2 = F.substring(z, 1, 1), F.substring(z, 2, 1)
    return (F.when(is_in(s, dims.COASTAL_STATES) & d2.isin("0", "1", "2"), "coastal")
            .when(is_in(s, dims.MOUNTAIN_STATES), "mountain")
            .when(d1.isin("0", "1", "2", "3"),
                  F.when(d2.isin("0", "1"), "urban_high_density")
                  .when(d2.isin("2", "3", "4"), "urban_medium_density")
                  .otherwise("urban_low_density"))
            .when(d1.isin("4", "5", "6"),
                  F.when(d2.isin("0", "1", "2"), "suburban_high_income")
                  .when(d2.isin("3", "4", "5", "6"), "suburban_medium_income")
                  .otherwise("suburban_low_income"))
            .when(d1.isin("7", "8", "9"),
                  F.when(d2.isin("0", "1", "2", "3"), "rural_town").otherwise("rural_remote"))
            .otherwise("default"))


def enhanced_territory_risk(terr, which: str) -> Column:
    """Enhanced territory -> one of six risks."""
    idx = dims.ENHANCED_RISK_COLUMNS.index(which)
    return lookup({k: v[idx] for k, v in dims.ENHANCED_TERRITORY_RISK.items()}, _c(terr),
                  dims.ENHANCED_TERRITORY_RISK["default"][idx])


def state_risk(state) -> Column:
    """State -> risk, default 1.0."""
    return lookup(dims.STATE_RISK, _c(state), dims.STATE_RISK_DEFAULT)


def weighted_location_risk(crime, weather, traffic, parking, vandalism, flood, state_factor) -> Column:
    """F21 on already looked-up risks."""
    return (crime * 0.3 + weather * 0.2 + traffic * 0.2 + parking * 0.1 + vandalism * 0.1 + flood * 0.1) * state_factor


def combined_location_risk(terr, state) -> Column:
    """weighted territory risks x state risk."""
    r = [enhanced_territory_risk(terr, c) for c in dims.ENHANCED_RISK_COLUMNS]
    return weighted_location_risk(*r, state_risk(state))


# ---- driver (F12-F15, J1) ---------------------------------------------------

def occupation_risk(occupation) -> Column:
    """Case-insensitive occupation -> risk; null/unknown -> 1.0."""
    return lookup(dims.OCCUPATION_RISK, F.lower(_c(occupation)), dims.OCCUPATION_DEFAULT)


def age_risk(age) -> Column:
    """age risk curve, 1.5 outside 16..99."""
    a = _c(age)
    return (F.when((a >= 16) & (a <= 24), F.lit(1.5) - F.lit(0.05) * (a - 16))
            .when((a >= 25) & (a <= 64), F.lit(1.0) + F.lit(0.005) * F.least(a - 25, F.lit(65) - a))
            .when((a >= 65) & (a <= 99), F.lit(1.0) + F.lit(0.02) * (a - 65))
            .otherwise(F.lit(1.5)))


def experience_risk(years) -> Column:
    """experience risk curve, 1.5 outside 0..59."""
    y = _c(years)
    return (F.when((y >= 0) & (y <= 2), F.lit(1.5) - F.lit(0.1) * y)
            .when((y >= 3) & (y <= 9), F.lit(1.3) - F.lit(0.04) * (y - 3))
            .when((y >= 10) & (y <= 59), F.lit(1.0))
            .otherwise(F.lit(1.5)))


def license_recency(age, experience) -> Column:
    """(age - experience) / age; 1.0 when age <= 0."""
    a, e = _c(age), _c(experience)
    return F.when(a > 0, (a - e).cast("double") / a.cast("double")).otherwise(F.lit(1.0))


# ---- pricing factors (F22-F24) -------------------------------------------------

def truthy(col) -> Column:
    """null or 0 counts as absent."""
    return F.nullif(_c(col), F.lit(0).cast("double"))


def credit_factor(score) -> Column:
    """F22."""
    s = _c(score)
    return (F.when(s >= 800, F.lit(0.8)).when(s >= 740, F.lit(0.9)).when(s >= 670, F.lit(1.0))
            .when(s >= 580, F.lit(1.2)).otherwise(F.lit(1.5)))


def insurance_factor(score) -> Column:
    """F23."""
    s = _c(score)
    return (F.when(s >= 90, F.lit(0.8)).when(s >= 80, F.lit(0.9)).when(s >= 70, F.lit(1.0))
            .when(s >= 60, F.lit(1.1)).when(s >= 50, F.lit(1.2)).otherwise(F.lit(1.3)))


# ---- JSON (F26-F28) ------------------------------------------------------------

def json_to_double_map(col) -> Column:
    """JSON object text -> map<string,double>; non-numeric values -> null."""
    return F.from_json(_c(col), "map<string,string>")


# ---- registry (F31, F32) -------------------------------------------------------

def version_stamp(ts) -> Column:
    """``yyyyMMddHHmmss`` stamp."""
    return F.date_format(_c(ts), "yyyyMMddHHmmss")


def model_path_parts(path) -> tuple[Column, Column]:
    """F32: (model name, version) from ``.../{name}_{yyyyMMddHHmmss}...``."""
    pat = r"([a-z_]+)_(\d{14})"
    return F.regexp_extract(_c(path), pat, 1), F.regexp_extract(_c(path), pat, 2)
