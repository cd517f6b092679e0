"""Base policy features.

Layout: a policy is a row of ``policies`` plus child rows in ``drivers``,
``vehicles``, ``history`` and ``locations`` keyed by ``policy_id``.

Plan shape at scale: each child table is reduced to one row per policy by
a single hash aggregate (partial aggregation on the map side, then one
shuffle on ``policy_id``). The four per-policy results are hash partitioned
on the same key, so the final left joins with the policy table add only
the policy table's own exchange. Aggregates are algebraic (count, sum, min,
max, avg), so a policy that owns a huge share of the children is reduced on
the map side and never lands whole in one task.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from types import SimpleNamespace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.functions import dims
from policylens.functions import exprs as X
from policylens.operators import fold

STATS = ("mean", "max", "min")


@dataclass
class Vocabulary:
    """Learned one-hot vocabularies (sorted), as fitted on the training rows."""

    genders: list[str] = field(default_factory=list)
    marital_statuses: list[str] = field(default_factory=list)
    uses: list[str] = field(default_factory=list)
    states: list[str] = field(default_factory=list)
    incident_types: list[str] = field(default_factory=list)
    severities: list[str] = field(default_factory=list)

    def to_dict(self) -> dict:
        return dict(self.__dict__)

    @classmethod
    def from_dict(cls, d: dict) -> "Vocabulary":
        return cls(**d)


def category_vocab_frame(drivers: DataFrame, vehicles: DataFrame, history: DataFrame,
                         locations: DataFrame) -> DataFrame:
    """Distinct categories per encoder as long rows (encoder, category); each table is scanned once and
    reduced to the combinations of its categories before they are taken apart.

    The encoders only ever see enum values or state codes, so the result is a
    bounded vocabulary, not a function of the data volume.
    """
    def pairs(df: DataFrame, **encoders: str) -> DataFrame:
        return df.select(*encoders.values()).distinct().select(F.inline(F.array(*[
            F.struct(F.lit(e).alias("encoder"), F.col(c).alias("category")) for e, c in encoders.items()])))

    out = pairs(drivers, gender="gender", marital_status="marital_status")
    for p in (pairs(vehicles, use="primary_use"), pairs(locations, state="state"),
              pairs(history, incident_type="incident_type", severity="severity")):
        out = out.unionByName(p)
    return out.where(F.col("category").isNotNull()).distinct()


def fit_vocabulary(drivers, vehicles, history, locations) -> Vocabulary:
    """Fit all encoders in one job; only the small vocabulary reaches the driver."""
    rows = category_vocab_frame(drivers, vehicles, history, locations).collect()
    voc: dict[str, list[str]] = {}
    for r in rows:
        voc.setdefault(r["encoder"], []).append(r["category"])
    get = lambda k: sorted(voc.get(k, []))
    return Vocabulary(genders=get("gender"), marital_statuses=get("marital_status"), uses=get("use"),
                      states=get("state"), incident_types=get("incident_type"), severities=get("severity"))


# ---- per-child features --------------------------------------------------------

def driver_age_cols(as_of) -> dict[str, Column]:
    a = X.as_date(as_of)
    return {"driver_age": X.whole_years(a, "date_of_birth"),
            "driver_experience": X.whole_years(a, "license_issue_date")}


# The columns of one child, from ``get``, which gives its fields by name: columns of a flat table, or fields of a struct.

def driver_columns(get, vocab: Vocabulary, band: Column | None = None) -> dict[str, Column]:
    """X1; ``get`` also gives driver_age and driver_experience. Here and below, what several columns are taken from may be given as a column of its own."""
    band = X.age_band(get("driver_age")) if band is None else band
    return ({c: get(c) for c in ("driver_age", "driver_experience")} | {f"age_band_{lbl}": X.one_hot(band, lbl) for lbl in dims.AGE_BAND_LABELS}
            | {f"gender_{g}": X.one_hot_nullable(get("gender"), g) for g in vocab.genders}
            | {f"marital_status_{m}": X.one_hot_nullable(get("marital_status"), m) for m in vocab.marital_statuses}
            | {"occupation_risk": X.occupation_risk(get("occupation"))})


def vehicle_columns(get, vocab: Vocabulary, as_of, key: Column | None = None, cls: Column | None = None) -> dict[str, Column]:
    """X2."""
    key = X.make_model_key(get("make"), get("model")) if key is None else key
    cls = X.vehicle_class(key) if cls is None else cls
    return ({"vehicle_age": X.vehicle_age(X.as_date(as_of), get("year")), "vehicle_value": get("value").cast("double"), "annual_mileage": get("annual_mileage"),
             "anti_theft_device": get("anti_theft_device").cast("int"), "make_model_risk": X.make_model_risk(key)}
            | {f"vehicle_class_{c}": X.one_hot(cls, c) for c in dims.VEHICLE_CLASSES} | {f"use_{u}": X.one_hot_nullable(get("primary_use"), u) for u in vocab.uses})


def location_columns(get, vocab: Vocabulary, terr: Column | None = None) -> dict[str, Column]:
    """X4."""
    terr = X.territory(get("zip_code")) if terr is None else terr
    return ({w: X.territory_risk(terr, w) for w in ("crime_rate", "weather_risk", "traffic_density")} | {f"territory_{t}": X.one_hot(terr, t) for t in dims.TERRITORIES}
            | {f"state_{s}": X.one_hot(get("state"), s).cast("double") for s in vocab.states})


def _with_key(rows: DataFrame, cols: dict[str, Column]) -> DataFrame:
    return rows.select("policy_id", *[c.alias(n) for n, c in cols.items()])


def driver_features(drivers: DataFrame, vocab: Vocabulary, as_of) -> DataFrame:
    """One row per driver with numeric features."""
    d = drivers.select("policy_id", "gender", "marital_status", "occupation",
                       *[c.alias(n) for n, c in driver_age_cols(as_of).items()])
    d = d.withColumn("_band", X.age_band("driver_age"))
    return _with_key(d, driver_columns(F.col, vocab, F.col("_band")))


def vehicle_features(vehicles: DataFrame, vocab: Vocabulary, as_of) -> DataFrame:
    """One row per vehicle."""
    v = vehicles.withColumn("_key", X.make_model_key("make", "model"))
    v = v.withColumn("_class", X.vehicle_class("_key"))
    return _with_key(v, vehicle_columns(F.col, vocab, as_of, F.col("_key"), F.col("_class")))


def location_features(locations: DataFrame, vocab: Vocabulary) -> DataFrame:
    """One row per location."""
    return _with_key(locations.withColumn("_terr", X.territory("zip_code")), location_columns(F.col, vocab, F.col("_terr")))


# ---- per-policy aggregation --------------------------------------------------------

_BINARY = re.compile(r"^(age_band_|gender_|marital_status_|vehicle_class_|use_)"
                     r"|^territory_(urban|suburban|rural|default)$|^state_[A-Z]{2}$")


def is_binary(name: str) -> bool:
    """One-hot columns hold only 0, 1 (or null for an absent category).
    Anything not matched takes the general (avg/max/min) path."""
    return bool(_BINARY.match(name))


def stat_aggs(value_cols, binary=is_binary, tag: str = ""):
    """Aggregates + final SQL expressions for mean/max/min per column.

    For a 0/1 column the three statistics follow from its sum and non-null
    count (mean = s/n, max = [s > 0], min = [s = n]), so it needs two cheap
    integer aggregates instead of three; this keeps the wide per-policy
    aggregate small. A statistic over no value is 0. Both lists are SQL text
    so that a wide aggregate costs one call per column to build. ``tag`` tells
    the aggregates of tables apart that are joined before the final expressions;
    those give 0 for a policy without a row, too.
    """
    aggs, finals, q = [], [], X.ident
    for c in value_cols:
        if binary(c):
            s, n = q(f"_s{tag}|{c}"), q(f"_n{tag}|{c}")
            aggs += [F.expr(f"sum(CAST({q(c)} AS BIGINT)) AS {s}"), F.expr(f"count({q(c)}) AS {n}")]
            finals.append((c, f"CASE WHEN {n} > 0 THEN CAST({s} AS DOUBLE) / {n} ELSE 0.0D END",
                           f"CASE WHEN {s} > 0 THEN 1.0D ELSE 0.0D END",
                           f"CASE WHEN {n} > 0 AND {s} = {n} THEN 1.0D ELSE 0.0D END"))
        else:
            v, parts = f"CAST({q(c)} AS DOUBLE)", [q(f"_{k}{tag}|{c}") for k in "axm"]
            aggs += [F.expr(f"{f}({v}) AS {part}") for f, part in zip(("avg", "max", "min"), parts)]
            finals.append((c, *[f"coalesce({part}, 0.0D)" for part in parts]))
    return aggs, finals


def stat_selects(finals, prefix: str) -> list[str]:
    return [f"{sql} AS {X.ident(f'{prefix}_{c}_{stat}')}" for c, *sqls in finals for stat, sql in zip(STATS, sqls)]


def numeric_stats(child: DataFrame, prefix: str, count_name: str | None = None) -> DataFrame:
    """A1: mean/max/min per policy for every numeric child column (nulls
    skipped; a statistic over no value is 0), in one hash aggregate."""
    value_cols = [c for c in child.columns if c != "policy_id"]
    aggs, finals = stat_aggs(value_cols)
    if count_name:
        aggs.append(F.count(F.lit(1)).alias(count_name))
    g = child.groupBy("policy_id").agg(*aggs)
    return g.selectExpr("policy_id", *stat_selects(finals, prefix), *([count_name] if count_name else []))


def history_features(history: DataFrame, as_of) -> DataFrame:
    """X3 (A3-A7): one row per policy that has incidents."""
    a = X.as_date(as_of)
    t = F.col("incident_type")
    weights = X.lookup(dims.SEVERITY_WEIGHT, F.col("severity"), 0)
    return history.groupBy("policy_id").agg(
        F.count_if(t == "accident").cast("double").alias("accident_count"),
        F.count_if(t == "violation").cast("double").alias("violation_count"),
        F.count_if(t == "claim").cast("double").alias("claim_count"),
        F.count_if(F.col("at_fault")).cast("double").alias("at_fault_count"),
        F.coalesce(F.sum(F.coalesce(F.col("claim_amount"), F.lit(0.0))), F.lit(0.0))
        .cast("double").alias("total_claim_amount"),
        X.whole_years(a, F.max("incident_date")).cast("double").alias("years_since_last_incident"),
        F.sum(weights).cast("double").alias("incident_severity_score"),
    )


HISTORY_DEFAULTS = {"accident_count": 0.0, "violation_count": 0.0, "claim_count": 0.0,
                    "at_fault_count": 0.0, "total_claim_amount": 0.0,
                    "years_since_last_incident": 10.0, "incident_severity_score": 0.0}


def history_with_defaults(policies: DataFrame, history: DataFrame, as_of) -> DataFrame:
    """Every policy gets a history row; no incidents -> (0,0,0,0,0,10,0)."""
    h = history_features(history, as_of)
    joined = policies.select("policy_id").join(h, "policy_id", "left")
    return joined.select("policy_id", *[F.coalesce(F.col(c), F.lit(v)).alias(c)
                                        for c, v in HISTORY_DEFAULTS.items()])


def child_counts(policies: DataFrame, drivers: DataFrame, vehicles: DataFrame,
                 locations: DataFrame) -> DataFrame:
    """A9 + F4 + F5: policy shape."""
    nd = drivers.groupBy("policy_id").agg(F.count(F.lit(1)).alias("num_drivers"))
    nv = vehicles.groupBy("policy_id").agg(F.count(F.lit(1)).alias("num_vehicles"))
    nl = locations.groupBy("policy_id").agg(F.count(F.lit(1)).alias("num_locations"))
    p = (policies.select("policy_id", "effective_date", "expiration_date")
         .join(nd, "policy_id", "left").join(nv, "policy_id", "left").join(nl, "policy_id", "left"))
    n = {c: F.coalesce(F.col(c), F.lit(0)).cast("long") for c in ("num_drivers", "num_vehicles", "num_locations")}
    return p.select(
        "policy_id",
        X.duration_days("effective_date", "expiration_date").alias("policy_duration_days"),
        n["num_drivers"].alias("num_drivers"), n["num_vehicles"].alias("num_vehicles"),
        n["num_locations"].alias("num_locations"),
        X.ratio_at_least_one(n["num_vehicles"], n["num_drivers"]).alias("vehicle_per_driver_ratio"))


# ---- the wide row --------------------------------------------------------------------

# The raw fields of a child and of a policy that the wide row is made of.
FIELDS = {"d": ["date_of_birth", "license_issue_date", "gender", "marital_status", "occupation"],
          "v": ["make", "model", "year", "value", "primary_use", "annual_mileage", "anti_theft_device"],
          "h": ["incident_type", "incident_date", "severity", "claim_amount", "at_fault"], "l": ["state", "zip_code"]}
POLICY_FIELDS = ("policy_id", "effective_date", "expiration_date", "credit_score", "insurance_score")
PREFIX = {"d": "driver", "v": "vehicle", "l": "location"}
COUNTS = {"d": "num_drivers", "v": "num_vehicles", "l": "num_locations"}


def _history_cells(get) -> dict[str, Column]:
    """What the sums of A3-A7 add up for one incident, and its day."""
    def one(test: Column) -> Column:
        return F.coalesce(test.cast("double"), F.lit(0.0))
    kind = get("incident_type")
    return {"accident_count": one(kind == "accident"), "violation_count": one(kind == "violation"), "claim_count": one(kind == "claim"),
            "at_fault_count": one(get("at_fault")), "total_claim_amount": one(get("claim_amount")),
            "incident_severity_score": X.lookup(dims.SEVERITY_WEIGHT, get("severity"), 0), "years_since_last_incident": F.unix_date(get("incident_date"))}


def stack_tables(policies, drivers, vehicles, history, locations) -> DataFrame:
    """The raw fields of all tables as the rows of ``fold``, a policy's together."""
    tables = {"d": drivers, "v": vehicles, "h": history, "l": locations}
    return fold.stacked(policies.select("policy_id", F.struct(*POLICY_FIELDS)),
                        {k: t.select("policy_id", F.struct(*FIELDS[k])) for k, t in tables.items()})


def child_parts(rows: DataFrame, as_of) -> DataFrame:
    """``rows`` with what several features of a child are taken from: ages, the make and model key, territory, age band, vehicle class."""
    a, of = X.as_date(as_of), lambda k: lambda name: F.col(k)[name]
    d, v, loc = of("d"), of("v"), of("l")
    rows = rows.select("*", X.whole_years(a, d("date_of_birth")).alias("_age"), X.whole_years(a, d("license_issue_date")).alias("_years"),
                       X.make_model_key(v("make"), v("model")).alias("_key"), X.territory(loc("zip_code")).alias("_terr"))
    return rows.select("*", X.age_band("_age").alias("_band"), X.vehicle_class("_key").alias("_class"))


def fold_policies(rows: DataFrame, vocab: Vocabulary, as_of, more: dict[str, dict[str, Column]] | None = None,
                  modes: dict[str, tuple[str, list, Column]] | None = None, keep=()) -> DataFrame:
    """The wide row of the policies whose fields ``rows`` has (``stack_tables``, with ``child_parts``).

    ``more``: further columns of a child, by its table; ``modes``: of a table the mode's name, a 0/1 column for each category, and the
    mode as an expression of their sums, by these columns' names; ``keep``: further fields of p, put behind.
    """
    more, modes = more or {}, modes or {}
    col = lambda k: lambda name: F.col(k)[name]
    own = {"driver_age": F.col("_age"), "driver_experience": F.col("_years")}
    cells = {"d": driver_columns(lambda name: own[name] if name in own else F.col("d")[name], vocab, F.col("_band")),
             "v": vehicle_columns(col("v"), vocab, as_of, F.col("_key"), F.col("_class")), "l": location_columns(col("l"), vocab, F.col("_terr"))}
    cells = {k: c | more.get(k, {}) for k, c in cells.items()} | {"h": _history_cells(col("h"))}
    stats = [(f"{p}_{c}_{s}", k, c, s) for k, p in PREFIX.items() for c in cells[k] for s in STATS] + [(n, k, "", "rows") for k, n in COUNTS.items()]
    stats += [(c, "h", c, "last" if c == "years_since_last_incident" else "sum") for c in cells["h"]]
    names = {k: SimpleNamespace(columns=[n for n, at, _, s in stats if at == k and s != "rows"]) for k in PREFIX}
    for k, (name, counts, _) in modes.items():
        cells[k] |= dict(counts)
        stats += [(c, k, c, "sum") for c, _ in counts]
        names[k].columns.append(name)
    p = col("p")
    days = ("effective_date", "expiration_date", "years_since_last_incident")
    wide = fold.fold(rows, cells, stats, {c: F.unix_date(p(c)) if c in days else p(c) for c in POLICY_FIELDS[1:]}, ["policy_id", *keep])
    dates = {c: F.date_from_unix_date(F.col(c).cast("int")) for c in days}
    dates["years_since_last_incident"] = X.whole_years(X.as_date(as_of), dates["years_since_last_incident"]).cast("double")
    wide = wide.withColumns(dates | {name: best for name, _, best in modes.values()})
    return wide.selectExpr("policy_id", *policy_row_sql(names["d"], names["v"], names["l"]), *[X.ident(n) for n in keep])


def policy_features(policies: DataFrame, drivers: DataFrame, vehicles: DataFrame,
                    history: DataFrame, locations: DataFrame, vocab: Vocabulary, as_of) -> DataFrame:
    """The wide per-policy feature row.

    Columns: policy shape, ``driver_*``, ``vehicle_*``, the 7 history
    features, ``location_*``, then credit and insurance scores (absent or 0
    -> 0). Every value is a double except the policy id.
    """
    children = {"driver": driver_features(drivers, vocab, as_of), "vehicle": vehicle_features(vehicles, vocab, as_of), "location": location_features(locations, vocab)}
    j = policies.select("policy_id", "effective_date", "expiration_date", "credit_score", "insurance_score").join(history_features(history, as_of), "policy_id", "left")
    stats, names = [], {}
    for prefix, child in children.items():
        # Sums and counts are joined; the three statistics of each are taken from the joined row.
        aggs, finals = stat_aggs([c for c in child.columns if c != "policy_id"], tag=prefix)
        j = j.join(child.groupBy("policy_id").agg(*aggs, F.count(F.lit(1)).alias(f"num_{prefix}s")), "policy_id", "left")
        stats += stat_selects(finals, prefix)
        names[prefix] = SimpleNamespace(columns=[f"{prefix}_{c}_{stat}" for c, *_ in finals for stat in STATS])
    j = j.selectExpr("policy_id", "effective_date", "expiration_date", "credit_score", "insurance_score", *HISTORY_DEFAULTS, *COUNTS.values(), *stats)
    return j.selectExpr("policy_id", *policy_row_sql(names["driver"], names["vehicle"], names["location"]))


def policy_row_sql(dagg, vagg, lagg, nd="num_drivers", nv="num_vehicles", nl="num_locations") -> list[str]:
    """Final projection of the wide policy row (J7) as SQL text."""
    def num(c):
        return f"CAST(coalesce({c}, 0) AS DOUBLE)"
    out = ["CAST(datediff(expiration_date, effective_date) AS DOUBLE) AS policy_duration_days",
           f"{num(nd)} AS num_drivers", f"{num(nv)} AS num_vehicles", f"{num(nl)} AS num_locations",
           f"{num(nv)} / greatest(1.0D, {num(nd)}) AS vehicle_per_driver_ratio"]
    for agg, cnt in ((dagg, nd), (vagg, nv)):
        for c in agg.columns:
            if c not in ("policy_id", cnt):
                out.append(X.ident(c) if c.endswith("_mode") else f"coalesce({X.ident(c)}, 0.0D) AS {X.ident(c)}")
    out += [f"coalesce({c}, {float(v)!r}D) AS {c}" for c, v in HISTORY_DEFAULTS.items()]
    for c in lagg.columns:
        if c not in ("policy_id", nl):
            out.append(X.ident(c) if c.endswith("_mode") else f"coalesce({X.ident(c)}, 0.0D) AS {X.ident(c)}")
    out += ["coalesce(nullif(credit_score, 0.0D), 0.0D) AS credit_score",
            "coalesce(nullif(insurance_score, 0.0D), 0.0D) AS insurance_score"]
    return out


def feature_names(df: DataFrame) -> list[str]:
    return [c for c in df.columns if c != "policy_id"]


def explode_children(policies_nested: DataFrame) -> DataFrame:
    """Flatten nested children of all policies to (policy_id, kind, n)."""
    kinds = {"driver": "drivers", "vehicle": "vehicles", "history": "driving_history", "location": "locations"}
    out = None
    for kind, col in kinds.items():
        part = (policies_nested.select("policy_id", F.explode(col).alias("child"))
                .select("policy_id", F.lit(kind).alias("kind")))
        out = part if out is None else out.unionByName(part)
    return out
