"""Feature scaling and the saved feature spec.

A fitted scaler is a small set of per-column numbers (one row of
statistics), computed by aggregates over all columns; applying it is
plain column arithmetic. The spec (ordered names, vocabularies, centre and
scale per column) is what a trained model needs to transform new policies
exactly as at fit time.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from policylens.functions.exprs import ident
from policylens.operators.cart import compressed
from policylens.operators.quantiles import BUCKETS, GRID, MARGIN, SKETCH, rank_state, select_rank
from policylens.session import settle


@dataclass
class FeatureSpec:
    """Frozen feature order + per-column centre/scale (+ vocabularies)."""

    names: list[str]
    center: dict[str, float] = field(default_factory=dict)
    scale: dict[str, float] = field(default_factory=dict)
    vocabulary: dict = field(default_factory=dict)
    method: str = "standard"

    def to_json(self) -> str:
        return json.dumps(self.__dict__)

    @classmethod
    def from_json(cls, text: str) -> "FeatureSpec":
        return cls(**json.loads(text))


def _q(c: str):
    return F.col(ident(c))


def _joined(a: tuple, b: tuple) -> tuple:
    """(count, mean, sum of squared deviations) of two parts together; alike values keep a deviation of exactly 0."""
    n = np.maximum(a[0] + b[0], 1)
    apart = np.where(a[0] > 0, b[1] - a[1], 0.0)
    mean = np.where(a[0] > 0, a[1] + apart * (b[0] / n), b[1])
    return a[0] + b[0], np.where(b[0] > 0, mean, a[1]), a[2] + b[2] + np.where(b[0] > 0, apart * apart * (a[0] * (b[0] / n)), 0.0)


def _part(x: np.ndarray, there: np.ndarray | None) -> tuple:
    """Counts, means and squared deviations of the columns of ``x``, measured from each column's first value; ``there``: which cells have one (None: all)."""
    if there is None:
        first, n = x[0], np.full(x.shape[1], len(x))
        away = x - first
    else:
        first, n = x[there.argmax(0), np.arange(x.shape[1])], there.sum(0)
        away = np.where(there, x - first, 0.0)
    shift = away.sum(0) / np.maximum(n, 1)
    rest = away - shift if there is None else np.where(there, away - shift, 0.0)
    return n, first + shift, (rest * rest).sum(0)


def moments(df: DataFrame, cols: list[str]) -> list[tuple[int, float, float]]:
    """Of each column its count, mean and sum of squared deviations, nulls skipped; the rows are read once.

    Tasks reduce their Arrow batches to one number of each kind a column; those parts are joined by column. An aggregate with a buffer
    for every moment of every column costs several times as much for wide rows.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (np.zeros(len(cols), np.int64), np.zeros(len(cols)), np.zeros(len(cols)))
        with np.errstate(all="ignore"):
            for b in batches:
                if len(b):
                    cells = b.column("x").flatten()
                    there = cells.is_valid().to_numpy(zero_copy_only=False).reshape(len(b), -1) if cells.null_count else None
                    own = _joined(own, _part(cells.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(b), -1), there))
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(cols), dtype=np.int32)), *[pa.array(v) for v in own]], ["i", "n", "mean", "m2"])

    def join(parts: pa.Table) -> pa.Table:
        own = (np.zeros(1, np.int64), np.zeros(1), np.zeros(1))
        with np.errstate(all="ignore"):
            for n, mean, m2 in zip(*(parts.column(c).to_numpy() for c in ("n", "mean", "m2")), strict=True):
                own = _joined(own, tuple(np.array([v]) for v in (n, mean, m2)))
        return pa.table([pa.array([parts.column("i")[0].as_py()], pa.int32()), *[pa.array(v) for v in own]], ["i", "n", "mean", "m2"])

    if not cols:
        return []
    kinds = "i int, n bigint, mean double, m2 double"
    parts = df.select(F.array(*[_q(c).cast("double") for c in cols]).alias("x")).mapInArrow(run, kinds).where("n > 0")
    found = {r["i"]: (r["n"], r["mean"], r["m2"]) for r in parts.groupBy("i").applyInArrow(join, kinds).collect()}
    return [found.get(i, (0, 0.0, 0.0)) for i in range(len(cols))]


def fit_standard(df: DataFrame, cols: list[str]) -> FeatureSpec:
    """X10 fit: mean and population std per column in one pass; std 0 -> 1."""
    center, scale = {}, {}
    for c, (n, mean, m2) in zip(cols, moments(df, cols), strict=True):
        center[c], scale[c] = float(mean), (math.sqrt(m2 / n) if n else 0.0) or 1.0
    return FeatureSpec(names=list(cols), center=center, scale=scale, method="standard")


def _sql_double(x: float) -> str:
    return f"double('{x}')" if x != x or x in (float("inf"), float("-inf")) else f"{x!r}D"


def _bracket(n: int, grid, low: float, high: float, first: int, last: int) -> tuple[float, float]:
    """Values around the ranks first to last, from the sketch's grid (``quantiles.bracket`` on the driver's few numbers)."""
    if not n:
        return low, high
    below, above = (first - 2) / n - MARGIN, (last + 3) / n + MARGIN
    return (low if below <= 0 else grid[min(math.floor(below * GRID), GRID)]), (high if above >= 1 else grid[math.ceil(above * GRID)])


def _columns(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(F.array(*[_q(c).cast("double") for c in cols]).alias("x"))


def _sorted_columns(b: pa.RecordBatch) -> Iterator[np.ndarray]:
    """The values of each column in order, nulls left out, NaN last."""
    cells = b.column("x").flatten()
    x = cells.fill_null(0.0).to_numpy(zero_copy_only=False).reshape(len(b), -1)
    there = cells.is_valid().to_numpy(zero_copy_only=False).reshape(len(b), -1) if cells.null_count else None
    for i in range(x.shape[1]):
        yield np.sort(x[:, i] if there is None else x[there[:, i], i]) + 0.0  # no negative zero


def _runs(v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different values of an ordered array, NaN as one, and how often each occurs."""
    at = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) & ~np.isnan(v[:-1])])) if len(v) else np.zeros(0, int)
    return v[at], np.diff(np.append(at, len(v)))


def _outlines(df: DataFrame, cols: list[str]) -> dict[int, tuple]:
    """By column with values: their number, least, largest, how many are numbers, and the values at GRID + 1 evenly spaced ranks of these, by a summary."""
    most, held_at_once = 2 * SKETCH, 16
    kinds = "i int, n bigint, a double, b double, v array<double>, c array<double>"
    schema = pa.schema([("i", pa.int32()), ("n", pa.int64()), ("a", pa.float64()), ("b", pa.float64()), ("v", pa.list_(pa.float64())), ("c", pa.list_(pa.float64()))])

    def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
        return compressed(np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts]), most)[:2]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, low, high, held = [0] * len(cols), [math.nan] * len(cols), [-math.inf] * len(cols), [[] for _ in cols]
        for b in batches:
            if not len(b):
                continue
            for i, v in enumerate(_sorted_columns(b)):
                if len(v):
                    n[i], low[i], high[i] = n[i] + len(v), np.fmin(low[i], v[0]), np.maximum(high[i], v[-1])
                    held[i].append(_runs(v[:np.searchsorted(v, math.nan)]))
                    if len(held[i]) >= held_at_once:
                        held[i] = [merged(held[i])]
        rows = [(i, n[i], low[i], high[i], *merged(held[i])) for i in range(len(cols)) if n[i]]
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)] if rows else [pa.array([], f.type) for f in schema], schema=schema)

    def join(parts: pa.Table) -> pa.Table:
        v, c = merged([(np.array(v, float), np.array(c, float)) for v, c in zip(parts.column("v").to_pylist(), parts.column("c").to_pylist(), strict=True)])
        low, high = np.fmin.reduce(parts.column("a").to_numpy()), np.maximum.reduce(parts.column("b").to_numpy())
        upto = np.cumsum(c)
        grid = v[np.minimum(np.searchsorted(upto, np.arange(GRID + 1) / GRID * upto[-1] * (1 - 1e-12)), len(v) - 1)] if len(v) else v
        return pa.table([pa.array([x], f.type) for x, f in zip((parts.column("i")[0].as_py(), sum(parts.column("n").to_pylist()), low, high, grid, [c.sum()]), schema)], schema=schema)

    found = _columns(df, cols).mapInArrow(run, kinds).groupBy("i").applyInArrow(join, kinds).collect()
    return {r["i"]: (r["n"], r["a"], r["b"], int(r["c"][0]), r["v"]) for r in found}


def _bracket_counts(df: DataFrame, cols: list[str], at: list[tuple[int, float, float]]) -> DataFrame:
    """Written counts of the values in and below each bracket (column, low, high), by its place ``s``, as ``quantiles.counted`` gives them."""
    by_column: dict[int, list[tuple[int, float, float]]] = {}
    for s, (i, low, high) in enumerate(at):
        by_column.setdefault(i, []).append((s, low, high))
    used = sorted(by_column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not len(b):
                continue
            place, value, count, null = [], [], [], []
            for i, v in zip(used, _sorted_columns(b), strict=True):
                for s, low, high in by_column[i]:
                    below, upto = np.searchsorted(v, low), np.searchsorted(v, high, "right")
                    inside, times = _runs(v[below:upto])
                    if below:
                        inside, times = np.append(inside, 0.0), np.append(times, below)
                    null.append(np.arange(len(inside)) == len(inside) - 1 if below else np.zeros(len(inside), bool))
                    place.append(np.full(len(inside), s, np.int32))
                    value.append(inside)
                    count.append(times)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(place)), pa.array(np.concatenate(value), mask=np.concatenate(null)), pa.array(np.concatenate(count).astype(np.int64))], ["s", "_v", "_c"])

    parts = _columns(df, [cols[i] for i in used]).mapInArrow(run, "s int, _v double, _c bigint")
    return settle(parts.groupBy("s", "_v").agg(F.sum("_c").alias("_c")), "brackets")


def wide_percentiles(df: DataFrame, cols: list[str], probs: list[float], buckets: int = BUCKETS) -> dict[str, list[float]]:
    """Exact percentiles (linear interpolation) of many columns of a wide table; a column without values has none.

    The rows are read twice, as ``quantiles`` explains: once for every column's count, ends and summary, and
    once for the counts in and below the brackets around the ranks. Both times tasks sort the columns of their Arrow batches; an aggregate with a
    sketch a column, and a row for each cell in a bracket, cost several times as much. Should a bracket miss its rank, a third read takes that
    column's whole range. The driver holds a grid for each column, and no more than two ranks for each column and percentile.
    """
    spark = df.sparkSession
    seen = _outlines(df, cols)
    # bracket (column, low, high) -> ranks; columns of few values share a bracket among their percentiles
    asked: dict[tuple[int, float, float], set[int]] = {}
    for i, (n, a, b, m, grid) in seen.items():
        for p in probs:
            first, last = math.floor(p * (n - 1)), math.ceil(p * (n - 1))
            asked.setdefault((i, *_bracket(m, grid, a, b, first, last)), set()).update((first, last))
    value: dict[tuple[int, int], float] = {}
    while asked:
        at = list(asked)
        counts = _bracket_counts(df, cols, at)
        ranks = spark.createDataFrame([(s, k) for s, key in enumerate(at) for k in sorted(asked[key])], "s int, k long")
        state = settle(rank_state(counts, ranks, ["s"]), "held")
        found = select_rank(counts, state.where("_held"), ["s", "k"], buckets, on=["s"])
        value.update({(at[r["s"]][0], r["k"]): r["value"] for r in found.collect()})
        asked = {}
        for r in state.where("NOT _held").collect():
            i = at[r["s"]][0]
            asked.setdefault((i, *seen[i][1:3]), set()).add(r["k"])
    out = {}
    for i, (n, *_) in seen.items():
        places = [p * (n - 1) for p in probs]
        ends = [(value[i, math.floor(x)], value[i, math.ceil(x)], x - math.floor(x)) for x in places]
        out[cols[i]] = [low if low == high else low + share * (high - low) for low, high, share in ends]
    return out


def fit_robust(df: DataFrame, cols: list[str]) -> FeatureSpec:
    """X11 fit: median and IQR per column (exact, linear interpolation); IQR 0 -> 1. The rows are read twice."""
    stats = wide_percentiles(df, cols, [0.25, 0.5, 0.75])
    center, scale = {}, {}
    for c in cols:
        q1, center[c], q3 = stats.get(c, (0.0, 0.0, 0.0))
        scale[c] = q3 - q1 if q3 != q1 else 1.0
    return FeatureSpec(names=list(cols), center=center, scale=scale, method="robust")


def align(df: DataFrame, names: list[str], keep=("policy_id",)) -> DataFrame:
    """Project to the frozen feature order; missing columns -> 0."""
    have = set(df.columns)
    cols = [F.col(k) for k in keep if k in have]
    cols += [(_q(c).cast("double") if c in have else F.lit(0.0)).alias(c) for c in names]
    return df.select(*cols)


def transform(df: DataFrame, spec: FeatureSpec, keep=("policy_id",)) -> DataFrame:
    """Apply a fitted spec: align, then (x - centre) / scale per column."""
    a = align(df, spec.names, keep)
    out = [F.col(k) for k in keep if k in a.columns]
    out += [((_q(c) - F.lit(spec.center[c])) / F.lit(spec.scale[c])).alias(c) for c in spec.names]
    return a.select(*out)


def _narrow(df: DataFrame, cols: list[str], keep) -> DataFrame:
    """The rows to scale, written once, so that fitting and scaling do not compute the features again."""
    return settle(df.select(*[k for k in keep if k in df.columns], *[_q(c) for c in cols]), "features")


def standard_scale(df: DataFrame, cols: list[str], keep=("policy_id",)) -> DataFrame:
    rows = _narrow(df, cols, keep)
    return transform(rows, fit_standard(rows, cols), keep)


def robust_scale(df: DataFrame, cols: list[str], keep=("policy_id",)) -> DataFrame:
    rows = _narrow(df, cols, keep)
    return transform(rows, fit_robust(rows, cols), keep)


class _Scaled(HasInputCols, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    """What the scaler and its fitted model share: the feature columns and the vector column."""


class FeatureScaler(Estimator, _Scaled):
    """X13 as an ML estimator: fits a ``FeatureSpec`` on ``inputCols``, for use in a ``Pipeline``.

    method: "standard" or "robust". vocabulary: JSON of the encoders' categories, kept in the spec.
    """

    method = Param(Params._dummy(), "method", "standard or robust", TypeConverters.toString)
    vocabulary = Param(Params._dummy(), "vocabulary", "JSON of the encoders' categories", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", method="standard", vocabulary="{}"):
        super().__init__()
        self._setDefault(outputCol="features", method="standard", vocabulary="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "FeatureScalerModel":
        method = self.getOrDefault(self.method)
        if method not in ("standard", "robust"):
            raise ValueError(f"unknown scaling method: {method}")
        spec = (fit_robust if method == "robust" else fit_standard)(dataset, self.getInputCols())
        spec.vocabulary = json.loads(self.getOrDefault(self.vocabulary))
        return FeatureScalerModel(inputCols=self.getInputCols(), outputCol=self.getOutputCol(), spec=spec.to_json())


class FeatureScalerModel(Model, _Scaled):
    """A fitted spec as an ML model: adds the scaled features as a vector, in the frozen order.

    A column that the rows lack counts as 0 (P1), a null value is NaN in the vector.
    """

    spec = Param(Params._dummy(), "spec", "JSON of the fitted FeatureSpec", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, outputCol="features", spec="{}"):
        super().__init__()
        self._setDefault(outputCol="features")
        self._set(**self._input_kwargs)

    @property
    def feature_spec(self) -> FeatureSpec:
        return FeatureSpec.from_json(self.getOrDefault(self.spec))

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn(self.getOutputCol(), array_to_vector(scaled_array(dataset.columns, self.feature_spec)))


def scaled_array(have, spec: FeatureSpec):
    """The scaled features of a row with the columns ``have``, as an array in the frozen order; a null value is NaN in it."""
    have = set(have)
    return F.expr("array(" + ", ".join("coalesce(({} - {}) / {}, double('NaN'))".format(
        f"CAST({ident(c)} AS DOUBLE)" if c in have else "0.0D", _sql_double(spec.center[c]), _sql_double(spec.scale[c])) for c in spec.names) + ")")


def assemble(df: DataFrame, names: list[str], out: str = "features", vector: bool = True) -> DataFrame:
    """Feature vector in spec order for ``pyspark.ml`` (X13), or an array of the same values; a null value is NaN in it."""
    cells = ", ".join(f"coalesce(CAST({ident(c)} AS DOUBLE), double('NaN'))" for c in names)
    cells = F.expr(f"array({cells})")
    return df.withColumn(out, array_to_vector(cells) if vector else cells)
