"""Principal components (X12) by a centred Gram matrix, with the rows' own components.

Each task adds up the outer products of its rows around their own mean, block by block; the
partial matrices (features x features numbers, whatever the rows) are joined
by their means, a matrix row at a time, and the driver takes the eigenvectors of the whole. So the rows are read once. An axis's
sign is fixed: its largest loading is positive, the first of equals. Rows are then projected where they lie.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass
class Components:
    """mean by feature; axes (features x components); variances (sample variance along each axis); total: of all axes."""

    names: list[str]
    mean: np.ndarray
    axes: np.ndarray
    variances: np.ndarray
    total: float

    @property
    def explained(self) -> np.ndarray:
        return self.variances / self.total if self.total else np.zeros(len(self.variances))


def _values(names: list[str]):
    return F.array(*[F.coalesce(F.col(f"`{c}`").cast("double"), F.lit(0.0)) for c in names]).alias("_x")


def _matrix(b: pa.RecordBatch, n: int) -> np.ndarray:
    return b.column("_x").flatten().to_numpy(zero_copy_only=False).reshape(len(b), n)


def _joined(a: tuple, b: tuple, at: int | None = None) -> tuple:
    """(rows, means, outer products around them) of two parts together; ``at``: the products are that row of the matrix alone."""
    n = a[0] + b[0]
    if not a[0] or not b[0]:
        return b if not a[0] else a
    apart = b[1] - a[1]
    own = np.outer(apart, apart) if at is None else apart[at] * apart
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + own * (a[0] * (b[0] / n))


def fit(df: DataFrame, names: list[str], k: int = 20, center: bool = True) -> Components:
    """The ``k`` axes of largest variance of the columns ``names`` (nulls are 0); one pass over the rows."""
    n = len(names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = (0, np.zeros(n), np.zeros((n, n)))
        for b in batches:
            for at in range(0, len(b), 4096):
                x = _matrix(b.slice(at, 4096), n)
                mean = x.mean(0) if center else np.zeros(n)
                x = x - mean
                own = _joined(own, (len(x), mean, x.T @ x))
        if own[0]:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n, dtype=np.int32)), pa.array(np.full(n, own[0])), pa.array([own[1]] * n, pa.list_(pa.float64())),
                                              pa.array(list(own[2]), pa.list_(pa.float64()))], ["i", "n", "mean", "v"])

    def join(parts: pa.Table) -> pa.Table:
        i, own = parts.column("i")[0].as_py(), (0, np.zeros(n), np.zeros(n))
        mean, v = (parts.column(c).combine_chunks().flatten().to_numpy().reshape(-1, n) for c in ("mean", "v"))
        for at, rows in enumerate(parts.column("n").to_pylist()):
            own = _joined(own, (rows, mean[at], v[at]), i)
        return pa.table([pa.array([i], pa.int32()), pa.array([own[0]]), pa.array([own[1]], pa.list_(pa.float64())), pa.array([own[2]], pa.list_(pa.float64()))], ["i", "n", "mean", "v"])

    kinds = "i int, n bigint, mean array<double>, v array<double>"
    count, mean, gram = 0, np.zeros(n), np.zeros((n, n))
    for r in df.select(_values(names)).mapInArrow(run, kinds).groupBy("i").applyInArrow(join, kinds).collect():
        count, mean[r["i"]], gram[r["i"]] = r["n"], r["mean"][r["i"]], r["v"]
    gram = (gram + gram.T) / 2
    values, axes = np.linalg.eigh(gram / max(count - 1, 1))
    order = np.argsort(-values, kind="stable")[:min(k, n)]
    axes = axes[:, order]
    top = np.abs(np.round(axes, 12)).argmax(0)
    axes = axes * np.where(axes[top, np.arange(axes.shape[1])] < 0, -1.0, 1.0)
    return Components(list(names), mean, axes, np.maximum(values[order], 0.0), float(np.maximum(values, 0).sum()))


def transform(df: DataFrame, c: Components, out: str = "pca", keep: list[str] | None = None, lengths: dict[str, Components | None] | None = None) -> DataFrame:
    """``df`` (of it the columns ``keep``; None: all) plus ``out``, the row's components as an array; no shuffle.

    ``lengths``: further columns, by name the squared length of the row's components along other axes of the same features (None: of the centred
    row itself), so that components of which no more is needed do not leave the task.
    """
    src = df.select(*(["*"] if keep is None else keep), _values(c.names))
    lengths = lengths or {}
    schema = T.StructType([*src.schema.fields[:-1], T.StructField(out, T.ArrayType(T.DoubleType())), *[T.StructField(name, T.DoubleType()) for name in lengths]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b, len(c.names)) - c.mean
            y = np.ascontiguousarray(x @ c.axes)
            ends = pa.array(np.arange(len(b) + 1, dtype=np.int32) * y.shape[1], pa.int32())
            more = [x if other is None else (x - (other.mean - c.mean)) @ other.axes for other in lengths.values()]
            yield pa.RecordBatch.from_arrays([*b.columns[:-1], pa.ListArray.from_arrays(ends, pa.array(y.ravel())), *[pa.array((v * v).sum(1)) for v in more]], schema.names)
    return src.mapInArrow(run, schema)
