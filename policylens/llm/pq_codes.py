"""Vector codes by active-entry Lloyd: product quantisation over integers, rounds that look only at what moved.

A row keeps, for each part, its entry and the exact distance to it. After an
update most entries stay where they were. A part whose own entry stayed
fixed compares its stored distance with the moved entries only; a part
whose entry moved scans the whole codebook. Ties go to the lower index in
both cases, so the codes are those of a full scan in every round.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.llm.hard_negatives import finite, integers, matrix
from policylens.llm.text import Scratch


@dataclass(frozen=True)
class Codes:
    """parts: equal pieces of a vector. entries: of each part's codebook. rounds: assignments followed by an update. factor: of the integers."""

    parts: int = 8
    entries: int = 16
    rounds: int = 6
    factor: int = 4096
    batch: int = 8192


def squared(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows (n x d) to entries (e x d)."""
    diff = x[:, None, :] - entries[None, :, :]
    return np.einsum("ned,ned->ne", diff, diff)


def assign(x: np.ndarray, book: np.ndarray, moved: np.ndarray, code: np.ndarray, gap: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """The nearest entry of each row and its distance, from those held (code -1: none yet); and the number of distances computed.

    ``moved`` marks the entries whose values differ from those that ``gap`` was measured on.
    """
    code, gap = code.copy(), gap.copy()
    away = (code < 0) | moved[code]
    whole = squared(x[away], book)
    code[away] = whole.argmin(1)
    gap[away] = whole.min(1, initial=np.iinfo(np.int64).max)
    active, near = np.flatnonzero(moved), np.flatnonzero(~away)
    if len(active) and len(near):
        part = squared(x[near], book[active])
        best = part.argmin(1)
        new, low = active[best], part[np.arange(len(near)), best]
        better = (low < gap[near]) | ((low == gap[near]) & (new < code[near]))
        code[near[better]], gap[near[better]] = new[better], low[better]
    return code, gap, whole.size + len(near) * len(active)


def _round(c: Codes, books: np.ndarray, moved: np.ndarray):
    """Rows with new codes and distances, and, as the last row of a task, its sums and counts by part and entry.

    ``books``: parts x entries x width, ``moved``: parts x entries.
    """
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, scans = np.zeros_like(books), np.zeros((parts, entries), np.int64), 0
        for whole in batches:
            for at in range(0, len(whole), c.batch):
                b = pa.Table.from_batches([whole.slice(at, c.batch)])
                x = matrix(b.column("ints"), parts * width).reshape(len(b), parts, width)
                code, gap = matrix(b.column("code"), parts), matrix(b.column("gap"), parts)
                for p in range(parts):
                    code[:, p], gap[:, p], n = assign(x[:, p], books[p], moved[p], code[:, p], gap[:, p])
                    np.add.at(sums[p], code[:, p], x[:, p])
                    counts[p] += np.bincount(code[:, p], minlength=entries)
                    scans += n
                yield from pa.table({"vec_id": b.column("vec_id"), "label": b.column("label"), "ints": b.column("ints"), "code": pa.array(list(code), pa.list_(pa.int64())),
                                     "gap": pa.array(list(gap), pa.list_(pa.int64())), "sums": pa.nulls(len(b), pa.list_(pa.int64()))}).to_batches()
        told = np.concatenate([sums.ravel(), counts.ravel(), [scans]])
        yield from pa.table({"vec_id": pa.nulls(1, pa.int64()), "label": pa.nulls(1, pa.string()), "ints": pa.nulls(1, pa.list_(pa.int64())), "code": pa.nulls(1, pa.list_(pa.int64())),
                             "gap": pa.nulls(1, pa.list_(pa.int64())), "sums": pa.array([told], pa.list_(pa.int64()))}).to_batches()
    return run


STATE = "vec_id bigint, label string, ints array<bigint>, code array<bigint>, gap array<bigint>, sums array<bigint>"


@dataclass
class Coded:
    """What fitting gives: rows (vec_id, label, code, gap), the final codebooks (parts x entries x width) and the distances computed in each assignment."""

    rows: DataFrame
    books: np.ndarray
    scans: list[int]

    def digest(self) -> str:
        """SHA-256 of all entries' decimal components by part, entry and position, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.books.ravel().tolist())).encode()).hexdigest()


def fit(rows: DataFrame, vec_id: Column, vector: Column, label: Column, c: Codes = Codes()) -> Coded:
    """Codebooks of all rows after ``c.rounds`` rounds, and every row's final codes and distances.

    Rows whose vector is null or holds a null or non-finite component are
    dropped. Vectors count as padded with zeros to the longest length, rounded
    up to a multiple of ``parts``. The first entries are the parts of the
    rows of smallest id (null ids last; of rows with equal ids, by label, null first, and vector); with fewer rows
    than entries there are as many entries. Repeated rows count each. An empty
    table gives no rows and empty codebooks. Sums are 64-bit integers.
    A round is one pass that writes the rows' state; the driver receives sums and counts alone, of fixed size.
    """
    spark = rows.sparkSession
    scratch = Scratch(spark, "codes")
    base = rows.select(vec_id.cast("long").alias("vec_id"), label.cast("string").alias("label"), vector.alias("vector"))
    base = base.where(finite(F.col("vector"))).select("vec_id", "label", integers(F.col("vector"), c.factor).alias("ints"))
    none = F.lit(None).cast("array<bigint>")
    fresh = F.array_repeat(F.lit(-1).cast("long"), c.parts)
    state = scratch.put(base.select("vec_id", "label", "ints", fresh.alias("code"), F.array_repeat(F.lit(0).cast("long"), c.parts).alias("gap"), none.alias("sums")), "start")
    longest = state.agg(F.max(F.size("ints"))).first()[0] or 0
    width = -(-longest // c.parts)
    first = state.orderBy(F.asc_nulls_last("vec_id"), F.asc_nulls_first("label"), "ints").limit(c.entries).select("ints").collect()
    start = np.zeros((len(first), c.parts * width), np.int64)
    for row, got in zip(start, first, strict=True):
        row[:len(got[0])] = got[0]
    books = start.reshape(len(first), c.parts, width).transpose(1, 0, 2).copy()
    moved, scans = np.ones(books.shape[:2], bool), []
    if not len(first):
        return Coded(scratch.keep(state.select("vec_id", "label", "code", "gap")), books, scans)
    for k in range(c.rounds + 1):
        state = scratch.put(state.where("sums IS NULL").mapInArrow(_round(c, books, moved), STATE), f"round-{k}")
        scratch.drop(f"round-{k - 1}" if k else "start")
        told = state.where("sums IS NOT NULL").select(F.posexplode("sums").alias("at", "v")).groupBy("at").agg(F.sum("v")).collect()
        got = np.zeros(books.size + moved.size + 1, np.int64)
        for at, v in told:
            got[at] = v
        scans.append(int(got[-1]))
        if k == c.rounds:
            break
        sums, counts = got[:books.size].reshape(books.shape), got[books.size:-1].reshape(moved.shape)
        new = np.where(counts[:, :, None] > 0, sums // np.maximum(counts, 1)[:, :, None], books)
        moved, books = (new != books).any(2), new
    out = scratch.keep(state.where("sums IS NULL").select("vec_id", "label", "code", "gap"))
    scratch.drop()
    return Coded(out, books, scans)


def digests(coded: Coded) -> DataFrame:
    """vec_id, code (two hex digits a part), error, label_error (errors summed over equal labels, nulls together), codebooks_sha256."""
    error = F.aggregate("gap", F.lit(0).cast("long"), lambda a, x: a + x)
    code = F.array_join(F.transform("code", lambda x: F.lower(F.lpad(F.hex(x), 2, "0"))), "")
    rows = coded.rows.select("vec_id", "label", code.alias("code"), error.alias("error"))
    sums = Scratch(coded.rows.sparkSession, "label-errors")
    total = sums.put(rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "its"), "sums")
    return rows.join(total, F.col("label").eqNullSafe(F.col("its"))).select("vec_id", "code", "error", "label_error", F.lit(coded.digest()).alias("codebooks_sha256"))
