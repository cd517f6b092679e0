"""Hashes of word windows over many documents at once (numpy, 64-bit arithmetic that wraps)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Odd bases of the polynomial hashes, and constants of the finishing mix.
BASE, OTHER = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    out = np.empty(max(n, 1), np.uint64)
    out[0] = 1
    if n > 1:
        out[1:] = base
        np.multiply.accumulate(out, out=out)
    return out[:n]


def lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """Flat values and n + 1 offsets of a column of lists without nulls inside."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    offsets = column.offsets.to_numpy(zero_copy_only=False).astype(np.int64)
    flat = column.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]
    return flat, offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 18) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most ``most`` list items (one row at least), so that a batch of long texts stays small."""
    for batch in batches:
        sizes = np.diff(batch.column(column).offsets.to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < len(sizes):
            fits = int(np.searchsorted(np.cumsum(sizes[at:]), most, side="right"))
            yield batch.slice(at, max(1, fits))
            at += max(1, fits)


def windows(ids: np.ndarray, width: int) -> np.ndarray:
    """Hash of each ``width`` consecutive ids of the flat array, document ends ignored: len - width + 1 values.

    Horner's rule over doubling widths: windows of 1, 2, 4, ... ids are
    joined to the wanted width, so each value depends on its own ids alone.
    """
    n = len(ids) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    part, size = mix(ids.astype(np.uint64) + BASE), 1
    out, done, k = None, 0, width
    power = BASE
    while k:
        if k & 1:
            piece = part[done:]
            out = piece if out is None else out[:len(piece)] * power + piece
            done += size
        k >>= 1
        if k:
            part = part[:-size] * power + part[size:]
            size *= 2
            power = np.uint64(int(power) ** 2 & (1 << 64) - 1)
    return mix(out[:n])


def sequence_digests(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each document's whole id sequence."""
    at = np.arange(len(ids)) - np.repeat(offsets[:-1], np.diff(offsets))
    longest = int(np.diff(offsets).max()) if len(offsets) > 1 else 0
    out = []
    for base in (BASE, OTHER):
        sums = np.concatenate([[np.uint64(0)], np.cumsum(mix(ids.astype(np.uint64) + base) * powers(base, longest)[at], dtype=np.uint64)])
        out.append(mix(sums[offsets[1:]] - sums[offsets[:-1]] + np.diff(offsets).astype(np.uint64)))
    return out[0], out[1]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the smallest value (the first of ties) in each window of ``width`` values."""
    n = len(values) - width + 1
    if n <= 0:
        return np.empty(0, np.int64)
    at, size = np.arange(len(values), dtype=np.int64), 1
    while size * 2 <= width:
        left, right = at[:-size], at[size:]
        at = np.where(values[right] < values[left], right, left)
        size *= 2
    left, right = at[:n], at[width - size:width - size + n]
    return np.where(values[right] < values[left], right, left)
