"""Cost-balanced packing of documents into training sequences.

A sequence costs its tokens (linear layers) plus the squares of its pieces'
lengths (attention within a document). Documents are assigned in descending
length, each to the cheapest sequence that still has room for it; one that
fits nowhere whole is cut at the cheapest sequence's room.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PIECES = ("doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, "
          "cost double")


@dataclass(frozen=True)
class Packing:
    """tokenizer: path of the tokenizers file. size: tokens of a sequence. end_id: put after each
    document. linear, quadratic: cost of a token, and of a squared piece length in units of ``size``.
    block_tokens: tokens packed together (the memory bound of a task)."""

    tokenizer: str
    size: int = 2048
    end_id: int = 1
    linear: float = 1.0
    quadratic: float = 1.0
    block_tokens: int = 4_000_000


def capacities(tokens: int, size: int) -> list[int]:
    """Full sequences, and the rest in falling powers of two, which need no padding."""
    rest = tokens % size
    return [size] * (tokens // size) + [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]


def assign(lengths: list[int], plan: Packing) -> list[tuple[int, int, int, int, int]]:
    """(document, start, length, sequence, offset) pieces; every token lies in one piece, every sequence is full."""
    room = np.array(capacities(sum(lengths), plan.size), np.int64)
    used, cost = np.zeros(len(room), np.int64), np.zeros(len(room))
    pieces = []

    def put(doc: int, start: int, length: int, seq: int) -> None:
        pieces.append((doc, start, length, seq, int(used[seq])))
        used[seq] += length
        room[seq] -= length
        cost[seq] += plan.linear * length + plan.quadratic * length * length / plan.size

    rest, free = [], 0
    for doc in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        whole = lengths[doc] // plan.size
        for k in range(whole):  # a stretch of a whole sequence's length is a sequence by itself
            put(doc, k * plan.size, plan.size, free)
            free += 1
        if lengths[doc] % plan.size:
            rest.append((lengths[doc] % plan.size, doc, whole * plan.size))
    for length, doc, start in sorted(rest, key=lambda x: (-x[0], x[1])):
        while length:
            fits = np.where(room >= length, cost, np.inf)
            seq = int(fits.argmin())
            if fits[seq] == np.inf:
                seq = int(np.where(room > 0, cost, np.inf).argmin())
            take = int(min(length, room[seq]))
            put(doc, start, take, seq)
            start, length = start + take, length - take
    return pieces


def _packer(plan: Packing):
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        from policylens.llm.tokens import encoder

        encode = encoder(plan.tokenizer)
        first = TaskContext.get().partitionId() << 40
        ids, docs, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                got = encode(text.as_py() or "")
                got.append(plan.end_id)
                ids.append(np.asarray(got, np.uint32))
                docs.append(doc_id)
                held += len(got)
                if held >= plan.block_tokens:
                    yield from _block(docs, ids, plan, first)
                    first += len(capacities(held, plan.size))
                    ids, docs, held = [], [], 0
        if docs:
            yield from _block(docs, ids, plan, first)
    return pack


def _block(docs: list, ids: list[np.ndarray], plan: Packing, first: int) -> Iterator[pa.RecordBatch]:
    rows = [(docs[d], start, length, zlib.crc32(ids[d][start:start + length].astype("<u4").tobytes()), len(ids[d]), first + seq, offset,
             plan.linear * length + plan.quadratic * length * length / plan.size)
            for d, start, length, seq, offset in assign([len(x) for x in ids], plan)]
    kinds = [pa.int64()] * 7 + [pa.float64()]
    yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                                     ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "cost"])


def pack(docs: DataFrame, doc_id: Column, text: Column, plan: Packing) -> DataFrame:
    """One row per piece (PIECES).

    Each task tokenizes and packs its own documents, in blocks of bounded
    size, without any shuffle; a repeated task makes the same rows, and
    sequence ids carry the partition. No sequence is padded: the last ones of
    a block have lengths that are powers of two. A null or empty text is its
    end token alone; repeated rows are packed each; a null doc_id stays null.
    """
    return docs.select(doc_id.cast("long").alias("doc_id"), text.alias("text")).mapInArrow(_packer(plan), PIECES)
