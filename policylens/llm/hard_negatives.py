"""Hard negatives by exact integer products: Strassen tiles, then mergeable heaps of positives and of score windows.

Anchors meet candidates shard by shard, in blocks. A task multiplies int64
tiles of anchors and candidates by Strassen's recursion (odd sides padded with
zeros; sums and products are exact integers), and keeps small heaps: the best
same-label rows of each anchor, then, once those are merged over all shards,
the best different-label rows inside each positive's window of scores. Heaps
of different tiles, shards and blocks merge by (score descending, id
ascending), so nothing depends on how rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm.text import Scratch

LEAST = np.iinfo(np.int64).min


@dataclass(frozen=True)
class Mining:
    """positives, negatives: heap sizes. low, high: a negative's score lies between these percentages of the positive's.
    shard_values: components of one shard's matrix. shard_least: rows of a small table's shard. block: anchors of one group.
    tile: rows of a tile (anchors, candidates). leaf: a side at which the recursion multiplies directly."""

    positives: int = 5
    negatives: int = 10
    low: int = 30
    high: int = 90
    shard_values: int = 1 << 22
    shard_least: int = 4096
    block: int = 16384
    tile: tuple[int, int] = (256, 4096)
    leaf: int = 32


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = 32) -> np.ndarray:
    """a @ b in 64-bit integers, by seven products of half-size blocks; odd sides get a row or column of zeros."""
    (m, k), n = a.shape, b.shape[1]
    if min(m, k, n) <= leaf:
        return a @ b
    a, b = np.pad(a, ((0, m % 2), (0, k % 2))), np.pad(b, ((0, k % 2), (0, n % 2)))
    h, i, j = (m + 1) // 2, (k + 1) // 2, (n + 1) // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1, p2 = strassen(a11 + a22, b11 + b22, leaf), strassen(a21 + a22, b11, leaf)
    p3, p4 = strassen(a11, b12 - b22, leaf), strassen(a22, b21 - b11, leaf)
    p5, p6 = strassen(a11 + a12, b22, leaf), strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), np.int64)
    out[:h, :j], out[:h, j:] = p1 + p4 - p5 + p7, p3 + p5
    out[h:, :j], out[h:, j:] = p2 + p4, p1 - p2 + p3 + p6
    return out[:m, :n]


@dataclass
class Heaps:
    """One heap a row: the ``k`` best (score, id) so far, best first; ``ok`` marks filled places."""

    score: np.ndarray
    ids: np.ndarray
    ok: np.ndarray

    @classmethod
    def empty(cls, rows: int, k: int) -> Heaps:
        return cls(np.full((rows, k), LEAST), np.zeros((rows, k), np.int64), np.zeros((rows, k), bool))

    def merge(self, score: np.ndarray, ids: np.ndarray, ok: np.ndarray) -> None:
        """Take in more entries; those of equal score must come with ids no smaller than the ones held, in ascending order."""
        score, ids, ok = np.concatenate([self.score, score], 1), np.concatenate([self.ids, ids], 1), np.concatenate([self.ok, ok], 1)
        best = np.lexsort((~np.where(ok, score, LEAST), ~ok), axis=1)[:, :self.score.shape[1]]
        self.score, self.ids, self.ok = (np.take_along_axis(x, best, 1) for x in (score, ids, ok))

    def entries(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Row numbers, ids and scores of the filled places."""
        row, at = np.nonzero(self.ok)
        return row, self.ids[row, at], self.score[row, at]


def matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """A list column as rows of ``width`` integers, shorter lists padded with zeros."""
    sizes = pc.list_value_length(column).to_numpy()
    out = np.zeros((len(sizes), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = pc.list_flatten(column).to_numpy()
    return out


def _tiles(m: Mining, candidates: pa.Table, anchors: pa.Table) -> Iterator[tuple]:
    """(anchor slice, [(candidate ids, scores, same label)]) with candidates by ascending id; copies are repeated."""
    there, asked = candidates.column("ints"), anchors.column("anchor_ints")
    width = max(pc.max(pc.list_value_length(x)).as_py() for x in (there, asked))
    ids, labels, copies = (candidates.column(c).to_numpy() for c in ("vec_id", "label", "copies"))
    order = np.argsort(ids, kind="stable")
    order = np.repeat(order, copies[order])
    there, asked = matrix(there, width), matrix(asked, width)
    own, own_label = anchors.column("anchor_id").to_numpy(), anchors.column("anchor_label").to_numpy()
    for a in range(0, len(asked), m.tile[0]):
        part = slice(a, a + m.tile[0])

        def scored(part=part):
            for c in range(0, len(order), m.tile[1]):
                at = order[c:c + m.tile[1]]
                yield ids[at], strassen(asked[part], there[at].T, m.leaf), own_label[part][:, None] == labels[at], own[part][:, None] != ids[at]
        yield part, scored()


def _best_positives(m: Mining):
    schema = pa.schema([("akey", pa.int64()), ("anchor_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(candidates) or not len(anchors):
            return schema.empty_table()
        key, own, out = anchors.column("akey").to_numpy(), anchors.column("anchor_id").to_numpy(), []
        for part, tiles in _tiles(m, candidates, anchors):
            heaps = Heaps.empty(len(key[part]), m.positives)
            for ids, score, same, other in tiles:
                ok = same & other
                best = np.argsort(~np.where(ok, score, LEAST), axis=1, kind="stable")[:, :m.positives]
                heaps.merge(*(np.take_along_axis(x, best, 1) for x in (score, np.broadcast_to(ids, score.shape), ok)))
            row, ids, score = heaps.entries()
            out.append((key[part][row], own[part][row], ids, score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)
    return run


def _best_in_windows(m: Mining):
    schema = pa.schema([("akey", pa.int64()), ("place", pa.int32()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(candidates: pa.Table, anchors: pa.Table) -> pa.Table:
        if not len(candidates) or not len(anchors):
            return schema.empty_table()
        key, out = anchors.column("akey").to_numpy(), []
        counts = pc.list_value_length(anchors.column("scores")).to_numpy()
        wanted = matrix(anchors.column("scores"), m.positives)
        for part, tiles in _tiles(m, candidates, anchors):
            p = wanted[part]
            upper, lower = m.high * p // 100, -(-m.low * p // 100)
            heaps = [Heaps.empty(len(p), m.negatives) for _ in range(m.positives)]
            for ids, score, same, _ in tiles:
                order = np.argsort(~np.where(same, LEAST, score), axis=1, kind="stable")
                run_, ok = np.take_along_axis(np.where(same, LEAST, score), order, 1), np.take_along_axis(~same, order, 1)
                for j, heap in enumerate(heaps):
                    at = (run_ > upper[:, j, None]).sum(1)[:, None] + np.arange(m.negatives)
                    inside, at = at < run_.shape[1], np.minimum(at, run_.shape[1] - 1)
                    got = np.take_along_axis(run_, at, 1)
                    good = inside & np.take_along_axis(ok, at, 1) & (got >= lower[:, j, None]) & (j < counts[part])[:, None]
                    heap.merge(got, ids[np.take_along_axis(order, at, 1)], good)
            for j, heap in enumerate(heaps):
                row, ids, score = heap.entries()
                out.append((key[part][row], np.full(len(row), j, np.int32), ids, score))
        return pa.table([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], schema=schema)
    return run


def integers(vector: Column, factor: int) -> Column:
    """Each component x as the integer floor(factor * x), x in double precision."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * factor))


def finite(vector: Column) -> Column:
    """Whether a vector is not null and holds no null or non-finite component."""
    return vector.isNotNull() & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))


def _paired(candidates: DataFrame, anchors: DataFrame, shards: int, blocks: int):
    """Both sides dealt to every (shard, block): a candidate once a block of anchors, an anchor once a shard."""
    left = candidates.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))
    right = anchors.withColumn("shard", F.explode(F.sequence(F.lit(0), F.lit(shards - 1))))
    return left.groupBy("shard", "block").cogroup(right.groupBy("shard", "block"))


def mine(rows: DataFrame, vec_id: Column, vector: Column, label: Column, is_anchor: Column, m: Mining = Mining()) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score: each positive's hardest negatives inside its window.

    Rows with a null id, label or vector, or a null or non-finite component,
    take no part. A row scores floor(256 x) inner products with the anchor;
    higher first, ties by smaller id. Vectors of different lengths count as
    padded with zeros, an empty one as zero; products are 64-bit integers (exact while they fit, then
    modulo 2^64). Rows that repeat are candidates each (of equal rows as many as a heap holds are
    kept), a repeated anchor is answered once, and rows of the anchor's own id are
    never its positives. An anchor without positives, or a positive without a negative in its
    window, gives no row; so does an empty table. Other columns are not read.
    """
    scratch = Scratch(rows.sparkSession, "negatives")
    base = rows.select(vec_id.cast("long").alias("vec_id"), label.cast("long").alias("label"), vector.alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("is_anchor"))
    base = (base.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & finite(F.col("vector")))
            .select("vec_id", "label", "is_anchor", integers(F.col("vector"), 256).alias("ints")))
    base = base.groupBy("vec_id", "label", "ints", "is_anchor").agg(F.least(F.count(F.lit(1)), F.lit(max(m.positives, m.negatives))).cast("int").alias("copies"))
    base = scratch.put(base.withColumn("akey", F.xxhash64("vec_id", "label", "ints")), "rows")
    count, asked, width = base.agg(F.count(F.lit(1)), F.count(F.when(F.col("is_anchor"), 1)), F.max(F.size("ints"))).first()
    size = min(max(m.shard_least, -(-count // 256)), max(1, m.shard_values // max(1, width or 0)))
    shards, blocks = max(1, -(-count // size)), max(1, -(-asked // m.block))
    candidates = base.select(F.pmod("akey", F.lit(shards)).cast("int").alias("shard"), "vec_id", "label", "ints", "copies")
    anchors = base.where("is_anchor").select("akey", F.col("vec_id").alias("anchor_id"), F.col("label").alias("anchor_label"), F.col("ints").alias("anchor_ints"), F.pmod(F.xxhash64("akey"), F.lit(blocks)).cast("int").alias("block"))

    found = _paired(candidates, anchors, shards, blocks).applyInArrow(_best_positives(m), "akey bigint, anchor_id bigint, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("anchor_id", "akey").orderBy(F.desc("score"), "vec_id"))
    positives = scratch.put(found.withColumn("place", rank).where(F.col("place") <= m.positives), "positives")
    scores = positives.groupBy("akey").agg(F.sort_array(F.collect_list(F.struct("place", "score")))["score"].alias("scores"))

    found = _paired(candidates, anchors.join(scores, "akey"), shards, blocks).applyInArrow(_best_in_windows(m), "akey bigint, place int, vec_id bigint, score bigint")
    rank = F.row_number().over(Window.partitionBy("akey", "place").orderBy(F.desc("score"), "vec_id"))
    negatives = (found.withColumn("rank", rank).where(F.col("rank") <= m.negatives)
                 .select("akey", (F.col("place") + 1).alias("place"), "rank", F.col("vec_id").alias("negative_id"), F.col("score").alias("negative_score")))
    pairs = positives.select("akey", "place", "anchor_id", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"))
    out = scratch.keep(negatives.join(pairs, ["akey", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))
    scratch.drop()
    return out
