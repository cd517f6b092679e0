"""Near-duplicate documents by SetSketch registers.

Register i of a set is a truncated, exponentially spaced minimum: with u the
smallest of hash_i over the set's shingles, floor(1 - log_b(-log(1-u)/a)),
kept in 0..q+1. Registers of a union are the larger ones (mergeable); two sets share a
register with a probability that follows their Jaccard similarity J, so runs of ``rows``
registers serve as bands for candidates. For a candidate pair, the counts of
equal, larger and smaller registers and both set sizes give J by maximum
likelihood; pairs that may reach the threshold are verified on the full sets.

Documents with equal sets are one class with one representative, so copies
never form pairs. In a band's bucket every member is held against the
bucket's smallest id, its leader; then, in a leader's group whose members are not yet all
connected, members of different components are held against each other. What shares a bucket and is
linked is therefore always connected, without all pairs of a group of near copies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.llm import rolling
from policylens.llm.components import connected_components
from policylens.llm.text import Scratch, ascii_lower, small, words


@dataclass(frozen=True)
class Sketching:
    """percent: links need 100 * intersection >= percent * union. bands x rows registers: a link at
    the threshold is missed with probability (1 - 0.8^rows)^bands, 1.3e-7 here. base, a, q: the spacing
    of registers (16 bits). slack: standard errors by which an estimate may fall short before verification. shingle: words of a shingle.
    block: members of a leader's group that meet others in one task."""

    percent: int = 80
    bands: int = 40
    rows: int = 5
    base: float = 1.001
    a: float = 20.0
    q: int = 65534
    slack: float = 6.0
    shingle: int = 5
    block: int = 512

    @property
    def m(self) -> int:
        return self.bands * self.rows


def shingles(text: Column, n: int) -> Column:
    """Hashes of the distinct n-word shingles of the lower-cased text; a shorter text is one shingle, a text without words none."""
    w = F.transform(words(ascii_lower(text)), lambda x: F.xxhash64(x))
    # transform over an outer array keeps one evaluation of the words
    return F.transform(F.array(w), lambda h: F.when(F.size(h) == 0, F.array().cast("array<bigint>"))
                       .when(F.size(h) < n, F.array(F.aggregate(h, F.size(h).cast("long"), lambda a, x: F.xxhash64(a, x))))
                       .otherwise(F.array_distinct(F.transform(F.slice(h, F.lit(1), F.size(h) - (n - 1)),
                                                               lambda x, i: F.xxhash64(x, *[F.get(h, i + k) for k in range(1, n)])))))[0]


def constants(m: int) -> tuple[np.ndarray, np.ndarray]:
    """An xor mask and an odd factor of each register's 32-bit hash."""
    seed = rolling.mix(np.arange(1, m + 1, dtype=np.uint64) * rolling.OTHER)
    return (seed & np.uint64(0xFFFFFFFF)).astype(np.uint32), ((seed >> np.uint64(32)) | np.uint64(1)).astype(np.uint32)


def registers(flat: np.ndarray, offsets: np.ndarray, s: Sketching) -> np.ndarray:
    """Registers (documents x m, 16 bits) of non-empty sets given as flat 64-bit hashes."""
    keys = (rolling.mix(flat.view(np.uint64)) >> np.uint64(32)).astype(np.uint32)
    masks, factors = constants(s.m)
    least = np.empty((s.m, len(offsets) - 1), np.uint32)
    for i in range(s.m):
        least[i] = np.minimum.reduceat((keys ^ masks[i]) * factors[i], offsets[:-1])
    u = (least.T.astype(np.float64) + 0.5) / 2.0 ** 32
    spaced = np.floor(1 - np.log(-np.log1p(-u) / s.a) / np.log(s.base))
    return np.clip(spaced, 0, s.q + 1).astype(np.uint16)


def _sketch(s: Sketching):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rolling.pieces(batches, "shingles", 1 << 18):
            flat, offsets = rolling.lists(batch.column("shingles"))
            n = np.diff(offsets)
            full = np.flatnonzero(n)
            regs: list = [None] * len(n)
            d1, d2 = np.zeros(len(n), np.uint64), np.zeros(len(n), np.uint64)
            if len(full):
                at = offsets[:-1][full]
                for k, row in zip(full, registers(flat, np.append(at, len(flat)), s), strict=True):
                    regs[k] = row.astype("<u2").tobytes()
                for d, salt in ((d1, rolling.BASE), (d2, rolling.OTHER)):
                    d[full] = np.add.reduceat(rolling.mix(flat.view(np.uint64) ^ salt), at)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n), pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)), pa.array(regs, pa.binary())],
                                             ["doc_id", "n_shingles", "d1", "d2", "registers"])
    return run


def _slopes(j: np.ndarray, n1, n2, larger, smaller, equal, s: Sketching) -> np.ndarray:
    """Derivative in J of the log-likelihood of the register counts."""
    u, v = n1 / (n1 + n2), n2 / (n1 + n2)
    c, log_b = (s.base - 1) / s.base, np.log(s.base)

    def p(x):
        return -np.log1p(-c * x) / log_b

    def dp(x):
        return c / ((1 - c * x) * log_b)

    x1, x2 = np.maximum(u - v * j, 1e-9), np.maximum(v - u * j, 1e-9)
    same = np.maximum(1 - p(x1) - p(x2), 1e-12)
    return -larger * v * dp(x1) / p(x1) - smaller * u * dp(x2) / p(x2) + equal * (v * dp(x1) + u * dp(x2)) / same


def estimate(n1, n2, r1: np.ndarray, r2: np.ndarray, s: Sketching) -> np.ndarray:
    """Maximum-likelihood J of pairs of sets from their sizes and registers (the likelihood is concave in J)."""
    n1, n2 = np.asarray(n1, float), np.asarray(n2, float)
    larger, smaller = (r1 > r2).sum(1), (r1 < r2).sum(1)
    equal = s.m - larger - smaller
    low, high = np.zeros(len(n1)), np.minimum(n1, n2) / np.maximum(n1, n2)
    for _ in range(30):
        mid = (low + high) / 2
        up = _slopes(mid, n1, n2, larger, smaller, equal, s) > 0
        low, high = np.where(up, mid, low), np.where(up, high, mid)
    return (low + high) / 2


def least_estimate(s: Sketching) -> float:
    """The smallest estimate that calls for verification."""
    t = s.percent / 100
    return t - s.slack * (t * (1 - t) / s.m) ** 0.5


def may_link(n1, n2, r1: np.ndarray, r2: np.ndarray, s: Sketching) -> np.ndarray:
    """Whether the estimate reaches ``least_estimate``: the likelihood, being concave, still rises there."""
    n1, n2 = np.asarray(n1, float), np.asarray(n2, float)
    larger, smaller = (r1 > r2).sum(1), (r1 < r2).sum(1)
    at = np.full(len(n1), least_estimate(s))
    return (np.minimum(n1, n2) >= at * np.maximum(n1, n2)) & (_slopes(at, n1, n2, larger, smaller, s.m - larger - smaller, s) >= 0)


def _likely(s: Sketching):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, len(batch), 4096):
                part = batch.slice(k, 4096)
                r1, r2 = (np.frombuffer(b"".join(part.column(c).to_pylist()), "<u2").reshape(-1, s.m) for c in ("r1", "r2"))
                ok = pa.array(np.flatnonzero(may_link(part.column("n1").to_numpy(), part.column("n2").to_numpy(), r1, r2, s)))
                yield pa.RecordBatch.from_arrays([part.column("a").take(ok), part.column("b").take(ok)], ["a", "b"])
    return run


def _join_components(s: Sketching):
    """A block of a leader's group -> links between its components, one for each two that it joins.

    Every pair of different components is estimated by registers and, where it may be a link, verified on the full sets.
    """
    def run(table: pa.Table) -> pa.Table:
        table = table.take(pa.array(np.argsort(table.column("b").to_numpy(), kind="stable")))
        ids = table.column("b").to_pylist()
        _, at = np.unique(table.column("label").to_numpy(), return_inverse=True)
        regs = np.frombuffer(b"".join(table.column("registers").to_pylist()), "<u2").reshape(-1, s.m)
        flat, offsets = rolling.lists(table.column("set").combine_chunks())
        n = np.diff(offsets)
        out: tuple[list, list] = ([], [])
        group = at.copy()
        ahead = np.ones(len(ids), bool)
        for x in np.argsort(np.bincount(at)[at], kind="stable"):  # members of small components first
            ahead[x] = False
            y = np.flatnonzero(ahead & (group != group[x]) & (100 * np.minimum(n, n[x]) >= s.percent * np.maximum(n, n[x])))
            if len(y):
                y = y[may_link(np.full(len(y), n[x]), n[y], regs[x], regs[y], s)]
            if not len(y):
                continue
            own = np.sort(flat[offsets[x]:offsets[x + 1]])
            every = np.concatenate([flat[offsets[k]:offsets[k + 1]] for k in y])
            hit = own[np.minimum(np.searchsorted(own, every), len(own) - 1)] == every
            shared = np.add.reduceat(hit.astype(np.int64), np.concatenate([[0], np.cumsum(n[y])[:-1]]))
            for k in y[100 * shared >= s.percent * (n[x] + n[y] - shared)]:
                if group[k] != group[x]:
                    out[0].append(min(ids[x], ids[k]))
                    out[1].append(max(ids[x], ids[k]))
                    group[group == group[k]] = group[x]
        return pa.table({"a": pa.array(out[0], pa.int64()), "b": pa.array(out[1], pa.int64())})
    return run


class NearDuplicates:
    """Components of documents linked by shingle similarity.

    Nulls: a null or blank text has no shingles, is linked with nothing and
    is its own component; rows with a null doc_id take no part and have a
    null component and kept = true. Rows that share a doc_id are one node,
    linked if any of their texts is. Repeated rows and copies are one class. An empty table gives no rows.
    """

    def __init__(self, docs: DataFrame, doc_id: Column, text: Column, s: Sketching = Sketching()):
        self.s, self.scratch = s, Scratch(docs.sparkSession, "near")
        put = self.scratch.put
        self.source = docs.select(doc_id.cast("long").alias("doc_id"), text.alias("text"))
        rows = self.source.select("doc_id", shingles(F.col("text"), s.shingle).alias("shingles"))
        self.rows = put(rows.mapInArrow(_sketch(s), "doc_id bigint, n_shingles bigint, d1 bigint, d2 bigint, registers binary"), "sketches")
        named = self.rows.where("doc_id is not null and n_shingles > 0")
        self.classes = put(named.groupBy("n_shingles", "d1", "d2").agg(F.min("doc_id").alias("first")), "classes")
        full = self.rows.select(F.col("doc_id").alias("first"), "n_shingles", "d1", "d2", "registers")
        self.reps = put(full.join(self.classes, ["first", "n_shingles", "d1", "d2"]).select(F.col("first").alias("id"), "n_shingles", "registers"), "reps")
        key = F.transform(F.sequence(F.lit(0), F.lit(s.bands - 1)),
                          lambda k: F.xxhash64(k, F.substr(F.col("registers"), k * (2 * s.rows) + 1, F.lit(2 * s.rows))))
        bands = self.reps.select("id", F.explode(key).alias("key"))
        multi = put(bands.groupBy("key").agg(F.min("id").alias("leader"), F.max("id").alias("last"), F.count(F.lit(1)).alias("n"))
                    .where("leader != last").select("key", "leader", "n"), "buckets")
        members = bands.join(small(multi, multi.count()), "key").where("id != leader")
        pairs = put(members.select(F.col("leader").alias("a"), F.col("id").alias("b")).distinct(), "pairs")
        links = self._verified(pairs)
        labels = connected_components(links)
        late = self._between(pairs, labels)
        if late.limit(1).count():
            labels = connected_components(links.unionAll(late))
        self.labels = labels

    def _sets(self, ids: DataFrame, name: str) -> DataFrame:
        """(id, set) of the given ids; only their texts are read on."""
        texts = self.source.join(small(ids, ids.count()), "doc_id", "left_semi")
        return self.scratch.put(texts.select(F.col("doc_id").alias("id"), shingles(F.col("text"), self.s.shingle).alias("set")), name)

    def _between(self, pairs: DataFrame, labels: DataFrame) -> DataFrame:
        """Links (a, b) that join components whose members share a bucket's leader.

        Members of one bucket share its leader, so all pairs of a bucket that
        the leader does not connect meet in the leader's group. A group is
        taken in blocks of ``block`` members, two at a time, and gives no more links than members.
        """
        s, put = self.s, self.scratch.put
        named = put(pairs.join(labels.withColumnRenamed("id", "b"), "b", "left").select("a", "b", F.coalesce("label", "b").alias("label")), "labelled")
        open_ = put(named.groupBy("a").agg(F.min("label").alias("x"), F.max("label").alias("y"), F.count(F.lit(1)).alias("n"))
                    .where("x != y").select("a", F.ceil(F.col("n") / s.block).cast("int").alias("blocks")), "open")
        named = put(named.join(small(open_, open_.count()), "a"), "open_members")
        sets = self._sets(put(named.select(F.col("b").alias("doc_id")).distinct(), "open_ids"), "open_sets")
        own = F.pmod(F.xxhash64("b"), "blocks").cast("int")
        rows = named.join(sets.withColumnRenamed("id", "b"), "b").join(self.reps.select(F.col("id").alias("b"), "registers", "n_shingles"), "b")
        rows = rows.where(F.size("set") == F.col("n_shingles")).withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = rows.select("a", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "b", "label", "registers", "set")
        return put(rows.groupBy("a", "i", "j").applyInArrow(_join_components(s), "a bigint, b bigint").distinct(), "late_links")

    def _verified(self, pairs: DataFrame) -> DataFrame:
        """The pairs (a, b) whose full sets are similar enough."""
        s, put = self.s, self.scratch.put
        a = self.reps.select(F.col("id").alias("a"), F.col("n_shingles").alias("n1"), F.col("registers").alias("r1"))
        b = self.reps.select(F.col("id").alias("b"), F.col("n_shingles").alias("n2"), F.col("registers").alias("r2"))
        both = pairs.join(a, "a").join(b, "b").where(100 * F.least("n1", "n2") >= s.percent * F.greatest("n1", "n2"))
        likely = put(both.select("a", "b", "n1", "n2", "r1", "r2").mapInArrow(_likely(s), "a bigint, b bigint").distinct(), "likely")
        sets = self._sets(put(likely.select(F.col("a").alias("doc_id")).union(likely.select("b")).distinct(), "ids"), "sets")
        one, two = sets.select(F.col("id").alias("a"), F.col("set").alias("s1")), sets.select(F.col("id").alias("b"), F.col("set").alias("s2"))
        found = likely.join(one, "a").join(two, "b").withColumn("shared", F.size(F.array_intersect("s1", "s2")))
        found = found.where(100 * F.col("shared") >= s.percent * (F.size("s1") + F.size("s2") - F.col("shared"))).select("a", "b").distinct()
        return put(found, "links")

    def result(self) -> DataFrame:
        """doc_id, n_shingles, component_id, kept of every row. Ends the object: its tables are dropped."""
        classes = self.classes.join(self.labels.withColumnRenamed("id", "first"), "first", "left")
        classes = classes.select("n_shingles", "d1", "d2", F.coalesce("label", "first").alias("by_set"))
        named = self.rows.select("doc_id", "n_shingles", "d1", "d2").join(classes, ["n_shingles", "d1", "d2"], "left")
        out = named.select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.coalesce("by_set", "doc_id")).alias("component_id"))
        out = self.scratch.keep(out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True))))
        self.scratch.drop()
        return out


def row_node(docs: DataFrame) -> Column:
    """A row's document: its doc_id (null included) together with its text."""
    return F.xxhash64(docs["doc_id"], docs["doc_id"].isNull(), F.coalesce(docs["text"], F.lit("")))


def one_of_each(docs: DataFrame, s: Sketching = Sketching()) -> DataFrame:
    """The rows of ``docs`` (doc_id, text, ...) that stand for their group, all columns; every text that goes is linked with one that stays.

    A document is a doc_id with a text, so rows that repeat an id with unlike
    texts are judged apart and rows without an id are compared like all
    others. Of a group the document of the smallest doc_id stays (a null
    after all others, then the smaller hash); a text without words is a group of its own. Of rows that agree in id and
    text one stays, the first by a hash of all columns (maps apart). Texts are shuffled only where the
    nodes below outgrow a broadcast, or for repeated rows. An empty table gives no rows.
    """
    node, scratch = row_node(docs), Scratch(docs.sparkSession, "groups")
    found = NearDuplicates(docs, node, docs["text"], s).result()
    nodes = scratch.keep(found.groupBy(F.col("doc_id").alias("_node")).agg(F.min("component_id").alias("c"), F.count(F.lit(1)).alias("n")).where("_node != c or n > 1"))
    far = nodes.where("_node != c").select("_node", "c")
    members = scratch.keep(far.union(far.select(F.col("c").alias("_node"), "c").distinct()))
    ids = docs.select(docs["doc_id"].alias("id"), node.alias("_at")).join(members, F.col("_at") == F.col("_node")).select("c", F.struct(F.col("id").isNull(), "id", "_node").alias("k"))
    stays = scratch.keep(ids.groupBy("c").agg(F.min("k")["_node"].alias("_stays")).select("_stays"))
    goes = scratch.keep(members.join(stays, F.col("_node") == F.col("_stays"), "left_anti").select("_node"))
    out = docs.join(small(goes, goes.count()), node == goes["_node"], "left_anti")
    again = nodes.where("n > 1").select("_node")
    n_again = again.count()
    if not n_again:
        return out
    row = F.struct(*[docs[f"`{c}`"] for c in docs.columns])
    order = F.xxhash64(*[docs[f"`{c}`"] for c, kind in docs.dtypes if "map<" not in kind])
    repeated = out.join(small(again, n_again), node == again["_node"], "left_semi").groupBy(node.alias("_node")).agg(F.min_by(row, order).alias("row")).select("row.*")
    return out.join(small(again, n_again), node == again["_node"], "left_anti").unionAll(repeated)
