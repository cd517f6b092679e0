"""Substring de-duplication: find every passage that recurs, and remove it.

A window is ``width`` consecutive words of one document; a word goes if some
window over it also starts elsewhere. Each window has a canonical phrase, the
``phrase`` words in it whose hash is smallest, which depends on the window's
words alone, so equal windows have equal phrases. The steps:

1. Phrases: every document lists the canonical phrases of its windows (about
   one for twelve words). Documents with the same words are one class.
2. Phrases that occur twice or more among classes are counted by a partial
   aggregate; only windows around those can recur.
3. Confirmation: those windows are counted by hash, again by a partial
   aggregate, so a passage of a third of all documents is no hot task.
4. Automata: the stretches of words around recurring phrases are dealt to
   shards by phrase (a hot phrase to several shards, by document and place); a shard
   compiles its confirmed passages into an Aho-Corasick automaton over word
   symbols and streams all its stretches through it; an occurrence counts if
   the 64-bit hash of the window at its place is a confirmed one.

Word ids are 64-bit hashes, and phrases, windows and whole texts are hashed
from them; the automaton's symbols are their low 32 bits. No text takes part
in a shuffle except those of documents that hold a recurring phrase.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from policylens.llm import rolling
from policylens.llm.text import BROADCAST_ROWS, Scratch, small, text_key, words

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@dataclass(frozen=True)
class Passages:
    """width: words of a window. phrase: words of a canonical phrase. shard: stretches of one automaton's shard."""

    width: int = 35
    phrase: int = 12
    shard: int = 2048


def word_ids(text: Column) -> Column:
    return _hashed(words(text))


def _hashed(w: Column | str) -> Column:
    return F.transform(w, lambda x: F.xxhash64(x))


def _canonical(ids: np.ndarray, offsets: np.ndarray, p: Passages) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window starts, place of each window's canonical phrase, all phrase hashes) over the flat ids."""
    phrases = rolling.windows(ids, p.phrase)
    at = rolling.sliding_argmin(phrases, p.width - p.phrase + 1)
    whole = np.zeros(len(ids) + 1, bool)
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        whole[a:max(a, b - p.width + 1)] = True
    starts = np.flatnonzero(whole[:len(at)])
    return starts, at[starts], phrases


def _phrases(p: Passages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rolling.pieces(batches, "ids"):
            ids, offsets = rolling.lists(batch.column("ids"))
            d1, d2 = rolling.sequence_digests(ids, offsets)
            _, at, phrases = _canonical(ids, offsets, p)
            at = np.unique(at)
            cuts = np.searchsorted(at, offsets)
            doc = np.repeat(np.arange(len(offsets) - 1), np.diff(cuts))
            kinds = pa.array(cuts, pa.int32())
            keep = [batch.column(n) for n in ("rid", "doc_id", "tkey", "n_words", "full_sha256")]
            yield pa.RecordBatch.from_arrays(
                [*keep, pa.array(d1.view(np.int64)), pa.array(d2.view(np.int64)),
                 pa.ListArray.from_arrays(kinds, pa.array(phrases[at].view(np.int64))),
                 pa.ListArray.from_arrays(kinds, pa.array((at - offsets[doc]).astype(np.int32)))],
                ["rid", "doc_id", "tkey", "n_words", "full_sha256", "d1", "d2", "phrases", "places"])
    return run


#: rid names a row; d1, d2 its whole word sequence.
PHRASES = "rid bigint, doc_id bigint, tkey bigint, n_words bigint, full_sha256 string, d1 bigint, d2 bigint, phrases array<bigint>, places array<int>"


def phrase_table(docs: DataFrame, doc_id: Column, text: Column, p: Passages) -> DataFrame:
    rows = docs.select(doc_id.cast("long").alias("doc_id"), text_key(text).alias("tkey"), words(text).alias("w"))
    rows = rows.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "tkey", F.size("w").cast("long").alias("n_words"),
                       F.sha2(F.array_join("w", " "), 256).alias("full_sha256"), _hashed("w").alias("ids"))
    return rows.mapInArrow(_phrases(p), PHRASES)


def _stretches(batch: pa.RecordBatch, p: Passages):
    """Of a batch of (rid, ids, places, phrases, spread): each recurring phrase's place with the windows that it stands for.

    Yields (row, place in the flat ids, first window, last window, phrase, spread, offsets, ids)."""
    ids, offsets = rolling.lists(batch.column("ids"))
    places, cuts = rolling.lists(batch.column("places"))
    phrases, _ = rolling.lists(batch.column("phrases"))
    spread, _ = rolling.lists(batch.column("spread"))
    starts, at, _ = _canonical(ids, offsets, p)
    row = np.repeat(np.arange(len(cuts) - 1), np.diff(cuts))
    place = places.astype(np.int64) + offsets[row]
    order = np.argsort(place, kind="stable")
    # windows of one canonical place are consecutive, as the place of the smallest never moves back
    first, last = np.searchsorted(at, place[order]), np.searchsorted(at, place[order], side="right") - 1
    return row[order], starts[first], starts[last], phrases[order], spread[order], offsets, ids


def _parts(rid: np.ndarray, start: np.ndarray, spread: np.ndarray) -> np.ndarray:
    """The part of its phrase's shard, 0 to spread - 1, to which a stretch is dealt."""
    mixed = rolling.mix(rid.astype(np.uint64) * rolling.BASE + start.astype(np.uint64) * rolling.OTHER)
    return (mixed % spread.astype(np.uint64)).astype(np.int32)


def _window_rows(p: Passages):
    """Each window of each stretch, with the stretch's part."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rolling.pieces(batches, "ids"):
            row, first, last, phrase, spread, offsets, ids = _stretches(batch, p)
            part = _parts(batch.column("rid").to_numpy()[row], first - offsets[row], spread)
            hashes = rolling.windows(ids, p.width)
            n = last - first + 1
            cuts = np.concatenate([[0], np.cumsum(n)])
            take = np.arange(cuts[-1]) - np.repeat(cuts[:-1], n) + np.repeat(first, n)
            for a in range(0, len(take), 1 << 20):
                z = slice(a, a + (1 << 20))
                which = np.repeat(np.arange(len(n)), n)[z]
                yield pa.RecordBatch.from_arrays([pa.array(hashes[take[z]].view(np.int64)), pa.array(phrase[which]), pa.array(spread[which]), pa.array(part[which])],
                                                 ["window", "phrase", "spread", "part"])
    return run


def _stretch_rows(p: Passages):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rolling.pieces(batches, "ids"):
            row, first, last, phrase, spread, offsets, ids = _stretches(batch, p)
            rid, hashes = batch.column("rid").to_numpy(), rolling.windows(ids, p.width).astype("<u8")
            symbols, part = ids.astype("<u8").astype("<u4"), _parts(rid[row], first - offsets[row], spread)
            for a in range(0, len(first), 1 << 14):
                z = slice(a, a + (1 << 14))
                ends = list(zip(first[z].tolist(), last[z].tolist(), strict=True))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rid[row[z]]), pa.array((first - offsets[row])[z].astype(np.int32)), pa.array(phrase[z]), pa.array(spread[z]), pa.array(part[z]),
                     pa.array([symbols[x:y + p.width].tobytes() for x, y in ends], pa.binary()),
                     pa.array([hashes[x:y + 1].tobytes() for x, y in ends], pa.binary())],
                    ["rid", "start", "phrase", "spread", "part", "symbols", "windows"])
    return run


def _locate(p: Passages):
    """One shard: its stretches and the hashes of its confirmed windows -> where confirmed windows occur, as word spans."""
    def run(stretches: pa.Table, confirmed: pa.Table) -> pa.Table:
        import ahocorasick

        schema = pa.schema([("rid", pa.int64()), ("from_word", pa.int64()), ("to_word", pa.int64())])
        if not len(stretches) or not len(confirmed):
            return schema.empty_table()
        known = np.unique(confirmed.column("window").to_numpy())
        data = [np.frombuffer(x, "<u4").tolist() for x in stretches.column("symbols").to_pylist()]
        windows = stretches.column("windows").to_pylist()
        offsets = np.concatenate([[0], np.cumsum([len(x) // 8 for x in windows])])
        hashes = np.frombuffer(b"".join(windows), "<i8")
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        hit = known[at] == hashes
        automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        added = set()
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            own = np.flatnonzero(hit[a:b])
            if len(own):
                # the ends of each run of recurring windows; those between lie under them, as a stretch is short
                ends = own[np.concatenate([[True], np.diff(own) > 1]) | np.concatenate([np.diff(own) > 1, [True]])]
                for s in ends.tolist():
                    if (h := int(hashes[a + s])) not in added:
                        added.add(h)
                        automaton.add_word(tuple(data[k][s:s + p.width]), True)
        if not added:
            return schema.empty_table()
        automaton.make_automaton()
        rid, first = stretches.column("rid").to_pylist(), stretches.column("start").to_pylist()
        out: tuple[list, list, list] = ([], [], [])
        for k, a in enumerate(offsets[:-1].tolist()):
            low = high = -1
            for end, _ in automaton.iter(tuple(data[k])):
                if not hit[a + end + 1 - p.width]:  # equal symbols of other words
                    continue
                if high < end + 1 - p.width:
                    if low >= 0:
                        for o, v in zip(out, (rid[k], first[k] + low, first[k] + high), strict=True):
                            o.append(v)
                    low = end + 1 - p.width
                high = end + 1
            if low >= 0:
                for o, v in zip(out, (rid[k], first[k] + low, first[k] + high), strict=True):
                    o.append(v)
        return pa.table([pa.array(o, pa.int64()) for o in out], schema=schema)
    return run


def _merged(spans: pa.ListScalar) -> list[tuple[int, int]]:
    """The spans of one text, joined where they meet."""
    low, high = (spans.values.field(k).to_numpy() for k in ("from_word", "to_word"))
    order = np.argsort(low, kind="stable")
    low, high = low[order], np.maximum.accumulate(high[order])
    new = np.concatenate([[True], low[1:] > high[:-1]])
    return list(zip(low[new].tolist(), high[np.concatenate([new[1:], [True]])].tolist(), strict=True))


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(rid, text, spans) -> what is left of the text."""
    for batch in batches:
        rows = []
        for rid, text, spans in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2), strict=True):
            found, at, kept, gone = WORD.findall(text.as_py() or ""), 0, [], 0
            for a, b in _merged(spans):
                kept += found[at:a]
                gone += b - a
                at = b
            left = " ".join(kept + found[at:])
            rows.append((rid, gone, hashlib.sha256(left.encode()).hexdigest(), left))
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 4,
                                         (pa.int64(), pa.int64(), pa.string(), pa.string()), strict=True)], ["rid", "gone", "sha256", "left_text"])


class Repeats:
    """The passages that recur in ``docs``, found once; then read as digests or as cleaned rows
    (either ends the object: its tables are dropped).

    Rows are told apart by doc_id and text. A null or short text (under
    ``width`` words) keeps everything; a text that another row repeats wholly
    loses everything, as does a row that is there twice; a null doc_id is an
    id like any other; an empty table gives no rows. Texts are whole, however long: a long one's stretches are
    dealt to many groups. Of overlapping passages each word counts once; no tie decides anything, as windows are judged
    by their words alone. Columns other than the id and the text are not read, and ``cleaned`` returns them as they are.
    """

    def __init__(self, docs: DataFrame, doc_id: Column, text: Column, p: Passages = Passages()):
        spark = docs.sparkSession
        self.p, self.scratch = p, Scratch(spark, "passages")
        put = self.scratch.put
        table = put(phrase_table(docs, doc_id, text, p), "phrases")
        long = table.where(F.col("n_words") >= p.width)
        classes = long.groupBy("n_words", "d1", "d2").agg(F.min("rid").alias("rid"), F.count(F.lit(1)).alias("copies")).select("rid", "copies")
        classes = put(classes, "classes")
        # copies: of the class that a row stands for; null: another row stands for this one
        self.table = put(table.join(classes, "rid", "left").drop("d1", "d2"), "rows")
        first = self.table.where("copies is not null")
        each = first.select("rid", F.explode(F.arrays_zip("phrases", "places")).alias("x")).select("rid", "x.phrases", "x.places").toDF("rid", "phrase", "place")
        recurring = put(each.groupBy("phrase").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                        .select("phrase", F.ceil(F.col("n") / p.shard).cast("int").alias("spread")), "recurring")
        n = recurring.count()
        each = each.join(small(recurring, n), "phrase")
        listed = each.groupBy("rid").agg(F.collect_list(F.struct("place", "phrase", "spread")).alias("x"))
        listed = put(first.select("rid", "doc_id", "tkey").join(listed, "rid")
                     .select("rid", "doc_id", "tkey", F.col("x.place").alias("places"), F.col("x.phrase").alias("phrases"), F.col("x.spread").alias("spread")), "listed")
        size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.size("places")), F.lit(0))).first()
        rows = docs.select(doc_id.cast("long").alias("doc_id"), text_key(text).alias("tkey"), text.alias("text"))
        ids = listed.select("doc_id", "tkey")
        if size[0] <= 2 * 500_000:  # two numbers a row
            few = F.broadcast(ids)
            rows = rows.join(few, (rows["doc_id"].eqNullSafe(few["doc_id"])) & (rows["tkey"] == few["tkey"]), "left_semi")
        joined = rows.join(listed, rows["doc_id"].eqNullSafe(listed["doc_id"]) & (rows["tkey"] == listed["tkey"]))
        self.some = put(joined.select("rid", "text", "places", "phrases", "spread"), "some")
        source = self.some.select("rid", word_ids(F.col("text")).alias("ids"), "places", "phrases", "spread")
        shards = max(1, -(-size[1] // p.shard))
        shard = F.when(F.col("spread") > 1, -1 - F.pmod("phrase", F.lit(1 << 40))).otherwise(F.pmod("phrase", F.lit(shards)))
        # a part of a hot phrase's shard gets the confirmed windows of its own stretches alone, so rows grow with the stretches
        counted = put(source.mapInArrow(_window_rows(p), "window bigint, phrase bigint, spread int, part int")
                      .select("window", shard.alias("shard"), "spread", "part").groupBy("window", "shard", "spread", "part").agg(F.count(F.lit(1)).alias("n"))
                      .where("n > 1 or spread > 1"), "counted")
        total = F.sum("n").over(Window.partitionBy("window", "shard"))
        confirmed = counted.withColumn("total", total).where("total > 1").select("window", "shard", "part")
        stretches = (source.mapInArrow(_stretch_rows(p), "rid bigint, start int, phrase bigint, spread int, part int, symbols binary, windows binary")
                     .select("rid", "start", "symbols", "windows", shard.alias("shard"), "part"))
        spans = (stretches.groupBy("shard", "part").cogroup(confirmed.groupBy("shard", "part"))
                 .applyInArrow(_locate(p), "rid bigint, from_word bigint, to_word bigint"))
        spans = spans.groupBy("rid").agg(F.collect_list(F.struct("from_word", "to_word")).alias("spans"))
        self.spans = put(spans, "spans")

    def _parts(self, more: str) -> DataFrame:
        """rid and what is left, of the rows that lose a part; classes of several rows lose everything anyway."""
        lone = self.table.where("copies = 1").select("rid")
        hit = self.some.select("rid", "text").join(self.spans, "rid").join(lone, "rid", "left_semi").select("rid", "text", "spans")
        return hit.mapInArrow(_cut, "rid bigint, gone bigint, sha256 string, left_text string").select("rid", "gone", more)

    def _whole(self) -> Column:
        return (F.col("n_words") >= self.p.width) & (F.col("copies").isNull() | (F.col("copies") > 1))

    def digests(self) -> DataFrame:
        """doc_id, n_words, n_removed, kept_sha256 of every row."""
        parts = self._parts("sha256").withColumnRenamed("rid", "r")
        out = self.table.join(parts, F.col("rid") == F.col("r"), "left")
        whole, nothing = self._whole(), F.sha2(F.lit(""), 256)
        out = self.scratch.keep(out.select(
            "doc_id", "n_words", F.when(whole, F.col("n_words")).otherwise(F.coalesce("gone", F.lit(0).cast("long"))).alias("n_removed"),
            F.when(whole, nothing).otherwise(F.coalesce("sha256", "full_sha256")).alias("kept_sha256")))
        self.scratch.drop()
        return out

    def cleaned(self, docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
        """``docs`` with the recurring words taken out of ``text`` (kept words joined by one space); other rows as they are."""
        changed = self.table.join(self._parts("left_text"), "rid", "left").where(self._whole() | F.col("gone").isNotNull())
        changed = self.scratch.keep(changed.select(F.col("doc_id").alias("_d"), F.col("tkey").alias("_k"),
                                                   F.when(self._whole(), F.lit("")).otherwise(F.col("left_text")).alias("_left")).dropDuplicates(["_d", "_k"]))
        self.scratch.drop()

        def same(other: DataFrame) -> Column:
            return docs[doc_id].cast("long").eqNullSafe(other["_d"]) & (text_key(docs[text]) == other["_k"])

        ids, n = changed.select("_d", "_k"), changed.count()
        if n > BROADCAST_ROWS:
            rest, hit = None, docs.join(changed, same(changed), "left")
        else:  # only the texts that change are shuffled
            rest, hit = docs.join(F.broadcast(ids), same(ids), "left_anti"), docs.join(F.broadcast(ids), same(ids), "left_semi").join(changed, same(changed))
        hit = hit.select(*[F.coalesce("_left", docs[c]).alias(c) if c == text else docs[f"`{c}`"] for c in docs.columns])
        return hit if rest is None else rest.select(*[docs[f"`{c}`"] for c in docs.columns]).unionAll(hit)
