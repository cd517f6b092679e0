"""Quality by votes of the nearest labelled documents in a latent-semantic space.

A document is described by three blocks: its words (those that the labels tell
apart, by a false discovery rate), the shapes of its words (runs of capitals, small letters and digits
shortened to one sign, everything else kept), and signs of repetition. How much a
block counts is measured on the sample: the classes' distance in it against their spread. A bounded,
documented sample of labelled documents gives the latent space (truncated SVD) and the labelled vectors; both are broadcast. Every document is then compared with
all labelled vectors by exact cosine products, in blocks.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from policylens.llm import rolling
from policylens.llm.fm_toxicity import PUNCTUATION, chances, sieve_of
from policylens.llm.learning import fold_of, labelled, sample
from policylens.llm.text import Scratch, words


@dataclass(frozen=True)
class Voting:
    """per_class: labelled documents of each class (the sample's bound). terms: hashed shapes. words: most words kept; discoveries: the share
    of them that may be there by chance.
    dims: of the latent space. k: neighbours that vote. sharpness: the power of the similarity that weighs a vote."""

    per_class: int = 2048
    terms: int = 2048
    words: int = 2048
    discoveries: float = 0.05
    dims: int = 48
    k: int = 25
    sharpness: float = 8.0


def features(docs: DataFrame, text: Column, v: Voting, **carry: Column) -> DataFrame:
    """Carried columns, ids (hashed shape terms, with repeats), words (hashes of the words in lower case without punctuation) and four counts: words, distinct words, words equal to the one before, lines."""
    shape = F.coalesce(text, F.lit(""))
    for pattern, sign in ((r"\p{Lu}+", "A"), (r"[\p{Ll}\p{Lo}\p{Lm}\p{Lt}]+", "a"), (r"\p{N}+", "0")):
        shape = F.regexp_replace(shape, pattern, sign)
    rows = docs.select(*[c.alias(k) for k, c in carry.items()], words(text).alias("_w"), words(shape).alias("_s"),
                       words(F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, "")).alias("_b"),
                       F.size(F.split(F.coalesce(text, F.lit("")), "\n", -1)).alias("_n"))
    rows = rows.withColumn("_h", F.transform("_w", lambda x: F.xxhash64(x)))
    same = F.aggregate(F.transform("_h", lambda x, i: F.when(x == F.get(F.col("_h"), i - 1), 1).otherwise(0)), F.lit(0), lambda a, x: a + x)
    return rows.select(*carry, F.transform("_s", lambda x: F.pmod(F.xxhash64(x), F.lit(v.terms)).cast("int")).alias("ids"),
                       F.transform("_b", lambda x: F.xxhash64(x)).alias("words"),
                       F.array(F.size("_w"), F.size(F.array_distinct("_h")), same, F.col("_n")).alias("counts"))


def unit(x: np.ndarray) -> np.ndarray:
    return (x / np.maximum(np.sqrt((x * x).sum(1, keepdims=True)), 1e-9)).astype(np.float32)


def shape_block(batch: pa.RecordBatch, v: Voting) -> np.ndarray:
    """Unit rows of log counts of shapes."""
    ids, offsets = rolling.lists(batch.column("ids"))
    n = len(offsets) - 1
    row = np.repeat(np.arange(n), np.diff(offsets))
    return unit(np.log1p(np.bincount(row * v.terms + ids, minlength=n * v.terms).reshape(n, v.terms).astype(np.float32)))


def sign_block(batch: pa.RecordBatch) -> np.ndarray:
    """Shares of repeated words, of words equal to the one before, of lines; and whether there are words."""
    total, distinct, same, lines = rolling.lists(batch.column("counts"))[0].reshape(-1, 4).T.astype(np.float32)
    some = np.maximum(total, 1)
    return np.stack([same / some, 1 - distinct / some, np.minimum(lines / some, 1), total > 0], 1).astype(np.float32)


def word_block(batch: pa.RecordBatch, kept: np.ndarray, weight: np.ndarray, sieve: np.ndarray) -> np.ndarray:
    """Unit rows of weighted log counts of the kept words; zero for a row without any."""
    flat, offsets = rolling.lists(batch.column("words"))
    n = len(offsets) - 1
    if not len(kept):
        return np.zeros((n, 0), np.float32)
    maybe = np.flatnonzero(sieve[flat & (len(sieve) - 1)])
    at = np.minimum(np.searchsorted(kept, flat[maybe]), len(kept) - 1)
    ok = kept[at] == flat[maybe]
    row = np.searchsorted(offsets, maybe[ok], side="right") - 1
    counts = np.bincount(row * len(kept) + at[ok], minlength=n * len(kept)).reshape(n, len(kept)).astype(np.float32)
    return unit(np.log1p(counts) * weight)


def telling_words(flat: np.ndarray, row: np.ndarray, y: np.ndarray, v: Voting) -> tuple[np.ndarray, np.ndarray]:
    """Words that the labels tell apart (Benjamini-Hochberg over the documents that hold them), sorted, and their absolute log odds."""
    held = np.unique(np.stack([row, flat], 1), axis=0)
    terms, at = np.unique(held[:, 1], return_inverse=True)
    if not len(terms) or not 0 < y.sum() < len(y):
        return np.zeros(0, np.int64), np.zeros(0, np.float32)
    seen, ones = np.bincount(at), np.bincount(at, weights=y[held[:, 0]]).astype(int)
    p = chances(seen, ones, len(y), int(y.sum()))
    order = np.argsort(p, kind="stable")
    passed = np.flatnonzero(p[order] <= v.discoveries * (np.arange(len(order)) + 1) / len(order))
    best = np.sort(order[:min(passed[-1] + 1 if len(passed) else 0, v.words)])
    odds = lambda k, n: np.log((k + 0.5) / (n - k + 0.5))
    return terms[best], np.abs(odds(ones[best], y.sum()) - odds((seen - ones)[best], len(y) - y.sum())).astype(np.float32)


def telling(block: np.ndarray, y: np.ndarray) -> float:
    """Squared distance of the classes' means against their spread."""
    if not 0 < y.sum() < len(y) or not block.shape[1]:
        return 0.0
    one, two = block[y == 1], block[y == 0]
    return float(((one.mean(0) - two.mean(0)) ** 2).sum() / max(one.var(0).sum() + two.var(0).sum(), 1e-9))


def matrix(batch: pa.RecordBatch, model: dict, v: Voting) -> np.ndarray:
    """Unit rows of the weighted blocks."""
    signs = np.clip((sign_block(batch) - model["mean"]) / model["scale"], -3, 3) / 6
    words_ = word_block(batch, model["kept"], model["odds"], model["sieve"])
    parts = (shape_block(batch, v), signs, words_)
    return unit(np.concatenate([w * x for w, x in zip(model["blocks"], parts, strict=True)], 1))


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in rolling.pieces(batches, "ids", 1 << 19):
        for a in range(0, len(batch), 512):
            yield batch.slice(a, 512)


def prepared(batches: list[pa.RecordBatch], y: np.ndarray, v: Voting) -> dict:
    """The blocks' words and weights, measured on the sample; words found on one half of it say on the other how much they tell."""
    signs = np.concatenate([sign_block(b) for b in batches])
    mean, scale = signs.mean(0), np.maximum(signs.std(0), 1e-3)
    flat = np.concatenate([rolling.lists(b.column("words"))[0] for b in batches])
    sizes = np.concatenate([np.diff(rolling.lists(b.column("words"))[1]) for b in batches])
    row = np.repeat(np.arange(len(y)), sizes)
    half = np.arange(len(y)) % 2 == 0
    kept, odds = telling_words(flat[half[row]], np.cumsum(half)[row[half[row]]] - 1, y[half], v)
    trial = np.concatenate([word_block(b, kept, odds, sieve_of(kept)) for b in batches])[~half]
    tell = [telling(np.concatenate([shape_block(b, v) for b in batches]), y), telling(np.clip((signs - mean) / scale, -3, 3) / 6, y), telling(trial, y[~half])]
    kept, odds = telling_words(flat, row, y, v)
    total = sum(tell)
    return {"mean": mean, "scale": scale, "kept": kept, "odds": odds, "sieve": sieve_of(kept), "blocks": [(t / total) ** 0.5 if total else 1.0 for t in tell]}


def _fit(v: Voting):
    """The whole (bounded) sample in one task -> the model as one pickled row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(_slices(batches))
        if parts:
            y = np.concatenate([b.column("label").to_numpy() for b in parts]).astype(np.float32)
            model = prepared(parts, y, v)
            x = np.concatenate([matrix(b, model, v) for b in parts])
            rng = np.random.default_rng(5)
            k = min(v.dims, *x.shape)
            basis = rng.standard_normal((x.shape[1], min(k + 16, x.shape[1]))).astype(np.float32)
            for _ in range(5):
                basis, _ = np.linalg.qr(x.T @ (x @ basis))
            _, _, right = np.linalg.svd(x @ basis, full_matrices=False)
            axes = (basis @ right[:k].T).astype(np.float32)
            model |= {"axes": axes, "vectors": unit(x @ axes), "labels": y}
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
    return run


def vote(x: np.ndarray, model: dict, v: Voting) -> np.ndarray:
    """Share of the label 1 among the k nearest labelled vectors, weighted by similarity; classes count alike.

    Cosines count to six places; all vectors as near as the k-th vote, so ties are not broken by order.
    """
    labels = model["labels"]
    cosine = np.round(unit(x @ model["axes"]) @ model["vectors"].T, 6)
    k = min(v.k, len(labels))
    least = np.partition(cosine, len(labels) - k, axis=1)[:, len(labels) - k]
    row, near = np.nonzero(cosine >= least[:, None])
    weight = np.maximum(cosine[row, near], 1e-6).astype(np.float64) ** v.sharpness
    share = float(labels.mean())
    weight *= np.where(labels[near] == 1, 1 / max(share, 1e-9), 1 / max(1 - share, 1e-9))
    n = len(cosine)
    return np.bincount(row, weight * labels[near], n) / np.bincount(row, weight, n)


def _score(v: Voting, model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            if model.value is None:
                got = np.full(len(batch), 0.5)
            else:
                got = vote(matrix(batch, model.value, v), model.value, v)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(got)], ["doc_id", "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, v: Voting = Voting(), label: str = "quality") -> dict | None:
    """The model, or None without labelled documents. The sample is fitted in one task; its bound is 2 * per_class documents."""
    rows = labelled(docs, Scratch(docs.sparkSession, "voting").keep(sample(labels, label, v.per_class)))
    rows = features(rows, rows["text"], v, label=rows["label"]).coalesce(1)
    made = rows.mapInArrow(_fit(v), "model binary").collect()
    return pickle.loads(bytes(made[0][0])) if made else None


def score(docs: DataFrame, model: dict | None, v: Voting = Voting()) -> DataFrame:
    """doc_id, held_out, score, predicted of every row; texts are never shuffled.

    A null or empty text has a vector of zeros and the vote of neighbours at no distance in particular; without a model every score is
    0.5; rows are scored one by one, so repeats and null ids do no harm. Texts are read whole, however long. Of equally near
    neighbours at the k-th place all vote. Columns other than the id and the text are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = features(docs, docs["text"], v, doc_id=docs["doc_id"].cast("long"))
    out = rows.mapInArrow(_score(v, shared), "doc_id bigint, score double")
    return out.select("doc_id", (fold_of(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
