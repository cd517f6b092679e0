"""Toxicity by a factorization machine over hashed terms.

Terms are 64-bit hashes of a text's distinct words and four-letter word beginnings, in lower case and without
punctuation. The machine has a weight and a short vector for every kept
term; the products of vectors weigh pairs of terms, such as an insult beside the name of a
group, which single weights cannot. It is fitted on a bounded, documented
sample in one task; the model is broadcast and every document is scored.
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
from policylens.llm.learning import fold_of, labelled, sample
from policylens.llm.text import Scratch, words

PUNCTUATION = ".,;:!?\"'()[]{}*#$%&|<>-_/\\"


@dataclass(frozen=True)
class Machine:
    """per_class: labelled documents of each class (the sample's bound). terms: most terms kept. discoveries: the share of the kept terms
    that may be there by chance. paired: the most frequent terms, whose pairs are judged too; pair_evidence: the chi-square by which a pair must
    tell more than either term. beginning: letters of a word beginning. rank, epochs, rate, decay: of the fit.
    hidden: share of a document's terms hidden at random in the first step, so that few signs suffice; it falls to a quarter of that by a
    third of the steps, so that the later ones see most pairs whole."""

    per_class: int = 4096
    terms: int = 8192
    discoveries: float = 0.5
    paired: int = 1024
    pair_evidence: float = 40.0
    beginning: int = 4
    rank: int = 6
    epochs: int = 60
    rate: float = 0.05
    decay: float = 1e-4
    hidden: float = 0.4


def features(docs: DataFrame, text: Column, fm: Machine, **carry: Column) -> DataFrame:
    """Carried columns and ids: hashes of the distinct terms."""
    w = words(F.translate(F.lower(F.coalesce(text, F.lit(""))), PUNCTUATION, ""))
    rows = docs.select(*[c.alias(k) for k, c in carry.items()], F.array_distinct(w).alias("_w"))
    begins = F.array_distinct(F.transform("_w", lambda x: F.xxhash64(F.substring(x, 1, fm.beginning), F.lit(1))))
    return rows.select(*carry, F.concat(F.transform("_w", lambda x: F.xxhash64(x)), begins).alias("ids"))


def chances(seen: np.ndarray, ones: np.ndarray, n: int, k: int) -> np.ndarray:
    """Two-sided hypergeometric p-values: a term seen in ``seen`` of ``n`` documents, ``ones`` of them among the ``k`` of label 1."""
    logs = np.concatenate([[0.0], np.cumsum(np.log(np.arange(1, n + 1)))])
    choose = lambda a, b: logs[a] - logs[b] - logs[a - b]
    kinds, at = np.unique(np.stack([seen, ones], 1), axis=0, return_inverse=True)
    out = np.ones(len(kinds))
    for i, (s, o) in enumerate(kinds):
        j = np.arange(max(0, s - (n - k)), min(s, k) + 1)
        p = np.exp(choose(k, j) + choose(n - k, s - j) - choose(n, s))
        out[i] = min(1.0, 2 * min(p[j >= o].sum(), p[j <= o].sum()))
    return out[at.ravel()]


def paired_terms(at: np.ndarray, row: np.ndarray, y: np.ndarray, seen: np.ndarray, ones: np.ndarray, fm: Machine) -> np.ndarray:
    """Terms of pairs that tell much more of the label together than either does alone, among the most frequent ones."""
    n, p = len(y), y.mean()
    often = np.sort(np.argsort(-np.where(seen <= 0.9 * n, seen, 0), kind="stable")[:fm.paired])
    place = np.full(len(seen), -1)
    place[often] = np.arange(len(often))
    x = np.zeros((n, len(often)), np.float32)
    near = place[at] >= 0
    x[row[near], place[at[near]]] = 1
    both, toxic = x.T @ x, x[y == 1].T @ x[y == 1]

    def chi(ones: np.ndarray, seen: np.ndarray) -> np.ndarray:
        return (ones - seen * p) ** 2 / np.maximum(seen * p * (1 - p) * (1 - seen / n), 1e-9) * (seen >= 5)

    alone = chi(ones[often], seen[often])
    more = chi(toxic, both) - np.maximum(alone[:, None], alone[None, :])
    np.fill_diagonal(more, 0)
    return often[(more >= fm.pair_evidence).any(1)]


def keep_terms(ids: np.ndarray, row: np.ndarray, y: np.ndarray, fm: Machine) -> np.ndarray:
    """The terms worth a weight and a vector, sorted by value: those whose own p-values pass the Benjamini-Hochberg rule at
    ``discoveries``, whatever the size of the sample, and those of telling pairs."""
    terms, at = np.unique(ids, return_inverse=True)
    ones = np.bincount(at, weights=y[row], minlength=len(terms)).astype(int)
    seen = np.bincount(at, minlength=len(terms))
    p = chances(seen, ones, len(y), int(y.sum()))
    order = np.argsort(p, kind="stable")
    passed = np.flatnonzero(p[order] <= fm.discoveries * (np.arange(len(order)) + 1) / max(len(order), 1))
    own = order[:passed[-1] + 1 if len(passed) else 0][:fm.terms]
    return terms[np.union1d(own, paired_terms(at, row, y, seen, ones, fm)[:fm.terms])] if len(terms) and 0 < y.sum() < len(y) else terms[:0]


def raw_scores(ids: np.ndarray, offsets: np.ndarray, model: dict) -> np.ndarray:
    """w0 + sum of weights + sum of pair products, of each document's kept terms."""
    n = len(offsets) - 1
    out = np.full(n, model["w0"])
    kept, sieve = model["terms"], model["sieve"]
    if not len(kept):
        return out
    maybe = np.flatnonzero(sieve[ids & (len(sieve) - 1)])
    at = np.minimum(np.searchsorted(kept, ids[maybe]), len(kept) - 1)
    ok = kept[at] == ids[maybe]
    row = np.searchsorted(offsets, maybe[ok], side="right") - 1
    at = at[ok]
    out += np.bincount(row, weights=model["w"][at], minlength=n)
    for f in range(model["v"].shape[1]):
        x = model["v"][at, f]
        out += 0.5 * (np.bincount(row, weights=x, minlength=n) ** 2 - np.bincount(row, weights=x * x, minlength=n))
    return out


def sieve_of(terms: np.ndarray) -> np.ndarray:
    """Low bits of the kept terms, which rule out most others at once."""
    out = np.zeros(1 << 20, bool)
    out[terms & (len(out) - 1)] = True
    return out


def train(ids: np.ndarray, offsets: np.ndarray, y: np.ndarray, fm: Machine) -> dict:
    row = np.repeat(np.arange(len(y)), np.diff(offsets))
    terms = keep_terms(ids, row, y, fm)
    rng = np.random.default_rng(11)
    model = {"terms": terms, "sieve": sieve_of(terms), "w0": 0.0, "w": np.zeros(len(terms)), "v": rng.normal(0, 0.05, (len(terms), fm.rank))}
    if not len(terms) or not len(y):
        model["w0"] = float(np.log((y.sum() + 1) / (len(y) - y.sum() + 1))) if len(y) else 0.0
        return model
    at = np.minimum(np.searchsorted(terms, ids), len(terms) - 1)
    ok = terms[at] == ids
    at, row = at[ok], row[ok]
    cuts = np.searchsorted(row, np.arange(len(y) + 1))
    weight = np.where(y == 1, 0.5 / max(y.mean(), 1e-9), 0.5 / max(1 - y.mean(), 1e-9))
    g_w, g_v, g_0 = np.full(len(terms), 1e-6), np.full((len(terms), fm.rank), 1e-6), 1e-6
    for epoch in range(fm.epochs):
        hidden = fm.hidden * max(0.25, 1 - 2 * epoch / fm.epochs)
        order = rng.permutation(len(y))
        for a in range(0, len(y), 256):
            docs = order[a:a + 256]
            sizes = cuts[docs + 1] - cuts[docs]
            own = np.repeat(np.arange(len(docs)), sizes)
            pick = at[np.repeat(cuts[docs] - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())]
            if hidden:
                shown = rng.random(len(pick)) >= hidden
                own, pick = own[shown], pick[shown]
            x = model["v"][pick]
            total = np.zeros((len(docs), fm.rank))
            np.add.at(total, own, x)
            squares = np.bincount(own, weights=(x * x).sum(1), minlength=len(docs))
            s = model["w0"] + np.bincount(own, weights=model["w"][pick], minlength=len(docs)) + 0.5 * ((total ** 2).sum(1) - squares)
            err = weight[docs] * (1 / (1 + np.exp(-np.clip(s, -30, 30))) - y[docs])
            d_w = np.bincount(pick, weights=err[own], minlength=len(terms)).astype(float)
            d_v = np.zeros_like(model["v"])
            np.add.at(d_v, pick, err[own][:, None] * (total[own] - x))
            used = np.unique(pick)
            d_w[used] += fm.decay * model["w"][used] * len(docs)
            d_v[used] += fm.decay * model["v"][used] * len(docs)
            g_w += d_w ** 2
            g_v += d_v ** 2
            g_0 += err.sum() ** 2
            model["w"] -= fm.rate * d_w / np.sqrt(g_w)
            model["v"] -= fm.rate * d_v / np.sqrt(g_v)
            model["w0"] -= fm.rate * err.sum() / np.sqrt(g_0)
    return model


def _fit(fm: Machine):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, sizes, y = [], [], []
        for batch in rolling.pieces(batches, "ids"):
            flat, offsets = rolling.lists(batch.column("ids"))
            ids.append(flat)
            sizes.append(np.diff(offsets))
            y += batch.column("label").to_pylist()
        if y:
            offsets = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
            model = train(np.concatenate(ids), offsets, np.array(y, float), fm)
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], ["model"])
    return run


def _score(model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in rolling.pieces(batches, "ids"):
            flat, offsets = rolling.lists(batch.column("ids"))
            s = np.zeros(len(batch)) if model.value is None else raw_scores(flat, offsets, model.value)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(1 / (1 + np.exp(-np.clip(s, -30, 30))))], ["doc_id", "score"])
    return run


def fit(docs: DataFrame, labels: DataFrame, fm: Machine = Machine(), label: str = "toxic") -> dict | None:
    """The model, or None without labelled documents. The sample is fitted in one task; its bound is 2 * per_class documents."""
    rows = labelled(docs, Scratch(docs.sparkSession, "machine").keep(sample(labels, label, fm.per_class)))
    rows = features(rows, rows["text"], fm, label=rows["label"]).coalesce(1)
    made = rows.mapInArrow(_fit(fm), "model binary").collect()
    return pickle.loads(bytes(made[0][0])) if made else None


def score(docs: DataFrame, model: dict | None, fm: Machine = Machine()) -> DataFrame:
    """doc_id, held_out, score, predicted (score >= 0.7) of every row; texts are never shuffled.

    A null or empty text has no term and the bias as score; without a model every score is 0.5; repeats and null ids do no harm.
    Texts are read whole, however long; a term counts once however often it stands there. Scores do not depend on other rows, so there are no
    ties to break. Columns other than the id and the text are not read. An empty table gives no rows.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    rows = features(docs, docs["text"], fm, doc_id=docs["doc_id"].cast("long"))
    out = rows.mapInArrow(_score(shared), "doc_id bigint, score double")
    return out.select("doc_id", (fold_of(F.col("doc_id")) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
