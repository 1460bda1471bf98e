"""Operator 6: toxicity by a factorization machine over hashed terms.

A document is the set of its hashed words. Its logit is ``bias + sum of term weights + sum over pairs of terms of the
product of their factor vectors``, so two terms that are harmless alone can weigh together. The machine is trained with
mini-batches on the logistic loss; terms that few training documents have, or that tell nothing, are left out. A logistic calibration, fitted on
training documents that the machine did not see, makes the score a probability.

It learns from at most ``SAMPLE`` labelled documents outside the held-out fold, taken by hashed id. Scores depend on the
text alone.

Nulls: a null text is empty and scored like one without known terms; labels that are null, or of documents that are not
there, are not learned from; of several labels of a document the largest counts. Without labels of both kinds every
score is the share of label 1, or 0. Repeated rows give repeated results. An empty table gives no rows.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, fold, labelled, slices, texts, values

BUCKETS = 1 << 18
FACTORS = 8
SAMPLE = 12_000
#: Terms are learned that are in at least so many documents, and either go with a label by so many standard deviations
#: or are in such a share of the documents.
LEAST_DOCUMENTS, SURPRISE, FREQUENT = 6, 4.0, 0.05
EPOCHS = 12
BATCH = 128
SEED = 6_001
HELD_OUT_PARTS, HELD_OUT = 5, 0

#: Words whose hashes a task keeps; beyond it starts anew.
KEPT_WORDS = 200_000

WORD = re.compile(r"[^\W\d_]+")
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


class Terms:
    """The hashed terms of texts."""

    def __init__(self, buckets=BUCKETS):
        self.buckets, self.known = buckets, {}

    def __call__(self, text):
        words = set(WORD.findall(text.lower()))
        known = self.known
        if len(known) > KEPT_WORDS:
            known.clear()
        for w in words:
            if w not in known:
                known[w] = zlib.crc32(w.encode()) % self.buckets
        return np.unique(np.fromiter((known[w] for w in words), dtype=np.int64, count=len(words)))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


class Machine:
    """Weights, factors and calibration of the terms that were learned."""

    def __init__(self, terms, bias, weights, factors, slope=1.0, shift=0.0):
        self.terms, self.bias, self.weights, self.factors = terms, bias, weights, factors
        self.slope, self.shift = slope, shift

    def logits(self, rows):
        """Of documents given as arrays of hashed terms."""
        out = np.empty(len(rows))
        for i, row in enumerate(rows):
            at = np.searchsorted(self.terms, row)
            at = at[(at < len(self.terms)) & (self.terms[np.minimum(at, max(0, len(self.terms) - 1))] == row)] if len(self.terms) else at[:0]
            v = self.factors[at]
            out[i] = self.bias + self.weights[at].sum() + 0.5 * ((v.sum(0) ** 2).sum() - (v**2).sum())
        return out

    def scores(self, rows):
        return sigmoid(self.slope * self.logits(rows) + self.shift)


def fit(rows, labels, epochs=EPOCHS, seed=SEED, rate=0.05, decay=2e-4):
    """Trains on documents given as arrays of hashed terms and their 0/1 labels."""
    labels = np.asarray(labels, dtype=np.float64)
    share = labels.mean() if len(labels) else 0.0
    if len(labels) < 20 or share in (0.0, 1.0):
        bias = np.log(share / (1 - share)) if 0 < share < 1 else (30.0 if share else -30.0)
        return Machine(np.empty(0, np.int64), bias, np.empty(0), np.empty((0, FACTORS)))
    random = np.random.default_rng(seed)
    order = random.permutation(len(rows))
    rest, train = order[: len(rows) // 5], order[len(rows) // 5 :]
    terms = telling([rows[i] for i in train], labels[train])
    found = [np.flatnonzero(np.isin(terms, r, assume_unique=True)) for r in rows]
    machine = Machine(terms, float(np.log(share / (1 - share))), np.zeros(len(terms)), random.normal(0, 0.01, (len(terms), FACTORS)))
    slow_w, slow_v, slow_b = np.full(len(terms), 1e-4), np.full((len(terms), FACTORS), 1e-4), 1e-4
    for _ in range(epochs):
        random.shuffle(train)
        for first in range(0, len(train), BATCH):
            batch = [i for i in train[first : first + BATCH] if len(found[i])]
            if not batch:
                continue
            at = np.concatenate([found[i] for i in batch])
            starts = np.concatenate(([0], np.cumsum([len(found[i]) for i in batch])[:-1]))
            sizes = np.diff(np.concatenate((starts, [len(at)])))
            v = machine.factors[at]
            sums = np.add.reduceat(v, starts, axis=0)
            logit = machine.bias + np.add.reduceat(machine.weights[at], starts)
            logit += 0.5 * ((sums**2).sum(1) - np.add.reduceat((v**2).sum(1), starts))
            error = (sigmoid(logit) - labels[batch]) / len(batch)
            each = np.repeat(error, sizes)
            used, where = np.unique(at, return_inverse=True)
            grad_w = np.bincount(where, weights=each) + decay * machine.weights[used]
            pull = each[:, None] * (np.repeat(sums, sizes, axis=0) - v)
            grad_v = np.stack([np.bincount(where, weights=pull[:, k]) for k in range(FACTORS)], axis=1) + decay * machine.factors[used]
            slow_w[used] += grad_w**2
            slow_v[used] += grad_v**2
            slow_b += error.sum() ** 2
            machine.weights[used] -= rate * grad_w / np.sqrt(slow_w[used])
            machine.factors[used] -= rate * 0.3 * grad_v / np.sqrt(slow_v[used])
            machine.bias -= rate * error.sum() / np.sqrt(slow_b)
    machine.slope, machine.shift = calibrate(machine.logits([rows[i] for i in rest]), labels[rest])
    return machine


def telling(rows, labels):
    """The terms to learn: those that go with a label beyond chance, and frequent ones, which may do so in pairs."""
    terms, n = np.unique(np.concatenate(rows), return_counts=True)
    toxic = np.concatenate([r for r, y in zip(rows, labels, strict=True) if y] or [terms[:0]])
    hits = np.zeros(len(terms))
    at, count = np.unique(toxic, return_counts=True)
    hits[np.searchsorted(terms, at)] = count
    share = labels.mean()
    surprise = np.abs(hits - n * share) / np.sqrt(n * share * (1 - share) * np.maximum(1e-9, 1 - n / (len(rows) + 1)))
    return terms[(n >= min(LEAST_DOCUMENTS, max(2, len(rows) // 50))) & ((surprise >= SURPRISE) | (n >= FREQUENT * len(rows)))]


def calibrate(logits, labels, steps=50):
    """Slope and shift of a logistic curve, by Newton's method with a little shrinkage towards slope 1."""
    x, p = np.stack([np.clip(logits, -30, 30), np.ones(len(logits))], axis=1), np.array([1.0, 0.0])
    if len(labels) == 0 or labels.min() == labels.max():
        return 1.0, 0.0
    for _ in range(steps):
        s = sigmoid(x @ p)
        step = np.linalg.solve(x.T @ (x * (s * (1 - s))[:, None]) + np.eye(2) * 0.1, x.T @ (s - labels) + 0.1 * (p - [1.0, 0.0]))
        p = p - step
        if np.abs(step).max() < 1e-6:
            break
    return (float(p[0]), float(p[1])) if p[0] > 0 and np.isfinite(p).all() else (1.0, 0.0)


def training_rows(documents, labels, sample=SAMPLE):
    """Hashed terms and labels of the documents learned from, in the order of their ids."""
    known = labelled(documents, labels, "toxic").where(fold("doc_id", HELD_OUT_PARTS) != HELD_OUT)
    chosen = bounded_sample(known, "doc_id", sample, SEED)

    def extract(batches):
        terms = Terms()
        for batch in slices(batches):
            rows = [terms(x).astype(np.int32) for x in texts(batch)]
            yield pa.RecordBatch.from_arrays(
                [values(batch, "doc_id"), values(batch, "label"), pa.array(rows, pa.list_(pa.int32()))], ["doc_id", "label", "terms"]
            )

    table = (
        documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("doc_id", "label", "text")
        .mapInArrow(extract, "doc_id long, label int, terms array<int>")
        .toArrow().sort_by([("doc_id", "ascending")])
    )
    rows = [np.asarray(x, dtype=np.int64) for x in table["terms"].to_pylist()]
    return rows, np.array(table["label"].to_pylist(), dtype=np.float64)


def score(documents, machine, keep=("doc_id",)):
    """The ``keep`` columns with ``score`` and ``predicted``."""

    def make():
        terms = Terms()

        def run(batch):
            found = machine.scores([terms(x) for x in texts(batch)])
            return pa.array(found), pa.array((found >= 0.5).astype(np.int32))

        return run

    return annotate(documents, FIELDS, make, keep)


def classify(documents, labels):
    """The contract's columns for every document."""
    machine = fit(*training_rows(documents, labels))
    return score(documents.select("doc_id", "text"), machine).select(
        "doc_id", (fold("doc_id", HELD_OUT_PARTS) == HELD_OUT).alias("held_out"), "score", "predicted"
    )
