"""Operator 8: quality by co-training two views of a document.

One view is the text's content, in shares of its characters, words and lines; the other is the metadata of its page:
language, source and length, which the text classifier does not see. Each view has a logistic classifier. Both views of
every document are computed once and written. In every round, each view looks through all unlabelled documents for those
it is surest of, as many of either kind as fits the labels' shares, and hands them to the other view. Sure is measured
at the base rate and at even odds, whichever says less, so a frequent label is not sure by itself, nor a rare one by being
likelier than usual. A view keeps what a round taught it only if the loss of both views together, on labelled validation
documents, falls by more than its standard error; the rounds end when neither view learns. Then both are calibrated on labelled documents that no round has learned or been chosen from, and a
score is the probability from the sum of the two calibrated log-odds, the base rate counted once.

It learns from at most ``SAMPLE`` labelled documents, taken by hashed id, and ``HANDED`` others a view and round, taken
from all; documents of equal views are one among them, and equally sure ones go by their hash.

Nulls: a null text is empty; a null language, source or length is a value of its own. Labels that are null, or of documents
that are not there, are not learned from; of several labels of a document the largest counts. Without labels of both
kinds every score is the share of label 1, or 0. Repeated rows give repeated results. An empty table gives no rows.
"""

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, fold, labelled, texts, values
from .sets import kept_small
from .toxicity import calibrate, sigmoid

SAMPLE = 8_000
ROUNDS = 5
#: The most documents that a view labels in a round, and the least confidence for it at even odds.
HANDED, CONFIDENCE = 400, 0.8
META_BUCKETS = 256
SEED = 8_001
HELD_OUT_PARTS, HELD_OUT = 5, 0

VOWELS = re.compile(r"[aeiouyáéíóúàèìòùâêîôûäëïöü]")
NEEDS = "text", "lang", "source", "n_chars"
FIELDS = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]


def content(text):
    """The text view."""
    n = len(text) or 1
    words = text.split()
    lines = [x for x in text.split("\n") if x.strip()]
    m, k = len(words) or 1, len(lines) or 1
    lower = [w.lower() for w in words]
    pairs = list(zip(lower[:-1], lower[1:]))
    letters = sum(map(str.isalpha, text))
    marks = sum(map(text.count, "#$%&*@|~^<>{}[]\\/=+_"))
    return [
        np.log1p(len(words)),
        letters / n,
        sum(map(str.isupper, text)) / max(1, letters),
        marks / n,
        marks / m,
        text.count("|") / m,
        text.count("!") / m,
        sum(map(text.count, ".,;:?")) / m,
        sum(map(text.count, "0123456789")) / n,
        letters / m / 10,
        len(set(lower)) / m,
        len(set(pairs)) / max(1, len(pairs)),
        len(set(lines)) / k,
        np.log1p(m / k),
        sum(len(w) <= 3 for w in words) / m,
        sum(1 for x in lines if x.rstrip()[-1:] in ".!?") / k,
    ]


def meta(lang, source, n_chars):
    """The metadata view: the places of hashed values of the columns and of the length's power of two."""
    size = "none" if n_chars is None else int(np.log2(max(1, n_chars)))
    return sorted({zlib.crc32(x.encode()) % META_BUCKETS for x in (f"lang {lang}", f"source {source}", f"size {size}", f"{lang} {size}")})


def matrices(contents, places):
    """Both views of documents as matrices."""
    x = np.array(contents, dtype=np.float64).reshape(len(contents), len(content("")))
    m = np.zeros((len(places), META_BUCKETS))
    for i, p in enumerate(places):
        m[i, p] = 1
    return x, m


class Logistic:
    """Logistic regression on standardised features, by Newton's method with a ridge."""

    def __init__(self, ridge):
        self.ridge = ridge

    def fit(self, x, y, weights):
        self.mean, self.scale = x.mean(0), x.std(0) + 1e-6
        z = np.concatenate([(x - self.mean) / self.scale, np.ones((len(x), 1))], axis=1)
        ridge = np.full(z.shape[1], self.ridge)
        ridge[-1] = 1e-6
        self.p = np.zeros(z.shape[1])
        for _ in range(15):
            s = sigmoid(z @ self.p)
            curve = z.T @ (z * (weights * np.maximum(s * (1 - s), 1e-4))[:, None]) + np.diag(ridge)
            step = np.linalg.solve(curve, z.T @ (weights * (s - y)) + ridge * self.p)
            self.p = self.p - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-5:
                break
        return self

    def logits(self, x):
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.p[:-1] + self.p[-1]


class CoTrained:
    """Both views and their calibration; ``views`` is None where nothing could be learned."""

    def __init__(self, views, curves, base):
        self.views, self.curves, self.base = views, curves, base

    def scores(self, *views):
        if self.views is None:
            return np.full(len(views[0]), self.base)
        prior = np.log(self.base / (1 - self.base))
        total = prior + sum(a * v.logits(x) + b - prior for v, (a, b), x in zip(self.views, self.curves, views, strict=True))
        return sigmoid(total)


def chosen(logits, prior, limits):
    """Of the rows, those surest of label 1 and of label 0 within the limits: (row, label, how sure), surest first."""
    least = np.log(CONFIDENCE / (1 - CONFIDENCE))
    for label, sign, n in ((1, 1, limits[0]), (0, -1, limits[1])):
        sure = sign * np.where(sign * prior > 0, logits - prior, logits)
        order = np.argsort(-sure, kind="stable")
        for i in order[sure[order] >= least][:n]:
            yield int(i), label, float(sure[i])


class Matrices:
    """Unlabelled documents in memory, as a pair of matrices."""

    def __init__(self, views):
        self.views = views

    def surest(self, k, view, prior, known, limits):
        """key: (label, both views' rows) of the documents that view ``k`` is surest of, without the known keys."""
        left = np.array([i for i in range(len(self.views[0])) if i not in known], dtype=np.int64)
        found = chosen(view.logits(self.views[k][left]), prior, limits)
        return {int(left[i]): (y, [v[left[i]] for v in self.views]) for i, y, _ in found}


class Table:
    """Unlabelled documents in a table of their distinct views; those that a view is sure of are ranked in Spark."""

    def __init__(self, frame):
        self.frame = frame

    def surest(self, k, view, prior, known, limits):
        known = set(known)

        def run(batches):
            for batch in batches:
                keys = values(batch, "key").to_numpy()
                logits = view.logits(matrices(values(batch, "content").to_pylist(), values(batch, "places").to_pylist())[k])
                found = [x for x in chosen(logits, prior, (len(logits),) * 2) if int(keys[x[0]]) not in known]
                if found:
                    rows, labels, sure = zip(*found, strict=True)
                    taken = [batch.column(c).take(pa.array(rows, pa.int64())) for c in range(3)]
                    columns = [*taken, pa.array(sure, pa.float64()), pa.array(labels, pa.int32())]
                    yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "sure", "label"])

        rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("sure"), "key"))
        rows = (
            self.frame.mapInArrow(run, "key long, content array<float>, places array<int>, sure double, label int")
            .withColumn("rank", rank).where(F.col("rank") <= max(limits)).collect()
        )
        found = {}
        for r in rows:
            if r["rank"] <= limits[1 - r.label]:
                x, m = matrices([r.content], [r.places])
                found[r.key] = r.label, (x[0], m[0])
        return found


def parts(y, order):
    """The rows to train on, to validate with and to calibrate with; all for each where a part lacks a label."""
    fifth = len(order) // 5
    cut = order[2 * fifth :], order[:fifth], order[fifth : 2 * fifth]
    return cut if all(len(p) and y[p].min() != y[p].max() for p in cut) else (order,) * 3


def co_train(labelled_views, y, pool, rounds=ROUNDS, handed=HANDED, seed=SEED):
    """Trains from the two views of labelled documents (a pair of matrices), their labels, and a pool of unlabelled ones."""
    y = np.asarray(y, dtype=np.float64)
    base = float(y.mean()) if len(y) else 0.0
    if len(y) < 20 or base in (0.0, 1.0):
        return CoTrained(None, None, base)
    train, held, rest = parts(y, np.random.default_rng(seed).permutation(len(y)))
    prior, limits = np.log(base / (1 - base)), (max(1, int(handed * base)), max(1, int(handed * (1 - base))))

    def fitted(k, lessons):
        rows = list(lessons.values())
        x = np.concatenate([labelled_views[k][train], *(v[k][None] for _, v in rows)])
        labels = np.concatenate([y[train], [label for label, _ in rows]])
        return Logistic((1.0, 10.0)[k]).fit(x, labels, np.concatenate([np.ones(len(train)), np.full(len(rows), 0.5)]))

    def combined(views):
        curves = [calibrate(v.logits(x[rest]), y[rest]) for v, x in zip(views, labelled_views, strict=True)]
        return CoTrained(views, curves, base)

    def losses(views):
        p = np.clip(combined(views).scores(*(x[held] for x in labelled_views)), 1e-3, 1 - 1e-3)
        return -np.where(y[held] == 1, np.log(p), np.log(1 - p))

    lessons = [{}, {}]  # what each view has been handed
    views = [fitted(0, {}), fitted(1, {})]
    before = losses(views)
    for _ in range(rounds):
        found = [pool.surest(k, views[k], prior, lessons[1 - k].keys(), limits) for k in (0, 1)]
        better = False
        for k in (0, 1):
            if not found[1 - k]:
                continue
            more = lessons[k] | found[1 - k]
            trial = [fitted(k, more) if j == k else views[j] for j in (0, 1)]
            now = losses(trial)
            if (before - now).mean() > (before - now).std() / np.sqrt(len(held)):
                views, before, lessons[k], better = trial, now, more, True
        if not better:
            break
    return combined(views)


def view_columns(documents, keep=("doc_id",)):
    """The ``keep`` columns and both views of every document, in ``content`` and ``places``."""
    fields = [T.StructField("content", T.ArrayType(T.FloatType())), T.StructField("places", T.ArrayType(T.IntegerType()))]

    def make():
        def run(batch):
            rows = zip(*(values(batch, c).to_pylist() for c in NEEDS[1:]), strict=True)
            return pa.array([content(t) for t in texts(batch)], pa.list_(pa.float32())), pa.array([meta(*r) for r in rows], pa.list_(pa.int32()))

        return run

    return annotate(documents, fields, make, keep, NEEDS)


def learn(views, labels, sample=SAMPLE):
    """The model, from the written views of all documents (``doc_id``, ``content``, ``places``) and the labels."""
    known = labelled(views, labels, "quality")
    taught = bounded_sample(known.where(fold("doc_id", HELD_OUT_PARTS) != HELD_OUT), "doc_id", sample, SEED)
    rows = views.join(F.broadcast(taught), "doc_id").toArrow().sort_by([("doc_id", "ascending"), ("label", "ascending")])
    pairs = matrices(rows["content"].to_pylist(), rows["places"].to_pylist())
    others = views.join(known.select("doc_id"), "doc_id", "left_anti").select("content", "places").distinct()
    pool = kept_small(others.select(F.xxhash64("content", "places", F.lit(SEED)).alias("key"), "content", "places"), "unlabelled")
    return co_train(pairs, rows["label"].to_pylist(), Table(pool))


def score(views, model, keep=("doc_id",)):
    """The ``keep`` columns with ``score`` and ``predicted``, from written views."""
    kept = [c for c in keep if c.lower() not in {f.name for f in FIELDS}]
    schema = T.StructType([views.schema[c] for c in kept] + FIELDS)

    def run(batches):
        for batch in batches:
            found = model.scores(*matrices(values(batch, "content").to_pylist(), values(batch, "places").to_pylist()))
            columns = [pa.array(found), pa.array((found >= 0.5).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([values(batch, c) for c in kept] + columns, schema.names)

    return views.select(*kept, "content", "places").mapInArrow(run, schema)


def classify(documents, labels):
    """``doc_id``, ``held_out``, ``score`` and ``predicted`` for every document."""
    views = kept_small(view_columns(documents), "views")
    return score(views, learn(views, labels)).select(
        "doc_id", (fold("doc_id", HELD_OUT_PARTS) == HELD_OUT).alias("held_out"), "score", "predicted"
    )
