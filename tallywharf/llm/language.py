"""Operator 7: language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1, fixed by its code point. A trigram is bound from the vectors of its
letters, the first rotated twice and the second once, multiplied together; a text is the bundle (sum) of its trigrams,
a language the bundle of its texts. A text gets the language whose prototype has the highest cosine. Texts are
lower-cased, runs of anything but letters are one blank, and blanks count as letters.

Prototypes are learned from at most ``SAMPLE`` labelled documents, taken by hashed id.

Nulls: a text that is null or has no letter gets ``und`` and score 0; documents without ``lang`` are not learned from. Where
nothing can be learned every text is ``und``. Equal cosines fall to the first language by name. Repeated rows give
repeated results. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import annotate, bounded_sample, fold, slices, texts, values

DIMENSIONS = 512
SAMPLE = 20_000
SEED = 7_001
UNKNOWN = "und"
HELD_OUT_PARTS, HELD_OUT = 4, 2

#: Trigram vectors that a task keeps; beyond it starts anew.
KEPT = 16_384
BLANK = 0x20

FIELDS = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]


def letter_table():
    """For each code point its lower-case letter, or a blank."""
    table = np.full(0x110000, BLANK, dtype=np.int64)
    for c in range(0x110000):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            table[c] = ord(low) if len(low) == 1 else c
    return table


def trigrams(text, table):
    """Codes and counts of a text's trigrams; none for a text without letters."""
    points = table[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype="<u4")]
    letters = np.concatenate(([BLANK], points, [BLANK]))
    letters = letters[np.concatenate(([True], (letters[1:] != BLANK) | (letters[:-1] != BLANK)))]
    if len(letters) < 3:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.unique((letters[:-2] << 42) | (letters[1:-1] << 21) | letters[2:], return_counts=True)


class Space:
    """Vectors of letters and trigrams."""

    def __init__(self, dimensions=DIMENSIONS, seed=SEED):
        self.dimensions, self.seed = dimensions, seed
        self.letters, self.rows = {}, {}
        self.vectors = np.empty((KEPT, dimensions), dtype=np.float32)

    def letter(self, point):
        if point not in self.letters:
            random = np.random.default_rng((self.seed, int(point)))
            self.letters[point] = (random.integers(0, 2, self.dimensions, dtype=np.int8) * 2 - 1).astype(np.int8)
        return self.letters[point]

    def bind(self, code):
        a, b, c = int(code) >> 42, (int(code) >> 21) & 0x1FFFFF, int(code) & 0x1FFFFF
        return np.roll(self.letter(a), 2) * np.roll(self.letter(b), 1) * self.letter(c)

    def bundle(self, codes, counts):
        """The sum of the trigrams' vectors, each as often as it is there."""
        total = np.zeros(self.dimensions, dtype=np.float32)
        for first in range(0, len(codes), KEPT):
            part = codes[first : first + KEPT].tolist()
            if len(self.rows) + len(part) > KEPT:
                missing = sum(c not in self.rows for c in part)
                if len(self.rows) + missing > KEPT:
                    self.rows = {}
            for c in part:
                if c not in self.rows:
                    self.vectors[len(self.rows)] = self.bind(c)
                    self.rows[c] = len(self.rows)
            at = np.fromiter(map(self.rows.__getitem__, part), dtype=np.int64, count=len(part))
            total += counts[first : first + KEPT].astype(np.float32) @ self.vectors[at]
        return total


def learn(documents, held_out=True, sample=SAMPLE):
    """Language names and their prototypes of length 1, from documents with ``lang`` outside the held-out fold."""
    known = documents.where(F.col("lang").isNotNull()).select("doc_id", "text", "lang")
    if held_out:
        known = known.where(fold("doc_id", HELD_OUT_PARTS) != HELD_OUT)
    chosen = bounded_sample(known.select("doc_id"), "doc_id", sample, SEED).distinct()

    def count(batches):
        table, totals = letter_table(), {}
        for batch in slices(batches):
            for lang, text in zip(values(batch, "lang").to_pylist(), texts(batch), strict=True):
                own = totals.setdefault(lang, {})
                for code, n in zip(*(x.tolist() for x in trigrams(text, table)), strict=True):
                    own[code] = own.get(code, 0) + n
        rows = [(lang, code, n) for lang, own in totals.items() for code, n in own.items()]
        if rows:
            yield pa.RecordBatch.from_pydict(dict(zip(("lang", "code", "n"), map(list, zip(*rows, strict=True)), strict=True)))

    counted = (
        known.join(F.broadcast(chosen), "doc_id", "left_semi")
        .select("lang", "text").mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    return prototypes(counted.toPandas())


def prototypes(counted):
    space, names, rows = Space(), [], []
    for lang, own in sorted(counted.groupby("lang"), key=lambda x: x[0]):
        vector = space.bundle(own.code.to_numpy(), own.n.to_numpy()).astype(np.float64)
        names.append(lang)
        rows.append(vector / (np.linalg.norm(vector) or 1.0))
    return names, np.array(rows).reshape(len(rows), DIMENSIONS)


def predict(documents, model, keep=("doc_id",)):
    """The ``keep`` columns with ``lang_pred`` and ``score``, the cosine, 0 where it is below."""
    names, matrix = model

    def make():
        table, space = letter_table(), Space()

        def best(batch):
            langs, scores = [], []
            for text in texts(batch):
                codes, counts = trigrams(text, table)
                if not len(codes) or not names:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                vector = space.bundle(codes, counts).astype(np.float64)
                cosines = matrix @ vector / (np.linalg.norm(vector) or 1.0)
                at = int(np.argmax(cosines))
                langs.append(names[at])
                scores.append(float(min(1.0, max(0.0, cosines[at]))))
            return pa.array(langs, pa.string()), pa.array(scores, pa.float64())

        return best

    return annotate(documents, FIELDS, make, keep)


def identify(documents):
    """The contract's columns for every document."""
    model = learn(documents)
    return predict(documents.select("doc_id", "text"), model).select(
        "doc_id", (fold("doc_id", HELD_OUT_PARTS) == HELD_OUT).alias("held_out"), "lang_pred", "score"
    )
