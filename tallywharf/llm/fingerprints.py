"""Operator 5: document fingerprints that recover what differs, as invertible Bloom lookup sketches.

A document is the set of digests of its paragraphs: pieces that end after line feeds and sentence marks, and wherever a hash
of the last ``WINDOW`` characters is low; where none is for ``LONGEST`` characters, as in a repeated word, after that many.
The rule is the same at every size and needs neither words nor marks, so an edit changes the pieces around it and no others;
a repeated piece has a digest for each time it is there. A sketch puts each digest into one cell of each of its three parts; a cell holds a count,
the exclusive or of the digests and of their checks. The sketches of two versions are subtracted cell by cell, equal
paragraphs cancel, and peeling cells that hold one digest recovers those that differ. A text's sketch has at least ``ROOM``
cells for each of its digests, in sizes that double, so that a larger sketch folds to each smaller size, and two are
compared at the smaller of their sizes. Where peeling gets stuck, or the counts suggest that it would, both are sketched
again with at least twice the cells; beyond sixteen times as many cells as there are digests, the sets themselves are
compared.

The fingerprint is the text's own sketch, at a size that the text alone decides, so equal texts have equal fingerprints. A
cell is its count in 4 bytes, digests in 8 and checks in 4, all counts first. ``fingerprint`` and ``edited_fingerprint`` fold,
subtract and peel to what the two texts differ in without the texts (``recovered``); where their sizes are too small for
that, ``larger_fingerprint`` and ``larger_edited_fingerprint`` hold the sketches that it took, and are null elsewhere.

Likeness is the share of common digests in all digests of both (0 to 1); two texts without any are alike.

``edited`` pairs every document with the next in descending order of ``doc_id``. The table is dealt by ranges of ids, each
row once; the first row of a range also goes to the range before it, and the first of all to the last.

Nulls: a null text is empty; a null ``doc_id`` counts as the lowest id. Rows that repeat an id follow each other in the
order of their texts. In a table of one row the next document is the row itself. An empty table gives no rows.
"""

import base64
import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from .common import slices, texts, values
from .sets import mixed, span_hashes

PARTS = 3
FIRST_CELLS = 15
GROWTH = 2
#: Cells for each digest of a text: enough for two versions that differ in half of their digests each.
ROOM = 2
RANGES_PER_PARTITION = 4

#: Characters whose hash decides whether a piece ends after them; characters to a piece, on average and at most.
WINDOW, PIECE = 4, 24
LONGEST = 8 * PIECE
#: Characters whose pieces are hashed at once.
HASHED = 1 << 20
_ENDS = np.zeros(1 << 16, dtype=bool)
_ENDS[[ord(c) for c in "\n.!?。！？"]] = True
_SPACE = np.array([chr(k).isspace() for k in range(0x3001)] + [False])
_FACTORS = [np.uint32(x) for x in (0xBF58476D, 0x1CE4E5B9, 0x94D049BB, 0x133111EB)]
SHIFTS = np.array([[0], [21], [42]], dtype=np.uint64)
ROWS = np.arange(PARTS, dtype=np.uint64)[:, None]
LOWEST = -(1 << 63)

SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, larger_fingerprint string, larger_edited_fingerprint string"
)


def pieces(codes):
    """Where the paragraphs of a text begin and end, white space around them left out; ``codes`` are its code points."""
    cut = _ENDS.take(codes, mode="clip")
    cut[:-1] &= ~cut[1:]
    n = len(codes) - WINDOW + 1
    if n > 0:
        rolled = codes[:n] * _FACTORS[0]
        for k in range(1, WINDOW):
            rolled += codes[k : k + n] * _FACTORS[k]
        cut[WINDOW - 1 :] |= rolled < np.uint32((1 << 32) // PIECE)
    at = np.concatenate(([0], np.flatnonzero(cut) + 1, [len(codes)]))
    wide = np.flatnonzero(np.diff(at) > LONGEST).tolist()
    if wide:
        at = np.unique(np.concatenate([at, *(np.arange(at[k], at[k + 1], LONGEST) for k in wide)]))
    starts, ends = at[:-1], at[1:]
    # The next character from each start that is no white space, and the last one before each end.
    black = np.flatnonzero(~_SPACE.take(codes, mode="clip"))
    first, last = np.searchsorted(black, starts), np.searchsorted(black, ends) - 1
    full = first <= last
    return black[first[full]], black[last[full]] + 1


def digests(text):
    """The distinct digests of a text's paragraphs."""
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(codes):
        return np.empty(0, np.uint64)
    starts, ends = pieces(codes)
    found, k = [np.empty(0, np.uint64)], 0
    while k < len(starts):
        # Pieces are short, so a stretch holds about as many characters as it may.
        n = max(k + 1, int(np.searchsorted(ends, starts[k] + HASHED, side="right")))
        found.append(span_hashes(mixed(codes[starts[k] : ends[n - 1]].astype(np.uint64) + np.uint64(1)), starts[k:n] - starts[k], ends[k:n] - starts[k]))
        k = n
    found = np.sort(np.concatenate(found))
    new = np.concatenate(([True], found[1:] != found[:-1]))[: len(found)]
    firsts = np.flatnonzero(new)
    time = np.arange(len(found)) - np.repeat(firsts, np.diff(np.concatenate((firsts, [len(found)]))))
    return np.unique(mixed(found + time.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))


def places(keys, cells):
    """The cells of each digest, one row for each part: from 21 bits of the digest each."""
    each = np.uint64(cells // PARTS)
    return (((keys >> SHIFTS) & np.uint64(0x1FFFFF)) % each + each * ROWS).astype(np.int64)


def put(cells, keys, sign):
    """Adds digests to the cells, or takes them away: ``sign`` is an array of 1 and -1."""
    count, key, check = cells
    at = places(keys, len(count)).ravel()
    np.add.at(count, at, np.concatenate([sign] * PARTS))
    np.bitwise_xor.at(key, at, np.concatenate([keys] * PARTS))
    np.bitwise_xor.at(check, at, np.concatenate([mixed(keys)] * PARTS))


def sketch(keys, cells=FIRST_CELLS):
    """Counts, digests and checks of the cells."""
    made = np.zeros(cells, np.int64), np.zeros(cells, np.uint64), np.zeros(cells, np.uint64)
    put(made, keys, np.ones(len(keys), np.int64))
    return made


def folded(made, cells):
    """A sketch at a smaller size of the same series: cells that share a remainder fall together."""
    if len(made[0]) == cells:
        return made
    count, key, check = (x.reshape(PARTS, -1, cells // PARTS) for x in made)
    return count.sum(axis=1).ravel(), np.bitwise_xor.reduce(key, axis=1).ravel(), np.bitwise_xor.reduce(check, axis=1).ravel()


def subtract(a, b):
    return a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]


def peel(difference):
    """The digests only in the first and only in the second set, or None if some could not be recovered."""
    count, key, check = (x.copy() for x in difference)
    mine, theirs = [], []
    while True:
        pure = np.flatnonzero(np.abs(count) == 1)
        pure = pure[mixed(key[pure]).astype(np.uint32) == check[pure].astype(np.uint32)]
        if not len(pure):
            break
        keys, first = np.unique(key[pure], return_index=True)
        sign = count[pure][first]
        mine.append(keys[sign > 0])
        theirs.append(keys[sign < 0])
        put((count, key, check), keys, -sign)
    if count.any() or key.any() or check.astype(np.uint32).any():
        return None
    none = [np.empty(0, np.uint64)]
    return np.concatenate(mine + none), np.concatenate(theirs + none)


class Version:
    """A text's digests and its sketches, made when asked for."""

    def __init__(self, text):
        self.text, self.keys, self.made = text, digests(text), {}
        self.cells = FIRST_CELLS
        while self.cells < ROOM * len(self.keys):
            self.cells *= GROWTH

    def sketch(self, cells=FIRST_CELLS):
        if cells not in self.made:
            self.made[cells] = folded(self.sketch(self.cells), cells) if cells < self.cells else sketch(self.keys, cells)
        return self.made[cells]

    def fingerprint(self, cells=None):
        count, key, check = self.sketch(cells or self.cells)
        return base64.b64encode(count.astype("<i4").tobytes() + key.astype("<u8").tobytes() + check.astype("<u4").tobytes()).decode()


def loaded(fingerprint):
    """The sketch that a fingerprint holds."""
    data = base64.b64decode(fingerprint)
    n = len(data) // 16
    return tuple(np.frombuffer(data, t, n, at * n) for t, at in (("<i4", 0), ("<u8", 4), ("<u4", 12)))


def recovered(a, b):
    """What the texts of two fingerprints differ in, from these alone; None if they are too small for it."""
    a, b = loaded(a), loaded(b)
    cells = min(len(a[0]), len(b[0]))
    return peel(subtract(folded(a, cells), folded(b, cells)))


def difference(a, b):
    """What two versions differ in, and the cells that it took (0: the sets were compared)."""
    cells, total = min(a.cells, b.cells), len(a.keys) + len(b.keys)
    while cells <= max(FIRST_CELLS, 16 * total):
        apart = subtract(a.sketch(cells), b.sketch(cells))
        # Differing digests count +1 or -1 in a cell of each part, so the squares sum up to about as many.
        likely = ((apart[0] ** 2).sum() - apart[0].sum() ** 2 / cells) / PARTS
        if 1.2 * likely < cells:
            found = peel(apart)
            if found:
                return *found, cells
        cells *= GROWTH
        while cells < 1.6 * likely:
            cells *= GROWTH
    return np.setdiff1d(a.keys, b.keys), np.setdiff1d(b.keys, a.keys), 0


def share(a, b, apart):
    total = len(a.keys) + len(b.keys)
    return (total - apart) / (total + apart) if total else 1.0


def likeness(a, b):
    mine, theirs, _ = difference(a, b)
    return share(a, b, len(mine) + len(theirs))


def edit(text, following):
    """The text with its last half replaced by as much of the beginning of the following one."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def ranges_of(documents, n):
    """Lower bounds of ``n`` ranges in descending order of ids, the first id of each range, and the range before it."""
    ids = documents.select("order_id")
    bounds = ids.agg(F.percentile_approx("order_id", [i / n for i in range(n - 1, 0, -1)], F.lit(10_000))).first()[0] if n > 1 else []
    bounds = sorted(set(bounds or []), reverse=True)
    firsts = {r.range: r.first for r in ids.groupBy(place(bounds).alias("range")).agg(F.max("order_id").alias("first")).collect()}
    filled = sorted(firsts)
    before = {r: filled[i - 1] for i, r in enumerate(filled)}
    n = len(bounds) + 1
    return bounds, [firsts.get(r) for r in range(n)], [before.get(r) for r in range(n)]


def place(bounds):
    """The range of an id: how many bounds are above it."""
    if not bounds:
        return F.lit(0)
    return F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b > F.col("order_id")))


def edited(documents):
    """The contract's columns for every document."""
    spark = documents.sparkSession
    source = documents.select(
        F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(LOWEST)).alias("order_id"),
    )
    n = RANGES_PER_PARTITION * int(spark.conf.get("spark.sql.shuffle.partitions"))
    bounds, firsts, before = ranges_of(source, n)

    def pick(items):
        return F.element_at(F.array(*(F.lit(x).cast("long") for x in items)), F.col("range") + 1)

    own = F.struct(F.col("range").cast("long").alias("range"), F.lit(0).alias("extra"))
    copy = F.struct(pick(before).alias("range"), F.lit(1).alias("extra"))
    dealt = (
        source.withColumn("range", place(bounds))
        .withColumn("to", F.explode(F.when(F.col("order_id") == pick(firsts), F.array(own, copy)).otherwise(F.array(own))))
        .select("doc_id", "order_id", "text", "to.range", "to.extra")
        .repartition("range").sortWithinPartitions("range", "extra", F.desc("order_id"), "text")
    )

    def run(batches):
        at, pending, closed = None, None, False
        for batch in slices(batches):
            out = []
            rows = zip(*(values(batch, c).to_pylist() for c in ("doc_id", "range", "extra")), texts(batch), strict=True)
            for doc_id, range_, extra, text in rows:
                if range_ != at:
                    at, pending, closed = range_, None, False
                if closed:
                    continue
                version = Version(text)
                if pending:
                    previous_id, previous = pending
                    changed = Version(edit(previous.text, text))
                    mine, theirs, cells = difference(previous, changed)
                    larger = cells if cells > min(previous.cells, changed.cells) else 0
                    out.append((
                        previous_id, len(previous.text), hashlib.sha256(changed.text.encode()).hexdigest(),
                        previous.fingerprint(), changed.fingerprint(),
                        share(previous, changed, len(mine) + len(theirs)), likeness(previous, version),
                        *(x.fingerprint(larger) if larger else None for x in (previous, changed)),
                    ))
                pending, closed = (doc_id, version), bool(extra)
            if out:
                arrays = list(map(list, zip(*out, strict=True)))
                kinds = [pa.int64()] * 2 + [pa.string()] * 3 + [pa.float64()] * 2 + [pa.string()] * 2
                names = [x.split()[0] for x in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(a, k) for a, k in zip(arrays, kinds, strict=True)], names)

    return dealt.mapInArrow(run, SCHEMA)
