"""Sets of word shingles: hashing, overlaps, and the groups that links make."""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallywharf.sources.workspace import ensure_checkpoints, fresh_folder

#: Links to a task of the steps that find components.
LINKS_PER_TASK = 100_000

_MIX = [np.uint64(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(x):
    """A bijection of 64-bit integers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _MIX[0]
    x = (x ^ (x >> np.uint64(27))) * _MIX[1]
    return x ^ (x >> np.uint64(31))


#: Bytes whose words are hashed at once; a longer word is taken whole.
HASHED_BYTES = 1 << 18

#: A value for every byte, an odd base, and its inverse modulo 2 ** 64.
_VALUES = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_BASE = 0xD1342543DE82EF95
_INVERSE = pow(_BASE, -1, 1 << 64)
_SPACE = np.isin(np.arange(256), [0x20, *range(0x09, 0x0E)])


class _Powers:
    """Powers of the base and of its inverse, as many as were needed so far."""

    up = down = np.ones(0, np.uint64)

    @classmethod
    def first(cls, n):
        if len(cls.up) < n:
            size = max(n, HASHED_BYTES)
            with np.errstate(over="ignore"):
                cls.up, cls.down = (np.cumprod(np.full(size, x, np.uint64)) for x in (_BASE, _INVERSE))
        return cls.up[:n], cls.down


def span_hashes(values, starts, ends):
    """The hashes of spans of 64-bit values.

    A span's values are the coefficients of a polynomial in the base, so it is worth a difference of two running sums.
    """
    up, down = _Powers.first(len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up, out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def _word_hashes(data):
    """The start of every word in bytes that begin and end between words, and its hash."""
    edges = np.flatnonzero(np.diff(np.concatenate(([True], _SPACE[data], [True]))))
    starts, ends = edges[::2], edges[1::2]
    return starts, span_hashes(_VALUES[data], starts, ends)


def hashed_words(texts_):
    """The hashes of all words of all texts in a row, and how many each text has."""
    # Of bytes, lower() turns A-Z alone.
    parts = [x.encode().lower() for x in texts_]
    firsts = np.cumsum([0] + [len(x) + 1 for x in parts])
    data = np.frombuffer(b" ".join(parts) + b" ", np.uint8)
    found, at = [(np.empty(0, np.int64), np.empty(0, np.uint64))], 0
    while at < len(data):
        end = min(at + HASHED_BYTES, len(data))
        while end < len(data):
            # Up to the last space of the stretch, or on to the next one if a word fills it.
            cut = np.flatnonzero(_SPACE[data[at:end]])
            if len(cut):
                end = at + int(cut[-1]) + 1
                break
            end = min(end + HASHED_BYTES, len(data))
        starts, hashes = _word_hashes(data[at:end])
        found.append((starts + at, hashes))
        at = end
    starts, flat = (np.concatenate(x) for x in zip(*found, strict=True))
    return flat, np.diff(np.searchsorted(starts, firsts))


def shingle_sets(texts_, size):
    """For each text its sorted distinct shingle hashes; a shorter text is one shingle."""
    flat, counts = hashed_words(texts_)
    ends = np.cumsum(counts)
    # All runs of words at once; those that reach over the end of a text are left out below.
    runs = np.full(max(0, len(flat) - size + 1), size, dtype=np.uint64)
    for j in range(size):
        runs = mixed(runs + flat[j : len(flat) - size + 1 + j])
    sets = []
    for n, end in zip(counts.tolist(), ends.tolist()):
        if n >= size:
            found = np.sort(runs[end - n : end - size + 1])
            new = np.concatenate(([True], found[1:] != found[:-1]))
            sets.append(found if new.all() else found[new])
            continue
        whole = np.full(min(n, 1), n, dtype=np.uint64)
        for j in range(n):
            whole = mixed(whole + flat[end - n + j])
        sets.append(whole)
    return sets


def digests(sets):
    """128 bits of each sorted set, as two columns of signed 64-bit integers."""
    import xxhash

    flat = b"".join(xxhash.xxh3_128_digest(x.tobytes()) for x in sets)
    both = np.frombuffer(flat, "<i8").reshape(-1, 2)
    return pa.array(both[:, 0], pa.int64()), pa.array(both[:, 1], pa.int64())


def kept_small(frame, purpose):
    """The frame written to the shared folder and read again, so that a join knows its true size when it is planned."""
    folder = fresh_folder(frame.sparkSession, purpose)
    frame.write.parquet(folder)
    return frame.sparkSession.read.schema(frame.schema).parquet(folder)


def components(links):
    """``id``, ``component``: every id in ``links`` (a, b) with the least id it can reach.

    Large-star and small-star steps in turn until nothing changes; each is a grouping of the links, and every round is
    written to the checkpoint folder.
    """
    ensure_checkpoints(links.sparkSession)
    current = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct().checkpoint()

    def signature(frame):
        # Spark adds up hashes of the links: equal sums in two rounds mean equal links.
        return tuple(frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first())

    seen, now = None, signature(current)
    # Steps only ever join links, so the first count bounds the tasks that a step needs.
    tasks = max(4, math.ceil(now[0] / LINKS_PER_TASK))
    while now != seen:
        both = current.union(current.select(F.col("b").alias("a"), F.col("a").alias("b"))).coalesce(tasks)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m")).coalesce(tasks)
        large = (
            both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .coalesce(tasks).distinct().coalesce(tasks)
        )
        low = large.groupBy("a").agg(F.min("b").alias("m")).coalesce(tasks)
        small = (
            large.join(low, "a")
            .select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("x"))
            .select("x.a", "x.b").where("a <> b").coalesce(tasks).distinct()
        )
        current = small.coalesce(tasks).checkpoint()
        seen, now = now, signature(current)
    roots = current.select("b", "b").toDF("id", "component").distinct()
    return current.toDF("id", "component").union(roots)


class Union:
    def __init__(self, n):
        self.up = list(range(n))

    def top(self, i):
        while self.up[i] != i:
            self.up[i] = self.up[self.up[i]]
            i = self.up[i]
        return i

    def join(self, i, j):
        self.up[self.top(i)] = self.top(j)


def overlaps(left, right):
    """Of each left set with each right set the size of the intersection, one row at a time."""
    tokens = np.concatenate(right) if right else np.empty(0, np.uint64)
    owner = np.repeat(np.arange(len(right)), [len(x) for x in right])
    order = np.argsort(tokens, kind="stable")
    tokens, owner = tokens[order], owner[order]
    for x in left:
        a, b = np.searchsorted(tokens, x), np.searchsorted(tokens, x, side="right")
        n = b - a
        hit = n > 0
        starts, n = a[hit], n[hit]
        at = np.repeat(starts - np.concatenate(([0], np.cumsum(n)[:-1])), n) + np.arange(n.sum()) if len(n) else np.empty(0, np.int64)
        yield np.bincount(owner[at], minlength=len(right))


def link_rows(left, right, percent):
    """For each left set the numbers of the right sets it links with."""
    sizes = np.array([len(x) for x in right])
    for x, both in zip(left, overlaps(left, right), strict=True):
        yield np.flatnonzero(100 * both >= percent * (len(x) + sizes - both))
