"""Operator 10: similarity join on sets of word shingles by token-combination prefixes, and the groups that its links make.

Two sets link when ``intersection / union >= percent / 100``. Rows with equal sets are one class; what follows works on
classes.

1. A table of ``CELLS`` counters, added up over all tasks, tells roughly how frequent the tokens of each hash cell are. Its
   size does not depend on the input. All sets order their tokens by it, rare ones first.
2. Linked sets share a token among the first ``n - ceil(n * percent / 100) + 1`` of each, their prefixes, whatever the
   order is, as long as it is one for all sets. Rare tokens of a prefix are indexed as single tokens.
3. Where the prefix reaches into frequent tokens, single ones would meet far too many sets. Then the prefix is extended to
   the whole set: its tokens are dealt by hash into more classes than two linked sets can differ in, so linked sets agree on
   a whole class, and the combination of all tokens of a class is indexed. If the first token that two linked sets share
   is frequent, both prefixes hold a frequent one and both sets emit combinations, so they meet in one.
4. A list of up to ``LIST`` classes gives its pairs, those of sizes that can link. A pair goes if its profiles show that it
   has no link: the tokens of a set, counted by hash buckets, have at most the lesser count of each bucket in common. A
   longer list ties its classes, those of the same or neighbouring size ranges.
5. ``families`` compares what is tied, directly or not, on whole sets, exactly.

Nothing that grows is broadcast or sent to the driver, no list or family meets in one task, and no pairs within a group are
emitted. Texts cross the network once, at every size by the same plan. Tokens and combinations are 64-bit hashes.

Nulls: a null text is empty. A document without words has an empty set and no links. A document with a null ``doc_id``
stays alone, with a null ``component_id``. Rows that repeat an id are separate rows, linked if their texts are; if rows of
one id lie in different groups, these count as one. A very long text is a slice of its own, and its whole set is indexed
and compared. Ties in the order go to the smaller token hash. Only ``doc_id`` and ``text`` are read, so further columns may
have any name. An empty table gives no rows.
"""

import math
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import families
from .common import release, slices, texts, values
from .sets import components, digests, kept_small, mixed, shingle_sets

SHINGLE = 3
PERCENT = 90

#: Counters of the frequency table, the slices it is added up in, and how far above the mean a frequent token's counter is.
CELLS, SLICES, FREQUENT = 1 << 22, 16, 8
#: Classes of a list that gives pairs.
LIST = 24


class Ranges:
    """Size ranges, and for each the number of classes its sets are dealt into."""

    def __init__(self, percent=PERCENT):
        self.percent, self.starts, self.dealt = percent, [1], {}

    def of(self, n):
        while self.starts[-1] <= n:
            self.starts.append(self.starts[-1] * 100 // self.percent + 1)
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    def classes(self, r):
        """Into how many classes range ``r`` is dealt, and in how many tokens a linked pair can differ whose smaller
        set is in the range. A few more classes than that, so that more of them than that have tokens."""
        if r not in self.dealt:
            self.of(self.starts[r])
            differ = (self.starts[r + 1] - 1) * (100 - self.percent) // self.percent
            n = differ + 1
            while differ and n < 2 * differ + 6:
                empty = n * math.exp(-self.starts[r] / n)
                if n - empty - 4 * math.sqrt(empty) >= differ + 1:
                    break
                n += 1
            self.dealt[r] = (n, differ)
        return self.dealt[r]

    def combinations(self, tokens):
        """The hashes of the combinations that a sorted set is indexed by.

        Classes without tokens are left out if more than ``differ`` others have some, as one of those then agrees.
        """
        n = len(tokens)
        if not n:
            return np.empty(0, np.uint64)
        own = self.of(n)
        out = []
        for r in (own, own - 1):
            if r < 0 or (self.starts[r + 1] - 1) * 100 < n * self.percent:
                continue
            classes, differ = self.classes(r)
            at = (tokens >> np.uint64(33)).astype(np.int64) % classes
            order = np.argsort(at, kind="stable")
            at, held = at[order], mixed(tokens[order] ^ np.uint64(r + 1))
            firsts = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
            total = np.add.reduceat(held, firsts)
            sizes = np.diff(np.concatenate((firsts, [n]))).astype(np.uint64)
            full = at[firsts]
            if len(full) <= differ:
                none = np.setdiff1d(np.arange(classes), full)
                full = np.concatenate((full, none))
                total, sizes = (np.concatenate((x, np.zeros(len(none), np.uint64))) for x in (total, sizes))
            salt = np.uint64(r * 1_000_003 + 17)
            out.append(mixed(total + mixed(full.astype(np.uint64) * np.uint64(2_654_435_761) + sizes + salt)))
        return np.concatenate(out)


def _cells(tokens):
    return (tokens >> np.uint64(20)).astype(np.int64) % CELLS


def profile(tokens):
    """How many tokens of a set lie in each of about as many buckets; nothing where a byte cannot hold a count."""
    buckets = 1 << max(3, int(len(tokens) / 1.5).bit_length())
    counts = np.bincount((tokens >> np.uint64(4)).astype(np.int64) & (buckets - 1), minlength=buckets)
    return counts.astype(np.uint8).tobytes() if counts.max(initial=0) < 256 else b""


def may_link(a, b, percent):
    """Whether two profiles leave room for a link; buckets of the longer one fold into those of the other."""
    if not a or not b:
        return True
    a, b = (np.frombuffer(x, np.uint8).astype(np.int64) for x in (a, b))
    least = min(len(a), len(b))
    a, b = (x.reshape(-1, least).sum(axis=0) for x in (a, b))
    both = np.minimum(a, b).sum()
    return 100 * both >= percent * (a.sum() + b.sum() - both)


def described(documents, size=SHINGLE):
    """For every row its set's size, digest and profile; and the counters of every task, as rows with a ``slice``."""

    def run(batches):
        counts, width = np.zeros(CELLS, np.uint8), CELLS // SLICES

        def rows(n, ids, sizes, high, low, profiles, at, data):
            columns = [ids, sizes, high, low, profiles, at, data]
            kinds = [pa.int64()] * 4 + [pa.binary(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, k) if c is None else c.cast(k) for c, k in zip(columns, kinds, strict=True)],
                ["doc_id", "n", "high", "low", "profile", "slice", "counts"],
            )

        for batch in slices(batches):
            sets = shingle_sets(texts(batch), size)
            sizes = pa.array([len(x) for x in sets], pa.int64())
            profiles = pa.array([profile(x) for x in sets], pa.binary())
            yield rows(len(sets), values(batch, "doc_id"), sizes, *digests(sets), profiles, None, None)
            cells, n = np.unique(_cells(np.concatenate(sets)), return_counts=True)
            # An order is all that is wanted, so a counter may stop at its end.
            counts[cells] = np.minimum(counts[cells] + n, 255).astype(np.uint8)
        parts = [zlib.compress(counts[k * width : (k + 1) * width].tobytes(), 1) for k in range(SLICES)]
        yield rows(SLICES, None, None, None, None, None, pa.array(range(SLICES)), pa.array(parts, pa.binary()))
        del counts, parts
        release()

    layout = "doc_id long, n long, high long, low long, profile binary, slice int, counts binary"
    return documents.mapInArrow(run, layout)


def frequencies(found):
    """The table of counters, of a fixed size whatever the input."""
    width = CELLS // SLICES

    def add(table):
        total = np.zeros(width, np.int64)
        for part in table["counts"].to_pylist():
            total += np.frombuffer(zlib.decompress(part), np.uint8)
        mean = max(1.0, total.mean())
        # Steps of a fraction of the mean, so that all tables fit the same few bytes.
        steps = np.minimum(total * 256 / mean, 65535).astype("<u2")
        return pa.table({"slice": table["slice"][:1], "steps": pa.array([steps.tobytes()], pa.binary())})

    parts = found.where("slice IS NOT NULL").select("slice", "counts").groupBy("slice").applyInArrow(add, "slice int, steps binary")
    table = np.zeros(CELLS, np.uint16)
    for part in parts.collect():
        table[part.slice * width : (part.slice + 1) * width] = np.frombuffer(part.steps, "<u2")
    return table


def can_link(n, percent):
    """Whether a set of this size can link with one that differs."""
    return n * 100 // percent > n or -(-n * percent // 100) < n


def index_values(tokens, table, ranges):
    """What a set is indexed by: rare tokens of its prefix, and combinations where the prefix holds frequent ones."""
    n = len(tokens)
    if not can_link(n, ranges.percent):
        return np.empty(0, np.uint64)
    often = table[_cells(tokens)]
    prefix = np.argsort(often, kind="stable")[: n + (-n * ranges.percent // 100) + 1]
    rare = often[prefix] <= FREQUENT * 256
    single = tokens[prefix[rare]]
    return single if rare.all() else np.concatenate((single, ranges.combinations(tokens)))


def entries(documents, table, size=SHINGLE, percent=PERCENT):
    """``value``, ``node``, ``n``: the index entries of every set, a repeated text of a task once.

    A node is the first half of a set's digest. Should two sets share it, they are tied without need and told apart when
    they are compared.
    """
    shared = documents.sparkSession.sparkContext.broadcast(table)

    def run(batches):
        ranges, seen = Ranges(percent), set()
        for batch in slices(batches):
            sets = shingle_sets(texts(batch), size)
            nodes = digests(sets)[0].to_numpy()
            found, owners, sizes = [], [], []
            for node, tokens in zip(nodes.tolist(), sets, strict=True):
                if len(tokens) and node not in seen:
                    seen.add(node)
                    found.append(index_values(tokens, shared.value, ranges))
                    owners.append(node)
                    sizes.append(len(tokens))
            if not found:
                continue
            count = [len(x) for x in found]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.concatenate(found).view(np.int64), pa.int64()),
                    pa.array(np.repeat(np.array(owners, np.int64), count), pa.int64()),
                    pa.array(np.repeat(np.array(sizes, np.int64), count), pa.int64()),
                ],
                ["value", "node", "n"],
            )
        del ranges, seen
        release()

    return documents.select("text").mapInArrow(run, "value long, node long, n long")


def _linkable(pairs, classes, percent):
    """The pairs whose profiles leave room for a link."""

    def run(batches):
        for batch in batches:
            x, y = batch.column(2).to_pylist(), batch.column(3).to_pylist()
            yield batch.select(["a", "b"]).filter(pa.array([may_link(p, q, percent) for p, q in zip(x, y, strict=True)], pa.bool_()))
        release()

    nodes = pairs.select("a").union(pairs.select("b")).distinct().toDF("high")
    profiles = kept_small(classes.join(nodes.hint("merge"), "high", "left_semi").select("high", "profile"), "profiles")
    both = pairs.join(profiles.toDF("a", "x").hint("merge"), "a").join(profiles.toDF("b", "y").hint("merge"), "b")
    return both.select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def ties(found, classes, percent=PERCENT):
    """``a``, ``b``: nodes tied by an index value, of which only the closure counts."""
    counts = kept_small(found.groupBy("value").agg(F.count("*").alias("length")).where("length > 1"), "counts")
    held = kept_small(found.join(counts.select("value").hint("merge"), "value").distinct(), "held")
    lengths = kept_small(held.groupBy("value").agg(F.count("*").alias("length")).where("length > 1"), "lengths")
    held = held.join(lengths.hint("merge"), "value")
    members = held.where(F.col("length") <= LIST).groupBy("value").agg(F.array_sort(F.collect_list(F.struct("n", "node"))).alias("x"))
    # In order of size: the later set of a pair is the larger one.
    each = F.expr(f"""flatten(transform(x, (a, i) -> transform(
      filter(slice(x, i + 2, size(x)), b -> 100 * a.n >= {percent} * b.n), b -> struct(a.node AS a, b.node AS b))))""")
    pairs = kept_small(members.select(F.explode(each).alias("pair")).select("pair.a", "pair.b").distinct(), "pairs")
    # Linked sets lie in the same size range or in neighbouring ones; ranges grow by a little more than linked sizes differ.
    size_range = F.floor(F.log(F.col("n").cast("double")) / (1.001 * math.log(100 / percent)))
    ranged = held.where(F.col("length") > LIST).select(
        "value", "node", F.explode(F.array(size_range, size_range + 1)).alias("range")
    )
    least = ranged.groupBy("value", "range").agg(F.min("node").alias("least"))
    stars = ranged.join(least.hint("merge"), ["value", "range"]).where(F.col("node") > F.col("least")).select("node", "least")
    return _linkable(pairs, classes, percent).union(stars)


def groups(documents, size=SHINGLE, percent=PERCENT):
    """``doc_id``, ``n_shingles``, ``component_id`` for every row: the operator's result.

    ``component_id`` is the least ``doc_id`` that can be reached by links.
    """
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    found = kept_small(described(documents, size), "rows")
    rows = found.where("slice IS NULL").select("doc_id", "n", "high", "low", "profile")
    named = rows.where("doc_id IS NOT NULL AND n > 0")
    classes = named.groupBy("high", "low").agg(
        F.min("doc_id").alias("least"), F.max("n").alias("n"), F.first("profile").alias("profile")
    )
    classes = kept_small(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    with_ids = documents.where("doc_id IS NOT NULL")
    indexed = kept_small(entries(with_ids, frequencies(found), size, percent), "index")
    tied = kept_small(components(ties(indexed, classes, percent)), "families")
    tied = classes.join(tied.toDF("node", "family").hint("merge"), F.col("high") == F.col("node")).select("id", "family")
    linked = families.class_components(with_ids, classes, tied, size, percent)
    labels = classes.join(linked.hint("merge"), "id", "left").withColumn("component", F.coalesce("component", "id"))
    names = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = kept_small(labels.join(names.hint("merge"), "component").select("high", "low", "component_id"), "labels")
    out = rows.join(labels.hint("merge"), ["high", "low"], "left").select(
        "doc_id", F.col("n").alias("n_shingles"),
        F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"),
    )
    return _one_group_an_id(out)


def _one_group_an_id(rows):
    """Joins the groups that rows of one id lie in."""
    several = rows.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.min("component_id").alias("a"), F.max("component_id").alias("b"))
    several = kept_small(several.where("a <> b"), "ids")
    if several.isEmpty():
        return rows
    held = rows.join(several.select("doc_id", "a").hint("merge"), "doc_id")
    joined = components(held.select("a", F.col("component_id").alias("b")))
    return rows.join(joined.toDF("component_id", "joined").hint("merge"), "component_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("joined", "component_id").alias("component_id")
    )


def join(documents, size=SHINGLE, percent=PERCENT):
    """The contract's columns."""
    return groups(documents, size, percent)


def sql(size=SHINGLE, percent=PERCENT):
    """The same in DuckDB's SQL: all pairs that share a shingle, then the least id reached over links."""
    return rf"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(ws[k:k + least(len(ws), {size}) - 1], ' ') AS sh
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(2, len(ws) - {size} + 2))) AS k FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS k FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * k >= {percent} * (nx.n + ny.n - k)),
r AS (SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT r.x, l.y FROM r JOIN l ON l.x = r.y)
SELECT w.doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id JOIN (SELECT x, min(y) AS component_id FROM r GROUP BY x) c ON c.x = w.doc_id
"""
