"""Operator 13: the trie of all prefixes of conversations, built as double arrays in prefix shards.

1. Turns are put in order by ranges of (conversation, turn), so a conversation of any length is spread over tasks; a turn
   becomes the 128-bit digest of its role and text, and the number of words of its text.
2. A conversation is cut into segments of ``SEGMENT`` turns. A segment's start is the digest of all turns before it, so
   segments with equal starts are the paths of one sub-trie. Equal paths are counted before anything is shuffled further.
3. Paths are sorted and dealt by ranges into prefix shards of about ``SHARD_TURNS`` turns. In each shard turns get dense
   ids, and the paths are packed into a double array: a node's child for id ``c`` is at ``BASE[node] + c``, and ``CHECK``
   there names the node. Paths are then walked through the arrays, and every node on the way gathers its path's members,
   least member, new children, childless ends and words.
4. Each quantity is a sum or a least value over paths, each of which lies in one shard, so the nodes that neighbouring
   shards share are merged by adding up. For that a shard knows how many turns its first path has in common with the last
   path before it, and whether the next shard's first path extends its last one: two numbers for each shard.
5. Totals of the sub-tries below a path are added along the conversation that holds their least member.

Rules: turns are ordered by number, null first, then by role and by the digest of role and text; repeated rows are turns
like others. Rows without ``conv_id`` belong to no conversation. A null role or text is empty. ``%`` keeps the sign of the
number before it, as in SQL. Further columns may have any name. An empty table has no conversations and no nodes.

A node's ids are hashed in numeric order, in blocks from ranges of (node, conversation); SHA-256 itself cannot be split,
so the blocks of one node stream through one task, which holds one block at a time.
"""

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F

from .common import crc_sql, crc_table_sql
from .sets import kept_small

#: Turns of a segment, turns of all paths of a shard, ids of a block that is hashed.
SEGMENT, SHARD_TURNS, BLOCK_IDS = 256, 1 << 18, 1 << 14
#: Bytes of a turn's digest.
WIDTH = 16
#: Every conversation opens with the head of the one whose id is the last multiple of this, with fewer turns than that.
BASES, HEADS = 20, 4

_EMPTY = hashlib.sha256(b"").hexdigest()
_STEPS = "conv_id long, part int, place long, digest binary, words long"


def turns(conversations):
    """``conv_id``, ``place`` (from 0), ``digest``, ``words`` of every turn, whatever conversation holds most of them."""
    spark = conversations.sparkSession
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    rows = conversations.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long"), "turn", role.alias("role"),
        F.unhex(F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))).alias("digest"),
        F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long").alias("words"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "role", "digest"]
    ranged = rows.repartitionByRange(_tasks(spark), *order).sortWithinPartitions(*order)

    def run(batches):
        last, before = None, 0
        for batch in batches:
            ids = batch.column(0).to_numpy()
            if not len(ids):
                continue
            new = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            place = np.arange(len(ids)) - np.repeat(new, np.diff(np.concatenate((new, [len(ids)]))))
            if ids[0] == last:
                place[: new[1] if len(new) > 1 else len(ids)] += before
            last, before = ids[-1], int(place[-1]) + 1
            part = pa.array(np.full(len(ids), batch.column(3)[0].as_py(), np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), part, pa.array(place, pa.int64()), batch.column(1), batch.column(2)],
                ["conv_id", "part", "place", "digest", "words"],
            )

    numbered = ranged.select("conv_id", "digest", "words", F.spark_partition_id().alias("part")).mapInArrow(run, _STEPS)
    numbered = kept_small(numbered, "turns")
    # A part begins inside at most one conversation, so there are no more offsets than parts.
    counts = numbered.groupBy("conv_id", "part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = counts.withColumn("before", before).where("before IS NOT NULL").select("conv_id", "part", "before")
    return numbered.join(F.broadcast(offsets), ["conv_id", "part"], "left").select(
        "conv_id", (F.col("place") + F.coalesce("before", F.lit(0))).alias("place"), "digest", "words"
    )


def _tasks(spark):
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def rebuilt(conversations):
    """Segments of every rebuilt conversation: (conv_id, segment, path, words), at least one for each conversation.

    ``path`` holds the digests of the segment's turns one after the other, ``words`` their words.
    """
    own = turns(conversations)
    shared = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).alias("shared")
    convs = own.groupBy("conv_id").agg(F.count("*").alias("n")).select(
        "conv_id", "n", shared, (F.col("conv_id") - F.col("conv_id") % BASES).alias("base")
    )
    # A head has fewer than HEADS turns and belongs to fewer than 2 * BASES conversations.
    heads = own.where((F.col("conv_id") % BASES == 0) & (F.col("place") < HEADS)).groupBy("conv_id").agg(
        F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("head")
    )
    convs = convs.join(heads.withColumnRenamed("conv_id", "base"), "base", "left").select(
        "conv_id", "shared",
        F.coalesce(F.slice("head", F.lit(1), F.col("shared").cast("int")), F.expr("array()").cast("array<struct<place:long,digest:binary,words:long>>")).alias("head"),
    )
    convs = kept_small(convs.withColumn("opening", F.size("head")), "conversations")
    rest = own.join(convs.select(F.col("conv_id").alias("c"), "shared", "opening").hint("merge"), F.col("conv_id") == F.col("c"))
    rest = rest.where("place >= shared").select("conv_id", (F.col("opening") + F.col("place") - F.col("shared")).alias("place"), "digest", "words")
    first = convs.select("conv_id", F.explode("head").alias("x")).select("conv_id", "x.place", "x.digest", "x.words")
    return segments(first.union(rest), convs.select("conv_id"))


def segments(rows, convs):
    """The segments of turns (conv_id, place, digest, words); a conversation in ``convs`` without turns has an empty one."""
    segment = (F.col("place") / SEGMENT).cast("long").alias("segment")
    cut = rows.groupBy("conv_id", segment).agg(F.array_sort(F.collect_list(F.struct("place", "digest", "words"))).alias("x")).select(
        "conv_id", "segment", F.unhex(F.array_join(F.transform("x", lambda t: F.hex(t["digest"])), "")).alias("path"),
        F.col("x.words").alias("words"),
    )
    empty = convs.join(rows.select("conv_id").distinct(), "conv_id", "left_anti").select(
        "conv_id", F.lit(0).cast("long"), F.lit(b""), F.expr("array()").cast("array<long>")
    )
    return cut.union(empty)


def _starts(paths):
    """The segments with their ``start``, the digest of all turns before, and ``more``, whether the conversation goes on.

    A start is the digest of the start before and the path before, so starts follow one another; only conversations of
    several segments are gathered, as digests.
    """
    own = Window.partitionBy("conv_id").orderBy("segment")
    sized = paths.withColumn("after", F.lead("segment").over(own).isNotNull())

    def run(table):
        table = table.sort_by("segment")
        at, out = b"", []
        for path in table["path"].to_pylist():
            out.append(at)
            at = hashlib.md5(at + path).digest()
        return pa.table({"conv_id": table["conv_id"], "segment": table["segment"], "start": pa.array(out, pa.binary())})

    long_ones = sized.where("segment > 0").select("conv_id").distinct()
    chains = paths.join(long_ones, "conv_id", "left_semi").select("conv_id", "segment", "path")
    starts = chains.groupBy("conv_id").applyInArrow(run, "conv_id long, segment long, start binary")
    return sized.join(starts, ["conv_id", "segment"], "left").select(
        "conv_id", "segment", F.coalesce("start", F.lit(b"")).alias("start"), "path", "words", F.col("after").alias("more")
    )


class DoubleArray:
    """A trie over paths of dense ids: the child of ``node`` for id ``c`` is ``base[node] + c`` where ``check`` there is ``node``."""

    ROOT = 0

    def __init__(self, paths):
        """``paths`` are lists of ids, sorted and distinct."""
        self.base, self.check = np.zeros(1, np.int64), np.full(1, -2, np.int64)
        self.free = 1
        todo = [(self.ROOT, 0, len(paths), 0)]
        while todo:
            node, a, b, depth = todo.pop()
            children, first = [], a
            while first < b:
                if len(paths[first]) == depth:
                    first += 1
                    continue
                c, last = paths[first][depth], first + 1
                while last < b and paths[last][depth] == c:
                    last += 1
                children.append((c, first, last))
                first = last
            if not children:
                continue
            base = self._place([c for c, _, _ in children])
            self.base[node] = base
            for c, first, last in children:
                self.check[base + c] = node
                todo.append((base + c, first, last, depth + 1))

    def _grow(self, size):
        if size > len(self.check):
            more = max(size, 2 * len(self.check)) - len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int64)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int64)))

    def _place(self, children):
        """The first base at which the places of all children are free; a base may be negative."""
        low, high = children[0], children[-1]
        while self.free < len(self.check) and self.check[self.free] != -1:
            self.free += 1
        at = self.free
        steps = np.array(children) - low
        while True:
            self._grow(at + high - low + 1)
            if (self.check[at + steps] == -1).all():
                return at - low
            at += 1
            while at < len(self.check) and self.check[at] != -1:
                at += 1

    def walk(self, nodes, ids):
        """The children of ``nodes`` for ``ids``; every one of them must be there."""
        at = self.base[nodes] + ids
        assert (self.check[at] == nodes).all()
        return at


_NODES = (
    "depth long, node binary, parent binary, later boolean, n_convs long, conv_id long, n_children long, n_leaves long, "
    "saved_tokens long"
)


def _common(a, b):
    """How many leading turns two paths have in common."""
    n = min(len(a), len(b)) // WIDTH
    k = 0
    while k < n and a[k * WIDTH : (k + 1) * WIDTH] == b[k * WIDTH : (k + 1) * WIDTH]:
        k += 1
    return k


def _rows(table):
    """The paths of a shard in order, with what each adds to the nodes on it.

    ``common`` is how many turns a path shares with the one before, -1 in another sub-trie. A path that the next one
    extends is no leaf; where it ends a segment that goes on, the leaves below have been counted.
    """
    rows = sorted(table.to_pylist(), key=lambda r: (r["segment"], r["start"], r["path"]))
    tries = [(r["segment"], r["start"]) for r in rows]
    for k, r in enumerate(rows):
        if k:
            r["common"] = _common(rows[k - 1]["path"], r["path"]) if tries[k] == tries[k - 1] else -1
        if k + 1 < len(rows):
            r["extended"] = tries[k] == tries[k + 1] and rows[k + 1]["path"].startswith(r["path"])
        r["leaves"] = 0 if r["extended"] else r["leaves"] if r["more"] else 1
    return rows, tries


def shard_nodes(segment_turns):
    """The nodes of one shard, each with what the shard's paths add to it."""

    def run(table):
        rows, tries = _rows(table)
        # Dense ids: the sub-tries first, then the turns, each in order, so that sorted paths stay sorted.
        roots = {x: k for k, x in enumerate(sorted(set(tries)))}
        cut = [[r["path"][k : k + WIDTH] for k in range(0, len(r["path"]), WIDTH)] for r in rows]
        dense = {x: k + len(roots) for k, x in enumerate(sorted({x for path in cut for x in path}))}
        paths = [[roots[t]] + [dense[x] for x in path] for t, path in zip(tries, cut, strict=True)]
        trie = DoubleArray(paths)

        def column(name):
            return np.array([r[name] for r in rows], np.int64)

        n, common, leaves, saved = (column(x) for x in ("n", "common", "leaves", "saved"))
        lengths = np.array([len(x) for x in cut])
        deepest = int(lengths.max())
        ids, words = (np.zeros((len(rows), deepest + 1), np.int64) for _ in range(2))
        for k, path in enumerate(paths):
            ids[k, : len(path)] = path
            words[k, 1 : len(path)] = rows[k]["words"]
        total = np.cumsum(words, axis=1)
        whole = total[:, -1]

        size = len(trie.check)
        convs, children, ends, tokens, depth = (np.zeros(size, np.int64) for _ in range(5))
        least, later = np.full(size, np.iinfo(np.int64).max), np.zeros(size, bool)
        key, parent = [b""] * size, [None] * size
        at, digest = np.full(len(rows), trie.ROOT), [hashlib.md5(start) for _, start in tries]
        for d in range(deepest + 1):
            on = np.flatnonzero(lengths >= d)
            came = at[on]
            at[on] = node = trie.walk(came, ids[on, d])
            # Of the path, the words before this node, and those of its nodes from here on that no path before has.
            before = total[on, d - 1] if d else 0
            new = whole[on] - total[on, np.maximum(common[on], max(d - 1, 0))]
            np.add.at(convs, node, n[on])
            np.add.at(children, node, (common[on] <= d) & (lengths[on] > d))
            np.add.at(ends, node, leaves[on])
            np.add.at(tokens, node, n[on] * (whole[on] - before) - new + saved[on])
            np.minimum.at(least, node, column("least")[on])
            for k, x, up in zip(on.tolist(), node.tolist(), came.tolist(), strict=True):
                segment, start = tries[k]
                if d:
                    digest[k].update(cut[k][d - 1])
                if not key[x]:
                    later[x] = segment > 0 and d == 0
                    key[x] = start if later[x] else digest[k].digest()
                    parent[x], depth[x] = key[up] if d else None, segment * segment_turns + d
        own = np.flatnonzero(trie.check >= 0)
        binary = [pa.array([x[k] for k in own], pa.binary()) for x in (key, parent)]
        columns = [depth[own], *binary, later[own], *(x[own] for x in (convs, least, children, ends, tokens))]
        return pa.Table.from_arrays([pa.array(x) for x in columns], [x.split()[0] for x in _NODES.split(", ")])

    return run


def _shards(paths):
    """Paths dealt in order to shards, and for each shard how its edges meet those of its neighbours."""
    size = paths.agg(F.sum(F.size("words") + 1)).first()[0] or 0
    shards = paths.repartitionByRange(max(1, math.ceil(size / SHARD_TURNS)), "segment", "start", "path")
    shards = kept_small(shards.withColumn("shard", F.spark_partition_id()), "shards")
    place, order = F.struct("segment", "start", "path"), Window.orderBy("shard")
    # One row for each shard.
    edges = shards.groupBy("shard").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    edges = edges.withColumns({"prior": F.lag("last").over(order), "next": F.lead("first").over(order)})

    def same(a, b):
        alike = (F.col(f"{a}.segment") == F.col(f"{b}.segment")) & (F.col(f"{a}.start") == F.col(f"{b}.start"))
        return F.coalesce(alike, F.lit(False))

    def opening(name, turns):
        return F.substring(F.col(f"{name}.path"), F.lit(1), turns * WIDTH)

    turns = F.sequence(F.lit(0), (F.least(F.octet_length("first.path"), F.octet_length("prior.path")) / WIDTH).cast("int"))
    common = F.array_max(F.filter(turns, lambda k: opening("first", k) == opening("prior", k)))
    extended = same("next", "last") & F.startswith("next.path", "last.path")
    return shards, edges.select(
        "shard", F.when(same("first", "prior"), common).otherwise(-1).cast("long").alias("common"), extended.alias("extended")
    )


def local_nodes(paths):
    """The nodes of all shards; one that neighbouring shards share comes once from each."""
    shards, edges = _shards(paths)
    # A small row for each shard.
    return shards.join(F.broadcast(edges), "shard").groupBy("shard").applyInArrow(shard_nodes(SEGMENT), _NODES)


def totals_below(members, paths):
    """``root``, ``root_leaves``, ``root_saved``: what lies below the root of each later segment, all segments on.

    What a sub-trie holds itself is told to its least member; a root's total is the sum, over its members, of what they
    have been told from there on.
    """
    later = paths.where("segment > 0").withColumns({"leaves": F.lit(0).cast("long"), "saved": F.lit(0).cast("long")})
    own = local_nodes(later).where("later").groupBy("node").agg(
        F.min("conv_id").alias("teller"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved")
    )
    told = members.where("segment > 0").select("conv_id", "segment", "start").join(
        kept_small(own, "sub-tries").hint("merge"), (F.col("start") == F.col("node")) & (F.col("conv_id") == F.col("teller")), "left"
    )
    onward = Window.partitionBy("conv_id").orderBy(F.desc("segment")).rowsBetween(Window.unboundedPreceding, 0)
    sums = told.select("start", *[F.coalesce(F.sum(c).over(onward), F.lit(0)).alias(c) for c in ("leaves", "saved")])
    return sums.groupBy(F.col("start").alias("root")).agg(F.sum("leaves").alias("root_leaves"), F.sum("saved").alias("root_saved"))


def ends(last):
    """``node``, ``ends_sha256`` of the conversations (node, conv_id) that end at each node."""

    def join(batches):
        for batch in batches:
            nodes, ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            starts = [k for k in range(len(nodes)) if not k or nodes[k] != nodes[k - 1]]
            cuts = [(a, k, min(k + BLOCK_IDS, b)) for a, b in zip(starts, [*starts[1:], len(nodes)], strict=True) for k in range(a, b, BLOCK_IDS)]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([nodes[a] for a, _, _ in cuts], pa.binary()), pa.array([ids[a] for _, a, _ in cuts], pa.int64()),
                    pa.array([",".join(map(str, ids[a:b])) for _, a, b in cuts], pa.string()),
                ],
                ["node", "first", "ids"],
            )

    def hashes(batches):
        node, sha = None, None
        for batch in batches:
            found = []
            for key, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if key == node:
                    sha.update(b",")
                else:
                    if node is not None:
                        found.append((node, sha.hexdigest()))
                    node, sha = key, hashlib.sha256()
                sha.update(ids.encode())
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in found], pa.binary()), pa.array([x for _, x in found], pa.string())], ["node", "ends_sha256"]
            )
        if node is not None:
            yield pa.RecordBatch.from_arrays([pa.array([node], pa.binary()), pa.array([sha.hexdigest()])], ["node", "ends_sha256"])

    tasks = _tasks(last.sparkSession)
    ranged = last.select("node", "conv_id").repartitionByRange(tasks, "node", "conv_id").sortWithinPartitions("node", "conv_id")
    blocks = ranged.mapInArrow(join, "node binary, first long, ids string")
    met = blocks.repartition(tasks, "node").sortWithinPartitions("node", "first").select("node", "ids")
    return met.mapInArrow(hashes, "node binary, ends_sha256 string")


def nodes(segments_):
    """The contract's rows from the segments of conversations (see ``rebuilt``)."""
    members = kept_small(_starts(segments_), "segments")
    paths = kept_small(
        members.groupBy("segment", "start", "path", "words")
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("least"), F.max("more").alias("more")), "paths",
    )
    end = F.unhex(F.md5(F.concat("start", "path")))
    if paths.where("segment > 0").isEmpty():
        whole = paths.withColumns({"root_leaves": F.lit(None).cast("long"), "root_saved": F.lit(None).cast("long")})
    else:
        below = kept_small(totals_below(members, paths), "totals")
        whole = paths.withColumn("end", F.when(F.col("more"), end)).join(below.hint("merge"), F.col("end") == F.col("root"), "left").drop("end", "root")
    zero = F.lit(0).cast("long")
    whole = whole.withColumns({"leaves": F.coalesce("root_leaves", zero), "saved": F.coalesce("root_saved", zero)}).drop("root_leaves", "root_saved")

    def total(name):
        return F.sum(F.when(~F.col("later"), F.col(name))).alias(name)

    merged = kept_small(
        local_nodes(whole).groupBy("depth", "node").agg(
            F.max("parent").alias("parent"), F.min("conv_id").alias("conv_id"), F.sum("n_children").alias("n_children"),
            total("n_convs"), total("n_leaves"), total("saved_tokens"),
        ), "nodes",
    )
    above = merged.select(F.col("node").alias("up"), F.col("conv_id").alias("parent_conv_id"))
    last = ends(members.where(~F.col("more")).select(end.alias("node"), "conv_id"))
    return merged.join(above.hint("merge"), merged.parent == above.up, "left").join(last.hint("merge"), "node", "left").select(
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens",
        F.coalesce("ends_sha256", F.lit(_EMPTY)).alias("ends_sha256"),
    )


def sql():
    """The same in DuckDB's SQL, by all prefixes and all their prefixes."""
    return rf"""
WITH {crc_table_sql()},
t AS (
  SELECT conv_id, turn, md5(CAST(length(role) AS VARCHAR) || ':' || role || text) AS x, role,
    length(regexp_extract_all(text, '[^ 	-
]+')) AS words
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)),
names AS (SELECT x, max(words) AS words FROM t GROUP BY x),
own AS (SELECT conv_id, list(x ORDER BY turn NULLS FIRST, role, x) AS xs FROM t GROUP BY conv_id),
ids AS (SELECT conv_id, xs, conv_id - conv_id % {BASES} AS base, {crc_sql("CAST(conv_id AS VARCHAR)")} % {HEADS} AS h FROM own, crc_table),
built AS (SELECT i.conv_id, coalesce(b.xs, [])[1:i.h] || i.xs[i.h + 1:] AS xs FROM ids i LEFT JOIN own b ON b.conv_id = i.base),
prefixes AS (
  SELECT conv_id, d, xs[1:d] AS p, d = length(xs) AS whole FROM (SELECT *, unnest(range(0, length(xs) + 1)) AS d FROM built)),
node AS (
  SELECT d, p, count(*) AS n, min(conv_id) AS conv_id,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (whole), '')) AS ends_sha256
  FROM prefixes GROUP BY d, p),
kids AS (SELECT p[1:d - 1] AS up, count(*) AS k FROM node WHERE d > 0 GROUP BY ALL),
valued AS (
  SELECT node.*, coalesce(k, 0) AS k, (n - 1) * coalesce(words, 0) AS saved
  FROM node LEFT JOIN kids ON kids.up = node.p LEFT JOIN names ON names.x = node.p[-1]),
below AS (
  SELECT up, sum((k = 0)::INT) AS n_leaves, sum(saved) AS saved_tokens
  FROM (SELECT k, saved, p[1:unnest(range(0, d + 1))] AS up FROM valued) GROUP BY up)
SELECT v.conv_id, v.d AS depth, a.conv_id AS parent_conv_id, v.n AS n_convs, v.k AS n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, v.ends_sha256
FROM valued v JOIN below ON below.up = v.p LEFT JOIN node a ON v.d > 0 AND a.p = v.p[1:v.d - 1]
"""
