"""Exact links inside families of sets: what is left to do once candidates tie documents together.

A family holds sets that candidates tie, directly or not. Small families share a task. A large one is dealt into blocks;
each block is compared with itself and with the family's pivots. Sets that are then still outside the family's main part
are compared with all its blocks, so every link between sets of different groups is found, no family meets in one task,
and no pairs within a group are emitted.
"""

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tallywharf.sources.workspace import ensure_checkpoints

from .common import release, slices, texts
from .sets import Union, components, digests, kept_small, link_rows, shingle_sets

#: Sets and tokens to a block of a large family, pivots of a family, tokens to a task.
BLOCK, BLOCK_TOKENS, PIVOTS, TASK_TOKENS = 512, 1 << 19, 64, 1 << 20

SETS = "family long, id long, n long, tokens binary"


def _groups(table, names):
    """The parts of a table with equal values in the named columns."""
    table = table.sort_by([(x, "ascending") for x in names])
    columns = np.stack([table[x].to_numpy() for x in names])
    new = np.flatnonzero(np.concatenate(([True], (columns[:, 1:] != columns[:, :-1]).any(axis=0)))) if table.num_rows else []
    for a, b in zip(new, [*new[1:], table.num_rows], strict=True):
        yield table.slice(a, b - a)


def _sets(table):
    return [np.frombuffer(x, "<u8") for x in table["tokens"].to_pylist()]


def _links(a, b):
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def tie_block(percent):
    """All sets of each block with each other: each id with the least id that it is tied to there."""

    def run(table):
        a, b = [], []
        release()
        for block in _groups(table, ["family", "block"]):
            if block.num_rows < 2:
                continue
            sets, ids = _sets(block), block["id"].to_numpy()
            order = np.argsort(ids)
            sets, ids = [sets[k] for k in order], ids[order]
            union = Union(len(ids))
            for i, found in enumerate(link_rows(sets, sets, percent)):
                for j in found[found < i].tolist():
                    union.join(max(union.top(i), union.top(j)), min(union.top(i), union.top(j)))
            tops = np.array([union.top(i) for i in range(len(ids))])
            far = tops != np.arange(len(ids))
            a.append(ids[far])
            b.append(ids[tops[far]])
        return _links(np.concatenate(a) if a else [], np.concatenate(b) if b else [])

    return run


def tie_rest(percent):
    """Sets outside the main part with a block: for each pair of groups that a link joins, one link."""

    def run(table):
        pairs = {}
        release()
        for part in _groups(table, ["family", "block", "chunk"]):
            outside = part["outside"].to_numpy(zero_copy_only=False).astype(bool)
            left, right = part.filter(pa.array(outside)), part.filter(pa.array(~outside))
            groups, ids = right["component"].to_numpy(), right["id"].to_numpy()
            rows = zip(left["component"].to_pylist(), left["id"].to_pylist(), link_rows(_sets(left), _sets(right), percent), strict=True)
            for own, one, found in rows:
                for j in found[groups[found] != own].tolist():
                    pairs.setdefault((own, int(groups[j])), (one, int(ids[j])))
        return _links(*zip(*pairs.values(), strict=True)) if pairs else _links([], [])

    return run


def linked(sets, percent):
    """``id``, ``component`` for every id of ``sets`` (of the columns ``SETS``, ids distinct) that has a link.

    ``tokens`` are a set's sorted 64-bit tokens. ``component`` is the least id that can be reached by links.
    """
    ensure_checkpoints(sets.sparkSession)
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n") / BLOCK_TOKENS)).cast("int")
    families = sets.groupBy("family").agg(F.count("*").alias("members"), F.sum("n").alias("load"), blocks.alias("blocks"))
    families = families.where("members > 1").checkpoint()
    tokens = families.agg(F.sum("load")).first()[0] or 0
    tasks = max(1, math.ceil(tokens / TASK_TOKENS))
    places = (
        sets.join(families, "family").select("family", "id", "members", "blocks")
        .withColumn("block", F.pmod(F.xxhash64("id", F.lit(20)), F.col("blocks").cast("long")).cast("int"))
    ).checkpoint()

    def by_task(rows, *keys):
        return rows.withColumn("task", F.pmod(F.xxhash64("family", *keys), F.lit(tasks))).groupBy("task")

    # The pivots of a large family, chosen by hash, go to all its blocks.
    pivot = (F.col("blocks") > 1) & (F.pmod(F.xxhash64("id", F.lit(21)), F.col("members")) < PIVOTS)
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = places.select("id", F.explode(F.when(pivot, everywhere).otherwise(F.array("block"))).alias("block"))
    with_sets = sets.select("family", "id", "tokens").join(dealt.hint("merge"), "id")
    tied = by_task(with_sets, "block").applyInArrow(tie_block(percent), "a long, b long").distinct().checkpoint()
    found = components(tied)

    large = places.where("blocks > 1")
    if large.isEmpty():
        return found
    parts = large.join(found, "id", "left").select(
        "family", "id", "block", "blocks", F.coalesce("component", "id").alias("component")
    ).checkpoint()
    sizes = parts.groupBy("family", "component").agg(F.count("*").alias("n"))
    main = sizes.groupBy("family").agg(
        F.max(F.struct("n", "component")).getField("component").alias("main"), (F.sum("n") - F.max("n")).alias("rest")
    ).where("rest > 0").select("family", "main", F.ceil(F.col("rest") / BLOCK).cast("int").alias("chunks"))
    parts = parts.join(main, "family").withColumn("outside", F.col("component") != F.col("main"))
    chunk = F.pmod(F.xxhash64("id", F.lit(22)), F.col("chunks").cast("long")).cast("int")
    columns = ["id", "block", "chunk", "component", "outside"]
    left = parts.where("outside").withColumn("chunk", chunk).withColumn("block", F.explode(everywhere)).select(columns)
    right = (
        parts.withColumn("outside", F.lit(False))
        .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).select(columns)
    )
    with_sets = sets.select("family", "id", "tokens").join(left.union(right).hint("merge"), "id")
    more = by_task(with_sets, "block", "chunk").applyInArrow(tie_rest(percent), "a long, b long")
    return components(tied.union(more))


def full_sets(documents, wanted, size):
    """The whole sets of the ``wanted`` classes (family, id, least, high, low, n), from the rows that have their ids."""

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(texts(batch), size)
            yield pa.RecordBatch.from_arrays(
                [*digests(sets), pa.array([x.astype("<u8").tobytes() for x in sets], pa.binary())], ["high", "low", "tokens"]
            )
        release()

    ids = wanted.select("least").distinct()
    documents = documents.select(F.col("doc_id").cast("long"), "text")
    rows = documents.join(ids.hint("merge"), documents.doc_id.eqNullSafe(ids.least), "left_semi").select("text")
    sets = rows.mapInArrow(run, "high long, low long, tokens binary").groupBy("high", "low").agg(F.first("tokens").alias("tokens"))
    return sets.join(wanted, ["high", "low"]).select("family", "id", "n", "tokens")


def class_components(documents, classes, tied, size, percent):
    """``id``, ``component`` of every class (id, high, low, least, n) that has a link to another.

    ``tied`` (id, family) gives the classes that candidates tie. All texts cross the network once, to where the ids of
    candidates are; what is kept of them is written, and later steps read that.
    """
    wanted = kept_small(classes.join(tied.hint("merge"), "id").select("family", "id", "least", "high", "low", "n"), "wanted")
    sets = kept_small(full_sets(documents, wanted, size), "sets")
    return kept_small(linked(sets, percent), "linked")
