"""Operator 12: near-duplicate documents by bottom-k sketches, and the groups that their links make.

Two documents link when ``100 * intersection >= percent * union`` of their sets of word shingles. One hash function gives
every shingle a 64-bit value; a document's sketch is its ``K`` smallest values, or all where it has fewer.

1. Documents with equal sets are one class; what follows works on classes.
2. The ``K`` smallest values of the union of two sets are a random sample of it, and those of the sample that both sets
   hold are in both sketches. At a similarity of 0.8 a sample of 64 has fewer than 32 of them less than once in ten million
   pairs, and smaller sets are compared whole. So linked classes share at least ``SHARE`` of their sketches, and if all
   values are put in one order, rare ones first, their first ``k - SHARE * k + 1`` values have one in common. Only these
   are kept in inverted lists, and no value that a single class holds needs a list.
3. A list of up to ``LIST`` classes gives its pairs; the union sketch of a pair, the ``K`` smallest of both sketches,
   estimates its similarity, and pairs below ``SHARE`` go. A longer list ties its classes to the least one.
4. Classes that are tied, directly or not, are a family. ``families`` finds the links in it on full sets, exactly.

No list, class or family is collected in one task or expanded into all pairs, and nothing that grows is broadcast or
sent to the driver. Every row of a frequent value is joined by sort-merge, which adaptive execution splits.

Nulls: a null text is empty. A document without words has an empty set, no links and itself as component. Rows that
repeat an id are separate rows that link by their texts; a null id takes part, and a component's id is its least id that is
not null. ``kept`` compares null-safe, so a row without id stays only where no row with one is linked to it. A very long
text is a slice of its own, and its whole set is compared. Ties do not arise: sets, not orders, decide. Only ``doc_id`` and
``text`` are read, so further columns may have any name. An empty table gives no rows.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from . import families
from .common import slices, texts, values
from .sets import components, digests, kept_small, shingle_sets
from .shingle_join import sql as join_sql

SHINGLE, PERCENT = 4, 80
#: Values of a sketch, the share of it that linked sets have in common, and classes of a list that gives pairs.
K, SHARE, LIST = 64, 0.5, 24

_ROWS = "doc_id long, n_shingles long, high long, low long, sketch array<long>"


def sketches(documents, size=SHINGLE):
    """For every row the size of its set, the set's digest, and its sketch."""

    def run(batches):
        for batch in slices(batches):
            sets = shingle_sets(texts(batch), size)
            # Sets are sorted by their hash values.
            least = [x[:K] for x in sets]
            offsets = np.concatenate(([0], np.cumsum([len(x) for x in least]))).astype(np.int32)
            flat = np.concatenate([np.empty(0, np.uint64), *least]).view(np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    values(batch, "doc_id"), pa.array([len(x) for x in sets], pa.int64()), *digests(sets),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(flat, pa.int64())),
                ],
                ["doc_id", "n_shingles", "high", "low", "sketch"],
            )

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(run, _ROWS)


def inverted_lists(classes):
    """``value``, ``id``: the values by which classes can meet those that they link with."""
    entries = classes.select("id", F.size("sketch").alias("k"), F.explode("sketch").alias("value"))
    counts = kept_small(entries.groupBy("value").agg(F.count("*").alias("held")).where("held > 1"), "counts")
    # Values held by one class come first in every order, so they fill places without being looked at.
    shared = entries.join(counts.hint("merge"), "value").groupBy("id", "k").agg(
        F.array_sort(F.collect_list(F.struct("held", "value"))).alias("shared")
    )
    places = F.col("k") - F.ceil(F.col("k") * SHARE) + 1 - (F.col("k") - F.size("shared"))
    first = shared.where(places > 0).select("id", F.explode(F.slice("shared", F.lit(1), places.cast("int"))).alias("x"))
    return kept_small(first.select("x.value", "id"), "lists")


def estimates(pairs):
    """The pairs with the estimate of their similarity from both sketches."""

    def run(batches):
        for batch in batches:
            found = []
            for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                x, y = np.array(x, np.int64).view(np.uint64), np.array(y, np.int64).view(np.uint64)
                # Two sketches that are not full are the sets themselves.
                union = np.union1d(x, y)[: K if max(len(x), len(y)) == K else None]
                both = np.intersect1d(x, y, assume_unique=True)
                found.append(np.count_nonzero(both <= union[-1]) / len(union))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.float64())], ["a", "b", "likeness"])

    return pairs.select("a", "b", "x", "y").mapInArrow(run, "a long, b long, likeness double")


def ties(classes, lists):
    """``a``, ``b``: candidate links, of which only the closure counts."""
    lengths = lists.groupBy("value").agg(F.count("*").alias("length"), F.min("id").alias("least")).where("length > 1")
    held = kept_small(lists.join(lengths.hint("merge"), "value"), "held")
    long_lists = held.where((F.col("length") > LIST) & (F.col("id") > F.col("least"))).select("id", "least")
    members = held.where(F.col("length") <= LIST).groupBy("value").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    each = F.expr("flatten(transform(ids, (a, i) -> transform(slice(ids, i + 2, size(ids)), b -> struct(a, b))))")
    pairs = members.select(F.explode(each).alias("pair")).select("pair.a", "pair.b").distinct()
    # Only classes in a list can be in a pair.
    few = classes.join(held.select("id").distinct().hint("merge"), "id", "left_semi").select("id", "sketch")
    few = kept_small(few, "sketches")
    with_sketches = (
        pairs.join(few.toDF("a", "x").hint("merge"), "a").join(few.toDF("b", "y").hint("merge"), "b")
    )
    alike = estimates(with_sketches).where(F.col("likeness") >= SHARE).select("a", "b")
    return alike.union(long_lists)


def groups(documents, size=SHINGLE, percent=PERCENT):
    """``doc_id``, ``n_shingles``, ``component_id``, ``kept`` for every row: the operator's result."""
    rows = kept_small(sketches(documents, size), "rows")
    classes = (
        rows.where("n_shingles > 0").groupBy("high", "low")
        .agg(F.min("doc_id").alias("least"), F.max("n_shingles").alias("n"), F.first("sketch").alias("sketch"))
    )
    classes = kept_small(classes.withColumn("id", F.monotonically_increasing_id()), "classes")
    tied = kept_small(components(ties(classes, inverted_lists(classes))), "families")
    tied = tied.select("id", F.col("component").alias("family"))
    found = families.class_components(documents, classes, tied, size, percent)
    labels = classes.select("id", "high", "low", "least").join(found.hint("merge"), "id", "left").withColumn(
        "component", F.coalesce("component", "id")
    )
    names = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    labels = kept_small(labels.join(names.hint("merge"), "component").select("high", "low", "component_id"), "labels")
    named = rows.join(labels.hint("merge"), ["high", "low"], "left")
    # Without words a document is its own component; the digest of the empty set has no label.
    component = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return named.select("doc_id", "n_shingles", component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )


def sql(size=SHINGLE, percent=PERCENT):
    """The same in DuckDB's SQL, by all pairs that share a shingle."""
    return f"SELECT *, doc_id = component_id AS kept FROM ({join_sql(size, percent)})"
