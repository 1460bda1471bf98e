"""Operator 2: documents packed into sequences by first-fit decreasing.

A document is encoded, closed with the end id and cut into pieces of the sequence length; its last piece may be
shorter. Pieces are dealt to groups by a seeded hash of id, start, digest and input partition, those of about
``GROUP_DOCUMENTS`` documents to a group, so groups stay of one size however many documents there are; an id that owns a
third of all rows is spread, and of equal rows a group holds at most those of the input partitions dealt to it. Within a group, whole pieces are
sequences of their own and the others are placed by length, longest first, into the first sequence with room, which a
tournament tree over the sequences' free room finds in logarithmic time.

Nulls: a null text is empty (its document is the end id alone); a null ``doc_id`` is a document like others. Repeated
rows are packed once each. Equal lengths are placed by ``doc_id``, ``start``, then ``ids_crc32``. An empty table gives no rows.
"""

import math
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, release, slices, texts, values
from .encode import TEXT_BYTES, encoder

TOKENIZER = "byte_bpe_50k.json"
END_ID = 1
LENGTH = 2048
GROUP_DOCUMENTS = 2048
SEED = 20_011

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids array<int>"
PLACES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Tournament:
    """Free room of up to ``n`` sequences; each inner node holds the most of its two children."""

    def __init__(self, n, room):
        self.leaves = 1 << max(0, (n - 1).bit_length())
        self.most = [room] * (2 * self.leaves)

    def place(self, length):
        """The first sequence with room for ``length``, which it takes."""
        most, node = self.most, 1
        while node < self.leaves:
            node *= 2
            if most[node] < length:
                node += 1
        most[node] -= length
        found = node - self.leaves
        while node > 1:
            node //= 2
            most[node] = max(most[2 * node], most[2 * node + 1])
        return found


def first_fit_decreasing(lengths, room):
    """Sequence and offset of each length; ``lengths`` come in descending order, none above ``room``."""
    tree, used = Tournament(len(lengths), room), [0] * len(lengths)
    sequences, offsets = [], []
    for n in lengths:
        found = tree.place(n)
        sequences.append(found)
        offsets.append(used[found])
        used[found] += n
    return sequences, offsets


def pieces(documents, length=LENGTH, tokenizer=TOKENIZER, end_id=END_ID, with_ids=False):
    """The pieces of every document; ``ids`` is null unless asked for."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def cut(batches):
        for batch in slices(batches, limit=TEXT_BYTES):
            encoded = [x + end for x in encoder(tokenizer).encode(texts(batch))]
            rows = [(i, a) for i, x in enumerate(encoded) for a in range(0, len(x), 4 * length)]
            parts = [encoded[i][a : a + 4 * length] for i, a in rows]
            counts = np.array([len(x) // 4 for x in parts], dtype=np.int64)
            if with_ids:
                offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
                ids = pa.ListArray.from_arrays(offsets, pa.array(np.frombuffer(b"".join(parts), dtype="<i4")))
            else:
                ids = pa.nulls(len(parts), pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [
                    values(batch, "doc_id").take(pa.array([i for i, _ in rows], pa.int32())),
                    pa.array([a // 4 for _, a in rows], pa.int64()),
                    pa.array(counts),
                    pa.array([zlib.crc32(x) for x in parts], pa.int64()),
                    pa.array([len(encoded[i]) // 4 for i, _ in rows], pa.int64()),
                    ids,
                ],
                ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "ids"],
            )
        release()

    return documents.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def pack(parts, groups, length=LENGTH, seed=SEED):
    """The pieces with ``sequence_id`` and ``offset``; other columns of ``parts`` stay."""
    fields = [f for f in parts.schema.fields if f.name.lower() not in ("group", "sequence_id", "offset")]
    schema = T.StructType(fields + [T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    names = [f.name for f in fields]

    def place(key, frame):
        whole = frame[frame.length == length]
        rest = frame[frame.length < length].sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        sequences, offsets = first_fit_decreasing(rest.length.tolist(), length)
        out = pd.concat([whole, rest])[names]
        local = np.concatenate((np.arange(len(whole)), len(whole) + np.array(sequences, dtype=np.int64))).astype(np.int64)
        out["sequence_id"] = (int(key[0]) << 32) + local
        out["offset"] = np.concatenate((np.zeros(len(whole), dtype=np.int64), np.array(offsets, dtype=np.int64)))
        return out

    group = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32", F.spark_partition_id(), F.lit(seed)), F.lit(groups))
    return parts.select(*(column(n) for n in names), group.alias("group")).groupBy("group").applyInPandas(place, schema)


def pack_documents(documents, length=LENGTH, tokenizer=TOKENIZER, end_id=END_ID, group_documents=GROUP_DOCUMENTS):
    """Where each piece of each document lies."""
    groups = max(1, math.ceil(documents.count() / group_documents))
    return pack(pieces(documents, length, tokenizer, end_id).drop("ids"), groups, length)


def sequences(documents, length=LENGTH, tokenizer=TOKENIZER, end_id=END_ID, group_documents=GROUP_DOCUMENTS, pad_id=0):
    """The packed sequences themselves: ``sequence_id``, ``ids`` padded to ``length``, and ``n_ids`` without padding."""
    groups = max(1, math.ceil(documents.count() / group_documents))
    placed = pack(pieces(documents, length, tokenizer, end_id, with_ids=True), groups, length)
    ids = F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("offset", "ids"))), lambda x: x["ids"]))
    return placed.groupBy("sequence_id").agg(ids.alias("ids")).select(
        "sequence_id",
        F.concat("ids", F.array_repeat(F.lit(pad_id), F.lit(length) - F.size("ids"))).alias("ids"),
        F.size("ids").alias("n_ids"),
    )
