"""Operator 1: token ids in ORC files.

A file holds consecutive documents in ascending order of ``doc_id``; a row is a document with its ids as ``array<int>``,
which ORC writes with integer run-length encoding. Row indexes and a Bloom filter on ``doc_id`` let a look-up skip
stripes and row groups; stripes are small enough for one file to be read by several tasks.

Nulls: a null text is empty (it has the end id alone), a document with a null ``doc_id`` comes first. Repeated rows are
documents of their own, next to each other in the order of their texts. An empty table gives no rows. Other columns
are not stored. A text of any length is one row.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import release, slices, texts, values
from .encode import TEXT_BYTES, encoder

TOKENIZER = "word_bpe_49k.json"
END_ID = 1
#: Characters of a text that tell rows of one id apart when they are dealt to files.
BEGINNING = 32

SCHEMA = "doc_id long, file_start long, n_tokens long, ids array<int>"

#: Options of the ORC writer.
ORC = {
    "compression": "zstd",
    "orc.stripe.size": str(8 << 20),
    "orc.row.index.stride": "1000",
    "orc.bloom.filter.columns": "doc_id",
    "orc.bloom.filter.fpp": "0.01",
}


def write(documents, folder, tokenizer=TOKENIZER, end_id=END_ID):
    """Encodes whole texts and writes them below ``folder``, each file a range of ids."""
    end = np.array([end_id], dtype="<u4").tobytes()

    def encode(batches):
        start = 0
        for batch in slices(batches, limit=TEXT_BYTES):
            ids = [x + end for x in encoder(tokenizer).encode(texts(batch))]
            counts = np.array([len(x) // 4 for x in ids], dtype=np.int64)
            ends = np.cumsum(counts)
            offsets = np.concatenate(([0], ends)).astype(np.int32)
            flat = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
            yield pa.RecordBatch.from_arrays(
                [values(batch, "doc_id"), pa.array(start + ends - counts), pa.array(counts), pa.ListArray.from_arrays(offsets, flat)],
                ["doc_id", "file_start", "n_tokens", "ids"],
            )
            start += int(ends[-1])
        release()

    (
        documents.select(F.col("doc_id").cast("long"), F.coalesce("text", F.lit("")).alias("text"))
        # Rows that repeat an id, or have none, are spread by how their texts begin.
        .repartitionByRange("doc_id", F.substring("text", 1, BEGINNING)).sortWithinPartitions("doc_id", "text")
        .mapInArrow(encode, SCHEMA)
        .write.options(**ORC).orc(folder)
    )


def read(spark, folder):
    """The stored rows with ``file``, the name of their file; files follow each other by ``file_number``."""
    return spark.read.schema(SCHEMA).orc(folder).select("*", F.col("_metadata.file_name").alias("file"))


def file_starts(spark, folder):
    """The ids before each file: one short row per file, from the counts alone."""
    totals = read(spark, folder).groupBy("file").agg(F.sum("n_tokens").alias("total"))
    order = Window.orderBy(file_number(F.col("file")), "file")
    return totals.select("file", (F.sum("total").over(order) - F.col("total")).alias("before"))


def file_number(name):
    """The number of the task that wrote a file; numbers of more than five digits make names longer."""
    return F.regexp_extract(name, r"part-(\d+)", 1).cast("long")


def digests(spark, folder):
    """``doc_id``, ``start``, ``n_tokens`` and ``ids_crc32`` of every document, from the files."""

    def check(batches):
        for batch in batches:
            lists = values(batch, "ids")
            flat = lists.values.to_numpy().astype("<u4", copy=False)
            bounds = lists.offsets.to_numpy()
            crcs = [zlib.crc32(flat[a:b].tobytes()) for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            counts = np.diff(bounds).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [values(batch, "doc_id"), values(batch, "file"), values(batch, "file_start"), pa.array(counts), pa.array(crcs, pa.int64())],
                ["doc_id", "file", "file_start", "n_tokens", "ids_crc32"],
            )

    schema = T._parse_datatype_string("doc_id long, file string, file_start long, n_tokens long, ids_crc32 long")
    rows = read(spark, folder).select("doc_id", "file", "file_start", "ids").mapInArrow(check, schema)
    return rows.join(file_starts(spark, folder), "file").select(
        "doc_id", (F.col("before") + F.col("file_start")).alias("start"), "n_tokens", "ids_crc32"
    )


def lookup(spark, folder, doc_ids):
    """The stored documents of a few ids; files, stripes and row groups without them are skipped."""
    return read(spark, folder).where(F.col("doc_id").isin([int(x) for x in doc_ids]))
