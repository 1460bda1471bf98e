"""What the operators share: Arrow slices bounded by bytes, new columns from Arrow functions, bounded keyed samples."""

import ctypes
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Text bytes that an Arrow function works on at once; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


def column(name):
    """The column of exactly this name, dots and spaces included."""
    return F.col("`" + name.replace("`", "``") + "`")


def slices(batches, name="text", limit=SLICE_BYTES):
    """The batches cut into runs of rows that hold at most ``limit`` bytes of the named string column."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(name))), 0)
        ends = np.cumsum(sizes.to_numpy(zero_copy_only=False).astype(np.int64))
        first = 0
        while first < batch.num_rows:
            before = ends[first - 1] if first else 0
            last = max(first + 1, int(np.searchsorted(ends, before + limit, side="right")))
            yield batch.slice(first, last - first)
            first = last


def release():
    """Gives freed memory back to the system, as workers stay for later stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def texts(batch, name="text"):
    """The named strings of a batch; null counts as empty."""
    return [x or "" for x in batch.column(batch.schema.get_field_index(name)).to_pylist()]


def values(batch, name):
    return batch.column(batch.schema.get_field_index(name))


def annotate(frame, fields, make, keep, needs=("text",)):
    """The ``keep`` columns of ``frame`` and new ones.

    ``make()`` runs once in each task and returns the function that gives the new columns of one slice as Arrow arrays.
    It sees the columns ``keep`` and ``needs``. A kept column that has the name of a new one gives way to it.
    """
    new = {f.name.lower() for f in fields}
    keep = [c for c in keep if c.lower() not in new]
    source = frame.select(*(column(c) for c in dict.fromkeys([*keep, *needs])))
    schema = T.StructType([source.schema[c] for c in keep] + list(fields))

    def run(batches):
        function = make()
        for batch in slices(batches, needs[0]):
            yield pa.RecordBatch.from_arrays([values(batch, c) for c in keep] + list(function(batch)), schema.names)

    return source.mapInArrow(run, schema)


def fold(id_column, parts):
    """crc32 of the id written as text, modulo ``parts``; -1 where the id is null."""
    return F.coalesce(F.crc32(F.col(id_column).cast("string").cast("binary")) % parts, F.lit(-1).cast("long"))


def bounded_sample(frame, id_column, bound, seed, total=None):
    """At most ``bound`` rows, those whose hashed ids come first; all rows where there are no more than that.

    The hash decides, so the same rows are taken however the table is laid out.
    """
    total = frame.count() if total is None else total
    share = 1.0 if total <= bound else 1.2 * bound / total
    if share < 1:
        limit = math.ceil(share * (1 << 40))
        frame = frame.where(F.pmod(F.xxhash64(id_column, F.lit(seed)), F.lit(1 << 40)) < limit)
    return frame.orderBy(F.xxhash64(id_column, F.lit(seed)), id_column).limit(bound)


def labelled(documents, labels, name):
    """``doc_id`` and the label ``name`` of documents that have one; of several labels of a document the largest."""
    return (
        labels.select("doc_id", F.col(name).cast("int").alias("label")).dropna()
        .groupBy("doc_id").agg(F.max("label").alias("label"))
        .join(documents.select("doc_id").distinct(), "doc_id", "left_semi")
    )


def crc_table_sql():
    """DuckDB's ``crc_table``, one row of ``entries``: the table of crc32 by its polynomial, a step for every bit."""
    step = "lambda x, b: CASE WHEN (x & 1) = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END"
    return f"""crc_table AS (SELECT list(entry ORDER BY k) AS entries FROM (
  SELECT k, list_reduce([k] || range(8), {step}) AS entry FROM (SELECT unnest(range(256)) AS k)))"""


def crc_sql(text):
    """The unsigned crc32 of a text's UTF-8, beside a row of ``crc_table``."""
    digits = f"hex(encode({text}))"
    octets = f"list_transform(range(1, length({digits}) // 2 + 1), lambda i: CAST('0x' || ({digits})[2 * i - 1:2 * i] AS BIGINT))"
    return f"xor(list_reduce([4294967295] || {octets}, lambda x, b: xor(x >> 8, entries[xor(x & 255, b) + 1])), 4294967295)"
