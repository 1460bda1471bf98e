"""Operator 3: passages of benchmark items inside documents, found by one Aho-Corasick automaton.

Words are runs of ``[0-9a-z]`` and of characters outside ASCII, after A-Z are lower-cased. Each window of ``WINDOW``
consecutive words of an item, or the whole item where it has fewer, is a pattern; a text is normalised to its words
with single spaces and scanned once. Hits are kept as word numbers, which ``original_spans`` maps back to the text.

Items are a test set, not a corpus, but their size is checked: they are read in blocks of about ``BLOCK_BYTES``, and
documents pass one automaton after the other in the same task, so a larger set takes more passes and no more memory.

Nulls: a null or empty text has no words and no hits; an item whose text is null has no windows, a null ``item_id``
belongs to no item. Items that repeat under one id count once. Repeated rows give repeated results. An empty benchmark
leaves all documents clean; an empty table gives no rows.
"""

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import column, slices, texts, values

WINDOW = 10
BLOCK_BYTES = 4 << 20

_LETTERS = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32 for b in range(256)
)
_LOWER = {c: c + 32 for c in range(65, 91)}
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_hit", T.LongType()),
    T.StructField("n_items", T.LongType()),
    T.StructField("items_sha256", T.StringType()),
    T.StructField("contaminated", T.BooleanType()),
]


def words(text):
    """The words of a text, as bytes of UTF-8."""
    return text.encode().translate(_LETTERS).split()


def windows(text, size=WINDOW):
    found = words(text)
    if not found:
        return set()
    return {b" ".join(found[i : i + size]) for i in range(max(1, len(found) - size + 1))}


def automaton(items, size=WINDOW):
    """Of (id, text) items; a pattern's value is its number of words and the ids of its items. None without patterns."""
    import ahocorasick

    patterns = {}
    for item, text in items:
        for x in windows(text, size):
            patterns.setdefault(x, set()).add(str(item))
    machine = ahocorasick.Automaton()
    for x, ids in patterns.items():
        machine.add_word(f" {x.decode('latin-1')} ", (x.count(b" ") + 1, tuple(ids)))
    if not patterns:
        return None
    machine.make_automaton()
    return machine


def scan(machine, found):
    """The hits among a text's words as (first word, words) pairs, and the ids of the items."""
    line = f" {b' '.join(found).decode('latin-1')} "
    hits, items, spaces, seen = [], set(), 0, 0
    for end, (n, ids) in machine.iter(line):
        spaces += line.count(" ", seen, end)
        seen = end
        hits.append((spaces - n, n))
        items.update(ids)
    return hits, items


def item_blocks(benchmark, most=BLOCK_BYTES):
    """The items in lists of about ``most`` bytes, in the order of their ids."""
    rows = benchmark.select("item_id", "text").dropna().distinct()
    block, size = [], 0
    for r in rows.orderBy("item_id", "text").toLocalIterator():
        block.append((r.item_id, r.text))
        size += len(r.text.encode())
        if size >= most:
            yield block
            block, size = [], 0
    if block:
        yield block


def find(documents, benchmark, keep=("doc_id",), size=WINDOW, block_bytes=BLOCK_BYTES):
    """The ``keep`` columns with ``hits`` (first word, words), ``items`` and the number of words ``n_words``."""
    new = [
        T.StructField("n_words", T.LongType()),
        T.StructField("hits", T._parse_datatype_string("array<struct<first:long,words:long>>")),
        T.StructField("items", T.ArrayType(T.StringType())),
    ]
    keep = [c for c in keep if c.lower() not in {f.name for f in new}]
    types = {f.name: f for f in documents.schema.fields}

    def passed(frame, items, first, drop_text):
        names = [*keep, *([] if drop_text else ["_text"])]
        schema = T.StructType([frame.schema[c] for c in names] + new)

        def run(batches):
            machine = automaton(items, size)
            for batch in slices(batches, "_text"):
                counts, hits, ids = [], [], []
                for text in texts(batch, "_text"):
                    found = words(text)
                    counts.append(len(found))
                    h, i = scan(machine, found) if machine and found else ([], set())
                    hits.append([{"first": a, "words": n} for a, n in h])
                    ids.append(sorted(i))
                if not first:
                    hits = [a + b for a, b in zip(values(batch, "hits").to_pylist(), hits, strict=True)]
                    ids = [sorted({*a, *b}) for a, b in zip(values(batch, "items").to_pylist(), ids, strict=True)]
                span = pa.list_(pa.struct([("first", pa.int64()), ("words", pa.int64())]))
                yield pa.RecordBatch.from_arrays(
                    [values(batch, c) for c in names]
                    + [pa.array(counts, pa.int64()), pa.array(hits, span), pa.array(ids, pa.list_(pa.string()))],
                    schema.names,
                )

        return frame.mapInArrow(run, schema)

    frame = documents.select(*(column(c) for c in keep), column(types["text"].name).alias("_text"))
    blocks = list(item_blocks(benchmark, block_bytes)) or [[]]
    for k, items in enumerate(blocks):
        frame = passed(frame, items, k == 0, k == len(blocks) - 1)
    return frame


def covered(hits):
    """How many words lie in any of the (first, words) hits."""
    total, end = 0, 0
    for a, n in sorted(hits):
        total += max(0, a + n - max(a, end))
        end = max(end, a + n)
    return total


def original_spans(text, hits):
    """Where the hits lie in the text itself, as (start, end) character offsets; touching hits are joined."""
    places = [m.span() for m in WORD.finditer(text.translate(_LOWER))]
    spans = []
    for a, n in sorted(hits):
        start, end = places[a][0], places[a + n - 1][1]
        if spans and start <= spans[-1][1]:
            spans[-1] = (spans[-1][0], max(end, spans[-1][1]))
        else:
            spans.append((start, end))
    return spans


def decontaminate(documents, benchmark, keep=("doc_id",), size=WINDOW, block_bytes=BLOCK_BYTES):
    """The ``keep`` columns with the verdict columns of ``FIELDS``."""
    new = {f.name for f in FIELDS}
    keep = [c for c in keep if c.lower() not in new | {"hits", "items"}]
    found = find(documents, benchmark, keep, size, block_bytes)
    end = F.struct(F.lit(0).cast("long").alias("total"), F.lit(0).cast("long").alias("end"))
    count = F.aggregate(
        F.array_sort("hits"), end,
        lambda acc, h: F.struct(
            (acc["total"] + F.greatest(F.lit(0), h["first"] + h["words"] - F.greatest(h["first"], acc["end"]))).alias("total"),
            F.greatest(acc["end"], h["first"] + h["words"]).alias("end"),
        ),
        lambda acc: acc["total"],
    )
    return found.select(
        *(column(c) for c in keep), "n_words", count.alias("n_hit"), F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"),
    )


def sql(size=WINDOW):
    """The verdicts in DuckDB's SQL."""
    return rf"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark),
p AS (
  SELECT DISTINCT item_id, least(len(ws), {size}) AS n, array_to_string(ws[s:s + least(len(ws), {size}) - 1], ' ') AS win
  FROM (SELECT item_id, ws, unnest(range(1, greatest(2, len(ws) - {size} + 2))) AS s FROM i WHERE len(ws) > 0)),
sizes AS (SELECT DISTINCT n FROM p),
d AS (
  SELECT doc_id, s, n, array_to_string(ws[s:s + n - 1], ' ') AS win
  FROM (SELECT doc_id, ws, n, unnest(range(1, greatest(1, len(ws) - n + 2))) AS s FROM w, sizes)),
h AS (SELECT d.doc_id, d.s, d.n, p.item_id FROM d JOIN p USING (win, n)),
c AS (SELECT doc_id, count(DISTINCT k) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS k FROM h) GROUP BY doc_id),
t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS items
  FROM (SELECT DISTINCT doc_id, item_id FROM h) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c ON c.doc_id = w.doc_id LEFT JOIN t ON t.doc_id = w.doc_id
"""
