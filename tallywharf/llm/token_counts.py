"""Operator 9: token counts, with nothing but lengths leaving the encoder.

Arrow batches are regrouped so that each call of the encoder gets about as many bytes; a text above ``PART_CHARS`` is
cut at safe boundaries, which no piece of the vocabulary crosses: a single space between two other characters. A part
after a cut starts behind that space, as the encoder itself puts one before each string. A long text without such a
space stays whole.

Nulls: a null text is empty and has no tokens; a null ``doc_id`` is a document like others. Repeated rows give
repeated results. An empty table gives no rows.
"""

import re

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
from pyspark.sql import types as T

from .common import annotate, texts

MODEL = "piece_bpe_32k.model"
LIMIT = 4096
PART_CHARS = 1 << 15
BATCH_BYTES = 1 << 18

#: The encoder's own mark for a space counts as one.
CUT = re.compile("(?<=[^ ▁]) (?=[^ ▁])")

FIELDS = [
    T.StructField("n_bytes", T.LongType()),
    T.StructField("n_tokens", T.LongType()),
    T.StructField("over_limit", T.BooleanType()),
]


def safe(model):
    """Whether no piece of the vocabulary holds a space after another character, so that cuts change no count."""
    return all("▁" not in model.id_to_piece(i).lstrip("▁") for i in range(model.get_piece_size()))


def parts(text, most=PART_CHARS):
    """The text in parts of about ``most`` characters, without the spaces it was cut at."""
    first = 0
    while len(text) - first > most:
        found = CUT.search(text, first + most)
        if not found:
            break
        yield text[first : found.start()]
        first = found.end()
    yield text[first:]


def byte_batches(strings, most=BATCH_BYTES):
    """Runs of strings of about ``most`` characters."""
    run, size = [], 0
    for x in strings:
        run.append(x)
        size += len(x)
        if size >= most:
            yield run
            run, size = [], 0
    if run:
        yield run


def count_tokens(documents, keep=("doc_id",), model=MODEL, limit=LIMIT):
    """The ``keep`` columns with ``n_bytes``, ``n_tokens`` and ``over_limit`` of every whole text."""

    def make():
        import sentencepiece

        encoder = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(model))
        most = PART_CHARS if safe(encoder) else float("inf")

        def count(batch):
            owners, pieces = [], []
            for i, text in enumerate(texts(batch)):
                for x in parts(text, most):
                    owners.append(i)
                    pieces.append(x)
            lengths = [len(ids) for run in byte_batches(pieces) for ids in encoder.encode(run, num_threads=1)]
            tokens = np.bincount(owners, weights=lengths, minlength=batch.num_rows).astype(np.int64)
            size = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index("text"))), 0).cast(pa.int64())
            return size, pa.array(tokens), pa.array(tokens > limit)

        return count

    return annotate(documents, FIELDS, make, keep)
