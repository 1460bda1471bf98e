"""Operator 11: groups of spelling variants, found by PartEnum signatures of letter multisets.

Two words are near if one inserted, deleted or replaced code point turns one into the other. A multiset of letters is a
binary vector with a place for every (letter, how often so far); a replaced letter changes it in two places, an inserted
one in one. The places are dealt into parts by a hash. With ``REPLACED`` parts at least ``REPLACED - 2`` agree between
words of equal length, with ``INSERTED`` parts at least ``INSERTED - 1`` between a word and one that is a letter longer, so
the words agree in one of the signatures that enumerate the parts which may agree: an equi-join of signatures finds every
pair. The one edit leaves the first or the second half of the letters as it is; a signature therefore also holds one
untouched half and the multiset of the rest, which splits the groups that common letters make. A hash of the signature is
joined; every pair that meets is verified, so collisions change nothing.

Words are distinct, so copies and hot sources only raise counts, which are added up before they are shuffled. Nothing is
collected: a group of equal signatures is joined by sort-merge, and adaptive execution splits a large one.

Nulls: a null text has no words; a null id is written as nothing in ``<doc_id>:<run>``. Rows that repeat an id count as
often as they come. Very long texts are whole slices of their own; a word is never cut. Ties between forms go to the
smallest word in code-point order. Only ``doc_id`` and ``text`` are read, so further columns may have any name. An empty
table gives no rows.
"""

import itertools
import math
import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import functions as F

from .common import crc_sql, crc_table_sql, slices, texts, values
from .sets import kept_small

#: The least letters of a word, the least occurrences, and how much more frequent a form is than its variant.
LETTERS, OCCURRENCES, MORE = 7, 2, 10
#: One run in so many loses a letter.
LOSES = 31
#: Parts of the letters' places for replaced and for inserted letters.
REPLACED, INSERTED = 4, 2
#: Distinct words that a task counts before it hands them on.
COUNTED = 1 << 18

_RUN = re.compile("[a-zÀ-ÿ]+")


def words_of(text, doc_id):
    """The words of a text with their counts, runs that lose a letter without it."""
    # Of bytes, lower() turns A-Z alone.
    runs = Counter(_RUN.findall(text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")))
    before = zlib.crc32(b"" if doc_id is None else str(doc_id).encode())
    before = zlib.crc32(b":", before)
    found = Counter()
    for run, n in runs.items():
        if len(run) >= LETTERS:
            h = zlib.crc32(run.encode(), before)
            if h % LOSES == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1 :]
            if len(run) >= LETTERS:
                found[run] += n
    return found


def vocabulary(documents, occurrences=OCCURRENCES):
    """``word``, ``n``: the words of all documents that occur at least so often."""

    def batch_of(counts):
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"]
        )

    def run(batches):
        counts = Counter()
        for batch in slices(batches):
            for doc_id, text in zip(values(batch, "doc_id").to_pylist(), texts(batch), strict=True):
                counts.update(words_of(text, doc_id))
                if len(counts) >= COUNTED:
                    yield batch_of(counts)
                    counts.clear()
        yield batch_of(counts)

    counted = documents.select("doc_id", "text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= occurrences)


class Parts:
    """Hashes of the letters' places, and the multisets of the parts they are dealt into."""

    def __init__(self):
        import xxhash

        self.hash, self.places = xxhash.xxh64_intdigest, {}

    def place(self, letter, time):
        if (letter, time) not in self.places:
            self.places[letter, time] = self.hash(f"{letter}{time}".encode())
        return self.places[letter, time]

    def sums(self, letters, parts):
        """For each part the sum of its places' hashes, which stands for its part of the multiset."""
        out, seen = [0] * parts, {}
        for letter in letters:
            time = seen[letter] = seen.get(letter, 0) + 1
            place = self.place(letter, time)
            out[place % parts] = (out[place % parts] + place) & 0xFFFFFFFFFFFFFFFF
        return out

    def signatures(self, kind, length, word, parts, agree):
        """One for each side and each choice of ``agree`` parts; ``length`` is that of the shorter word of a pair."""
        half = length // 2
        n = len(word)
        for side, kept, rest in (("<", word[:half], word[half:]), (">", word[n - (length - half) :], word[: n - (length - half)])):
            sums = self.sums(rest, parts)
            head = f"{kind}{length}{side}{kept}".encode()
            for chosen in itertools.combinations(range(parts), agree):
                body = b"".join(bytes((k,)) + sums[k].to_bytes(8, "little") for k in chosen)
                yield self.hash(head + body)

    def of(self, word, longer):
        """All signatures of a word as the one or the other word of a pair."""
        n = len(word)
        yield from self.signatures("=", n, word, REPLACED, REPLACED - 2)
        yield from self.signatures("+", n - 1 if longer else n, word, INSERTED, INSERTED - 1)


def signed(words, longer):
    """A row for every signature of every word."""

    def run(batches):
        parts = Parts()
        for batch in batches:
            found = [list(parts.of(w, longer)) for w in batch.column(0).to_pylist()]
            at = [k for k, x in enumerate(found) for _ in x]
            # As signed 64-bit integers.
            keys = [x - (1 << 64) if x >> 63 else x for own in found for x in own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64()))],
                ["signature", "word", "n"],
            )

    return words.select("word", "n").mapInArrow(run, "signature long, word string, n long")


def near_pairs(words):
    """``a``, ``a_n``, ``b``, ``b_n``: every pair of near words once, found by equal signatures and verified."""
    left = signed(words, False).toDF("signature", "a", "a_n")
    right = signed(words, True).toDF("signature", "b", "b_n")
    shorter = F.length("a") < F.length("b")
    ordered = shorter | ((F.length("a") == F.length("b")) & (F.col("a") < F.col("b")))
    met = left.join(right, (left.signature == right.signature) & ordered & (F.levenshtein("a", "b", 1) == 1))
    return met.select("a", "a_n", "b", "b_n").distinct()


def _roots(forms, steps):
    """``word``, ``root`` for every word that has a form: where its forms lead in at most ``steps`` steps."""
    at = forms.select("word", F.col("form").alias("root"))
    for _ in range(max(1, steps).bit_length()):
        on = at.toDF("via", "next")
        at = kept_small(
            at.join(on, at.root == on.via, "left").select("word", F.coalesce("next", "root").alias("root")), "roots"
        )
    return at


def variants(documents, occurrences=OCCURRENCES, more=MORE):
    """``word``, ``form``, ``root``, ``n``, ``n_near``, ``form_n`` for every word."""
    words = kept_small(vocabulary(documents, occurrences), "words")
    pairs = near_pairs(words)
    both = pairs.select(F.col("a").alias("word"), "a_n", F.col("b").alias("other"), "b_n").union(
        pairs.select("b", "b_n", "a", "a_n")
    ).toDF("word", "n", "other", "other_n")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other").alias("other")))
    near = both.groupBy("word", "n").agg(F.count("*").alias("n_near"), best.alias("best"))
    near = kept_small(near.select(
        "word", "n_near", F.when(-F.col("best.less") >= more * F.col("n"), F.struct("best.other", (-F.col("best.less")).alias("n"))).alias("to")
    ), "near")
    forms = near.where("to IS NOT NULL").select("word", F.col("to.other").alias("form"))
    # Every step multiplies the count, so the largest count bounds the steps.
    top = words.agg(F.max("n")).first()[0] or 1
    roots = _roots(forms, max(1, math.ceil(math.log(top, more)))) if more > 1 else forms.toDF("word", "root")
    return (
        words.join(near, "word", "left").join(roots, "word", "left")
        .select(
            "word", F.col("to.other").alias("form"), F.coalesce("root", "word").alias("root"), "n",
            F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"), F.col("to.n").alias("form_n"),
        )
    )


def sql():
    """The same in DuckDB's SQL: words that share what is left without one letter; crc32 byte by byte."""
    return rf"""
WITH RECURSIVE
{crc_table_sql()},
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT doc_id, unnest(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
    FROM documents)
  WHERE length(run) >= {LETTERS} GROUP BY ALL),
hashed AS (SELECT run, n, {crc_sql("coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run")} AS h FROM runs, crc_table),
w AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (
    SELECT CASE WHEN h % {LOSES} = 0 THEN run[1:h % length(run)] || run[h % length(run) + 2:] ELSE run END AS word, n FROM hashed)
  WHERE length(word) >= {LETTERS} GROUP BY word HAVING sum(n) >= {OCCURRENCES}),
cut AS (SELECT word, n, i, word[1:i - 1] || word[i + 1:] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM w)),
near AS (
  SELECT DISTINCT * FROM (
    SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
    UNION ALL SELECT a.word, a.n, b.word, b.n FROM cut a JOIN w b ON a.rest = b.word
    UNION ALL SELECT b.word, b.n, a.word, a.n FROM cut a JOIN w b ON a.rest = b.word)),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS form, max(other_n) AS form_n FROM near GROUP BY word),
f AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= {MORE} * n THEN form END AS form,
  CASE WHEN form_n >= {MORE} * n THEN form_n END AS form_n FROM w LEFT JOIN best USING (word)),
r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL
"""
