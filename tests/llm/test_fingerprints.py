import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallywharf.llm import fingerprints as f

DOCUMENTS = "/root/testdata/sf0.01/documents.parquet"


def test_peeling_recovers_what_differs():
    rnd = np.random.default_rng(1)
    for n, mine, theirs in ((0, 0, 0), (5, 1, 0), (40, 3, 4), (200, 60, 90), (3000, 500, 2)):
        common, a, b = (rnd.integers(1, 1 << 63, k).astype(np.uint64) for k in (n, mine, theirs))
        cells = f.PARTS * (10 + mine + theirs)
        got = f.peel(f.subtract(f.sketch(np.concatenate([common, a]), cells), f.sketch(np.concatenate([common, b]), cells)))
        assert got and np.array_equal(np.sort(got[0]), np.sort(a)) and np.array_equal(np.sort(got[1]), np.sort(b))


def test_a_small_sketch_fails_and_a_larger_one_does_not():
    a, b = (f.Version(" ".join(f"Sentence {k} number {i}." for i in range(300))) for k in ("one", "two"))
    assert f.peel(f.subtract(a.sketch(), b.sketch())) is None
    mine, theirs, cells = f.difference(a, b)
    assert (len(mine), len(theirs)) == (300, 300) and cells > f.FIRST_CELLS


def brute(rows):
    """Likeness from the digests themselves, for each row and the next in descending order of ids."""
    order = sorted(rows, key=lambda r: (-(r[0] if r[0] is not None else f.LOWEST), r[1] or ""))
    out = []
    for i, (doc_id, text) in enumerate(order):
        text, following = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]

        def like(other, mine=set(f.digests(text).tolist())):
            other = set(f.digests(other).tolist())
            return len(mine & other) / len(mine | other) if mine | other else 1.0

        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), like(edited), like(following)))
    return sorted(out, key=repr)


def got(frame):
    rows = [tuple(r) for r in f.edited(frame).select("doc_id", "n_chars", "edited_sha256", "near_edited", "near_next").collect()]
    return sorted(rows, key=repr)


def test_odd_rows(odd):
    assert got(odd.repartition(4)) == brute([(r.doc_id, r.text) for r in odd.collect()])


@pytest.mark.parametrize("n", [1, 2, 300])
def test_neighbours_over_many_ranges(spark, n):
    rnd = random.Random(n)
    rows = [(i * i, ". ".join(f"s{rnd.randrange(9)} w{rnd.randrange(9)}" for _ in range(rnd.randrange(20)))) for i in range(n)]
    assert got(spark.createDataFrame(rows, "doc_id long, text string").repartition(7)) == brute(rows)


def test_equal_texts_have_equal_fingerprints(odd):
    rows = f.edited(odd).where("doc_id = 5").select("fingerprint").distinct()
    assert rows.count() == 1


@pytest.mark.skipif(not os.path.exists(DOCUMENTS), reason="no test data")
def test_all_repeated_texts_have_equal_fingerprints(spark):
    documents = spark.read.parquet(DOCUMENTS)
    found = f.edited(documents).join(documents.select("doc_id", "text"), "doc_id").groupBy("text").agg(
        F.count("*").alias("n"), F.countDistinct("fingerprint").alias("kinds"))
    assert found.where("n > 1").count() > 20
    assert found.where("kinds <> 1").count() == 0


def plain_pieces(text):
    """Character by character."""
    out, piece = [], ""
    for k, c in enumerate(text):
        piece += c
        last = text[max(0, k + 1 - f.WINDOW) : k + 1]
        hashed = sum(ord(x) * int(y) for x, y in zip(last, f._FACTORS, strict=False)) % (1 << 32)
        mark = c in "\n.!?。！？" and (k + 1 == len(text) or text[k + 1] not in "\n.!?。！？")
        if mark or len(last) == f.WINDOW and hashed < (1 << 32) // f.PIECE:
            out.append(piece)
            piece = ""
    out.append(piece)
    return [x for p in out for k in range(0, len(p), f.LONGEST) if (x := p[k : k + f.LONGEST].strip())]


def test_pieces_and_digests_against_single_characters(monkeypatch):
    rnd = random.Random(7)
    for n in (0, 1, 5, 199, 200, 201, 900, 5000):
        for alphabet in ("ab. \n", "abcdefgh \u3000é漢!", "x", "abcdefghijklmnop", " \n\t"):
            text = "".join(rnd.choices(alphabet, k=n))
            codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
            want = plain_pieces(text)
            if n:
                assert [text[a:b] for a, b in zip(*f.pieces(codes), strict=True)] == want
            times = {}
            for x in want:
                times[x] = times.get(x, 0) + 1
            keys = {(x, k) for x, m in times.items() for k in range(m)}
            assert len(f.digests(text)) == len(keys)
            monkeypatch.setattr(f, "HASHED", 64)
            cut = f.digests(text)
            monkeypatch.setattr(f, "HASHED", 1 << 20)
            assert np.array_equal(cut, f.digests(text))


def test_an_empty_table(empty):
    assert f.edited(empty).count() == 0


def alike(a, b):
    return f.likeness(f.Version(a), f.Version(b))


@pytest.mark.parametrize("n", [40, 59, 60, 61, 400])
def test_one_digest_rule_at_all_sizes(n):
    rnd, longer, half = random.Random(n), [], []
    for _ in range(30):
        words = ["".join(rnd.choices("abcdefghijklmnop", k=rnd.randrange(2, 9))) for _ in range(n + 1)]
        longer.append(alike(" ".join(words[:n]), " ".join(words)))
        half.append(alike(" ".join(words), " ".join(words[n // 2 :])))
    assert np.mean(longer) > 0.7 and np.mean(half) > 0.3


def test_texts_without_marks_or_words_have_many_digests():
    rnd = random.Random(3)
    text = "".join(rnd.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=4000))
    assert len(f.digests(text)) > 80 and alike(text, text[:2000] + "+" + text[2000:]) > 0.9
    assert len(f.digests("De " * 700)) > 9 and alike("De " * 700, "De " * 350 + "Fu " * 350) > 0.25


def test_returned_fingerprints_recover_what_differs(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(f"w{rnd.randrange(10_000)}" for _ in range(rnd.choice([0, 3, 40, 900])))) for i in range(60)]
    rows += [(60, "x" * 5000), (61, "x" * 80 + ". y" * 2000), (62, None)]
    found = f.edited(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    order = sorted(rows, reverse=True)
    following = {a[0]: b[1] or "" for a, b in zip(order, order[1:] + order[:1], strict=True)}
    for r in found:
        text = dict(rows)[r.doc_id] or ""
        a, b = set(f.digests(text).tolist()), set(f.digests(f.edit(text, following[r.doc_id])).tolist())
        own = f.Version(text).fingerprint(), f.Version(f.edit(text, following[r.doc_id])).fingerprint()
        assert (r.fingerprint, r.edited_fingerprint) == own
        larger = r.larger_fingerprint, r.larger_edited_fingerprint
        mine, theirs = f.recovered(*(own if larger == (None, None) else larger))
        assert set(mine.tolist()) == a - b and set(theirs.tolist()) == b - a and len(mine) == len(a - b)
