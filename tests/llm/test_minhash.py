import random

import numpy as np
import pytest

from tallywharf.llm import families, minhash
from tallywharf.llm.shingle_join import shingle_sets

from test_shingle_join import edits, shingles


def brute(rows, size=4, percent=80):
    """By all pairs of rows: (id, set size, least id of the component, whether it stays)."""
    sets = [shingles(t, size) for _, t in rows]
    up = list(range(len(rows)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[top(i)] = top(j)
    least = {}
    for i, (doc_id, _) in enumerate(rows):
        if doc_id is not None:
            least[top(i)] = min(doc_id, least.get(top(i), doc_id))
    out = [(d, len(s), least.get(top(i))) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True))]
    return sorted(((d, n, c if n else d, d == (c if n else d)) for d, n, c in out), key=repr)


def run(frame):
    return sorted(((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in minhash.groups(frame).collect()), key=repr)


@pytest.mark.parametrize("block, longest", [(512, 24), (6, 3)])
def test_groups_against_all_pairs(spark, monkeypatch, block, longest):
    monkeypatch.setattr(families, "BLOCK", block)
    monkeypatch.setattr(families, "PIVOTS", 2)
    monkeypatch.setattr(minhash, "LIST", longest)
    rows = edits(block, 12, 22)
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)) == brute(rows)


def test_odd_rows_and_empty_tables(odd, empty):
    assert run(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert run(empty) == []


def test_repeated_and_null_ids_and_clashing_columns(spark):
    text, other = " ".join(f"w{k}" for k in range(40)), " ".join(f"v{k}" for k in range(40))
    near = text.replace("w39", "x")
    rows = [(7, text), (7, other), (None, near), (None, near), (3, other + " more"), (None, "alone in this world of words"), (7, text)]
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], "doc_id long, text string, id long, family string, n long")
    assert run(frame) == brute(rows)


def test_copies_and_near_copies_that_are_most_of_the_table(spark):
    rnd = random.Random(8)
    base = [f"w{rnd.randrange(10_000)}" for _ in range(120)]
    rows = [(k, " ".join(base)) for k in range(300)]
    for k in range(300, 700):
        text = list(base)
        for _ in range(rnd.randrange(1, 9)):
            text[rnd.randrange(len(text))] = f"x{rnd.randrange(10_000)}"
        rows.append((k, " ".join(text)))
    rows += [(k, " ".join(f"y{rnd.randrange(10_000)}" for _ in range(50))) for k in range(700, 760)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string").repartition(6)) == brute(rows)


def test_estimates_are_close_and_exact_for_small_sets():
    rnd = np.random.default_rng(4)
    off = []
    for n in (20, 400):
        for _ in range(60):
            words = [f"w{x}" for x in rnd.integers(0, 1 << 40, n)]
            cut = list(words)
            for k in rnd.integers(0, n, max(1, n // 50)):
                cut[k] = "other"
            a, b = shingle_sets([" ".join(words), " ".join(cut)], 4)
            x, y = a[: minhash.K], b[: minhash.K]
            union = np.union1d(x, y)[: minhash.K if max(len(x), len(y)) == minhash.K else None]
            got = np.isin(union, np.intersect1d(x, y)).mean()
            true = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
            if n == 20:
                assert got == true
            off.append(abs(got - true))
    assert np.mean(off) < 0.05


def test_families_against_all_pairs(spark, monkeypatch):
    """One family whose members hang together in chains, in blocks that cut the chains."""
    monkeypatch.setattr(families, "BLOCK", 4)
    monkeypatch.setattr(families, "PIVOTS", 1)
    sets = [np.arange(start, start + 20, dtype="<u8") for start in [*range(0, 120, 2), *range(1000, 1060, 3), 5000, 6000]]
    frame = spark.createDataFrame(
        [(1, k, len(x), bytearray(x.tobytes())) for k, x in enumerate(sets)], families.SETS
    )
    got = {r.id: r.component for r in families.linked(frame, 80).collect()}
    up = list(range(len(sets)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(np.intersect1d(a, b))
            if 100 * both >= 80 * (len(a) + len(b) - both):
                top = up[i], up[j]
                up = [min(top) if x in top else x for x in up]
    assert {k: got.get(k, k) for k in range(len(sets))} == dict(enumerate(up))
