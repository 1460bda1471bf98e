import random
import re

import numpy as np
import pytest

from tallywharf.llm import families, sets, shingle_join


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    k = min(size, len(words))
    return {tuple(words[i : i + k]) for i in range(len(words) - k + 1)} if k else set()


def brute(rows, size, percent):
    """(id, set size, least id reached) by comparing all pairs; equal ids are one."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    up = {i: i for i, _ in sets}

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for n, (i, a) in enumerate(sets):
        for j, b in sets[:n]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((top(i), top(j)))
                up[y] = x
    return sorted(((i, len(shingles(t, size)), None if i is None else top(i)) for i, t in rows), key=repr)


def edits(seed, families, members):
    rnd = random.Random(seed)
    words = [f"w{i}" for i in range(4000)]
    rows, n = [], 0
    passage = rnd.sample(words, 60)
    for f in range(families):
        base = rnd.sample(words, rnd.choice([3, 9, 12, 30, 80, 150])) + (passage if f % 2 else [])
        for _ in range(members):
            text = list(base)
            for _ in range(rnd.randrange(0, 1 + len(base) // 25)):
                text[rnd.randrange(len(text))] = rnd.choice(words)
            rows.append((n, " ".join(text)))
            n += 1
    rnd.shuffle(rows)
    return rows + [(n + 1, None), (n + 2, ""), (n + 3, " \n"), (n + 4, "one"), (n + 5, "ONE"), (n + 6, "one two")]


@pytest.mark.parametrize("size, percent", [(3, 90), (5, 80)])
@pytest.mark.parametrize("block", [512, 6])
def test_groups_against_all_pairs(spark, monkeypatch, size, percent, block):
    monkeypatch.setattr(families, "BLOCK", block)
    monkeypatch.setattr(families, "PIVOTS", block // 3)
    monkeypatch.setattr(shingle_join, "LIST", min(24, block))
    rows = edits(size * percent + block, 12, 22)
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = sorted((tuple(r) for r in shingle_join.join(frame, size, percent).collect()), key=repr)
    assert got == brute(rows, size, percent)


def test_odd_rows(odd):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    got = sorted((tuple(r) for r in shingle_join.join(odd).collect()), key=repr)
    assert got == brute(rows, 3, 90)


def test_an_empty_table(empty):
    assert shingle_join.join(empty).count() == 0


def test_repeated_ids_join_their_groups(spark):
    rows = [(k % 40, " ".join(f"w{(k + j) % 23}" for j in range(12 + k % 3))) for k in range(120)] + [(3, ""), (None, "w1 w2 w3"), (None, "w1 w2 w3")]
    frame = spark.createDataFrame([(*r, "a", 1) for r in rows], "doc_id long, text string, value string, n long")
    assert sorted((tuple(r) for r in shingle_join.join(frame).collect()), key=repr) == brute(rows, 3, 90)


def test_every_linked_pair_meets():
    """Whatever the counters say: none, few or all tokens may be frequent."""
    rnd = np.random.default_rng(3)
    for percent in (80, 90):
        ranges = shingle_join.Ranges(percent)
        for share in (0.0, 0.1, 0.9, 1.0):
            table = np.where(rnd.random(shingle_join.CELLS) < share, 9000, rnd.integers(0, 900, shingle_join.CELLS)).astype(np.uint16)
            linked = 0
            for _ in range(500):
                n = int(rnd.integers(1, 260))
                a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
                most = len(a) * (100 - percent) // percent
                gone, fresh = int(rnd.integers(0, most + 1)), int(rnd.integers(0, most + 1))
                b = np.unique(np.concatenate([a[gone:], rnd.integers(0, 1 << 63, fresh).astype(np.uint64)]))
                both = len(np.intersect1d(a, b))
                if (gone or fresh) and 100 * both >= percent * (len(a) + len(b) - both):
                    linked += 1
                    x, y = (shingle_join.index_values(t, table, ranges) for t in (a, b))
                    assert len(np.intersect1d(x, y))
            assert linked > 50


def test_sets_that_cannot_link_need_no_index():
    for percent in (80, 90):
        for n in range(1, 60):
            other = any(
                100 * both >= percent * (n + m - both) for m in range(1, 120) for both in range(min(n, m) + 1) if (both, m) != (n, n)
            )
            assert shingle_join.can_link(n, percent) == other


def test_counters_add_up_over_tasks(spark):
    texts = [(k, " ".join(f"w{(k * 7 + j) % 50}" for j in range(40))) for k in range(60)]
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    found = [shingle_join.frequencies(shingle_join.described(frame.repartition(n))) for n in (1, 5)]
    assert (found[0] == found[1]).all()
    counted = np.zeros(shingle_join.CELLS, np.int64)
    for x in sets.shingle_sets([t for _, t in texts], 3):
        np.add.at(counted, shingle_join._cells(x), 1)
    order = np.argsort(counted, kind="stable")
    assert (np.diff(found[0][order].astype(int)) >= 0).all()


def test_profiles_never_hide_a_link():
    rnd = np.random.default_rng(9)
    for _ in range(400):
        n, m = rnd.integers(1, 400, 2)
        a = np.unique(rnd.integers(0, 1 << 63, n).astype(np.uint64))
        b = np.unique(np.concatenate([a[: rnd.integers(0, len(a) + 1)], rnd.integers(0, 1 << 63, m // 3).astype(np.uint64)]))
        both = len(np.intersect1d(a, b))
        for percent in (50, 80, 90):
            if len(b) and 100 * both >= percent * (len(a) + len(b) - both):
                assert shingle_join.may_link(shingle_join.profile(a), shingle_join.profile(b), percent)
    apart = [shingle_join.profile(np.unique(rnd.integers(0, 1 << 63, 300).astype(np.uint64))) for _ in range(2)]
    assert not shingle_join.may_link(*apart, 80)


def test_words_are_hashed_alike_however_texts_are_cut(monkeypatch):
    texts = ["a bb  ccc\n", "", " ", "BB x" * 30, "É é ccc", "y" * 90 + " bb"]
    flat, counts = sets.hashed_words(texts)
    words = [w for t in texts for w in t.encode().lower().split()]
    assert counts.tolist() == [len(t.encode().split()) for t in texts]
    for x, h in zip(words, flat.tolist(), strict=True):
        assert all((x == y) == (h == g) for y, g in zip(words, flat.tolist(), strict=True))
    monkeypatch.setattr(sets, "HASHED_BYTES", 16)
    assert (sets.hashed_words(texts)[0] == flat).all()
