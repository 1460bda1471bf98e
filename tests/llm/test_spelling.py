import itertools
import random
import zlib

import pytest

from tallywharf.llm import spelling


def near(a, b):
    """Exactly one inserted, deleted or replaced code point."""
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def plain_words(rows):
    """Counts by reading character by character."""
    counts = {}
    for doc_id, text in rows:
        run = ""
        for c in (text or "") + " ":
            if "A" <= c <= "Z" or "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c.lower() if "A" <= c <= "Z" else c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                if len(run) >= 7:
                    counts[run] = counts.get(run, 0) + 1
            run = ""
    return {w: n for w, n in counts.items() if n >= 2}


def brute(rows):
    words = plain_words(rows)
    out = {}
    for w, n in words.items():
        others = [x for x in words if near(w, x)]
        form = min(others, key=lambda x: (-words[x], x.encode()), default=None)
        form = form if form is not None and words[form] >= 10 * n else None
        out[w] = (form, n, len(others), words.get(form))
    rows = []
    for w, (form, n, k, form_n) in out.items():
        root = w
        while out[root][0] is not None:
            root = out[root][0]
        rows.append((w, form, root, n, k, form_n))
    return sorted(rows)


COLUMNS = ("word", "form", "root", "n", "n_near", "form_n")


def run(frame):
    return sorted(tuple(r[c] for c in COLUMNS) for r in spelling.variants(frame).collect())


def vary(rnd, word):
    k, c = rnd.randrange(len(word) + 1), rnd.choice("aeéßÿÀ÷n")
    return rnd.choice((word[:k] + c + word[k:], word[:k] + word[k + 1 :], word[:k] + c + word[k + 1 :]))


@pytest.mark.parametrize("seed", [1, 2])
def test_against_all_pairs(spark, seed):
    rnd = random.Random(seed)
    stems = ["".join(rnd.choice("abenrtéç") for _ in range(rnd.randrange(6, 12))) for _ in range(25)]
    texts = []
    for stem in stems:
        # Counts that fall by more than ten at each step, so forms follow one another.
        texts += [stem] * 300
        once = vary(rnd, stem)
        texts += [once.upper()] * 25 + [once] * 2
        texts += [vary(rnd, once)] * 2 + [vary(rnd, stem) for _ in range(40)]
    rnd.shuffle(texts)
    rows = [(k // 9, " ".join(texts[k : k + 9])) for k in range(0, len(texts), 9)]
    rows += [(None, "nothing nothing Nothing's noïthing"), (3, None), (4, ""), (5, "nothing×nothing÷nothing " * 2)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert got == brute(rows)


def test_forms_lead_on_to_a_root(spark):
    texts = ["remember"] * 4000 + ["remembber"] * 120 + ["remembbber"] * 6
    rows = [(k, text) for k, text in enumerate(texts)]
    got = run(spark.createDataFrame(rows, "doc_id long, text string"))
    assert got == brute(rows)
    assert ("remembbber", "remembber", "remember") in [r[:3] for r in got]


def test_pairs_of_every_kind_share_a_signature():
    parts, rnd = spelling.Parts(), random.Random(5)
    for _ in range(3000):
        a = "".join(rnd.choice("aabcß") for _ in range(rnd.randrange(7, 14)))
        b = vary(rnd, a)
        if not near(a, b) or len(b) < 7:
            continue
        short, long = sorted((a, b), key=len)
        assert set(parts.of(short, False)) & set(parts.of(long, True))


def test_ties_go_to_the_smallest_word(spark):
    rows = [(k, "mission mission mission mission mission " * 4 + "fission " * 20) for k in range(3)] + [(9, "zission zission")]
    words = plain_words(rows)
    got = {r[0]: r for r in run(spark.createDataFrame(rows, "doc_id long, text string"))}
    best = min((w for w in words if near("zission", w)), key=lambda w: (-words[w], w))
    assert got["zission"][1] == best and got["zission"][4] == sum(near("zission", w) for w in words)


def test_repeated_rows_count_and_other_columns_do_not_matter(spark):
    rows = [(1, "variant variant", "a", 1, "b"), (1, "variant variant", "a", 1, "b")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, word string, n long, signature string")
    assert run(frame) == brute([r[:2] for r in rows])


def test_odd_rows_and_empty_tables(odd, empty):
    assert run(odd) == brute([(r.doc_id, r.text) for r in odd.collect()])
    assert run(empty) == []


def test_one_word_in_a_third_of_all_rows(spark):
    rows = [(k, "commonword " * 50 if k % 3 == 0 else f"rare{'abcdefghij'[k % 10]}word comonword") for k in range(300)]
    assert run(spark.createDataFrame(rows, "doc_id long, text string")) == brute(rows)


def test_near_is_symmetric():
    for a, b in itertools.product(("abcdefg", "abcdefgh", "abcdegf", "abcdef"), repeat=2):
        assert near(a, b) == near(b, a)
