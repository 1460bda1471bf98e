import random
import zlib

import numpy as np
import pytest

from tallywharf.llm import decontamination, language, quality, toxicity
from tallywharf.llm.common import bounded_sample

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "aa": "the of and thing water stone light shown", "bb": "der und nicht stein wasser licht zeigt über",
    "cc": "le et pas pierre eau lumière être montré",
}


def corpus(spark, n=240):
    rnd = random.Random(4)
    rows = []
    for i in range(n):
        lang = sorted(WORDS)[i % 3]
        text = " ".join(rnd.choice(WORDS[lang].split()) + rnd.choice(["", "", "."]) for _ in range(30))
        if i % 8 == 1:
            text += " idiot friend"
        if i % 5 == 2:
            text = " | ".join(text.upper().split())
        rows.append((i, text, lang, f"s{i % 4}", len(text)))
    return spark.createDataFrame(rows, DOCS)


def labels(spark, documents):
    rows = [(i, int(i % 5 != 2), int(i % 8 == 1)) for i, in documents.select("doc_id").dropna().collect()]
    odd = [(3, None, None), (None, 1, 1), (99_999, 0, 1), (3, 1, 0)]
    return spark.createDataFrame(rows + odd, "doc_id long, quality int, toxic int")


def held(doc_id, parts, which):
    return zlib.crc32(str(doc_id).encode()) % parts == which


def test_language(spark):
    docs = corpus(spark)
    want = {r.doc_id: r.lang for r in docs.collect()}
    got = language.identify(docs).collect()
    assert all(r.lang_pred == want[r.doc_id] and 0 <= r.score <= 1 and r.held_out == held(r.doc_id, 4, 2) for r in got)


def test_bundles_are_sums_of_bound_letters():
    space, table = language.Space(), language.letter_table()
    codes, counts = language.trigrams("Ab, äB!", table)
    letters = [ord(c) for c in " ab äb "]
    want = sum(
        np.roll(space.letter(a), 2) * np.roll(space.letter(b), 1) * space.letter(c)
        for a, b, c in zip(letters, letters[1:], letters[2:])
    )
    assert np.array_equal(space.bundle(codes, counts), want)


def test_toxicity(spark):
    docs = corpus(spark, 600)
    got = toxicity.classify(docs, labels(spark, docs)).collect()
    right = [r.predicted == int(r.doc_id % 8 == 1) for r in got if r.held_out]
    assert len(right) > 60 and np.mean(right) > 0.97
    assert all(r.held_out == held(r.doc_id, 5, 0) and r.predicted == int(r.score >= 0.5) for r in got)


def test_pairs_tell_what_single_terms_do_not():
    """Label 1 where exactly both words meet or both are missing: no sum of weights can say that."""
    rnd = np.random.default_rng(1)
    rows, y = [], []
    for _ in range(1500):
        a, b = rnd.integers(0, 2, 2)
        rows.append(np.unique(np.concatenate([[10] if a else [11], [20] if b else [21], rnd.integers(100, 110, 3)])).astype(np.int64))
        y.append(int(a == b))
    model = toxicity.fit(rows[:1200], y[:1200], epochs=60)
    assert np.mean((model.scores(rows[1200:]) >= 0.5) == np.array(y[1200:])) > 0.95


def test_quality(spark):
    docs = corpus(spark, 600)
    got = quality.classify(docs, labels(spark, docs)).collect()
    right = [r.predicted == int(r.doc_id % 5 != 2) for r in got if r.held_out]
    assert len(right) > 60 and np.mean(right) > 0.95


def test_co_training_hands_labels_over():
    rnd = np.random.default_rng(2)
    y = rnd.integers(0, 2, 900)
    a, b = y[:, None] * 2.0 + rnd.normal(0, 0.8, (900, 3)), y[:, None] * 2.0 + rnd.normal(0, 0.8, (900, 3))
    model = quality.co_train((a[:60], b[:60]), y[:60], quality.Matrices((a[60:500], b[60:500])))
    assert np.mean((model.scores(a[500:], b[500:]) >= 0.5) == y[500:]) > 0.95


def two_views(seed, n, share, noise):
    rnd = np.random.default_rng(seed)
    y = (rnd.random(n) < share).astype(int)
    return y, tuple(y[:, None] * 1.5 + rnd.normal(0, s, (n, 4)) for s in noise)


def test_rounds_do_not_harm_and_help_where_labels_are_few():
    def losses(seed, labelled_rows, noise, rounds):
        y, (a, b) = two_views(seed, 4000, 0.85, noise)
        k, m = labelled_rows, 2500
        model = quality.co_train((a[:k], b[:k]), y[:k], quality.Matrices((a[k:m], b[k:m])), rounds=rounds)
        p = np.clip(model.scores(a[m:], b[m:]), 1e-6, 1 - 1e-6)
        return -np.mean(np.where(y[m:] == 1, np.log(p), np.log(1 - p)))

    for labelled_rows, noise in ((60, (0.9, 0.9)), (400, (0.7, 6.0)), (400, (0.7, 0.7))):
        alone, taught = ([losses(s, labelled_rows, noise, r) for s in range(8)] for r in (0, 5))
        assert np.mean(taught) <= np.mean(alone) + 0.01, (labelled_rows, noise)


def test_a_label_is_not_sure_by_its_frequency():
    """With 0.88 of label 1, neither 0.9 for it nor 0.6 against the rest is sure; 0.98 and 0.05 are."""
    logits = np.log([0.88 / 0.12, 0.9 / 0.1, 0.98 / 0.02, 0.6 / 0.4, 0.05 / 0.95])
    assert [x[:2] for x in quality.chosen(logits, np.log(0.88 / 0.12), (5, 5))] == [(2, 1), (4, 0)]
    assert [x[:2] for x in quality.chosen(-logits, -np.log(0.88 / 0.12), (5, 5))] == [(4, 1), (2, 0)]
    assert not list(quality.chosen(logits, np.log(0.88 / 0.12), (0, 0)))


def test_the_surest_of_all_rows_are_found(spark):
    """The table finds what a pool in memory finds."""
    y, _ = two_views(1, 300, 0.5, (1, 1))
    rnd = np.random.default_rng(3)
    contents = (y[:, None] * 2 + rnd.normal(0, 1, (300, len(quality.content(""))))).astype(np.float32)
    places = [sorted({int(v) * 7, 100 + i % 9}) for i, v in enumerate(y)]
    views = quality.matrices(contents, places)
    frame = spark.createDataFrame(
        [(i, c.tolist(), p) for i, (c, p) in enumerate(zip(contents, places))], "key long, content array<float>, places array<int>"
    ).repartition(5)
    view = quality.Logistic(1.0).fit(views[0][:50], y[:50], np.ones(50))
    got = quality.Table(frame).surest(0, view, 0.1, {3, 4, 250}, (20, 7))
    want = quality.Matrices(views).surest(0, view, 0.1, {3, 4, 250}, (20, 7))
    assert {k: v[0] for k, v in got.items()} == {k: v[0] for k, v in want.items()} and len(got) == 27
    assert all(np.allclose(g, w) for k in got for g, w in zip(got[k][1], want[k][1]))


@pytest.mark.parametrize("classify", [toxicity.classify, quality.classify])
def test_odd_rows(spark, odd, empty, classify):
    some = labels(spark, odd)
    assert classify(empty, some).count() == 0
    for given in (some, some.limit(0)):
        got = classify(odd, given).collect()
        assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)


def test_odd_languages(odd, empty):
    assert language.identify(empty).count() == 0
    got = language.identify(odd).collect()
    assert len(got) == odd.count()
    assert {r.lang_pred for r in got if r.doc_id in (2, 3)} == {"und"}


def test_samples_are_bounded_and_stable(spark):
    frame = spark.range(10_000).withColumnRenamed("id", "doc_id")
    a, b = ({r[0] for r in bounded_sample(f, "doc_id", 500, 1).collect()} for f in (frame, frame.repartition(13)))
    assert a == b and 400 < len(a) <= 500


def brute_hits(text, items, size):
    words, hit, found = decontamination.words(text or ""), set(), set()
    for item, body in items:
        for w in decontamination.windows(body or "", size):
            parts = w.split()
            for i in range(len(words) - len(parts) + 1):
                if words[i : i + len(parts)] == parts:
                    hit |= set(range(i, i + len(parts)))
                    found.add(item)
    return len(words), len(hit), len(found)


@pytest.mark.parametrize("block", [1 << 20, 30])
def test_decontamination(spark, odd, empty, block):
    items = [(1, "Quick, BROWN fox jumps"), (2, None), (3, ""), (4, "over\tnow"), (5, "straße"), (6, "jumps over the lazy dog quick brown"),
             (7, "alpha0 beta0 gamma0 delta0"), (8, "no such passage anywhere"), (None, "same text")]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    good = [(i, t) for i, t in items if i is not None and t]
    got = decontamination.decontaminate(odd, benchmark, ("doc_id", "text"), 3, block).collect()
    assert len(got) == odd.count()
    for r in got:
        assert (r.n_words, r.n_hit, r.n_items) == brute_hits(r.text, good, 3)
        assert r.contaminated == (r.n_hit > 0)
    assert decontamination.decontaminate(empty, benchmark).count() == 0
    assert not any(r.contaminated for r in decontamination.decontaminate(odd, benchmark.limit(0)).collect())


def test_hits_lead_back_to_the_text():
    text, items = "Well: the Quick-brown FOX; jumps!", [(1, "quick brown fox")]
    hits, found = decontamination.scan(decontamination.automaton(items, 3), decontamination.words(text))
    assert found == {"1"} and [text[a:b] for a, b in decontamination.original_spans(text, hits)] == ["Quick-brown FOX"]
