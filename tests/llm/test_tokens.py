import collections
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tallywharf.llm import packing, token_counts, token_files
from tallywharf.llm.encode import Encoder

FILES = token_files.TOKENIZER, packing.TOKENIZER


def whole(file, text):
    ids = Tokenizer.from_file(public_tokenizers.path(file)).encode(text or "", add_special_tokens=False).ids
    return np.array([*ids, 1], dtype="<u4").tobytes()


@pytest.mark.parametrize("file", FILES)
def test_pieces_encode_as_the_whole_text(file):
    encoder = Encoder(file, kept=50)
    plain = Tokenizer.from_file(public_tokenizers.path(file))

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=" \n\t abS's.,1é́Σ<|endoftext|>漢", max_size=60))
    def same(text):
        assert encoder.encode([text])[0] == np.array(plain.encode(text, add_special_tokens=False).ids, dtype="<u4").tobytes()

    same()


@pytest.mark.parametrize("file", FILES)
@pytest.mark.parametrize("template", ["a {}.", "a {} b", "{}", "A{}, b", "x {}\u0301 y.", "\u0399{}. \u03a3 z"])
def test_every_code_point_encodes_as_in_the_whole_text(file, template):
    points = [chr(k) for k in range(1, 0x32000) if unicodedata.category(chr(k)) not in ("Cn", "Cs", "Co")]
    points = [c for c in points if not 0x3500 < ord(c) < 0x9F00 and not 0xAC10 < ord(c) < 0xD7A0 and not 0x17100 < ord(c) < 0x18C00 and not 0x20100 < ord(c) < 0x31300]
    texts = [template.format(c) for c in points]
    plain = Tokenizer.from_file(public_tokenizers.path(file)).encode_batch(texts, add_special_tokens=False)
    got = Encoder(file).encode(texts)
    bad = [t for t, g, p in zip(texts, got, plain, strict=True) if g != np.array(p.ids, dtype="<u4").tobytes()]
    assert not bad, (len(bad), bad[:5])


def test_marks_after_letters_need_no_offsets(monkeypatch):
    """Runs of marks are told from the letters before them by the words themselves, each run encoded once."""
    file = "word_bpe_49k.json"
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    marks = string.punctuation
    runs = [*marks, *(a + b for a in marks for b in marks), *(3 * a for a in marks)]
    stems = ("red", "s", "ll", "naïve", "e\u0301te", "Ǆ", "ß", "ﬁ", "中文", "a\u0338")
    texts = ["x " + " ".join(stem + run for run in runs) + " y" for stem in stems]
    offsets = []
    encoder = Encoder(file)
    plain = encoder._by_offset
    monkeypatch.setattr(encoder, "_by_offset", lambda words: (offsets.extend(words), plain(words))[1])
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids
    assert not [w for w in offsets if w.isascii()]


@pytest.mark.parametrize("file", FILES)
def test_words_are_put_together_from_parts(file, monkeypatch):
    """Marks after letters and words after a line feed are not encoded again in each combination, nor are they looked up
    at each place."""
    stems = ["red", "Roja", "naïve", "Éclair", "中文"]
    ends = ["", ".", "!!", "###", ".,!!", "'", "'!", "$$$"]
    words = [a + b for a in stems for b in ends]
    words += [a + "\n" + b for a in words for b in words]
    random = np.random.default_rng(3)
    texts = [" ".join(words[k] for k in random.integers(0, len(words), 400)) for _ in range(40)]
    texts += ["red", "red.\nRoja!!", "red\n\nRoja it", "'s red.\n's it\n", "\nred", "a\u1680\nred", ""]
    texts += ["red a.\n\nb", "red a\n\n<|endoftext|>", "red a\n\n\nb", "red a\n\n", "x<|endoftext|>!\nred <|endoftext|>"]
    tokenizer = Tokenizer.from_file(public_tokenizers.path(file))
    encoder = Encoder(file)
    calls = []
    for name in ("_plain", "_marked", "_by_offset"):
        monkeypatch.setattr(encoder, name, lambda words, f=getattr(encoder, name): (calls.extend(words), f(words))[1])
    for text, got in zip(texts, encoder.encode(texts), strict=True):
        assert np.frombuffer(got, dtype="<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text
    assert len(calls) < 60, len(calls)


@pytest.mark.parametrize("file", FILES)
def test_words_that_come_again_stay_known(file, monkeypatch):
    """A table that is full gives way to a new one, into which words go over when they come again."""
    encoder, calls = Encoder(file, kept=20), []
    plain = encoder._plain
    monkeypatch.setattr(encoder, "_plain", lambda words: (calls.extend(words), plain(words))[1])
    for k in range(30):
        new = " ".join("".join(chr(97 + int(c)) for c in str(1000 + 7 * k + x)) for x in range(7))
        encoder.encode([f"x often {new} again"])
    assert calls.count("often") == calls.count("again") == 1
    assert len(encoder.words) + len(encoder.before) < 2 * 20 + 2 * 11


def test_files_follow_each_other_by_number(spark):
    names = spark.createDataFrame([(f"part-{k:05d}-x.orc",) for k in (99999, 100000, 7)], "file string")
    assert [r.file[5:-6] for r in names.orderBy(token_files.file_number(names.file)).collect()] == ["00007", "99999", "100000"]


def test_look_ups_skip_stripes(spark, folder):
    frame = spark.range(0, 60_000, 2).select(F.col("id").alias("doc_id"), F.concat_ws(" ", *[F.col("id")] * 30).alias("text"))
    token_files.write(frame.repartition(1), f"{folder}/ids")
    found = token_files.lookup(spark, f"{folder}/ids", [31_000])
    assert [r.doc_id for r in found.collect()] == [31_000]
    plan = found._jdf.queryExecution().executedPlan()
    found._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    read = sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size()))
    assert 1 <= read <= 4000, read
    # Between the ids that are there lie others that only a Bloom filter can rule out.
    none = token_files.lookup(spark, f"{folder}/ids", [31_001])
    plan = none._jdf.queryExecution().executedPlan()
    none._jdf.queryExecution().toRdd().count()
    leaves = plan.collectLeaves()
    assert sum(leaves.apply(k).metrics().apply("numOutputRows").value() for k in range(leaves.size())) <= 1000


def brute_files(rows):
    start, out = 0, []
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        ids = whole(token_files.TOKENIZER, text)
        out.append((doc_id, start, len(ids) // 4, zlib.crc32(ids)))
        start += len(ids) // 4
    return sorted(out, key=repr)


def test_files_round_trip(spark, odd, folder):
    token_files.write(odd.repartition(5), f"{folder}/ids")
    got = [tuple(r) for r in token_files.digests(spark, f"{folder}/ids").collect()]
    assert sorted(got, key=repr) == brute_files([(r.doc_id, r.text) for r in odd.collect()])


def test_files_of_an_empty_table(spark, empty, folder):
    token_files.write(empty, f"{folder}/ids")
    assert token_files.digests(spark, f"{folder}/ids").count() == 0


def test_lookup_is_pushed_to_the_files(spark, odd, folder):
    token_files.write(odd, f"{folder}/ids")
    found = token_files.lookup(spark, f"{folder}/ids", [5, 9])
    assert sorted(r.doc_id for r in found.collect()) == [5, 5, 9]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "In(doc_id, [5,9])" in plan


def check_places(rows, documents, length):
    got = {}
    for r in rows:
        got.setdefault(r.sequence_id, []).append(r)
    for members in got.values():
        at = 0
        for r in sorted(members, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= length
    texts = {}
    for doc_id, text in documents:
        ids = whole(packing.TOKENIZER, text)
        for a in range(0, len(ids), 4 * length):
            part = ids[a : a + 4 * length]
            key = (doc_id, a // 4, len(part) // 4, zlib.crc32(part), len(ids) // 4)
            texts[key] = texts.get(key, 0) + 1
    for r in rows:
        texts[r.doc_id, r.start, r.length, r.ids_crc32, r.doc_tokens] -= 1
    assert not any(texts.values())


def test_packing(odd):
    documents = [(r.doc_id, r.text) for r in odd.collect()]
    for groups in (2, 100):
        check_places(packing.pack_documents(odd, 64, group_documents=groups).collect(), documents, 64)


def test_packing_an_empty_table(empty):
    assert packing.pack_documents(empty).count() == 0
    assert packing.sequences(empty).count() == 0


def test_first_fit_decreasing_is_the_plain_one():
    random = np.random.default_rng(5)
    for n in (1, 2, 3, 7, 64, 200):
        lengths = sorted(random.integers(1, 65, n).tolist(), reverse=True)
        room, want = [], []
        for x in lengths:
            k = next((i for i, r in enumerate(room) if r >= x), len(room))
            if k == len(room):
                room.append(64)
            want.append((k, 64 - room[k]))
            room[k] -= x
        assert list(zip(*packing.first_fit_decreasing(lengths, 64), strict=True)) == want


def test_sequences_hold_every_id(odd):
    rows = packing.sequences(odd, 64, pad_id=-1).collect()
    assert all(len(r.ids) == 64 and set(r.ids[r.n_ids :]) <= {-1} for r in rows)
    ids = sorted(i for r in rows for i in r.ids[: r.n_ids])
    want = sorted(i for r in odd.collect() for i in np.frombuffer(whole(packing.TOKENIZER, r.text), "<u4").tolist())
    assert ids == want


def brute_count(text):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    return len(model.encode(text or ""))


def test_counts(odd, monkeypatch):
    for most in (1 << 15, 10):
        monkeypatch.setattr(token_counts, "PART_CHARS", most)
        got = token_counts.count_tokens(odd, limit=100).collect()
        want = [(r.doc_id, len((r.text or "").encode()), n := brute_count(r.text), n > 100) for r in odd.collect()]
        assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)


def test_parts_keep_the_count():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(token_counts.MODEL))
    assert token_counts.safe(model)

    @settings(max_examples=300, deadline=None)
    @given(st.text(alphabet=" ▁\nab.é漢1", max_size=80))
    def same(text):
        assert sum(len(model.encode(x)) for x in token_counts.parts(text, 5)) == len(model.encode(text))

    same()


def test_counts_of_an_empty_table(empty):
    assert token_counts.count_tokens(empty).count() == 0


def test_a_hot_id_is_spread_over_the_groups(spark):
    """Every piece has one id, or none; no group gets much more than its share, and every piece stays."""
    rows = [(7 if i % 2 else None, i * 3, 1 + i % 90, i * 7919, 400) for i in range(4000)]
    parts = spark.createDataFrame(rows, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long").repartition(4)
    got = packing.pack(parts, 8, 100).collect()
    groups = collections.Counter(r.sequence_id >> 32 for r in got)
    assert len(groups) == 8 and max(groups.values()) < 2 * 4000 / 8
    assert sorted((r.start, r.ids_crc32) for r in got) == sorted((s, c) for _, s, _, c, _ in rows)
