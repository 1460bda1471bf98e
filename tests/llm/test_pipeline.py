import random

import pytest

import corpus_pipeline
from tallywharf.llm import decontamination, private

DOCS = "doc_id long, text string, lang string, source string, n_chars long, group string"
ITEM = "which stone is the heaviest stone that the river can carry down"


def corpus():
    rnd = random.Random(9)
    vocabulary = {"aa": [f"thing{i}" for i in range(300)], "bb": [f"wöchte{i}" for i in range(300)]}
    vocabulary = {k: ["".join(c if c.isalpha() else "abcdefghij"[int(c)] for c in w) for w in v] for k, v in vocabulary.items()}
    rows = []
    for i in range(60):
        lang = "ab"[i % 2] * 2
        rows.append([i, " ".join(rnd.choices(vocabulary[lang], k=60)) + ".", lang, f"s{i % 3}", 0, "g"])
    rows[7][1] += " " + ITEM
    rows[9][1] += " write to ann.12@mail3.example.com today"
    copy = [60, rows[5][1], "bb", "s", 0, "g"]
    near = [61, rows[5][1] + " and", "bb", "s", 0, "g"]
    rows += [copy, near, list(rows[4]), [63, None, None, None, None, None], [64, "", "aa", "s", 0, "g"], [65, "12 %", "aa", "s", 0, "g"]]
    for r in rows:
        r[4] = None if r[1] is None else len(r[1])
    return rows


@pytest.fixture
def tables(spark, folder):
    spark.createDataFrame(corpus(), DOCS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, None)], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder


def test_stages(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables)
        out.write.parquet(f"{tables}/out/{name}")
        docs = spark.read.parquet(f"{tables}/out/{name}")
        kept[name] = docs.collect()
        assert name == "packing" or docs.columns == columns
    ids = {name: sorted(r.doc_id for r in rows) for name, rows in kept.items()}
    assert ids["language"] == sorted([*range(62), 4])
    assert ids["near_duplicates"] == list(range(60))
    clean = [r.doc_id for r in kept["near_duplicates"] if not decontamination.scan(
        decontamination.automaton([(1, ITEM)]), decontamination.words(r.text))[0]]
    assert ids["decontamination"] == sorted(clean) == [i for i in range(60) if i != 7]
    masked = {r.doc_id: r for r in kept["private_data"]}
    for r in kept["decontamination"]:
        want = private.masked(r.text, private.base_spans(r.text))
        assert masked[r.doc_id].text == want and masked[r.doc_id].n_chars == len(want)
    assert masked[9].text.endswith("write to <email> today")
    assert sorted({r.doc_id for r in kept["packing"]}) == ids["private_data"]


def test_run_and_empty_tables(spark, tables, folder):
    assert {r.doc_id for r in corpus_pipeline.run(spark, tables).collect()} == set(range(60)) - {7}
    empty = f"{folder}/empty"
    spark.createDataFrame([], DOCS).write.parquet(f"{empty}/documents.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{empty}/benchmark.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_near_duplicates_go_by_row(spark, folder):
    rnd = random.Random(4)
    a, b, c, d = (" ".join(rnd.choices([f"w{i}" for i in range(500)], k=60)) for _ in range(4))
    rows = [(1, a), (7, a), (7, b), (8, c), (8, c + " end"), (None, d), (None, d + " end"), (9, d)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = corpus_pipeline.one_of_each_group(spark, docs, folder).collect()
    assert sorted((r.doc_id, r.text.removesuffix(" end")) for r in got) == sorted([(1, a), (7, b), (8, c), (9, d)])


def test_stages_leave_clashing_columns_alone(spark, tables):
    """Columns with the names that stages use inside stay as they are; ids repeat and are null."""
    names = ("_row", "_text", "_n_chars", "component_id", "spans", "lang_pred", "score")
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    docs = docs.selectExpr("IF(doc_id % 7 = 0, NULL, doc_id % 20) AS doc_id", "* EXCEPT (doc_id)", *[f"concat('{n}', doc_id) AS {n}" for n in names])
    columns, rows = docs.columns, docs.count()
    want = {n: {r[n] for r in docs.select(n).distinct().collect()} for n in names}
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, tables)
        assert docs.columns == columns
        assert all({r[n] for r in docs.select(n).distinct().collect()} <= want[n] for n in names)
    assert 50 < docs.count() < rows
