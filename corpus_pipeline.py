"""The corpus pipeline: documents in, packed pieces out. A stage reads what the stage before it has kept.

1. Language identification: documents whose language is ``und``, those without a letter, go.
2. N-gram Jaccard join, five words and a similarity of 0.8: of each group the row with the least id stays.
3. Benchmark decontamination: documents that hold a window of a benchmark item go.
4. Personal data: all spans are masked in the text, and ``n_chars`` follows.
5. Packing: the pieces of what is left.

All but the last return the columns of ``documents``. Null and empty texts have no language and go in the first stage; rows
are told apart by place, not by id, so ids may repeat or be null, and of copies under one id one row stays. Empty tables pass through.
"""

from pyspark.sql import functions as F

from tallywharf.llm import decontamination, language, packing, private, shingle_join
from tallywharf.llm.common import column
from tallywharf.sources.workspace import fresh_folder

SHINGLE, PERCENT = 5, 80


def known_language(spark, docs, sf_dir):
    inner = docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns if c not in ("doc_id", "text", "lang")})
    model = language.learn(inner)
    kept = language.predict(inner, model, inner.columns).where(F.col("lang_pred") != language.UNKNOWN)
    return kept.select(*inner.columns).toDF(*docs.columns)


def one_of_each_group(spark, docs, sf_dir):
    # Each row gets a key of its own, so ids may repeat or be null; written, so that the keys stay as they are.
    row = "_row"
    while row in {c.lower() for c in docs.columns}:
        row = f"_{row}"
    keyed = shingle_join.kept_small(docs.withColumn(row, F.monotonically_increasing_id()), "keyed")
    groups = shingle_join.join(keyed.select(F.col(row).alias("doc_id"), "text"), SHINGLE, PERCENT)
    groups = shingle_join.kept_small(groups.select(F.col("doc_id").alias("row"), "component_id"), "groups")
    # Only rows that have a copy are looked up and compared.
    several = groups.groupBy("component_id").agg(F.count("*").alias("n")).where("n > 1").select("component_id")
    copied = shingle_join.kept_small(groups.join(several, "component_id"), "copied")
    ids = keyed.select(F.col(row).alias("row"), F.struct(F.col("doc_id").isNull(), "doc_id", F.xxhash64("text"), row).alias("place"))
    places = shingle_join.kept_small(ids.join(copied, "row").select("row", "component_id", "place"), "places")
    first = places.groupBy("component_id").agg(F.min("place").getField(row).alias("first"))
    others = places.join(first, "component_id").where(F.col("row") != F.col("first")).select(F.col("row").alias(row))
    return keyed.join(shingle_join.kept_small(others, "copies"), row, "left_anti").select([column(c) for c in docs.columns])


def without_benchmark(spark, docs, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    inner = docs.withColumnsRenamed({c: f"d_{c}" for c in docs.columns if c != "text"})
    found = decontamination.decontaminate(inner, benchmark, inner.columns)
    return found.where("NOT contaminated").select(*inner.columns).toDF(*docs.columns)


def without_private_data(spark, docs, sf_dir):
    return private.mask(docs, private.learn(docs))


def packed(spark, docs, sf_dir):
    return packing.pack_documents(docs)


STAGES = [
    ("language", known_language),
    ("near_duplicates", one_of_each_group),
    ("decontamination", without_benchmark),
    ("private_data", without_private_data),
    ("packing", packed),
]

#: The stages are learned, iterative or bound to a tokenizer, so SQL cannot express them.
ORACLE_SQL = None


def run(spark, sf_dir):
    """Applies the stages to ``documents``, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = fresh_folder(spark, "pipeline")
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
