"""The operators over the driver's tables, and the same in SQL where SQL can express it."""

from tallywharf.sources.workspace import fresh_folder

from . import decontamination, fingerprints, language, minhash, packing, prefix_trie, private, quality, shingle_join, spelling, token_counts, token_files, toxicity


def _table(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_token_files(spark, sf_dir):
    folder = fresh_folder(spark, "token-files")
    token_files.write(_table(spark, sf_dir, "documents"), folder)
    return token_files.digests(spark, folder)


def op2_packing(spark, sf_dir):
    return packing.pack_documents(_table(spark, sf_dir, "documents"))


def op3_decontamination(spark, sf_dir):
    return decontamination.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op7_language(spark, sf_dir):
    return language.identify(_table(spark, sf_dir, "documents"))


def op4_private(spark, sf_dir):
    return private.classify(_table(spark, sf_dir, "documents"))


def op5_fingerprints(spark, sf_dir):
    return fingerprints.edited(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark, sf_dir):
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op8_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op9_token_counts(spark, sf_dir):
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"))


def op10_shingle_join(spark, sf_dir):
    return shingle_join.join(_table(spark, sf_dir, "documents"))


def op11_spelling(spark, sf_dir):
    return spelling.variants(_table(spark, sf_dir, "documents"))


def op12_minhash(spark, sf_dir):
    return minhash.groups(_table(spark, sf_dir, "documents"))


def op13_prefix_trie(spark, sf_dir):
    return prefix_trie.nodes(prefix_trie.rebuilt(_table(spark, sf_dir, "conversations")))


QUERIES = {
    "op1_token_files": op1_token_files,
    "op2_packing": op2_packing,
    "op3_decontamination": op3_decontamination,
    "op4_private": op4_private,
    "op5_fingerprints": op5_fingerprints,
    "op6_toxicity": op6_toxicity,
    "op7_language": op7_language,
    "op8_quality": op8_quality,
    "op9_token_counts": op9_token_counts,
    "op10_shingle_join": op10_shingle_join,
    "op11_spelling": op11_spelling,
    "op12_minhash": op12_minhash,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op3_decontamination": decontamination.sql(),
    "op10_shingle_join": shingle_join.sql(),
    "op11_spelling": spelling.sql(),
    "op12_minhash": minhash.sql(),
    "op13_prefix_trie": prefix_trie.sql(),
}
