"""Sale documents with the words they can be found by.

``<table>/documents/`` is ordered by day and id, ``<table>/postings/`` holds a row (day, word, id) for every distinct word
of a document and is ordered by day and word.  Both are dealt by ranges, so a day and a word are found by the statistics
of a few files, and a day with many documents spreads over as many files as it needs.
"""

from ..operators import search


def _ordered(rows, path, *order):
    _dealt(rows, *order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def _dealt(rows, *order):
    """Rows by ranges; where all columns are in ``order``, equal rows meet in one range and stay once, with no second shuffle."""
    dealt = rows.repartitionByRange(*order)
    return dealt.distinct() if set(order) == set(rows.columns) else dealt


def write(sales, table):
    """Stores documents, one row per (dt, order_detail_id), and gives what ``read`` gives."""
    spark = sales.sparkSession
    _ordered(sales, f"{table}/documents", "dt", "order_detail_id")
    stored = spark.read.schema(sales.schema).parquet(f"{table}/documents")
    _ordered(search.words_of(stored), f"{table}/postings", "dt", "word", "order_detail_id")
    return read(spark, table, sales.schema)


def read(spark, table, schema):
    """The documents and their postings."""
    words = "dt string, word string, order_detail_id string"
    return spark.read.schema(schema).parquet(f"{table}/documents"), spark.read.schema(words).parquet(f"{table}/postings")
