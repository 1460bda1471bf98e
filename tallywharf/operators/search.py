"""Keyword search over sale documents, paging, and bucket counts of the matches."""

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..functions import shares, text
from ..sources.workspace import ensure_checkpoints


def matches(sales, keyword):
    """Sales whose product name shares a word with ``keyword``, with the number of shared words."""
    score = text.match_score(F.col("sku_name"), keyword)
    return sales.where(score > 0).withColumn("score", score)


def postings(sales):
    """(dt, word, order_detail_id): the words that each document can be found by."""
    return words_of(sales).distinct()


def words_of(sales):
    """The same, with the words of a document that comes twice listed twice."""
    return sales.select("dt", F.explode(text.words(F.col("sku_name"))).alias("word"), "order_detail_id")


def posted(documents, words, keyword, day=None):
    """What ``matches`` gives, found by the postings of the keyword's words; ``documents`` has one row per (dt, id)."""
    if day is not None:
        documents, words = documents.where(F.col("dt") == day), words.where(F.col("dt") == day)
    # The few words of a keyword, as plain values that a scan can skip by.
    asked = words.sparkSession.range(1).select(text.words(F.lit(keyword))).first()[0]
    found = words.where(F.col("word").isin(asked)).groupBy("dt", "order_detail_id").agg(F.count(F.lit(1)).cast("int").alias("score"))
    return documents.join(found, ["dt", "order_detail_id"])


_KEY = ("score", "order_detail_id")


def _rank():
    return [F.desc("score"), F.asc("order_detail_id")]


def _on_page(keys, skip, size):
    """The keys of a page: how many rows of each are on it, and how many come before it.

    Only the first rows up to the end of the page are numbered.
    """
    number = F.row_number().over(Window.orderBy(*_rank()))
    numbered = keys.orderBy(*_rank()).limit(skip + size).withColumn("number", number)
    counted = numbered.groupBy(*_KEY).agg(
        F.count_if(F.col("number") > skip).alias("here"), F.count_if(F.col("number") <= skip).alias("before")
    )
    return counted.where("here > 0")


def _fetch(hits, keys, size):
    """The wide rows of a page of keys, which are at most ``size`` and so travel to the hits.

    Rows of one key are told apart only here, by a digest of all columns.
    """
    rows = hits.join(F.broadcast(keys), list(_KEY)).withColumn("_tie", F.xxhash64(*hits.columns))
    place = F.row_number().over(Window.partitionBy(*_KEY).orderBy("_tie"))
    rows = rows.withColumn("_place", place).where("_place BETWEEN before + 1 AND before + here")
    rows = rows.orderBy(*_rank(), "_tie").limit(size)
    return rows.select(*hits.columns).withColumn("es_metadata_id", F.col("order_detail_id"))


def page(hits, number, size):
    """The ``number``-th page (from 1) of the best hits.

    Only keys are ranked, whatever the page; the other columns are fetched for the rows of the page.  For walking
    through all pages ``page_after`` is cheaper, as it never ranks what comes before; for a page far down ``far_page``.
    """
    return _fetch(hits, _on_page(hits.select(*_KEY), (number - 1) * size, size), size)


def far_page(hits, number, size):
    """The same page, without a task that ranks all that comes before it.

    Keys are dealt by ranges in the order of ranks; the ranges' counts tell which of them hold the page, and only those
    are ranked.  Equal keys share a range.
    """
    ensure_checkpoints(hits.sparkSession)
    ranged = hits.select(*_KEY).repartitionByRange(*_rank()).withColumn("part", F.spark_partition_id()).checkpoint()
    skip, before, wanted = (number - 1) * size, 0, []
    # A row for each range.
    for part, n in ranged.groupBy("part").agg(F.count(F.lit(1)).alias("n")).orderBy("part").collect():
        if before + n > skip and before < skip + size:
            wanted.append((part, before))
        before += n
    keys = ranged.where(F.col("part").isin([p for p, _ in wanted])).select(*_KEY)
    return _fetch(hits, _on_page(keys, skip - (wanted[0][1] if wanted else 0), size), size)


def page_after(hits, last, size):
    """The page that follows a row, given as its (score, order_detail_id); ``None`` for the first page."""
    if last is not None:
        score, key = last
        hits = hits.where(
            (F.col("score") < score) | ((F.col("score") == score) & (F.col("order_detail_id") > F.lit(key)))
        )
    return page(hits, 1, size)


def terms(hits, column, k):
    """(term, n): the ``k`` most frequent known values of a column; equally frequent ones rank in their own order."""
    counts = hits.where(F.col(column).isNotNull()).groupBy(F.col(column).alias("term")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "term").limit(k)


def _options(pairs):
    return F.array(*[
        F.struct(F.lit(name).alias("name"), value.alias("value")) for name, value in pairs
    ])


def summary(hits):
    """One row: total, and the shares of age bands and genders as arrays of (name, value).

    Every hit counts, in one pass and with nothing but counters to shuffle.  The middle age band is what the other two
    leave; an unknown value is in the total only; shares of no hits are NULL.
    """
    ages, genders = shares.age_band(F.col("user_age")), shares.gender_band(F.col("user_gender"))
    count = F.count_if
    counts = hits.agg(
        F.count(F.lit(1)).alias("total"),
        count(ages == shares.UNDER_20).alias("young"),
        count(ages == shares.FROM_30).alias("old"),
        count(ages.isNotNull()).alias("aged"),
        count(genders == shares.MALE).alias("men"),
        count(genders.isNotNull()).alias("gendered"),
    )
    young, old = (shares.percent(F.col(c), F.col("aged")) for c in ("young", "old"))
    men = F.try_divide(F.col("men") * F.lit(100.0), F.col("gendered"))
    return counts.select(
        "total",
        _options([
            (shares.UNDER_20, young), (shares.FROM_20_TO_29, shares.remainder(young, old)), (shares.FROM_30, old),
        ]).alias("ages"),
        _options([
            (shares.MALE, shares.percent(F.col("men"), F.col("gendered"))), (shares.FEMALE, shares.remainder(men)),
        ]).alias("genders"),
    )


def option_rows(summary_row, options):
    """(name, value) rows of one of the share arrays."""
    return summary_row.select(F.explode(options).alias("o")).select("o.name", "o.value")
