"""KPI, hour-by-hour and sale-search reports.

Reports read stored tables: ``dau`` (one row per day and device: log_date, mid, log_hour), ``orders`` (create_date,
create_hour, total_amount) and sale documents.  A day filter on log_date, create_date or dt prunes partitions.
"""

from pyspark.sql import functions as F

from ..functions import clock, shares
from ..operators import search

# Ids and names of the KPI report.
KPI_NAMES = (("dau", "新增日活"), ("new_mid", "新增设备"), ("order_amount", "新增交易额"))

TODAY, YESTERDAY = "today", "yesterday"


def dau_total(dau, day):
    return dau.where(F.col("log_date") == day).agg(F.count(F.lit(1)).alias("dau"))


def dau_by_hour(dau, day):
    return (
        dau.where(F.col("log_date") == day)
        .groupBy(F.col("log_hour").alias("hour")).agg(F.count(F.lit(1)).alias("nums"))
    )


def _device_days(dau, day):
    """Per device its first day up to ``day`` and whether it was there on ``day``.

    One combinable aggregate over the keys answers "active today" and "never seen before today" together; no join
    of a day against all of history is needed.
    """
    return (
        dau.where(F.col("log_date") <= day)
        # As dates the two extremes fit into a hash aggregation; as text they would need a sort.
        .select("mid", F.to_date("log_date").alias("day"))
        .groupBy("mid")
        .agg(F.min("day").alias("first_day"), F.max("day").alias("last_day"))
        .where(F.col("last_day") == F.lit(day).cast("date"))
    )


def _is_new(day):
    # An unknown device is never recognised, so it is new on every day it shows up.
    return F.col("mid").isNull() | (F.col("first_day") == F.lit(day).cast("date"))


def new_device_count(dau, day):
    return _device_days(dau, day).agg(F.count_if(_is_new(day)).alias("new_mid"))


def first_seen_count(first_seen, day):
    """New devices of a day from the table of first days; no other day is read."""
    return first_seen.where(F.col("log_date") == day).agg(F.count(F.lit(1)).alias("new_mid"))


def gmv_total(orders, day):
    """Amount of a day; NULL when it has no orders."""
    return orders.where(F.col("create_date") == day).agg(F.sum("total_amount").alias("gmv"))


def gmv_by_hour(orders, day):
    return (
        orders.where(F.col("create_date") == day)
        .groupBy(F.col("create_hour").alias("hour")).agg(F.sum("total_amount").alias("gmv"))
    )


def kpi_totals(dau, orders, day):
    """Three rows (id, name, value) for one day."""
    names = dict(KPI_NAMES)

    def kpi(key, value):
        return F.struct(F.lit(key).alias("id"), F.lit(names[key]).alias("name"), value.cast("double").alias("value"))

    devices = (
        _device_days(dau, day)
        .agg(F.count(F.lit(1)).alias("dau"), F.count_if(_is_new(day)).alias("new_mid"))
        .select(F.explode(F.array(kpi("dau", F.col("dau")), kpi("new_mid", F.col("new_mid")))).alias("k"))
    )
    amount = gmv_total(orders, day).select(kpi("order_amount", F.col("gmv")).alias("k"))
    return devices.unionByName(amount).select("k.*")


def _two_days(table, day_column, day):
    before = clock.previous_day(F.lit(day))
    label = F.when(F.col(day_column) == day, TODAY).otherwise(YESTERDAY)
    return table.where(F.col(day_column).isin(F.lit(day), before)).withColumn("day_label", label)


def dau_hours_compare(dau, day):
    """(day_label, hour, value): devices by hour, today and yesterday, from one scan of both days."""
    return (
        _two_days(dau, "log_date", day)
        .groupBy("day_label", F.col("log_hour").alias("hour")).agg(F.count(F.lit(1)).alias("value"))
    )


def gmv_hours_compare(orders, day):
    return (
        _two_days(orders, "create_date", day)
        .groupBy("day_label", F.col("create_hour").alias("hour")).agg(F.sum("total_amount").alias("value"))
    )


def hours_compare(dau, orders, day, report):
    """Devices for the report id "dau", amounts for any other."""
    return dau_hours_compare(dau, day) if report == "dau" else gmv_hours_compare(orders, day)


def hours_map(compared):
    """One row: for each of the two days a map from hour to value (at most 24 entries each)."""

    def of(label):
        entry = F.when(F.col("day_label") == label, F.struct(F.col("hour").cast("int").alias("h"), "hour", "value"))
        ordered = F.sort_array(F.collect_list(entry))
        return F.map_from_entries(F.transform(ordered, lambda e: F.struct(e["hour"], e["value"])))

    return compared.agg(of(TODAY).alias(TODAY), of(YESTERDAY).alias(YESTERDAY))


def sale_search(sales, day, keyword, number, size):
    """One row {total, detail[], stat[2]}: a page of matching sales, and shares over all matches.

    ``day`` may be None to search sale documents of all days.  Matches are scanned twice: once for the page and once
    for the counts that total and shares are derived from.
    """
    return _search_report(search.matches(sales if day is None else sales.where(F.col("dt") == day), keyword), number, size)


def sale_search_postings(documents, postings, day, keyword, number, size):
    """The same report over stored documents and the words they are found by (see ``sources.documents``)."""
    return _search_report(search.posted(documents, postings, keyword, day), number, size)


def _search_report(found, number, size):
    columns = [*[c for c in found.columns if c != "score"], "es_metadata_id"]
    hits = search.page(found, number, size).select(
        F.struct((-F.col("score")).alias("rank"), F.col("order_detail_id").alias("at"),
                 F.struct(*columns).alias("doc")).alias("hit")
    )
    # At most one page of documents.
    detail = hits.agg(F.transform(F.sort_array(F.collect_list("hit")), lambda h: h["doc"]).alias("detail"))
    # Two one-row results, stacked and then squeezed into one row.
    both = search.summary(found).unionByName(detail, allowMissingColumns=True)
    row = both.agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("total", "detail", "ages", "genders")])

    def stat(title, options):
        return F.struct(F.lit(title).alias("title"), F.col(options).alias("options"))

    return row.select(
        "total", "detail",
        F.array(stat(shares.AGE_TITLE, "ages"), stat(shares.GENDER_TITLE, "genders")).alias("stat"),
    )
