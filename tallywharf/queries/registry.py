"""``QUERIES``: name → function of (spark, sf_dir) giving a DataFrame."""

from pyspark.sql import functions as F

from ..functions import clock
from ..operators import alerts, decode, devices, ingest, newest, sales, search
from ..plans import reports
from ..schemas import COUPON_ALERT
from ..sources import documents as documents_store
from ..sources import keyed, topics
from ..sources.workspace import fresh_folder
from ..streaming import jobs
from . import tables as t

QUERIES = {}

DAY = "2024-01-15"
DAY_BEFORE = "2024-01-14"
EARLY_DAY = "2024-01-02"
ORDER_DAY = "1998-10-03"
KEYWORD = "red bolt"

DAY_SECONDS = 24 * 3600
# Windows of a day start at local midnight, which is 16:00 of the day before in UTC.
LOCAL_MIDNIGHT = 16 * 3600
RULE = {"coupon": "view", "click": "error"}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _money(column):
    return F.round(column, 2).alias(column)


# Typed records -------------------------------------------------------------------------------------------------


@query
def startup_typed(spark, sf_dir):
    messages = t.startup_messages(t.read(spark, sf_dir, "events"))
    return decode.accepted(decode.startup_logs(messages)).select(
        "mid", "uid", "appid", "area", "ch", "type", "vs", "ts", "log_date", "log_hour"
    )


@query
def event_typed(spark, sf_dir):
    messages = t.event_messages(t.read(spark, sf_dir, "events"))
    return decode.accepted(decode.event_logs(messages)).select(
        "mid", "uid", "type", "evid", "pgid", "itemid", "ts", "log_date", "log_hour"
    )


def _decoded_orders(spark, sf_dir):
    messages = t.order_messages(t.read(spark, sf_dir, "orders"), t.read(spark, sf_dir, "customer"))
    return decode.accepted(decode.orders(messages))


_ORDER_COLUMNS = ("id", "user_id", "order_status", "total_amount", "order_comment", "consignee_tel", "create_time",
                  "create_date", "create_hour")


@query
def order_typed_masked(spark, sf_dir):
    return _decoded_orders(spark, sf_dir).select(*_ORDER_COLUMNS)


@query
def age_years(spark, sf_dir):
    born = F.to_date("o_orderdate").cast("string")
    return t.read(spark, sf_dir, "orders").select(
        "o_orderkey", clock.age_years(born, clock.wall_clock(t.AS_OF)).alias("age")
    )


# Devices -------------------------------------------------------------------------------------------------------


def _logs(spark, sf_dir, first=None, last=None):
    return t.device_logs(t.days(t.read(spark, sf_dir, "events"), "ts", first, last))


def _dau(spark, sf_dir, first, last):
    """Device days with the hour of the first log."""
    return t.with_hour(devices.first_per_day(_logs(spark, sf_dir, first, last), keep=["ts"]))


@query
def dau_first_event(spark, sf_dir):
    firsts = devices.first_per_day(_logs(spark, sf_dir), order_by=("ts", "event_id"))
    return t.with_hour(firsts).select(
        F.col("log_date").cast("string").alias("log_date"), "mid", "log_hour", "event_id", "event_type", "value"
    )


@query
def dau_total(spark, sf_dir):
    return reports.dau_total(_dau(spark, sf_dir, DAY, DAY), DAY)


@query
def dau_by_hour(spark, sf_dir):
    return reports.dau_by_hour(_dau(spark, sf_dir, DAY, DAY), DAY)


@query
def new_mid_count(spark, sf_dir):
    return reports.new_device_count(_logs(spark, sf_dir, last=EARLY_DAY), EARLY_DAY)


@query
def dau_hours_compare(spark, sf_dir):
    return reports.dau_hours_compare(_dau(spark, sf_dir, DAY_BEFORE, DAY), DAY)


@query
def hours_map(spark, sf_dir):
    both = reports.hours_map(reports.dau_hours_compare(_dau(spark, sf_dir, DAY_BEFORE, DAY), DAY))
    return both.select(F.to_json("today").alias("today"), F.to_json("yesterday").alias("yesterday"))


# Orders --------------------------------------------------------------------------------------------------------


def _purchases(spark, sf_dir, first, last):
    return t.purchases(t.days(t.read(spark, sf_dir, "events"), "ts", first, last))


@query
def gmv_total(spark, sf_dir):
    orders = t.days(t.read(spark, sf_dir, "orders"), "o_orderdate", ORDER_DAY, ORDER_DAY)
    return reports.gmv_total(t.orders_by_day(orders), ORDER_DAY).select(_money("gmv"))


@query
def gmv_by_hour(spark, sf_dir):
    return reports.gmv_by_hour(_purchases(spark, sf_dir, DAY, DAY), DAY).select("hour", _money("gmv"))


@query
def gmv_hours_compare(spark, sf_dir):
    compared = reports.gmv_hours_compare(_purchases(spark, sf_dir, DAY_BEFORE, DAY), DAY)
    return compared.select("day_label", "hour", _money("value"))


@query
def kpi_totals(spark, sf_dir):
    rows = reports.kpi_totals(_logs(spark, sf_dir, last=DAY), _purchases(spark, sf_dir, DAY, DAY), DAY)
    return rows.select("id", "name", _money("value"))


# Users and upserts ---------------------------------------------------------------------------------------------


@query
def user_latest(spark, sf_dir):
    versions = t.read(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value", "props")
    return newest.latest_by_key(versions, ["user_id"], ["ts", "event_id"]).drop("ts")


@query
def keyed_upsert(spark, sf_dir):
    lines = t.read(spark, sf_dir, "lineitem")
    latest = newest.latest_by_key(lines, ["l_orderkey", "l_linenumber"], ["l_shipdate"])
    return latest.withColumn("l_shipdate", F.to_date("l_shipdate").cast("string"))


# Sales ---------------------------------------------------------------------------------------------------------


def _joined(spark, sf_dir, day=None):
    details = t.order_details(t.read(spark, sf_dir, "lineitem"), t.read(spark, sf_dir, "part"))
    orders = t.days(t.read(spark, sf_dir, "orders"), "o_orderdate", day, day)
    return sales.join_sales(t.orders(orders), details)


def _sales(spark, sf_dir, day=None):
    users = t.users(t.read(spark, sf_dir, "customer"))
    return sales.enrich(_joined(spark, sf_dir, day), users, clock.wall_clock(t.AS_OF))


@query
def sale_detail_join(spark, sf_dir):
    return _joined(spark, sf_dir)


@query
def sale_detail_join_timed(spark, sf_dir):
    """Order lines as raw messages that arrive with their order, within ten minutes of it, just then, or too late."""
    orders, lines = t.read(spark, sf_dir, "orders"), t.read(spark, sf_dir, "lineitem")
    orders = t.orders(orders.withColumn("arrived", t.arrival("o_orderkey")))
    details = decode.accepted(decode.order_details(t.order_detail_messages(lines)), keep=("arrived",))
    details = details.withColumn("order_id", F.col("order_id").cast("bigint"))
    return sales.join_sales(orders, details, "10 minutes").select(
        "order_detail_id", "order_id", "order_status", "user_id", "sku_id", "sku_price", "dt"
    )


@query
def sale_detail_enriched(spark, sf_dir):
    return _sales(spark, sf_dir)


@query
def sale_search_total(spark, sf_dir):
    return search.matches(_sales(spark, sf_dir), KEYWORD).agg(F.count(F.lit(1)).alias("total"))


@query
def sale_search_page(spark, sf_dir):
    hits = search.matches(_sales(spark, sf_dir), KEYWORD)
    return search.page(hits, 3, 20).select("es_metadata_id", "score", "order_id", "sku_id", "sku_name")


@query
def sale_search_deep_page(spark, sf_dir):
    """A page that starts far beyond what a top-k should keep."""
    hits = search.matches(_sales(spark, sf_dir), KEYWORD)
    return search.page(hits, 551, 20).select("es_metadata_id", "score", "order_id", "sku_id", "sku_name")


@query
def sale_search_range_page(spark, sf_dir):
    """The same page, ranked within the one range of keys that holds it."""
    hits = search.matches(_sales(spark, sf_dir), KEYWORD)
    return search.far_page(hits, 551, 20).select("es_metadata_id", "score", "order_id", "sku_id", "sku_name")


@query
def sale_search_postings(spark, sf_dir):
    """The report of one day from the words kept by day; no product name is read to find the hits."""
    work = fresh_folder(spark, "sales")
    documents = documents_store.write(_sales(spark, sf_dir), f"{work}/table")
    return _flat_report(reports.sale_search_postings(*documents, ORDER_DAY, KEYWORD, 1, 5))


@query
def sale_gender_terms(spark, sf_dir):
    return search.terms(search.matches(_sales(spark, sf_dir), KEYWORD), "user_gender", 1)


@query
def sale_age_terms(spark, sf_dir):
    return search.terms(search.matches(_sales(spark, sf_dir), KEYWORD), "user_age", 7)


def _summary(spark, sf_dir):
    return search.summary(search.matches(_sales(spark, sf_dir), KEYWORD))


@query
def sale_age_share(spark, sf_dir):
    return search.option_rows(_summary(spark, sf_dir), "ages")


@query
def sale_gender_share(spark, sf_dir):
    return search.option_rows(_summary(spark, sf_dir), "genders")


def _report(spark, sf_dir, day):
    return _flat_report(reports.sale_search(_sales(spark, sf_dir, day), day, KEYWORD, 1, 5))


def _flat_report(found):
    ids = F.transform("detail", lambda d: d["es_metadata_id"])
    return found.select("total", F.array_join(ids, ",").alias("detail"), F.to_json("stat").alias("stat"))


@query
def sale_search_report(spark, sf_dir):
    return _report(spark, sf_dir, None)


@query
def sale_search_day_report(spark, sf_dir):
    return _report(spark, sf_dir, ORDER_DAY)


# Alerts --------------------------------------------------------------------------------------------------------


def _alerts(spark, sf_dir, window, slide=None, offset=0):
    logs = t.shared_device_logs(t.read(spark, sf_dir, "events"))
    return alerts.batch_alerts(logs, window, slide, offset, **RULE)


@query
def coupon_alert(spark, sf_dir):
    return _alerts(spark, sf_dir, DAY_SECONDS, offset=LOCAL_MIDNIGHT)


@query
def coupon_alert_sliding(spark, sf_dir):
    return _alerts(spark, sf_dir, DAY_SECONDS, 6 * 3600)


@query
def coupon_alert_fine_slide(spark, sf_dir):
    """Thirty windows per event, as many as five minutes sliding by ten seconds give."""
    return _alerts(spark, sf_dir, 15 * 3600, 1800)


@query
def coupon_alert_minute(spark, sf_dir):
    """A thinned clock, on which an hour is a second: several windows end in one minute, and the last one stays."""
    logs = t.shared_device_logs(t.read(spark, sf_dir, "events"))
    logs = logs.withColumn("ts", F.call_function("div", F.col("ts"), F.lit(3600)))
    return alerts.batch_alerts(logs, 20, 10, **RULE)


# Ingest --------------------------------------------------------------------------------------------------------


@query
def log_route(spark, sf_dir):
    lines = t.raw_lines(t.read(spark, sf_dir, "events"))
    return ingest.route_logs(ingest.stamp(lines, F.col("arrived"))).select("topic", "value")


@query
def log_route_repeated_keys(spark, sf_dir):
    """Lines that say everything twice; the last of equal keys holds."""
    lines = t.raw_lines(t.read(spark, sf_dir, "events"))
    stale = F.concat(F.lit('{"type":"stale","uid":0,"seq":"x",'), F.expr("substring(value, 2)"))
    twice = F.when(F.get_json_object("value", "$.type").isNotNull(), stale).otherwise(F.col("value"))
    return ingest.route_logs(ingest.stamp(lines.withColumn("value", twice), F.col("arrived"))).select("topic", "value")


@query
def cdc_route(spark, sf_dir):
    changes = t.row_changes(*[t.read(spark, sf_dir, n) for n in ("orders", "lineitem", "customer", "part")])
    return ingest.route_changes(changes, db_pattern=r"shop\..*")


# Streams: each runs its job to the end of the table, then reads what the job has stored ---------------------------


def _finish(running):
    running.awaitTermination()


@query
def stream_dau(spark, sf_dir):
    """Half of the month is loaded in bulk, then the whole table streams past it: seen devices must not come twice."""
    work = fresh_folder(spark, "dau")
    schema = "log_date date, mid bigint, ts timestamp_ntz, event_id bigint, event_type string, value double"
    order = ("ts", "event_id")
    loaded = devices.first_per_day(_logs(spark, sf_dir, last=DAY), order)
    keyed.write_settled(loaded, f"{work}/table", "log_date")
    logs = t.device_logs(t.stream(spark, sf_dir, "events"))
    _finish(jobs.dau(logs, f"{work}/table", f"{work}/checkpoint", schema, order, interval=None))
    return t.with_hour(keyed.read_batches(spark, f"{work}/table", schema)).select(
        F.col("log_date").cast("string").alias("log_date"), "mid", "log_hour", "event_id", "event_type", "value"
    )


def _stored_dau(spark, sf_dir):
    """The table of daily devices that the job has written, and its layout."""
    work = fresh_folder(spark, "dau")
    schema = "log_date date, mid bigint, ts timestamp_ntz, event_id bigint, event_type string, value double"
    order = ("ts", "event_id")
    keyed.write_settled(devices.first_per_day(_logs(spark, sf_dir, last=DAY_BEFORE), order), f"{work}/table", "log_date")
    logs = t.device_logs(t.stream(spark, sf_dir, "events"))
    _finish(jobs.dau(logs, f"{work}/table", f"{work}/checkpoint", schema, order, interval=None))
    return t.with_hour(keyed.read_batches(spark, f"{work}/table", schema))


@query
def kpi_stored(spark, sf_dir):
    """The KPI report over the tables that the jobs keep."""
    stored = _stored_dau(spark, sf_dir)
    work = fresh_folder(spark, "purchases")
    layout = "create_date date, create_hour string, total_amount double"
    keyed.write_settled(_purchases(spark, sf_dir, DAY_BEFORE, DAY), f"{work}/table", "create_date")
    orders = keyed.read_batches(spark, f"{work}/table", layout)
    return reports.kpi_totals(stored, orders, DAY).select("id", "name", _money("value"))


@query
def dau_hours_stored(spark, sf_dir):
    return reports.dau_hours_compare(_stored_dau(spark, sf_dir), DAY)


@query
def sale_search_stored_day(spark, sf_dir):
    """The search report over stored sale documents; only the folder of the day is read."""
    work = fresh_folder(spark, "sales")
    found = _sales(spark, sf_dir)
    keyed.write_settled(found, f"{work}/table", "dt")
    stored = keyed.read_batches(spark, f"{work}/table", found.schema).drop("batch_id")
    return _flat_report(reports.sale_search(stored, ORDER_DAY, KEYWORD, 1, 5))


@query
def stream_orders(spark, sf_dir):
    work = fresh_folder(spark, "orders")
    messages = t.order_messages(t.stream(spark, sf_dir, "orders"), t.read(spark, sf_dir, "customer"))
    messages = messages.withColumn("arrived", F.timestamp_seconds(F.lit(0)))
    _finish(jobs.orders(messages, f"{work}/table", f"{work}/checkpoint", f"{work}/bad", interval=None))
    return jobs.order_table(spark, f"{work}/table").select(*_ORDER_COLUMNS)


@query
def stream_user_latest(spark, sf_dir):
    """Each event is a new version of its user; the snapshot keeps the last one."""
    work = fresh_folder(spark, "users")
    messages = t.stream(spark, sf_dir, "events").select(
        F.to_json(F.struct(
            F.col("user_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("login_name"),
            F.col("event_type").alias("user_level"),
        )).alias("value"),
        F.timestamp_micros(clock.wall_micros(F.col("ts"))).alias("arrived"),
    )
    _finish(jobs.users(messages, f"{work}/table", f"{work}/checkpoint", f"{work}/bad", interval=None))
    return jobs.user_snapshot(spark, f"{work}/table").select(
        "id", F.col("login_name").alias("event_id"), F.col("user_level").alias("event_type")
    )


@query
def stream_sale_join(spark, sf_dir):
    """The tables know no arrival time, so all rows arrive together."""
    work = fresh_folder(spark, "sales")
    together = F.timestamp_seconds(F.lit(1_000_000_000))
    orders = t.orders(t.stream(spark, sf_dir, "orders").withColumn("arrived", together))
    details = t.order_details(
        t.stream(spark, sf_dir, "lineitem").withColumn("arrived", together), t.read(spark, sf_dir, "part")
    )
    customer = t.read(spark, sf_dir, "customer")
    _finish(jobs.sale_details(
        orders, details, f"{work}/table", f"{work}/checkpoint",
        lambda ids: t.users(customer).join(ids, "id", "left_semi"),
        lambda: clock.wall_clock(t.AS_OF), interval=None,
    ))
    layout = (
        "order_detail_id string, order_id bigint, order_status string, create_time string, user_id bigint, "
        "sku_id bigint, sku_price double, sku_name string, dt string, arrived timestamp, user_gender string, "
        "user_age int, user_level string"
    )
    return jobs.sale_documents(spark, f"{work}/table", layout).drop("arrived")


@query
def stream_alert(spark, sf_dir):
    work = fresh_folder(spark, "alerts")
    logs = t.shared_device_logs(t.stream(spark, sf_dir, "events"))
    _finish(jobs.coupon_alerts(
        logs, f"{work}/table", f"{work}/checkpoint", DAY_SECONDS, DAY_SECONDS, LOCAL_MIDNIGHT, interval=None, **RULE
    ))
    return jobs.alert_documents(spark, f"{work}/table", COUPON_ALERT)


# Streams in several micro-batches -----------------------------------------------------------------------------------

_FINE = {"window_seconds": 15 * 3600, "slide_seconds": 1800}


def _sliding_documents(spark, sf_dir, logs, **windows):
    """Events come in four steps by their time; the job runs after each."""
    work = fresh_folder(spark, "alerts")
    for _ in t.land(logs, f"{work}/in", "ts", 4):
        _finish(jobs.sliding_alerts(
            t.landed(spark, logs, f"{work}/in"), f"{work}/panes", f"{work}/table", f"{work}/checkpoint", interval=None,
            **windows, **RULE,
        ))
    return keyed.read_batches(spark, f"{work}/table", COUPON_ALERT).drop("batch_id")


@query
def stream_alert_sliding(spark, sf_dir):
    """Thirty windows per event; state holds it once. Every stored row is final, so none is chosen among versions."""
    return _sliding_documents(spark, sf_dir, t.shared_device_logs(t.read(spark, sf_dir, "events")), **_FINE)


@query
def stream_alert_minute(spark, sf_dir):
    """The thinned clock of ``coupon_alert_minute``: the last window of a minute comes out when the minute has closed."""
    logs = t.shared_device_logs(t.read(spark, sf_dir, "events"))
    logs = logs.withColumn("ts", F.call_function("div", F.col("ts"), F.lit(3600)))
    return _sliding_documents(spark, sf_dir, logs, window_seconds=20, slide_seconds=10)


@query
def stream_alert_repeated_files(spark, sf_dir):
    """Event messages through topic files, every batch of which is written twice and counted once."""
    work = fresh_folder(spark, "alerts")
    messages = t.shared_device_messages(t.read(spark, sf_dir, "events")).withColumn("topic", F.lit("event"))
    middle = messages.agg(F.expr("CAST(avg(ts) AS BIGINT)")).first()[0] or 0
    for batch, part in enumerate((messages.where(F.col("ts") < middle), messages.where(F.col("ts") >= middle))):
        for _ in range(2):
            topics.write_topics(part, f"{work}/topics", batch, marked=True)
            _finish(jobs.sliding_alerts_from_messages(
                topics.read_files(spark, topics.topic_path(f"{work}/topics", "event"), marked=True),
                f"{work}/panes", f"{work}/table", f"{work}/checkpoint", once=("mark",), interval=None, **_FINE, **RULE,
            ))
    return keyed.read_batches(spark, f"{work}/table", COUPON_ALERT).drop("batch_id")


@query
def stream_user_versions(spark, sf_dir):
    """Versions that all arrive at one instant, in four batches: the one written last holds, whatever its text."""
    work = fresh_folder(spark, "users")
    messages = t.read(spark, sf_dir, "events").select(
        F.to_json(F.struct(
            F.col("user_id").cast("string").alias("id"), F.col("event_id").cast("string").alias("login_name"),
            F.col("event_type").alias("user_level"),
        )).alias("value"),
        F.timestamp_seconds(F.lit(0)).alias("arrived"), "event_id",
    )
    for _ in t.land(messages, f"{work}/in", "event_id", 4):
        place = F.col("_metadata.file_path").alias("source"), F.col("_metadata.file_block_start").alias("position")
        _finish(jobs.users(
            t.landed(spark, messages, f"{work}/in", *place), f"{work}/table", f"{work}/checkpoint", f"{work}/bad", interval=None
        ))
    return jobs.user_snapshot(spark, f"{work}/table").select(
        "id", F.col("login_name").alias("event_id"), F.col("user_level").alias("event_type")
    )


def _corrected_orders(spark, sf_dir):
    """Every third order is first written with a wrong day; of these, half come in time and half after their correction."""
    work = fresh_folder(spark, "orders")
    orders, customers = t.read(spark, sf_dir, "orders"), t.read(spark, sf_dir, "customer")
    key = F.col("o_orderkey")
    wrong = orders.where(key % 3 == 0).withColumns({
        "o_orderdate": F.col("o_orderdate") + F.expr("INTERVAL 2 DAYS"), "o_totalprice": F.col("o_totalprice") + 1,
        "written": F.lit(1), "step": 3 * (key % 2),
    })
    right = orders.withColumns({"written": F.lit(2), "step": 1 + key % 3})
    messages = t.order_messages(
        wrong.unionByName(right), customers, F.timestamp_seconds("written").alias("arrived"), F.col("step").cast("bigint").alias("step")
    )
    for _ in t.land(messages, f"{work}/in", "step", 4):
        _finish(jobs.orders(
            t.landed(spark, messages, f"{work}/in"), f"{work}/table", f"{work}/checkpoint", f"{work}/bad", interval=None
        ))
    return jobs.order_table(spark, f"{work}/table")


@query
def stream_orders_corrected(spark, sf_dir):
    return _corrected_orders(spark, sf_dir).select(*_ORDER_COLUMNS)


@query
def gmv_stored(spark, sf_dir):
    """The amount of a day over the table that the job keeps; only files that can hold the day are read."""
    return reports.gmv_total(_corrected_orders(spark, sf_dir), ORDER_DAY).select(_money("gmv"))


@query
def stream_sale_join_late(spark, sf_dir):
    """Raw messages of both sides in four steps of time: lines with their order, up to ten minutes off, and later."""
    work = fresh_folder(spark, "sales")
    customer = t.read(spark, sf_dir, "customer")
    sides = {
        "orders": t.timed_orders(t.read(spark, sf_dir, "orders"), customer),
        "details": t.timed_details(t.read(spark, sf_dir, "lineitem")),
    }
    steps = zip(*(t.land(rows, f"{work}/{name}", "at", 4, columns) for name, (rows, columns) in sides.items()), strict=True)
    for _ in steps:
        orders, details = (
            t.landed(spark, rows.select(*columns), f"{work}/{name}") for name, (rows, columns) in sides.items()
        )
        _finish(jobs.sale_details_from_messages(
            orders, details,
            f"{work}/table", f"{work}/checkpoint", lambda ids: t.user_messages(customer).join(ids, "id", "left_semi"),
            lambda: clock.wall_clock(t.AS_OF), interval=None,
        ))
    return jobs.sale_documents(spark, f"{work}/table", _SALE_LAYOUT).select(
        "order_detail_id", "order_id", "order_status", "user_id", "sku_id", "sku_price", "dt", "user_gender", "user_age", "user_level"
    )


_SALE_LAYOUT = (
    "order_detail_id string, order_id string, order_status string, create_time string, user_id string, sku_id string, "
    "sku_price double, sku_name string, dt string, arrived timestamp, user_gender string, user_age int, user_level string"
)


@query
def new_mid_stored(spark, sf_dir):
    """New devices of a day from the table of first days, which a late half of the month has moved back."""
    work = fresh_folder(spark, "dau")
    layout = "log_date date, mid bigint, ts timestamp_ntz, event_id bigint, event_type string, value double, late bigint"
    logs = t.device_logs(t.read(spark, sf_dir, "events")).withColumn("late", (F.col("log_date") <= F.lit(DAY).cast("date")).cast("bigint"))
    for _ in t.land(logs, f"{work}/in", "late", 2):
        _finish(jobs.dau(
            t.landed(spark, logs, f"{work}/in"), f"{work}/table", f"{work}/checkpoint", layout, ("ts", "event_id"),
            interval=None, first_seen=f"{work}/first",
        ))
    return reports.first_seen_count(jobs.first_seen_table(spark, f"{work}/first", "mid bigint, log_date date"), EARLY_DAY)
