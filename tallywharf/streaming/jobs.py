"""Streaming jobs.

Every job is a stream of messages or typed rows, a shared transformation, and one ``foreachBatch`` sink that can be
run again for the same batch.  Each returns the started query.  Offsets and state live in the checkpoint folder.
Large join and window state belongs in the RocksDB state store, which the session chooses before the start.
"""

from functools import reduce
from math import gcd
from operator import or_

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock
from ..operators import alerts as coupon
from ..operators import decode, devices, ingest, moves, sales
from ..operators.newest import latest_by_key
from ..schemas import DAU_ROW, MESSAGE, ORDER_ROW, USER
from ..sources import keyed, topics

DAU_INTERVAL = "5 seconds"
INTERVAL = "10 seconds"
SALE_LATENESS = "10 minutes"

# Up to this many keys of one batch are sent to where a stored table lies; with more, both sides are shuffled.
BROADCAST_KEYS = 500_000
# Up to this many keys are looked up as a filter on the stored column, which skips by Bloom filters and statistics.
FILTER_KEYS = 64


def _start(rows, name, sink, checkpoint, interval):
    """``interval`` None processes what is there and stops."""
    writer = rows.writeStream.queryName(name).option("checkpointLocation", checkpoint).foreachBatch(sink)
    trigger = {"availableNow": True} if interval is None else {"processingTime": interval}
    return writer.trigger(**trigger).start()


def _spark(batch):
    return batch.sparkSession


class _Held:
    """A batch kept for several actions, released when they are done."""

    def __init__(self, batch):
        self.batch = batch

    def __enter__(self):
        return self.batch.persist()

    def __exit__(self, *_):
        self.batch.unpersist()


def _set_aside(decoded, quarantine, batch_id):
    keyed.fold(_spark(decoded), quarantine, batch_id)
    keyed.write_batch(decode.rejected(decoded), quarantine, batch_id)


def set_aside(messages, decoder, quarantine, checkpoint, interval=INTERVAL):
    """The messages that ``decoder`` rejects, for jobs that decode in front of their state."""

    def sink(batch, batch_id):
        _set_aside(decoder(batch), quarantine, batch_id)

    return _start(messages, "set_aside", sink, checkpoint, interval)


def _arranged(batch):
    """Messages of a batch with their ``line``, by which those of one stretch of a file follow one another."""
    return batch.withColumn("line", F.monotonically_increasing_id())


def _written(batch):
    """The columns that order the versions of a key: when they arrived, and among equal ones where they stand."""
    return [c for c in ("arrived", "source", "position", "line") if c in batch.columns]


def _last_written(decoded, keys):
    """Per key the accepted row that was written last, with its time of arrival."""
    order = _written(decoded)
    rows = latest_by_key(decode.accepted(decoded, keep=order), keys, order)
    return rows.drop(*[c for c in order if c != "arrived"])


# Ingest ---------------------------------------------------------------------------------------------------------


def route_logs(lines, root, checkpoint, quarantine, archive=None, zone=clock.SHOP_ZONE, marked=False, interval=INTERVAL):
    """Raw log lines to the startup and event topics, and to day files; ``marked`` as in ``topics.write_topics``."""

    def sink(batch, batch_id):
        with _Held(ingest.stamp(batch, F.col("arrived"))) as stamped:
            topics.write_topics(ingest.route_logs(stamped), root, batch_id, marked)
            if archive is not None:
                topics.write_day_files(stamped.where("usable"), archive, batch_id, zone)
            bad = stamped.where(~F.col("usable")).select(F.col("raw").alias("value"), "arrived")
            keyed.write_batch(bad, quarantine, batch_id)

    return _start(lines, "route_logs", sink, checkpoint, interval)


def route_changes(changes, root, checkpoint, db_pattern=None, routes=ingest.CHANGE_ROUTES, interval=INTERVAL):
    """Database row changes to the order, order detail and user topics."""

    def sink(batch, batch_id):
        topics.write_topics(ingest.route_changes(batch, db_pattern, routes), root, batch_id)

    return _start(changes, "route_changes", sink, checkpoint, interval)


# Devices --------------------------------------------------------------------------------------------------------


def dau_sink(table, schema=DAU_ROW, order_by=("ts",), first_seen=None):
    """Keeps the first log of each device and day: first within the batch, then against the stored days.

    Stored keys are looked up only for the days that the batch has, and only those that the batch asks about leave
    their executors.  A few devices are looked up by a filter on ``mid``, which skips row groups by their Bloom filters.
    ``first_seen`` names a table to keep of the day each device was first seen on (read it with ``first_seen_table``).
    """

    def sink(batch, batch_id):
        spark = _spark(batch)
        keyed.fold(spark, table, batch_id, day="log_date", lookup=("mid",))
        with _Held(devices.first_per_day(batch, order_by)) as firsts:
            # One row per day.
            days = firsts.groupBy("log_date").agg(F.count(F.lit(1)).alias("n")).collect()
            if not days:
                return
            stored = keyed.read_batches(spark, table, schema, before=batch_id)
            stored = _asked(stored.where(F.col("log_date").isin([d.log_date for d in days])), firsts, days)
            seen = devices.seen_among(firsts, stored, broadcast_keys=sum(d.n for d in days) <= BROADCAST_KEYS)
            with _Held(devices.unseen(firsts, seen)) as new:
                keyed.write_batch(new, table, batch_id, "log_date")
                if first_seen is not None:
                    _keep_first_seen(new, first_seen, batch_id)

    return sink


def _asked(stored, firsts, days):
    """Stored rows, those of a few devices alone where the batch has no more."""
    if sum(d.n for d in days) > FILTER_KEYS:
        return stored
    mids = [r.mid for r in firsts.select("mid").distinct().collect()]
    return stored.where(reduce(or_, [F.col("mid").isNull() if m is None else F.col("mid") == F.lit(m) for m in mids]))


FIRST_SEEN = ("mid", "log_date", moves.GONE)


def _first_seen_layout(rows):
    kinds = dict(rows.dtypes)
    return f"mid {kinds['mid']}, log_date {kinds['log_date']}, {moves.GONE} boolean"


def _keep_first_seen(new, table, batch_id):
    """Adds devices never seen before under their day, and moves those that a late row shows to be older.

    The unknown device is never recognised: it is new on every day.
    """
    spark = _spark(new)
    keyed.fold(spark, table, batch_id, ("log_date", "mid"), day="log_date", lookup=("mid",))
    layout = _first_seen_layout(new)
    unknown = new.where("mid IS NULL").select("mid", "log_date", F.lit(False).alias(moves.GONE))
    known = new.where("mid IS NOT NULL").groupBy("mid").agg(F.min("log_date").alias("log_date"))
    stored = keyed.read_batches(spark, table, layout, before=batch_id).join(_few(known.select("mid")), "mid", "left_semi")
    live = moves.staying(keyed.current(stored, ["log_date", "mid"]))
    placed = moves.relocated(known, live, "mid", "log_date", F.col("r.log_date") < F.col("s.log_date"))
    keyed.write_batch(placed.select(*FIRST_SEEN).unionByName(unknown), table, batch_id, "log_date")


def _few(keys):
    """Keys of a batch, sent to where a stored table lies if they are few."""
    return F.broadcast(keys) if keys.count() <= BROADCAST_KEYS else keys


def _of_few(stored, keys):
    """Stored rows with one of the keys of a batch, filtered in place if these are few; all rows if not."""
    return stored.join(F.broadcast(keys), keys.columns, "left_semi") if keys.count() <= BROADCAST_KEYS else stored


def first_seen_table(spark, table, schema):
    """(mid, log_date): devices by the day they were first seen on; a filter on the day reads that day alone."""
    kinds = T.StructType([schema[c] for c in ("mid", "log_date")]) if isinstance(schema, T.StructType) else None
    layout = f"{keyed.ddl(kinds) if kinds else schema}, {moves.GONE} boolean"
    rows = keyed.read_batches(spark, table, layout)
    return moves.staying(keyed.current(rows, ["log_date", "mid"])).drop(moves.GONE)


def dau(logs, table, checkpoint, schema=DAU_ROW, order_by=("ts",), interval=DAU_INTERVAL, first_seen=None):
    """Typed startup logs to the table of daily active devices."""
    return _start(logs, "dau", dau_sink(table, schema, order_by, first_seen), checkpoint, interval)


def dau_from_messages(messages, table, checkpoint, quarantine, zone=clock.SHOP_ZONE, interval=DAU_INTERVAL, first_seen=None):
    """The same from raw messages, with those that cannot be decoded set aside."""
    store = dau_sink(table, first_seen=first_seen)

    def sink(batch, batch_id):
        with _Held(decode.startup_logs(batch, zone)) as decoded:
            _set_aside(decoded, quarantine, batch_id)
            store(decode.accepted(decoded), batch_id)

    return _start(messages, "dau", sink, checkpoint, interval)


# Orders and users -----------------------------------------------------------------------------------------------


ORDER_VERSION = T.StructType(ORDER_ROW.fields + [MESSAGE["arrived"], T.StructField(moves.GONE, T.BooleanType())])


def orders(messages, table, checkpoint, quarantine, interval=INTERVAL):
    """Order messages to the order table, one row per id (read it with ``order_table``).

    The version written last holds.  One that changes the day of creation takes the order out of its old day, and one
    that comes after a later version changes nothing.
    """

    def sink(batch, batch_id):
        spark = _spark(batch)
        keyed.fold(spark, table, batch_id, ("create_date", "id"), ("arrived",), "create_date", lookup=("id",))
        with _Held(decode.orders(_arranged(batch))) as decoded:
            _set_aside(decoded, quarantine, batch_id)
            with _Held(_last_written(decoded, ["id"])) as latest:
                places = keyed.read_batches(spark, table, ORDER_VERSION, before=batch_id)
                places = places.select("id", "create_date", "arrived", moves.GONE, "batch_id")
                live = moves.staying(_order_rows(places.join(_few(latest.select("id")), "id", "left_semi")))
                later = F.col("r.arrived") >= F.col("s.arrived")
                keyed.write_batch(moves.relocated(latest, live, "id", "create_date", later), table, batch_id, "create_date")

    return _start(messages, "orders", sink, checkpoint, interval)


def _order_rows(versions):
    return keyed.current(versions, ["create_date", "id"], ["arrived"])


def order_table(spark, table):
    """The order table.

    An order is kept under one day at any time, so a filter on ``create_date`` reaches the scan below the choice of
    versions.
    """
    return moves.staying(_order_rows(keyed.read_batches(spark, table, ORDER_VERSION))).drop(moves.GONE)


def users(messages, table, checkpoint, quarantine, interval=INTERVAL):
    """User messages to the user snapshot: per id the raw object that was written last."""

    def sink(batch, batch_id):
        keyed.fold(_spark(batch), table, batch_id, ("id",), ("arrived",), lookup=("id",))
        with _Held(decode.users(_arranged(batch))) as decoded:
            _set_aside(decoded, quarantine, batch_id)
            order = _written(decoded)
            good = decoded.where(F.col(decode.REASON).isNull()).select("id", "value", *order)
            latest = latest_by_key(good, ["id"], order).select("id", "value", "arrived")
            keyed.write_batch(latest, table, batch_id)

    return _start(messages, "users", sink, checkpoint, interval)


USER_VERSION = "id string, value string, arrived timestamp"


def user_snapshot(spark, table, ids=None):
    """The user table as of now, decoded; only the users in ``ids`` (a frame of ``id``) when given.

    The restriction comes before versions are compared, so users nobody asks about are not shuffled.
    """
    versions = keyed.read_batches(spark, table, USER_VERSION)
    if ids is not None:
        versions = versions.join(ids, "id", "left_semi")
    latest = keyed.current(versions, ["id"], ["arrived"])
    return decode.accepted(decode.users(latest.select("value"))).select(*USER.fieldNames())


# Sales ----------------------------------------------------------------------------------------------------------


_WAITING_ORDER = ("id", "order_status", "create_time", "user_id", "create_date")
_WAITING_LINE = ("id", "order_id", "sku_id", "sku_name", "order_price")
_UNTIL = "orders timestamp, lines timestamp"
_BUYER = ("user_gender", "user_age", "user_level")


def sale_details(order_rows, detail_rows, table, checkpoint, users, as_of, lateness=SALE_LATENESS, salts=1,
                 interval=INTERVAL):
    """Orders and order lines that arrive at most ``lateness`` apart, with buyer data, to the sale documents.

    Both inputs carry ``arrived``.  ``users`` maps a frame of buyer ids to their snapshot (such as ``user_snapshot``)
    and ``as_of`` gives the time ages refer to; both are called per batch, so a batch sees the users known when it
    runs.  A pair that is delivered again overwrites its document.

    Rows wait for their partners in a stored table below the checkpoint, not in memory: a folder for each side, sorted by
    a whole number for the time of arrival, by which a scan skips what has left.  Spark makes a batch anew for every
    action on it, so it is written there at once and read from there.  Its rows are joined with each other and with the
    waiting ones that they ask for: one batch join, which spills and is split at run time.  A row waits until both sides
    have come ``lateness`` past the last time a partner could arrive; a later partner still finds it as long as it is
    there.  ``salts`` is as in ``join_sales``.
    """
    waiting, place = f"{checkpoint}/waiting", f"{checkpoint}/waiting/rows"
    order_kind, line_kind = (
        f"struct<{', '.join(f'`{c}`: {kinds[c]}' for c in columns)}>"
        for kinds, columns in ((dict(order_rows.dtypes), _WAITING_ORDER), (dict(detail_rows.dtypes), _WAITING_LINE))
    )
    layout = f"at bigint, an_order {order_kind}, a_line {line_kind}, side string"
    gap = F.expr(f"INTERVAL {lateness}")
    at = F.unix_micros("arrived").alias("at")
    orders_in = order_rows.where(F.col("id").isNotNull()).select(
        at, F.struct(*_WAITING_ORDER).alias("an_order"), F.lit(None).cast(line_kind).alias("a_line"), F.lit("order").alias("side"))
    lines_in = detail_rows.where(F.col("order_id").isNotNull()).select(
        at, F.lit(None).cast(order_kind).alias("an_order"), F.struct(*_WAITING_LINE).alias("a_line"), F.lit("line").alias("side"))

    def orders_of(rows):
        return rows.where(F.col("side") == "order").select("an_order.*", F.timestamp_micros("at").alias("arrived"), "new")

    def lines_of(rows):
        return rows.where(F.col("side") == "line").select("a_line.*", F.timestamp_micros("at").alias("arrived"), "new")

    def sink(batch, batch_id):
        spark = _spark(batch)
        until = keyed.newest_folder(spark, f"{waiting}/until", _UNTIL, batch_id).drop("batch_id")
        # Of a side that has not come yet nothing is known, so all rows wait.
        both = until.agg(F.max("orders").alias("o"), F.max("lines").alias("l")).where("o IS NOT NULL AND l IS NOT NULL")
        since = both.select(F.unix_micros(F.least("o", "l") - gap - gap)).first()
        alive = F.lit(True) if since is None else F.col("at") >= since[0]

        keyed.fold(spark, table, batch_id, ("dt", "order_detail_id"), ("arrived",), "dt")
        keyed.fold(spark, f"{waiting}/until", batch_id)
        keyed.fold(spark, place, batch_id, day="at", keep=alive, by=("side",), layout=layout)
        keyed.write_batch(batch, place, batch_id, "at", by=("side",))
        come = keyed.read_batch(spark, place, layout, batch_id).withColumn("new", F.lit(True))
        orders, lines = orders_of(come), lines_of(come)
        never = F.lit(None).cast("timestamp")
        reached = until.unionByName(orders.select(F.col("arrived").alias("orders"), never.alias("lines")))
        reached = reached.unionByName(lines.select(never.alias("orders"), F.col("arrived").alias("lines")))
        keyed.write_batch(reached.agg(F.max("orders").alias("orders"), F.max("lines").alias("lines")), f"{waiting}/until", batch_id)

        if any(first < batch_id for first, _, _ in keyed.folders(spark, place)):
            before = keyed.read_batches(spark, place, layout, before=batch_id).where(alive).withColumn("new", F.lit(False))
            asked_orders = _of_few(orders_of(before), lines.select(F.col("order_id").alias("id")))
            asked_lines = _of_few(lines_of(before), orders.select(F.col("id").alias("order_id")))
            orders, lines = orders.unionByName(asked_orders), lines.unionByName(asked_lines)
        buyers = orders.select(F.col("user_id").alias("id")).where(F.col("id").isNotNull()).distinct()
        # The snapshot has at most one row per buyer, so the count of buyers bounds both broadcasts.
        snapshot = F.broadcast(users(F.broadcast(buyers))) if buyers.count() <= BROADCAST_KEYS else users(buyers)
        # Orders get their buyers before they meet their lines, of which there are more.
        known = sales.enrich(orders, snapshot, as_of())
        documents = sales.join_sales(known, lines, lateness, salts, _BUYER, "new")
        keyed.write_batch(latest_by_key(documents, ["dt", "order_detail_id"], ["arrived"]), table, batch_id, "dt")

    return _start(orders_in.unionByName(lines_in), "sale_details", sink, checkpoint, interval)


def sale_details_from_messages(order_messages, detail_messages, table, checkpoint, users, as_of, lateness=SALE_LATENESS,
                               salts=1, interval=INTERVAL):
    """The same from raw messages of both topics; ``set_aside`` keeps those that cannot be decoded."""
    order_rows = decode.accepted(decode.orders(order_messages), keep=("arrived",))
    detail_rows = decode.accepted(decode.order_details(detail_messages), keep=("arrived",))
    return sale_details(order_rows, detail_rows, table, checkpoint, users, as_of, lateness, salts, interval)


def sale_documents(spark, table, schema):
    """The sale documents of all days.

    A document belongs to its day, so a filter on ``dt`` reaches the scan below the choice of versions.
    """
    return keyed.current(keyed.read_batches(spark, table, schema), ["dt", "order_detail_id"], ["arrived"])


# Alerts ---------------------------------------------------------------------------------------------------------


def coupon_alerts(logs, table, checkpoint, window_seconds=coupon.WINDOW_SECONDS, slide_seconds=coupon.SLIDE_SECONDS,
                  offset_seconds=0, delay="1 minute", interval=INTERVAL, once=(), **rule):
    """Typed event logs to alert documents, one per device and minute (read them with ``alert_documents``).

    State holds each event once for every window it lies in, so this is for windows that tumble or slide by much;
    ``sliding_alerts`` holds it once.
    """
    facts = coupon.stream_facts(logs, window_seconds, slide_seconds, offset_seconds, delay, once)

    def sink(batch, batch_id):
        keyed.fold(_spark(batch), table, batch_id)
        with _Held(batch) as facts_of_closed_windows:
            found = coupon.window_alerts(facts_of_closed_windows, minutes_shared=slide_seconds < 60, **rule)
            keyed.write_batch(found, table, batch_id)

    return _start(facts, "coupon_alerts", sink, checkpoint, interval)


_PANE_KEYS = ("mid", "uid", "evid", "itemid")
PANE = "pane_start bigint, mid string, uid string, evid string, itemid string, n bigint"


def sliding_alerts(logs, panes, table, checkpoint, window_seconds=coupon.WINDOW_SECONDS,
                   slide_seconds=coupon.SLIDE_SECONDS, offset_seconds=0, delay="1 minute", interval=INTERVAL, once=(), **rule):
    """Typed event logs to alert documents over sliding windows, each final when it is written.

    State holds counts per pane, the longest stretch of which all windows are made: an event is in it once, whatever the
    slide.  Closed panes go to the table ``panes``.  The sink then forms the windows that have closed since the last
    closed pane before, from the panes that these reach back to; windows that end in one minute wait until the minute's
    last has closed, so no alert is written twice.  A window that ends after the last closed pane waits for the next one.
    """
    pane_seconds = gcd(window_seconds, slide_seconds)
    facts = coupon.stream_facts(logs, pane_seconds, pane_seconds, offset_seconds, delay, once)

    def open_end(rows):
        last = rows.agg(F.max("pane_start")).first()[0]
        return None if last is None else coupon.open_end(last + pane_seconds, window_seconds, slide_seconds, offset_seconds)

    def sink(batch, batch_id):
        spark = _spark(batch)
        keyed.fold(spark, panes, batch_id, day="pane_start")
        keyed.fold(spark, table, batch_id)
        closed = batch.select((F.col("window_end") - pane_seconds).alias("pane_start"), *_PANE_KEYS, "n")
        with _Held(closed) as rows:
            until = open_end(rows)
            if until is None:
                return
            keyed.write_batch(rows, panes, batch_id, "pane_start")
            # Panes close in order, so the last batch that closed any tells which windows have been formed.
            since = open_end(keyed.newest_folder(spark, panes, PANE, batch_id))
            if since is not None and since >= until:
                return
            reached = keyed.read_batches(spark, panes, PANE, before=batch_id).drop("batch_id")
            if since is not None:
                reached = reached.where(F.col("pane_start") >= since - window_seconds)
            found = coupon.pane_alerts(
                reached.unionByName(rows), window_seconds, slide_seconds, offset_seconds, ends=(since, until), **rule
            )
            keyed.write_batch(found, table, batch_id)

    return _start(facts, "sliding_alerts", sink, checkpoint, interval)


def sliding_alerts_from_messages(messages, panes, table, checkpoint, once=("source", "position"), zone=clock.SHOP_ZONE, **options):
    """The same from raw event messages, each counted once by the columns that tell messages apart.

    These are a partition and an offset, or the ``mark`` of files that ``topics.write_topics`` has marked.
    """
    logs = decode.accepted(decode.event_logs(messages, zone), keep=once)
    return sliding_alerts(logs, panes, table, checkpoint, once=once, **options)


def alert_documents(spark, table, schema):
    return keyed.current_documents(keyed.read_batches(spark, table, schema), ["doc_id"], "ts", ["kind", "value"])
