"""The driver's tables seen as logs, orders, order lines, users and row changes.

Device logs come from ``events`` in two readings.  Where days are plain calendar days of the table, the device is the
user and ``ts`` is taken as local time.  Where the zone matters, ``ts`` is an instant and days are those of the
shop's zone.
"""

from pyspark.sql import functions as F

from ..functions import clock
from ..sources import keyed

AS_OF = "2024-01-01 00:00:00"


def path(sf_dir, name):
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark, sf_dir, name):
    return spark.read.parquet(path(sf_dir, name))


def stream(spark, sf_dir, name):
    """The table as a stream. The last letter of the path is written as a glob, so that a single file works too."""
    where = path(sf_dir, name)
    return spark.readStream.schema(read(spark, sf_dir, name).schema).parquet(f"{where[:-1]}[{where[-1]}]")


_STEP = "_step"
#: Rows that a task writes of a large table, so that a step has files for many tasks to read.
_FILE_ROWS = 200_000


def land(frame, folder, key, parts, columns=None):
    """Writes the rows below ``folder`` in ``parts`` steps, by equal ranges of a whole-number column and in its order.

    Yields after each step, so that a job can run on what has come in.  All steps are made ready in one pass; rows of
    equal keys are dealt by a digest, so a step that has one key only is still written by many tasks.  ``columns`` are
    what is written, made of the frame's once its rows have been dealt and sorted: messages are then made once, not again
    for the sample by which Spark deals, and what crosses the network is the frame.
    """
    spark = frame.sparkSession
    low, high, count = frame.agg(F.min(key), F.max(key), F.count(key)).first()
    if low is None:
        return
    step = F.lit(0)
    for k in range(1, parts):
        step = step + (F.col(key) >= low + (high + 1 - low) * k // parts).cast("int")
    dealt = key, F.xxhash64(*frame.columns)
    files = count // _FILE_ROWS
    rows = frame.where(F.col(key).isNotNull())
    rows = rows.repartitionByRange(files, *dealt) if files > spark.sparkContext.defaultParallelism else rows.repartitionByRange(*dealt)
    ready = f"{folder}-ready"
    rows = rows.withColumn(_STEP, step).sortWithinPartitions(_STEP, key)
    written = frame.columns if columns is None else columns
    rows.select(*written, _STEP).write.partitionBy(_STEP).parquet(ready)
    for k in range(parts):
        if not keyed.move(spark, f"{ready}/{_STEP}={k}", f"{folder}/{k}"):
            frame.select(*written).limit(0).write.parquet(f"{folder}/{k}")
        yield k


def landed(spark, frame, folder, *more):
    """What ``land`` writes, as a stream."""
    rows = spark.readStream.schema(frame.schema).parquet(f"{folder}/*")
    return rows.select("*", *more) if more else rows


def days(frame, column, first=None, last=None):
    """Rows whose timestamp lies on one of the days; a range on the stored column, so the scan can skip by it."""
    if first is not None:
        frame = frame.where(F.col(column) >= clock.wall_clock(first))
    if last is not None:
        end = F.date_add(F.lit(last).cast("date"), 1).cast("timestamp_ntz")
        frame = frame.where(F.col(column) < end)
    return frame


def device_logs(events):
    return events.select(
        F.to_date("ts").alias("log_date"), F.col("user_id").alias("mid"), "ts", "event_id", "event_type", "value"
    )


def with_hour(rows):
    return rows.withColumn("log_hour", clock.hour_text(F.col("ts")))


def purchases(events):
    return events.where(F.col("event_type") == "purchase").select(
        F.to_date("ts").alias("create_date"), clock.hour_text(F.col("ts")).alias("create_hour"),
        F.col("value").alias("total_amount"),
    )


def orders_by_day(orders):
    return orders.select(F.to_date("o_orderdate").alias("create_date"), F.col("o_totalprice").alias("total_amount"))


def _text(column):
    return F.col(column).cast("string")


def _money(column):
    return F.col(column).cast("decimal(18,2)").cast("string")


def _time_text(column):
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss")


def _json(*fields):
    return F.to_json(F.struct(*fields)).alias("value")


def startup_messages(events):
    return events.select(_json(
        F.lit("startup").alias("type"),
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
        _text("user_id").alias("uid"),
        F.lit("shop").alias("appid"),
        F.col("event_type").alias("ch"),
        _text("event_id").alias("vs"),
        clock.wall_seconds(F.col("ts")).alias("ts"),
    ))


def event_messages(events):
    return events.select(_json(
        F.lit("event").alias("type"),
        F.concat(F.lit("mid_"), _text("user_id")).alias("mid"),
        _text("user_id").alias("uid"),
        F.col("event_type").alias("evid"),
        F.col("event_id").alias("pgid"),
        F.get_json_object("props", "$.k").cast("int").alias("itemid"),
        clock.wall_seconds(F.col("ts")).alias("ts"),
    ))


def raw_lines(events):
    """Lines as clients send them: purchases without a type, signups as startups, a client time to be replaced."""
    kind = F.when(F.col("event_type") == "signup", "startup").when(F.col("event_type") != "purchase", "event")
    return events.select(
        _json(
            kind.alias("type"), _text("user_id").alias("uid"), F.col("event_id").alias("seq"),
            F.lit(0).alias("ts"), F.col("event_type").alias("evid"),
        ),
        (F.timestamp_seconds(clock.wall_seconds(F.col("ts")) + 5)).alias("arrived"),
    )


def shared_device_logs(events):
    """Ten accounts share a device."""
    return events.select(
        F.call_function("div", F.col("user_id"), F.lit(10)).cast("string").alias("mid"), _text("user_id").alias("uid"),
        F.col("event_type").alias("evid"), F.col("props").alias("itemid"),
        clock.wall_seconds(F.col("ts")).alias("ts"),
    )


def shared_device_messages(events):
    logs = shared_device_logs(events)
    return logs.select(_json(*[F.col(c) for c in logs.columns]), "ts")


def order_messages(orders, customers, *extra):
    return orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(_order_message(), *extra)


def _order_message():
    return _json(
        _text("o_orderkey").alias("id"), _text("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"), _money("o_totalprice").alias("total_amount"),
        F.col("o_orderpriority").alias("order_comment"), F.col("c_name").alias("consignee_tel"),
        _time_text("o_orderdate").alias("create_time"),
    )


def timed_orders(orders, customers):
    """What messages of orders are made of, with the second ``at`` which they arrive, and the columns of the messages."""
    rows = orders.join(customers, orders["o_custkey"] == customers["c_custkey"]).select(
        *orders.columns, "c_name", F.unix_seconds(arrival("o_orderkey")).alias("at")
    )
    return rows, [_order_message(), F.timestamp_seconds("at").alias("arrived"), "at"]


def orders(frame):
    return frame.select(
        F.col("o_orderkey").alias("id"), F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"), _time_text("o_orderdate").alias("create_time"),
        F.to_date("o_orderdate").cast("string").alias("create_date"), *[c for c in ("arrived",) if c in frame.columns],
    )


def order_details(lineitem, part):
    return (
        lineitem.join(part, lineitem["l_partkey"] == part["p_partkey"])
        .select(
            F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
            F.col("l_orderkey").alias("order_id"), F.col("p_name").alias("sku_name"),
            F.col("l_partkey").alias("sku_id"), F.col("l_extendedprice").alias("order_price"),
            *[c for c in ("arrived",) if c in lineitem.columns],
        )
    )


# Seconds between an order and its line, by part: some orders come after their lines.
GAPS = (0, 500, -600, 600, 601, -700)


def arrival(key, gap=None):
    """When a row arrives: orders a second apart in the order of their keys, lines some seconds from their order."""
    gap = F.lit(0) if gap is None else gap
    return F.timestamp_seconds(F.lit(1_700_000_000) + F.col(key) + gap)


def user_messages(customer):
    """Customers as user messages; see ``users``."""
    return users(customer).select(F.col("id").cast("string").alias("id"), "login_name", "user_level", "birthday", "gender")


def line_gap():
    return F.element_at(F.array(*map(F.lit, GAPS)), (F.pmod(F.col("l_partkey"), F.lit(len(GAPS))) + 1).cast("int"))


def timed_details(lineitem):
    """The same of order lines."""
    rows = lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.unix_seconds(arrival("l_orderkey", line_gap())).alias("at"),
    )
    message = _json(
        F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").alias("id"),
        _text("l_orderkey").alias("order_id"), _text("l_partkey").alias("sku_id"), _money("l_extendedprice").alias("order_price"),
    )
    return rows, [message, F.timestamp_seconds("at").alias("arrived"), "at"]


def order_detail_messages(lineitem):
    rows, columns = timed_details(lineitem)
    return rows.select(*columns[:2])


def users(customer):
    """The segment plays the gender, unknown for one segment; accounts in debt have no birthday."""
    age = F.col("c_nationkey") + 10
    born = F.date_sub(F.lit(AS_OF[:10]).cast("date"), age * 365 + 100).cast("string")
    return customer.select(
        F.col("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        F.when(F.col("c_acctbal") > 5000, "gold").otherwise("basic").alias("user_level"),
        F.when(F.col("c_acctbal") >= 0, born).alias("birthday"),
        F.when(F.col("c_mktsegment") == "MACHINERY", "F")
        .when(F.col("c_mktsegment") != "FURNITURE", "M").alias("gender"),
    )


def _change(frame, table, event, *columns):
    names = [name for name, _ in columns]
    after = F.map_from_arrays(F.array(*[F.lit(n) for n in names]), F.array(*[value for _, value in columns]))
    return frame.select(
        F.lit("ROWDATA").alias("entry_type"), F.lit("shop").alias("db_name"), F.lit(table).alias("table_name"),
        event.alias("event_type"), after.alias("after"),
    )


def row_changes(orders, lineitem, customer, part):
    """Row changes of four tables, one of them not routed; status, return flag and segment play the operation."""

    def operation(column, insert, update):
        return F.when(F.col(column) == insert, "INSERT").when(F.col(column) == update, "UPDATE").otherwise("DELETE")

    return (
        _change(orders, "order_info", operation("o_orderstatus", "O", "F"), ("id", _text("o_orderkey")),
                ("user_id", _text("o_custkey")), ("total_amount", _money("o_totalprice")),
                ("create_time", _time_text("o_orderdate")))
        .unionByName(_change(lineitem, "order_detail", operation("l_returnflag", "N", "R"),
                             ("id", F.concat_ws("-", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")),
                             ("order_id", _text("l_orderkey")), ("sku_id", _text("l_partkey")),
                             ("order_price", _money("l_extendedprice"))))
        .unionByName(_change(customer, "user_info", operation("c_mktsegment", "MACHINERY", "FURNITURE"),
                             ("id", _text("c_custkey")), ("login_name", F.col("c_name")),
                             ("gender", F.col("c_mktsegment"))))
        .unionByName(_change(part, "sku_info", F.lit("INSERT"), ("id", _text("p_partkey")),
                             ("sku_name", F.col("p_name"))))
    )
