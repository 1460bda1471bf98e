"""Stamping and routing of raw logs and of database change rows."""

from pyspark.sql import functions as F

# Topics. A topic is a name only; where it lives is the source's and sink's business.
STARTUP, EVENT = "startup", "event"
ORDER_INFO, ORDER_DETAIL, USER_INFO = "order_info", "order_detail", "user_info"

# Fixed values: (table, event types, topic), which row changes are published where. All other changes are dropped.
CHANGE_ROUTES = (
    ("order_info", ("INSERT",), ORDER_INFO),
    ("order_detail", ("INSERT",), ORDER_DETAIL),
    ("user_info", ("INSERT", "UPDATE"), USER_INFO),
)


def _last_of_each_key(entries):
    """A map without the earlier entries of a key that is there more than once, as JSON allows."""
    names = F.map_keys(entries)
    kept = F.filter(F.map_entries(entries), lambda e, i: ~F.array_contains(F.slice(names, i + 2, F.size(names)), e["key"]))
    once = F.size(F.array_distinct(names)) == F.size(names)
    return F.when(once, entries).otherwise(F.map_from_entries(kept))


def stamp(lines, arrived):
    """Adds the arrival second to each raw log line as ``ts``, replacing one sent by the client.

    Lines are objects of any shape, so they are opened one level only and every value keeps its JSON type.  A line
    that is not an object is not ``usable``; its text stays in ``raw``.
    """
    # Passing through one-element explodes keeps what follows from parsing the line again.
    opened = F.explode(F.array(F.from_json("value", "map<string,variant>"))).alias("opened")
    lines = lines.select("value", arrived.alias("arrived"), opened)
    lines = lines.select("value", "arrived", F.explode(F.array(_last_of_each_key(F.col("opened")))).alias("entries"))
    others = F.map_filter("entries", lambda k, _: k != "ts")
    second = F.create_map(F.lit("ts"), F.unix_seconds("arrived").cast("variant"))
    return lines.select(
        F.col("value").alias("raw"),
        F.to_json(F.map_concat(others, second), {"ignoreNullFields": "false"}).alias("value"),
        F.try_variant_get(F.try_element_at("entries", F.lit("type")), "$", "string").alias("type"),
        "arrived",
        F.col("entries").isNotNull().alias("usable"),
    )


def log_topic(kind):
    """Logs of type "event" are events; every other log, also one without a type, is a startup."""
    return F.when(kind.eqNullSafe("event"), EVENT).otherwise(STARTUP)


def route_logs(stamped):
    return stamped.where("usable").select(
        log_topic(F.col("type")).alias("topic"), "value", "arrived"
    )


def change_topic(routes=CHANGE_ROUTES):
    topic = F.lit(None).cast("string")
    for table, events, name in reversed(routes):
        topic = F.when((F.col("table_name") == table) & F.col("event_type").isin(*events), name).otherwise(topic)
    return topic


def route_changes(changes, db_pattern=None, routes=CHANGE_ROUTES):
    """Row changes of the routed tables as (topic, after-image JSON)."""
    rows = changes.where(F.col("entry_type") == "ROWDATA")
    if db_pattern is not None:
        rows = rows.where(F.concat_ws(".", "db_name", "table_name").rlike(f"^(?:{db_pattern})$"))
    return (
        rows.withColumn("topic", change_topic(routes))
        .where(F.col("topic").isNotNull())
        .select("topic", F.to_json("after", {"ignoreNullFields": "false"}).alias("value"))
    )
