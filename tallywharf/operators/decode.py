"""JSON messages to typed rows.

A message that cannot be decoded is kept, with the reason, instead of failing the batch: ``accepted`` gives the typed
rows and ``rejected`` the raw messages to put aside.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import clock, text
from ..schemas import EVENT_LOG, ORDER, ORDER_DETAIL, STARTUP_LOG, USER, wire

REASON = "reject_reason"
#: Columns of a message that say what it is and where it stands, not what it holds.
CARRIED = ("value", "arrived", "source", "position", "line", "mark")
_CORRUPT = "_corrupt"


def _parse(messages, schema):
    """Adds one column per field, cast to its type, and the reason why a message is not acceptable.

    The parsed object passes through a one-element ``explode_outer``: filters on it are not pushed below that, so each
    message is parsed once rather than once more for every filter.  The array is a column of its own, which Spark counts
    in the size of the rows: with the object first made inside it Spark took a few of its fields for a tenth of the
    messages' size, and sent millions of them to every task through the driver.
    """
    layout = T.StructType(wire(schema).fields + [T.StructField(_CORRUPT, T.StringType())])
    opened = F.from_json("value", layout, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    opened = messages.select("*", F.array(opened).alias("_opened"))
    parsed = opened.select("*", F.explode_outer("_opened").alias("_wire")).drop("_opened")
    no_object = (
        F.col("_wire").isNull()
        | F.col(f"_wire.{_CORRUPT}").isNotNull()
        | ~F.coalesce(F.ltrim("value").startswith("{"), F.lit(False))
    )
    reason = F.when(no_object, "not a JSON object")
    typed = {}
    for field in schema.fields:
        raw = F.col(f"_wire.{field.name}")
        if isinstance(field.dataType, T.StringType):
            typed[field.name] = raw
        else:
            typed[field.name] = _number(raw, field.dataType)
            reason = reason.when(raw.isNotNull() & typed[field.name].isNull(), f"bad {field.name}")
    return parsed.withColumns({**typed, REASON: reason}).drop("_wire")


def _number(raw, kind):
    """Text as a number; a whole number may be written with a fraction or an exponent."""
    plain = raw.try_cast(kind)
    if not isinstance(kind, T.LongType):
        return plain
    exact = raw.try_cast("decimal(38,9)")
    return F.coalesce(F.when(~raw.contains("."), plain), F.when(exact == F.floor(exact), exact.try_cast(kind)))


def _also(reason, bad, label):
    return F.coalesce(reason, F.when(bad, F.lit(label)))


def _logs(messages, schema, zone):
    rows = _parse(messages, schema).withColumn("_local", clock.local_time("ts", zone))
    return rows.withColumns({
        "log_date": clock.day_text(F.col("_local")),
        "log_hour": clock.hour_text(F.col("_local")),
        REASON: _also(F.col(REASON), ~F.coalesce(clock.in_range("ts"), F.lit(False)), "bad ts"),
    }).drop("_local")


def startup_logs(messages, zone=clock.SHOP_ZONE):
    return _logs(messages, STARTUP_LOG, zone)


def event_logs(messages, zone=clock.SHOP_ZONE):
    return _logs(messages, EVENT_LOG, zone)


def orders(messages):
    """Orders with day and hour of creation; the phone number leaves this step masked only."""
    rows = _parse(messages, ORDER).withColumn("_created", clock.parse_local("create_time"))
    return rows.withColumns({
        "create_date": clock.day_text(F.col("_created")),
        "create_hour": clock.hour_text(F.col("_created")),
        "consignee_tel": text.mask_phone(F.col("consignee_tel")),
        REASON: _also(_also(F.col(REASON), F.col("_created").isNull(), "bad create_time"), F.col("id").isNull(), "no id"),
    }).drop("_created")


def order_details(messages):
    """Order lines.  One without an id gets one from its content, the same whenever the message is decoded."""
    rows = _parse(messages, ORDER_DETAIL)
    reason = _also(F.col(REASON), F.col("order_price").isNull(), "bad order_price")
    return rows.withColumns({
        "id": F.coalesce("id", F.concat(F.lit("line-"), F.sha2("value", 256))),
        REASON: _also(reason, F.col("order_id").isNull(), "no order_id"),
    })


def users(messages):
    rows = _parse(messages, USER)
    return rows.withColumn(REASON, _also(F.col(REASON), F.col("id").isNull(), "no id"))


def accepted(decoded, keep=()):
    """The decoded rows that passed, without the raw message; ``keep`` names message columns to carry on."""
    drop = [c for c in CARRIED if c not in keep]
    return decoded.where(F.col(REASON).isNull()).drop(REASON, *drop)


def rejected(decoded):
    """The raw messages that did not pass and why."""
    return decoded.where(F.col(REASON).isNotNull()).select(
        "value", REASON, *[c for c in ("arrived",) if c in decoded.columns]
    )
