"""Record layouts.

Every record arrives as one JSON object per line.  Producers disagree about whether a number is written as a number
or as a string, so the wire layout of every record is all STRING and the decoder casts to the typed layout.
"""

from pyspark.sql import types as T


def _strings(*names):
    return [T.StructField(n, T.StringType()) for n in names]


# The field names of the records.
STARTUP_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "ch", "type", "vs")
    + [T.StructField("ts", T.LongType())]
)

EVENT_LOG = T.StructType(
    _strings("mid", "uid", "appid", "area", "os", "type", "evid", "pgid", "npgid", "itemid")
    + [T.StructField("ts", T.LongType())]
)

ORDER = T.StructType(
    _strings("id", "province_id", "consignee", "order_comment", "consignee_tel", "order_status", "payment_way",
             "user_id", "img_url")
    + [T.StructField("total_amount", T.DoubleType())]
    + _strings("expire_time", "delivery_address", "create_time", "operate_time", "tracking_no", "parent_order_id",
               "out_trade_no", "trade_body")
)

ORDER_DETAIL = T.StructType(
    _strings("id", "order_id", "sku_name", "sku_id")
    + [T.StructField("order_price", T.DoubleType())]
    + _strings("img_url", "sku_num")
)

USER = T.StructType(_strings("id", "login_name", "user_level", "birthday", "gender"))

DERIVED_LOG_FIELDS = T.StructType(_strings("log_date", "log_hour"))
DERIVED_ORDER_FIELDS = T.StructType(_strings("create_date", "create_hour"))

DAU_ROW = T.StructType(STARTUP_LOG.fields + DERIVED_LOG_FIELDS.fields)
ORDER_ROW = T.StructType(ORDER.fields + DERIVED_ORDER_FIELDS.fields)

SALE_DETAIL = T.StructType(
    _strings("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "user_gender")
    + [T.StructField("user_age", T.IntegerType())]
    + _strings("user_level")
    + [T.StructField("sku_price", T.DoubleType())]
    + _strings("sku_name", "dt")
)

COUPON_ALERT = T.StructType(
    _strings("doc_id", "mid", "minute", "kind", "value")
    + [T.StructField("n", T.LongType()), T.StructField("ts", T.LongType())]
)

CHANGE = T.StructType(
    _strings("entry_type", "db_name", "table_name", "event_type")
    + [T.StructField("after", T.MapType(T.StringType(), T.StringType()))]
)

MESSAGE = T.StructType(
    [T.StructField("value", T.StringType()), T.StructField("arrived", T.TimestampType())]
)


def wire(schema):
    """The all-STRING layout of a typed record."""
    return T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
