"""Order lines with their order and the buyer's current data."""

from pyspark.sql import functions as F

from ..functions import clock
from .salt import SALT, copied, spread


def order_side(orders, *extra):
    return orders.select(
        F.col("id").alias("order_id"), "order_status", "create_time", "user_id",
        F.col("create_date").alias("dt"), *extra,
    )


def detail_side(details, *extra):
    return details.select(
        F.col("id").alias("order_detail_id"), F.col("order_id").alias("detail_order_id"), "sku_id", "sku_name",
        F.col("order_price").alias("sku_price"), *extra,
    )


_SALE = ("order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id", "sku_price", "sku_name",
         "dt")


def join_sales(orders, details, lateness=None, salts=1, carry=(), new=None):
    """Matched (order, order line) pairs.

    With ``lateness`` (an interval such as "10 minutes") both sides carry ``arrived`` and a pair counts only when
    the two arrived no further apart than that; on streams with watermarks this also bounds the join state.
    ``salts`` spreads the lines of one order over that many join tasks, at the price of as many copies of each
    order.  Batch joins need no salt: adaptive execution splits oversized partitions by itself.  ``carry`` names more
    columns of the orders to keep.  With ``new``, a boolean column of both sides, a pair counts only if one of the two
    is new.
    """
    timed = lateness is not None
    left = order_side(orders, *([F.col("arrived").alias("order_arrived")] if timed else []), *carry,
                      *([F.col(new).alias("_order_new")] if new else []))
    right = detail_side(details, *(["arrived"] if timed else []), *([F.col(new).alias("_detail_new")] if new else []))
    on = F.col("order_id") == F.col("detail_order_id")
    if salts > 1:
        left = copied(left, salts).withColumnRenamed(SALT, "order_salt")
        right = spread(right, ["order_detail_id", "sku_id"], salts).withColumnRenamed(SALT, "detail_salt")
        on = on & (F.col("order_salt") == F.col("detail_salt"))
    if timed:
        gap = F.expr(f"INTERVAL {lateness}")
        on = on & F.col("arrived").between(F.col("order_arrived") - gap, F.col("order_arrived") + gap)
    if new:
        on = on & (F.col("_order_new") | F.col("_detail_new"))
    return left.join(right, on, "inner").select(*_SALE, *(["arrived"] if timed else []), *carry)


def enrich(sales, users, as_of, salts=1):
    """Adds the buyer's gender, age and level from a one-row-per-user snapshot, to sales or to orders.

    A buyer without a snapshot row keeps the sale with age 0 and no gender or level; so does an unknown birthday.
    ``salts`` spreads the sales of one buyer, as in ``join_sales``.
    """
    buyers = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        clock.age_years("birthday", as_of).alias("user_age"),
        F.col("user_level"),
    )
    on = ["user_id"]
    if salts > 1:
        sales, buyers, on = spread(sales, ["order_detail_id"], salts), copied(buyers, salts), ["user_id", SALT]
    joined = sales.join(buyers, on, "left").withColumn("user_age", F.coalesce("user_age", F.lit(0)))
    return joined.select(*[c for c in sales.columns if c != SALT], "user_gender", "user_age", "user_level")
