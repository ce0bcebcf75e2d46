"""Order ⋈ order item ⋈ user.

Inputs are ``orders`` (schema ORDER_INFO with ``create_date``), ``details`` (ORDER_DETAIL) and
``users`` (one row per id, USER_INFO). No side is broadcast by hint: the optimizer does so only
under its size threshold and otherwise sorts and merges, splitting hot keys at run time. Joins
are kept to the inner, left and anti kinds, which are the ones it can split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions import age_at, doc_id
from shoptide.operators.keyed import first_per_key

ORDER_COLUMNS = {"id": "order_id", "order_status": "order_status", "create_time": "create_time", "create_date": "dt", "user_id": "user_id"}
DETAIL_COLUMNS = {"id": "order_detail_id", "order_id": "order_id", "sku_id": "sku_id", "sku_name": "sku_name"}


def order_side(orders: DataFrame, *extra: str) -> DataFrame:
    return orders.select(*[F.col(c).alias(name) for c, name in ORDER_COLUMNS.items()], *extra)


def detail_side(details: DataFrame, *extra: str) -> DataFrame:
    price = F.coalesce(F.col("order_price").try_cast("double"), F.lit(0.0)).alias("sku_price")
    return details.select(*[F.col(c).alias(name) for c, name in DETAIL_COLUMNS.items()], price, *extra)


def join_orders(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Items with their order; items or orders without a partner do not appear."""
    return detail_side(details).join(order_side(orders), "order_id")


def join_status(orders: DataFrame, details: DataFrame) -> DataFrame:
    """Full outer join of orders and items: (order_id, order_detail_id, match_status).

    Written as left join + anti join: a full outer join cannot be split when a key is hot.
    """
    ids = orders.select(F.col("id").alias("order_id"))
    items = details.select("order_id", F.col("id").alias("order_detail_id"))
    known = ids.withColumn("known", F.lit(True))
    status = F.when(F.col("known"), F.lit("both")).otherwise(F.lit("detail_only"))
    with_items = items.join(known, "order_id", "left").select("order_id", "order_detail_id", status.alias("match_status"))
    childless = ids.join(items.select("order_id").distinct(), "order_id", "left_anti")
    return with_items.unionByName(
        childless.select("order_id", F.lit(None).cast("string").alias("order_detail_id"), F.lit("order_only").alias("match_status"))
    )


# Seconds of the units that a tolerance is given in.
UNITS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def seconds(tolerance: str) -> int:
    """``"120 seconds"`` as a number of seconds."""
    number, unit = tolerance.split()
    return int(number) * UNITS[unit.removesuffix("s")]


def arrival_bucket(time: Column, width: int) -> Column:
    """Number of the stretch of ``width`` seconds in which ``time`` lies."""
    return F.floor(F.unix_micros(time) / (width * 1_000_000))


def join_orders_within(orders: DataFrame, details: DataFrame, tolerance: str = "120 seconds", time: str = "ingest_ts") -> DataFrame:
    """:func:`join_orders` for partners that arrived within ``tolerance`` of each other."""
    return match_within(order_side(orders, F.col(time).alias("seen")), detail_side(details, F.col(time).alias("seen")), tolerance)


def match_within(placed: DataFrame, items: DataFrame, tolerance: str = "120 seconds") -> DataFrame:
    """Rows of :func:`order_side` and :func:`detail_side`, each with its arrival ``seen``, that arrived within ``tolerance``.

    An item is in the bucket of its arrival, an order in its own and the two beside it, so that the join is one of equal
    keys that takes an order with very many items apart by time.
    """
    width = seconds(tolerance)
    bucket = arrival_bucket(F.col("seen"), width)
    left = placed.withColumn("arrival", F.explode(F.array(bucket - 1, bucket, bucket + 1))).withColumnRenamed("seen", "order_seen")
    right = items.withColumn("arrival", bucket).withColumnRenamed("seen", "detail_seen")
    reach = F.expr(f"INTERVAL {width} SECONDS")
    inside = F.col("detail_seen").between(F.col("order_seen") - reach, F.col("order_seen") + reach)
    return left.join(right, ["order_id", "arrival"]).filter(inside).drop("arrival", "order_seen", "detail_seen")


def enrich_user(sales: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """Add user columns. An unknown user leaves gender and level null, age 0, ``user_known`` false."""
    side = users.select(
        F.col("id").alias("user_id"),
        F.col("gender").alias("user_gender"),
        age_at("birthday", as_of).alias("user_age"),
        F.col("user_level"),
        F.lit(True).alias("user_known"),
    )
    return sales.join(side, "user_id", "left").withColumns(
        {
            "user_age": F.coalesce(F.col("user_age"), F.lit(0)),
            "user_known": F.coalesce(F.col("user_known"), F.lit(False)),
        }
    )


def with_doc_id(sales: DataFrame) -> DataFrame:
    return sales.withColumn("doc_id", doc_id("-", "order_id", "order_detail_id"))


# Among repeats of an item the first in this order is kept.
REPEAT_ORDER = ("sku_name", "sku_id", "sku_price", "order_status", "create_time", "user_id")


def one_per_item(joined: DataFrame) -> DataFrame:
    """One row per (order_id, order_detail_id).

    The join has already brought the rows of an order together, so this needs no shuffle of its
    own; only when a hot order was split does the optimizer add one, on both columns.
    """
    return first_per_key(joined, ["order_id", "order_detail_id"], [F.col(c).asc_nulls_first() for c in REPEAT_ORDER])


ORDER_REPEATS = ("order_status", "create_time", "user_id")


def sales_by_order(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """What :func:`sale_detail` says about orders, one row per order: its user's columns, and ``sales``, how many sale
    rows it has. Enough for counts by user, and items are shuffled once, as two narrow columns."""
    items = details.select("order_id", F.col("id").alias("item")).distinct()
    counts = items.groupBy("order_id").agg(F.count("*").alias("sales"))
    # The order row that one_per_item would keep.
    placed = first_per_key(order_side(orders), ["order_id"], [F.col(c).asc_nulls_first() for c in ORDER_REPEATS])
    return enrich_user(placed.join(counts, "order_id"), users, as_of)


def sale_detail(orders: DataFrame, details: DataFrame, users: DataFrame, as_of: str | Column) -> DataFrame:
    """Wide sale rows, one per (order_id, order_detail_id).

    Users are joined to orders first, so that items, the largest table, are shuffled once: by their order.
    """
    bought = enrich_user(order_side(orders), users, as_of)
    return one_per_item(detail_side(details).join(bought, "order_id"))
