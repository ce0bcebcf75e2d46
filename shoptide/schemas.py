"""Record schemas. Field names and types are fixed values of the data feeds."""

from __future__ import annotations

from pyspark.sql import types as T


def _schema(strings: str, **typed: T.DataType) -> T.StructType:
    fields = [T.StructField(name, T.StringType()) for name in strings.split()]
    fields += [T.StructField(name, kind) for name, kind in typed.items()]
    return T.StructType(fields)


STARTUP_LOG = _schema("mid uid appid area os ch type vs", ts=T.LongType())

EVENT_LOG = _schema("mid uid appid area os type evid pgid npgid itemid", ts=T.LongType())

ORDER_INFO = _schema(
    "id province_id consignee order_comment consignee_tel order_status payment_way user_id img_url "
    "expire_time delivery_address create_time operate_time tracking_no parent_order_id out_trade_no trade_body",
    total_amount=T.DoubleType(),
)

# What a field must look like for its row to be used: an order needs a date and an hour.
ORDER_INFO_PATTERNS = {"create_time": "^[^ ]+ [^ :]+"}

ORDER_DETAIL = _schema("id order_id sku_name sku_id order_price img_url sku_num")

USER_INFO = _schema("id login_name user_level birthday gender")

SALE_DETAIL = _schema(
    "order_detail_id order_id order_status create_time user_id sku_id user_gender user_level sku_name dt",
    user_age=T.IntegerType(),
    sku_price=T.DoubleType(),
)

COUPON_ALERT = T.StructType(
    [
        T.StructField("mid", T.StringType()),
        T.StructField("uids", T.ArrayType(T.StringType())),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("events", T.ArrayType(T.StringType())),
        T.StructField("ts", T.LongType()),
    ]
)

CDC_ENVELOPE = T.StructType(
    [
        T.StructField("table", T.StringType()),
        T.StructField("event_type", T.StringType()),
        # Only ROWDATA entries carry rows; an entry without the field counts as one.
        T.StructField("entry_type", T.StringType()),
        T.StructField("rows", T.ArrayType(T.MapType(T.StringType(), T.StringType()))),
    ]
)

# Topic names; every job takes its own names as arguments, these are only defaults.
TOPIC_STARTUP = "startup_log"
TOPIC_EVENT = "event_log"
TOPIC_ORDER_INFO = "order_info"
TOPIC_ORDER_DETAIL = "order_detail"
TOPIC_USER_INFO = "user_info"
