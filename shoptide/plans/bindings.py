"""The shop's records as views over the test tables.

Every function is DataFrame in, DataFrame out, so it binds a table and a replay of it alike.
"""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.functions import money, with_log_time, with_order_time

DAY = "yyyy-MM-dd"
SECOND = "yyyy-MM-dd HH:mm:ss"
ACCOUNTS_PER_DEVICE = 15


def text(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def _ms(ts: str) -> Column:
    return F.unix_millis(F.col(ts).cast("timestamp"))


def between_days(df: DataFrame, ts: str, *dates: str) -> DataFrame:
    """Rows of the given days, as ranges of the raw time column that reach the file scan."""
    keep = F.lit(False)
    for day in dates:
        after = (Date.fromisoformat(day) + timedelta(days=1)).isoformat()
        keep = keep | ((F.col(ts) >= F.lit(day).cast("timestamp_ntz")) & (F.col(ts) < F.lit(after).cast("timestamp_ntz")))
    return df.filter(keep)


def up_to_day(df: DataFrame, ts: str, date: str) -> DataFrame:
    """Rows up to the end of a day, as a range of the raw time column."""
    after = (Date.fromisoformat(date) + timedelta(days=1)).isoformat()
    return df.filter(F.col(ts) < F.lit(after).cast("timestamp_ntz"))


def startup_logs(events: DataFrame) -> DataFrame:
    logs = events.select("event_id", text("user_id").alias("mid"), text("user_id").alias("uid"), _ms("ts").alias("ts"))
    return with_log_time(logs)


def event_type(column: str = "event_type") -> Column:
    kind = F.col(column)
    return F.when(kind == "purchase", "coupon").when(kind == "click", "clickItem").otherwise(kind)


def event_logs(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        text(F.expr(f"user_id div {ACCOUNTS_PER_DEVICE}")).alias("mid"),
        text("user_id").alias("uid"),
        event_type().alias("evid"),
        F.get_json_object("props", "$.k").alias("itemid"),
        _ms("ts").alias("ts"),
    )


DENSE_START, DENSITY = 1_704_067_200_000, 200


def dense_event_logs(events: DataFrame) -> DataFrame:
    """Event logs two hundred times as dense, so that windows of minutes hold several."""
    since = F.call_function("div", F.col("ts") - DENSE_START, F.lit(DENSITY).cast("bigint"))
    return event_logs(events).withColumn("ts", F.lit(DENSE_START) + since)


def event_messages(events: DataFrame) -> DataFrame:
    """(event_id, value): event logs as JSON; those of errors are cut off before the end."""
    e = event_logs(events)
    item = F.format_string(
        '{"mid":"%s","uid":"%s","evid":"%s","itemid":%s,"ts":%s,"extra":true}',
        "mid", "uid", "evid", "itemid", text("ts"),
    )
    cut = F.substring(item, 1, 20)
    return e.select("event_id", F.when(F.col("evid") == "error", cut).otherwise(item).alias("value"))


def device_messages(events: DataFrame) -> DataFrame:
    """(value, stamp): device logs before intake. Sign-ups count as start-ups, errors have no type. Some have white space
    around them or a ``ts`` in their body, and every 17th is followed by something else, so that it is no JSON."""
    kind = F.when(F.col("event_type") == "signup", "startup").otherwise("event")
    nested = F.when(F.col("event_id") % 11 == 3, F.lit(',"more":{"ts":5}')).otherwise("")
    ends = {1: "\n", 2: "\t", 3: "\r\n", 4: " }", 5: " x"}
    end = F.lit("")
    for rest, text_after in ends.items():
        end = F.when(F.col("event_id") % 17 == rest, F.lit(text_after)).otherwise(end)
    typed = F.when(F.col("event_type") == "error", "").otherwise(F.concat(F.lit('"type":"'), kind, F.lit('",')))
    value = F.concat(F.lit('{"mid":"'), text("user_id"), F.lit('",'), typed, F.lit('"ts":1,"price":1.50,"serial":123456789012345678901234567890,"body":'), F.col("props"), nested, F.lit("}"), end)
    return events.select(value.alias("value"), _ms("ts").alias("stamp"))


def json_messages(df: DataFrame, *columns: str) -> DataFrame:
    """(value, timestamp) messages holding ``columns``, with the ``offset`` if there is one."""
    place = ["offset"] if "offset" in df.columns else []
    return df.select(F.to_json(F.struct(*columns)).alias("value"), "timestamp", *place)


def phone(key: str) -> Column:
    return F.concat(F.lit("13"), F.lpad(text(key), 9, "0"))


def orders(table: DataFrame, *extra: Column) -> DataFrame:
    """Orders; all were placed at midnight."""
    rows = table.select(
        text("o_orderkey").alias("id"),
        text("o_custkey").alias("user_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_totalprice").alias("total_amount"),
        F.date_format("o_orderdate", SECOND).alias("create_time"),
        phone("o_orderkey").alias("consignee_tel"),
        *extra,
    )
    return with_order_time(rows)


def province_orders(table: DataFrame, customer: DataFrame) -> DataFrame:
    """Orders with the province of the customer."""
    home = customer.select(F.col("c_custkey").alias("o_custkey"), text("c_nationkey").alias("province_id"))
    return table.select("o_custkey", F.col("o_totalprice").alias("total_amount")).join(home, "o_custkey")


def timed_orders(events: DataFrame, *extra: Column) -> DataFrame:
    """Purchases as orders, with the time of day."""
    rows = events.filter(F.col("event_type") == "purchase").select(
        text("event_id").alias("id"),
        text("user_id").alias("user_id"),
        F.col("value").alias("total_amount"),
        F.date_format("ts", SECOND).alias("create_time"),
        phone("event_id").alias("consignee_tel"),
        *extra,
    )
    return with_order_time(rows)


def details(lineitem: DataFrame, part: DataFrame | None, *extra: Column) -> DataFrame:
    """Order items; without ``part`` their product name is null, for plans that have no use for it."""
    item = F.concat_ws("-", text("l_orderkey"), text("l_linenumber"))
    named = lineitem.withColumn("sku_name", F.lit(None).cast("string"))
    if part is not None:
        names = part.select(F.col("p_partkey").alias("l_partkey"), F.col("p_name").alias("sku_name"))
        named = lineitem.join(names, "l_partkey", "left")
    return named.select(
        item.alias("id"),
        text("l_orderkey").alias("order_id"),
        "sku_name",
        text("l_partkey").alias("sku_id"),
        text(money("l_extendedprice")).alias("order_price"),
        text(F.col("l_quantity").cast("bigint")).alias("sku_num"),
        *extra,
    )


# Arrival times: one order per second, its lines 40 seconds apart.
ARRIVAL_START = 1704067200


def order_arrival() -> Column:
    return F.timestamp_seconds(F.lit(ARRIVAL_START) + F.col("o_orderkey"))


def detail_arrival() -> Column:
    return F.timestamp_seconds(F.lit(ARRIVAL_START) + F.col("l_orderkey") + F.col("l_linenumber") * 40)


def users(customer: DataFrame, *extra: Column) -> DataFrame:
    birthday = F.date_add(F.lit("1960-01-01").cast("date"), (F.col("c_custkey") * 37 % 18000).cast("int"))
    return customer.select(
        text("c_custkey").alias("id"),
        F.col("c_name").alias("login_name"),
        text(F.col("c_custkey") % 3 + 1).alias("user_level"),
        F.date_format(birthday, DAY).alias("birthday"),
        F.when(F.col("c_custkey") % 2 == 0, "M").otherwise("F").alias("gender"),
        *extra,
    )


def user_changes(customer: DataFrame) -> DataFrame:
    """Every user as version 1; those with a balance over 5000 rise to level 9 as version 2."""
    first = users(customer, F.lit(1).alias("version"))
    risen = users(customer.filter(F.col("c_acctbal") > 5000), F.lit(2).alias("version"))
    return first.unionByName(risen.withColumn("user_level", F.lit("9")))


def change_feed(orders: DataFrame, lineitem: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Change-feed entries (table, event_type, entry_type, rows); a user entry carries two rows. Every fifth order has an
    entry that carries no row data."""

    def kind(key: str) -> Column:
        return F.element_at(F.array(F.lit("INSERT"), F.lit("UPDATE"), F.lit("DELETE")), (F.col(key) % 3 + 1).cast("int"))

    def row(**fields: Column) -> Column:
        return F.create_map(*[x for name, value in fields.items() for x in (F.lit(name), value)])

    def entry(df: DataFrame, table: str, event_type: Column, *rows: Column) -> DataFrame:
        entry_type = F.when(F.col(df.columns[0]) % 5 == 0, "TRANSACTIONEND").otherwise("ROWDATA") if table == "order_info" else F.lit("ROWDATA")
        return df.select(F.lit(table).alias("table"), event_type.alias("event_type"), entry_type.alias("entry_type"), F.array(*rows).alias("rows"))

    order_row = row(id=text("o_orderkey"), user_id=text("o_custkey"), total_amount=text(money("o_totalprice")))
    item_row = row(
        id=F.concat_ws("-", text("l_orderkey"), text("l_linenumber")),
        order_id=text("l_orderkey"),
        sku_id=text("l_partkey"),
        order_price=text(money("l_extendedprice")),
    )
    user_rows = [row(id=text("c_custkey"), user_level=F.lit(level)) for level in ("1", "2")]
    return (
        entry(orders, "order_info", kind("o_orderkey"), order_row)
        .unionByName(entry(lineitem, "order_detail", kind("l_orderkey"), item_row))
        .unionByName(entry(customer, "user_info", kind("c_custkey"), *user_rows))
        .unionByName(entry(nation, "base_province", F.lit("INSERT"), row(id=text("n_nationkey"), name=F.col("n_name"))))
    )


def lines_of_text(documents: DataFrame, conversations: DataFrame) -> DataFrame:
    return documents.select(F.col("text").alias("value")).unionByName(conversations.select(F.col("text").alias("value")))
