"""The registered queries: each operator over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import schemas
from shoptide.functions import age_at, doc_id, epoch_ms, mask_phone, minute_of
from shoptide.operators import alerts, dedup, metrics, sale_detail, search, users
from shoptide.operators import text as text_ops
from shoptide.plans import bindings as bind
from shoptide.plans import reports
from shoptide.session import new_run_dir, tune
from shoptide.sources import cdc, decode, logs, tables
from shoptide.streaming import jobs, sinks

DATE = "2024-01-15"
FIRST_DATE = "2024-01-01"
SALE_DATE = "1997-05-20"
KEYWORD = "red"
AS_OF = "2024-01-01"
PAGE, PAGE_SIZE = 2, 5
HOUR_MS = 3_600_000
ALERT = {"size_ms": 6 * HOUR_MS, "slide_ms": HOUR_MS, "accounts": 3}

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = lambda spark, sf: fn(tune(spark), sf)
        return fn

    return register


def _t(spark: SparkSession, sf: str, *names: str):
    found = [tables.read(spark, sf, n) for n in names]
    return found[0] if len(found) == 1 else found


def _startup(spark: SparkSession, sf: str, *dates: str) -> DataFrame:
    events = _t(spark, sf, "events")
    return bind.startup_logs(bind.between_days(events, "ts", *dates) if dates else events)


def _first_seen(spark: SparkSession, sf: str, date: str) -> DataFrame:
    """Devices and their first log ever; what comes after ``date`` makes no device of that day or earlier ones new."""
    return metrics.first_seen(bind.startup_logs(bind.up_to_day(_t(spark, sf, "events"), "ts", date)))


def _dau(spark: SparkSession, sf: str, *dates: str) -> DataFrame:
    return dedup.first_per_day(_startup(spark, sf, *dates), "event_id")


def _timed_orders(spark: SparkSession, sf: str, *dates: str) -> DataFrame:
    events = _t(spark, sf, "events")
    return bind.timed_orders(bind.between_days(events, "ts", *dates) if dates else events)


def _details(spark: SparkSession, sf: str) -> DataFrame:
    return bind.details(*_t(spark, sf, "lineitem", "part"))


def _sales(spark: SparkSession, sf: str, date: str | None = None) -> DataFrame:
    orders, customer = _t(spark, sf, "orders", "customer")
    if date:
        orders = bind.between_days(orders, "o_orderdate", date)
    return sale_detail.sale_detail(bind.orders(orders), _details(spark, sf), bind.users(customer), AS_OF)


def _order_sales(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem, customer = _t(spark, sf, "orders", "lineitem", "customer")
    return sale_detail.sales_by_order(bind.orders(orders), bind.details(lineitem, None), bind.users(customer), AS_OF)


# --- sources ----------------------------------------------------------------------------------


@query("decode_json")
def decode_json(spark: SparkSession, sf: str) -> DataFrame:
    messages = bind.event_messages(_t(spark, sf, "events"))
    rows = decode.decode(messages, schemas.EVENT_LOG, keep=("event_id",))
    return rows.select("event_id", "mid", "uid", "os", "evid", "itemid", "ts", "malformed", "raw")


def _routed(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.route(bind.change_feed(*_t(spark, sf, "orders", "lineitem", "customer", "nation")))


@query("cdc_route")
def cdc_route(spark: SparkSession, sf: str) -> DataFrame:
    first = F.element_at("rows", 1)
    return _routed(spark, sf).select("topic", "event_type", first["id"].alias("row_id"), F.size("rows").alias("n_rows"))


@query("cdc_flatten")
def cdc_flatten(spark: SparkSession, sf: str) -> DataFrame:
    return cdc.flatten(_routed(spark, sf))


@query("log_route")
def log_route(spark: SparkSession, sf: str) -> DataFrame:
    sent = bind.device_messages(_t(spark, sf, "events"))
    return logs.route(sent, F.col("stamp")).filter("NOT malformed").select("topic", "value")


# --- projections ------------------------------------------------------------------------------


@query("log_time")
def log_time(spark: SparkSession, sf: str) -> DataFrame:
    return _startup(spark, sf).select("event_id", "mid", "log_date", "log_hour")


@query("order_time")
def order_time(spark: SparkSession, sf: str) -> DataFrame:
    return _timed_orders(spark, sf).select("id", "create_time", "create_date", "create_hour")


@query("mask_phone")
def mask_phone_numbers(spark: SparkSession, sf: str) -> DataFrame:
    return bind.orders(_t(spark, sf, "orders")).select("id", mask_phone("consignee_tel").alias("consignee_tel"))


@query("doc_id")
def doc_ids(spark: SparkSession, sf: str) -> DataFrame:
    both = F.array(doc_id("_", "mid", "log_date"), doc_id("_", "mid", minute_of(epoch_ms("ts"))))
    logs_ids = _startup(spark, sf).select(F.explode(both).alias("doc_id"))
    items = _t(spark, sf, "lineitem")
    by_item = items.select(doc_id("-", F.col("l_orderkey").cast("string"), F.col("l_linenumber").cast("string")).alias("doc_id"))
    return logs_ids.unionByName(by_item)


@query("user_age")
def user_age(spark: SparkSession, sf: str) -> DataFrame:
    return bind.users(_t(spark, sf, "customer")).select("id", "birthday", age_at("birthday", AS_OF).alias("user_age"))


@query("user_latest")
def user_latest(spark: SparkSession, sf: str) -> DataFrame:
    return users.latest(bind.user_changes(_t(spark, sf, "customer")), "version")


# --- daily active devices ---------------------------------------------------------------------


def _halves(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Start-up logs from noon on, and those before noon as the seen set."""
    all_logs = _startup(spark, sf)
    return all_logs.filter(F.col("log_hour") >= "12"), all_logs.filter(F.col("log_hour") < "12")


@query("dau_unseen")
def dau_unseen(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.unseen(*_halves(spark, sf)).select("event_id", "mid", "log_date", "log_hour", "ts")


@query("dau_first")
def dau_first(spark: SparkSession, sf: str) -> DataFrame:
    return _dau(spark, sf).select("mid", "log_date", "log_hour", "ts", "event_id")


@query("dau_stage_counts")
def dau_stage_counts(spark: SparkSession, sf: str) -> DataFrame:
    return dedup.stage_counts(*_halves(spark, sf))


@query("dau_total")
def dau_total(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.dau_total(_dau(spark, sf, DATE), DATE)


@query("dau_hours")
def dau_hours(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.dau_hours(_dau(spark, sf, DATE), DATE)


@query("new_mid_total")
def new_mid_total(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.new_mid_total(_first_seen(spark, sf, FIRST_DATE), FIRST_DATE)


@query("new_mid_hours")
def new_mid_hours(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.new_mid_hours(_first_seen(spark, sf, FIRST_DATE), FIRST_DATE)


# --- order amount -----------------------------------------------------------------------------


@query("gmv_total")
def gmv_total(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.gmv_total(_timed_orders(spark, sf, DATE), DATE)


@query("gmv_hours")
def gmv_hours(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.gmv_hours(_timed_orders(spark, sf, DATE), DATE)


@query("hours_filled")
def hours_filled(spark: SparkSession, sf: str) -> DataFrame:
    days = (DATE, reports.day_before(DATE))
    hourly = metrics.dau_hours(_dau(spark, sf, *days), *days)
    return metrics.fill_hours(spark, hourly, "log_date", *days)


@query("sales_by_province")
def sales_by_province(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.sales_by_province(bind.province_orders(*_t(spark, sf, "orders", "customer")))


@query("realtime_total")
def realtime_total(spark: SparkSession, sf: str) -> DataFrame:
    dau, orders = _dau(spark, sf, FIRST_DATE), _timed_orders(spark, sf, FIRST_DATE)
    return reports.realtime_total(dau, _first_seen(spark, sf, FIRST_DATE), orders, FIRST_DATE)


@query("realtime_hours")
def realtime_hours(spark: SparkSession, sf: str) -> DataFrame:
    days = (DATE, reports.day_before(DATE))
    inputs = (_dau(spark, sf, *days), _first_seen(spark, sf, DATE), _timed_orders(spark, sf, *days))
    dau = reports.realtime_hours(spark, "dau", DATE, *inputs)
    return dau.unionByName(reports.realtime_hours(spark, "order_amount", DATE, *inputs))


# --- orders and items -------------------------------------------------------------------------

# The columns of the sale record.
SALE_COLUMNS = [
    "order_detail_id", "order_id", "order_status", "create_time", "user_id", "sku_id",
    "user_gender", "user_age", "user_level", "sku_price", "sku_name", "dt", "user_known",
]


@query("order_detail_join")
def order_detail_join(spark: SparkSession, sf: str) -> DataFrame:
    return sale_detail.join_orders(bind.orders(_t(spark, sf, "orders")), _details(spark, sf))


@query("order_detail_full_outer")
def order_detail_full_outer(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = _t(spark, sf, "orders", "lineitem")
    return sale_detail.join_status(bind.orders(orders), bind.details(lineitem, None))


@query("order_detail_interval_join")
def order_detail_interval_join(spark: SparkSession, sf: str) -> DataFrame:
    orders, lineitem = _t(spark, sf, "orders", "lineitem")
    left = bind.orders(orders, bind.order_arrival().alias("ingest_ts"))
    right = bind.details(lineitem, None, bind.detail_arrival().alias("ingest_ts"))
    return sale_detail.join_orders_within(left, right).select("order_id", "order_detail_id").distinct()


@query("sale_detail")
def sale_details(spark: SparkSession, sf: str) -> DataFrame:
    return _sales(spark, sf).select(*SALE_COLUMNS)


@query("keyword_match")
def keyword_match(spark: SparkSession, sf: str) -> DataFrame:
    part = _t(spark, sf, "part").select(bind.text("p_partkey").alias("sku_id"), F.col("p_name").alias("sku_name"))
    return part.filter(search.match_all("sku_name", KEYWORD))


@query("keyword_match_all")
def keyword_match_all(spark: SparkSession, sf: str) -> DataFrame:
    """Several tokens in any order, some of them Chinese, upper and lower case."""
    more = F.when(F.col("p_partkey") % 2 == 0, F.lit(" 红色 手机")).otherwise("")
    part = _t(spark, sf, "part").select(bind.text("p_partkey").alias("sku_id"), F.concat("p_name", more).alias("sku_name"))
    return part.filter(search.match_all("sku_name", "手机 BOLT 红色"))


def _described(spark: SparkSession, sf: str) -> DataFrame:
    """Products with descriptions of different lengths."""
    part = _t(spark, sf, "part")
    extra = F.when(F.col("p_partkey") % 3 == 0, " red plate").otherwise("")
    more = F.when(F.col("p_partkey") % 5 == 0, " for the old kitchen, red").otherwise("")
    return part.select(bind.text("p_partkey").alias("sku_id"), F.concat("p_name", extra, more).alias("sku_name"))


@query("keyword_relevance")
def keyword_relevance(spark: SparkSession, sf: str) -> DataFrame:
    return search.with_relevance(_described(spark, sf), "sku_name", "plate RED")


@query("keyword_index")
def keyword_index(spark: SparkSession, sf: str) -> DataFrame:
    described = _described(spark, sf)
    index = search.token_rows(described, "sku_id", "sku_name")
    return search.only_keys(described, search.keys_of_tokens(index, "red kitchen", "sku_id"), "sku_id")


@query("sale_detail_deep_page")
def sale_detail_deep_page(spark: SparkSession, sf: str) -> DataFrame:
    """A page from the middle of all items, found by counting."""
    items = bind.details(_t(spark, sf, "lineitem"), None).select("order_id", "id", "sku_id", "order_price")
    return search.page(items, 101, 200, ["order_id", "id"], deep=5000)


@query("gender_terms")
def gender_terms(spark: SparkSession, sf: str) -> DataFrame:
    return search.terms(_order_sales(spark, sf), "user_gender", 2, "sales")


@query("age_terms")
def age_terms(spark: SparkSession, sf: str) -> DataFrame:
    return search.terms(_order_sales(spark, sf), "user_age", 100, "sales")


@query("gender_share")
def gender_share(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.gender_share(_order_sales(spark, sf), "sales")


@query("age_share")
def age_share(spark: SparkSession, sf: str) -> DataFrame:
    return metrics.age_share(_order_sales(spark, sf), "sales")


@query("sale_detail_page")
def sale_detail_page(spark: SparkSession, sf: str) -> DataFrame:
    hits = search.search(_sales(spark, sf, SALE_DATE), SALE_DATE, KEYWORD)
    return search.page(hits, PAGE, PAGE_SIZE, ["order_id", "order_detail_id"]).select(*SALE_COLUMNS)


@query("sale_detail_report")
def sale_detail_report(spark: SparkSession, sf: str) -> DataFrame:
    sales, work_dir = _sales(spark, sf, SALE_DATE), new_run_dir(spark, "report")
    return reports.sale_detail_report(sales, SALE_DATE, KEYWORD, 1, 20, work_dir)


# --- alerts -----------------------------------------------------------------------------------


def _alert_rows(docs: DataFrame) -> DataFrame:
    joined = {name: F.array_join(name, ",") for name in ("uids", "item_ids", "events")}
    return docs.withColumns(joined).select("doc_id", "mid", "uids", "item_ids", "events", "ts", "dt")


@query("coupon_alert")
def coupon_alert(spark: SparkSession, sf: str) -> DataFrame:
    events = bind.event_logs(_t(spark, sf, "events"))
    return _alert_rows(alerts.coupon_alerts(events, **ALERT, tie="event_id"))


@query("coupon_alert_live")
def coupon_alert_live(spark: SparkSession, sf: str) -> DataFrame:
    """The windows of the live job: 5 minutes that slide by 5 seconds."""
    return _alert_rows(alerts.coupon_alerts(bind.dense_event_logs(_t(spark, sf, "events")), tie="event_id"))


@query("coupon_alert_parts")
def coupon_alert_parts(spark: SparkSession, sf: str) -> DataFrame:
    events = bind.event_logs(_t(spark, sf, "events"))
    parts = alerts.coupon_alert_parts(events, **ALERT, tie="event_id", most=2)
    return parts.withColumn("events", F.array_join("events", ","))


# --- streams ----------------------------------------------------------------------------------
# Each replays its tables through the job and reads back what the job stored.


def _with_event_id(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema, T.StructField("event_id", T.LongType())])


@query("dau_stream")
def dau_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "dau")
    rows = bind.startup_logs(tables.replay(spark, sf, "events", f"{run}/feed")).withColumn("timestamp", epoch_ms("ts"))
    messages = bind.json_messages(rows, "mid", "uid", "ts", "event_id")
    schema = _with_event_id(schemas.STARTUP_LOG)
    table = jobs.dau_table(f"{run}/table", schema, "event_id")
    jobs.run_to_end(spark, jobs.dau(messages, table, schema, "event_id"), f"{run}/checkpoint")
    return table.read(spark).select("mid", "log_date", "log_hour", "ts", "event_id")


@query("new_mid_stream")
def new_mid_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "new-mid")
    rows = bind.startup_logs(tables.replay(spark, sf, "events", f"{run}/feed")).withColumn("timestamp", epoch_ms("ts"))
    devices, days = jobs.device_table(f"{run}/devices", buckets=16), jobs.first_day_table(f"{run}/days")
    jobs.run_to_end(spark, jobs.first_seen(bind.json_messages(rows, "mid", "uid", "ts"), devices, days), f"{run}/checkpoint")
    return jobs.standing(days.read(spark)).select("mid", "ts", "log_date", "log_hour")


@query("coupon_alert_stream")
def coupon_alert_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "alerts")
    rows = bind.event_logs(tables.replay(spark, sf, "events", f"{run}/feed")).withColumn("timestamp", epoch_ms("ts"))
    messages = bind.json_messages(rows, "mid", "uid", "evid", "itemid", "ts", "event_id")
    panes, docs = jobs.pane_table(f"{run}/panes"), jobs.alert_table(f"{run}/docs")
    writer = jobs.coupon_alert_docs(messages, panes, docs, **ALERT, schema=_with_event_id(schemas.EVENT_LOG), tie="event_id")
    jobs.run_to_end(spark, writer, f"{run}/checkpoint")
    return _alert_rows(jobs.standing(docs.read(spark)))


def _order_messages(spark: SparkSession, sf: str, run: str) -> DataFrame:
    rows = bind.orders(tables.replay(spark, sf, "orders", f"{run}/order-feed"), bind.order_arrival().alias("timestamp"))
    return bind.json_messages(rows, "id", "user_id", "order_status", "total_amount", "create_time", "consignee_tel")


def _detail_messages(spark: SparkSession, sf: str, run: str) -> DataFrame:
    part = tables.read(spark, sf, "part")
    rows = bind.details(tables.replay(spark, sf, "lineitem", f"{run}/detail-feed"), part, bind.detail_arrival().alias("timestamp"))
    return bind.json_messages(rows, "id", "order_id", "sku_name", "sku_id", "order_price", "sku_num")


def _user_table(spark: SparkSession, changes: DataFrame, run: str) -> sinks.KeyedTable:
    # All versions arrive at the same time; only their place in the feed tells which came last.
    stamped = changes.withColumns({"timestamp": F.timestamp_seconds(F.lit(1)), "offset": F.col("version").cast("bigint")})
    messages = bind.json_messages(stamped, "id", "login_name", "user_level", "birthday", "gender")
    table = jobs.user_table(f"{run}/users", buckets=16)
    jobs.run_to_end(spark, jobs.users(messages, table), f"{run}/users-checkpoint")
    return table


@query("user_stream")
def user_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "users")
    changes = bind.user_changes(tables.replay(spark, sf, "customer", f"{run}/feed"))
    return _user_table(spark, changes, run).read(spark).drop("seen_at", "partition", "offset")


def _purchases(spark: SparkSession, sf: str, run: str) -> DataFrame:
    rows = bind.timed_orders(tables.replay(spark, sf, "events", f"{run}/feed"), F.col("ts").cast("timestamp").alias("timestamp"))
    return bind.json_messages(rows, "id", "user_id", "total_amount", "create_time", "consignee_tel")


@query("gmv_stream")
def gmv_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "gmv")
    table = jobs.order_table(f"{run}/table")
    jobs.run_to_end(spark, jobs.gmv(_purchases(spark, sf, run), table), f"{run}/checkpoint")
    return table.read(spark).select("id", "user_id", "total_amount", "create_date", "create_hour", "consignee_tel")


@query("gmv_hours_stream")
def gmv_hours_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Totals by hour kept by change; every fifth order is sent a second time with another amount."""
    run = new_run_dir(spark, "gmv-hours")
    sent = bind.timed_orders(tables.replay(spark, sf, "events", f"{run}/feed"), F.col("ts").cast("timestamp").alias("timestamp"))
    later = sent.filter(F.col("id").cast("bigint") % 5 == 0).withColumns({"total_amount": F.col("total_amount") * 2, "timestamp": F.expr("timestamp + INTERVAL 1 HOUR")})
    messages = bind.json_messages(sent.unionByName(later), "id", "user_id", "total_amount", "create_time", "consignee_tel")
    table, hours = jobs.order_table(f"{run}/table"), jobs.hour_table(f"{run}/hours")
    jobs.run_to_end(spark, jobs.gmv(messages, table, hours), f"{run}/checkpoint")
    return hours.read(spark).select("create_date", "hour", F.round("amount", 2).cast("double").alias("value"), "orders")


@query("sale_detail_stream")
def sale_detail_stream(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "sales")
    first_versions = bind.users(tables.replay(spark, sf, "customer", f"{run}/user-feed"), F.lit(1).alias("version"))
    known = _user_table(spark, first_versions, run)
    table = jobs.sale_table(f"{run}/table", partition_by_day=False)
    writer = jobs.sale_details(_order_messages(spark, sf, run), _detail_messages(spark, sf, run), known, table, AS_OF, side_width="6 hours")
    jobs.run_to_end(spark, writer, f"{run}/checkpoint")
    return table.read(spark).select("doc_id", *SALE_COLUMNS)


@query("document_stream")
def document_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Every event as a document; those with an odd number come without an id."""
    run = new_run_dir(spark, "documents")
    events = tables.replay(spark, sf, "events", f"{run}/feed")
    named = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("e"), bind.text("event_id")))
    rows = events.select(named.alias("doc_id"), "event_id", F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.col("ts").cast("timestamp").alias("timestamp"))
    table = jobs.document_table(f"{run}/table")
    jobs.run_to_end(spark, jobs.documents(bind.json_messages(rows, "doc_id", "event_id", "dt"), table), f"{run}/checkpoint")
    body = F.get_json_object("body", "$.event_id").cast("bigint")
    return table.read(spark).select(body.alias("event_id"), "dt", F.col("doc_id").startswith("auto-").alias("generated"))


@query("log_archive")
def log_archive(spark: SparkSession, sf: str) -> DataFrame:
    run = new_run_dir(spark, "archive")
    sent = bind.device_messages(tables.replay(spark, sf, "events", f"{run}/feed"))
    lines = logs.archive_rows(logs.route(sent, F.col("stamp")))
    jobs.run_to_end(spark, sinks.archive(lines, f"{run}/lines"), f"{run}/checkpoint")
    return spark.read.schema("value string, log_date string").text(f"{run}/lines").select("log_date", "value")


# --- text -------------------------------------------------------------------------------------


@query("word_count")
def word_count(spark: SparkSession, sf: str) -> DataFrame:
    return text_ops.word_count(bind.lines_of_text(*_t(spark, sf, "documents", "conversations")))


@query("fold_lengths")
def fold_lengths(spark: SparkSession, sf: str) -> DataFrame:
    folds = text_ops.fold_lengths(_t(spark, sf, "documents"), "source", "doc_id", "text", "0")
    return text_ops.join_folds(folds, "source", "0")


@query("observed_sum")
def observed_sum(spark: SparkSession, sf: str) -> DataFrame:
    doubled, seen = metrics.observed_sum(_t(spark, sf, "events").select("value"), "value")
    doubled.write.format("noop").mode("overwrite").save()
    return spark.range(1).select(F.lit(seen.get["total"]).cast("double").alias("total"))
