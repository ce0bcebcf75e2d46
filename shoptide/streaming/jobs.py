"""The streaming jobs. Each takes message streams (``value`` and arrival ``timestamp``) and gives a
writer that is ready to start; the caller picks trigger and checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from shoptide import schemas
from shoptide.functions import mask_phone, with_log_time, with_order_time
from shoptide.operators import alerts, dedup, metrics, sale_detail, search
from shoptide.operators.keyed import first_per_key, near_keys
from shoptide.session import ROCKSDB_PROVIDER, adaptive
from shoptide.sources import decode
from shoptide.sources.decode import decoded
from shoptide.sources.tables import upper_columns
from shoptide.streaming import sinks
from shoptide.streaming.sinks import KeyedTable

BATCH_INTERVAL = "5 seconds"


def _string_fields(schema: T.StructType, *names: str) -> T.StructType:
    return T.StructType([*schema, *[T.StructField(n, T.StringType()) for n in names]])


def _upper(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name.upper(), f.dataType) for f in schema])


def startup_rows(messages: DataFrame, schema: T.StructType = schemas.STARTUP_LOG) -> DataFrame:
    return with_log_time(decoded(decode.decode(messages, schema)))


def order_rows(messages: DataFrame, *keep: str) -> DataFrame:
    """Typed orders with date, hour and masked phone number."""
    typed = decode.decode(messages, schemas.ORDER_INFO, keep=keep, patterns=schemas.ORDER_INFO_PATTERNS)
    rows = with_order_time(decoded(typed))
    return rows.withColumn("consignee_tel", mask_phone("consignee_tel"))


# Where a message stood: arrival time, partition and offset in it. For lines of files (with ``block``, the place of the
# file's part that is read) the offset is counted when a micro-batch is written.
POSITION = [T.StructField("seen_at", T.TimestampType()), T.StructField("partition", T.IntegerType()), T.StructField("offset", T.LongType())]


BLOCK = T.StructField("block", T.LongType())
PLACE = [*[f.name for f in POSITION], BLOCK.name]


def numbered(batch: DataFrame) -> DataFrame:
    """A micro-batch whose lines of files have an offset: rows of a task follow each other as in the file."""
    line = F.col("block") + F.monotonically_increasing_id() % (1 << 33)
    return batch.withColumn("offset", F.coalesce("offset", line))


def with_position(messages: DataFrame) -> DataFrame:
    named = messages.withColumnRenamed("timestamp", "seen_at")
    for field in [*POSITION[1:], BLOCK]:
        if field.name not in named.columns:
            named = named.withColumn(field.name, F.lit(None).cast(field.dataType))
    return named


def _last_sent() -> list[Column]:
    """Best first. A key keeps to its partition, where offsets rise; between partitions the arrival decides."""
    return [F.col(c).desc_nulls_last() for c in ("seen_at", "offset", "partition")]


# --- daily active devices -------------------------------------------------------------------


def dau_table(path: str, schema: T.StructType = schemas.STARTUP_LOG, tie: str | None = None, writer: str = "main") -> KeyedTable:
    columns = _upper(_string_fields(schema, "log_date", "log_hour"))
    order = [F.col("TS").asc()] + ([F.col(tie.upper()).asc()] if tie else [])
    return KeyedTable(path, columns, ["MID", "LOG_DATE"], "LOG_DATE", order, writer)


def dau(messages: DataFrame, table: KeyedTable, schema: T.StructType = schemas.STARTUP_LOG, tie: str | None = None) -> DataStreamWriter:
    """Each batch adds, of its first logs per device and day, those that the table does not have or has a later one of.

    The table is the seen set: of the batch's days its keys are read, and a device that starts up a hundred times is
    stored once. There is no state and no lateness: a log that comes days late, or has no ``ts``, still counts.
    """
    attempts = sinks.Attempts(table)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            attempts.clear(spark, batch_id)
            came = sinks.staged(dedup.first_per_day(batch, tie), f"{table.path}-staging/{table.writer}")
            days = [r.log_date for r in came.select("log_date").distinct().collect()]
            stored = table.versions(spark, folders=days, before=batch_id)
            stored = stored.select(*[F.col(c.upper()).alias(c) for c in ("mid", "log_date", "ts", *([tie] if tie else []))])
            table.add(upper_columns(dedup.unseen_or_earlier(came, stored, tie)), batch_id)

    return timed_logs(messages, schema).writeStream.foreachBatch(add).outputMode("append")


def timed_logs(messages: DataFrame, schema: T.StructType = schemas.STARTUP_LOG) -> DataFrame:
    """Start-up logs with date and hour; one without ``ts`` is of time 0."""
    return with_log_time(startup_rows(messages, schema).withColumn("ts", F.coalesce("ts", F.lit(0).cast("bigint"))))


# --- new devices ------------------------------------------------------------------------------

FIRST_SEEN = T.StructType().add("mid", T.StringType()).add("ts", T.LongType()).add("log_date", T.StringType()).add("log_hour", T.StringType())
KEY_BUCKETS = 64


def device_table(path: str, writer: str = "main", buckets: int = KEY_BUCKETS) -> KeyedTable:
    """The first log ever of each device, in a folder per hash of the device."""
    return KeyedTable(path, FIRST_SEEN, ["mid"], None, [F.col("ts").asc()], writer, buckets=buckets)


def first_day_table(path: str, writer: str = "main") -> KeyedTable:
    """The same in a folder per day; ``withdrawn`` marks devices of which an earlier log has come since."""
    return KeyedTable(path, T.StructType([*FIRST_SEEN]).add("withdrawn", T.BooleanType()), ["mid"], "log_date", [], writer)


def first_seen(messages: DataFrame, devices: KeyedTable, days: KeyedTable, schema: T.StructType = schemas.STARTUP_LOG) -> DataStreamWriter:
    """Keep the first log ever of each device, so that the new devices of a day are read from its folder alone.

    A batch looks up its devices in their buckets only and writes those that are new or were first seen later than
    now known; of the latter the row of the later day is withdrawn. A log may come late by any time.
    """
    attempts = sinks.Attempts(devices, days)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            attempts.clear(spark, batch_id)
            came = sinks.staged(metrics.first_seen(batch), f"{days.path}-staging/{days.writer}")
            known = devices.read(spark, only=came, before=batch_id).select("mid", F.struct("ts", "log_date", "log_hour").alias("known"))
            earlier = came.join(known, "mid", "left").filter(F.col("known").isNull() | (F.col("ts") < F.col("known.ts")))
            earlier = sinks.staged(earlier, f"{days.path}-staging/{days.writer}-earlier")
            devices.add(earlier, batch_id)
            moved = earlier.filter(F.col("known.log_date") != F.col("log_date")).select("mid", "known.*", F.lit(True).alias("withdrawn"))
            days.add(earlier.select(*FIRST_SEEN.fieldNames(), F.lit(False).alias("withdrawn")).unionByName(moved), batch_id)

    return timed_logs(messages, schema).filter("mid IS NOT NULL").writeStream.foreachBatch(add).outputMode("append")


# --- order amount ---------------------------------------------------------------------------


def order_table(path: str, writer: str = "main") -> KeyedTable:
    columns = _upper(T.StructType([*_string_fields(schemas.ORDER_INFO, "create_date", "create_hour"), *POSITION]))
    order = [F.col(c).desc_nulls_last() for c in ("SEEN_AT", "OFFSET", "PARTITION", *[f.name.upper() for f in schemas.ORDER_INFO])]
    return KeyedTable(path, columns, ["ID"], "CREATE_DATE", order, writer)


def hour_table(path: str, writer: str = "main") -> KeyedTable:
    """Order amount and number of orders by hour, a folder per day."""
    columns = T.StructType().add("create_date", T.StringType()).add("hour", T.StringType()).add("amount", T.DecimalType(38, 10)).add("orders", T.LongType())
    return KeyedTable(path, columns, ["create_date", "hour"], "create_date", [], writer)


def gmv(messages: DataFrame, table: KeyedTable, hours: KeyedTable | None = None) -> DataStreamWriter:
    """Store orders, the last message of each; with ``hours`` also keep the totals by hour.

    Totals are kept by change: what an order that a batch brings stood for before is taken out and what it stands
    for now put in, so an order that is sent again, or is changed by a message read late, counts once. A batch that is run
    again compares with the tables as they were before it.
    """
    attempts = sinks.Attempts(table, *([hours] if hours else []))

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            attempts.clear(spark, batch_id)
            came = upper_columns(numbered(batch))
            if hours is None:
                table.add(came, batch_id)
                return
            work = f"{hours.path}-staging/{hours.writer}"
            came = sinks.staged(came, f"{work}/came")
            days = [r[0] for r in came.select("CREATE_DATE").distinct().collect()]
            before = sinks.staged(table.read(spark, only=came, folders=days, before=batch_id), f"{work}/before")
            table.add(came, batch_id)
            after = table.read(spark, only=came, folders=days, before=batch_id + 1)
            change = metrics.hour_change(after, 1).unionByName(metrics.hour_change(before, -1))
            stood = hours.read(spark, folders=days, before=batch_id)
            hours.add(metrics.changed_hours(stood, change), batch_id)

    return order_rows(with_position(messages), *PLACE).writeStream.foreachBatch(add).outputMode("append")


# --- coupon alerts --------------------------------------------------------------------------

def _structs(**fields: T.DataType) -> T.ArrayType:
    return T.ArrayType(T.StructType([T.StructField(n, t) for n, t in fields.items()]))


PANE_SCHEMA = (
    T.StructType()
    .add("mid", T.StringType())
    .add("pane", T.LongType())
    .add("uids", _structs(uid=T.StringType()))
    .add("items", _structs(itemid=T.StringType()))
    .add("clicked", T.BooleanType())
    .add("log", _structs(ts=T.LongType(), tie=T.LongType(), evid=T.StringType()))
    .add("dt", T.StringType())
    .add("part", T.StringType())
)


def pane_table(path: str, writer: str = "main") -> KeyedTable:
    """Rows of panes; a pane has a row of each batch that brought something for it, so no batch replaces another's."""
    return KeyedTable(path, PANE_SCHEMA, ["mid", "pane", "part"], "dt", [], writer)


def coupon_panes(
    messages: DataFrame,
    table: KeyedTable,
    slide_ms: int = 5_000,
    schema: T.StructType = schemas.EVENT_LOG,
    tie: str | None = None,
) -> DataStreamWriter:
    """Each batch adds its share of the panes. Read the alerts with ``alerts.pane_alerts(table.read(spark), ...)``."""

    def add(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            rows = alerts.pane_rows(batch, slide_ms, tie)
            table.add(rows.withColumn("part", F.lit(f"{table.writer}:{batch_id}")), batch_id)

    return decoded(decode.decode(messages, schema)).writeStream.foreachBatch(add).outputMode("append")


def alert_table(path: str, writer: str = "main") -> KeyedTable:
    """Alert documents, one per device and minute; ``withdrawn`` marks those that a later event has undone."""
    columns = T.StructType([T.StructField("doc_id", T.StringType()), *schemas.COUPON_ALERT]).add("dt", T.StringType()).add("withdrawn", T.BooleanType())
    return KeyedTable(path, columns, ["doc_id"], "dt", [], writer)


def standing(docs: DataFrame) -> DataFrame:
    return docs.filter(~F.col("withdrawn")).drop("withdrawn")


def coupon_alert_docs(
    messages: DataFrame,
    panes: KeyedTable,
    docs: KeyedTable,
    size_ms: int = 300_000,
    slide_ms: int = 5_000,
    accounts: int = 3,
    schema: T.StructType = schemas.EVENT_LOG,
    tie: str | None = None,
) -> DataStreamWriter:
    """Store the panes, and the alert documents of the minutes that a batch touches.

    The windows over those minutes are decided again from the stored panes near them, which are read of the batch's days and
    their neighbours only; windows are at most a day long. What has changed is compared with the documents as they stood
    before the batch, and a document that no longer stands is marked as withdrawn. A batch that is run again stores the same.
    """
    attempts = sinks.Attempts(panes, docs)

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        work = f"{docs.path}-staging/{docs.writer}"
        with adaptive(spark):
            attempts.clear(spark, batch_id)
            rows = alerts.pane_rows(batch, slide_ms, tie).withColumn("part", F.lit(f"{panes.writer}:{batch_id}"))
            rows = sinks.staged(rows, f"{work}/came")
            panes.add(rows, batch_id)
            came = rows.select("mid", "pane").distinct()
            near_days = F.transform(F.array(F.lit(-1), F.lit(0), F.lit(1)), lambda d: F.date_add(F.col("dt").cast("date"), d).cast("string"))
            days = [r.dt for r in rows.select(F.explode(near_days).alias("dt")).distinct().collect()]
            touched = alerts.touched_minutes(came, size_ms, slide_ms)
            near = sinks.staged(alerts.near_panes(panes.read(spark, folders=days), came, size_ms), f"{work}/near")
            now = sinks.staged(alerts.pane_alerts(near, size_ms, slide_ms, accounts, touched), f"{work}/now")
            minute = F.unix_millis(F.date_trunc("minute", F.timestamp_millis("ts")))
            before = standing(docs.read(spark, folders=days, before=batch_id)).withColumn("minute", minute).join(touched, ["mid", "minute"], "left_semi")
            before = before.select(*now.columns)
            gone = before.join(now.select("doc_id"), "doc_id", "left_anti").withColumn("withdrawn", F.lit(True))
            same = before.select("doc_id", F.struct(*now.columns).alias("known"))
            new = now.join(same, "doc_id", "left").filter(~F.col("known").eqNullSafe(F.struct(*[now[c] for c in now.columns])))
            docs.add(new.select(*now.columns, F.lit(False).alias("withdrawn")).unionByName(gone), batch_id)

    return decoded(decode.decode(messages, schema)).writeStream.foreachBatch(add).outputMode("append")


# --- users ----------------------------------------------------------------------------------


def user_table(path: str, writer: str = "main", buckets: int = KEY_BUCKETS) -> KeyedTable:
    """The last message of each user, in a folder per hash of the id, so that the buyers of a batch are looked up in theirs only."""
    columns = T.StructType([*schemas.USER_INFO, *POSITION])
    return KeyedTable(path, columns, ["id"], None, _last_sent() + [F.col(f.name).desc_nulls_last() for f in schemas.USER_INFO], writer, buckets=buckets)


def users(messages: DataFrame, table: KeyedTable) -> DataStreamWriter:
    """Keep the last message of each user, by arrival and then by place in the feed; there is no expiry."""
    placed = with_position(messages)
    rows = decoded(decode.decode(placed, schemas.USER_INFO, keep=tuple(PLACE)))
    return rows.writeStream.foreachBatch(lambda batch, batch_id: table.add(numbered(batch), batch_id)).outputMode("append")


# --- sale detail ----------------------------------------------------------------------------


def sale_table(path: str, writer: str = "main", partition_by_day: bool = True) -> KeyedTable:
    columns = T.StructType([*_string_fields(schemas.SALE_DETAIL, "doc_id"), T.StructField("user_known", T.BooleanType())])
    # A sale with its user beats one without; repeats of an item are settled by its values.
    order = [F.col("user_known").desc(), *[F.col(c).asc_nulls_first() for c in sale_detail.REPEAT_ORDER]]
    if partition_by_day:
        return KeyedTable(path, columns, ["doc_id"], "dt", order, writer)
    return KeyedTable(path, columns, ["doc_id"], None, order, writer, cluster_by="dt")


TOKEN_ROW = T.StructType().add("token", T.StringType()).add("doc_id", T.StringType()).add("dt", T.StringType())


def token_table(path: str, writer: str = "main", partition_by_day: bool = True) -> KeyedTable:
    """Which sale rows have a token in their product name, by day and sorted by token, so that a search reads of a day
    what its tokens need."""
    return KeyedTable(path, TOKEN_ROW, ["token", "doc_id"], "dt" if partition_by_day else None, [], writer, cluster_by="token")


SIDE_WIDTH = "1 hour"


def side_table(table: KeyedTable, side: str, rows: DataFrame) -> KeyedTable:
    """Every row of one side of the join, beside the sale table, in a folder per stretch of arrival."""
    return KeyedTable(f"{table.path}-{side}", rows.schema, ["order_id"], "slot", writer=table.writer)


def sale_details(
    order_messages: DataFrame,
    detail_messages: DataFrame,
    users_from: KeyedTable,
    table: KeyedTable,
    as_of: str | Column | None = None,
    tolerance: str = "120 seconds",
    side_width: str = SIDE_WIDTH,
    index: KeyedTable | None = None,
) -> DataStreamWriter:
    """Join orders and items that arrive within ``tolerance`` of each other, add the user as known
    when the batch runs, and upsert by ``{order_id}-{order_detail_id}``.

    Both sides are stored in folders by arrival, and each batch is matched with what is stored of the other side in the
    folders within reach of its rows: what is listed and read does not grow with history, and a row that is read days late
    opens the folders of its own time only. There is no state and no lateness. ``index`` also stores the
    tokens of the product names.
    """
    orders = order_rows(order_messages, "timestamp")
    details = decoded(decode.decode(detail_messages, schemas.ORDER_DETAIL, keep=("timestamp",)))
    matchable = "order_id IS NOT NULL AND seen IS NOT NULL"
    width, reach = sale_detail.seconds(side_width), F.expr(f"INTERVAL {sale_detail.seconds(tolerance)} SECONDS")
    slot = sale_detail.arrival_bucket(F.col("seen"), width).alias("slot")
    placed = sale_detail.order_side(orders, F.col("timestamp").alias("seen")).filter(matchable).select("*", slot)
    items = sale_detail.detail_side(details, F.col("timestamp").alias("seen")).filter(matchable).select("*", slot)
    sides = {"orders": (placed, side_table(table, "orders", placed)), "items": (items, side_table(table, "items", items))}
    packed = [rows.select(F.struct(*rows.columns).alias(side)) for side, (rows, _) in sides.items()]
    attempts = sinks.Attempts(table, *[kept for _, kept in sides.values()], *([index] if index else []))
    work = f"{table.path}-staging/{table.writer}"

    def near(side: str, came: DataFrame, batch_id: int) -> DataFrame:
        """Rows of a side stored before the batch that may match a row that came, by arrival and order."""
        rows, kept = sides[side]
        first, last = (sale_detail.arrival_bucket(t, width) for t in (F.col("seen") - reach, F.col("seen") + reach))
        slots = sorted(r.slot for r in came.select(F.explode(F.sequence(first, last)).alias("slot")).distinct().collect())
        return near_keys(kept.versions(came.sparkSession, folders=slots, before=batch_id).select(*rows.columns), came, ["order_id"])

    def add(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        with adaptive(spark):
            attempts.clear(spark, batch_id)
            came = {}
            # Both sides in one go: the batch would be read and decoded anew for each.
            both = sinks.staged(batch, f"{work}/came")
            for side, (_, kept) in sides.items():
                came[side] = both.filter(F.col(side).isNotNull()).select(f"{side}.*")
                kept.add(came[side], batch_id)
            # What came on one side meets all of the other, and what had been there before meets what came.
            of_orders = came["items"].unionByName(near("items", came["orders"], batch_id))
            found = sale_detail.match_within(came["orders"].drop("slot"), of_orders.drop("slot"), tolerance)
            found = found.unionByName(sale_detail.match_within(near("orders", came["items"], batch_id).drop("slot"), came["items"].drop("slot"), tolerance))
            sales = sinks.staged(found, f"{work}/sales")
            known = users_from.read(spark, only=sales.select(F.col("user_id").alias("id")))
            rows = sale_detail.enrich_user(sales, known, F.current_timestamp() if as_of is None else as_of)
            table.add(sale_detail.with_doc_id(rows), batch_id)
            if index:
                index.add(search.token_rows(sale_detail.with_doc_id(sales), "doc_id", "sku_name", "dt").distinct(), batch_id)

    return packed[0].unionByName(packed[1], allowMissingColumns=True).writeStream.foreachBatch(add).outputMode("append")


# --- documents ------------------------------------------------------------------------------


def document_table(path: str, writer: str = "main") -> KeyedTable:
    columns = T.StructType().add("doc_id", T.StringType()).add("body", T.StringType()).add("dt", T.StringType())
    return KeyedTable(path, columns, ["doc_id"], "dt", [], writer)


def documents(messages: DataFrame, table: KeyedTable) -> DataStreamWriter:
    """Bulk upsert of JSON documents by their ``doc_id``, in folders of their ``dt`` or of the day they arrived.

    A document without an id gets one from its text and its place in the feed, so that it has the same when a
    batch is run again, and two equal ones stay two. Of documents with one id in a batch the last by place counts. Text that
    is no JSON object is left out.
    """
    attempts = sinks.Attempts(table)

    def add(batch: DataFrame, batch_id: int) -> None:
        with adaptive(batch.sparkSession):
            attempts.clear(batch.sparkSession, batch_id)
            place = F.concat_ws("/", F.col("seen_at").cast("string"), F.col("partition").cast("string"), F.col("offset").cast("string"), "value")
            placed = numbered(batch).withColumn("place", F.sha1(place))
            # Equal documents of a feed that does not tell places are counted.
            copy = F.row_number().over(Window.partitionBy("place").orderBy("place")).cast("string")
            named = placed.withColumn("doc_id", F.coalesce(F.get_json_object("value", "$.doc_id"), F.concat_ws("-", F.lit("auto"), "place", copy)))
            day = F.coalesce(F.get_json_object("value", "$.dt"), F.date_format("seen_at", "yyyy-MM-dd"))
            rows = first_per_key(named.withColumn("dt", day), ["doc_id", "dt"], _last_sent())
            table.add(rows.select("doc_id", F.col("value").alias("body"), "dt"), batch_id)

    rows = with_position(messages).filter(F.expr("json_object_keys(value) IS NOT NULL"))
    return rows.select("value", *PLACE).writeStream.foreachBatch(add).outputMode("append")


# --- malformed messages ---------------------------------------------------------------------


def quarantine(messages: DataFrame, schema: T.StructType, path: str) -> DataStreamWriter:
    """Messages the jobs leave out, as text in ``path``."""
    patterns = schemas.ORDER_INFO_PATTERNS if schema == schemas.ORDER_INFO else None
    return aside(decode.quarantine(decode.decode(messages, schema, patterns=patterns)), path)


def aside(raw: DataFrame, path: str) -> DataStreamWriter:
    """Raw messages (raw) as lines of text; a message without any text is an empty line."""
    return raw.select(F.coalesce("raw", F.lit("")).alias("value")).writeStream.format("text").option("path", path)


# --- running --------------------------------------------------------------------------------


def start(writer: DataStreamWriter, checkpoint: str, name: str | None = None, interval: str = BATCH_INTERVAL) -> StreamingQuery:
    """Run until stopped."""
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(processingTime=interval).start()


def run_to_end(spark: SparkSession, writer: DataStreamWriter, checkpoint: str) -> None:
    """Process what is there now and stop."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, ROCKSDB_PROVIDER)
    try:
        writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    finally:
        spark.conf.set(key, before)
