"""The three reports of the query layer, as tidy rows."""

from __future__ import annotations

from datetime import date as Date
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.functions import percent
from shoptide.operators import metrics, search
from shoptide.streaming.sinks import staged

# Ids and names of the totals.
TOTALS = {"dau": "新增日活", "new_mid": "新增设备", "order_amount": "新增交易额"}


def day_before(date: str) -> str:
    return (Date.fromisoformat(date) - timedelta(days=1)).isoformat()


def realtime_total(dau: DataFrame, first: DataFrame, orders: DataFrame, date: str) -> DataFrame:
    """(id, name, value): active devices, new devices and order amount of a day. ``first`` has each device's first log ever."""
    parts = {
        "dau": metrics.dau_total(dau, date),
        "new_mid": metrics.new_mid_total(first, date),
        "order_amount": metrics.gmv_total(orders, date),
    }
    rows = [
        part.select(F.lit(key).alias("id"), F.lit(TOTALS[key]).alias("name"), F.col("value").cast("double").alias("value"))
        for key, part in parts.items()
    ]
    return rows[0].unionByName(rows[1]).unionByName(rows[2])


def realtime_hours(spark: SparkSession, metric: str, date: str, dau: DataFrame, first: DataFrame, orders: DataFrame) -> DataFrame:
    """(id, label, hour, value) for ``date`` (today) and the day before (yesterday).

    Hours without data have no row. A metric that does not exist gives one row per label with a
    null hour and value. Both days come from one scan.
    """
    days = (date, day_before(date))
    if metric == "dau":
        hourly, day = metrics.dau_hours(dau, *days), "log_date"
    elif metric == "new_mid":
        hourly, day = metrics.new_mid_hours(first, *days), "log_date"
    elif metric == "order_amount":
        hourly, day = metrics.gmv_hours(orders, *days), "create_date"
    else:
        labels = F.explode(F.array(F.lit("today"), F.lit("yesterday")))
        blank = [F.lit(None).cast("string").alias("hour"), F.lit(None).cast("double").alias("value")]
        return spark.range(1).select(F.lit(metric).alias("id"), labels.alias("label"), *blank)
    return hours_of_days(metric, hourly, day, date)


def hours_of_days(metric: str, hourly: DataFrame, day: str, date: str) -> DataFrame:
    """(id, label, hour, value) of hourly values (day, hour, value)."""
    label = F.when(F.col(day) == date, "today").otherwise("yesterday")
    return hourly.select(F.lit(metric).alias("id"), label.alias("label"), "hour", F.col("value").cast("double").alias("value"))


def sale_detail_report(
    sales: DataFrame, date: str, keyword: str, page: int, size: int, work_dir: str | None = None, index: DataFrame | None = None, by_relevance: bool = False
) -> DataFrame:
    """(section, title, name, value, detail): total, age and gender shares, one page of rows.

    All numbers come from one aggregate over the matches, the page from a second read of them.
    Give ``work_dir``, a new folder, when ``sales`` is a join and not a stored table: the matches
    are then written there once, and read twice. ``index`` (dt, token, doc_id) finds the matches without reading the names
    of all rows. With ``by_relevance`` rows come in the order of their score over the day's names, best first.
    """
    if by_relevance:
        hits = search.with_relevance(sales.filter(F.col("dt") == date), "sku_name", keyword)
    elif index is not None:
        hits = search.only_keys(sales.filter(F.col("dt") == date), search.keys_of_tokens(index.filter(F.col("dt") == date), keyword, "doc_id"), "doc_id")
    else:
        hits = search.search(sales, date, keyword)
    if work_dir:
        hits = staged(hits, work_dir)
    counts = metrics.share_counts(hits)

    def entry(section: str, title: str | None, name: str, value) -> object:
        return F.struct(
            F.lit(section).alias("section"),
            F.lit(title).cast("string").alias("title"),
            F.lit(name).alias("name"),
            value.cast("double").alias("value"),
        )

    numbers = [entry("total", None, "total", F.col("total"))]
    for title, options in ((metrics.AGE_TITLE, metrics.AGE_OPTIONS), (metrics.GENDER_TITLE, metrics.GENDER_OPTIONS)):
        numbers += [entry("stat", title, label, percent(F.col(c), F.col("total"))) for c, label in options.items()]
    stats = counts.select(F.inline(F.array(*numbers))).withColumn("detail", F.lit(None).cast("string"))

    shown = ["order_detail_id", "order_id", "user_id", "user_gender", "user_age", "user_level", "sku_id", "sku_name", "dt"]
    rows = search.page(hits, page, size, [*(["-score"] if by_relevance else []), "order_id", "order_detail_id"]).select(
        F.lit("detail").alias("section"),
        F.lit(None).cast("string").alias("title"),
        F.concat_ws("-", "order_id", "order_detail_id").alias("name"),
        F.col("sku_price").alias("value"),
        F.to_json(F.struct(*shown)).alias("detail"),
    )
    return stats.unionByName(rows)
