"""Daily active devices: the first start-up log of each device and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide.operators.keyed import first_per_key, near_keys

DEVICE_DAY = ["mid", "log_date"]


def unseen(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """Logs whose (mid, log_date) is not in the seen set."""
    return logs.join(seen.select(*DEVICE_DAY).distinct(), DEVICE_DAY, "left_anti")


def unseen_or_earlier(logs: DataFrame, seen: DataFrame, tie: str | None = None) -> DataFrame:
    """Logs, one per (mid, log_date), that the seen ones (mid, log_date, ts) have none of, or only later ones."""
    place = F.struct("ts", *([tie] if tie else []))
    first = near_keys(seen, logs, DEVICE_DAY).groupBy(*DEVICE_DAY).agg(F.min(place).alias("_seen"))
    return logs.join(first, DEVICE_DAY, "left").filter(F.col("_seen").isNull() | (place < F.col("_seen"))).select(*logs.columns)


def first_per_day(logs: DataFrame, tie: str | None = None) -> DataFrame:
    """The log with the smallest ``ts`` for each (mid, log_date)."""
    order = [F.col("ts").asc()] + ([F.col(tie).asc()] if tie else [])
    return first_per_key(logs, DEVICE_DAY, order)


def stage_counts(logs: DataFrame, seen: DataFrame) -> DataFrame:
    """Rows before de-duplication, after the seen-set filter and after first-per-day.

    Logs are counted per key before the join, so each stage comes from one pass over the logs.
    """
    per_key = logs.groupBy(*DEVICE_DAY).agg(F.count("*").alias("n"))
    marked = per_key.join(seen.select(*DEVICE_DAY).distinct().withColumn("seen", F.lit(True)), DEVICE_DAY, "left")
    is_new = F.col("seen").isNull()
    totals = marked.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("input"),
        F.coalesce(F.sum(F.when(is_new, F.col("n"))), F.lit(0)).alias("after_unseen"),
        F.count(F.when(is_new, 1)).alias("after_first"),
    )
    return totals.unpivot([], ["input", "after_unseen", "after_first"], "stage", "n")
