"""Database change feed: choose the topic of each change and flatten it to JSON rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shoptide import schemas

# Which changes of which table go to which topic.
ROUTES = {
    "order_info": (schemas.TOPIC_ORDER_INFO, ("INSERT",)),
    "order_detail": (schemas.TOPIC_ORDER_DETAIL, ("INSERT",)),
    "user_info": (schemas.TOPIC_USER_INFO, ("INSERT", "UPDATE")),
}


def route(envelopes: DataFrame, routes: dict[str, tuple[str, tuple[str, ...]]] = ROUTES) -> DataFrame:
    """Add ``topic``; drop changes no route wants and entries that carry no rows."""
    kept = envelopes
    if "entry_type" in envelopes.columns:
        kept = kept.filter(F.coalesce("entry_type", F.lit("ROWDATA")) == "ROWDATA")
    topic = F.lit(None).cast("string")
    for table, (name, kinds) in routes.items():
        wanted = (F.col("table") == table) & F.col("event_type").isin(*kinds)
        topic = F.when(wanted, F.lit(name)).otherwise(topic)
    return kept.withColumn("topic", topic).filter(F.col("topic").isNotNull())


def flatten(routed: DataFrame) -> DataFrame:
    """One (topic, value) message per changed row, the value being its after-image as JSON."""
    return routed.select("topic", F.explode("rows").alias("row")).select("topic", F.to_json("row").alias("value"))
