"""Device log intake: stamp, route by type, archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide import schemas
from shoptide.functions import epoch_ms


# White space of JSON, and a member "ts" with a plain value.
SPACE = " \t\n\r"
TS_NAME = r'"ts"\s*:'
TS_MEMBER = r'"ts"\s*:\s*(-?[0-9][0-9.eE+-]*|"[^"\\]*"|null|true|false)\s*,?\s*'
# Names that are escaped, and strings in single quotes, which the parser takes and JSON does not know.
ODD_TEXT = r"\\u|[,:{\[]\s*'"


def route(
    df: DataFrame,
    stamp: Column | None = None,
    value: str = "value",
    startup_topic: str = schemas.TOPIC_STARTUP,
    event_topic: str = schemas.TOPIC_EVENT,
) -> DataFrame:
    """(topic, value, ts, malformed): the log with its ``ts`` set and the topic it belongs to.

    ``ts`` replaces any sent by the device. A start-up log goes to one topic, every other one,
    also one without a type, to the other. Text that is no JSON object, or has something other than white space
    behind one, has ``malformed`` set and keeps its value, without a topic.
    """
    at = F.unix_millis(F.current_timestamp()) if stamp is None else stamp
    # The parser stops at the end of a value. An empty object behind it shows whether there is anything else.
    pair = F.expr(f"from_json('[' || {value} || ',{{}}]', 'array<map<string,variant>>')")
    parsed = df.select(F.trim(F.col(value), F.lit(SPACE)).alias("text"), F.col(value).alias("sent"), at.cast("bigint").alias("ts"), pair.alias("pair"))
    parsed = parsed.select("text", "sent", "ts", F.when((F.size("pair") == 2) & F.endswith("text", F.lit("}")), F.get("pair", F.lit(0))).alias("m"))
    # The text is kept as it was sent, numbers and all. Only a log whose "ts" is not plain to see is written anew from
    # its parsed fields, where 1.50 becomes 1.5.
    named = F.regexp_count("text", F.lit(TS_NAME))
    seen = F.when(F.expr("map_contains_key(m, 'ts')"), (named == 1) & F.col("text").rlike(TS_MEMBER)).otherwise(named == 0)
    others = F.when(seen & ~F.col("text").rlike(ODD_TEXT), F.regexp_replace("text", TS_MEMBER, "")).otherwise(F.to_json(F.expr("map_filter(m, (k, v) -> k <> 'ts')")))
    # Without the last brace and a comma that is left over; an object without members gets no comma.
    members = F.regexp_replace(F.concat(F.regexp_replace(others, r"\s*,?\s*\}$", ""), F.lit(",")), r"^\{\s*,$", "{")
    stamped = F.concat(members, F.lit('"ts":'), F.col("ts").cast("string"), F.lit("}"))
    kind = F.expr("try_variant_get(element_at(m, 'type'), '$', 'string')")
    topic = F.when(kind.eqNullSafe(F.lit("startup")), F.lit(startup_topic)).otherwise(F.lit(event_topic))
    bad = F.col("m").isNull()
    return parsed.select(F.when(~bad, topic).alias("topic"), F.when(bad, F.col("sent")).otherwise(stamped).alias("value"), "ts", bad.alias("malformed"))


def archive_rows(routed: DataFrame) -> DataFrame:
    """(value, log_date): the raw line and the day whose file it belongs to."""
    day = F.date_format(epoch_ms("ts"), "yyyy-MM-dd")
    return routed.filter(~F.col("malformed")).select("value", day.alias("log_date"))
