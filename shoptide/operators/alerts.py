"""Coupon alert: in a sliding window, one device took coupons under several accounts and no item
was clicked on it. One alert per device and minute, the last window that ends in the minute.

Event input: ``mid, uid, itemid, evid, ts`` (epoch milliseconds) and, if wanted, a column that
settles the order of events with equal ``ts``.

A window of 5 minutes that slides by 5 seconds puts every event into 60 windows. So the windows
are decided by a sweep over a small set of facts (distinct accounts and clicks per pane, a pane being
one slide): each fact counts up when windows begin to hold it and down when they cease to. Whole
events are touched only for the windows that raise an alert.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shoptide.functions import doc_id, minute_of
from shoptide.operators.keyed import near_keys

# Event types.
COUPON = "coupon"
CLICK = "clickItem"

MS_PER_MINUTE = 60_000


def _floor_to(ms: Column, width: int) -> Column:
    return ms - F.pmod(ms, F.lit(width))


def _block(ms: Column, width: int) -> Column:
    """Number of the stretch of ``width`` a time lies in."""
    return F.call_function("div", _floor_to(ms, width), F.lit(width).cast("bigint"))


def _check(size_ms: int, slide_ms: int) -> None:
    if slide_ms <= 0 or size_ms % slide_ms:
        raise ValueError("the window length must be a multiple of the slide")


def event_facts(events: DataFrame, slide_ms: int) -> DataFrame:
    """(mid, pane, clicked, uid): which accounts took coupons, and where clicks were."""
    clicked = F.col("evid") == CLICK
    return (
        events.filter(F.col("evid").isin(COUPON, CLICK))
        .select(
            "mid",
            _floor_to(F.col("ts"), slide_ms).alias("pane"),
            clicked.alias("clicked"),
            F.when(~clicked, F.col("uid")).alias("uid"),
        )
    )


# A sweep goes over stretches of so many window lengths, each on its own.
SWEEP_SIZES = 12


def _changes(facts: DataFrame, keys: list[str], size_ms: int, slide_ms: int, *counts: Column) -> DataFrame:
    """(mid, stretch, at, accounts, clicks): at the window end ``at`` the number of accounts or clicks in the window changes.

    A fact in ``pane`` is in the windows that end from ``pane + slide`` to ``pane + size``. Up to the next fact with the same
    ``keys`` the fact counts itself, from there on that one does, so a stay of any length is a chain of spans
    without overlap. Spans are cut where a stretch ends.
    """
    following = F.lead("pane").over(Window.partitionBy(*keys).orderBy("pane"))
    end = F.least(F.col("pane") + size_ms, F.coalesce(following, F.col("pane") + size_ms)) + slide_ms
    spans = facts.select(*keys, "pane").distinct().select("mid", (F.col("pane") + slide_ms).alias("start"), end.alias("end"))
    width = SWEEP_SIZES * size_ms
    touched = F.array_distinct(F.array(_block(F.col("start"), width), _block(F.col("end") - 1, width)))
    spans = spans.select("mid", "start", "end", F.explode(touched).alias("stretch"))
    first, after = F.col("stretch") * width, (F.col("stretch") + 1) * width
    change = lambda at, sign: F.struct(at.alias("at"), *[(c * sign).alias(n) for c, n in zip(counts, ("accounts", "clicks"), strict=True)])
    ends = F.when(F.col("end") < after, change(F.col("end"), -1))
    both = F.array_compact(F.array(change(F.greatest("start", first), 1), ends))
    return spans.select("mid", "stretch", F.inline(both))


def flagged_spans(facts: DataFrame, size_ms: int, slide_ms: int, accounts: int = 3) -> DataFrame:
    """(mid, start, end): stretches of window ends, ``start`` to before ``end``, whose windows raise an alert.

    A sweep over the times at which an account enters or leaves the window, instead of a copy of each fact per window:
    every fact counts up once and down once. A stretch of ``SWEEP_SIZES`` window lengths is swept on its
    own, so a device with a share of all events is spread over tasks. Times are epoch milliseconds, a missing account counts
    as an account.
    """
    _check(size_ms, slide_ms)
    one, none = F.lit(1), F.lit(0)
    facts = facts.filter("mid IS NOT NULL")
    took = _changes(facts.filter(~F.col("clicked")), ["mid", "uid"], size_ms, slide_ms, one, none)
    clicks = _changes(facts.filter("clicked"), ["mid"], size_ms, slide_ms, none, one)
    changes = took.unionByName(clicks).groupBy("mid", "stretch", "at").agg(F.sum("accounts").alias("accounts"), F.sum("clicks").alias("clicks"))
    along = Window.partitionBy("mid", "stretch").orderBy("at")
    running = along.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    after = (F.col("stretch") + 1) * (SWEEP_SIZES * size_ms)
    swept = changes.select(
        "mid",
        F.col("at").alias("start"),
        F.coalesce(F.lead("at").over(along), after).alias("end"),
        F.sum("accounts").over(running).alias("n"),
        F.sum("clicks").over(running).alias("clicks"),
    )
    return swept.filter((F.col("n") >= accounts) & (F.col("clicks") == 0)).select("mid", "start", "end")


def last_of_minute(spans: DataFrame, slide_ms: int) -> DataFrame:
    """(mid, window_end): the last flagged window of each device and minute. Rows are made per alert, not per window."""
    last = F.col("end") - slide_ms
    if slide_ms % MS_PER_MINUTE == 0:  # at most one window ends in a minute
        return spans.select("mid", F.explode(F.sequence("start", last, F.lit(slide_ms).cast("bigint"))).alias("window_end"))
    minutes = F.sequence(_floor_to(F.col("start"), MS_PER_MINUTE), _floor_to(last, MS_PER_MINUTE), F.lit(MS_PER_MINUTE).cast("bigint"))
    placed = spans.select("mid", "start", last.alias("last"), F.explode(minutes).alias("minute"))
    end = F.least("last", _floor_to(F.col("minute") + MS_PER_MINUTE - 1, slide_ms))
    placed = placed.select("mid", "minute", "start", end.alias("window_end")).filter((F.col("window_end") >= F.col("minute")) & (F.col("window_end") >= F.col("start")))
    return placed.groupBy("mid", "minute").agg(F.max("window_end").alias("window_end")).drop("minute")


def _documents(windows: DataFrame, panes: DataFrame, size_ms: int) -> DataFrame:
    """Alert documents: the accounts, items and events of each window.

    ``panes`` has ``mid, at, uids, items, log``; a window takes the panes with
    ``window_end - size <= at < window_end``. Blocks of the window's length make it an equi-join.
    """
    start = F.col("window_end") - size_ms
    blocks = F.array_distinct(F.array(_block(start, size_ms), _block(F.col("window_end") - 1, size_ms)))
    wanted = windows.select("mid", "window_end", F.explode(blocks).alias("block"))
    placed = panes.withColumn("block", _block(F.col("at"), size_ms))
    inside = (F.col("at") >= start) & (F.col("at") < F.col("window_end"))
    ended = F.timestamp_millis("window_end")
    # All events are read here, but only those near an alert may reach the shuffle.
    return (
        near_keys(placed, wanted, ["mid", "block"])
        .join(wanted, ["mid", "block"])
        .filter(inside)
        .groupBy("mid", "window_end")
        .agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("uids")))).alias("uids"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            F.array_sort(F.flatten(F.collect_list("log"))).alias("log"),
        )
        .select(
            doc_id("_", "mid", minute_of(ended)).alias("doc_id"),
            "mid",
            F.transform("uids", lambda x: x["uid"]).alias("uids"),
            F.transform("items", lambda x: x["itemid"]).alias("item_ids"),
            F.transform("log", lambda x: x["evid"]).alias("events"),
            F.col("window_end").alias("ts"),
            F.date_format(ended, "yyyy-MM-dd").alias("dt"),
        )
    )


def _log_entry(tie: str | None) -> Column:
    return F.struct(F.col("ts").alias("ts"), (F.col(tie) if tie else F.lit(0)).cast("bigint").alias("tie"), F.col("evid").alias("evid"))


def coupon_alerts(events: DataFrame, size_ms: int = 300_000, slide_ms: int = 5_000, accounts: int = 3, tie: str | None = None) -> DataFrame:
    """Alert documents (doc_id, mid, uids, item_ids, events, ts, dt) of a table of events.

    A missing account counts as an account, and stays in ``uids`` as a null. A missing ``ts`` counts as 0.
    Events without a device belong to none and raise no alert.
    """
    events = events.withColumn("ts", F.coalesce("ts", F.lit(0).cast("bigint")))
    alerts = last_of_minute(flagged_spans(event_facts(events, slide_ms), size_ms, slide_ms, accounts), slide_ms)
    took = F.col("evid") == COUPON
    none = F.array()
    rows = events.select(
        "mid",
        F.col("ts").alias("at"),
        F.when(took, F.array(F.struct("uid"))).otherwise(none).alias("uids"),
        F.when(took, F.array(F.struct("itemid"))).otherwise(none).alias("items"),
        F.array(_log_entry(tie)).alias("log"),
    )
    return _documents(alerts, rows, size_ms)


# Events of one part of an alert.
PART_EVENTS = 1000


def coupon_alert_parts(
    events: DataFrame, size_ms: int = 300_000, slide_ms: int = 5_000, accounts: int = 3, tie: str | None = None, most: int = PART_EVENTS
) -> DataFrame:
    """The events of the alerts of :func:`coupon_alerts` in ordered parts: (doc_id, pane, part, events).

    A part holds up to ``most`` events of one pane, so that an alert of a device with a share of all events is in no
    task's memory as a whole; ``pane`` and then ``part`` give the order. For readers that want an alert in one row there is
    :func:`whole_events`.
    """
    events = events.withColumn("ts", F.coalesce("ts", F.lit(0).cast("bigint")))
    windows = last_of_minute(flagged_spans(event_facts(events, slide_ms), size_ms, slide_ms, accounts), slide_ms)
    start = F.col("window_end") - size_ms
    blocks = F.array_distinct(F.array(_block(start, size_ms), _block(F.col("window_end") - 1, size_ms)))
    wanted = windows.select("mid", "window_end", F.explode(blocks).alias("block"))
    placed = events.select("mid", "ts", "evid", (F.col(tie) if tie else F.lit(0)).cast("bigint").alias("tie"), _block(F.col("ts"), size_ms).alias("block"))
    inside = (F.col("ts") >= start) & (F.col("ts") < F.col("window_end"))
    rows = near_keys(placed, wanted, ["mid", "block"]).join(wanted, ["mid", "block"]).filter(inside)
    rows = rows.select(doc_id("_", "mid", minute_of(F.timestamp_millis("window_end"))).alias("doc_id"), _floor_to(F.col("ts"), slide_ms).alias("pane"), "ts", "tie", "evid")
    row = F.row_number().over(Window.partitionBy("doc_id", "pane").orderBy("ts", "tie", "evid"))
    parts = rows.withColumn("part", F.floor((row - 1) / most).cast("int")).groupBy("doc_id", "pane", "part").agg(F.array_sort(F.collect_list(F.struct("ts", "tie", "evid"))).alias("log"))
    return parts.select("doc_id", "pane", "part", F.transform("log", lambda x: x["evid"]).alias("events"))


def whole_events(parts: DataFrame) -> DataFrame:
    """(doc_id, events): the parts of each alert put together."""
    listed = F.array_sort(F.collect_list(F.struct("pane", "part", "events")))
    return parts.groupBy("doc_id").agg(listed.alias("parts")).select("doc_id", F.flatten(F.transform("parts", lambda p: p["events"])).alias("events"))


def pane_rows(events: DataFrame, slide_ms: int = 5_000, tie: str | None = None) -> DataFrame:
    """What one micro-batch adds to the panes: a row per device and pane with its accounts, items, clicks and events.

    A pane may get rows from many batches, in any order and however late; readers take them together. A click
    that arrives late withdraws the alerts of the windows over it. A missing ``ts`` counts as 0.
    """
    took = F.col("evid") == COUPON
    at = F.coalesce("ts", F.lit(0).cast("bigint"))
    return (
        events.withColumn("ts", at)
        .groupBy("mid", _floor_to(F.col("ts"), slide_ms).alias("pane"))
        .agg(
            F.collect_set(F.when(took, F.struct("uid"))).alias("uids"),
            F.collect_set(F.when(took, F.struct("itemid"))).alias("items"),
            F.coalesce(F.bool_or(F.col("evid") == CLICK), F.lit(False)).alias("clicked"),
            F.collect_list(_log_entry(tie)).alias("log"),
        )
        .withColumn("dt", F.date_format(F.timestamp_millis("pane"), "yyyy-MM-dd"))
    )


def touched_minutes(panes: DataFrame, size_ms: int, slide_ms: int) -> DataFrame:
    """(mid, minute): the minutes whose last window may change when something comes into ``panes`` (mid, pane)."""
    if slide_ms % MS_PER_MINUTE == 0:
        minutes = F.sequence(F.col("pane") + slide_ms, F.col("pane") + size_ms, F.lit(slide_ms).cast("bigint"))
    else:
        minutes = F.sequence(_floor_to(F.col("pane") + slide_ms, MS_PER_MINUTE), _floor_to(F.col("pane") + size_ms, MS_PER_MINUTE), F.lit(MS_PER_MINUTE).cast("bigint"))
    return panes.filter("mid IS NOT NULL").select("mid", F.explode(minutes).alias("minute")).select("mid", _floor_to(F.col("minute"), MS_PER_MINUTE).alias("minute")).distinct()


def near_panes(stored: DataFrame, came: DataFrame, size_ms: int) -> DataFrame:
    """Stored pane rows that windows over the minutes touched by ``came`` (mid, pane) may hold."""
    width = size_ms + MS_PER_MINUTE
    block = _block(F.col("pane"), width)
    blocks = came.filter("mid IS NOT NULL").select("mid", F.explode(F.array(block - 1, block, block + 1)).alias("block")).distinct()
    placed = stored.withColumn("block", block)
    return near_keys(placed, blocks, ["mid", "block"]).join(blocks, ["mid", "block"], "left_semi").drop("block")


def pane_alerts(panes: DataFrame, size_ms: int = 300_000, slide_ms: int = 5_000, accounts: int = 3, only: DataFrame | None = None) -> DataFrame:
    """Streaming form, part two: alert documents from all stored pane rows; equals the batch form. ``only`` limits
    them to some minutes (mid, minute)."""
    took = panes.select("mid", "pane", F.lit(False).alias("clicked"), F.explode("uids").alias("u"))
    clicks = panes.filter("clicked").select("mid", "pane", "clicked", F.lit(None).cast("string").alias("uid"))
    facts = took.select("mid", "pane", "clicked", "u.uid").unionByName(clicks)
    alerts = last_of_minute(flagged_spans(facts, size_ms, slide_ms, accounts), slide_ms)
    if only is not None:
        alerts = alerts.withColumn("minute", _floor_to(F.col("window_end"), MS_PER_MINUTE)).join(only, ["mid", "minute"], "left_semi").drop("minute")
    return _documents(alerts, panes.withColumnRenamed("pane", "at"), size_ms)
