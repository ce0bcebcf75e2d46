from __future__ import annotations

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from shoptide.operators import alerts

MIN = 60_000
START = 1_705_276_800_000  # 2024-01-15 00:00
EVENT = "mid string, uid string, itemid string, evid string, ts bigint, seq bigint"


def events(spark, *rows):
    full = [(mid, uid, item, evid, START + at, i) for i, (mid, uid, item, evid, at) in enumerate(rows)]
    return spark.createDataFrame(full, EVENT)


def coupons(*uids, mid="m", start=0, step=1000):
    return [(mid, u, f"i{u}", "coupon", start + n * step) for n, u in enumerate(uids)]


def found(df, **kw):
    return {(r.mid, r.ts - START): r for r in alerts.coupon_alerts(df, tie="seq", **kw).collect()}


def brute_force(rows, size, slide, accounts):
    """The definition, window by window."""
    by_window = defaultdict(list)
    for r in rows:
        first = r["ts"] // slide * slide + slide
        for end in range(first, first + size, slide):
            by_window[r["mid"], end].append(r)
    last = {}
    for (mid, end), members in by_window.items():
        took = [r for r in members if r["evid"] == "coupon"]
        if len({r["uid"] for r in took}) >= accounts and not any(r["evid"] == "clickItem" for r in members):
            key = (mid, end // MIN)
            if key not in last or end > last[key][0]:
                ordered = sorted(members, key=lambda r: (r["ts"], r["seq"]))
                last[key] = (end, {r["uid"] for r in took}, {r["itemid"] for r in took}, [r["evid"] for r in ordered])
    return {(mid, end): (u, i, e) for (mid, _), (end, u, i, e) in last.items()}


def test_three_accounts_without_click(spark):
    got = found(events(spark, *coupons("a", "b", "c"), ("m", "a", None, "addCart", 1500)))
    ends = sorted(end for _, end in got)
    # Windows ending from 0:05 to 5:00 hold all three; one alert per minute, its last window.
    assert ends == [55_000, 115_000, 175_000, 235_000, 295_000, 300_000]
    row = got["m", 55_000]
    assert row.doc_id == "m_2024-01-15 00:00" and row.dt == "2024-01-15"
    assert (row.uids, row.item_ids) == (["a", "b", "c"], ["ia", "ib", "ic"])
    assert row.events == ["coupon", "coupon", "addCart", "coupon"]


@pytest.mark.parametrize(
    "rows",
    [
        coupons("a", "b"),
        coupons("a", "a", "a"),
        coupons("a", "b", "c") + [("m", "z", "i", "clickItem", 2500)],
        coupons("a", "b") + coupons("c", mid="other"),
        coupons("a", "b", "c", step=150_000 + 1),
        [("m", u, "i", "addCart", 0) for u in "abc"],
    ],
)
def test_no_alert(spark, rows):
    assert found(events(spark, *rows)) == {}


def test_click_before_the_window_does_not_count(spark):
    got = found(events(spark, ("m", "z", "i", "clickItem", 0), *coupons("a", "b", "c", start=200_000)))
    assert got and min(end for _, end in got) == 355_000
    assert all(end > 300_000 for _, end in got)


def test_missing_account_counts_as_one(spark):
    got = found(events(spark, *coupons("a", "b"), ("m", None, "i", "coupon", 1)))
    assert got and next(iter(got.values())).uids == [None, "a", "b"]


@pytest.mark.parametrize(("size", "slide", "accounts"), [(300_000, 5_000, 3), (300_000, 60_000, 2), (60_000, 60_000, 2), (120_000, 60_000, 3)])
def test_equals_brute_force(spark, size, slide, accounts):
    rng = random.Random(size + slide)
    kinds = ["coupon"] * 8 + ["addCart"] * 3 + ["clickItem"]
    rows = [
        (f"m{rng.choice([0, 0, 0, 1, 2])}", rng.choice(["a", "b", "c", "d", None]), f"i{rng.randrange(5)}", rng.choice(kinds), rng.randrange(0, 40 * MIN))
        for _ in range(260)
    ]
    df = events(spark, *rows)
    got = alerts.coupon_alerts(df, size, slide, accounts, tie="seq").collect()
    want = brute_force([r.asDict() for r in df.collect()], size, slide, accounts)
    assert want
    assert {(r.mid, r.ts): (set(r.uids), set(r.item_ids), r.events) for r in got} == want


@pytest.mark.parametrize("stretch", [1, 3])
@pytest.mark.parametrize(("size", "slide"), [(300_000, 5_000), (60_000, 60_000), (180_000, 90_000), (3_600_000, 600_000)])
def test_sweep_flags_the_windows_of_the_definition(spark, monkeypatch, stretch, size, slide):
    monkeypatch.setattr(alerts, "SWEEP_SIZES", stretch)
    rng = random.Random(size)
    facts = []
    for _ in range(400):
        clicked = rng.random() < 0.1
        facts.append((rng.choice(["m", "m", "n", None]), rng.randrange(-40, 80) * slide, clicked, None if clicked else rng.choice(["a", "b", "c", "d", None])))
    counted, clicks = defaultdict(set), set()
    for mid, pane, clicked, uid in facts:
        for end in range(pane + slide, pane + size + 1, slide):
            clicks.add((mid, end)) if clicked else counted[mid, end].add(uid)
    want = {(mid, end) for (mid, end), uids in counted.items() if mid and len(uids) >= 2 and (mid, end) not in clicks}
    spans = alerts.flagged_spans(spark.createDataFrame(facts, "mid string, pane bigint, clicked boolean, uid string"), size, slide, 2)
    got = [(r.mid, end) for r in spans.collect() for end in range(r.start, r.end, slide)]
    assert len(got) == len(set(got)) and set(got) == want and want
    last = {}
    for mid, end in want:
        last[mid, end // MIN] = max(end, last.get((mid, end // MIN), end))
    found = alerts.last_of_minute(spans, slide).collect()
    assert sorted((r.mid, r.window_end) for r in found) == sorted((mid, end) for (mid, _), end in last.items())


def test_no_fact_is_copied_into_its_windows(spark):
    facts = spark.createDataFrame([("m", 0, False, "a")], "mid string, pane bigint, clicked boolean, uid string")
    plan = alerts.flagged_spans(facts, 300_000, 5_000)._jdf.queryExecution().optimizedPlan().toString()
    assert "sequence(" not in plan


def test_stored_panes_give_the_same_alerts(spark):
    rng = random.Random(5)
    rows = [(f"m{rng.randrange(3)}", rng.choice("abcd"), "i", rng.choice(["coupon"] * 9 + ["clickItem"]), rng.randrange(0, 60 * MIN)) for _ in range(150)]
    df = events(spark, *rows)
    # Two micro-batches bring parts of the same panes.
    panes = alerts.pane_rows(df.filter("seq % 2 = 0"), tie="seq").unionByName(alerts.pane_rows(df.filter("seq % 2 = 1"), tie="seq"))
    stored = {r.doc_id: r for r in alerts.pane_alerts(panes).collect()}
    assert stored == {r.doc_id: r for r in alerts.coupon_alerts(df, tie="seq").collect()}
    assert stored


def test_events_of_an_alert_in_parts(spark):
    rng = random.Random(8)
    rows = [(f"m{rng.randrange(2)}", rng.choice("abcd"), "i", rng.choice(["coupon"] * 9 + ["addCart"]), rng.randrange(0, 10 * MIN)) for _ in range(200)]
    df = events(spark, *rows)
    parts = alerts.coupon_alert_parts(df, tie="seq", most=2)
    assert parts.filter("size(events) > 2").count() == 0 and parts.filter("part > 0").count() > 0
    got = {r.doc_id: r.events for r in alerts.whole_events(parts).collect()}
    assert got == {r.doc_id: r.events for r in alerts.coupon_alerts(df, tie="seq").collect()} and got


def test_window_must_be_whole_slides(spark):
    with pytest.raises(ValueError, match="multiple"):
        alerts.coupon_alerts(events(spark, *coupons("a")), 300_000, 7_000)


def test_alert_record(spark):
    from shoptide.schemas import COUPON_ALERT

    got = alerts.coupon_alerts(events(spark, *coupons("a", "b", "c"))).schema
    assert {f.name: f.dataType.simpleString() for f in COUPON_ALERT}.items() <= {f.name: f.dataType.simpleString() for f in got}.items()
