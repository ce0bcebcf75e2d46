from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shoptide.functions import age_at, doc_id, epoch_ms, mask_phone, minute_of, percent, tokens, with_log_time, with_order_time
from shoptide.operators.search import match_all

SOME = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def column(spark, values, kind="string"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, v {kind}")


def out(df, expr):
    return [r[0] for r in df.orderBy("i").select(expr).collect()]


def test_mask_phone_lengths(spark):
    df = column(spark, ["13412349876", "1341234", "134", "13", "", None])
    assert out(df, mask_phone("v")) == ["134****9876", "134****", "134****", "13****", "****", None]


@SOME
@given(st.lists(st.text(alphabet="0123456789+é中", max_size=14), min_size=1, max_size=30))
def test_mask_phone_hides_characters_four_to_seven(spark, values):
    df = column(spark, values)
    assert out(df, mask_phone("v")) == [v[:3] + "****" + v[7:] for v in values]


def test_log_time(spark):
    df = with_log_time(column(spark, [1_705_329_000_123, None, 0], "bigint"), "v").orderBy("i")
    assert [(r.log_date, r.log_hour) for r in df.collect()] == [
        ("2024-01-15", "14"),
        ("1970-01-01", "00"),
        ("1970-01-01", "00"),
    ]


def test_log_time_follows_the_session_zone(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        row = with_log_time(column(spark, [1_705_334_400_000], "bigint"), "v").first()
        assert (row.log_date, row.log_hour) == ("2024-01-16", "00")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_order_time(spark):
    df = with_order_time(column(spark, ["2020-07-18 09:05:59", "2020-07-18", "", None]), "v").orderBy("i")
    assert [(r.create_date, r.create_hour) for r in df.collect()] == [
        ("2020-07-18", "09"),
        ("2020-07-18", None),
        (None, None),
        (None, None),
    ]


def test_age_counts_years_of_365_days_towards_zero(spark):
    born = ["2024-01-01", "2023-01-01", "2023-01-02", "2000-02-29", "2024-12-01", "2026-01-01", "x", None]
    assert out(column(spark, born), age_at("v", "2024-01-01")) == [0, 1, 0, 23, 0, -2, None, None]


@SOME
@given(st.lists(st.tuples(st.integers(0, 5000), st.integers(0, 5000)), min_size=1, max_size=40))
def test_percent_rounds_half_up(spark, pairs):
    df = spark.createDataFrame([(i, min(p), max(p)) for i, p in enumerate(pairs)], "i int, part bigint, total bigint")
    got = out(df, percent(F.col("part"), F.col("total")))
    want = [((a * 1000 * 2 + b) // (2 * b)) / 10 if b else 0.0 for a, b in ((min(p), max(p)) for p in pairs)]
    assert got == want


def test_percent_of_halves(spark):
    df = spark.createDataFrame([(1, 1, 2000), (2, 3, 2000), (3, 0, 0)], "i int, part bigint, total bigint")
    assert out(df, percent(F.col("part"), F.col("total"))) == [0.1, 0.2, 0.0]


def test_tokens(spark):
    df = column(spark, ["Red-Plate x2", "红色 Phone", "", "--"])
    assert out(df, tokens("v")) == [["red", "plate", "x2"], ["红", "色", "phone"], [], []]


def test_match_all_needs_every_token(spark):
    df = column(spark, ["big Red plate", "red", "reddish plate", "plate, RED", None])
    assert out(df, match_all("v", "plate red")) == [True, False, False, True, False]
    assert out(df, match_all("v", "")) == [False] * 5
    assert out(column(spark, ["红色手机", "手表"]), match_all("v", "手 机")) == [True, False]


def test_document_keys(spark):
    df = spark.createDataFrame([("m1", 1_705_329_059_999)], "mid string, ts bigint")
    assert df.select(doc_id("_", "mid", minute_of(epoch_ms("ts")))).first()[0] == "m1_2024-01-15 14:30"
