from __future__ import annotations

import random

from conftest import rows_of

from shoptide.functions import with_log_time
from shoptide.operators import dedup, keyed, users

HOUR = 3_600_000
DAY = 24 * HOUR
START = 1_705_276_800_000  # 2024-01-15 00:00


def logs(spark, *rows):
    return with_log_time(spark.createDataFrame(rows, "mid string, ts bigint, seq int"))


def test_first_per_day(spark):
    df = logs(
        spark,
        ("m1", START + 5, 1),
        ("m1", START + 2, 2),
        ("m1", START + DAY, 3),
        ("m2", START + 9, 5),
        ("m2", START + 9, 4),
    )
    assert rows_of(dedup.first_per_day(df, "seq"), "mid", "log_date", "ts", "seq") == [
        ("m1", "2024-01-15", START + 2, 2),
        ("m1", "2024-01-16", START + DAY, 3),
        ("m2", "2024-01-15", START + 9, 4),
    ]


def test_first_per_day_twice_changes_nothing(spark):
    rng = random.Random(1)
    df = logs(spark, *[(f"m{rng.randrange(9)}", START + rng.randrange(3 * DAY), i) for i in range(300)])
    once = dedup.first_per_day(df, "seq")
    assert rows_of(once) == rows_of(dedup.first_per_day(once, "seq"))


def test_unseen_compares_the_log_day(spark):
    df = logs(spark, ("m1", START, 1), ("m1", START + DAY, 2), ("m2", START, 3))
    seen = logs(spark, ("m1", START + 7, 0), ("m1", START + 8, 0))
    assert rows_of(dedup.unseen(df, seen), "mid", "log_date") == [("m1", "2024-01-16"), ("m2", "2024-01-15")]


def test_stage_counts_equal_the_stages(spark):
    rng = random.Random(2)
    make = lambda n: logs(spark, *[(f"m{rng.randrange(20)}", START + rng.randrange(2 * DAY), i) for i in range(n)])
    df, seen = make(200), make(15)
    fresh = dedup.unseen(df, seen)
    want = {"input": df.count(), "after_unseen": fresh.count(), "after_first": dedup.first_per_day(fresh).count()}
    assert {r.stage: r.n for r in dedup.stage_counts(df, seen).collect()} == want


def test_stage_counts_of_nothing(spark):
    empty = logs(spark, ("m", START, 1)).limit(0)
    assert {r.stage: r.n for r in dedup.stage_counts(empty, empty).collect()} == {"input": 0, "after_unseen": 0, "after_first": 0}


def test_latest_user(spark):
    df = spark.createDataFrame([("u1", 1, "a"), ("u1", 3, "b"), ("u1", 2, "c"), ("u2", 1, "d"), ("u2", 1, "e")], "id string, version int, level string")
    assert rows_of(users.latest(df, "version", ["level"])) == [("u1", 3, "b"), ("u2", 1, "e")]


def test_one_row_per_key_leaves_each_task(spark):
    """A device with most of the rows costs the shuffle one row per task."""
    df = logs(spark, *[("hot", START + i, i) for i in range(50)], ("m1", START, 99))
    plan = dedup.first_per_day(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2 and "Partial" in plan


def test_near_keys_keeps_every_wanted_row_and_few_others(spark):
    table = spark.range(20_000).selectExpr("cast(id % 5000 AS string) AS k", "id % 3 AS b", "id")
    wanted = spark.range(40).selectExpr("cast(id * 7 AS string) AS k", "id % 3 AS b")
    near = keyed.near_keys(table, wanted, ["k", "b"])
    exact = table.join(wanted, ["k", "b"], "left_semi")
    assert near.columns == table.columns
    assert exact.join(near, "id", "left_anti").count() == 0 < exact.count()
    assert near.count() - exact.count() < 100
