"""Streams in several micro-batches: the stored result equals the batch result."""

from __future__ import annotations

import random

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import schemas
from shoptide.functions import with_log_time
from shoptide.operators import alerts, dedup, metrics
from shoptide.sources import decode, logs
from shoptide.sources.tables import upper_columns
from shoptide.streaming import jobs, sinks

DAY = 86_400_000
START = 1_705_276_800_000  # 2024-01-15 00:00
WITH_SEQ = T.StructType([*schemas.EVENT_LOG, T.StructField("seq", T.LongType())])


def start_log(mid, ts):
    return ({"mid": mid, "uid": "u", "type": "startup", "ts": ts}, 0)


def run(spark, writer, tmp_path, name="checkpoint"):
    jobs.run_to_end(spark, writer, str(tmp_path / name))


def test_dau_over_batches(spark, messages, tmp_path):
    feed = messages("start")
    feed.send(start_log("m1", START + 500), start_log("m1", START + 300), start_log("m2", START))
    feed.send(start_log("m1", START + 100), start_log("m3", START - DAY + 5), ("{broken", 0))
    feed.send(start_log("m1", START + 900), start_log("m1", START + DAY))
    table = jobs.dau_table(str(tmp_path / "dau"))
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    got = table.read(spark)
    assert "LOG_DATE" in got.columns and got.columns == [c.upper() for c in got.columns]
    assert rows_of(got, "MID", "LOG_DATE", "LOG_HOUR", "TS") == [
        ("m1", "2024-01-15", "00", START + 100),
        ("m1", "2024-01-16", "00", START + DAY),
        ("m2", "2024-01-15", "00", START),
        ("m3", "2024-01-14", "00", START - DAY + 5),
    ]


@pytest.mark.parametrize("seed", [1, 2])
def test_dau_does_not_depend_on_the_split_into_batches(spark, messages, tmp_path, seed):
    rng = random.Random(seed)
    sent = [(f"m{rng.randrange(8)}", START + rng.randrange(2 * DAY)) for _ in range(120)]
    feed = messages("start")
    while sent_left := sent[sum(sizes) :] if (sizes := getattr(feed, "sizes", [])) else sent:
        size = min(len(sent_left), rng.randrange(10, 60))
        feed.send(*[start_log(*x) for x in sent_left[:size]])
        feed.sizes = [*sizes, size]
    table = jobs.dau_table(str(tmp_path / "dau"))
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    batch = dedup.first_per_day(with_log_time(spark.createDataFrame(sent, "mid string, ts bigint")))
    assert rows_of(table.read(spark), "mid", "log_date", "ts") == rows_of(batch, "mid", "log_date", "ts")


def test_dau_goes_on_from_its_checkpoint(spark, messages, tmp_path):
    feed = messages("start")
    table = jobs.dau_table(str(tmp_path / "dau"))
    feed.send(start_log("m1", START + 50), start_log("m2", START))
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    feed.send(start_log("m1", START + 70), start_log("m2", START + DAY))
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    assert rows_of(table.read(spark), "mid", "ts") == [("m1", START + 50), ("m2", START), ("m2", START + DAY)]


def test_late_and_timeless_logs_count(spark, messages, tmp_path):
    feed = messages("start")
    for day in range(5):
        feed.send(start_log("m1", START + day * DAY))
    feed.send(start_log("late", START + 7))
    feed.send(({"mid": "nots", "uid": "u", "type": "startup"}, 0))
    table = jobs.dau_table(str(tmp_path / "dau"))
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    got = rows_of(table.read(spark), "MID", "LOG_DATE")
    assert ("late", "2024-01-15") in got and ("nots", "1970-01-01") in got and len(got) == 7


def event(mid, uid, evid, at, seq, item="1"):
    return ({"mid": mid, "uid": uid, "evid": evid, "itemid": item, "ts": START + at, "seq": seq}, 0)


def stream_alerts(spark, feed, tmp_path):
    table = jobs.pane_table(str(tmp_path / "panes"))
    run(spark, jobs.coupon_panes(feed.stream(), table, schema=WITH_SEQ, tie="seq"), tmp_path)
    return alerts.pane_alerts(table.read(spark))


def test_late_click_withdraws_the_alert(spark, messages, tmp_path):
    feed = messages("events")
    feed.send(*[event("m", u, "coupon", i * 1000, i) for i, u in enumerate("abc")])
    assert stream_alerts(spark, feed, tmp_path).count() == 6
    feed.send(event("m", "a", "clickItem", 1500, 9))
    assert stream_alerts(spark, feed, tmp_path).count() == 0


def test_alerts_over_batches_equal_batch(spark, messages, tmp_path):
    rng = random.Random(7)
    sent = [event(f"m{rng.randrange(3)}", rng.choice("abcd"), rng.choice(["coupon"] * 9 + ["addCart", "clickItem"]), at, i, rng.randrange(4)) for i, at in enumerate(sorted(rng.randrange(0, 1_500_000) for _ in range(90)))]
    feed = messages("events")
    for i in range(0, 90, 23):
        feed.send(*rng.sample(sent[i : i + 23], len(sent[i : i + 23])))
    got = {r.doc_id: r for r in stream_alerts(spark, feed, tmp_path).collect()}
    table = spark.createDataFrame([(m["mid"], m["uid"], str(m["itemid"]), m["evid"], m["ts"], m["seq"]) for m, _ in sent], "mid string, uid string, itemid string, evid string, ts bigint, seq bigint")
    want = {r.doc_id: r for r in alerts.coupon_alerts(table, tie="seq").collect()}
    assert got == want and want


def order(key, second, **more):
    message = {"id": key, "user_id": f"u{key}", "order_status": "1001", "total_amount": "12.5", "create_time": "2024-01-15 10:11:12", "consignee_tel": "13412349876"}
    return ({**message, **more}, second)


def detail(key, order_key, second, price="3.5"):
    return ({"id": key, "order_id": order_key, "sku_id": "s", "sku_name": "red plate", "order_price": price, "sku_num": "1"}, second)


def user(key, second, level="1", gender="F"):
    return ({"id": key, "login_name": "n", "user_level": level, "birthday": "1990-01-15", "gender": gender}, second)


def test_orders_are_masked_and_stored_once(spark, messages, tmp_path):
    feed = messages("orders")
    feed.send(order("1", 0), order("2", 0, total_amount="x"), order("4", 0, create_time="2024-01-15"))
    feed.send(order("1", 5), order("3", 5, create_time="2024-01-16 01:00:00"))
    table = jobs.order_table(str(tmp_path / "orders"))
    run(spark, jobs.gmv(feed.stream(), table), tmp_path)
    assert rows_of(table.read(spark), "ID", "CONSIGNEE_TEL", "TOTAL_AMOUNT", "CREATE_DATE", "CREATE_HOUR") == [
        ("1", "134****9876", 12.5, "2024-01-15", "10"),
        ("3", "134****9876", 12.5, "2024-01-16", "01"),
    ]


def test_malformed_messages_are_kept_aside(spark, messages, tmp_path):
    feed = messages("orders")
    feed.send(order("1", 0), ("{no json", 0), order("2", 0, total_amount="x"), order("4", 0, create_time=None))
    run(spark, jobs.quarantine(feed.stream(), schemas.ORDER_INFO, str(tmp_path / "bad")), tmp_path)
    kept = [r.value for r in spark.read.text(str(tmp_path / "bad")).collect()]
    assert len(kept) == 3 and "{no json" in kept


def test_users_keep_the_last_message(spark, messages, tmp_path):
    feed = messages("users")
    table = jobs.user_table(str(tmp_path / "users"))
    feed.send(user("u1", 1, "1"), user("u2", 1, "1"), user("u1", 2, "2"))
    feed.send(user("u2", 3, "5"))
    run(spark, jobs.users(feed.stream(), table), tmp_path)
    assert rows_of(table.read(spark), "id", "user_level") == [("u1", "2"), ("u2", "5")]
    only = spark.createDataFrame([("u2",), ("u9",)], "id string")
    assert rows_of(table.read(spark, only=only), "id", "user_level") == [("u2", "5")]


def test_sale_details_over_batches(spark, messages, tmp_path):
    people = messages("users")
    known = jobs.user_table(str(tmp_path / "users"))
    people.send(user("u1", 0, "1"), user("u1", 1, "7", "M"))
    run(spark, jobs.users(people.stream(), known), tmp_path, "users-checkpoint")

    orders, details = messages("orders"), messages("details")
    # Order 1: same batch, item sent twice. Order 2: item first. Order 3: order first.
    # Order 4: more than 120 s apart. Order 5: no item. Order 6: exactly 120 s.
    orders.send(order("1", 10), order("3", 10), order("4", 10), order("5", 10), order("6", 10))
    details.send(detail("d1", "1", 10), detail("d1", "1", 11), detail("d2", "2", 12))
    orders.send(order("2", 60))
    details.send(detail("d3", "3", 70), detail("d6", "6", 130), detail("d4", "4", 131), detail("d9", "9", 70))
    table = jobs.sale_table(str(tmp_path / "sales"))
    writer = jobs.sale_details(orders.stream(), details.stream(), known, table, "2024-01-15")
    run(spark, writer, tmp_path)
    got = table.read(spark)
    assert rows_of(got, "doc_id", "user_gender", "user_age", "user_level", "sku_price", "user_known") == [
        ("1-d1", "M", 34, "7", 3.5, True),
        ("2-d2", None, 0, None, 3.5, False),
        ("3-d3", None, 0, None, 3.5, False),
        ("6-d6", None, 0, None, 3.5, False),
    ]
    assert rows_of(got.filter("dt = '2024-01-15'").select("dt").distinct()) == [("2024-01-15",)]


def test_sale_messages_are_decoded_once(spark, messages, tmp_path):
    read = spark.sparkContext.accumulator(0)

    @F.udf("string")
    def counted(value):
        read.add(1)
        return value

    orders, details = messages("orders"), messages("details")
    orders.send(order("1", 10), order("2", 10))
    details.send(detail("d1", "1", 10), detail("d2", "2", 12), detail("d3", "3", 12))
    feeds = [feed.stream().withColumn("value", counted.asNondeterministic()("value")) for feed in (orders, details)]
    table = jobs.sale_table(str(tmp_path / "sales"))
    run(spark, jobs.sale_details(*feeds, jobs.user_table(str(tmp_path / "nobody")), table, "2024-01-15"), tmp_path)
    assert rows_of(table.read(spark), "doc_id") == [("1-d1",), ("2-d2",)] and read.value == 5


def test_sale_partners_that_are_read_late_still_match(spark, messages, tmp_path):
    orders, details = messages("orders"), messages("details")
    # All partners arrive 10 s apart, but one of each pair is read two batches after rows that arrived an hour later.
    orders.send(order("1", 10))
    details.send(detail("d2", "2", 20))
    for second in (4000, 8000):
        orders.send(order(f"at{second}", second))
        details.send(detail("d", f"at{second}", second))
    orders.send(order("2", 10))
    details.send(detail("d1", "1", 20), detail("d3", "1", 131))
    table = jobs.sale_table(str(tmp_path / "sales"))
    run(spark, jobs.sale_details(orders.stream(), details.stream(), jobs.user_table(str(tmp_path / "nobody")), table, "2024-01-15"), tmp_path)
    assert rows_of(table.read(spark), "doc_id") == [("1-d1",), ("2-d2",), ("at4000-d",), ("at8000-d",)]


DOC = T.StructType([T.StructField("doc_id", T.StringType()), T.StructField("v", T.IntegerType()), T.StructField("dt", T.StringType())])


def docs(spark, *rows):
    return spark.createDataFrame(rows, DOC)


def test_same_document_id_overwrites_and_a_batch_can_run_again(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "docs"), DOC, ["doc_id"], "dt")
    table.add(docs(spark, ("a", 1, "d1"), ("b", 1, "d2")), 0)
    table.add(docs(spark, ("a", 2, "d1")), 1)
    table.add(docs(spark, ("a", 2, "d1")), 1)
    table.add(docs(spark).limit(0), 2)
    assert rows_of(table.read(spark)) == [("a", 2, "d1"), ("b", 1, "d2")]
    assert table.versions(spark).count() == 3
    plan = table.read(spark).filter("dt = 'd1'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(dt" in plan


def test_compacted_table_takes_newer_batches(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "docs"), DOC, ["doc_id"], "dt")
    table.add(docs(spark, ("a", 1, "d1"), ("b", 1, "d2")), 0)
    table.add(docs(spark, ("a", 2, "d1")), 1)
    copy = table.compact(spark, str(tmp_path / "copy"))
    assert rows_of(copy.read(spark)) == [("a", 2, "d1"), ("b", 1, "d2")] and copy.versions(spark).count() == 2
    copy.add(docs(spark, ("b", 5, "d2")), 2)
    assert rows_of(copy.read(spark)) == [("a", 2, "d1"), ("b", 5, "d2")]


@pytest.mark.parametrize("buckets", [None, 2])
def test_writer_and_compaction_take_turns(spark, tmp_path, buckets):
    rng = random.Random(9)
    by_day = None if buckets else "dt"
    plain, table = (sinks.KeyedTable(str(tmp_path / n), DOC, ["doc_id"], by_day, buckets=buckets) for n in ("plain", "merged"))
    other = sinks.KeyedTable(table.path, DOC, ["doc_id"], by_day, writer="other", buckets=buckets)
    merges = 0
    for batch in range(12):
        rows = docs(spark, *{f"k{rng.randrange(6)}": (f"k{rng.randrange(6)}", batch, f"d{rng.randrange(2)}") for _ in range(5)}.values()).dropDuplicates(["doc_id"])
        rows = sinks.staged(rows, str(tmp_path / f"rows-{batch}"))
        for target in (plain, table):
            target.add(rows, batch)
        if batch == 5:
            late = docs(spark, ("late", 1, "d0"))
            other.add(late, 0)
            sinks.KeyedTable(plain.path, DOC, ["doc_id"], by_day, writer="other", buckets=buckets).add(late, 0)
        if batch % 3 == 2:
            merges += len(sinks.compact_closed(spark, table, None if buckets else "d0", least=2))
        assert rows_of(table.read(spark)) == rows_of(plain.read(spark))
    # The last batch can still be run again.
    again = docs(spark, ("k0", 99, "d0"))
    for target in (plain, table):
        sinks.Attempts(target).clear(spark, 11)
        target.add(again, 11)
    assert rows_of(table.read(spark)) == rows_of(plain.read(spark))
    assert merges >= 3 and table.versions(spark).count() < plain.versions(spark).count()
    if not buckets:
        assert not list((tmp_path / "merged" / "dt=d1").glob("writer=compacted"))


def test_documents_without_id_get_one(spark, tmp_path, messages):
    feed = messages("docs")
    feed.send(({"doc_id": "a", "v": 1}, 0), ({"v": 2}, 0), ({"v": 3}, 0))
    df = decode.decoded(decode.decode(feed.stream(), T.StructType(DOC.fields[:2]))).withColumn("dt", F.lit("d"))
    table = sinks.KeyedTable(str(tmp_path / "docs"), DOC, ["doc_id"], "dt")
    run(spark, sinks.upsert_docs(df, table), tmp_path)
    got = table.read(spark).collect()
    assert sorted(r.v for r in got) == [1, 2, 3] and len({r.doc_id for r in got}) == 3 and None not in {r.doc_id for r in got}


def test_documents_get_the_same_id_when_a_batch_runs_again(spark, tmp_path, messages):
    feed, table = messages("feed"), jobs.document_table(str(tmp_path / "docs"))
    feed.send(({"doc_id": "a", "v": 1, "dt": "2024-01-15"}, 5), ({"v": 2}, 6), ({"v": 2}, 6), ("no json", 7), ("[1]", 7))
    run(spark, jobs.documents(feed.stream(), table), tmp_path)
    first = rows_of(table.versions(spark).drop("written_at"))
    uncommit(tmp_path)
    run(spark, jobs.documents(feed.stream(), table), tmp_path)
    assert rows_of(table.versions(spark).drop("written_at")) == first
    feed.send(({"doc_id": "a", "v": 3, "dt": "2024-01-15"}, 9))
    run(spark, jobs.documents(feed.stream(), table), tmp_path)
    got = table.read(spark).collect()
    assert len(got) == 3 and [r.body for r in got if r.doc_id == "a"] == ['{"doc_id": "a", "v": 3, "dt": "2024-01-15"}']
    assert {r.dt for r in got if r.doc_id.startswith("auto-")} == {"1970-01-01"}


def test_several_outputs_of_one_batch(spark, tmp_path, messages):
    feed = messages("docs")
    feed.send(("x", 0), ("y", 0))
    one, two = [], []
    writer = feed.stream().writeStream.foreachBatch(sinks.split_outputs(lambda b, i: one.append(b.count()), lambda b, i: two.append(b.count())))
    run(spark, writer, tmp_path)
    assert one == two == [2]


def test_archive_has_a_folder_per_day(spark, tmp_path, messages):
    feed = messages("logs")
    feed.send(('{"a":1}', 0), ("bad", 0))
    lines = logs.archive_rows(logs.route(feed.stream(), F.lit(START)))
    run(spark, sinks.archive(lines, str(tmp_path / "lines")), tmp_path)
    assert (tmp_path / "lines" / "log_date=2024-01-15").is_dir()
    assert [r.value for r in spark.read.text(str(tmp_path / "lines")).collect()] == ['{"a":1,"ts":%d}' % START]


def test_kafka_sink_options():
    assert sinks.kafka_options("b:9092", linger="5") == {"kafka.bootstrap.servers": "b:9092", "kafka.acks": "1", "linger": "5"}


def test_console_sink(spark, tmp_path, messages):
    feed = messages("logs")
    feed.send(("x", 0))
    run(spark, sinks.console(feed.stream()), tmp_path)


def test_outputs_leave_the_stream_session_as_it_was(spark, tmp_path, messages):
    """Adaptive planning is on for outputs only; the state plan of the next batch stays fixed."""
    feed = messages("start")
    for i in range(3):
        feed.send(start_log(f"m{i}", START + i))
    seen = []
    table = jobs.dau_table(str(tmp_path / "dau"))

    def spy(batch, batch_id):
        table.add(upper_columns(batch), batch_id)
        seen.append(batch.sparkSession.conf.get("spark.sql.adaptive.enabled"))

    writer = jobs.dau(feed.stream(), table).foreachBatch(sinks.split_outputs(spy))
    run(spark, writer, tmp_path)
    assert len(seen) >= 3 and len(set(seen)) == 1


def feed_folder(tmp_path, name, *messages):
    import json

    folder = tmp_path / name
    folder.mkdir()
    (folder / "1.txt").write_text("".join(json.dumps(m) + "\n" for m in messages))
    return str(folder)


def run_job(tmp_path, job, source, table, *more):
    from shoptide.__main__ import main

    main([job, "--source", source, "--table", str(tmp_path / table), "--checkpoint", str(tmp_path / f"{table}-state"), "--once", *more])


def test_jobs_run_from_the_command_line(spark, tmp_path):
    changes = feed_folder(
        tmp_path,
        "changes",
        {"table": "order_info", "event_type": "INSERT", "rows": [order("1", 0)[0]]},
        {"table": "order_info", "event_type": "DELETE", "rows": [order("2", 0)[0]]},
        {"table": "order_detail", "event_type": "INSERT", "rows": [detail("d1", "1", 0)[0], detail("d2", "1", 0)[0]]},
        {"table": "user_info", "event_type": "UPDATE", "rows": [user("u1", 0, "4")[0]]},
    )
    run_job(tmp_path, "cdc", changes, "topics")
    topic = lambda name: str(tmp_path / "topics" / f"topic={name}")
    run_job(tmp_path, "gmv", topic("order_info"), "orders")
    run_job(tmp_path, "users", topic("user_info"), "users")
    run_job(tmp_path, "sales", topic("order_info"), "sales", "--details", topic("order_detail"), "--users", str(tmp_path / "users"))
    sales = jobs.sale_table(str(tmp_path / "sales")).read(spark)
    assert rows_of(sales, "doc_id", "user_level", "sku_price") == [("1-d1", "4", 3.5), ("1-d2", "4", 3.5)]
    assert rows_of(jobs.order_table(str(tmp_path / "orders")).read(spark), "ID") == [("1",)]

    sent = feed_folder(tmp_path, "logs", {"type": "startup", "mid": "m1"}, {"type": "event", "mid": "m1", "evid": "coupon", "uid": "a"})
    run_job(tmp_path, "logs", sent, "routed")
    run_job(tmp_path, "archive", sent, "archived")
    run_job(tmp_path, "dau", str(tmp_path / "routed" / "topic=startup_log"), "dau")
    run_job(tmp_path, "alerts", str(tmp_path / "routed" / "topic=event_log"), "panes")
    assert rows_of(jobs.dau_table(str(tmp_path / "dau")).read(spark), "MID") == [("m1",)]
    assert rows_of(jobs.pane_table(str(tmp_path / "panes")).read(spark), "mid", "uids") == [("m1", [("a",)])]
    assert spark.read.text(str(tmp_path / "archived")).count() == 2
    bad = feed_folder(tmp_path, "bad", {"ts": "never"}, {"ts": 1})
    run_job(tmp_path, "quarantine", bad, "aside", "--record", "startup")
    assert [r.value for r in spark.read.text(str(tmp_path / "aside")).collect()] == ['{"ts": "never"}']


def test_reports_from_stored_tables(spark, tmp_path, messages, capsys):
    import json

    from shoptide.plans import serving

    starts, orders, details, people = (messages(n) for n in ("start", "orders", "details", "users"))
    starts.send(start_log("m1", START - DAY), start_log("m1", START + 3_600_000), start_log("m2", START + 7_200_000))
    orders.send(order("1", 10), order("2", 10, total_amount="0.5"))
    details.send(detail("d1", "1", 10), detail("d2", "2", 10))
    people.send(user("u1", 0), user("u2", 0, gender="M"))
    dau, sold, known, sales = (str(tmp_path / f"{n}-table") for n in ("dau", "orders", "users", "sales"))
    run(spark, jobs.dau(starts.stream(), jobs.dau_table(dau)), tmp_path, "c1")
    run(spark, jobs.gmv(orders.stream(), jobs.order_table(sold)), tmp_path, "c2")
    run(spark, jobs.users(people.stream(), jobs.user_table(known)), tmp_path, "c3")
    run(spark, jobs.sale_details(orders.stream(), details.stream(), jobs.user_table(known), jobs.sale_table(sales), "2024-01-15"), tmp_path, "c4")

    def ask(*args):
        serving.main([*args, "--date", "2024-01-15", "--dau", dau, "--orders", sold, "--sales", sales])
        return json.loads(capsys.readouterr().out.strip().splitlines()[-1])

    assert ask("total") == [
        {"id": "dau", "name": "新增日活", "value": 2.0},
        {"id": "new_mid", "name": "新增设备", "value": 1.0},
        {"id": "order_amount", "name": "新增交易额", "value": 13.0},
    ]
    assert ask("hours", "--id", "dau") == {"yesterday": {"00": 1.0}, "today": {"01": 1.0, "02": 1.0}}
    assert ask("hours", "--id", "order_amount") == {"yesterday": {}, "today": {"10": 13.0}}
    assert ask("hours", "--id", "nothing") == {"yesterday": None, "today": None}
    got = ask("sales", "--keyword", "plate", "--page", "1", "--size", "1")
    assert got["total"] == 2 and [r["order_detail_id"] for r in got["detail"]] == ["d1"]
    assert got["stat"] == [
        {"title": "年龄占比", "options": [{"name": "20岁以下", "value": 0.0}, {"name": "20岁到30岁", "value": 0.0}, {"name": "30岁以上", "value": 100.0}]},
        {"title": "性别占比", "options": [{"name": "男", "value": 50.0}, {"name": "女", "value": 50.0}]},
    ]
    assert ask("sales", "--keyword", "nothing")["total"] == 0

    # The same from the tables that are kept by day, by hour and by token.
    first, hours, index = (str(tmp_path / n) for n in ("first", "hours", "index"))
    run(spark, jobs.first_seen(starts.stream(), jobs.device_table(f"{first}-devices"), jobs.first_day_table(first)), tmp_path, "c5")
    run(spark, jobs.gmv(orders.stream(), jobs.order_table(f"{sold}-2"), jobs.hour_table(hours)), tmp_path, "c6")
    indexed = jobs.sale_table(f"{sales}-2")
    run(spark, jobs.sale_details(orders.stream(), details.stream(), jobs.user_table(known), indexed, "2024-01-15", index=jobs.token_table(index)), tmp_path, "c7")
    assert ask("total", "--first", first) == ask("total")
    assert ask("hours", "--id", "new_mid", "--first", first) == ask("hours", "--id", "new_mid") == {"yesterday": {"00": 1.0}, "today": {"02": 1.0}}
    assert ask("hours", "--id", "order_amount", "--hours", hours) == ask("hours", "--id", "order_amount")
    paged = ("--page", "1", "--size", "5")
    for keyword in ("plate", "red plate", "nothing", "plate nothing"):
        want = ask("sales", "--keyword", keyword, *paged)
        assert ask("sales", "--keyword", keyword, "--index", index, *paged) == ask("sales", "--keyword", keyword, "--by-relevance", *paged) == want


def test_coupon_and_click_that_come_days_late(spark, messages, tmp_path):
    feed = messages("events")
    feed.send(event("m", "a", "coupon", 0, 0), event("m", "b", "coupon", 1000, 1))
    feed.send(event("x", "z", "coupon", 9 * DAY, 2))
    feed.send(event("m", "c", "coupon", 2000, 3))
    assert stream_alerts(spark, feed, tmp_path).count() == 6
    feed.send(event("m", "a", "clickItem", 500, 4))
    assert stream_alerts(spark, feed, tmp_path).count() == 0


def test_alert_documents_are_stored_and_withdrawn(spark, messages, tmp_path):
    feed = messages("events")
    panes, docs = jobs.pane_table(str(tmp_path / "panes")), jobs.alert_table(str(tmp_path / "docs"))

    def stored():
        run(spark, jobs.coupon_alert_docs(feed.stream(), panes, docs, schema=WITH_SEQ, tie="seq"), tmp_path)
        want = {r.doc_id: (r.uids, r.item_ids, r.events, r.ts) for r in alerts.pane_alerts(panes.read(spark)).collect()}
        got = {r.doc_id: (r.uids, r.item_ids, r.events, r.ts) for r in jobs.standing(docs.read(spark)).collect()}
        assert got == want
        return got

    feed.send(event("m", "a", "coupon", 0, 0), event("m", "b", "coupon", 1000, 1), event("x", "z", "coupon", 9 * DAY, 2))
    assert not stored()
    feed.send(event("m", "c", "coupon", 2000, 3), event("o", "z", "coupon", 5000, 4))
    assert len(stored()) == 6
    feed.send(event("m", "d", "coupon", 240_000, 5))
    assert len(stored()) == 6
    feed.send(event("m", "a", "clickItem", 500, 6))
    assert len(stored()) < 6
    assert docs.read(spark).filter("withdrawn").count() > 0


def uncommit(tmp_path, name="checkpoint"):
    """Take back the commit of the last batch, as if the query had ended between storing it and noting that."""
    commits = tmp_path / name / "commits"
    last = max(int(p.name) for p in commits.iterdir() if p.name.isdigit())
    for path in (commits / str(last), commits / f".{last}.crc"):
        path.unlink(missing_ok=True)


def test_alert_documents_of_a_batch_that_runs_again_are_the_same(spark, messages, tmp_path):
    feed = messages("events")
    panes, docs = jobs.pane_table(str(tmp_path / "panes")), jobs.alert_table(str(tmp_path / "docs"))

    def stored(writer_of=jobs.coupon_alert_docs):
        run(spark, writer_of(feed.stream(), panes, docs, schema=WITH_SEQ, tie="seq"), tmp_path)
        versions = docs.versions(spark).drop("written_at")
        return rows_of(versions), rows_of(jobs.standing(docs.read(spark)).select("doc_id", "uids", "item_ids", "events", "ts"))

    feed.send(event("A", "a", "coupon", 0, 0), event("A", "b", "coupon", 1000, 1), event("A", "c", "coupon", 2000, 2))
    batches = [
        [event("A", "a", "clickItem", 30_000, 3), *[event("B", u, "coupon", 1000, 4 + i) for i, u in enumerate("abc")]],
        [event("A", u, "coupon", DAY + 500_000, 10 + i) for i, u in enumerate("abcd")],
        [event("B", "x", "clickItem", 500, 20), event("C", "x", "coupon", -DAY, 21)],
        [event("C", u, "coupon", -DAY, 22 + i) for i, u in enumerate("yz")],
    ]
    for sent in batches:
        first = stored()
        uncommit(tmp_path)
        assert stored() == first
        feed.send(*sent)
        want = rows_of(alerts.pane_alerts(panes.read(spark)).select("doc_id", "uids", "item_ids", "events", "ts"))
        assert first[1] == want
    stored()
    assert stored()[1] == rows_of(alerts.pane_alerts(panes.read(spark)).select("doc_id", "uids", "item_ids", "events", "ts"))


def test_a_repeated_batch_without_rows_for_a_day_clears_it(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "docs"), DOC, ["doc_id"], "dt")
    table.add(docs(spark, ("a", 1, "d1")), 0)
    table.add(docs(spark, ("b", 1, "d1"), ("c", 1, "d2")), 1)
    other = sinks.KeyedTable(table.path, DOC, ["doc_id"], "dt", writer="other")
    other.add(docs(spark, ("o", 1, "d1")), 7)
    attempts = sinks.Attempts(table)
    attempts.clear(spark, 1)
    attempts.clear(spark, 0)
    assert rows_of(table.read(spark), "doc_id") == [("a",), ("o",)]
    table.add(docs(spark, ("c", 2, "d2")), 1)
    assert rows_of(table.read(spark), "doc_id") == [("a",), ("c",), ("o",)]
    assert rows_of(table.read(spark, before=1), "doc_id") == [("a",), ("o",)]


def test_dau_stores_only_unseen_and_earlier_logs(spark, messages, tmp_path):
    rng = random.Random(3)
    feed, table = messages("start"), jobs.dau_table(str(tmp_path / "dau"))
    sent, corrections, least = [], 0, {}
    for _ in range(20):
        logs_of_batch = [(f"m{rng.randrange(6)}", START + rng.randrange(2 * DAY)) for _ in range(30)]
        sent += logs_of_batch
        first = {}
        for mid, ts in logs_of_batch:
            key = (mid, ts // DAY)
            first[key] = min(ts, first.get(key, ts))
        for key, ts in first.items():
            corrections += key in least and ts < least[key]
            least[key] = min(ts, least.get(key, ts))
        feed.send(*[start_log(*x) for x in logs_of_batch])
    run(spark, jobs.dau(feed.stream(), table), tmp_path)
    batch = dedup.first_per_day(with_log_time(spark.createDataFrame(sent, "mid string, ts bigint")))
    assert rows_of(table.read(spark), "mid", "log_date", "ts") == rows_of(batch, "mid", "log_date", "ts")
    assert table.versions(spark).count() == len(least) + corrections < 20 * 12


def test_new_devices_are_kept_by_day(spark, messages, tmp_path):
    rng = random.Random(4)
    feed = messages("start")
    devices, days = jobs.device_table(str(tmp_path / "devices"), buckets=8), jobs.first_day_table(str(tmp_path / "days"))
    sent = [(f"m{rng.randrange(40)}", START + rng.randrange(6 * DAY)) for _ in range(200)]
    for i in range(0, 200, 40):
        feed.send(*[start_log(*x) for x in sent[i : i + 40]], ({"uid": "no device", "type": "startup", "ts": START}, 0))
        run(spark, jobs.first_seen(feed.stream(), devices, days), tmp_path)
        before = rows_of(days.versions(spark).drop("written_at"))
        uncommit(tmp_path)
        run(spark, jobs.first_seen(feed.stream(), devices, days), tmp_path)
        assert rows_of(days.versions(spark).drop("written_at")) == before
    want = metrics.first_seen(spark.createDataFrame(sent, "mid string, ts bigint"))
    assert rows_of(jobs.standing(days.read(spark)), "mid", "ts", "log_date") == rows_of(want, "mid", "ts", "log_date")
    day = "2024-01-16"
    one = jobs.standing(days.read(spark, folders=[day]))
    assert rows_of(one, "mid") == rows_of(want.filter(F.col("log_date") == day), "mid")
    assert one.inputFiles() and all(f"log_date={day}/" in f for f in one.inputFiles())
    assert rows_of(metrics.new_mid_hours(one, day)) == rows_of(metrics.new_mid_hours(want, day))


def test_hours_follow_every_change_of_an_order(spark, messages, tmp_path):
    rng = random.Random(5)
    feed = messages("orders")
    table, hours = jobs.order_table(str(tmp_path / "sold")), jobs.hour_table(str(tmp_path / "hours"))
    for _ in range(5):
        feed.send(*[order(f"{rng.randrange(25)}", rng.randrange(100), total_amount=f"{rng.randrange(1000)}.{rng.randrange(100):02d}", create_time=f"2024-01-{15 + rng.randrange(2)} 1{rng.randrange(3)}:00:00") for _ in range(20)])
        run(spark, jobs.gmv(feed.stream(), table, hours), tmp_path)
        before = rows_of(hours.versions(spark).drop("written_at"))
        uncommit(tmp_path)
        run(spark, jobs.gmv(feed.stream(), table, hours), tmp_path)
        assert rows_of(hours.versions(spark).drop("written_at")) == before
        sold = table.read(spark)
        for day in ("2024-01-15", "2024-01-16"):
            assert rows_of(metrics.kept_hours(hours.read(spark, folders=[day]), day)) == rows_of(metrics.gmv_hours(sold, day))
            assert hours.read(spark).filter(F.col("create_date") == day).agg(F.sum("orders")).first()[0] == sold.filter(F.col("CREATE_DATE") == day).count()


def test_users_are_looked_up_in_their_buckets(spark, messages, tmp_path):
    feed, table = messages("users"), jobs.user_table(str(tmp_path / "users"))
    for batch in range(3):
        feed.send(*[user(f"u{i}", batch, str(batch)) for i in range(60)])
    run(spark, jobs.users(feed.stream(), table), tmp_path)
    assert table.read(spark).count() == 60
    only = spark.createDataFrame([("u7",), ("u8",), ("u999",)], "id string")
    found = table.read(spark, only=only)
    assert rows_of(found, "id", "user_level") == [("u7", "2"), ("u8", "2")]
    read = {f.split("bucket=")[1].split("/")[0] for f in found.inputFiles() if "bucket=" in f}
    assert 1 <= len(read) <= 3
    assert len({p.name for p in (tmp_path / "users").glob("bucket=*")}) > 20


def test_what_the_sale_job_reads_does_not_grow_with_history(spark, messages, tmp_path, monkeypatch):
    orders, details = messages("orders"), messages("details")
    table, nobody = jobs.sale_table(str(tmp_path / "sales")), jobs.user_table(str(tmp_path / "nobody"))
    opened = []
    versions = sinks.KeyedTable.versions

    def watched(self, spark, folders=None, before=None):
        rows = versions(self, spark, folders, before)
        if self.path.endswith(("-orders", "-items")):
            opened[-1] += len(rows.inputFiles())
        return rows

    monkeypatch.setattr(sinks.KeyedTable, "versions", watched)
    for batch in range(20):
        opened.append(0)
        second = 7200 * batch
        orders.send(order(f"o{batch}", second))
        details.send(detail("d", f"o{batch}", second + 5))
        run(spark, jobs.sale_details(orders.stream(), details.stream(), nobody, table, "2024-01-15"), tmp_path)
    # A batch opens what it has stored itself, as nothing else arrived near it; what a late row opens is its own time.
    assert set(opened) == {2}
    opened.append(0)
    details.send(detail("late", "o3", 3 * 7200 + 60))
    run(spark, jobs.sale_details(orders.stream(), details.stream(), nobody, table, "2024-01-15"), tmp_path)
    assert opened[-1] == 1
    assert rows_of(table.read(spark), "doc_id") == sorted([(f"o{i}-d",) for i in range(20)] + [("o3-late",)])
    uncommit(tmp_path)
    run(spark, jobs.sale_details(orders.stream(), details.stream(), nobody, table, "2024-01-15"), tmp_path)
    assert table.read(spark).count() == 21


def test_of_two_versions_sent_at_once_the_later_stays(spark, tmp_path):
    lines = [m for i in range(40) for m in (user(f"u{i:02d}", 0, "9")[0], user(f"u{i:02d}", 0, "1")[0])]
    run_job(tmp_path, "users", feed_folder(tmp_path, "sent", *lines), "users")
    got = jobs.user_table(str(tmp_path / "users")).read(spark)
    assert got.count() == 40 and got.filter("user_level <> '1'").count() == 0


def test_absent_table_is_empty_and_sales_start_before_users(spark, messages, tmp_path):
    known = jobs.user_table(str(tmp_path / "nobody"))
    assert known.read(spark).count() == 0
    orders, details = messages("orders"), messages("details")
    orders.send(order("1", 10))
    details.send(detail("d1", "1", 10))
    table = jobs.sale_table(str(tmp_path / "sales"))
    run(spark, jobs.sale_details(orders.stream(), details.stream(), known, table, "2024-01-15"), tmp_path)
    assert rows_of(table.read(spark), "doc_id", "user_known") == [("1-d1", False)]


def test_the_day_comes_before_the_batch(spark, tmp_path):
    table = sinks.KeyedTable(str(tmp_path / "docs"), DOC, ["doc_id"], "dt")
    for i in range(6):
        table.add(docs(spark, ("a", i, "d1"), (f"b{i}", i, f"e{i}")), i)
    days = sorted(p.name for p in (tmp_path / "docs").glob("dt=*"))
    assert days == ["dt=d1", *[f"dt=e{i}" for i in range(6)]]
    assert rows_of(table.read(spark).filter("dt = 'd1'")) == [("a", 5, "d1")]
    assert len(table.versions(spark).filter("dt = 'e3'").inputFiles()) >= 1
    assert len(list((tmp_path / "docs" / "dt=e3").rglob("*.parquet"))) == 1


def test_raw_logs_and_change_entries_that_do_not_parse_are_kept(spark, tmp_path):
    folder = tmp_path / "raw"
    folder.mkdir()
    (folder / "1.txt").write_text('{"type":"startup"}\nno json\n')
    run_job(tmp_path, "quarantine", str(folder), "bad-logs", "--record", "log")
    assert [r.value for r in spark.read.text(str(tmp_path / "bad-logs")).collect()] == ["no json"]
    run_job(tmp_path, "quarantine", str(folder), "bad-changes", "--record", "change")
    assert [r.value for r in spark.read.text(str(tmp_path / "bad-changes")).collect()] == ["no json"]


def test_stored_alerts_of_a_day(spark, messages, tmp_path):
    from shoptide.plans import serving

    feed = messages("events")
    # Coupons just before midnight: their windows end on the next day.
    feed.send(*[event("m", u, "coupon", i * 1000 - 60_000, i) for i, u in enumerate("abc")])
    table = jobs.pane_table(str(tmp_path / "panes"))
    run(spark, jobs.coupon_panes(feed.stream(), table, schema=WITH_SEQ, tie="seq"), tmp_path)
    serving.main(["alerts", "--date", "2024-01-15", "--panes", table.path, "--out", str(tmp_path / "out")])
    assert spark.read.json(str(tmp_path / "out")).count() == 5
    assert serving.stored_alerts(spark, table.path, "2024-01-14").count() == 1
    # The same from stored documents, of which a late click withdraws some.
    docs = jobs.alert_table(str(tmp_path / "docs"))
    run(spark, jobs.coupon_alert_docs(feed.stream(), table, docs, schema=WITH_SEQ, tie="seq"), tmp_path, "docs-checkpoint")
    assert serving.stored_alerts(spark, "", "2024-01-15", docs.path).count() == 5
    serving.main(["alerts", "--date", "2024-01-14", "--docs", docs.path, "--out", str(tmp_path / "before")])
    assert spark.read.json(str(tmp_path / "before")).count() == 1
    feed.send(event("m", "a", "clickItem", -50_000, 9))
    run(spark, jobs.coupon_alert_docs(feed.stream(), table, docs, schema=WITH_SEQ, tie="seq"), tmp_path, "docs-checkpoint")
    assert serving.stored_alerts(spark, "", "2024-01-15", docs.path).count() == 0
