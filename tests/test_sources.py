from __future__ import annotations

import json

import pytest
from conftest import rows_of
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shoptide import schemas
from shoptide.sources import cdc, decode, kafka, logs, tables


def values(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_decode_types_and_quarantine(spark):
    df = values(
        spark,
        '{"id":"1","total_amount":12.5,"create_time":"2020-07-18 09:00:00","new_field":[1]}',
        '{"id":2,"total_amount":"7.25"}',
        '{"id":"3","total_amount":"seven"}',
        '{"id":"4","total_a',
        "[1,2]",
        "",
        None,
        '{"id":"5","total_amount":null}',
    )
    out = decode.decode(df, schemas.ORDER_INFO)
    assert rows_of(decode.decoded(out), "id", "total_amount", "create_time") == [
        ("1", 12.5, "2020-07-18 09:00:00"),
        ("2", 7.25, None),
        ("5", None, None),
    ]
    assert sorted(r.raw or "" for r in decode.quarantine(out).collect()) == sorted(
        ['{"id":"3","total_amount":"seven"}', '{"id":"4","total_a', "[1,2]", "", ""]
    )


def test_decode_reads_numbers_as_text_and_keeps_columns(spark):
    df = values(spark, '{"mid":"m","pgid":12,"itemid":3,"ts":1700000000000}').withColumn("offset", F.lit(7))
    row = decode.decode(df, schemas.EVENT_LOG, keep=("offset",)).first()
    assert (row.offset, row.pgid, row.itemid, row.ts, row.malformed) == (7, "12", "3", 1700000000000, False)


def feed(spark, *entries):
    return spark.createDataFrame(entries, T.StructType([f for f in schemas.CDC_ENVELOPE if f.name != "entry_type"]))


def test_cdc_routes(spark):
    row = [{"id": "1"}]
    df = feed(
        spark,
        ("order_info", "INSERT", row),
        ("order_info", "UPDATE", row),
        ("order_detail", "INSERT", row),
        ("order_detail", "DELETE", row),
        ("user_info", "INSERT", row),
        ("user_info", "UPDATE", row),
        ("user_info", "DELETE", row),
        ("base_province", "INSERT", row),
    )
    assert rows_of(cdc.route(df), "topic", "event_type") == [
        ("order_detail", "INSERT"),
        ("order_info", "INSERT"),
        ("user_info", "INSERT"),
        ("user_info", "UPDATE"),
    ]


def test_cdc_takes_row_entries_only(spark):
    df = feed(spark, ("user_info", "INSERT", [{"id": "1"}]))
    assert cdc.route(df.withColumn("entry_type", F.lit("TRANSACTIONBEGIN"))).count() == 0
    assert cdc.route(df.withColumn("entry_type", F.lit("ROWDATA"))).count() == 1


def test_cdc_flattens_every_row(spark):
    df = feed(spark, ("user_info", "UPDATE", [{"id": "1", "gender": "F"}, {"id": "2", "gender": ""}]))
    got = [(r.topic, json.loads(r.value)) for r in cdc.flatten(cdc.route(df)).collect()]
    assert sorted(got, key=lambda x: x[1]["id"]) == [("user_info", {"id": "1", "gender": "F"}), ("user_info", {"id": "2", "gender": ""})]


def test_logs_are_stamped_and_routed(spark):
    df = values(
        spark,
        '{"type":"startup","mid":"m1","ts":5}',
        '{"type":"event","mid":"m2","pgid":7,"ok":true,"nested":{"a":[1,2]}}',
        '{"mid":"m3"}',
        "{}",
        '{"mid":"x","mid":"m4"}',
        '{"mid":',
    )
    got = [(r.topic, r.malformed, r.value) for r in logs.route(df, F.lit(99)).collect()]
    assert [(t, bad) for t, bad, _ in got] == [
        ("startup_log", False),
        ("event_log", False),
        ("event_log", False),
        ("event_log", False),
        ("event_log", False),
        (None, True),
    ]
    assert [json.loads(v) for _, bad, v in got if not bad] == [
        {"type": "startup", "mid": "m1", "ts": 99},
        {"type": "event", "mid": "m2", "pgid": 7, "ok": True, "nested": {"a": [1, 2]}, "ts": 99},
        {"mid": "m3", "ts": 99},
        {"ts": 99},
        {"mid": "m4", "ts": 99},
    ]
    assert got[5][2] == '{"mid":'


def test_logs_use_the_clock_by_default(spark):
    row = logs.route(values(spark, '{"type":"startup"}')).first()
    assert json.loads(row.value)["ts"] == row.ts > 1_700_000_000_000


def test_archive_rows(spark):
    df = logs.archive_rows(logs.route(values(spark, "{}", "nope"), F.lit(1_705_329_000_000)))
    assert rows_of(df) == [('{"ts":1705329000000}', "2024-01-15")]


def test_kafka_reader_options():
    got = kafka.kafka_options("b1:9092,b2:9092", {"t2", "t1"}, "g", maxOffsetsPerTrigger="1000")
    assert got == {
        "kafka.bootstrap.servers": "b1:9092,b2:9092",
        "subscribe": "t1,t2",
        "startingOffsets": "latest",
        "failOnDataLoss": "true",
        "kafka.group.id": "g",
        "maxOffsetsPerTrigger": "1000",
    }


def test_message_values(spark):
    df = spark.sql("SELECT 't' AS topic, encode('hi', 'utf-8') AS value, timestamp '2024-01-01' AS timestamp, 1 AS offset")
    row = kafka.message_values(df).first()
    assert (row.topic, row.value) == ("t", "hi")


def test_upper_columns_and_date_scan(spark, tmp_path):
    path = str(tmp_path / "orders.parquet")
    spark.createDataFrame([("1", "2024-01-01"), ("2", "2024-01-02")], "id string, create_date string").write.partitionBy("create_date").parquet(path)
    df = tables.read(spark, str(tmp_path), "orders").withColumn("create_date", F.col("create_date").cast("string"))
    assert tables.upper_columns(df).columns == ["ID", "CREATE_DATE"]
    assert tables.on_dates(df, "create_date", "2024-01-02").count() == 1


@pytest.mark.parametrize("folder", [True, False])
def test_table_replay_reads_files_and_folders(spark, tmp_path, folder):
    target = tmp_path / "t.parquet"
    if folder:
        spark.range(10).repartition(3).write.parquet(str(target))
    else:
        spark.range(10).toPandas().to_parquet(target)
    query = tables.stream(spark, str(tmp_path), "t").writeStream.format("memory").queryName(f"replay_{folder}").trigger(availableNow=True).start()
    query.awaitTermination()
    assert spark.table(f"replay_{folder}").count() == 10


def test_logs_keep_numbers_as_sent(spark):
    sent = ('{"mid":"m","price":1.50,"big":' + "9" * 50 + ',"ts":12,"e":1e3}', '{"ts": "x"}', '{ "a" : 1 }', '{"a":{"ts":1},"ts":2}')
    got = [r.value for r in logs.route(values(spark, *sent), F.lit(7)).collect()]
    assert got == ['{"mid":"m","price":1.50,"big":' + "9" * 50 + ',"e":1e3,"ts":7}', '{"ts":7}', '{ "a" : 1,"ts":7}', '{"a":{"ts":1},"ts":7}']


@pytest.mark.parametrize("end", ["\n", "\t", "\r", " ", "\r\n \t"])
def test_logs_with_white_space_around_stay_json(spark, end):
    sent = ('{"a":1}', '{"ts":5}', '{"a":{"ts":3}}', '{"ts":{"x":1},"a":"}"}', "{}", '{"\\u0074s":4,"a":1.50}', "{'a':1}", '{"a":[1,{"ts":2}],"ts":9,"b":",}"}')
    got = logs.route(values(spark, *[end + s + end for s in sent]), F.lit(7)).collect()
    assert not any(r.malformed for r in got)
    assert [json.loads(r.value) for r in got] == [
        {"a": 1, "ts": 7}, {"ts": 7}, {"a": {"ts": 3}, "ts": 7}, {"a": "}", "ts": 7}, {"ts": 7}, {"a": 1.5, "ts": 7}, {"a": 1, "ts": 7}, {"a": [1, {"ts": 2}], "b": ",}", "ts": 7},
    ]


def test_logs_with_something_behind_are_malformed(spark):
    sent = ('{"a":1} x', '{"a":1}}', '{"a":1}]}', '{"a":1} {"b":2}', '{"a":1},{"b":2}', "[{}]", "null", "", "7", None)
    got = logs.route(values(spark, *sent), F.lit(7)).collect()
    assert [(r.malformed, r.topic, r.value) for r in got] == [(True, None, s) for s in sent]


def test_change_entries_that_do_not_parse_are_told_apart(spark):
    df = values(spark, '{"table":"user_info","event_type":"INSERT","rows":[{"id":"1"}]}', "nope", "")
    assert decode.nested(df, schemas.CDC_ENVELOPE).count() == 1
    assert sorted(r.raw for r in decode.unparsed(df, schemas.CDC_ENVELOPE).collect()) == ["", "nope"]


def test_replay_of_a_large_single_file_gives_each_core_a_part(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(tables, "REPLAY_ROWS", 100)
    spark.range(2000).coalesce(1).write.parquet(str(tmp_path / "t.parquet"))
    feed = tables.replay(spark, str(tmp_path), "t", str(tmp_path / "feed"))
    sizes = []
    feed.writeStream.foreachBatch(lambda batch, _: sizes.append((batch.rdd.getNumPartitions(), batch.count()))).option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start().awaitTermination()
    cores = spark.sparkContext.defaultParallelism
    assert cores > 1 and [tasks for tasks, _ in sizes] == [cores] * 4 and sum(n for _, n in sizes) == 2000
