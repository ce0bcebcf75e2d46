from __future__ import annotations

from conftest import rows_of
from pyspark.sql import functions as F

from shoptide.operators import sale_detail as sd


def orders(spark, *ids, at=0):
    rows = [(i, "1001", "2024-01-15 10:00:00", "2024-01-15", f"u{i}", at) for i in ids]
    return spark.createDataFrame(rows, "id string, order_status string, create_time string, create_date string, user_id string, at bigint").withColumn(
        "ingest_ts", F.timestamp_seconds("at")
    )


def details(spark, *rows):
    full = [(i, o, f"sku {i}", f"s{i}", price, at) for i, o, price, at in rows]
    return spark.createDataFrame(full, "id string, order_id string, sku_name string, sku_id string, order_price string, at bigint").withColumn(
        "ingest_ts", F.timestamp_seconds("at")
    )


def users(spark, *rows):
    return spark.createDataFrame(rows, "id string, gender string, birthday string, user_level string")


def test_join_keeps_pairs_only(spark):
    got = sd.join_orders(orders(spark, "1", "2"), details(spark, ("d1", "1", "9.5", 0), ("d2", "1", "x", 0), ("d3", "7", "1", 0)))
    assert rows_of(got, "order_id", "order_detail_id", "sku_price") == [("1", "d1", 9.5), ("1", "d2", 0.0)]


def test_join_status(spark):
    got = sd.join_status(orders(spark, "1", "2"), details(spark, ("d1", "1", "1", 0), ("d2", "1", "1", 0), ("d3", "7", "1", 0), ("d4", None, "1", 0)))
    assert rows_of(got) == [
        ("1", "d1", "both"),
        ("1", "d2", "both"),
        ("2", None, "order_only"),
        ("7", "d3", "detail_only"),
        (None, "d4", "detail_only"),
    ]


def test_interval_join(spark):
    got = sd.join_orders_within(orders(spark, "1", at=1000), details(spark, *[(f"d{t}", "1", "1", t) for t in (879, 880, 1000, 1120, 1121)]))
    assert rows_of(got, "order_detail_id") == [("d1000",), ("d1120",), ("d880",)]


def test_sale_detail_rows(spark):
    got = sd.sale_detail(
        orders(spark, "1", "2"),
        details(spark, ("d1", "1", "9.5", 0), ("d1", "1", "9.5", 3), ("d2", "2", "1", 0)),
        users(spark, ("u1", "F", "1990-01-15", "2")),
        "2024-01-15",
    )
    assert rows_of(got, "order_detail_id", "user_id", "user_gender", "user_age", "user_level", "user_known", "dt") == [
        ("d1", "u1", "F", 34, "2", True, "2024-01-15"),
        ("d2", "u2", None, 0, None, False, "2024-01-15"),
    ]


def test_repeated_item_is_settled_by_its_values(spark):
    both = [("d1", "1", "9.5", 0), ("d1", "1", "3.5", 0)]
    for rows in (both, both[::-1]):
        got = sd.sale_detail(orders(spark, "1"), details(spark, *rows), users(spark, ("u1", "F", "1990-01-15", "2")), "2024-01-15")
        assert rows_of(got, "sku_price") == [(3.5,)]


def test_document_id(spark):
    df = spark.createDataFrame([("7", "d1")], "order_id string, order_detail_id string")
    assert sd.with_doc_id(df).first().doc_id == "7-d1"


def test_hot_order_is_split_and_nothing_is_lost(spark, tmp_path):
    """One order holds most of the items, one user most of the orders."""
    many = spark.range(60_000).select(
        F.concat(F.lit("d"), F.col("id").cast("string")).alias("id"),
        F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise((F.col("id") % 999).cast("string")).alias("order_id"),
        F.sha2(F.col("id").cast("string"), 256).alias("sku_name"),
        F.col("id").cast("string").alias("sku_id"),
        F.lit("1.5").alias("order_price"),
    )
    ids = many.select(F.col("order_id").alias("id")).distinct()
    heads = ids.select("id", *[F.lit(v).alias(n) for n, v in (("order_status", "1"), ("create_time", "2024-01-15 01:00:00"), ("create_date", "2024-01-15"))], F.lit("u").alias("user_id"))
    for name, df in (("items", many), ("heads", heads)):
        df.repartition(8).write.parquet(f"{tmp_path}/{name}")
    many, heads = spark.read.parquet(f"{tmp_path}/items"), spark.read.parquet(f"{tmp_path}/heads")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50KB",
        "spark.sql.shuffle.partitions": "16",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    for key, value in small.items():
        spark.conf.set(key, value)
    try:
        got = sd.sale_detail(heads, many, users(spark, ("u", "M", "1990-01-01", "1")), "2024-01-15")
        assert len(got.select("order_detail_id", "order_id").collect()) == 60_000
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_sales_by_order_counts_as_the_wide_rows_do(spark):
    from shoptide.operators import metrics, search
    from shoptide.plans import queries

    sf = "/root/testdata/sf0.001"
    wide, narrow = queries._sales(spark, sf), queries._order_sales(spark, sf)
    assert rows_of(search.terms(wide, "user_age", 100)) == rows_of(search.terms(narrow, "user_age", 100, "sales"))
    assert rows_of(metrics.share_counts(wide)) == rows_of(metrics.share_counts(narrow, "sales"))


def test_counts_by_user_move_items_once_and_read_no_product(spark):
    from shoptide.plans import queries

    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        plan = queries.QUERIES["gender_terms"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(key, before)
    assert "p_name" not in plan and "p_partkey" not in plan and "l_extendedprice" not in plan
