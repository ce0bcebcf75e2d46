"""Exact de-duplication as a stream with keyed state on disk that never expires."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shoptide.llm.common import written
from shoptide.operators.keyed import near_keys
from shoptide.session import ROCKSDB_PROVIDER, new_run_dir

WHITE_SPACE = r"[\x20\x09-\x0D]+"
LOCATOR = ["file", "row"]
# State on the executors' disks. Without pre-allocation a store takes the disk that its keys need, not 4 MB per
# partition at least.
STATE_CONF = {
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
}


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), WHITE_SPACE, " ")


def sha256(text: Column) -> Column:
    return F.sha2(F.encode(text, "UTF-8"), 256)


def located(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _text, file, row): every row with the place of its text, a file and the row's number in it. Rows that
    do not come straight from Parquet files are written to the shared folder first."""
    columns = [F.col(id_col).alias("_id"), F.col(text_col).alias("_text")]
    place = [F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row")]
    if docs.inputFiles():
        try:
            return docs.select(*columns, *place)
        except AnalysisException:  # its rows have been through a join or an aggregation
            pass
    return written(docs.select(*columns), "texts").select("_id", "_text", *place)


def digest_state(narrow: DataFrame, files_per_trigger: int = 16) -> DataFrame:
    """(digest, keep_id, file, row, group_size) after all micro-batches over the stored table ``narrow``.

    The state is a streaming aggregation in RocksDB keyed by the digest, with no watermark: a digest stays
    known forever. It keeps the smallest identifier, where that row's text lies, and a count. Every micro-batch
    is combined within its tasks before the shuffle, so a digest that holds a third of all rows sends one row per
    task. Each batch writes only the keys that it changed; the last version of a key is the one with the
    highest count.
    """
    spark = narrow.sparkSession
    run = new_run_dir(spark, "exact-dedup")
    path = narrow.inputFiles()[0].rsplit("/", 1)[0]
    stream = spark.readStream.schema(narrow.schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)
    first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), *LOCATOR)).alias("first")
    state = stream.groupBy("digest").agg(first, F.count("*").alias("group_size"))
    state = state.select("digest", F.col("first._id").alias("keep_id"), "first.file", "first.row", "group_size")
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{run}/versions/batch={number}")

    try:
        query = (state.writeStream.outputMode("update").foreachBatch(keep)
                 .option("checkpointLocation", f"{run}/checkpoint").trigger(availableNow=True).start())
        query.awaitTermination()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    versions = spark.read.schema(state.schema).parquet(f"{run}/versions/batch=*")
    # Within a key the count rises with every version and the kept identifier only falls.
    last = F.max_by(F.struct("keep_id", *LOCATOR), "group_size")
    return (versions.groupBy("digest").agg(last.alias("at"), F.max("group_size").alias("group_size"))
            .select("digest", "at.keep_id", "at.file", "at.row", "group_size"))


def exact_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", digest=sha256,
                files_per_trigger: int = 16) -> DataFrame:
    """One row per row of ``docs``: (id, keep_id, group_size, kept, text_sha256, survivor, file, row).

    Texts are equal when they are identical after each run of ASCII white space becomes one space; a null text
    is an empty one. The smallest identifier of equal texts stays; a null identifier is larger than any other.
    Rows that repeat an identifier and a text are all counted, and all of them are ``kept`` when their
    identifier is the one that stays; ``survivor`` holds for exactly one row of a group. Other columns are not read, whatever their
    names. An empty table gives an empty table.

    Rows that share a digest are compared byte by byte with the text found at the group's locator. Rows that
    differ from it are grouped again by their full texts, so that colliding digests do not merge texts;
    ``digest`` can be replaced by a weaker one to test that.
    """
    source = located(docs, id_col, text_col).withColumn("_text", normalised(F.col("_text")))
    source = source.withColumn("digest", digest(F.col("_text")))
    narrow = written(source.select("_id", "digest", sha256(F.col("_text")).alias("text_sha256"), *LOCATOR), "digests")
    state = written(digest_state(narrow, files_per_trigger), "digest-state")

    # Full bytes are checked on hits only, the groups with more than one row.
    hits = state.filter("group_size > 1").select("digest", *LOCATOR)
    texts = near_keys(source, hits, ["digest"])
    held = texts.join(hits, ["digest", *LOCATOR]).select("digest", F.col("_text").alias("held"))
    other = written(texts.join(held, "digest").filter("_text <> held").drop("held"), "collisions")

    at = F.struct(*LOCATOR)
    out = narrow.join(state.select("digest", "keep_id", "group_size", at.alias("at")), "digest")
    if not other.isEmpty():
        first = F.min(F.struct(F.col("_id").isNull().alias("none"), F.col("_id"), *LOCATOR)).alias("first")
        regrouped = other.groupBy("digest", "_text").agg(first, F.count("*").alias("other_size"))
        moved = other.join(regrouped, ["digest", "_text"]).select(*LOCATOR, F.col("first._id").alias("other_id"), F.struct("first.file", "first.row").alias("other_at"), "other_size")
        gone = other.groupBy("digest").agg(F.count("*").alias("gone"))
        moves = F.col("other_size").isNotNull()
        out = (out.join(moved, LOCATOR, "left").join(gone, "digest", "left")
               .withColumn("at", F.coalesce("other_at", "at"))
               .withColumn("keep_id", F.when(moves, F.col("other_id")).otherwise(F.col("keep_id")))
               .withColumn("group_size", F.when(moves, F.col("other_size")).otherwise(F.col("group_size") - F.coalesce("gone", F.lit(0)))))
    kept = F.col("_id").eqNullSafe(F.col("keep_id"))
    return out.select(F.col("_id").alias(id_col), "keep_id", "group_size", kept.alias("kept"), "text_sha256", (at == F.col("at")).alias("survivor"), *LOCATOR)
