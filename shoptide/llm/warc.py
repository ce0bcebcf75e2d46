"""Web archive addressed by content: payload bytes are stored once per SHA-256, record headers apart from them,
and the original records are put together again by a join. Built-in functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.operators.keyed import SLOTS, near_keys
from shoptide.session import new_run_dir

# Payloads under this many bytes are never made a reference to another record.
LEAST_SHARED = 100
# Fixed values of the WARC 1.1 format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"


@dataclass
class Archive:
    """Where an archive lies: a folder of record headers and one of payloads."""

    headers: str
    payloads: str


def _header(record_type: Column, page_id: Column, url: Column, digest: Column, length: Column, refers_to: Column) -> Column:
    """The exact header bytes of a record as text, up to and with the empty line that ends it."""
    line = lambda name, value: F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))
    record = lambda value: F.concat(F.lit("<urn:page:"), value.cast("string"), F.lit(">"))
    revisit = F.when(refers_to.isNotNull(), F.concat(line("WARC-Refers-To", record(refers_to)), line("WARC-Profile", F.lit(PROFILE)))).otherwise("")
    # Line ends inside a URL would break the header and are percent-encoded.
    safe_url = F.replace(F.replace(F.coalesce(url, F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    return F.concat(
        F.lit("WARC/1.1\r\n"), line("WARC-Type", record_type), line("WARC-Record-ID", record(F.coalesce(page_id.cast("string"), F.lit("")))),
        line("WARC-Date", F.lit(DATE)), line("WARC-Target-URI", safe_url), line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), digest)),
        revisit, line("Content-Type", F.lit("text/html; charset=utf-8")), line("Content-Length", length.cast("string")), F.lit("\r\n"))


def write_archive(pages: DataFrame, *, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> Archive:
    """Write a record per row. A null payload is empty. Of records with equal payloads of at least
    ``LEAST_SHARED`` bytes the one with the smallest id is the response and the others revisit it; a null id
    is larger than any other. Rows that repeat the response's id and payload are responses too. Other columns
    are not read, whatever their names; an empty table makes an empty archive.

    Which record is the response is decided on digests alone. Payload bytes are shuffled only where a digest
    may occur more than once (a filter of fixed size tells); all others go straight from the scan to the store.
    """
    spark = pages.sparkSession
    run = new_run_dir(spark, "warc")
    payload = F.encode(F.coalesce(F.col(payload_col), F.lit("")), "UTF-8")
    source = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url"), payload.alias("payload"))
    source = source.withColumn("digest", F.sha2("payload", 256)).withColumn("bytes", F.length("payload").cast("long"))
    narrow = source.select("_id", "_url", "digest", "bytes")
    counts = narrow.groupBy("digest").agg(F.min("_id").alias("first"), F.count("*").alias("n"))
    shared = counts.filter("n > 1")

    revisit = (F.col("n").isNotNull()) & (F.col("bytes") >= LEAST_SHARED) & ~F.col("_id").eqNullSafe(F.col("first"))
    records = narrow.join(shared, "digest", "left").select(
        "_id", "_url", "digest", "bytes", F.when(revisit, "revisit").otherwise("response").alias("record_type"), F.when(revisit, F.col("first")).alias("refers_to"))
    header = _header(F.col("record_type"), F.col("_id"), F.col("_url"), F.col("digest"), F.col("bytes"), F.col("refers_to"))
    records.select("_id", "record_type", "refers_to", "digest", "bytes", header.alias("header")).write.option("compression", "zstd").parquet(f"{run}/headers")

    slot = near_keys(source.select("digest", "payload"), shared, ["digest"])
    alone = source.select("digest", "payload").join(F.broadcast(_slots(shared)), _slot() == F.col("_taken"), "left_anti")
    once = slot.groupBy("digest").agg(F.first("payload").alias("payload"))
    alone.unionByName(once).write.option("compression", "zstd").parquet(f"{run}/payloads")
    return Archive(f"{run}/headers", f"{run}/payloads")


def _slot() -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(SLOTS))


def _slots(shared: DataFrame) -> DataFrame:
    return shared.select(_slot().alias("_taken")).distinct()


def read_archive(spark: SparkSession, archive: Archive, *, id_col: str = "page_id") -> DataFrame:
    """Every original record: (id, record_type, refers_to, header, payload, payload_digest, payload_bytes, record).

    Headers and payloads are joined by digest; ``record`` is the whole record as it would stand in a file. A
    record whose payload is missing or does not have the header's digest and length ends the job.
    """
    headers, payloads = spark.read.parquet(archive.headers), spark.read.parquet(archive.payloads)
    joined = headers.join(payloads, "digest", "left")
    right = (F.sha2("payload", 256) == F.col("digest")) & (F.length("payload") == F.col("bytes"))
    checked = F.when(F.coalesce(right, F.lit(False)), F.col("payload")).otherwise(F.raise_error(F.concat(F.lit("payload does not have digest "), F.col("digest"))))
    out = joined.withColumn("payload", checked)
    end = F.encode(F.lit("\r\n\r\n"), "UTF-8")
    return out.select(
        F.col("_id").alias(id_col), "record_type", "refers_to", "header", "payload", F.sha2("payload", 256).alias("payload_digest"),
        F.length("payload").cast("long").alias("payload_bytes"), F.concat(F.encode("header", "UTF-8"), F.col("payload"), end).alias("record"))
