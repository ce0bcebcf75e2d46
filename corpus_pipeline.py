"""A training corpus from ``documents``: language, quality, exact copies, near copies, packed sequences."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shoptide.llm import exact_dedup, jaccard_join, language_id, packing, quality
from shoptide.llm.common import prepare, table, without, written
from shoptide.llm.queries import held_out

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# Near copies: distinct shingles of five words, Jaccard similarity of 80 percent or more.
NEAR_WORDS, NEAR_PERCENT = 5, 80


def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in one of the learned languages. Those without a letter go, null and empty texts among them, and those whose
    phrase rate is nearer to that of foreign texts than to their language's; texts too short to tell stay. Rows are judged each
    on their own, repeated or without id; nothing is learned from an empty table and nothing kept of it."""
    prepare(spark)
    learned = docs.filter(~held_out())
    model = language_id.calibrated(language_id.train(learned), learned)
    return language_id.predict(docs, model, keep=COLUMNS).filter("known").select(*COLUMNS)


def keep_good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than not by text, host and path. Rows are judged each on their own; null texts count as
    empty ones, null sources and languages as a site of their own. Without labels all are as likely as not and stay."""
    labels = table(spark, sf_dir, "labels")
    found = quality.quality(docs, labels, host=F.col("source"), path=F.concat_ws("/", "source", "lang"), keep=COLUMNS)
    return found.filter("kept").select(*COLUMNS)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts, the one with the smallest id, null last; of rows that repeat an id and a text the
    first by place."""
    prepare(spark)
    gone = written(exact_dedup.exact_dedup(docs).filter("NOT survivor").select("file", "row"), "copies")
    rows = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return without(rows, gone, ["file", "row"]).select(*COLUMNS)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies, the one with the smallest id. Rows without words are near to nothing and stay, as do
    rows that repeat an id with another text; null ids stand behind all others."""
    prepare(spark)
    found = jaccard_join.jaccard_components(docs, words=NEAR_WORDS, percent=NEAR_PERCENT)
    gone = written(found.filter("NOT survivor").select("file", "row"), "near-copies")
    rows = docs.select(*COLUMNS, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("row"))
    return without(rows, gone, ["file", "row"]).select(*COLUMNS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces in sequences of 2048. Every row is packed, null ids and repeated ones too; a null text is the end id alone."""
    prepare(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [
    ("language ID", keep_known_language),
    ("quality classifier", keep_good_quality),
    ("exact dedup", drop_copies),
    ("near dedup", drop_near_copies),
    ("packing", pack),
]
# Models and tokenizers decide here, which SQL cannot express; the tests compare with a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after the other, each over what the last one wrote."""
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = written(docs, "pipeline")
    return docs
