"""Rows that every operator must stand: nulls, empty and very long texts, ties, repeated rows, clashing column names."""

from __future__ import annotations

from pyspark.sql import functions as F

LONG = "the quick brown fox jumps over the lazy dog again " * 4000
TEXTS = [
    "the quick brown fox jumps over the lazy dog", "the  quick brown\tfox jumps over the lazy\ndog", "The quick brown fox jumps over the lazy dog", None, "", "   ",
    "word", "two words", "Das ist ein kleiner Text über Bäume", "émoji 🎉🎉 日本語 12345", "<s> <|endoftext|> hi </s>", LONG, LONG + " end", "!!! ??? 123", "a\x1cb c d",
]
CLASHING = ["_id", "_text", "_keep", "digest", "file", "row", "n", "rep", "word", "pos", "h", "keys", "label2", "count", "kept", "lang_pred", "evidence", "host", "path", "p"]


def documents(spark):
    """Texts with ids from 0, a null id, a repeated row, and columns named as the operators name theirs."""
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "no id here at all"), (1, TEXTS[1])]
    df = spark.createDataFrame([(i, t, "en" if i and i % 2 else None, None if i == 3 else "s", None) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumns({c: F.lit("x") for c in CLASHING})


def expected_ids():
    return sorted([*range(len(TEXTS)), -1, 1])


def ids_of(df, column="doc_id"):
    return sorted(-1 if r[0] is None else r[0] for r in df.select(column).collect())
