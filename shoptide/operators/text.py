"""Word count, and a fold over string lengths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def words(text: str | Column) -> Column:
    """Pieces between single spaces; trailing empty pieces are dropped, inner ones are kept."""
    col = F.col(text) if isinstance(text, str) else text
    trimmed = F.rtrim(col)
    only_spaces = (trimmed == "") & (F.length(col) > 0)
    return F.when(only_spaces, F.array().cast("array<string>")).otherwise(F.split(trimmed, " "))


def word_count(df: DataFrame, text: str = "value") -> DataFrame:
    """(word, n)."""
    return df.select(F.explode(words(text)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))


def _digits(number: Column) -> Column:
    return F.length(number.cast("string"))


def fold_lengths(df: DataFrame, group: str, order: str, value: str, zero: str = "0", pick: str = "max") -> DataFrame:
    """(group, folded): per group, ``acc = text(pick(length(acc), length(value)))`` from ``zero``.

    Only the last three values can show in the result: the length of a length of a length is 1,
    whatever the text. So a group limit keeps four rows per group before the shuffle, and no
    group is ever folded as a whole. ``pick`` is ``max`` or ``min``.
    """
    if pick not in ("max", "min"):
        raise ValueError(f"pick must be max or min, not {pick!r}")
    recent = Window.partitionBy(group).orderBy(F.col(order).desc())
    last = (
        df.filter(F.col(value).isNotNull())
        .select(group, order, F.length(value).alias("len"))
        .withColumn("back", F.row_number().over(recent))
        .filter(F.col("back") <= 4)
        .groupBy(group)
        .agg(F.count("*").alias("n"), *[F.max(F.when(F.col("back") == i, F.col("len"))).alias(f"l{i}") for i in (1, 2, 3)])
    )
    start = len(zero)
    start_term = (
        F.when(F.col("n") == 1, F.lit(start))
        .when(F.col("n") == 2, F.lit(len(str(start))))
        .otherwise(F.lit(1))
    )
    choose = F.greatest if pick == "max" else F.least
    # Nulls, the values a short group does not have, are skipped by greatest and least.
    folded = choose(F.col("l1"), _digits(F.col("l2")), _digits(_digits(F.col("l3"))), start_term)
    return last.select(group, folded.cast("string").alias("folded"))


def join_folds(folds: DataFrame, group: str, zero: str = "0") -> DataFrame:
    """One row (folded): ``zero`` and then the result of each group, in group order.

    Takes one short number per group, never the groups' rows.
    """
    ordered = F.array_sort(F.collect_list(F.struct(group, "folded")))
    return folds.agg(F.concat(F.lit(zero), F.array_join(F.transform(ordered, lambda x: x["folded"]), "")).alias("folded"))
