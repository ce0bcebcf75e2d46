"""One row per key: the building block of de-duplication and of keyed upserts. And a bounded filter
that keeps rows from a shuffle they would not survive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key in the given order.

    Spark turns ``row_number() = 1`` into a group limit that runs before the shuffle, so each task
    sends one row per key however many rows the key has.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def latest_per_key(df: DataFrame, keys: list[str], version: str, ties: list[str] | None = None) -> DataFrame:
    """The row of the highest ``version`` for each key; equal versions are settled by ``ties``."""
    order = [F.col(version).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in ties or []]
    return first_per_key(df, keys, order)


# A slot is one long: the set of all slots is 8 MB, however many keys fall into them.
SLOTS = 1 << 20


def near_keys(df: DataFrame, wanted: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose keys may be among those of ``wanted``: all that are, and few others.

    Keys are hashed to a fixed number of slots, so what is broadcast has a fixed bound. Put it
    before a join of a large table with few keys that may still be too many to broadcast; the
    join then shuffles only rows that have a chance. Key types must agree on both sides.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    taken = wanted.select(slot.alias("_slot")).distinct()
    return df.withColumn("_slot", slot).join(F.broadcast(taken), "_slot", "left_semi").drop("_slot")
