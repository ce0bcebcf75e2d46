"""User dimension: the latest version of each user."""

from __future__ import annotations

from pyspark.sql import DataFrame

from shoptide.operators.keyed import latest_per_key


def latest(changes: DataFrame, version: str, ties: list[str] | None = None) -> DataFrame:
    return latest_per_key(changes, ["id"], version, ties)
