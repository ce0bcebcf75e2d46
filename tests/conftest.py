from __future__ import annotations

import json
import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from shoptide.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.driver.memory": "4g",
            "spark.log.level": "ERROR",
        },
    )
    yield session
    session.stop()


@pytest.fixture
def messages(spark, tmp_path):
    """A feed of JSON messages: each call of ``send`` adds the file of one micro-batch."""

    class Feed:
        def __init__(self, name: str):
            self.folder = tmp_path / name
            self.folder.mkdir()
            self.sent = 0

        def send(self, *rows) -> None:
            """Rows are (message, arrival second); a message is a dict or raw text."""
            self.sent += 1
            path = self.folder / f"{self.sent:05d}.json"
            with open(path, "w") as out:
                for value, second in rows:
                    text = value if isinstance(value, str) else json.dumps(value)
                    out.write(json.dumps({"value": text, "arrived": second}) + "\n")
            # File times set the order of the batches.
            os.utime(path, (1_700_000_000 + self.sent, 1_700_000_000 + self.sent))

        def stream(self):
            source = spark.readStream.schema("value string, arrived bigint").option("maxFilesPerTrigger", 1)
            return source.json(str(self.folder)).selectExpr("value", "timestamp_seconds(arrived) AS timestamp")

    return Feed


def rows_of(df, *columns):
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
