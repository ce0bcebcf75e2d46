"""Table scans, as batch or as stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def stream(
    spark: SparkSession, root: str, name: str, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Replay a table (one file or a folder of files) as a stream.

    Without a file limit the files present form one micro-batch.
    """
    path = f"{root}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    # The streaming source takes a single file only through a pattern.
    return reader.parquet(f"{root}/{name}.[p]arquet")


# A file of a replay, and so a task of its micro-batches, has about so many rows while there are cores for more.
REPLAY_ROWS = 10_000


def replay(spark: SparkSession, root: str, name: str, path: str, batches: int = 4) -> DataFrame:
    """Replay a table in about ``batches`` micro-batches whose rows are in no order of time. The rows are dealt out by
    their hash into files below ``path``. A large table has a file per core in each micro-batch, also when it is one file
    itself: a small file is read by one task."""
    df = read(spark, root, name)
    width = max(1, len(df.inputFiles()), min(spark.sparkContext.defaultParallelism, df.count() // (batches * REPLAY_ROWS)))
    df.repartition(batches * width, F.xxhash64(*df.columns)).write.parquet(path)
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", width).parquet(path)


def on_dates(df: DataFrame, column: str, *dates: str) -> DataFrame:
    """Rows of the given days of a date-partitioned table; prunes partitions."""
    return df.filter(F.col(column).isin(*dates))


def upper_columns(df: DataFrame) -> DataFrame:
    return df.toDF(*[name.upper() for name in df.columns])
