"""Helpers shared by the operators: scratch tables, batching of Arrow rows, connected components."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shoptide.operators.keyed import SLOTS, near_keys
from shoptide.session import new_run_dir, tune


# Bytes that are sent to Python at once; a task holds several copies of them. Narrow rows still come by the ten thousand.
BYTES_AT_ONCE = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Give the session the settings that the operators count on."""
    tune(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BYTES_AT_ONCE))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    prepare(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once to the shared folder and read back: lineage ends here, and a lost executor costs no
    recomputation of what lies before."""
    spark = df.sparkSession
    path = new_run_dir(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def without(df: DataFrame, gone: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of ``df`` whose ``keys`` are not in ``gone``; null keys are in no table.

    Keys of ``gone`` are hashed to a fixed number of slots. Rows of free slots pass at once; only the others are
    shuffled for the exact anti join, so that wide rows mostly stay where they are.
    """
    slot = F.pmod(F.xxhash64(*keys), F.lit(SLOTS))
    taken = F.broadcast(gone.select(slot.alias("_slot")).distinct())
    free = df.withColumn("_slot", slot).join(taken, "_slot", "left_anti").drop("_slot")
    return free.unionByName(near_keys(df, gone, keys).join(gone.select(*keys), keys, "left_anti").select(*df.columns))


def numbered(df: DataFrame, order: list[Column], name: str, as_name: str) -> DataFrame:
    """``df`` with its rows numbered from 1 in ``order`` as the column ``name``.

    Rows are dealt out by range and written once. Each range is numbered on its own and starts where the ones before
    it end; only their sizes, one number per task, come to the driver. Give an order without ties, so that a hot
    value is spread over ranges.
    """
    spark = df.sparkSession
    ranged = df.repartitionByRange(*order).withColumn("_part", F.spark_partition_id())
    ranged = written(ranged, as_name)
    sizes = ranged.groupBy("_part").count()
    start, starts = 0, []
    for part, size in sorted(sizes.collect()):
        starts.append((part, start))
        start += size
    before = F.broadcast(spark.createDataFrame(starts, "_part int, _start long"))
    row = F.row_number().over(Window.partitionBy("_part").orderBy(*order))
    return ranged.join(before, "_part").withColumn(name, F.col("_start") + row).drop("_part", "_start")


def whole_runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[pa.RecordBatch, list[tuple[int, int]]]]:
    """Batches of rows sorted by their first ``keys`` integer columns, cut so that no run of equal keys is split,
    each with the (start, end) of its runs. Only the run that a batch ends with is held back."""
    import numpy as np

    def ready(table: pa.Table):
        batch = table.combine_chunks().to_batches()[0]
        new = np.zeros(batch.num_rows, bool)
        new[0] = True
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            new[1:] |= column[1:] != column[:-1]
        first = np.flatnonzero(new).tolist()
        return batch, list(zip(first, [*first[1:], batch.num_rows], strict=True))

    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        same = np.ones(batch.num_rows, bool)
        for k in range(keys):
            column = batch.column(k).to_numpy(zero_copy_only=False)
            same &= column == column[-1]
        cut = int(np.argmax(same))
        if held and (cut or any(held[-1].column(k)[-1].as_py() != batch.column(k)[-1].as_py() for k in range(keys))):
            yield ready(pa.Table.from_batches([*held, batch.slice(0, cut)]))
            held = []
        elif cut:
            yield ready(pa.Table.from_batches([batch.slice(0, cut)]))
        held.append(batch.slice(cut))
    if held:
        yield ready(pa.Table.from_batches(held))


def components(edges: DataFrame, name: str) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): one row (node, component) per node, the component
    being its smallest node.

    Alternating large-star and small-star steps; each step is an aggregation and a join on the node, so no
    node's links are gathered, and a hot node's join is split at run time. Every round is written to the
    shared folder, and the loop ends when a round changes nothing. Self links are allowed; null ends are left
    out; an empty table gives an empty table.
    """
    links = edges.filter("a IS NOT NULL AND b IS NOT NULL AND a <> b").selectExpr("least(a, b) AS lo", "greatest(a, b) AS hi")
    links = written(links.distinct(), name)
    mark = None
    while True:
        # Large star: every larger neighbour of a node is linked to the node's smallest neighbour.
        both = links.selectExpr("hi AS u", "lo AS v").unionByName(links.selectExpr("lo AS u", "hi AS v"))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.filter("v > u").join(least, "u").selectExpr("m AS lo", "v AS hi").distinct()
        # Small star: a node and its smaller neighbours are linked to the smallest of them.
        least = large.groupBy("hi").agg(F.min("lo").alias("m"))
        small = large.join(least, "hi").filter("lo <> m").selectExpr("m AS lo", "lo AS hi")
        links = written(small.unionByName(least.selectExpr("m AS lo", "hi")).distinct(), name)
        seen = links.agg(F.count("*"), F.sum(F.xxhash64("lo", "hi").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    roots = links.select(F.col("lo").alias("node")).distinct().withColumn("component", F.col("node"))
    return links.select(F.col("hi").alias("node"), F.col("lo").alias("component")).unionByName(roots)
