"""Streaming sinks: keyed tables, document sets, Kafka, text archive, console.

A keyed table is a folder of Parquet files to which each micro-batch adds its rows in a folder of
its own; the row that counts for a key is chosen on read. Nothing is rewritten, so a batch costs
what it brings, and a batch that is run again after a failure replaces only its own folder.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from shoptide.operators.keyed import first_per_key, near_keys
from shoptide.session import adaptive
from shoptide.sources.tables import upper_columns


def _folder(spark: SparkSession, path: str) -> tuple:
    """The file system of a folder and the folder's path in it."""
    there = spark._jvm.org.apache.hadoop.fs.Path(path)
    return there.getFileSystem(spark._jsc.hadoopConfiguration()), there


@dataclass(frozen=True)
class KeyedTable:
    """``order`` ranks the rows of a key, best first; later batches win among equals.

    ``writer`` names the query that writes. A query that starts over with a new checkpoint needs
    a new name, since its batch numbers start over too. ``partition_by`` gives each value a folder,
    right for live data, where a batch touches a day or two. ``buckets`` gives each hash of a key one, so that a
    lookup of few keys opens few folders. ``cluster_by`` sorts the files by a column; alone it is
    right for a replay of years, where folders per day would be tiny.
    """

    path: str
    schema: T.StructType
    keys: list[str]
    partition_by: str | None = None
    order: list[Column] = field(default_factory=list)
    writer: str = "main"
    cluster_by: str | None = None
    buckets: int | None = None

    def _bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def add(self, batch: DataFrame, batch_id: int) -> None:
        """Add one micro-batch. Running it again replaces the same folders."""
        self._write(batch.select(*self.schema.fieldNames()).withColumn("written_at", F.current_timestamp()), batch_id)

    def _write(self, rows: DataFrame, batch_id: int) -> None:
        rows = rows.withColumns({"writer": F.lit(self.writer), "batch": F.lit(batch_id).cast("bigint")})
        if self.buckets:
            rows = rows.withColumn("bucket", self._bucket())
        # Rebalancing writes few files per day without putting a large day into one task.
        near = [c for c in (self.partition_by, "bucket" if self.buckets else None) if c] or [c for c in (self.cluster_by,) if c]
        with adaptive(rows.sparkSession):
            out = rows.hint("rebalance", *near)
            if self.cluster_by:
                out = out.sortWithinPartitions(*dict.fromkeys([*near, "writer", "batch", self.cluster_by]))
            # The day comes before the batch, so that a reader of a day lists that day's folders only. Only the
            # folders of this batch are replaced.
            folders = [c for c in (self.partition_by, "bucket" if self.buckets else None, "writer", "batch") if c]
            out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*folders).parquet(self.path)

    def clear(self, spark: SparkSession, batch_id: int) -> None:
        """Remove what this writer has stored of ``batch_id`` and later ones: an attempt that did not end. Replacing
        folders would leave those standing that the batch has no rows for any more."""
        files, path = _folder(spark, self.path)
        levels = (self.partition_by is not None) + (self.buckets is not None)
        found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(path, "/".join(["*"] * levels + [f"writer={self.writer}", "batch=*"])))
        for folder in found or []:
            gone = folder.getPath()
            if int(gone.getName().removeprefix("batch=")) < batch_id:
                continue
            files.delete(gone, True)
            # Folders that are left empty go too: a reader tells from folders what they are divided by.
            for _ in range(levels + 1):
                gone = gone.getParent()
                if len(files.listStatus(gone)):
                    break
                files.delete(gone, False)

    def versions(self, spark: SparkSession, folders: list | None = None, before: int | None = None) -> DataFrame:
        """Every row written, with ``written_at``, ``writer`` and ``batch``.

        ``folders`` limits what is listed and read to these values of ``partition_by``, or to these buckets.
        With ``before``, rows of this writer's batches from that number on are left out: what a batch compares
        with then is the table before it, also when it is run again.
        """
        columns = [f for f in self.schema if f.name != self.partition_by]
        full = T.StructType(columns).add("written_at", T.TimestampType()).add("writer", T.StringType()).add("batch", T.LongType())
        if self.partition_by:
            full = full.add(self.schema[self.partition_by])
        if self.buckets:
            full = full.add("bucket", T.IntegerType())
        paths = [self.path] if folders is None else [f"{self.path}/{self.partition_by or 'bucket'}={value}" for value in folders]
        paths = [p for p in paths if self._exists(spark, p)]
        if not paths:
            return spark.createDataFrame([], full)
        rows = spark.read.schema(full).option("basePath", self.path).parquet(*paths)
        return rows if before is None else rows.filter((F.col("writer") != self.writer) | (F.col("batch") < before))

    @staticmethod
    def _exists(spark: SparkSession, path: str) -> bool:
        """A table that no batch has been written to yet reads as empty."""
        files, there = _folder(spark, path)
        return files.exists(there)

    def read(self, spark: SparkSession, only: DataFrame | None = None, folders: list | None = None, before: int | None = None) -> DataFrame:
        """One row per key. A filter on the partition column prunes folders; ``folders`` and ``before`` are those of
        :meth:`versions`.

        ``only`` limits the result to the keys it lists, before rows are shuffled and compared; of a table in
        buckets, to their buckets' folders.
        """
        if only is None:
            return self._best(self.versions(spark, folders, before)).select(*self.schema.fieldNames())
        wanted = only.select(*self.keys).distinct()
        if self.buckets and folders is None:
            folders = sorted(r.bucket for r in wanted.select(self._bucket().alias("bucket")).distinct().collect())
        rows = self.versions(spark, folders, before)
        rows = near_keys(rows, wanted, self.keys).join(wanted, self.keys, "left_semi")
        return self._best(rows).select(*self.schema.fieldNames())

    def _best(self, rows: DataFrame) -> DataFrame:
        keys = list(self.keys)
        if self.partition_by and self.partition_by not in keys:
            keys.append(self.partition_by)
        return first_per_key(rows, keys, [*self.order, F.col("written_at").desc(), F.col("batch").desc()])

    def compact(self, spark: SparkSession, path: str) -> KeyedTable:
        """A copy with one row per key in few files, for when many small batches have piled up.

        Stop the writing query, compact, and start it on the copy with its old checkpoint: its
        next batches count as newer, since rows keep the time they were first written.
        """
        best = self._best(self.versions(spark)).select(*self.schema.fieldNames(), "written_at")
        copy = replace(self, path=path, writer="compacted")
        copy._write(best, 0)
        return replace(self, path=path)


COMPACTED = "compacted"


def compact_closed(spark: SparkSession, table: KeyedTable, up_to: str | None = None, least: int = 8) -> list[str]:
    """Merge the small folders of closed days beside running writers; the days (or buckets) that were merged.

    Of each folder of the table with at least ``least`` batches, up to the day ``up_to``, the rows that count are written once
    more in few files, with the time they were first written. The last batch of every writer is left as it is, since it may be
    run again. Merged folders stay until the next call, for readers that have listed them: until then every row is
    there twice, which changes no answer. A call that is broken off is made good by the next one.
    """
    files, root = _folder(spark, table.path)
    path = spark._jvm.org.apache.hadoop.fs.Path
    column = table.partition_by or "bucket"
    if not files.exists(root):
        return []
    found: dict[str, list[tuple[str, int]]] = {}
    for entry in files.globStatus(path(root, f"{column}=*/writer=*/batch=*")) or []:
        batch = entry.getPath()
        value = batch.getParent().getParent().getName().removeprefix(f"{column}=")
        found.setdefault(value, []).append((batch.getParent().getName().removeprefix("writer="), int(batch.getName().removeprefix("batch="))))
    last: dict[str, int] = {}
    for writer, batch in (b for batches in found.values() for b in batches):
        last[writer] = max(batch, last.get(writer, -1))
    done = []
    for value, batches in sorted(found.items()):
        if up_to is not None and value > up_to:
            continue
        folder = lambda writer, batch, value=value: path(root, f"{column}={value}/writer={writer}/batch={batch}")
        merged = max((b for w, b in batches if w == COMPACTED), default=-1)
        note = path(root, f"_merged/{value}-{merged}")
        if merged >= 0 and files.exists(note):
            for status in files.listStatus(note):
                writer, batch = status.getPath().getName().rsplit("@", 1)
                files.delete(folder(writer, batch), True)
                batches = [b for b in batches if b != (writer, int(batch))]
            files.delete(note, True)
        closed = [(w, b) for w, b in batches if w == COMPACTED or b < last[w]]
        if len(closed) < least:
            continue
        rows = table.versions(spark, folders=[value])
        rows = rows.join(F.broadcast(spark.createDataFrame(closed, "writer string, batch bigint")), ["writer", "batch"], "left_semi")
        best = table._best(rows).select(*table.schema.fieldNames(), "written_at")
        # Noted before they are written, so that a folder of merged rows always says what it stands for.
        note = path(root, f"_merged/{value}-{merged + 1}")
        for writer, batch in closed:
            files.create(path(note, f"{writer}@{batch}"), True).close()
        replace(table, writer=COMPACTED)._write(best, merged + 1)
        done.append(value)
    return done


class Attempts:
    """Clears what an attempt that did not end has left in ``tables``, before a query's first batch. Only the first one
    after a start can be a repetition."""

    def __init__(self, *tables: KeyedTable):
        self.tables: tuple[KeyedTable, ...] = tables

    def clear(self, spark: SparkSession, batch_id: int) -> None:
        for table in self.tables:
            table.clear(spark, batch_id)
        self.tables = ()


def upsert_table(df: DataFrame, table: KeyedTable) -> DataStreamWriter:
    """Keyed upsert into a wide table, whose column names are upper case."""
    return upper_columns(df).writeStream.foreachBatch(table.add)


def upsert_docs(df: DataFrame, table: KeyedTable) -> DataStreamWriter:
    """Upsert of documents by ``doc_id``; a document without one gets a generated id."""

    def add(batch: DataFrame, batch_id: int) -> None:
        table.add(batch.withColumn("doc_id", F.coalesce("doc_id", F.expr("uuid()"))), batch_id)

    return df.writeStream.foreachBatch(add)


def kafka_options(brokers: str, acks: str = "1", **extra: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": brokers, "kafka.acks": acks, **extra}


def kafka(df: DataFrame, brokers: str, **extra: str) -> DataStreamWriter:
    """Messages without key; ``topic`` of each row says where it goes."""
    return df.select("topic", "value").writeStream.format("kafka").options(**kafka_options(brokers, **extra))


def archive(rows: DataFrame, path: str) -> DataStreamWriter:
    """Raw lines as text, one folder per ``log_date``."""
    return rows.select("value", "log_date").writeStream.format("text").partitionBy("log_date").option("path", path)


def console(df: DataFrame, rows: int = 10) -> DataStreamWriter:
    return df.writeStream.format("console").option("numRows", rows).option("truncate", "false")


def staged(batch: DataFrame, path: str) -> DataFrame:
    """The micro-batch, written once and read back.

    For a batch that its own output joins with: the state behind it is then worked through once,
    also when executors are lost. The folder is reused by the next batch.
    """
    batch.write.mode("overwrite").parquet(path)
    return batch.sparkSession.read.schema(batch.schema).parquet(path)


def split_outputs(*outputs: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """Several outputs of one micro-batch, which is computed once."""

    def run(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for output in outputs:
                output(batch, batch_id)
        finally:
            batch.unpersist()

    return run
