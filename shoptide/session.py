"""Session building and the shared folder that jobs write their state to."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import cache

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# Settings a session can take on at any time.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot join keys are split at run time; the extra shuffle this may take is cheaper than one
    # giant task.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keep keyed stream state on the executors' disks instead of in their heaps.
    "spark.sql.streaming.stateStore.providerClass": ROCKSDB_PROVIDER,
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

PARTITIONS_PER_CORE = 4


def is_local(spark: SparkSession) -> bool:
    """Whether all tasks run in the driver's process; ``local-cluster`` has executors of its own."""
    master = spark.sparkContext.master
    return master == "local" or master.startswith("local[")


def tune(spark: SparkSession) -> SparkSession:
    """Give an existing session the settings the plans count on."""
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    context = spark.sparkContext
    if not is_local(spark):
        # Batch shuffles start out fine enough for the cluster and are merged by measured size. The
        # number of state partitions is a setting of its own and stays what it is.
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), PARTITIONS_PER_CORE * context.defaultParallelism)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", str(parts))
    return spark


@contextmanager
def adaptive(spark: SparkSession) -> Iterator[None]:
    """Adaptive planning for the output of a micro-batch.

    A stream switches it off for its session, since the number of state partitions is fixed; the
    batch handed to an output no longer depends on that.
    """
    key = "spark.sql.adaptive.enabled"
    before = spark.conf.get(key)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def build_session(app: str = "shoptide", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not is_local(spark):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    return _local_folder()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="shoptide-")


def new_run_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared one, for a run's output and checkpoints."""
    return f"{shared_dir(spark)}/shoptide/{name}-{uuid.uuid4().hex[:12]}"
