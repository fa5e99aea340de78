"""Session settings the jobs rely on, and the shared folder they may write to."""

from __future__ import annotations

import math
import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

ZONE = "spark.sql.session.timeZone"
STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"

SETTINGS = {
    # Event times carry no zone of their own; every job reads them as UTC.
    ZONE: "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    # Deduplication state lives on local disk, not on the executor heap.
    STATE_STORE: (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    CHANGELOG: "true",
}


def shuffle_partitions(input_bytes: int, cores: int, target_bytes: int = 128 << 20) -> int:
    """Partitions of about ``target_bytes``, in whole waves of the cluster's cores.

    Adaptive execution merges partitions that turn out small but cannot add
    any, so large inputs need the number up front.
    """
    wanted = max(1, math.ceil(input_bytes / target_bytes))
    return math.ceil(wanted / cores) * cores


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Size of the files below a path, from the file listing."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    return files.agg(F.sum("length")).first()[0] or 0


def state_partitions(state_bytes: int, target_bytes: int = 128 << 20) -> int:
    """State partitions for a stream by the size of the state it will hold, which is
    what arrives within its delay. The number is fixed when a query first starts, so
    size it for the largest state expected, not for the cores there are just now."""
    return max(1, math.ceil(state_bytes / target_bytes))


def apply_settings(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def prepare(spark: SparkSession) -> SparkSession:
    """Give an existing session the UTC zone, which results depend on, and a state
    store that keeps deduplication state off the heap."""
    if spark.conf.get(ZONE) != "UTC":
        spark.conf.set(ZONE, "UTC")
    if "RocksDB" not in spark.conf.get(STATE_STORE):
        spark.conf.set(STATE_STORE, SETTINGS[STATE_STORE])
        spark.conf.set(CHANGELOG, SETTINGS[CHANGELOG])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """A new folder below the one the cluster names in ``spark.checkpoint.dir``, or,
    where that is unset, below the warehouse. Off a local master that could be a folder
    of the driver's own machine, so there the cluster must name one."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors reach")
        base = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/work"
    return f"{base.rstrip('/')}/tollbook-{uuid.uuid4().hex}"
