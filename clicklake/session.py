"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Spark's own knobs for large, skewed inputs. No master and no memory size: those belong to the
# cluster. Shuffle partition count is left to AQE, which coalesces from the configured maximum.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split skewed join partitions even where that costs one more exchange further up.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.session.timeZone": "UTC",
}


def build_session(app_name: str = "clicklake", **overrides: str) -> SparkSession:
    """A session with :data:`SETTINGS`; ``overrides`` use ``__`` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in overrides.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_root(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names, else one below the warehouse folder.

    Executors must see it: a local warehouse is refused unless the master is local.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        warehouse = spark.conf.get("spark.sql.warehouse.dir")
        is_local = warehouse.startswith("file:") or "://" not in warehouse
        if is_local and not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        root = f"{warehouse.rstrip('/')}/clicklake-scratch"
    if not context.getCheckpointDir():
        context.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path below :func:`scratch_root`; nothing is created."""
    path = f"{scratch_root(spark)}/clicklake-{label}-{uuid.uuid4().hex}"
    _MADE.append(path)
    return path


_MADE: list[str] = []


def clear_scratch(spark: SparkSession) -> int:
    """Remove what was written below the paths of :func:`scratch_path`; tables read from there end.

    Returns how many folders there were.
    """
    removed = 0
    while _MADE:
        path = spark._jvm.org.apache.hadoop.fs.Path(_MADE.pop())
        files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        removed += bool(files.delete(path, True))
    return removed


def streaming_session(spark: SparkSession, state_partitions: int | None = None, restarts: bool = False) -> SparkSession:
    """A sibling session for streams with state; the caller's settings stay as they are.

    The number of state partitions is fixed when a stream first runs, and AQE cannot change it: by
    default one per core. State is kept in RocksDB, so it may outgrow the executors' memory.

    A batch notes the changes of its state. For a stream that is started anew every few batches (``restarts``) it stores
    the state's new files instead: a start reads the state as it is, not all changes since the stream began. The rows
    of the state are not counted then, which takes a look-up for each change, and files that the last two batches do not
    need are removed every few seconds.
    """
    session = spark.newSession()
    partitions = state_partitions or spark.sparkContext.defaultParallelism
    session.conf.set("spark.sql.shuffle.partitions", str(partitions))
    session.conf.set(
        "spark.sql.streaming.stateStore.providerClass",
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    )
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", str(not restarts).lower())
    session.conf.set("spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows", str(not restarts).lower())
    if restarts:
        session.conf.set("spark.sql.streaming.minBatchesToRetain", "2")
        session.conf.set("spark.sql.streaming.stateStore.maintenanceInterval", "5s")
    return session


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
