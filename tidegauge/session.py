"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import sys
import tempfile
import uuid

from pyspark import cloudpickle
from pyspark.sql import SparkSession

#: Bytes of a batch that a stateful operator hands to Python, which holds it more than once.
STATE_BATCH = 16 << 20
ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def local_session(app: str = "tidegauge", cpus: str | int = "*", partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def ship_package(spark: SparkSession) -> SparkSession:
    """Send this package's functions to the Python workers along with each job.

    Not needed where it is installed on all nodes. The worker that a stateful
    stream starts beside the driver does not see ``addPyFile``, hence by value.
    """
    cloudpickle.register_pickle_by_value(sys.modules[__package__])
    return spark


def pin_utc(spark: SparkSession) -> SparkSession:
    """Event times are instants; zone-free input is read as UTC."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def prepare(spark: SparkSession) -> SparkSession:
    """A session of their own for the registered queries; the caller's settings stay as they are.

    On one machine the default of 200 shuffle partitions would open 200 state
    stores per stream; there it becomes one per core. Other values are kept.
    """
    given, spark = spark, spark.newSession()
    for name in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.enabled"):
        spark.conf.set(name, given.conf.get(name))
    if spark.sparkContext.master.startswith("local") and spark.conf.get("spark.sql.shuffle.partitions") == "200":
        spark.conf.set("spark.sql.shuffle.partitions", str(spark.sparkContext.defaultParallelism))
    return ship_package(pin_utc(spark))


def use_rocksdb(spark: SparkSession) -> SparkSession:
    """Keep streaming state on disk instead of on the executor heap.

    A micro-batch then uploads its changes; whole snapshots follow in the
    background. Batches for Python are cut at ``STATE_BATCH`` bytes.
    """
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(STATE_BATCH))
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``, ready for ``DataFrame.checkpoint``.

    Only a local session may go without the setting; it gets a temporary
    folder. On a cluster a machine-local folder would be lost with its
    executor, so a missing setting is an error there.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tidegauge-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, purpose: str) -> str:
    """A path below the shared folder that no earlier run has used."""
    return f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
