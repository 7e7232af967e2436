"""Spark session settings the library relies on."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession

# Settings every job needs, whatever the cluster:
#  * UTC session: timestamps are wall-clock (timestamp_ntz) and epoch
#    arithmetic casts them through the session zone.
#  * AQE with skew-join splitting and partition coalescing.
#  * dynamic partition overwrite, so a rerun replaces exactly its own days.
#  * partition columns stay strings ("01", not 1).
REQUIRED_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "snappy",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings the operators assume to an existing session."""
    for key, value in REQUIRED_CONF.items():
        spark.conf.set(key, value)
    return spark


# Shuffle bytes per input byte of the dwell job: the bucketed window copies
# each event into about 2.1 buckets (2 h buckets, 90 min back + 45 min ahead).
HALO_FACTOR = 2.2
TARGET_PARTITION_BYTES = 128 * 1024 * 1024


def configure_for_input(spark: SparkSession, input_bytes: int,
                        target_partition_bytes: int = TARGET_PARTITION_BYTES) -> int:
    """Size shuffles for a day of ``input_bytes`` of trace (compressed Parquet).

    Sets ``spark.sql.shuffle.partitions`` so that the largest shuffle (events
    with their halo copies) lands near ``target_partition_bytes`` per partition
    before AQE coalesces small ones, file splits of the same size, and the AQE
    skew-join thresholds relative to it.  Returns the partition count.
    """
    n = max(200, int(input_bytes * HALO_FACTOR // target_partition_bytes) + 1)
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", str(4 * target_partition_bytes))
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "4")
    return n


def local_session(cores: int | str = "*", shuffle_partitions: int = 8,
                  app_name: str = "footfall") -> SparkSession:
    """Session for tests and the local benchmark (no UI, small shuffles)."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("FOOTFALL_DRIVER_MEMORY", "16g"))
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in REQUIRED_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    configure(spark)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def checkpoint_dir(spark: SparkSession) -> str | None:
    """The shared folder the cluster names for checkpoints, if any."""
    value = spark.sparkContext.getCheckpointDir()
    if value:
        return value
    return spark.conf.get("spark.checkpoint.dir", None) or None


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the session's checkpoint folder; create a private one only when unset.

    On a cluster the folder comes from ``spark.checkpoint.dir`` (shared storage).
    Only a session without one (tests, local runs) gets a fresh temporary folder,
    set on the SparkContext (the conf key itself is fixed at startup).
    """
    current = checkpoint_dir(spark)
    if current is None:
        if not spark.sparkContext.master.partition("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        current = tempfile.mkdtemp(prefix="footfall-ckpt-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(current)
    return current


_SHIPPED: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the session's Python workers this package (once per application).

    Functions that run in Python workers are pickled by their module's name, so the workers
    must be able to import it; a zip of the sources goes through Spark's own file server.
    """
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = os.path.dirname(os.path.abspath(__file__))
    name = os.path.join(os.path.realpath(tempfile.mkdtemp(prefix="footfall-zip-")), "footfall.zip")
    with zipfile.ZipFile(name, "w") as z:
        for folder, _, files in os.walk(package):
            for f in files:
                if f.endswith(".py"):
                    z.write(os.path.join(folder, f),
                            os.path.join("footfall", os.path.relpath(os.path.join(folder, f), package)))
    sc.addPyFile(name)
    _SHIPPED.add(sc.applicationId)
