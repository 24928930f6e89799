"""Spark session settings and the shared work folder."""
from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import SparkSession

# Runtime settings every job relies on. UTC makes timestamps equal on every machine; AQE coalesces
# small shuffle partitions, splits skewed join partitions and turns joins with a side that proved
# small at run time into broadcasts.
RUNTIME_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # State of de-duplication and hourly counts may outgrow the heap.
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else created."""
    for name, value in RUNTIME_SETTINGS.items():
        spark.conf.set(name, value)
    return spark


def local_session(cores: str = "8", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and measurements."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lakevault")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    spark = configure(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Folders of local sessions whose cluster settings name none, by application.
_local_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it in ``spark.checkpoint.dir``.

    Only a local-mode session may fall back to a folder of its own: on a cluster a machine-local
    path would scatter the data over the executors.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
    application = spark.sparkContext.applicationId
    if application not in _local_folders:
        _local_folders[application] = tempfile.mkdtemp(prefix="lakevault-")
    return _local_folders[application]


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of intermediate data, wherever it is."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def release(spark: SparkSession) -> None:
    """Have Spark drop the shuffle files of frames that nobody holds; it waits for the collectors to find them."""
    gc.collect()
    spark._jvm.System.gc()


def run_folder(spark: SparkSession, label: str) -> str:
    """A new, never reused folder below the shared one."""
    application = spark.sparkContext.applicationId
    return f"{shared_folder(spark)}/lakevault/{application}/{label}-{uuid.uuid4().hex[:10]}"
