"""Session for local work, and the shared folder that jobs write to."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cpus="*", shuffle_partitions=8) -> SparkSession:
    """A single-machine session for tests and the benchmark; on a cluster, pass in its own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tagpulse")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        # the state of live queries on disk, not in the heap, and only its changes written per batch
        .config("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
        .config("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder in `spark.checkpoint.dir`, which every executor must be able to reach.

    Where the setting is absent a local session gets a temporary folder; on a cluster that
    would lose data with the machine, so there the setting is required.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    sc = spark.sparkContext
    if folder is None:
        folder = sc.getCheckpointDir()
    if folder is None:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        folder = tempfile.mkdtemp(prefix="tagpulse-")
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(folder)
    return folder


def fresh_folder(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, for the tables of one run."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Write `df` to the shared folder and read it back, cutting its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()
