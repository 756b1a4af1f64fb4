"""Tables that a stream writes one folder per batch, so that a repeated batch replaces its own.

What a live table no longer needs is dropped as it goes: a log of updates is compacted every so many batches, and a state keeps
its last two batches. The last batch may be repeated after a failure, so it and the one before it are never touched.
"""

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MERGED = "_merged"  # marks the folder of a batch that has the newest rows of all before it


def write_batch(df: DataFrame, path, batch_id: int) -> DataFrame:
    """Write the batch's rows and return them read back: later steps do not compute them again."""
    folder = f"{path}/batch_id={batch_id}"
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)


def read_batch(spark: SparkSession, path, batch_id: int, schema) -> DataFrame | None:
    """What the batch wrote; None before the first. Every batch writes, also an empty one."""
    if batch_id < 0:
        return None
    return spark.read.schema(schema).parquet(f"{path}/batch_id={batch_id}")


def files_of(spark: SparkSession, path):
    """The file system of `path`, and the path for it."""
    root = spark._jvm.org.apache.hadoop.fs.Path(str(path))
    return root.getFileSystem(spark._jsc.hadoopConfiguration()), root


def numbered_folders(spark: SparkSession, path, name="batch_id") -> dict[int, str]:
    """The folders `name`=n right under `path`, by n."""
    files, root = files_of(spark, path)
    found = {}
    if files.exists(root):
        for status in files.listStatus(root):
            number = re.fullmatch(rf"{name}=(\d+)", status.getPath().getName())
            if number:
                found[int(number[1])] = status.getPath().toString()
    return found


def drop_before(spark: SparkSession, path, batch_id: int, name="batch_id") -> None:
    """Removes the folders of earlier batches."""
    for number, folder in numbered_folders(spark, path, name).items():
        if number < batch_id:
            files, at = files_of(spark, folder)
            files.delete(at, True)


def _exists(spark: SparkSession, path) -> bool:
    files, at = files_of(spark, path)
    return files.exists(at)


def latest(log: DataFrame, keys) -> DataFrame:
    """The newest row of each key of a log, with its batch_id."""
    values = [c for c in log.columns if c not in keys]
    newest = F.max_by(F.struct(*values), "batch_id").alias("_value")
    return log.groupBy(*keys).agg(newest).select(*keys, "_value.*")


def compact(spark: SparkSession, path, batch_id: int, keys, every: int) -> None:
    """Every `every` batches, moves what older batches still have to say into the batch before the last but one.

    That batch gets the newest rows of keys that it has not written itself. The older folders go one round later, so that a reader
    that has listed them can still read them. Done twice, or broken off at any place, it changes nothing that `latest` shows.
    """
    target = batch_id - 2
    if every < 1 or batch_id % every or target < 0:
        return
    folders = numbered_folders(spark, path)
    merged = [n for n in folders if n < target and _exists(spark, f"{folders[n]}/{MERGED}")]
    if merged:  # what is before it has been in it since the round before
        drop_before(spark, path, max(merged))
        folders = numbered_folders(spark, path)
    old = [folders[n] for n in sorted(folders) if n <= target]
    if target not in folders or len(old) < 2:
        return
    log = spark.read.option("basePath", str(path)).parquet(*old)
    moved = latest(log, keys).where(F.col("batch_id") < target).drop("batch_id")
    moved.write.mode("append").parquet(f"{path}/batch_id={target}")
    files, mark = files_of(spark, f"{path}/batch_id={target}/{MERGED}")
    files.create(mark, True).close()
