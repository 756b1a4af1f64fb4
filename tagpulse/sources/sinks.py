"""Where results and streams go. Every stream keeps its progress in a checkpoint folder.

A stream stays on until it is stopped; `trigger=ONCE` ends it when it has read what is there.
"""

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from tagpulse.streaming.folders import compact, latest


ONCE = {"availableNow": True}


def tuple_lines(df: DataFrame) -> DataFrame:
    """Rows as printed tuples: (a,b,c)."""
    fields = F.concat_ws(",", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in df.columns])
    return df.select(F.concat(F.lit("("), fields, F.lit(")")).alias("value"))


def show(df: DataFrame, rows: int) -> None:
    """A preview of so many rows on the console; the whole result goes to `write_lines` or a table."""
    df.show(rows, truncate=False)


def with_size(df: DataFrame, name="rows") -> tuple[DataFrame, Observation]:
    """The result, and an observation of its number of rows: filled by the first action on the
    result, at no further pass."""
    seen = Observation()
    return df.observe(seen, F.count(F.lit(1)).alias(name)), seen


def write_lines(df: DataFrame, path) -> None:
    """A result as text, overwriting; one file per partition."""
    tuple_lines(df).write.mode("overwrite").text(path)


def _started(writer: DataStreamWriter, checkpoint, trigger) -> StreamingQuery:
    return triggered(writer.option("checkpointLocation", checkpoint), trigger).start()


def triggered(writer: DataStreamWriter, trigger) -> DataStreamWriter:
    """With no trigger the next batch starts when the last has ended."""
    return writer.trigger(**trigger) if trigger else writer


def to_console(df: DataFrame, checkpoint, rows: int, mode="update", trigger=None) -> StreamingQuery:
    """A preview of so many rows of each batch on the console; the whole goes to `to_updates` or `to_files`."""
    console = df.writeStream.format("console").outputMode(mode).option("truncate", False).option("numRows", rows)
    return _started(console, checkpoint, trigger)


def to_files(df: DataFrame, path, checkpoint, fmt="parquet", trigger=None) -> StreamingQuery:
    """Append final rows to files, each exactly once."""
    return _started(df.writeStream.format(fmt).outputMode("append").option("path", path), checkpoint, trigger)


def to_updates(df: DataFrame, path, checkpoint, trigger=None, keys=None, compact_every=20) -> StreamingQuery:
    """Each batch's changed keys as its own folder; a repeated batch replaces its folder.

    With `keys`, what newer batches have replaced is dropped every `compact_every` batches, so the log stays as large as the
    result and the last batches.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        if keys:
            compact(batch.sparkSession, path, batch_id, keys, compact_every)

    return _started(df.writeStream.foreachBatch(write).outputMode("update"), checkpoint, trigger)


def latest_updates(spark: SparkSession, path, keys) -> DataFrame:
    """The current value of each key written by `to_updates`."""
    return latest(spark.read.parquet(path), keys).drop("batch_id")


def copy_log(lines: DataFrame, path, checkpoint, trigger=None) -> StreamingQuery:
    """The raw stream, unchanged, to text files."""
    return to_files(lines.select("value"), path, checkpoint, "text", trigger)
