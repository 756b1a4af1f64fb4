"""Raw posts: JSON lines, at rest or arriving, to the canonical columns."""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagpulse.schema import POST


def read_lines(spark: SparkSession, path) -> DataFrame:
    """Recorded posts, one per line. Arrival order: file time, then place in the read."""
    return spark.read.text(path).select(
        "value",
        F.monotonically_increasing_id().alias("tweet_id"),
        F.col("_metadata.file_modification_time").alias("ts"),
    )


OFFSET_BITS = 41  # of a place in a file: up to 2 TB


def _number_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds to each line how many this task has read before it."""
    place = 0
    for batch in batches:
        places = pa.array(np.arange(place, place + batch.num_rows))
        place += batch.num_rows
        yield pa.RecordBatch.from_arrays([*batch.columns, places], names=[*batch.schema.names, "place"])


def stream_lines(spark: SparkSession, path, files_per_trigger=None) -> DataFrame:
    """Posts as files of lines appear under `path`. Arrival order: file time, then the file, then place in it.

    A large file is read by many tasks, each of which numbers the lines of its block from where the block starts: a block has no
    more lines than bytes, so the numbers rise through the file and none comes twice. (Only the last block of a file, or the only
    one, shares a task with other files, so numbers that start higher there meet no later block.) Of files of one time and one in
    four million that hash alike the lines are mixed.
    """
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    lines = reader.load(path).select(
        "value", F.col("_metadata.file_modification_time").alias("ts"),
        F.pmod(F.xxhash64("_metadata.file_path"), F.lit(1 << 22)).alias("file"), F.col("_metadata.file_block_start").alias("start"))
    numbered = lines.mapInArrow(_number_lines, "value string, ts timestamp, file long, start long, place long")
    return numbered.select(
        "value", (F.shiftleft("file", OFFSET_BITS) + F.col("start") + F.col("place")).alias("tweet_id"), "ts")


def with_processing_time(lines: DataFrame, order) -> DataFrame:
    """For any stream with a `value` column (a message queue's, say) that has no event time.

    `order` is a column that numbers the lines in the order of their arrival, each once: a queue's offset, or partition and
    offset in one number.
    """
    return lines.select(
        F.col("value").cast("string").alias("value"),
        order.cast("long").alias("tweet_id"),
        F.current_timestamp().alias("ts"),
    )


def _parsed(lines: DataFrame, mode: str) -> DataFrame:
    schema = POST
    options = {"mode": mode}
    if mode == "PERMISSIVE":
        schema = T.StructType(POST.fields + [T.StructField("_bad", T.StringType())])
        options["columnNameOfCorruptRecord"] = "_bad"
    else:
        lines = lines.where(F.col("value").rlike(r"\S"))
    # inline() of the one parsed object keeps later filters from parsing the line a second time
    return lines.select(
        "value", "tweet_id", "ts", F.inline(F.array(F.from_json("value", schema, options))))


def _flat() -> list:
    """The canonical columns of a parsed line."""
    return [
        F.col("tweet_id"), F.col("ts"), F.col("text"), F.col("lang"),
        F.col("user.name").alias("user_name"),
        F.col("user.lang").alias("user_lang"),
        F.col("place.country").alias("country"),
        F.col("entities.hashtags.text").alias("hashtags"),
    ]


def parse_tweets(lines: DataFrame, mode="PERMISSIVE", with_line=False) -> DataFrame:
    """Lines (value, tweet_id, ts) to canonical posts, and the line itself if asked for.

    Blank lines are skipped. A line that is not JSON is left out here and found by `bad_lines`,
    or fails the job with mode="FAILFAST". Absent fields are NULL; views drop rows without the
    field they need. Posts that are parsed already, such as those of a layer, stay as they are.
    """
    if "hashtags" in lines.columns:
        return lines if with_line else lines.drop("value")
    posts = _parsed(lines, mode)
    if mode == "PERMISSIVE":
        posts = posts.where(F.col("_bad").isNull())
    return posts.select(*_flat(), *(["value"] if with_line else []))


def posts_and_bad_lines(lines: DataFrame) -> DataFrame:
    """The rows of `parse_tweets` and of `bad_lines` in one pass, told apart by `bad`; with the line."""
    parsed = _parsed(lines, "PERMISSIVE").where(F.col("value").rlike(r"\S"))
    return parsed.select(*_flat(), "value", F.col("_bad").isNotNull().alias("bad"))


def bad_lines(lines: DataFrame) -> DataFrame:
    """The lines that `parse_tweets` left out, to be written beside its result."""
    bad = F.col("_bad").isNotNull() & F.col("value").rlike(r"\S")
    return _parsed(lines, "PERMISSIVE").where(bad).select("value", "tweet_id", "ts")


def to_lines(tweets: DataFrame) -> DataFrame:
    """The inverse of `parse_tweets`: each post as its JSON object."""
    post = F.struct(
        "text", "lang",
        F.struct(F.col("user_name").alias("name"), F.col("user_lang").alias("lang")).alias("user"),
        F.when(F.col("country").isNotNull(), F.struct("country")).alias("place"),
        F.struct(F.transform("hashtags", lambda t: F.named_struct(F.lit("text"), t)).alias("hashtags")).alias("entities"),
    )
    return tweets.select(F.to_json(post).alias("value"), "tweet_id", "ts")
