"""Posts parsed once: a columnar copy of the JSON lines that arrive, by day, with the lines that are no posts beside it.

Programs read the layer instead of parsing every line again. Each batch of files is a folder of its own, so a file is added exactly
once, a late one adds itself to its days and touches nothing else, and a repeated batch replaces its folder.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tagpulse.schema import TWEET
from tagpulse.sources.posts import posts_and_bad_lines
from tagpulse.sources.sinks import triggered

#: `value` is the line of a bad line, and of every post with keep_lines; `bad` and `day` are folders.
LAYER = T.StructType([*TWEET.fields, T.StructField("value", T.StringType()), T.StructField("bad", T.BooleanType()),
                      T.StructField("day", T.DateType()), T.StructField("batch_id", T.LongType())])


def start_layer(lines: DataFrame, out, checkpoint, keep_lines=False, trigger=None) -> StreamingQuery:
    """Adds streaming lines (value, tweet_id, ts) to the layer at `out`. A line is parsed once and written once, as a post under
    its day or, if it isn't one, under bad=true; blank lines say nothing."""
    rows = posts_and_bad_lines(lines).withColumn("day", F.to_date("ts"))
    if not keep_lines:
        rows = rows.withColumn("value", F.when(F.col("bad"), F.col("value")))

    def step(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").partitionBy("bad", "day").parquet(f"{out}/batch_id={batch_id}")

    writer = rows.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def _rows(spark: SparkSession, out, since, until) -> DataFrame:
    rows = spark.read.schema(LAYER).parquet(str(out))
    if since is not None:
        rows = rows.where(F.col("day") >= F.lit(since))
    return rows if until is None else rows.where(F.col("day") <= F.lit(until))


def read_posts(spark: SparkSession, out, since=None, until=None, with_line=False) -> DataFrame:
    """The posts of the layer, those of the days asked for: other days' folders are not read, and of these only the columns used."""
    posts = _rows(spark, out, since, until).where("not bad")
    return posts.select(*TWEET.fieldNames(), *(["value"] if with_line else []))


def read_bad_lines(spark: SparkSession, out, since=None, until=None) -> DataFrame:
    return _rows(spark, out, since, until).where("bad").select("value", "tweet_id", "ts")
