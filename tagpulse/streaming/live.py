"""Live twins of the aggregates: streaming DataFrames, ready for a sink.

The operators are the batch ones. A live query shows the value per changed key and micro-batch; the value after every single
record comes from streaming/updates.py. A window comes out once the posts have moved past it; `finish` closes the last ones of a
stream that has ended.
"""

import datetime
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagpulse.operators import aggregates as agg
from tagpulse.operators import compare, regression, views
from tagpulse.schema import ARRIVAL, TWEET
from tagpulse.streaming.folders import files_of

# how long a window waits for late posts
DELAY = "1 minute"
# the closing post's time, and a window that never closes
END = datetime.datetime(9999, 1, 1)


def tag_counts(tweets: DataFrame) -> DataFrame:
    """Update mode."""
    return agg.tag_counts(views.tag_rows(views.english_with_text(tweets)))


def mean_words(tweets: DataFrame, tags=None, match="exact", normalize=True) -> DataFrame:
    """Mean, posts, time of the latest. Update mode."""
    return agg.mean_words(agg.post_words(tweets, tags, match, normalize))


def new_users(tweets: DataFrame) -> DataFrame:
    """Each user of a tag once, in the batch of the first use. Update mode.

    Grouped rather than de-duplicated, because grouping combines before the shuffle. A pair that
    was seen in one batch only, and is in this one, is new.
    """
    rows = views.tag_user(tweets).withColumn("_now", F.current_timestamp())  # the same all through a batch
    pairs = rows.groupBy("tag", "user_name").agg(
        F.min(F.struct(*ARRIVAL)).alias("_first"), F.min("_now").alias("_since"), F.max("_now").alias("_until"))
    return pairs.where(F.col("_since") == F.col("_until")).select("tag", "user_name", "_first.*")


def longest_words(tweets: DataFrame, width="20 seconds", tags=None, delay=DELAY) -> DataFrame:
    """Closed windows. Append mode."""
    return agg.longest_words(agg.longest_word_rows(tweets.withWatermark("ts", delay), tags), width)


def window_mean_words(tweets: DataFrame, width="60 minutes", tags=None, delay=DELAY) -> DataFrame:
    """Closed windows. Append mode."""
    return agg.mean_words(agg.post_words(tweets.withWatermark("ts", delay), tags), width)


def window_users(tweets: DataFrame, width="10 seconds", delay=DELAY) -> DataFrame:
    """Closed windows. Append mode."""
    return agg.window_users(views.tag_user(tweets.withWatermark("ts", delay)), width)


def scored_token_stats(tweets: DataFrame, model: DataFrame, width="10 seconds", delay=DELAY) -> DataFrame:
    """Closed windows of token count and longest token, with the longest that `model` expects."""
    cells = agg.token_stats(agg.token_rows(tweets.withWatermark("ts", delay)), width)
    return regression.score(cells, model, "tokens")


def compared_counts(tweets: DataFrame, recorded: DataFrame) -> DataFrame:
    """Running counts beside recorded ones. Update mode; the trigger sets the pace."""
    return compare.compare_counts(recorded, tag_counts(tweets))


def with_end(tweets: DataFrame, folder) -> DataFrame:
    """The posts, and the closing post that `close` puts into `folder`. To be put before windows."""
    spark = tweets.sparkSession
    files, at = files_of(spark, folder)
    files.mkdirs(at)
    return tweets.unionByName(spark.readStream.schema(TWEET).parquet(str(folder)).select(*tweets.columns))


def close(spark: SparkSession, folder, tags=("end",)) -> None:
    """Says that a stream `with_end` has ended: every window closes, and posts that come later are late.

    The closing post is of the year 9999, so it moves the watermark past all windows but its own, which stays open. It must pass the
    query's filters to be seen, so give it a tag that they let through. Closing twice is closing once.
    """
    files, at = files_of(spark, folder)
    if files.exists(at) and any(s.getPath().getName().startswith("part-") for s in files.listStatus(at)):
        return
    post = (0, END, "end", "en", "end", "en", "end", list(tags))
    spark.createDataFrame([post], TWEET).coalesce(1).write.mode("append").parquet(str(folder))


def finish(start: Callable[[], StreamingQuery], spark: SparkSession, folder, tags=("end",)) -> None:
    """Runs a query over a stream `with_end` through what there is, closes the stream, and runs the query to its end. `start` starts
    it with trigger ONCE and always the same checkpoint, so after a failure the whole may be called again."""
    start().awaitTermination()
    close(spark, folder, tags)
    start().awaitTermination()
