"""Posts derived from the test tables, each over the whole of its table."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# documents carry no time: one every 7 seconds from 2024-01-01 UTC
FIRST_SECOND = 1704067200
SECONDS_APART = 7
USERS = 50
EVENT_TOPICS = 30
NATIONS = 25


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal the rows out anew if the files give fewer partitions than there are cores.

    A file that cannot be split is one task, whatever is done with its text. Large tables have
    partitions enough and stay as they are.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def stream_table(spark: SparkSession, sf_dir: str, name: str, files_per_trigger=None) -> DataFrame:
    """The same table as a stream of its files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    # as a pattern, the path may be one file as well as a folder
    return reader.parquet(f"{sf_dir}/{{{name}}}.parquet")


def _with_country(rows: DataFrame, nation: DataFrame | None) -> DataFrame:
    if nation is None:
        return rows.withColumn("country", F.lit(None).cast("string")).drop("_nation")
    names = nation.select(F.col("n_nationkey").alias("_nation"), F.col("n_name").alias("country"))
    return rows.join(names, "_nation", "left").drop("_nation")


def from_documents(documents: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """Documents as posts with the hashtags [source, lang]; French ones have no place.

    `nation` is joined only when the caller needs countries.
    """
    doc = F.col("doc_id")
    rows = documents.select(
        doc.alias("tweet_id"),
        F.timestamp_seconds(F.lit(FIRST_SECOND) + doc * SECONDS_APART).alias("ts"),
        "text", "lang",
        F.concat(F.lit("u"), (doc % USERS).cast("string")).alias("user_name"),
        F.col("lang").alias("user_lang"),
        F.array(F.when(doc % 2 == 0, F.upper("source")).otherwise(F.col("source")), F.col("lang")).alias("hashtags"),
        F.when(F.col("lang") != "fr", doc % NATIONS).cast("int").alias("_nation"),
    )
    return _with_country(rows, nation)


def from_events(events: DataFrame, nation: DataFrame | None = None) -> DataFrame:
    """Events as posts with the hashtags [event type, a topic of the user]; errors have no place."""
    user = F.col("user_id")
    k = F.get_json_object("props", "$.k").try_cast("int")
    rows = events.select(
        F.col("event_id").alias("tweet_id"),
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat_ws(" ", "event_type", "props").alias("text"),
        F.when(k >= 50, "en").otherwise("de").alias("lang"),
        F.concat(F.lit("u"), user.cast("string")).alias("user_name"),
        F.when(k >= 50, "en").otherwise("de").alias("user_lang"),
        F.array(F.col("event_type"), F.concat(F.lit("src"), (user % EVENT_TOPICS).cast("string"))).alias("hashtags"),
        F.when(F.col("event_type") != "error", user % NATIONS).cast("int").alias("_nation"),
    )
    return _with_country(rows, nation)
