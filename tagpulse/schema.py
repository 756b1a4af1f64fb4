"""The post as it arrives (JSON) and as every operator takes it (flat columns)."""

from pyspark.sql import types as T

# Fields of the JSON object that the programs read; all others are skipped by the parser.
POST = T.StructType([
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("user", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("lang", T.StringType()),
    ])),
    T.StructField("place", T.StructType([T.StructField("country", T.StringType())])),
    T.StructField("entities", T.StructType([
        T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", T.StringType())]))),
    ])),
])

# Canonical columns. `hashtags` keeps its case; views lower it.
TWEET = T.StructType([
    T.StructField("tweet_id", T.LongType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("text", T.StringType()),
    T.StructField("lang", T.StringType()),
    T.StructField("user_name", T.StringType()),
    T.StructField("user_lang", T.StringType()),
    T.StructField("country", T.StringType()),
    T.StructField("hashtags", T.ArrayType(T.StringType())),
])

# Arrival order of the hashtags of all posts: unique per row, so "first" and "so far" are definite.
ARRIVAL = ["ts", "tweet_id", "tag_pos"]
