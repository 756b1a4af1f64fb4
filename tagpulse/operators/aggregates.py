"""Aggregates per hashtag or country, each over all of its input.

Those marked "batch or streaming" are plain grouped aggregates, combined before the shuffle.
Those that build lists number their rows first (see ordering.py) and are for batch.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.functions.text import json_quoted, with_longest_word, with_token_stats, word_count
from tagpulse.operators.ordering import lists_in_parts, numbered
from tagpulse.operators.views import tag_rows, with_any_tag
from tagpulse.schema import ARRIVAL

# items per row of a long list
PART = 1000


def tumbling(width) -> list:
    """Grouping columns for a tumbling window of event time; none without a width."""
    return [F.window("ts", width)] if width else []


def window_bounds(width) -> list:
    if not width:
        return []
    return [F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end")]


def tag_counts(rows: DataFrame) -> DataFrame:
    """Uses of each tag; one used twice in a post counts twice. Batch or streaming."""
    return rows.groupBy("tag").agg(F.count("*").alias("uses"))


def first_uses(rows: DataFrame) -> DataFrame:
    """The first use of each tag by each user. Batch or streaming."""
    return (
        rows.groupBy("tag", "user_name").agg(F.min(F.struct(*ARRIVAL)).alias("_first"))
        .select("tag", "user_name", "_first.*")
    )


def users_per_tag(rows: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    """Distinct users of each tag, first seen first: (tag, part, users "a;b")."""
    return users_of_first_uses(first_uses(rows), part_size, ranges)


def users_of_first_uses(firsts: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    placed = numbered(firsts, ["tag"], ARRIVAL, "position", ranges)
    parts = lists_in_parts(placed, ["tag"], "position", "user_name", "_users", part_size)
    return parts.select("tag", "part", F.array_join("_users", ";").alias("users"))


def tags_per_country(rows: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    """All tags used in each country, repeats kept, in arrival order: (country, part, tags "a;b;").

    The parts of a country, joined in order, are its one string.
    """
    placed = numbered(rows.select("country", "tag", *ARRIVAL), ["country"], ARRIVAL, "position", ranges)
    parts = lists_in_parts(placed, ["country"], "position", "tag", "_tags", part_size)
    return parts.select("country", "part", F.concat(F.array_join("_tags", ";"), F.lit(";")).alias("tags"))


def with_country_prefix(parts: DataFrame) -> DataFrame:
    """As printed: the first part starts with "Country:"."""
    first = F.when(F.col("part") == 0, F.concat("country", F.lit(":"))).otherwise(F.lit(""))
    return parts.withColumn("tags", F.concat(first, "tags"))


def post_words(tweets: DataFrame, tags=None, match="exact", normalize=True) -> DataFrame:
    """(tag, words of the post) per hashtag; the text is counted once per post, not per tag."""
    counted = tweets.withColumn("words", word_count(F.col("text")))
    return tag_rows(counted, "words", needs=["text"], tags=tags, match=match, normalize=normalize)


def mean_words(rows: DataFrame, width=None, quoted=False) -> DataFrame:
    """Mean words per post, number of posts and time of the latest, per tag and window.

    `quoted` writes the tag as a JSON string, as recorded files have it. Batch or streaming.
    """
    totals = rows.groupBy(*tumbling(width), "tag").agg(
        F.sum("words").alias("_words"), F.count("*").alias("posts"), F.max("ts").alias("last_ts"))
    return totals.select(
        *window_bounds(width),
        (json_quoted(F.col("tag")) if quoted else F.col("tag")).alias("tag"),
        (F.col("_words") / F.col("posts")).alias("avg_words"), "posts", F.col("_words").alias("words"), "last_ts")


def longest_word_rows(tweets: DataFrame, tags=None, utf16=False) -> DataFrame:
    """(tag, word, length): the longest word of each post, per hashtag."""
    if tags is not None:
        tweets = with_any_tag(tweets, tags)  # ahead of splitting the text
    return tag_rows(with_longest_word(tweets, utf16), "word", "length", needs=[], tags=tags)


def longest_word_places(rows: DataFrame, width=None) -> DataFrame:
    """(tag, best) per tag and window: the longest word, first by arrival, as a struct whose maximum over parts is that of the
    whole. Batch or streaming."""
    best = F.max(F.struct(
        "length", (-F.unix_micros("ts")).alias("_ts"), (-F.col("tweet_id")).alias("_id"), "word"))
    return rows.groupBy(*tumbling(width), "tag").agg(best.alias("best"))


def longest_words(rows: DataFrame, width=None) -> DataFrame:
    """The longest word per tag and window; among equals the first to arrive. Batch or streaming."""
    return longest_word_places(rows, width).select(*window_bounds(width), "tag", "best.word", "best.length")


def token_rows(tweets: DataFrame, utf16=False) -> DataFrame:
    """(tag, tokens, longest): token count and longest token of each post, per hashtag."""
    return tag_rows(with_token_stats(tweets, utf16), "tokens", "longest", needs=[])


def token_stats(rows: DataFrame, width=None) -> DataFrame:
    """Tokens and longest token length per tag and window. Batch or streaming."""
    return (
        rows.groupBy(*tumbling(width), "tag")
        .agg(F.sum("tokens").alias("tokens"), F.max("longest").alias("longest"))
        .select(*window_bounds(width), "tag", "tokens", "longest")
    )


def window_users(rows: DataFrame, width) -> DataFrame:
    """Uses and distinct users per tag and window. Batch or streaming (append mode).

    Counted per user first, then over users: exact, and no set of users is held for a hot tag.
    """
    per_user = rows.groupBy(F.window("ts", width), "tag", "user_name").agg(F.count("*").alias("_uses"))
    return (
        per_user.groupBy("window", "tag")
        .agg(F.sum("_uses").alias("uses"), F.count("*").alias("users"))
        .select(*window_bounds(width), "tag", "uses", "users")
    )
