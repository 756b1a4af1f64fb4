"""Projections of posts to one row per hashtag, and the filters on them.

Each takes and returns a DataFrame, batch or streaming, and starts no job.
"""

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def tag_matches(tag: Column, tags, match="exact") -> Column:
    """Whether a hashtag is one of `tags`, or contains one of them with match="substring"."""
    tag = F.lower(tag)
    wanted = [t.lower() for t in tags]
    if match == "exact":
        return tag.isin(wanted)
    if match == "substring":
        return reduce(or_, (F.contains(tag, F.lit(t)) for t in wanted))
    raise ValueError(f"match must be exact or substring, not {match!r}")


def with_any_tag(tweets: DataFrame, tags, match="exact") -> DataFrame:
    """Posts with at least one matching hashtag, still one row each.

    Used ahead of work on the text, so that it is not done for posts that drop out afterwards.
    """
    return tweets.where(F.exists("hashtags", lambda t: tag_matches(t, tags, match)))


def tag_rows(tweets: DataFrame, *columns, needs=None, tags=None, match="exact", normalize=True) -> DataFrame:
    """One row per hashtag: tag, arrival columns and `columns`.

    Posts without hashtags, hashtags without text and posts lacking one of `columns` give none.
    Where columns are computed, `needs` names the stored ones to test in their place: a test on
    the result would be pushed down and compute it twice. `tags=None` keeps every tag;
    `normalize=False` keeps the case of the key.
    """
    rows = tweets
    for name in columns if needs is None else needs:
        rows = rows.where(F.col(name).isNotNull())
    if tags is not None:
        rows = with_any_tag(rows, tags, match)
    rows = rows.select("ts", "tweet_id", *columns, F.posexplode("hashtags").alias("tag_pos", "tag"))
    rows = rows.where(F.col("tag").isNotNull())
    if tags is not None:
        rows = rows.where(tag_matches(F.col("tag"), tags, match))
    if normalize:
        rows = rows.withColumn("tag", F.lower("tag"))
    return rows


def english_with_text(tweets: DataFrame) -> DataFrame:
    return tweets.where((F.col("lang") == "en") & (F.length("text") > 0))


def tag_text_lang(tweets: DataFrame) -> DataFrame:
    return tag_rows(tweets, "text", "lang")


def tag_user(tweets: DataFrame) -> DataFrame:
    return tag_rows(tweets, "user_name")


def tag_user_unit(tweets: DataFrame) -> DataFrame:
    """(tag, user, 1)."""
    return tag_user(tweets).withColumn("unit", F.lit(1).cast("long"))


def tag_unit(rows: DataFrame) -> DataFrame:
    """(tag, 1) from any per-tag rows: drops whatever else they carry."""
    return rows.select("tag", F.lit(1).cast("long").alias("unit"))


def country_tag(tweets: DataFrame) -> DataFrame:
    return tag_rows(tweets, "country")


def raw_unit(tweets: DataFrame) -> DataFrame:
    """(raw line, 1) per hashtag, from posts parsed with their line."""
    return tag_rows(tweets, "value").select("value", F.lit(1).cast("long").alias("unit"))


def with_keyword_tag(tweets: DataFrame, keywords) -> DataFrame:
    """Posts with a hashtag that contains one of the keywords."""
    return with_any_tag(tweets, keywords, match="substring")


def english_user_with_text(tweets: DataFrame) -> DataFrame:
    return tweets.where((F.col("user_lang") == "en") & F.col("text").isNotNull())


def word_units(tweets: DataFrame) -> DataFrame:
    """(word, 1) of posts by English-speaking users: split at blanks, lower-cased."""
    word = F.explode(F.split("text", r"[ \t\n\r\f]+")).alias("word")
    return (
        english_user_with_text(tweets).select(word)
        .select(F.lower(F.replace(F.col("word"), F.lit("\x0b"), F.lit(""))).alias("word"))
        .where(F.col("word") != "")
        .withColumn("unit", F.lit(1).cast("long"))
    )
