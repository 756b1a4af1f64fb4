"""Small posts with every odd shape, and ways to make more of them."""

import datetime

from tagpulse.schema import TWEET

LINES = [
    '{"text":"one two  three","lang":"en","user":{"name":"ann","lang":"en"},"place":{"country":"Japan"},"entities":{"hashtags":[{"text":"Japan"},{"text":"USA"}]}}',
    '{"text":"line1\\nline2 x","lang":"en","user":{"name":"bob;c"},"place":null,"entities":{"hashtags":[{"text":"japan"},{"text":"japan"}]}}',
    '{"text":"","lang":"en","user":{"name":"ann"},"entities":{"hashtags":[{"text":"empty"}]}}',
    '{"text":"no tags","lang":"de","user":{"name":"dan"},"place":null,"entities":{"hashtags":[]}}',
    '{"text":"odd","lang":"en","user":{"name":"eve"},"place":null,"entities":{"hashtags":[{"indices":[0,1]}]}}',
    '{"delete":{"status":{"id":1}}}',
    "not json",
    "",
    "   ",
]
START = datetime.datetime(2024, 1, 1)


def lines_df(spark, lines=LINES):
    rows = [(v, i, START + datetime.timedelta(seconds=i)) for i, v in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, tweet_id long, ts timestamp")


def tweets_df(spark, posts):
    """Posts from dicts; the time is the place in the list, in seconds, unless given."""
    rows = []
    for i, p in enumerate(posts):
        row = dict(tweet_id=i, ts=START + datetime.timedelta(seconds=p.get("at", i)), text="x", lang="en",
                   user_name="ann", user_lang="en", country=None, hashtags=["a"])
        row.update({k: v for k, v in p.items() if k != "at"})
        rows.append(tuple(row[f.name] for f in TWEET.fields))
    return spark.createDataFrame(rows, TWEET)


def tuples(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())
