"""The complete programs: from lines of JSON to a result, recorded or live.

Recorded programs return a DataFrame. Live ones return a streaming DataFrame for a sink of
sources/sinks.py, or, where named start_*, start a query that keeps tables under `out`.
"""

from pyspark.sql import DataFrame, SparkSession

from tagpulse.operators import aggregates as agg
from tagpulse.operators import regression, reshape, views
from tagpulse.session import checkpointed
from tagpulse.sources.posts import parse_tweets
from tagpulse.streaming import live, updates
from tagpulse.streaming.lists import start_lists
from tagpulse.streaming.online import start_online_regression

# fixed values: the tags that the programs with a filter look for, and those that the longest-word programs look for
COUNTRY_TAGS = ["germany", "russia", "usa", "japan", "china"]
MUSIC_TAGS = ["exo", "baekhyun", "wasteitonme", "tempo_baekhyun", "bts"]
# fixed values: the keywords of the scratch filter
SPORT_KEYWORDS = ["nfl", "sports", "nbl", "nba"]
# pace of the live comparisons
PACE = {"processingTime": "10 seconds"}


# recorded posts

def tags_per_country(lines: DataFrame, part_size=agg.PART) -> DataFrame:
    return agg.with_country_prefix(agg.tags_per_country(views.country_tag(parse_tweets(lines)), part_size))


def users_per_tag(lines: DataFrame, part_size=agg.PART) -> DataFrame:
    return agg.users_per_tag(views.tag_user(parse_tweets(lines)), part_size)


def longest_words(lines: DataFrame, tags=MUSIC_TAGS) -> DataFrame:
    return agg.longest_words(agg.longest_word_rows(parse_tweets(lines), tags))


def tag_counts(lines: DataFrame) -> DataFrame:
    return agg.tag_counts(views.tag_rows(views.english_with_text(parse_tweets(lines))))


def mean_words(lines: DataFrame, tags=COUNTRY_TAGS, match="exact", quoted=True) -> DataFrame:
    means = agg.mean_words(agg.post_words(parse_tweets(lines), tags, match), quoted=quoted)
    return means.select("tag", "avg_words", "posts")


# live posts

def live_tag_counts(lines: DataFrame) -> DataFrame:
    return live.tag_counts(parse_tweets(lines))


def live_mean_words(lines: DataFrame, tags=None) -> DataFrame:
    """With the time of the latest post."""
    return live.mean_words(parse_tweets(lines), tags).drop("words")


def live_mean_words_by_case(lines: DataFrame, tags=COUNTRY_TAGS) -> DataFrame:
    """The filter ignores case, the key keeps it."""
    return live.mean_words(parse_tweets(lines), tags, normalize=False).select("tag", "avg_words", "posts")


def live_window_mean_words(lines: DataFrame, width="60 minutes", tags=None) -> DataFrame:
    return live.window_mean_words(parse_tweets(lines), width, tags)


def live_longest_words(lines: DataFrame, width="20 seconds", tags=MUSIC_TAGS) -> DataFrame:
    return live.longest_words(parse_tweets(lines), width, tags)


def start_tag_count_updates(lines: DataFrame, out, checkpoint, **options):
    """The count after every use of a tag; `updates.read_updates` reads them."""
    return updates.start_counts(views.tag_rows(views.english_with_text(parse_tweets(lines))), out, checkpoint, **options)


def start_mean_words_updates(lines: DataFrame, out, checkpoint, tags=None, **options):
    """The mean after every post of a tag, with its time; `updates.read_mean_words` reads them."""
    return updates.start_mean_words(agg.post_words(parse_tweets(lines), tags), out, checkpoint, **options)


def start_tags_per_country(lines: DataFrame, out, checkpoint, **options):
    return start_lists(views.country_tag(parse_tweets(lines)), "country", "tag", out, checkpoint, **options)


def start_users_per_tag(lines: DataFrame, out, checkpoint, **options):
    return start_lists(live.new_users(parse_tweets(lines)), "tag", "user_name", out, checkpoint, mode="update", **options)


# live beside recorded; the recorded result is written out once, not computed again per batch

def start_compare_counts(recorded: DataFrame, lines: DataFrame, out, checkpoint, trigger=PACE, **options):
    """The current count of each tag beside the recorded one, once per batch; `updates.read_latest_counts` reads it."""
    return updates.start_latest_counts(
        live_tag_counts(lines), checkpointed(tag_counts(recorded)), out, checkpoint, trigger=trigger, **options)


def start_compare_count_updates(recorded: DataFrame, lines: DataFrame, out, checkpoint, trigger=PACE, **options):
    """The count after every use of a tag beside the recorded one; `updates.read_compared_counts` reads them."""
    rows = views.tag_rows(views.english_with_text(parse_tweets(lines)))
    return updates.start_compared_counts(rows, checkpointed(tag_counts(recorded)), out, checkpoint, trigger=trigger, **options)


def start_compare_users(recorded: DataFrame, lines: DataFrame, out, checkpoint, part_size=agg.PART, trigger=PACE):
    known = checkpointed(users_per_tag(recorded, part_size))
    return start_users_per_tag(lines, out, checkpoint, part_size=part_size, recorded=known, trigger=trigger)


def start_compare_country_tags(recorded: DataFrame, lines: DataFrame, out, checkpoint, part_size=agg.PART, trigger=PACE):
    known = checkpointed(agg.tags_per_country(views.country_tag(parse_tweets(recorded)), part_size))
    return start_tags_per_country(lines, out, checkpoint, part_size=part_size, recorded=known, trigger=trigger)


# regression

def longest_word_model(lines: DataFrame) -> DataFrame:
    """The line through (tokens, longest token) of all recorded tags."""
    return regression.fit(agg.token_stats(agg.token_rows(parse_tweets(lines))), "tokens", "longest")


def live_longest_word_scores(recorded: DataFrame, lines: DataFrame, width="10 seconds") -> DataFrame:
    return live.scored_token_stats(parse_tweets(lines), checkpointed(longest_word_model(recorded)), width)


def start_user_regression(lines: DataFrame, out, checkpoint, width="10 seconds", **options):
    return start_online_regression(live.window_users(parse_tweets(lines), width), "uses", "users", out, checkpoint, **options)


def start_mean_words_regression(lines: DataFrame, out, checkpoint, width="10 seconds", tags=None, **options):
    cells = live.window_mean_words(parse_tweets(lines), width, tags)
    return start_online_regression(cells, "posts", "avg_words", out, checkpoint, xy="words", **options)


# the rest

def keyword_posts(lines: DataFrame, keywords=SPORT_KEYWORDS) -> DataFrame:
    """The raw lines of posts with such a hashtag."""
    return views.with_keyword_tag(parse_tweets(lines, with_line=True), keywords).select("value")


def chart_series(lines: DataFrame, part_size=agg.PART) -> DataFrame:
    return reshape.recorded_series(reshape.parse_series(lines), part_size)


def fare_lines(spark: SparkSession, path) -> DataFrame:
    return reshape.fares(reshape.read_fields(spark, path))


def trip_lines(spark: SparkSession, path) -> DataFrame:
    return reshape.trips(reshape.read_fields(spark, path))
