"""Parsing, views and text: one test per odd shape."""

import pytest
from pyspark.sql import functions as F

from fixtures import LINES, lines_df, tuples, tweets_df
from tagpulse.functions import text
from tagpulse.operators import aggregates as agg
from tagpulse.operators import views
from tagpulse.sources.posts import bad_lines, parse_tweets, read_lines, to_lines
from tagpulse.plans import programs


def test_parse_keeps_posts_and_drops_bad_lines(spark):
    lines = lines_df(spark)
    assert parse_tweets(lines).where("text is not null").count() == 5
    assert [r.value for r in bad_lines(lines).collect()] == ["not json"]


def test_failfast(spark):
    with pytest.raises(Exception):
        parse_tweets(lines_df(spark), mode="FAILFAST").collect()
    assert parse_tweets(lines_df(spark, LINES[:6] + ["", " "]), mode="FAILFAST").count() == 6


def test_round_trip(spark):
    tweets = parse_tweets(lines_df(spark)).where("text is not null")
    assert tuples(parse_tweets(to_lines(tweets)).select("tweet_id", "text", "user_name", "country")) == tuples(
        tweets, "tweet_id", "text", "user_name", "country")


def test_tag_counts(spark):
    lines = lines_df(spark)
    assert tuples(programs.tag_counts(lines)) == [("japan", 3), ("usa", 1)]


def test_read_lines_from_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(LINES), encoding="utf-8")
    assert tuples(programs.tag_counts(read_lines(spark, str(tmp_path)))) == [("japan", 3), ("usa", 1)]


def test_words_are_spaces_plus_one(spark):
    rows = agg.post_words(parse_tweets(lines_df(spark)))
    assert tuples(rows, "tag", "words") == [("empty", 1), ("japan", 2), ("japan", 2), ("japan", 4), ("usa", 4)]


def test_mean_words_quoted(spark):
    means = programs.mean_words(lines_df(spark))
    assert tuples(means) == [('"japan"', 8 / 3, 3), ('"usa"', 4.0, 1)]


def test_no_place_and_no_tag_text(spark):
    tweets = parse_tweets(lines_df(spark))
    assert tuples(views.country_tag(tweets), "country", "tag") == [("Japan", "japan"), ("Japan", "usa")]


def test_place_without_country(spark):
    line = '{"text":"t","place":{"id":1},"entities":{"hashtags":[{"text":"a"}]}}'
    assert views.country_tag(parse_tweets(lines_df(spark, [line]))).count() == 0


def test_users_are_a_set_in_first_seen_order(spark):
    posts = [dict(user_name=u) for u in ["b;x", "a", "b;x", "x", "b", "a"]]
    got = agg.users_per_tag(views.tag_user(tweets_df(spark, posts)))
    assert tuples(got) == [("a", 0, "b;x;a;x;b")]


def test_country_list_keeps_repeats(spark):
    posts = [dict(country="Peru", hashtags=["A", "b"]), dict(country="Peru", hashtags=["a"]), dict(hashtags=["z"])]
    rows = views.country_tag(tweets_df(spark, posts))
    assert tuples(agg.with_country_prefix(agg.tags_per_country(rows))) == [("Peru", 0, "Peru:a;b;a;")]


def test_filters(spark):
    tweets = tweets_df(spark, [dict(hashtags=["MadeInUSA", "usa"]), dict(hashtags=["Japan"])])
    exact = views.tag_rows(tweets, tags=["usa", "japan"])
    assert tuples(exact, "tag") == [("japan",), ("usa",)]
    part = views.tag_rows(tweets, tags=["usa"], match="substring", normalize=False)
    assert tuples(part, "tag") == [("MadeInUSA",), ("usa",)]
    assert views.with_keyword_tag(tweets, ["made"]).count() == 1
    with pytest.raises(ValueError):
        views.tag_rows(tweets, tags=["usa"], match="prefix")


def test_case_is_kept_on_request(spark):
    tweets = tweets_df(spark, [dict(hashtags=["USA"]), dict(hashtags=["usa"])])
    assert tuples(agg.mean_words(agg.post_words(tweets, normalize=False)), "tag", "posts") == [("USA", 1), ("usa", 1)]


@pytest.mark.parametrize("value,expected", [
    ("a b", ["a", "b"]), ("http://x.y", ["http", "://", "x", ".", "y"]), (" lead  two ", ["lead", "two"]),
    ("été!", ["été", "!"]), ("a_b c1", ["a_b", "c1"]), ("\U0001f600 ok", ["\U0001f600", "ok"]), ("", []),
])
def test_tokens(spark, value, expected):
    df = spark.createDataFrame([(value,)], "text string")
    assert df.select(text.tokens(F.col("text"))).first()[0] == expected


def test_length_units(spark):
    df = spark.createDataFrame([("\U0001f600a",)], "w string")
    assert df.select(text.text_length(F.col("w")), text.text_length(F.col("w"), True)).first()[:] == (2, 3)


def test_json_quoted(spark):
    df = spark.createDataFrame([('a"b\n',)], "w string")
    assert df.select(text.json_quoted(F.col("w"))).first()[0] == '"a\\"b\\n"'


def test_longest_word_first_of_equals(spark):
    posts = [dict(text="aa bbbb", at=5), dict(text="cccc dddd", at=1), dict(text="", hashtags=["e"]), dict(text="  ", hashtags=["f"])]
    got = agg.longest_words(agg.longest_word_rows(tweets_df(spark, posts)))
    assert tuples(got) == [("a", "cccc", 4), ("e", "", 0)]


def test_token_stats_ignore_blank_text(spark):
    posts = [dict(text="one, two", hashtags=["a", "a"]), dict(text=""), dict(text=" ")]
    assert tuples(agg.token_stats(agg.token_rows(tweets_df(spark, posts)))) == [("a", 6, 3)]


def test_units(spark):
    lines = lines_df(spark)
    tweets = parse_tweets(lines, with_line=True)
    assert views.raw_unit(tweets).count() == 5
    assert tuples(views.word_units(tweets)) == [("one", 1), ("three", 1), ("two", 1)]
    assert tuples(views.tag_unit(views.tag_user_unit(tweets))) == [("empty", 1), ("japan", 1), ("japan", 1), ("japan", 1), ("usa", 1)]
