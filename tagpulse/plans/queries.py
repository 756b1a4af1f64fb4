"""Every operator as a named query over the test tables (see sources/tables.py), whole tables only.

Times come out as epoch numbers (`ts_us`, `window_s`) so that engines can be compared; part sizes
are small enough for lists to have several parts.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.operators import aggregates as agg
from tagpulse.operators import compare, regression, reshape, running, views
from tagpulse.plans import programs
from tagpulse.session import checkpointed, fresh_folder
from tagpulse.sources.posts import parse_tweets, to_lines
from tagpulse.sources.sinks import ONCE, copy_log, latest_updates, to_files, to_updates
from tagpulse.sources.tables import from_documents, from_events, spread, stream_table, table
from tagpulse.streaming import increments, layer, live, updates
from tagpulse.streaming.lists import read_compared, read_lists, start_lists
from tagpulse.streaming.online import read_predictions, start_online_regression

TAGS = ["src0", "src1", "src2", "src3", "src4"]
USER_PART = 20
COUNTRY_PART = 25

QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def docs(spark, sf_dir, places=False) -> DataFrame:
    return from_documents(spread(table(spark, sf_dir, "documents")), table(spark, sf_dir, "nation") if places else None)


def events(spark, sf_dir, places=False) -> DataFrame:
    return from_events(table(spark, sf_dir, "events"), table(spark, sf_dir, "nation") if places else None)


def live_docs(spark, sf_dir, places=False) -> DataFrame:
    return from_documents(stream_table(spark, sf_dir, "documents"), table(spark, sf_dir, "nation") if places else None)


def live_events(spark, sf_dir, places=False) -> DataFrame:
    return from_events(stream_table(spark, sf_dir, "events"), table(spark, sf_dir, "nation") if places else None)


def plain(df: DataFrame) -> DataFrame:
    """Times as numbers."""
    if "ts" in df.columns:
        df = df.withColumn("ts_us", F.unix_micros("ts")).drop("ts")
    if "last_ts" in df.columns:
        df = df.withColumn("last_us", F.unix_micros("last_ts")).drop("last_ts")
    if "window_start" in df.columns:
        df = df.withColumn("window_s", F.unix_seconds("window_start")).drop("window_start", "window_end")
    return df


def rounded(df: DataFrame, *columns) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# aggregates

@query
def tag_count_en(spark, sf_dir):
    return agg.tag_counts(views.tag_rows(views.english_with_text(docs(spark, sf_dir))))


@query
def tag_count_from_json(spark, sf_dir):
    parsed = parse_tweets(to_lines(docs(spark, sf_dir, places=True)))
    return agg.tag_counts(views.tag_rows(views.english_with_text(parsed)))


@query
def users_per_tag(spark, sf_dir):
    return agg.users_per_tag(views.tag_user(events(spark, sf_dir)), USER_PART)


@query
def tags_per_country(spark, sf_dir):
    return agg.with_country_prefix(
        agg.tags_per_country(views.country_tag(docs(spark, sf_dir, places=True)), COUNTRY_PART))


@query
def avg_words_per_tag(spark, sf_dir):
    means = agg.mean_words(agg.post_words(docs(spark, sf_dir), TAGS), quoted=True)
    return means.select("tag", "avg_words", "posts")


@query
def avg_words_substring_match(spark, sf_dir):
    rows = agg.post_words(docs(spark, sf_dir), ["src1", "e"], match="substring", normalize=False)
    return agg.mean_words(rows).select("tag", "avg_words", "posts")


@query
def longest_word_per_tag(spark, sf_dir):
    return agg.longest_words(agg.longest_word_rows(docs(spark, sf_dir), TAGS))


@query
def token_stats_per_tag(spark, sf_dir):
    return agg.token_stats(agg.token_rows(docs(spark, sf_dir)))


@query
def regression_longest_word(spark, sf_dir):
    model = regression.fit(agg.token_stats(agg.token_rows(docs(spark, sf_dir))), "tokens", "longest")
    return rounded(model, "slope", "intercept")


@query
def regression_longest_word_scored(spark, sf_dir):
    cells = agg.token_stats(agg.token_rows(docs(spark, sf_dir)), "10 seconds")
    # the whole of a tag is the total of its windows, so the text is split once
    model = regression.fit(agg.token_stats(cells), "tokens", "longest")
    return rounded(plain(regression.score(cells, model, "tokens")), "prediction")


# after every update

@query
def running_tag_count(spark, sf_dir):
    return plain(running.running_counts(views.tag_rows(views.english_with_text(events(spark, sf_dir)))))


@query
def running_users_per_tag(spark, sf_dir):
    return plain(running.running_users(views.tag_user(events(spark, sf_dir))))


@query
def running_user_lists(spark, sf_dir):
    return plain(running.running_user_text(views.tag_user(events(spark, sf_dir)), USER_PART))


@query
def running_tags_per_country(spark, sf_dir):
    rows = views.country_tag(docs(spark, sf_dir, places=True))
    return plain(running.as_fold(running.running_tags(rows, COUNTRY_PART)))


@query
def running_country_lists(spark, sf_dir):
    return plain(running.running_tags(views.country_tag(events(spark, sf_dir, places=True)), COUNTRY_PART))


@query
def running_avg_words(spark, sf_dir):
    return plain(running.running_mean_words(agg.post_words(docs(spark, sf_dir))))


# windows

@query
def window_longest_word(spark, sf_dir):
    return plain(agg.longest_words(agg.longest_word_rows(docs(spark, sf_dir)), "20 seconds"))


@query
def window_avg_words(spark, sf_dir):
    return plain(agg.mean_words(agg.post_words(docs(spark, sf_dir)), "60 minutes"))


@query
def window_user_counts(spark, sf_dir):
    return plain(agg.window_users(views.tag_user(events(spark, sf_dir)), "1 hour"))


@query
def window_token_stats(spark, sf_dir):
    return plain(agg.token_stats(agg.token_rows(docs(spark, sf_dir)), "10 seconds"))


@query
def online_regression_users(spark, sf_dir):
    cells = agg.window_users(views.tag_user(events(spark, sf_dir)), "1 hour")
    return rounded(plain(regression.online_predictions(cells, "uses", "users")), "prediction")


@query
def online_regression_words(spark, sf_dir):
    cells = agg.mean_words(agg.post_words(docs(spark, sf_dir)), "1 minute")
    scored = regression.online_predictions(cells, "posts", "avg_words", xy="words")
    return rounded(plain(scored), "avg_words", "prediction").select("window_s", "tag", "avg_words", "prediction")


# documents as the record, events as the live side

@query
def compare_tag_count(spark, sf_dir):
    return compare.compare_counts(
        agg.tag_counts(views.tag_rows(views.english_with_text(docs(spark, sf_dir)))),
        agg.tag_counts(views.tag_rows(views.english_with_text(events(spark, sf_dir)))))


@query
def compare_users(spark, sf_dir):
    return compare.compare_users(
        agg.users_per_tag(views.tag_user(docs(spark, sf_dir)), USER_PART),
        agg.users_per_tag(views.tag_user(events(spark, sf_dir)), USER_PART))


@query
def compare_country_tags(spark, sf_dir):
    return compare.compare_country_tags(
        agg.tags_per_country(views.country_tag(docs(spark, sf_dir, places=True)), COUNTRY_PART),
        agg.tags_per_country(views.country_tag(events(spark, sf_dir, places=True)), COUNTRY_PART))


@query
def compare_tag_count_updates(spark, sf_dir):
    return plain(compare.compare_count_updates(
        agg.tag_counts(views.tag_rows(views.english_with_text(docs(spark, sf_dir)))),
        views.tag_rows(views.english_with_text(events(spark, sf_dir)))))


@query
def compare_users_updates(spark, sf_dir):
    return plain(compare.compare_user_updates(
        agg.users_per_tag(views.tag_user(docs(spark, sf_dir)), USER_PART),
        views.tag_user(events(spark, sf_dir)), USER_PART))


@query
def compare_country_tags_updates(spark, sf_dir):
    return plain(compare.compare_country_updates(
        agg.tags_per_country(views.country_tag(docs(spark, sf_dir, places=True)), COUNTRY_PART),
        views.country_tag(events(spark, sf_dir, places=True)), COUNTRY_PART))


# the other way round: here the recorded lists are the longer ones

@query
def compare_users_longer_record(spark, sf_dir):
    return compare.compare_users(
        agg.users_per_tag(views.tag_user(events(spark, sf_dir)), USER_PART),
        agg.users_per_tag(views.tag_user(docs(spark, sf_dir)), USER_PART))


@query
def compare_users_updates_longer_record(spark, sf_dir):
    return plain(compare.compare_user_updates(
        agg.users_per_tag(views.tag_user(events(spark, sf_dir)), USER_PART),
        views.tag_user(docs(spark, sf_dir)), USER_PART))


@query
def recorded_result_sizes(spark, sf_dir):
    """How many groups each recorded result has."""
    english = views.tag_rows(views.english_with_text(docs(spark, sf_dir)))
    sizes = [
        agg.tag_counts(english).agg(F.count("*").alias("groups")).withColumn("result", F.lit("counts")),
        views.tag_user(docs(spark, sf_dir)).agg(F.count_distinct("tag").alias("groups")).withColumn("result", F.lit("users")),
        views.country_tag(docs(spark, sf_dir, places=True)).agg(
            F.count_distinct("country").alias("groups")).withColumn("result", F.lit("countries")),
    ]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


# reshaping

@query
def recorded_series(spark, sf_dir):
    means = running.running_mean_words(agg.post_words(docs(spark, sf_dir)))
    series = reshape.recorded_series(reshape.parse_series(reshape.series_lines(means)), COUNTRY_PART)
    points = series.select("tag", "part", F.posexplode("series").alias("place", "point"))
    return points.select("tag", "part", F.col("place").cast("long").alias("place"), "point.*")


def _rides(spark, sf_dir) -> DataFrame:
    """Order lines as ride records of 14 fields: ordered is the start, shipped the end."""
    lines = table(spark, sf_dir, "lineitem").join(
        table(spark, sf_dir, "orders"), F.col("l_orderkey") == F.col("o_orderkey"))
    text = lambda c: F.col(c).cast("string")
    none = F.lit("")
    fields = F.array(
        text("l_orderkey"), text("l_linenumber"), none, none, none, text("o_orderdate"), text("l_shipdate"),
        text("l_quantity"), none, none, text("l_returnflag"), text("l_linestatus"), text("l_partkey"), text("l_suppkey"))
    return lines.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate", fields.alias("fields"))


RIDE_ORDER = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_shipdate"]


@query
def start_end_events(spark, sf_dir):
    rides = reshape.place_by_time(reshape.trip_events(_rides(spark, sf_dir), RIDE_ORDER))
    seconds = lambda c: F.unix_seconds(F.col(c).cast("timestamp"))
    return rides.withColumns({"at_s": seconds("at"), "other_s": seconds("other")}).drop("at", "other")


@query
def row_numbered_projection(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    fields = F.array(*[F.col(c).cast("string") for c in lines.columns])
    rows = lines.select(*[F.col(c).alias(f"_{c}") for c in RIDE_ORDER], fields.alias("fields"))
    return reshape.fares(rows, [f"_{c}" for c in RIDE_ORDER])


@query
def tag_keyword_filter(spark, sf_dir):
    return views.with_keyword_tag(docs(spark, sf_dir), ["rc1", "fr"]).select("tweet_id", "lang")


@query
def english_word_counts(spark, sf_dir):
    return views.word_units(docs(spark, sf_dir)).groupBy("word").agg(F.sum("unit").alias("uses"))


@query
def unit_projections(spark, sf_dir):
    """(tag, user, 1), its pair without the unit, and (tag, 1): each summed per tag."""
    units = views.tag_user_unit(events(spark, sf_dir))
    pairs = units.drop("unit").groupBy("tag").agg(F.count_distinct("user_name").alias("users"))
    ones = views.tag_unit(units).groupBy("tag").agg(F.sum("unit").alias("uses"))
    return ones.join(pairs, "tag")


@query
def raw_units(spark, sf_dir):
    """(raw line, 1) per hashtag; the line is shown by its user and the length of its text."""
    units = views.raw_unit(parse_tweets(to_lines(docs(spark, sf_dir)), with_line=True))
    return units.select(
        F.get_json_object("value", "$.user.name").alias("user_name"),
        F.length(F.get_json_object("value", "$.text")).cast("long").alias("chars"), "unit")


# live twins: the table is read as a stream until its end

@query
def stream_tag_count(spark, sf_dir):
    out = fresh_folder(spark, "counts")
    to_updates(live.tag_counts(live_docs(spark, sf_dir)), f"{out}/log", f"{out}/progress", ONCE).awaitTermination()
    return latest_updates(spark, f"{out}/log", ["tag"])


@query
def stream_users_per_tag(spark, sf_dir):
    out = fresh_folder(spark, "users")
    rows = live.new_users(live_events(spark, sf_dir))
    start_lists(rows, "tag", "user_name", out, f"{out}/progress", USER_PART, mode="update", trigger=ONCE).awaitTermination()
    return read_lists(spark, out, "tag").select("tag", "part", F.array_join("items", ";").alias("users"))


@query
def stream_tags_per_country(spark, sf_dir):
    out = fresh_folder(spark, "countries")
    rows = views.country_tag(live_docs(spark, sf_dir, places=True))
    start_lists(rows, "country", "tag", out, f"{out}/progress", COUNTRY_PART, trigger=ONCE).awaitTermination()
    parts = read_lists(spark, out, "country")
    return agg.with_country_prefix(
        parts.select("country", "part", F.concat(F.array_join("items", ";"), F.lit(";")).alias("tags")))


@query
def stream_avg_words(spark, sf_dir):
    out = fresh_folder(spark, "means")
    to_updates(live.mean_words(live_docs(spark, sf_dir)), f"{out}/log", f"{out}/progress", ONCE).awaitTermination()
    return plain(latest_updates(spark, f"{out}/log", ["tag"]))


def _closed(spark, name, windows) -> DataFrame:
    out = fresh_folder(spark, name)
    to_files(windows, f"{out}/rows", f"{out}/progress", trigger=ONCE).awaitTermination()
    return plain(spark.read.schema(windows.schema).parquet(f"{out}/rows"))


@query
def stream_longest_word(spark, sf_dir):
    return _closed(spark, "longest", live.longest_words(live_docs(spark, sf_dir), tags=TAGS))


@query
def stream_window_avg_words(spark, sf_dir):
    return _closed(spark, "hours", live.window_mean_words(live_docs(spark, sf_dir), "10 minutes"))


@query
def stream_window_user_counts(spark, sf_dir):
    return _closed(spark, "hourly-users", live.window_users(live_events(spark, sf_dir), "1 hour"))


@query
def stream_regression_scored(spark, sf_dir):
    model = regression.fit(agg.token_stats(agg.token_rows(docs(spark, sf_dir))), "tokens", "longest")
    cells = live.scored_token_stats(live_docs(spark, sf_dir), checkpointed(model))
    return rounded(_closed(spark, "scores", cells), "prediction")


@query
def stream_online_regression(spark, sf_dir):
    out = fresh_folder(spark, "user-model")
    cells = live.window_users(live_events(spark, sf_dir), "1 hour")
    start_online_regression(cells, "uses", "users", out, f"{out}/progress", trigger=ONCE).awaitTermination()
    return rounded(plain(read_predictions(spark, out)), "prediction")


@query
def stream_online_regression_words(spark, sf_dir):
    out = fresh_folder(spark, "word-model")
    cells = live.window_mean_words(live_docs(spark, sf_dir), "1 minute")
    start_online_regression(cells, "posts", "avg_words", out, f"{out}/progress", xy="words", trigger=ONCE).awaitTermination()
    scored = rounded(plain(read_predictions(spark, out)), "avg_words", "prediction")
    return scored.select("window_s", "tag", "avg_words", "prediction")


@query
def stream_compare_tag_count(spark, sf_dir):
    out = fresh_folder(spark, "compared")
    recorded = checkpointed(agg.tag_counts(views.tag_rows(views.english_with_text(docs(spark, sf_dir)))))
    rows = live.compared_counts(live_events(spark, sf_dir), recorded)
    to_updates(rows, f"{out}/log", f"{out}/progress", ONCE).awaitTermination()
    return latest_updates(spark, f"{out}/log", ["tag"])


@query
def stream_compare_users(spark, sf_dir):
    out = fresh_folder(spark, "compared-users")
    recorded = checkpointed(agg.users_per_tag(views.tag_user(docs(spark, sf_dir)), USER_PART))
    rows = live.new_users(live_events(spark, sf_dir))
    start_lists(rows, "tag", "user_name", out, f"{out}/progress", USER_PART, recorded, "update", ONCE).awaitTermination()
    return read_compared(spark, out, "tag")


@query
def stream_compare_users_longer_record(spark, sf_dir):
    out = fresh_folder(spark, "compared-users")
    recorded = checkpointed(agg.users_per_tag(views.tag_user(events(spark, sf_dir)), USER_PART))
    rows = live.new_users(live_docs(spark, sf_dir))
    start_lists(rows, "tag", "user_name", out, f"{out}/progress", USER_PART, recorded, "update", ONCE).awaitTermination()
    return read_compared(spark, out, "tag")


@query
def stream_compare_country_tags(spark, sf_dir):
    out = fresh_folder(spark, "compared-countries")
    recorded = checkpointed(agg.tags_per_country(views.country_tag(docs(spark, sf_dir, places=True)), COUNTRY_PART))
    rows = views.country_tag(live_events(spark, sf_dir, places=True))
    start_lists(rows, "country", "tag", out, f"{out}/progress", COUNTRY_PART, recorded, trigger=ONCE).awaitTermination()
    return read_compared(spark, out, "country")


# every single update of a stream

@query
def stream_running_tag_count(spark, sf_dir):
    out = fresh_folder(spark, "count-updates")
    rows = views.tag_rows(views.english_with_text(live_events(spark, sf_dir)))
    updates.start_counts(rows, out, f"{out}/progress", trigger=ONCE).awaitTermination()
    return plain(updates.read_updates(spark, out))


@query
def stream_running_avg_words(spark, sf_dir):
    out = fresh_folder(spark, "mean-updates")
    updates.start_mean_words(agg.post_words(live_docs(spark, sf_dir)), out, f"{out}/progress", trigger=ONCE).awaitTermination()
    return plain(updates.read_mean_words(spark, out))


@query
def stream_compare_tag_count_updates(spark, sf_dir):
    out = fresh_folder(spark, "compared-updates")
    recorded = checkpointed(agg.tag_counts(views.tag_rows(views.english_with_text(docs(spark, sf_dir)))))
    rows = views.tag_rows(views.english_with_text(live_events(spark, sf_dir)))
    updates.start_compared_counts(rows, recorded, out, f"{out}/progress", trigger=ONCE).awaitTermination()
    return plain(updates.read_compared_counts(spark, out))


# posts parsed once, and results kept up by increments

def _layer(spark, tweets) -> DataFrame:
    out = fresh_folder(spark, "layer")
    layer.start_layer(to_lines(tweets), f"{out}/posts", f"{out}/progress", trigger=ONCE).awaitTermination()
    return layer.read_posts(spark, f"{out}/posts")


@query
def layer_tag_count(spark, sf_dir):
    return programs.tag_counts(_layer(spark, live_docs(spark, sf_dir)))


@query
def layer_users_per_tag(spark, sf_dir):
    return programs.users_per_tag(_layer(spark, live_events(spark, sf_dir)), USER_PART)


def _increments(spark, posts, name, **options) -> DataFrame:
    out = fresh_folder(spark, "increments")
    increments.start_increments(posts, out, f"{out}/progress", [name], trigger=ONCE, **options).awaitTermination()
    return plain(increments.read_result(spark, out, name))


@query
def increments_tag_count(spark, sf_dir):
    return _increments(spark, live_docs(spark, sf_dir), "tag_counts")


@query
def increments_avg_words(spark, sf_dir):
    return _increments(spark, live_docs(spark, sf_dir), "mean_words")


@query
def increments_longest_word(spark, sf_dir):
    return _increments(spark, live_docs(spark, sf_dir), "longest_words")


@query
def increments_token_stats(spark, sf_dir):
    return _increments(spark, live_docs(spark, sf_dir), "token_stats")


# streams that have ended: the last windows too

def _finished(spark, name, tweets, windows, tags=("end",)) -> DataFrame:
    out = fresh_folder(spark, name)
    cells = windows(live.with_end(tweets, f"{out}/end"))
    live.finish(lambda: to_files(cells, f"{out}/rows", f"{out}/progress", trigger=ONCE), spark, f"{out}/end", tags)
    return plain(spark.read.schema(cells.schema).parquet(f"{out}/rows"))


@query
def stream_finished_longest_word(spark, sf_dir):
    return _finished(spark, "all-longest", live_docs(spark, sf_dir), lambda t: live.longest_words(t, tags=TAGS), TAGS)


@query
def stream_finished_avg_words(spark, sf_dir):
    return _finished(spark, "all-means", live_docs(spark, sf_dir), lambda t: live.window_mean_words(t, "10 minutes"))


@query
def stream_finished_user_counts(spark, sf_dir):
    return _finished(spark, "all-users", live_events(spark, sf_dir), lambda t: live.window_users(t, "1 hour"))


@query
def stream_finished_regression_scored(spark, sf_dir):
    model = checkpointed(regression.fit(agg.token_stats(agg.token_rows(docs(spark, sf_dir))), "tokens", "longest"))
    return rounded(_finished(spark, "all-scores", live_docs(spark, sf_dir), lambda t: live.scored_token_stats(t, model)), "prediction")


def _finished_regression(spark, name, tweets, windows, *columns, **options) -> DataFrame:
    out = fresh_folder(spark, name)
    cells = windows(live.with_end(tweets, f"{out}/end"))
    live.finish(lambda: start_online_regression(cells, *columns, out, f"{out}/progress", trigger=ONCE, **options), spark, f"{out}/end")
    return rounded(plain(read_predictions(spark, out)), "prediction")


@query
def stream_finished_online_regression(spark, sf_dir):
    return _finished_regression(
        spark, "whole-user-model", live_events(spark, sf_dir), lambda t: live.window_users(t, "1 hour"), "uses", "users")


@query
def stream_finished_online_regression_words(spark, sf_dir):
    scored = _finished_regression(
        spark, "whole-word-model", live_docs(spark, sf_dir), lambda t: live.window_mean_words(t, "1 minute"), "posts", "avg_words", xy="words")
    return rounded(scored, "avg_words").select("window_s", "tag", "avg_words", "prediction")


@query
def raw_log_copy(spark, sf_dir):
    out = fresh_folder(spark, "log")
    copy_log(to_lines(live_docs(spark, sf_dir)), f"{out}/lines", f"{out}/progress", ONCE).awaitTermination()
    line = F.col("value")
    return spark.read.text(f"{out}/lines").select(
        F.get_json_object(line, "$.user.name").alias("user_name"), F.get_json_object(line, "$.text").alias("text"))
