"""Live queries over several micro-batches, against the batch result of the same posts."""

import os
import random

import pytest
from pyspark.sql import functions as F

from fixtures import LINES, START, tuples, tweets_df
from tagpulse.operators import aggregates as agg
from tagpulse.operators import compare, regression, running, views
from tagpulse.plans import programs
from tagpulse.schema import TWEET
from tagpulse.sources import sinks
from tagpulse.sources.sinks import ONCE
from tagpulse.sources.posts import parse_tweets, read_lines, stream_lines
from tagpulse.streaming import live, updates
from tagpulse.streaming.keyed import KeyedTable, Record
from tagpulse.streaming.lists import read_compared, read_lists, start_lists
from tagpulse.streaming.online import read_predictions, start_online_regression

BATCHES = 3
SECONDS = 40


def posts():
    rng = random.Random(5)
    return [dict(at=i, hashtags=[rng.choice(["Hot", "hot", "cold"]), rng.choice("abc")], user_name=rng.choice("uvwxyz"),
                 country=rng.choice(["Peru", "Chad", None]), text="w " * rng.randrange(6) + "x" * rng.randrange(1, 9))
            for i in range(SECONDS * BATCHES)]


def write_files(spark, folder, data, first=0):
    """One file per batch, in time order."""
    for n in range(0, len(data), SECONDS):
        number = first + n // SECONDS
        part = [dict(p, tweet_id=number * SECONDS + i) for i, p in enumerate(data[n:n + SECONDS])]
        df = tweets_df(spark, part)
        name = f"{folder}/part-{number}"
        df.coalesce(1).write.parquet(name)
        for f in os.listdir(name):
            if f.endswith(".parquet"):
                os.rename(f"{name}/{f}", f"{folder}/{number}.parquet")
        os.utime(f"{folder}/{number}.parquet", (1700000000 + number, 1700000000 + number))


@pytest.fixture
def both(spark, tmp_path):
    folder = tmp_path / "posts"
    folder.mkdir()
    data = posts()
    write_files(spark, str(folder), data)
    stream = spark.readStream.schema(TWEET).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
    return tweets_df(spark, data), stream, str(folder), str(tmp_path)


def done(query):
    query.awaitTermination()
    assert query.lastProgress is None or query.exception() is None
    return query


def test_counts_and_means(spark, both):
    tweets, stream, _, tmp = both
    query = done(sinks.to_updates(live.tag_counts(stream), f"{tmp}/counts", f"{tmp}/c1", ONCE))
    assert len(query.recentProgress) >= BATCHES
    expected = agg.tag_counts(views.tag_rows(views.english_with_text(tweets)))
    assert tuples(sinks.latest_updates(spark, f"{tmp}/counts", ["tag"])) == tuples(expected)
    done(sinks.to_updates(live.mean_words(stream, ["hot"], normalize=False), f"{tmp}/means", f"{tmp}/c2", ONCE))
    expected = agg.mean_words(agg.post_words(tweets, ["hot"], normalize=False))
    assert tuples(sinks.latest_updates(spark, f"{tmp}/means", ["tag"])) == tuples(expected)


def test_each_user_is_new_once(spark, both):
    tweets, stream, _, tmp = both
    done(sinks.to_updates(live.new_users(stream), f"{tmp}/new", f"{tmp}/c", ONCE))
    log = spark.read.parquet(f"{tmp}/new")
    assert tuples(log.drop("batch_id")) == tuples(agg.first_uses(views.tag_user(tweets)))
    assert log.select("batch_id").distinct().count() > 1


@pytest.mark.parametrize("part_size", [4, 1000])
def test_lists(spark, both, part_size):
    tweets, stream, _, tmp = both
    rows = views.country_tag(tweets)
    expected = agg.tags_per_country(rows, part_size)
    recorded = agg.tags_per_country(rows.where("country = 'Peru'"), part_size)
    done(start_lists(views.country_tag(stream), "country", "tag", f"{tmp}/out", f"{tmp}/c", part_size, recorded, trigger=ONCE))
    parts = read_lists(spark, f"{tmp}/out", "country")
    assert tuples(parts.select("country", "part", F.concat(F.array_join("items", ";"), F.lit(";")))) == tuples(expected)
    compared = compare.compare_country_tags(recorded, expected)
    assert tuples(read_compared(spark, f"{tmp}/out", "country")) == tuples(compared)

    done(start_lists(live.new_users(stream), "tag", "user_name", f"{tmp}/users", f"{tmp}/c2", part_size, mode="update", trigger=ONCE))
    users = read_lists(spark, f"{tmp}/users", "tag").select("tag", "part", F.array_join("items", ";"))
    assert tuples(users) == tuples(agg.users_per_tag(views.tag_user(tweets), part_size))


def closed(df, seconds, delay=0):
    last = SECONDS * BATCHES - 1 - delay
    return df.where((F.unix_seconds("window_end") - int((START - type(START)(1970, 1, 1)).total_seconds())) <= last)


def test_windows(spark, both):
    tweets, stream, _, tmp = both
    cases = {
        "longest": (live.longest_words(stream, delay="0 seconds"), agg.longest_words(agg.longest_word_rows(tweets), "20 seconds"), 20),
        "means": (live.window_mean_words(stream, "30 seconds", delay="0 seconds"), agg.mean_words(agg.post_words(tweets), "30 seconds"), 30),
        "users": (live.window_users(stream, delay="0 seconds"), agg.window_users(views.tag_user(tweets), "10 seconds"), 10),
    }
    for name, (windows, expected, seconds) in cases.items():
        done(sinks.to_files(windows, f"{tmp}/{name}", f"{tmp}/c-{name}", trigger=ONCE))
        assert tuples(spark.read.parquet(f"{tmp}/{name}")) == tuples(closed(expected, seconds)), name


def test_scores(spark, both):
    tweets, stream, _, tmp = both
    model = regression.fit(agg.token_stats(agg.token_rows(tweets)), "tokens", "longest")
    done(sinks.to_files(live.scored_token_stats(stream, model, delay="0 seconds"), f"{tmp}/s", f"{tmp}/c", trigger=ONCE))
    cells = closed(agg.token_stats(agg.token_rows(tweets), "10 seconds"), 10)
    assert tuples(spark.read.parquet(f"{tmp}/s")) == tuples(regression.score(cells, model, "tokens"))


def rounded(df):
    return tuples(df.withColumn("prediction", F.round("prediction", 9)))


def test_online_regression_with_restart_and_repeated_batch(spark, both):
    tweets, stream, folder, tmp = both
    cells = live.window_users(stream, delay="0 seconds")
    start = lambda: done(start_online_regression(cells, "uses", "users", f"{tmp}/out", f"{tmp}/c", trigger=ONCE))
    start()
    whole = regression.online_predictions(closed(agg.window_users(views.tag_user(tweets), "10 seconds"), 10), "uses", "users")
    first = rounded(read_predictions(spark, f"{tmp}/out"))
    assert first == rounded(whole)

    # lose the record that the last batch was finished: it runs again
    commits = sorted((f for f in os.listdir(f"{tmp}/c/commits") if f.isdigit()), key=int)
    for name in (commits[-1], f".{commits[-1]}.crc"):
        os.remove(f"{tmp}/c/commits/{name}")
    start()
    assert rounded(read_predictions(spark, f"{tmp}/out")) == first

    # more posts, same query
    more = [dict(p, at=p["at"] + SECONDS * BATCHES) for p in posts()]
    write_files(spark, folder, more, BATCHES)
    start()
    cells = agg.window_users(views.tag_user(tweets_df(spark, posts() + more)), "10 seconds")
    last = SECONDS * BATCHES * 2 - 1
    cells = cells.where(F.unix_seconds("window_end") - 1704067200 <= last)
    assert rounded(read_predictions(spark, f"{tmp}/out")) == rounded(regression.online_predictions(cells, "uses", "users"))


def test_late_posts_are_dropped_after_the_delay(spark, tmp_path):
    folder = tmp_path / "late"
    folder.mkdir()
    write_files(spark, str(folder), [dict(at=i) for i in range(SECONDS)])
    write_files(spark, str(folder), [dict(at=SECONDS)], 1)
    write_files(spark, str(folder), [dict(at=0)], 2)
    stream = spark.readStream.schema(TWEET).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
    done(sinks.to_files(live.window_mean_words(stream, "10 seconds", delay="0 seconds"), f"{tmp_path}/w", f"{tmp_path}/c", trigger=ONCE))
    assert [r.posts for r in spark.read.parquet(f"{tmp_path}/w").collect()] == [10] * (SECONDS // 10)


def test_programs_from_lines(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    for n in range(3):
        (folder / f"{n}.json").write_text("\n".join(LINES), encoding="utf-8")
        os.utime(folder / f"{n}.json", (1700000000 + n, 1700000000 + n))
    lines = stream_lines(spark, str(folder), 1)
    recorded = read_lines(spark, str(folder))
    out = lambda name: str(tmp_path / name)
    done(programs.start_compare_counts(recorded, lines, out("counts"), out("c1"), ONCE))
    assert tuples(updates.read_latest_counts(spark, out("counts"))) == [
        ("japan", "Batch-Value: 9  Stream-Value:9"), ("usa", "Batch-Value: 3  Stream-Value:3")]
    done(programs.start_compare_count_updates(recorded, lines, out("each"), out("c6"), ONCE))
    each = updates.read_compared_counts(spark, out("each")).orderBy("tag", "ts", "tweet_id", "tag_pos")
    assert [r.result for r in each.collect()] == [
        *[f"Batch-Value: 9  Stream-Value:{n}" for n in range(1, 10)], *[f"Batch-Value: 3  Stream-Value:{n}" for n in range(1, 4)]]
    done(programs.start_compare_users(recorded, lines, out("users"), out("c2"), trigger=ONCE))
    users = dict(tuples(read_compared(spark, out("users"), "tag"), "tag", "result"))
    assert users["usa"] == "Batch-Value: ann  Stream-Value:ann"
    # in the order of their lines, as in the record
    assert users["japan"] == "Batch-Value: ann;bob;c  Stream-Value:ann;bob;c"
    done(programs.start_compare_country_tags(recorded, lines, out("tags"), out("c3"), trigger=ONCE))
    tags = "japan;usa;japan;usa;japan;usa"
    assert tuples(read_compared(spark, out("tags"), "country")) == [("Japan", 0, f"Batch-Value: {tags};  Stream-Value:{tags}")]
    done(sinks.copy_log(lines, out("log"), out("c4"), ONCE))
    assert sorted(r.value for r in spark.read.text(out("log")).collect()) == sorted(LINES * 3)
    done(sinks.to_console(programs.live_tag_counts(lines), out("c5"), 30, trigger=ONCE))
    for name, frame in {"a": programs.live_mean_words(lines), "b": programs.live_mean_words_by_case(lines)}.items():
        done(sinks.to_updates(frame, out(f"m{name}"), out(f"cm{name}"), ONCE))
    assert tuples(sinks.latest_updates(spark, out("mb"), ["tag"])) == [("Japan", 4.0, 3), ("USA", 4.0, 3), ("japan", 2.0, 6)]
    for name, frame in {"w": programs.live_window_mean_words(lines), "l": programs.live_longest_words(lines, tags=programs.COUNTRY_TAGS),
                        "s": programs.live_longest_word_scores(recorded, lines)}.items():
        done(sinks.to_files(frame, out(name), out(f"c{name}"), trigger=ONCE))
    done(programs.start_user_regression(lines, out("r1"), out("cr1"), trigger=ONCE))
    done(programs.start_mean_words_regression(lines, out("r2"), out("cr2"), trigger=ONCE))


def test_recorded_programs(spark, tmp_path):
    (tmp_path / "a.json").write_text("\n".join(LINES), encoding="utf-8")
    lines = read_lines(spark, str(tmp_path))
    assert tuples(programs.tags_per_country(lines)) == [("Japan", 0, "Japan:japan;usa;")]
    assert tuples(programs.users_per_tag(lines)) == [("empty", 0, "ann"), ("japan", 0, "ann;bob;c"), ("usa", 0, "ann")]
    assert tuples(programs.longest_words(lines, programs.COUNTRY_TAGS)) == [("japan", "three", 5), ("usa", "three", 5)]
    assert programs.longest_word_model(lines).first().points == 2
    assert programs.keyword_posts(lines, ["usa"]).count() == 1
    assert programs.longest_words(lines).count() == 0  # they look for tags of their own


def test_longer_records_are_shown_whole(spark, tmp_path):
    """Ten recorded users, three live ones, parts of four: all three parts, also where nothing is live."""
    recorded = agg.users_per_tag(views.tag_user(tweets_df(spark, [dict(at=i, hashtags=["t"], user_name=f"r{i}") for i in range(10)])), 4)
    data = [dict(at=i, hashtags=["t"], user_name=f"l{i // 2}") for i in range(6)]
    live_rows = views.tag_user(tweets_df(spark, data))
    label = lambda old, new: f"Batch-Value: {old}  Stream-Value:{new}"
    expected = [("t", 0, label("r0;r1;r2;r3", "l0;l1;l2")), ("t", 1, label("r4;r5;r6;r7", "")), ("t", 2, label("r8;r9", ""))]
    assert tuples(compare.compare_users(recorded, agg.users_per_tag(live_rows, 4))) == expected
    updates = compare.compare_user_updates(recorded, live_rows, 4).select("tag", "part", "result", "tweet_id")
    assert sorted((r.part, r.result) for r in updates.collect() if r.part) == [(1, expected[1][2]), (2, expected[2][2])]
    assert updates.where("part = 0").count() == 6

    folder = tmp_path / "posts"
    folder.mkdir()
    for n in range(3):
        df = tweets_df(spark, [dict(p, tweet_id=2 * n + i) for i, p in enumerate(data[2 * n:2 * n + 2])])
        df.coalesce(1).write.parquet(str(folder / f"part-{n}"))
        for f in (folder / f"part-{n}").glob("*.parquet"):
            f.rename(folder / f"{n}.parquet")
        os.utime(folder / f"{n}.parquet", (1700000000 + n, 1700000000 + n))
    stream = spark.readStream.schema(TWEET).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
    done(start_lists(live.new_users(stream), "tag", "user_name", str(tmp_path / "out"), str(tmp_path / "c"), 4, recorded, "update", ONCE))
    assert tuples(read_compared(spark, str(tmp_path / "out"), "tag")) == expected


def test_live_lines_keep_the_order_of_their_file(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    names = ["ann", "bob", "cid", "dan", "eve", "fay"]
    for n in range(2):
        lines = [f'{{"text":"x","lang":"en","user":{{"name":"{name}{n}"}},"entities":{{"hashtags":[{{"text":"t"}}]}}}}' for name in names]
        (folder / f"{n}.json").write_text("\n".join([*lines, lines[0]]) + "\n", encoding="utf-8")
        os.utime(folder / f"{n}.json", (1700000000 + n, 1700000000 + n))
    rows = live.new_users(parse_tweets(stream_lines(spark, str(folder), 2)))
    done(start_lists(rows, "tag", "user_name", str(tmp_path / "out"), str(tmp_path / "c"), 100, mode="update", trigger=ONCE))
    listed = read_lists(spark, str(tmp_path / "out"), "tag").first()["items"]
    assert listed == [f"{name}{n}" for n in range(2) for name in names]
    batch = agg.users_per_tag(views.tag_user(parse_tweets(read_lines(spark, str(folder)))), 100).first().users
    assert batch.split(";") == listed


def test_live_tables_stay_small(spark, tmp_path):
    """Thirteen batches, compacted every fourth: few folders, the same result, also after the last batch is repeated."""
    folder = tmp_path / "posts"
    folder.mkdir()
    data = posts()[:26]
    for n in range(13):
        df = tweets_df(spark, [dict(p, tweet_id=2 * n + i) for i, p in enumerate(data[2 * n:2 * n + 2])])
        df.coalesce(1).write.parquet(str(folder / f"part-{n}"))
        for f in (folder / f"part-{n}").glob("*.parquet"):
            f.rename(folder / f"{n}.parquet")
        os.utime(folder / f"{n}.parquet", (1700000000 + n, 1700000000 + n))
    stream = spark.readStream.schema(TWEET).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
    tweets = tweets_df(spark, data)
    rows, out = views.country_tag(tweets), str(tmp_path / "out")
    recorded = agg.tags_per_country(rows, 2)
    start = lambda: done(start_lists(
        views.country_tag(stream), "country", "tag", out, str(tmp_path / "c"), 4, recorded, trigger=ONCE, compact_every=4))
    check = lambda: (
        tuples(read_lists(spark, out, "country").select("country", "part", F.concat(F.array_join("items", ";"), F.lit(";"))))
        == tuples(agg.tags_per_country(rows, 4))
        and tuples(read_compared(spark, out, "country")) == tuples(compare.compare_country_tags(recorded, agg.tags_per_country(rows, 4))))
    start()
    assert check()
    # of a bucket: folders that have not been merged yet, a few that have been, and those that readers may still hold
    count = lambda name: max(len(os.listdir(f"{out}/{name}/{b}")) for b in os.listdir(f"{out}/{name}") if b.startswith("bucket="))
    assert len([f for f in os.listdir(f"{out}/items") if f.startswith("batch_id=")]) == 1
    assert all(count(name) <= 13 for name in ("state", "lists", "compared"))
    last = max((f for f in os.listdir(tmp_path / "c" / "commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(tmp_path / "c" / "commits" / name)
    start()
    assert check()

    log = str(tmp_path / "log")
    done(sinks.to_updates(live.tag_counts(stream), log, str(tmp_path / "c2"), ONCE, ["tag"], 4))
    # what was merged in the last round stays for readers that have listed it
    assert len([f for f in os.listdir(log) if f.startswith("batch_id=")]) <= 7
    assert tuples(sinks.latest_updates(spark, log, ["tag"])) == tuples(agg.tag_counts(views.tag_rows(views.english_with_text(tweets))))


def repeat_last_batch(checkpoint):
    """Loses the record that the last batch was finished."""
    last = max((f for f in os.listdir(f"{checkpoint}/commits") if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.remove(f"{checkpoint}/commits/{name}")


def test_every_update_of_three_batches_one_repeated(spark, both):
    tweets, stream, folder, tmp = both
    rows, arriving = (views.tag_rows(views.english_with_text(t)) for t in (tweets, stream))
    recorded = agg.tag_counts(rows.where("tag <> 'a'"))
    starts = {
        "counts": lambda: updates.start_counts(arriving, f"{tmp}/counts", f"{tmp}/c-counts", trigger=ONCE),
        "means": lambda: updates.start_mean_words(agg.post_words(stream), f"{tmp}/means", f"{tmp}/c-means", trigger=ONCE),
        "compared": lambda: updates.start_compared_counts(arriving, recorded, f"{tmp}/compared", f"{tmp}/c-compared", trigger=ONCE, compact_every=1, buckets=2)}
    results = lambda: (
        tuples(updates.read_updates(spark, f"{tmp}/counts")), tuples(updates.read_mean_words(spark, f"{tmp}/means")),
        tuples(updates.read_compared_counts(spark, f"{tmp}/compared")))
    expected = lambda t: (
        tuples(running.running_counts(views.tag_rows(views.english_with_text(t)))), tuples(running.running_mean_words(agg.post_words(t))),
        tuples(compare.compare_count_updates(recorded, views.tag_rows(views.english_with_text(t)))))
    for start in starts.values():
        done(start())
    assert results() == expected(tweets)
    assert len([f for f in os.listdir(f"{tmp}/counts/updates") if f.startswith("batch_id=")]) >= BATCHES
    more = [dict(p, at=p["at"] + SECONDS * BATCHES) for p in posts()]
    write_files(spark, folder, more, BATCHES)
    for name, start in starts.items():
        repeat_last_batch(f"{tmp}/c-{name}")
        done(start())
    assert results() == expected(tweets_df(spark, posts() + more))


def bytes_by_batch(folder):
    """Bytes of files in folders batch_id=n, at any depth."""
    found = {}
    for at, _, files in os.walk(folder):
        number = [p for p in at.split("/") if p.startswith("batch_id=")]
        if number:
            found[int(number[-1][9:])] = found.get(int(number[-1][9:]), 0) + sum(
                os.path.getsize(f"{at}/{f}") for f in files if f.endswith(".parquet"))
    return found


def test_a_batch_writes_what_it_touches(spark, tmp_path):
    """The same two batches, after a first one of 20 and of 2,000 other keys: as many bytes."""
    written = {}
    for keys in (20, 2000):
        folder = tmp_path / f"posts-{keys}"
        folder.mkdir()
        first = [dict(at=0, hashtags=[f"k{k}"], country=f"c{k}") for k in range(keys)]
        data = [first, *[[dict(at=n, hashtags=["t"], country="new"), dict(at=n, hashtags=["u"], country="c1")] for n in (1, 2)]]
        for n, some in enumerate(data):
            df = tweets_df(spark, [dict(p, tweet_id=10_000 * n + i) for i, p in enumerate(some)])
            df.coalesce(1).write.parquet(str(folder / f"part-{n}"))
            for f in (folder / f"part-{n}").glob("*.parquet"):
                f.rename(folder / f"{n}.parquet")
            os.utime(folder / f"{n}.parquet", (1700000000 + n, 1700000000 + n))
        stream = spark.readStream.schema(TWEET).option("maxFilesPerTrigger", 1).parquet(f"{folder}/*.parquet")
        out = tmp_path / f"out-{keys}"
        recorded = agg.tags_per_country(views.country_tag(tweets_df(spark, first)), 4)
        done(start_lists(views.country_tag(stream), "country", "tag", str(out), f"{out}-c", 4, recorded, trigger=ONCE, compact_every=1))
        done(updates.start_counts(views.tag_rows(stream), f"{out}-n", f"{out}-n-c", trigger=ONCE, compact_every=1))
        expected = agg.tags_per_country(views.country_tag(tweets_df(spark, sum(data, []))), 4)
        assert tuples(read_lists(spark, str(out), "country").select("country", "part", F.concat(F.array_join("items", ";"), F.lit(";")))) == tuples(expected)
        written[keys] = [
            {n: size for n, size in bytes_by_batch(at).items() if n > 0} for at in (f"{out}/state", f"{out}/lists", f"{out}/compared", f"{out}-n/totals")]
    for few, many in zip(written[20], written[2000]):
        assert few.keys() == many.keys() and all(abs(few[n] - many[n]) < 200 for n in few)


def test_a_record_is_read_by_the_buckets_of_the_keys(spark, tmp_path):
    rows = tweets_df(spark, [dict(at=i, hashtags=[f"k{i % 500}"], user_name=f"u{i}") for i in range(1500)])
    recorded = agg.users_per_tag(views.tag_user(rows), 2)
    record = Record(recorded, str(tmp_path / "record"), "tag", 64)
    whole = {f for f in spark.read.parquet(str(tmp_path / "record")).inputFiles()}
    one = record.lookup(spark.createDataFrame([("k7",)], "tag string"))
    assert len({os.path.dirname(f) for f in one.inputFiles()}) == 1 and len(whole) > 30
    assert tuples(one) == [("k7", 0, "u7;u507", 1), ("k7", 1, "u1007", None)]
    nothing = record.lookup(spark.createDataFrame([], "tag string"))
    assert nothing.collect() == [] and nothing.columns == one.columns
    before = {f: os.path.getmtime(f"{tmp_path}/record/{f}") for f in os.listdir(tmp_path / "record")}
    again = Record(recorded, str(tmp_path / "record"), "tag", 64)  # written once
    assert tuples(again.lookup(one.select("tag"))) == tuples(one)
    assert before == {f: os.path.getmtime(f"{tmp_path}/record/{f}") for f in os.listdir(tmp_path / "record")}


def test_keyed_tables_under_random_batches(spark, tmp_path):
    """As a dictionary, with merges at every batch, batches repeated, and a reader that holds an old listing."""
    rng = random.Random(2)
    table = KeyedTable(spark, str(tmp_path / "t"), ["k"], "k string, v long", 4)
    known, held = {}, None
    for batch in range(20):
        size = 40 if batch % 8 == 0 else 3
        rows = {f"k{rng.randrange(60)}": rng.randrange(1000) for _ in range(size)}
        df = spark.createDataFrame(list(rows.items()), "k string, v long")
        assert dict(tuples(table.lookup(df, batch))) == {k: known[k] for k in rows if k in known}
        for _ in range(2 if batch % 5 == 0 else 1):
            table.write(df, batch)
            table.compact(batch)
        known |= rows
        assert dict(tuples(table.read())) == known
        if batch == 12:
            held, then = table.read(), dict(known)
        if batch == 15:
            assert dict(tuples(held)) == then  # merged since, not gone yet
    assert max(len(os.listdir(tmp_path / "t" / f"bucket={b}")) for b in range(4)) <= 14


def test_finished_streams_close_all_windows(spark, both):
    tweets, stream, _, tmp = both
    ended = lambda name: live.with_end(stream, f"{tmp}/{name}-end")
    cases = {
        "longest": (live.longest_words(ended("longest"), tags=["hot"]), agg.longest_words(agg.longest_word_rows(tweets, ["hot"]), "20 seconds")),
        "means": (live.window_mean_words(ended("means"), "30 seconds"), agg.mean_words(agg.post_words(tweets), "30 seconds")),
        "users": (live.window_users(ended("users")), agg.window_users(views.tag_user(tweets), "10 seconds")),
    }
    for name, (windows, expected) in cases.items():
        start = lambda: sinks.to_files(windows, f"{tmp}/{name}", f"{tmp}/c-{name}", trigger=ONCE)
        live.finish(start, spark, f"{tmp}/{name}-end", ["hot"])
        assert tuples(spark.read.parquet(f"{tmp}/{name}")) == tuples(expected), name
        live.finish(start, spark, f"{tmp}/{name}-end", ["hot"])  # after a failure: nothing twice
        assert tuples(spark.read.parquet(f"{tmp}/{name}")) == tuples(expected), name
    cells = live.window_users(ended("fit"))
    live.finish(lambda: start_online_regression(cells, "uses", "users", f"{tmp}/fit", f"{tmp}/c-fit", trigger=ONCE), spark, f"{tmp}/fit-end")
    whole = regression.online_predictions(agg.window_users(views.tag_user(tweets), "10 seconds"), "uses", "users")
    assert rounded(read_predictions(spark, f"{tmp}/fit")) == rounded(whole)


def test_a_large_file_is_read_by_many_tasks_in_order(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    size = "spark.sql.files.maxPartitionBytes"
    for n, count in enumerate((3000, 5, 400)):
        (folder / f"{n}.txt").write_text("".join(f"{n}:{k}\n" for k in range(count)) + "\n\nlast", encoding="utf-8")
        os.utime(folder / f"{n}.txt", (1700000000 + n, 1700000000 + n))
    before = spark.conf.get(size)
    spark.conf.set(size, "2000")
    try:
        lines = stream_lines(spark, str(folder)).withColumn("task", F.spark_partition_id())
        done(lines.writeStream.format("parquet").option("path", str(tmp_path / "out")).option("checkpointLocation", str(tmp_path / "c")).trigger(**ONCE).start())
    finally:
        spark.conf.set(size, before)
    rows = spark.read.parquet(str(tmp_path / "out")).orderBy("ts", "tweet_id").collect()
    expected = [v for n, count in enumerate((3000, 5, 400)) for v in [*(f"{n}:{k}" for k in range(count)), "", "", "last"]]
    assert [r.value for r in rows] == expected
    assert len({r.tweet_id for r in rows if r.value.startswith("0:")}) == 3000
    assert len({r.task for r in rows if r.value.startswith("0:")}) > 5
