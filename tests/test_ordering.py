"""Lists, numbers and running values, against plain Python; with a hot key over many ranges."""

import random

import pytest

from fixtures import tuples, tweets_df
from pyspark.sql import functions as F
from tagpulse.operators import aggregates as agg
from tagpulse.operators import compare, regression, running, views
from tagpulse.operators.ordering import arrange, numbered
from tagpulse.operators.ordering import running as running_values

RANGES = [1, 7]


def posts(count, seed=1):
    """A third of the hashtags and users are the same one; many posts share a second."""
    rng = random.Random(seed)
    pick = lambda name, n: name if rng.random() < 0.34 else f"{name}{rng.randrange(n)}"
    return [dict(hashtags=[pick("hot", 40), pick("tag", 9)], user_name=pick("u", 60), at=rng.randrange(20),
                 country=rng.choice(["Peru", "Peru", "Chad", None]), text="w " * rng.randrange(9)) for _ in range(count)]


def arrivals(data):
    """(tag, user, country, arrival) in arrival order."""
    rows = [((p["at"], i, j), t.lower(), p) for i, p in enumerate(data) for j, t in enumerate(p["hashtags"])]
    return sorted(rows, key=lambda r: r[0])


def test_hot_key_spans_ranges(spark):
    rows = views.tag_rows(tweets_df(spark, posts(600)))
    laid = arrange(rows, ["tag"], ["ts", "tweet_id", "tag_pos"], 7)
    spread = laid.where("tag = 'hot'").select("_range").distinct().count()
    assert laid.select("_range").distinct().count() == 7 and spread >= 2
    sizes = [r["count"] for r in laid.groupBy("_range").count().collect()]
    assert max(sizes) < 2 * sum(sizes) / len(sizes)


@pytest.mark.parametrize("ranges", RANGES)
def test_running_counts(spark, ranges):
    data = posts(400)
    seen, expected = {}, []
    for (at, i, j), tag, _ in arrivals(data):
        seen[tag] = seen.get(tag, 0) + 1
        expected.append((i, j, tag, seen[tag]))
    got = running.running_counts(views.tag_rows(tweets_df(spark, data)), ranges=ranges)
    assert tuples(got, "tweet_id", "tag_pos", "tag", "uses") == sorted(expected)


@pytest.mark.parametrize("ranges", RANGES)
def test_running_mean(spark, ranges):
    data = posts(300)
    sums, expected = {}, []
    for (at, i, j), tag, p in arrivals(data):
        n, s = sums.get(tag, (0, 0))
        sums[tag] = n, s = n + 1, s + p["text"].count(" ") + 1
        expected.append((i, j, tag, s / n, n))
    got = running.running_mean_words(agg.post_words(tweets_df(spark, data)), ranges)
    assert tuples(got, "tweet_id", "tag_pos", "tag", "avg_words", "posts") == sorted(expected)


@pytest.mark.parametrize("ranges", RANGES)
@pytest.mark.parametrize("part_size", [3, 1000])
def test_running_user_text(spark, ranges, part_size):
    data = posts(300)
    users, uses, expected = {}, {}, []
    for (at, i, j), tag, p in arrivals(data):
        known = users.setdefault(tag, [])
        uses[tag] = uses.get(tag, 0) + 1
        if p["user_name"] not in known:
            known.append(p["user_name"])
        part = (len(known) - 1) // part_size
        expected.append((i, j, tag, uses[tag], len(known), part, ";".join(known[part * part_size:])))
    got = running.running_user_text(views.tag_user(tweets_df(spark, data)), part_size, ranges=ranges)
    assert tuples(got, "tweet_id", "tag_pos", "tag", "uses", "users", "part", "text") == sorted(expected)


@pytest.mark.parametrize("ranges", RANGES)
@pytest.mark.parametrize("part_size", [4, 1000])
def test_country_lists(spark, ranges, part_size):
    data = posts(300)
    lists, expected = {}, []
    for (at, i, j), tag, p in arrivals(data):
        if p["country"]:
            so_far = lists.setdefault(p["country"], [])
            so_far.append(tag)
            part = (len(so_far) - 1) // part_size
            head = p["country"] + ":" if part == 0 else ""
            expected.append((i, j, head + ";".join(so_far[part * part_size:]) + ";"))
    rows = views.country_tag(tweets_df(spark, data))
    got = running.as_fold(running.running_tags(rows, part_size, ranges))
    assert tuples(got, "tweet_id", "tag_pos", "text") == sorted(expected)

    parts = sorted(tuple(r) for r in agg.with_country_prefix(agg.tags_per_country(rows, part_size, ranges)).collect())
    whole = {}
    for country, part, text in parts:
        assert part == len(whole.setdefault(country, []))
        whole[country].append(text)
    assert {c: "".join(t) for c, t in whole.items()} == {c: f"{c}:{';'.join(t)};" for c, t in lists.items()}


@pytest.mark.parametrize("ranges", RANGES)
def test_row_numbers(spark, ranges):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    assert all(r.v + 1 == r.position for r in numbered(df, [], ["v"], ranges=ranges).collect())


def test_null_order_values_and_lookup(spark):
    df = spark.createDataFrame([("a", None, 1), ("a", 2, 5), ("b", 1, 7), ("a", 3, 2)], "k string, o int, v long")
    known = spark.createDataFrame([("a", "x"), ("c", "y")], "k string, extra string")
    got = running_values(df, ["k"], ["o"], {"total": F.col("v")}, lookup=known, ranges=3)
    assert sorted(got.select("k", "v", "extra", "total").collect()) == [
        ("a", 1, "x", 1), ("a", 2, "x", 8), ("a", 5, "x", 6), ("b", 7, None, 7)]


def test_empty_input(spark):
    rows = views.tag_rows(tweets_df(spark, posts(5))).where("tag = 'none'")
    assert running.running_counts(rows).count() == 0


@pytest.mark.parametrize("ranges", RANGES)
def test_online_regression_matches_refitting(spark, ranges):
    rng = random.Random(3)
    points = [(w, t, rng.randrange(1, 6), rng.randrange(1, 9)) for w in range(12) for t in "abc"]
    df = spark.createDataFrame(points, "window_start int, tag string, x int, y int")
    got = {(r.window_start, r.tag): r.prediction for r in regression.online_predictions(df, "x", "y", ranges=ranges).collect()}
    for i, (w, t, x, _) in enumerate(points):
        xs, ys = [p[2] for p in points[:i + 1]], [p[3] for p in points[:i + 1]]
        n, den = len(xs), len(xs) * sum(v * v for v in xs) - sum(xs) ** 2
        if not den:
            assert (w, t) not in got
            continue
        slope = (n * sum(a * b for a, b in zip(xs, ys)) - sum(xs) * sum(ys)) / den
        assert got[w, t] == pytest.approx((sum(ys) - slope * sum(xs)) / n + slope * x)


def test_online_regression_in_two_runs(spark):
    points = [(w, t, (w * 7 + ord(t)) % 5, (w * 3 + ord(t)) % 4) for w in range(8) for t in "ab"]
    schema = "window_start int, tag string, x int, y int"
    whole = tuples(regression.online_predictions(spark.createDataFrame(points, schema), "x", "y"))
    old, new = spark.createDataFrame(points[:10], schema), spark.createDataFrame(points[10:], schema)
    before = regression.point_sums(old, "x", "y").first().asDict()
    assert sorted(tuples(regression.online_predictions(old, "x", "y"))
                  + tuples(regression.online_predictions(new, "x", "y", before=before))) == whole


def test_online_regression_of_large_counts(spark):
    """Products past 38 digits fall back to doubles rather than to nothing."""
    points = [(w, "a", 10 ** 17 * (w % 3 + 1), 10 ** 17 * (w % 3 + 1)) for w in range(6)]
    got = regression.online_predictions(spark.createDataFrame(points, "window_start int, tag string, x long, y long"), "x", "y")
    assert got.count() == 5
    assert all(r.prediction == pytest.approx(r.y) for r in got.collect())


@pytest.mark.parametrize("points,expected", [
    ([(1, 2)], (None, None, 1)), ([(3, 1), (3, 5)], (None, None, 2)), ([(1, 3), (2, 5), (3, 7)], (2.0, 1.0, 3)),
])
def test_fit(spark, points, expected):
    got = regression.fit(spark.createDataFrame(points, "x int, y int"), "x", "y").first()
    assert tuple(got) == expected
    scored = regression.score(spark.createDataFrame([(4,)], "x int"), regression.fit(spark.createDataFrame(points, "x int, y int"), "x", "y"), "x")
    assert scored.first().prediction == (9.0 if expected[0] else None)


def test_compare_lists_part_by_part(spark):
    schema = "tag string, part long, users string"
    recorded = spark.createDataFrame([("a", 0, "x;y"), ("a", 1, "z"), ("b", 0, "q"), ("d", 0, "m")], schema)
    live = spark.createDataFrame([("a", 0, "x"), ("c", 0, "r;s"), ("c", 1, "t"), ("d", 0, "m;n"), ("d", 1, "o")], schema)
    say = lambda old, new: f"Batch-Value: {old}  Stream-Value:{new}"
    assert tuples(compare.compare_users(recorded, live)) == [
        ("a", 0, say("x;y", "x")), ("a", 1, say("z", "")), ("c", 0, say("NONE", "r;s")), ("c", 1, say("", "t")),
        ("d", 0, say("m", "m;n")), ("d", 1, say("", "o"))]
