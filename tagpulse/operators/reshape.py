"""Recorded results read back as series, and the two reshapes of ride records."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.functions.text import json_quoted
from tagpulse.operators.ordering import lists_in_parts, numbered, numbered_as_read

# fixed value: the "other time" of a START row
NO_TIME = "1970-01-01 00:00:00"


def series_lines(means: DataFrame) -> DataFrame:
    """Running means as recorded: one line `("tag",mean,posts,epoch ms)` per update."""
    fields = F.concat_ws(",", json_quoted(F.col("tag")), F.col("avg_words").cast("string"),
                         F.col("posts").cast("string"), F.unix_millis("ts").cast("string"))
    return means.select(F.concat(F.lit("("), fields, F.lit(")")).alias("value"))


def _series_fields(lines: DataFrame) -> DataFrame:
    fields = F.split(F.regexp_replace("value", '["()]', ""), ",")
    return lines.select(
        "value", F.get(fields, 0).alias("tag"), F.get(fields, 1).try_cast("double").alias("avg_words"),
        F.get(fields, 2).try_cast("long").alias("posts"), F.get(fields, 3).try_cast("long").alias("ms"))


def parse_series(lines: DataFrame) -> DataFrame:
    """(tag, avg_words, posts, ms) of recorded lines; quotes and brackets are dropped. Lines without a mean or a time are left
    out here and found by `bad_series_lines`."""
    return _series_fields(lines).where("avg_words is not null and ms is not null").drop("value")


def bad_series_lines(lines: DataFrame) -> DataFrame:
    """The lines that `parse_series` left out, to be written beside its result; blank lines say nothing."""
    bad = _series_fields(lines).where("avg_words is null or ms is null")
    return bad.where(F.col("value").rlike(r"\S")).select("value")


def series_points(points: DataFrame, ranges=None) -> DataFrame:
    """(tag, point, avg_words, elapsed_ms): the points of each tag in time order, and the time
    since the first of all points."""
    placed = numbered(points, ["tag"], ["ms", "posts"], "point", ranges)
    start = placed.agg(F.min("ms").alias("start")).scalar()
    return placed.select("tag", "point", "avg_words", (F.col("ms") - start).alias("elapsed_ms"))


def recorded_series(points: DataFrame, part_size=1000, ranges=None) -> DataFrame:
    """(tag, part, series): each tag's points as a list of (avg_words, elapsed_ms), in parts."""
    rows = series_points(points, ranges).withColumn("_xy", F.struct("avg_words", "elapsed_ms"))
    return lists_in_parts(rows, ["tag"], "point", "_xy", "series", part_size)


def read_fields(spark: SparkSession, path) -> DataFrame:
    """Comma-separated lines as `fields` (no quoting, carriage returns removed), with columns
    that give file order."""
    return spark.read.text(path).select(
        F.split(F.replace(F.col("value"), F.lit("\r"), F.lit("")), ",").alias("fields"),
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("line"),
    )


FILE_ORDER = ["file", "block", "line"]


def _field(number) -> Column:
    """The numbered field, counted from 1; empty where the line is shorter."""
    return F.coalesce(F.try_element_at("fields", F.lit(number)), F.lit(""))


def _with_row_number(rows: DataFrame, order, ranges) -> DataFrame:
    """By `order`; rows in the order of their files are numbered where they are."""
    if list(order) == FILE_ORDER:
        return numbered_as_read(rows, FILE_ORDER[:2], FILE_ORDER[2], "row_no")
    return numbered(rows, [], order, "row_no", ranges, hold=False)


def fares(rows: DataFrame, order=FILE_ORDER, ranges=None) -> DataFrame:
    """Row number and fields 1, 2, 4, 5, 9, 10, 11. Rows of files come out as they lie, a split's in order."""
    picked = rows.select(*order, *[_field(n).alias(f"c{n}") for n in (1, 2, 4, 5, 9, 10, 11)])
    return _with_row_number(picked, order, ranges).select(
        "row_no", *[f"c{n}" for n in (1, 2, 4, 5, 9, 10, 11)])


def trip_events(rows: DataFrame, order=FILE_ORDER, ranges=None) -> DataFrame:
    """A START and an END row per ride, sharing its row number.

    START carries the start time (field 6) and no other time, END the end time (field 7) and
    the start time; both carry fields 11-14, 8, 1, 2. Times are typed, so the order is that of
    time in every locale; a field that is no time gives NULL and sorts first.
    """
    rest = ["c11", "c12", "c13", "c14", "c8", "c1", "c2"]
    picked = rows.select(*order, *[_field(n).alias(f"c{n}") for n in (1, 2, 6, 7, 8, 11, 12, 13, 14)])
    rides = _with_row_number(picked, order, ranges)
    time = lambda text: text.try_cast("timestamp_ntz")
    event = lambda kind, at, other: F.struct(F.lit(kind).alias("kind"), time(at).alias("at"), time(other).alias("other"))
    both = F.array(event("START", F.col("c6"), F.lit(NO_TIME)), event("END", F.col("c7"), F.col("c6")))
    return rides.select("row_no", F.explode(both).alias("event"), *rest).select(
        "row_no", F.col("event.kind").alias("kind"), F.col("event.at").alias("at"), F.col("event.other").alias("other"), *rest)


TRIP_ORDER = ["at", "other", "c11", "c12", "c13", "c14", "c8", "c1", "c2", "row_no", "kind"]


def trips(rows: DataFrame, order=FILE_ORDER, ranges=None) -> DataFrame:
    """The rows of `trip_events` sorted by time; of files that sort is the only layout."""
    return trip_events(rows, order, ranges).orderBy(*TRIP_ORDER)


def place_by_time(events: DataFrame, ranges=None) -> DataFrame:
    """Adds `position`, the place in the order of `trips`, from 1."""
    return numbered(events, [], TRIP_ORDER, "position", ranges, hold=False)


def as_csv_lines(rows: DataFrame, columns) -> DataFrame:
    return rows.select(F.concat_ws(",", *[F.col(c).cast("string") for c in columns]).alias("value"))
