"""The value after every single update, replayed over recorded posts.

A live query shows one value per key and micro-batch (see streaming/); these give one row per
hashtag use, as a stream processed record by record would print them.
"""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.operators.aggregates import first_uses
from tagpulse.operators.ordering import numbered, part_of, running
from tagpulse.schema import ARRIVAL

# items in the text of one running row
PART = 100


def running_counts(rows: DataFrame, lookup=None, ranges=None) -> DataFrame:
    """(tag, arrival, uses so far)."""
    rows = rows.select("tag", *ARRIVAL)
    return running(rows, ["tag"], ARRIVAL, {"uses": F.lit(1).cast("long")}, lookup=lookup, ranges=ranges)


def running_mean_words(rows: DataFrame, ranges=None) -> DataFrame:
    """(tag, arrival, mean words, posts so far); `ts` is the time of the latest post."""
    totals = running(
        rows.select("tag", *ARRIVAL, "words"), ["tag"], ARRIVAL,
        {"_total": F.col("words"), "posts": F.lit(1).cast("long")}, ranges=ranges)
    return totals.select("tag", *ARRIVAL, (F.col("_total") / F.col("posts")).alias("avg_words"), "posts")


def _uses_and_first_uses(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """Both as rows; `_use` is 0 for a first use, which thus comes just before the use itself."""
    uses = rows.select("tag", "user_name", *ARRIVAL, F.lit(1).cast("long").alias("_use"))
    return uses.unionByName(firsts.withColumn("_use", F.lit(0).cast("long")), allowMissingColumns=True)


def running_users(rows: DataFrame, ranges=None) -> DataFrame:
    """(tag, arrival, user, uses so far, distinct users so far)."""
    events = _uses_and_first_uses(rows, first_uses(rows))
    totals = {"uses": F.col("_use"), "users": 1 - F.col("_use")}
    return running(events, ["tag"], [*ARRIVAL, "_use"], totals, ranges=ranges).where("_use = 1").drop("_use")


def _text_so_far(item, keys, position, separator=";"):
    """The items of this part up to the row; the window spans one part, never a whole key."""
    upto = Window.partitionBy(*keys, "part").orderBy(position).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return F.array_join(F.collect_list(item).over(upto), separator)


def running_user_text(rows: DataFrame, part_size=PART, lookup=None, ranges=None) -> DataFrame:
    """(tag, arrival, user, uses, users, part, text "a;b"): the users so far after every update.

    The whole list at an update is the complete parts before `part` (as `users_per_tag` gives
    them for the same size) followed by `text`. `lookup` has one row per (tag, part).
    """
    # the list only changes at a first use; between two of them it is the latest one so far
    states = numbered(first_uses(rows), ["tag"], ARRIVAL, "users", ranges)
    states = states.withColumn("part", part_of("users", part_size))
    states = states.withColumn("text", _text_so_far("user_name", ["tag"], "users"))
    extra = []
    if lookup is not None:
        states = states.join(lookup, ["tag", "part"], "left")
        extra = [c for c in lookup.columns if c not in ("tag", "part")]
    state = F.struct("users", "part", "text", *extra)
    events = _uses_and_first_uses(rows, states.select("tag", "user_name", *ARRIVAL, state.alias("_state")))
    values = running(
        events, ["tag"], [*ARRIVAL, "_use"], {"uses": F.col("_use")}, {"_latest": F.col("_state")}, ranges=ranges)
    return values.where("_use = 1").select("tag", "user_name", *ARRIVAL, "uses", "_latest.*")


def running_tags(rows: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    """(country, arrival, tag, position, part, text "a;b"): the tags so far after every update.

    As above, the complete parts before `part` followed by `text` are the whole list.
    """
    rows = rows.select("country", "tag", *ARRIVAL)
    placed = running(rows, ["country"], ARRIVAL, {"position": F.lit(1).cast("long")}, ranges=ranges)
    placed = placed.withColumn("part", part_of("position", part_size))
    return placed.withColumn("text", _text_so_far("tag", ["country"], "position"))


def as_fold(tags: DataFrame) -> DataFrame:
    """`running_tags` as the fold from "" prints it: "Country:a;b;"."""
    first = F.when(F.col("part") == 0, F.concat("country", F.lit(":"))).otherwise(F.lit(""))
    return tags.withColumn("text", F.concat(first, "text", F.lit(";")))
