"""Live results beside recorded ones.

Live keys without a recorded value show NONE; keys only in the record do not appear; a recorded
list that is longer than the live one is shown whole. Both sides are aggregates, one row per key
and part, and joined on both, so the joins have no hot key; whether the recorded side is broadcast
is left to the optimizer, which knows its size.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.operators.running import PART, running_counts, running_tags, running_user_text
from tagpulse.schema import ARRIVAL

MISSING = "NONE"


def label(recorded: Column, live: Column) -> Column:
    return F.concat(F.lit("Batch-Value: "), recorded, F.lit("  Stream-Value:"), live)


def compare_counts(recorded: DataFrame, live: DataFrame) -> DataFrame:
    """(tag, result) from two tables of (tag, uses). `live` may be a streaming aggregate."""
    known = recorded.select("tag", F.col("uses").alias("_recorded"))
    return live.join(known, "tag", "left").select(
        "tag", label(known_or_none("_recorded"), F.col("uses").cast("string")).alias("result"))


def known_or_none(name) -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(MISSING))


def _part_or_none(name) -> Column:
    """A recorded list that is shorter than the live one is known, and simply has ended."""
    return F.coalesce(F.col(name), F.when(F.col("part") == 0, F.lit(MISSING)).otherwise(F.lit("")))


def compare_lists(recorded: DataFrame, live: DataFrame, key, item, last: DataFrame | None = None) -> DataFrame:
    """(key, part, result) from two tables of (key, part, item), part by part.

    Where the recorded list is longer, its further parts stand beside nothing. They hang on part 0 of the live list: that row
    learns how many recorded parts there are and opens a cell for each, so no join is on the bare key, however many parts it
    has. `live` may also be the parts that a batch has touched: a list that is still in its part 0 has that part among them.
    `last` (key, part 0, number of the last part as `_last`) saves counting the recorded parts where that is known.
    """
    old = recorded.select(key, "part", F.col(item).alias("_recorded"))
    new = live.select(key, "part", F.col(item).alias("_live"))
    if last is None:
        last = recorded.groupBy(key).agg(F.max("part").alias("_last")).withColumn("part", F.lit(0).cast("long"))
    own = F.struct("part", "_live")
    further = F.transform(
        F.sequence(F.lit(1).cast("long"), "_last"), lambda p: F.struct(p.alias("part"), F.lit(None).cast("string").alias("_live")))
    cells = F.when(F.col("_last") >= 1, F.concat(F.array(own), further)).otherwise(F.array(own))
    opened = new.join(last, [key, "part"], "left").select(key, F.explode(cells).alias("c"))
    both = opened.groupBy(key, F.col("c.part").alias("part")).agg(F.max("c._live").alias("_live"))
    return both.join(old, [key, "part"], "left").select(
        key, "part", label(_part_or_none("_recorded"), F.coalesce("_live", F.lit(""))).alias("result"))


def _further_at_first(recorded: DataFrame, live_rows: DataFrame, key) -> DataFrame:
    """(key, arrival, part, result): at a key's first live use, the recorded parts that the live list can't have reached."""
    first = live_rows.groupBy(key).agg(F.min(F.struct(*ARRIVAL)).alias("_at"))
    last = recorded.groupBy(key).agg(F.max("part").alias("_last")).where("_last >= 1")
    cells = first.join(last, key).select(
        key, "_at", F.explode(F.sequence(F.lit(1).cast("long"), "_last")).alias("part"))
    return cells.join(recorded.select(key, "part", "_recorded"), [key, "part"]).select(
        key, "_at.*", "part", label(F.col("_recorded"), F.lit("")).alias("result"))


def compare_users(recorded: DataFrame, live: DataFrame) -> DataFrame:
    return compare_lists(recorded, live, "tag", "users")


def compare_country_tags(recorded: DataFrame, live: DataFrame) -> DataFrame:
    """Live lists are shown without the closing semicolon that recorded ones have."""
    live = live.withColumn("tags", F.left("tags", F.length("tags") - 1))
    return compare_lists(recorded, live, "country", "tags")


def compare_count_updates(recorded: DataFrame, live_rows: DataFrame, ranges=None) -> DataFrame:
    """One row per live use of a tag: its running count beside the recorded count."""
    known = recorded.select("tag", F.col("uses").alias("_recorded"))
    return running_counts(live_rows, known, ranges).select(
        "tag", *ARRIVAL, label(known_or_none("_recorded"), F.col("uses").cast("string")).alias("result"))


def compare_user_updates(recorded: DataFrame, live_rows: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    """One row per live use of a tag: its users so far beside the recorded ones, for the part
    that is growing; at its first use, one more for every further recorded part. `recorded` must
    have the same part size."""
    known = recorded.select("tag", "part", F.col("users").alias("_recorded"))
    grown = running_user_text(live_rows, part_size, known, ranges).select(
        "tag", *ARRIVAL, "part", label(_part_or_none("_recorded"), F.col("text")).alias("result"))
    return grown.unionByName(_further_at_first(known, live_rows, "tag"))


def compare_country_updates(recorded: DataFrame, live_rows: DataFrame, part_size=PART, ranges=None) -> DataFrame:
    """One row per live use of a tag in a country, as above; a part has at most `part_size` rows."""
    known = recorded.select("country", "part", F.col("tags").alias("_recorded"))
    grown = running_tags(live_rows, part_size, ranges).join(known, ["country", "part"], "left").select(
        "country", *ARRIVAL, "part", label(_part_or_none("_recorded"), F.col("text")).alias("result"))
    return grown.unionByName(_further_at_first(known, live_rows, "country"))

