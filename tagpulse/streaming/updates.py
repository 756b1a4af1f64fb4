"""The value after every single record of a stream.

A batch's rows get their running values as recorded ones do (operators/ordering.py), so a hot key spans many tasks; what the keys
add up to before the batch comes from a keyed table, and what they add up to after it goes there.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagpulse.operators import compare
from tagpulse.operators.ordering import running
from tagpulse.schema import ARRIVAL
from tagpulse.session import checkpointed
from tagpulse.sources.sinks import triggered
from tagpulse.streaming.keyed import BUCKETS, KeyedTable, Record


def start_updates(rows: DataFrame, key, totals, out, checkpoint, recorded: DataFrame | None = None, trigger=None,
                  compact_every=20, buckets=BUCKETS) -> StreamingQuery:
    """Appends to `out/updates`, for every row of a stream (key, arrival and what `totals` take), the row with the running sums
    `name: whole-number column` of `totals` over all rows of its key up to it.

    Within a batch rows go by arrival; a batch comes after those before it. Of `recorded`, a table of one row per key, the columns are
    added to the rows of its keys, NULL where it has none; it is indexed in `out/record` at the first start. A repeated batch replaces
    its own rows. The log has a row per record, as asked for; the totals are a row per key and cost a batch what it touches.
    """
    spark = rows.sparkSession
    shares = {f"_share_{name}": column for name, column in totals.items()}
    table = KeyedTable(spark, f"{out}/totals", [key], f"{key} string, " + ", ".join(f"{name} long" for name in totals), buckets)
    record = Record(recorded, f"{out}/record", key, buckets) if recorded is not None else None

    def step(batch: DataFrame, batch_id: int) -> None:
        held = checkpointed(batch.withColumns(shares))
        own = table.touched(held)
        before = table.lookup(held, batch_id, own).withColumnsRenamed({name: f"_before_{name}" for name in totals})
        lookup = before
        if record is not None:
            lookup = before.join(record.lookup(held, own).drop("_last"), key, "full")
        placed = running(held, [key], ARRIVAL, {name: F.col(f"_share_{name}") for name in totals}, lookup=lookup)
        after = {name: F.col(name) + F.coalesce(f"_before_{name}", F.lit(0)) for name in totals}
        dropped = [*shares, *(f"_before_{name}" for name in totals)]
        placed.withColumns(after).drop(*dropped).write.mode("overwrite").parquet(f"{out}/updates/batch_id={batch_id}")
        sums = held.groupBy(key).agg(*[F.sum(f"_share_{name}").alias(name) for name in totals])
        table.write(sums.join(before, key, "left").withColumns(after), batch_id)
        if compact_every and batch_id % compact_every == 0:
            table.compact(batch_id)

    writer = rows.writeStream.foreachBatch(step).outputMode("append").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def read_updates(spark: SparkSession, out) -> DataFrame:
    """All rows so far."""
    return spark.read.parquet(f"{out}/updates").drop("batch_id")


def start_counts(rows: DataFrame, out, checkpoint, **options) -> StreamingQuery:
    """(tag, arrival, uses so far) for every use of a tag."""
    return start_updates(rows.select("tag", *ARRIVAL), "tag", {"uses": F.lit(1).cast("long")}, out, checkpoint, **options)


def start_mean_words(rows: DataFrame, out, checkpoint, **options) -> StreamingQuery:
    """(tag, arrival, words so far, posts so far) for every use of a tag; `read_mean_words` has the means."""
    totals = {"total": F.col("words").cast("long"), "posts": F.lit(1).cast("long")}
    return start_updates(rows.select("tag", *ARRIVAL, "words"), "tag", totals, out, checkpoint, **options)


def read_mean_words(spark: SparkSession, out) -> DataFrame:
    """(tag, arrival, mean words, posts so far); `ts` is the time of the latest post."""
    return read_updates(spark, out).select("tag", *ARRIVAL, (F.col("total") / F.col("posts")).alias("avg_words"), "posts")


def start_compared_counts(rows: DataFrame, recorded: DataFrame, out, checkpoint, **options) -> StreamingQuery:
    """As `start_counts`, with the recorded count (tag, uses) of each tag."""
    known = recorded.select("tag", F.col("uses").alias("_recorded"))
    return start_counts(rows, out, checkpoint, recorded=known, **options)


def read_compared_counts(spark: SparkSession, out) -> DataFrame:
    """(tag, arrival, result): the running count of every use beside the recorded one."""
    return read_updates(spark, out).select(
        "tag", *ARRIVAL, compare.label(compare.known_or_none("_recorded"), F.col("uses").cast("string")).alias("result"))


def start_latest_counts(counts: DataFrame, recorded: DataFrame, out, checkpoint, trigger=None, compact_every=20,
                        buckets=BUCKETS) -> StreamingQuery:
    """Keeps `out/compared` up to date with the label (tag, result) of changed counts (a streaming aggregate in update mode) beside
    the recorded ones, once per batch. The record is indexed at the first start; a batch reads the buckets of its tags."""
    record = Record(recorded, f"{out}/record", "tag", buckets)
    table = KeyedTable(counts.sparkSession, f"{out}/compared", ["tag"], "tag string, result string", buckets)

    def step(batch: DataFrame, batch_id: int) -> None:
        held = checkpointed(batch)
        table.write(compare.compare_counts(record.lookup(held), held), batch_id)
        if compact_every and batch_id % compact_every == 0:
            table.compact(batch_id)

    writer = counts.writeStream.foreachBatch(step).outputMode("update").option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def read_latest_counts(spark: SparkSession, out, buckets=BUCKETS) -> DataFrame:
    return KeyedTable(spark, f"{out}/compared", ["tag"], "tag string, result string", buckets).read()
