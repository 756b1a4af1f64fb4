"""Lists that grow live: the users of a tag, the tags of a country.

The list itself is never held whole. Each batch adds its items with their positions, rewrites the parts it touched, and keeps per
key only the length and the items of the last, open part. State, lists and comparison are keyed tables (keyed.py): a batch reads
the buckets of its own keys and writes their rows, whatever other keys there are.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tagpulse.operators import compare
from tagpulse.operators.aggregates import PART
from tagpulse.operators.ordering import lists_in_parts, part_of, running
from tagpulse.schema import ARRIVAL
from tagpulse.session import checkpointed
from tagpulse.sources.sinks import triggered
from tagpulse.streaming.folders import drop_before, write_batch
from tagpulse.streaming.keyed import BUCKETS, KeyedTable, Record


class _Tables:
    def __init__(self, spark: SparkSession, key, item, out, buckets: int = BUCKETS):
        self.state = KeyedTable(spark, f"{out}/state", [key], f"{key} string, size long, open array<string>", buckets)
        self.lists = KeyedTable(spark, f"{out}/lists", [key, "part"], f"{key} string, part long, items array<string>", buckets)
        self.compared = KeyedTable(spark, f"{out}/compared", [key, "part"], f"{key} string, part long, result string", buckets)


def _extend(batch: DataFrame, batch_id: int, key, item, out, part_size, tables: _Tables) -> tuple[DataFrame, list[int]]:
    """Places the batch's items behind those of earlier batches; returns the parts it touched, and the buckets of its keys."""
    # cut points are sampled from the rows before they are moved; do not run the stream's plan twice
    rows = checkpointed(batch.select(key, item, *ARRIVAL))
    buckets = tables.state.touched(rows)
    before = tables.state.lookup(rows, batch_id, buckets)
    placed = running(
        rows, [key], ARRIVAL, {"position": F.lit(1).cast("long")}, lookup=before.select(key, "size"))
    placed = placed.withColumn("position", F.col("position") + F.coalesce("size", F.lit(0))).drop("size")
    items = write_batch(placed, f"{out}/items", batch_id)

    sizes = items.groupBy(key).agg(F.max("position").alias("size"))
    reopened = before.select(
        key, (F.col("size") - F.size("open")).alias("_full"), F.posexplode("open").alias("_i", item))
    reopened = reopened.select(key, item, (F.col("_full") + F.col("_i") + 1).alias("position"))
    touched = tables.lists.write(lists_in_parts(
        items.select(key, item, "position").unionByName(reopened), [key], "position", item, "items", part_size), batch_id)

    # on key and part: a key with many touched parts is not one task
    last = touched.join(sizes.withColumn("part", part_of("size", part_size)), [key, "part"])
    full = F.col("size") % part_size == 0
    grown = last.select(key, "size", F.when(full, F.array().cast("array<string>")).otherwise(F.col("items")).alias("open"))
    tables.state.write(grown, batch_id)
    return touched, buckets


def start_lists(rows: DataFrame, key, item, out, checkpoint, part_size=PART, recorded=None, mode="append",
                trigger=None, compact_every=20, buckets=BUCKETS) -> StreamingQuery:
    """Keeps `out/lists` up to date with (key, part, items) from streaming rows (key, item, arrival).

    With `recorded`, a table of (key, part, text) of the same part size, every batch also writes
    the touched parts beside the recorded ones to `out/compared`, and while a list is in its part 0
    the further recorded parts, so that the recorded value is always whole. The record is indexed by key in `out/record` at the
    first start, and a batch reads the buckets of its keys.

    A batch costs what it touches. Every `compact_every` batches, buckets whose newer folders have grown as large as the older
    ones are merged. `buckets` stays the same for the life of `out`.
    """
    tables = _Tables(rows.sparkSession, key, item, out, buckets)
    record = Record(recorded, f"{out}/record", key, buckets) if recorded is not None else None

    def step(batch: DataFrame, batch_id: int) -> None:
        touched, own = _extend(batch, batch_id, key, item, out, part_size, tables)
        if record is not None:
            text = [c for c in recorded.columns if c not in (key, "part")][0]
            live = touched.select(key, "part", F.array_join("items", ";").alias(text))
            known = record.lookup(touched, own)
            last = known.where("_last is not null").select(key, "part", "_last")
            tables.compared.write(compare.compare_lists(known.drop("_last"), live, key, text, last), batch_id)
        if compact_every and batch_id % compact_every == 0:
            for table in (tables.state, tables.lists, *([tables.compared] if record is not None else [])):
                table.compact(batch_id)
        drop_before(batch.sparkSession, f"{out}/items", batch_id)

    writer = rows.writeStream.foreachBatch(step).outputMode(mode).option("checkpointLocation", checkpoint)
    return triggered(writer, trigger).start()


def read_lists(spark: SparkSession, out, key, buckets=BUCKETS) -> DataFrame:
    """The current parts (key, part, items) of every list."""
    return _Tables(spark, key, None, out, buckets).lists.read()


def read_compared(spark: SparkSession, out, key, buckets=BUCKETS) -> DataFrame:
    """The latest comparison (key, part, result) of every key the stream has touched."""
    return _Tables(spark, key, None, out, buckets).compared.read()
