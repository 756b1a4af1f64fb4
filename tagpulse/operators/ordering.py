"""Running totals, row numbers and long lists over keys of any size.

A window over one key runs in one task, however many rows the key has. Here the rows are first
laid out in ranges of (key, order) of even size, so that a hot key spans many ranges; each range
is summed, the sums of earlier ranges are carried in, and the window runs within a range only.
"""

from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.session import checkpointed

RANGE = "_range"


def arrange(df: DataFrame, keys, order, ranges=None, hold=True) -> DataFrame:
    """`df` cut into even ranges of (keys, order): sorted, with the range in `_range` and the
    row's place in it, from 0, in `_place`.

    The cut points come from a sample, so the result is written once to the shared folder: every
    later use, and every retry after a lost executor, sees the same ranges. `order` must be
    unique within a key. The number of ranges is `spark.sql.shuffle.partitions` by default, and
    adaptive execution merges small ones.

    The sample and the shuffle each read `df`. Rows drawn from posts are far narrower than the
    posts, so they are held in between and the posts are read once; with hold=False they are
    read twice, which is cheaper where the rows are as wide as their source.
    """
    columns = [*keys, *order]
    held = df.persist() if hold else df
    try:
        laid = held.repartitionByRange(ranges, *columns) if ranges else held.repartitionByRange(*columns)
        row = F.monotonically_increasing_id()  # partition number above bit 33, place below
        laid = laid.sortWithinPartitions(*columns).withColumn("_row", row)
        return checkpointed(laid.select(
            *df.columns, F.shiftright("_row", 33).cast("int").alias(RANGE),
            F.col("_row").bitwiseAND(F.lit((1 << 33) - 1)).alias("_place")))
    finally:
        if hold:
            held.unpersist()


def running(df: DataFrame, keys, order, totals, maxima=None, lookup: DataFrame | None = None, ranges=None) -> DataFrame:
    """Adds running values over the rows of the same key up to and including this one: for each
    `name: column` of `totals` the sum, for each of `maxima` the largest value that is not NULL.

    `lookup` has at most one row per key; its columns are added to the rows of that key, NULL
    where it has none. It meets the sums of the ranges, not the rows, so a hot key costs nothing.
    """
    keys, order, maxima = list(keys), list(order), maxima or {}
    # output name -> (column of one row's share, how shares combine)
    parts = {n: (f"_share_{n}", F.sum) for n in totals} | {n: (f"_share_{n}", F.max) for n in maxima}
    shares = {parts[n][0]: c for n, c in (totals | maxima).items()}
    laid = arrange(df.withColumns(shares), keys, order, ranges).drop("_place")

    # one row per range and key in it: no more than there are keys and ranges together
    sums = laid.groupBy(RANGE, *keys).agg(*[merge(c).alias(c) for c, merge in parts.values()])
    earlier = Window.partitionBy(*keys).orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(RANGE, *keys, *[merge(c).over(earlier).alias(c) for c, merge in parts.values()])
    extra = []
    if lookup is not None:
        extra = [c for c in lookup.columns if c not in keys]
        carried = carried.join(lookup, keys, "left")
    carried = carried.where(reduce(or_, (F.col(c).isNotNull() for c in [*shares, *extra])))

    # what a range starts from becomes the first row of its key, ahead of the data
    heads = carried.withColumn("_data", F.lit(False))
    rows = laid.withColumn("_data", F.lit(True)).unionByName(heads, allowMissingColumns=True)
    rows = rows.repartitionById(max(laid.rdd.getNumPartitions(), 1), RANGE)
    so_far = (
        Window.partitionBy(RANGE, *keys).orderBy("_data", *order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.select(
            "_data", *df.columns, *[F.first(c).over(so_far).alias(c) for c in extra],
            *[merge(c).over(so_far).alias(n) for n, (c, merge) in parts.items()])
        .where("_data").drop("_data")
    )


def numbered(df: DataFrame, keys, order, name="position", ranges=None, hold=True) -> DataFrame:
    """Adds the row's number within its key, from 1 without gaps.

    Without keys all rows are numbered, and come out in that order.
    """
    if keys:
        return running(df, keys, order, {name: F.lit(1).cast("long")}, ranges=ranges)
    # the place in the range plus the rows of earlier ranges: no further shuffle of the rows
    laid = arrange(df, [], order, ranges, hold)
    earlier = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    counts = laid.groupBy(RANGE).agg(F.count("*").alias("_rows"))
    starts = counts.select(RANGE, F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    # one row per range, so never more than there are partitions
    return laid.join(F.broadcast(starts), RANGE).select(*df.columns, (F.col("_start") + F.col("_place") + 1).alias(name))


def numbered_as_read(df: DataFrame, split, line, name="position") -> DataFrame:
    """Adds the row's number in the order of files, from 1 without gaps, to rows that still lie as they were read.

    `split` are columns that tell and order the splits of the input (file, where it starts in the file); `line` rises by one from
    row to row of a split, as a row number of the read does. No row is moved: rows are counted per split, what earlier splits add up
    to is sent to all tasks, and the rows are numbered while they are read again. Of each split that is two numbers and a hash, some
    MB at 100 TB.
    """
    at = [F.xxhash64(*split).alias("_split")]
    counts = df.groupBy(*split).agg(F.count("*").alias("_rows"), F.min(line).alias("_first"))
    earlier = Window.orderBy(*split).rowsBetween(Window.unboundedPreceding, -1)  # one row per split
    shift = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first") + 1
    shifts = counts.select(*split, shift.alias("_shift")).select(*at, "_shift")
    return df.withColumn("_split", at[0]).join(F.broadcast(shifts), "_split").select(
        *df.columns, (F.col(line) + F.col("_shift")).alias(name))


def part_of(position, size):
    """Parts are numbered from 0 and hold `size` positions each."""
    return F.call_function("div", F.col(position) - 1, F.lit(size))


def lists_in_parts(rows: DataFrame, keys, position, item, name, size) -> DataFrame:
    """One row per key and part with the items at its positions, in order.

    A list of up to `size` items is one row with part 0; a longer one continues in part 1, 2, …
    Nothing is cut off, and no task or row ever holds more than `size` items.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(position).alias("p"), F.col(item).alias("v"))))
    return (
        rows.groupBy(*keys, part_of(position, size).alias("part"))
        .agg(pairs.alias("_pairs"))
        .select(*keys, "part", F.col("_pairs.v").alias(name))
    )
