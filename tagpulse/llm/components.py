"""Connected components of links."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.session import checkpointed


HOT = 1 << 16  # a bound on the keys that `joined` broadcasts


def joined(large: DataFrame, small: DataFrame, key: str, rows: int) -> DataFrame:
    """`large` with the columns of the row in `small` that has the same `key`; rows without one go.

    `small` has one row for each key and in `n` at least how many rows of `large` have it; all `n` add up to `rows` or less. A key with a
    third of all rows would be a single task of a shuffled join. Those of over `rows` / 65,536 rows can't be more than 65,536, so they are
    broadcast, and their rows of `large` stay where they are; the others are shuffled. With 65,536 rows or fewer there are no more keys than
    that, so all are broadcast: shuffling so few rows costs a file and a task for each partition, whatever is in it. `n` is left out of the
    result.
    """
    if rows <= HOT:
        return large.join(F.broadcast(small.drop("n")), key)
    limit = max(256, rows // HOT)
    hot = F.broadcast(small.where(F.col("n") > limit).drop("n"))
    cold = small.where(F.col("n") <= limit).drop("n")
    return large.join(hot, key).unionByName(large.join(hot.select(key), key, "left_anti").join(cold, key))


def _state(links: DataFrame):
    return links.agg(F.count("*"), F.bit_xor(F.xxhash64("node", "root"))).first()


def components(links: DataFrame, left: str = "left", right: str = "right") -> DataFrame:
    """(node, root) for every node of `links` but the roots: root is the smallest node it is linked to, over any path.

    Alternating stars: every round ties the larger neighbours of a node to its smallest, then its smaller ones,
    until nothing changes; the rounds grow with the logarithm of the longest path. The smallest neighbour is an
    aggregate that combines before its shuffle, nodes of very many links are met by `joined`, and only counts come to the driver. Each round is written to the
    shared folder. Links of a node to itself, repeated ones and ones with a NULL say nothing; no links give no rows.
    """
    links = checkpointed(
        links.select(F.greatest(left, right).alias("node"), F.least(left, right).alias("root"))
        .where("node <> root").distinct())
    state = _state(links)
    while state[0]:
        # every node sees its neighbours on both sides; the larger ones are tied to the smallest of all
        both = links.select(F.explode(F.array(F.struct("node", "root"), F.struct(F.col("root").alias("node"), F.col("node").alias("root")))).alias("l")).select("l.*")
        least = both.groupBy("node").agg(F.min("root").alias("least"), F.count("*").alias("n")).withColumnRenamed("node", "root")
        large = (
            joined(links, least, "root", 2 * state[0])
            .select("node", F.least("root", "least").alias("root")).distinct())
        # then a node's smaller neighbours are tied to the smallest of them, and so is the node
        lower = large.groupBy("node").agg(F.min("root").alias("least"), F.count("*").alias("n"))
        small = (
            joined(large, lower, "node", state[0])
            .select(F.explode(F.array(F.struct("node", F.col("least").alias("root")),
                                      F.struct(F.col("root").alias("node"), F.col("least").alias("root")))).alias("l"))
            .select("l.node", "l.root").where("node <> root").distinct())
        links = checkpointed(small)
        before, state = state, _state(links)
        if state == before:
            break
    return links
