"""Mixing sources to target weights by a temperature, as blocks that each hold the mixture."""

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.session import checkpointed

SECTIONS, ROUNDS = 64, 5  # the exponent's range is cut into 64 parts five times: to one part in 10^9
FAN = 1024  # buckets per level under which running totals are summed


def tokens_of(text: Column) -> Column:
    """The words of a text and an end mark, so that an empty one counts too."""
    words = F.array_remove(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), "")
    return (F.size(words) + 1).cast("long")


@dataclass
class Mixture:
    """What the weights aim at. With `exponent` 1 sources weigh as they are, with 0 all weigh the same; between them the
    exponent is bisected.

    `repeats`: the smallest exponent at which no source is read more than so many times. `entropy`: the largest exponent at
    which the weights' entropy reaches this share of the largest possible. With both, the limit on repeats wins.
    `budget`: tokens in all; by default as many as read every document at least once.
    """
    repeats: float | None = 2.0
    entropy: float | None = None
    budget: float | None = None
    block_tokens: int = 1 << 20
    seed: int = 42


def exponent(shares: DataFrame, aim: Mixture, total: float) -> float:
    """Bisects the exponent over (share), one row per source; only sums over all sources come to the driver."""
    low, high = 0.0, 1.0
    for _ in range(ROUNDS):
        step = (high - low) / SECTIONS
        at = F.lit(low) + F.col("k") * F.lit(step)
        powers = shares.select("share", F.explode(F.sequence(F.lit(0), F.lit(SECTIONS))).alias("k"))
        powers = powers.select("k", "share", F.pow("share", at).alias("power"))
        sums = powers.groupBy("k").agg(
            F.sum("power").alias("z"), F.sum(F.col("power") * F.ln("share")).alias("logs"), F.count("*").alias("n"),
            F.max(F.col("power") / F.col("share")).alias("most"), F.min(F.col("power") / F.col("share")).alias("least"))
        rows = sorted(sums.collect(), key=lambda r: r.k)  # one row per section

        def repeats(r):
            return r.most / r.least if aim.budget is None else aim.budget / total * r.most / r.z

        def entropy(r):
            from math import log

            alpha = low + r.k * step
            return (log(r.z) - alpha * r.logs / r.z) / log(r.n) if r.n > 1 else 1.0

        few = [aim.repeats is None or repeats(r) <= aim.repeats * (1 + 1e-12) for r in rows]
        even = [aim.entropy is None or entropy(r) >= aim.entropy - 1e-12 for r in rows]
        # repeats fall and evenness falls as the exponent rises
        first = few.index(True) if True in few else SECTIONS
        last = max((k for k, e in enumerate(even) if e), default=0)
        if aim.entropy is not None and last >= first:
            low, high = low + last * step, low + min(last + 1, SECTIONS) * step
            chosen = low
        else:
            high = low + first * step
            low, chosen = max(high - step, low), high
    return chosen


def weights(sizes: DataFrame, aim: Mixture = Mixture()) -> DataFrame:
    """(source, tokens, share, weight, quota): from (source, tokens), tokens over 0. quota: the tokens to read from a source."""
    total = float(sizes.agg(F.sum("tokens")).first()[0] or 0)
    if not total:
        return sizes.select("source", "tokens", *[F.lit(0.0).alias(c) for c in ("share", "weight", "quota")])
    shares = sizes.withColumn("share", F.col("tokens") / F.lit(total))
    alpha = exponent(shares, aim, total)
    powers = shares.withColumn("power", F.pow("share", F.lit(alpha)))
    sums = powers.agg(F.sum("power").alias("z"), F.max(F.col("tokens") / F.col("power")).alias("scale")).first()
    budget = aim.budget if aim.budget is not None else sums.z * sums.scale
    weight = F.col("power") / F.lit(sums.z)
    return powers.select("source", "tokens", "share", weight.alias("weight"), (weight * F.lit(float(budget))).alias("quota"))


def running_before(rows: DataFrame, keys: list[str], draw: str, amount: str) -> DataFrame:
    """Adds `before`: the sum of `amount` over rows of the same keys ahead in the order of `draw` (a random long) and then `row`.

    A key of any size is summed over buckets of the draw's leading bits, two levels of FAN: no window has more than FAN
    buckets or the rows of one bucket.
    """
    bits = FAN.bit_length() - 1
    leading = F.shiftrightunsigned(draw, 64 - 2 * bits)
    rows = rows.withColumns({"upper": F.shiftright(leading, bits), "lower": leading.bitwiseAND(F.lit(FAN - 1))})
    leaves = rows.groupBy(*keys, "upper", "lower").agg(F.sum(amount).alias("part"))
    branches = leaves.groupBy(*keys, "upper").agg(F.sum("part").alias("part"))
    ahead = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("long")
    over_branches = branches.select(
        *keys, "upper", F.coalesce(F.sum("part").over(ahead(*keys).orderBy("upper")), zero).alias("outer"))
    over_leaves = leaves.select(
        *keys, "upper", "lower", F.coalesce(F.sum("part").over(ahead(*keys, "upper").orderBy("lower")), zero).alias("inner"))
    same = lambda a, b, by: a.join(b.withColumnsRenamed({c: f"_{c}" for c in by}), [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]).drop(*[f"_{c}" for c in by])
    starts = same(over_leaves, over_branches, [*keys, "upper"])
    within = F.coalesce(F.sum(amount).over(ahead(*keys, "upper", "lower").orderBy(draw, "row")), zero)
    placed = rows.withColumn("within", within)
    return (
        same(placed, starts, [*keys, "upper", "lower"])
        .withColumn("before", F.col("outer") + F.col("inner") + F.col("within"))
        .drop("upper", "lower", "outer", "inner", "within"))


def schedule(docs: DataFrame, aim: Mixture = Mixture()) -> DataFrame:
    """When each document of `docs` (`doc_id`, `text`, `source`) is read: the source weights, realised as blocks.

    A source's share of the tokens is raised to the exponent and normalised; that times the budget is its quota. It is read in
    as many permutations (epochs) as the quota holds, the last as far as it goes. Where a document's epoch and place fall in the
    quota tells its block, so every block of about `block_tokens` tokens has the sources in their weights; within a block the
    order is a permutation of its own.

    Per reading: doc_id, source, tokens, epoch (from 0), block, place (from 0 in its block), text_key and copy (which of equal rows).
    A NULL or empty text counts as one token; a NULL source is a source; a NULL doc_id is kept; repeated rows are read once each;
    an empty table or a budget of nothing gives no rows; other columns are ignored. A source of any size is cut by hash, so none is one task.
    """
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), tokens_of(F.col("text")).alias("tokens"),
        F.xxhash64("text").alias("text_key"))
    copy = F.row_number().over(Window.partitionBy("doc_id", "text_key").orderBy("source"))
    rows = checkpointed(docs.withColumn("copy", copy))  # a few numbers per document
    plan = checkpointed(weights(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), aim))  # a row per source
    budget = plan.agg(F.sum("quota")).first()[0] or 0.0
    blocks = max(int(-(-budget // aim.block_tokens)), 1)

    seed = F.lit(aim.seed)
    read = (
        rows.join(plan.where("quota > 0").select(F.col("source").alias("of"), F.col("tokens").alias("size"), "quota"), F.col("source").eqNullSafe(F.col("of")))
        .withColumn("epoch", F.explode(F.sequence(F.lit(0), F.ceil(F.col("quota") / F.col("size") - 1e-9).cast("int") - 1)))
        .withColumn("row", F.xxhash64("doc_id", "text_key", "copy"))
        .withColumn("draw", F.xxhash64("row", "epoch", seed)))
    ordered = running_before(read.drop("of"), ["source", "epoch"], "draw", "tokens")
    at = F.col("epoch") * F.col("size") + F.col("before")
    placed = (
        ordered.where(at < F.col("quota") - 1e-6)
        .withColumn("block", F.least(F.floor(at / F.col("quota") * blocks), F.lit(blocks - 1)).cast("long")))
    within = Window.partitionBy("block").orderBy(F.xxhash64("block", "draw", seed), "row", "epoch")
    return placed.select(
        "doc_id", "source", "tokens", "epoch", "block", (F.row_number().over(within) - 1).cast("long").alias("place"), "text_key", "copy")


def mix(docs: DataFrame, aim: Mixture = Mixture()) -> DataFrame:
    """`docs` as `schedule` has it read: its rows, repeated or left out, in the order of the blocks within partitions."""
    rows = docs.select(  # whole rows in one column, so that none of theirs clashes with another
        F.struct(*docs.columns).alias("doc"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("key"),
        F.col("source").cast("string").alias("of"))
    rows = rows.withColumn("nth", F.row_number().over(Window.partitionBy("id", "key").orderBy("of"))).drop("of")
    plan = schedule(docs, aim).select("doc_id", "text_key", "copy", "block", "place")
    met = F.col("id").eqNullSafe(F.col("doc_id")) & (F.col("key") == F.col("text_key")) & (F.col("nth") == F.col("copy"))
    both = rows.join(plan, met).select("doc", "block", "place")
    return both.repartition("block").sortWithinPartitions("block", "place").select("doc.*")
