"""Document fingerprints: every shingle hash below a fixed fraction of all hashes."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tagpulse.operators.ordering import RANGE, arrange

FRACTION_BITS = 2  # a hash is kept if these leading bits are zero: a quarter of all


def shingle_hashes(text: Column, words: int = 5) -> Column:
    """Hashes of all runs of `words` words, in lower case; of the words there are, if fewer."""
    found = F.array_remove(F.split(F.lower(text), r"[\x20\x09-\x0D]+"), "")

    def of(w):
        return F.when(F.size(w) >= words, F.transform(
            F.sequence(F.lit(0), F.size(w) - words), lambda i: F.xxhash64(*[F.get(w, i + k) for k in range(words)])
        )).when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<long>"))

    # bound once, so that the words are split once
    return F.flatten(F.transform(F.array(found), of))


def sketch(text: Column, words: int = 5, fraction_bits: int = FRACTION_BITS) -> Column:
    """The 32 bits after the leading zeros of every hash below the fraction, distinct and sorted; of the smallest hash where
    none is below, so that only a text without words has none. Sketches of parts of a corpus merge by union."""

    def kept(hashes):
        below = F.filter(hashes, lambda h: F.shiftrightunsigned(h, 64 - fraction_bits) == 0)
        least = F.when(F.size(hashes) > 0, F.array(F.array_min(hashes))).otherwise(hashes)
        return F.when(F.size(below) > 0, below).otherwise(least)

    short = F.transform(F.flatten(F.transform(F.array(shingle_hashes(text, words)), kept)),
                        lambda h: F.shiftright(F.shiftleft(h, fraction_bits), 32).cast("int"))
    return F.array_sort(F.array_distinct(short))


def written(kept: Column) -> Column:
    """A sketch as text: eight hexadecimal digits for each hash, one after the other."""
    return F.array_join(F.transform(kept, lambda h: F.right(F.lpad(F.lower(F.hex(h)), 16, "0"), F.lit(8))), "")


def containment(one: Column, other: Column) -> Column:
    """The share of the smaller sketch that is in the larger: 1 for equal ones, 0 if just one is empty."""
    smaller = F.least(F.size(one), F.size(other))
    shared = F.size(F.array_intersect(one, other))
    return F.when(one == other, 1.0).when(smaller == 0, 0.0).otherwise(shared / F.greatest(smaller, F.lit(1)))


def before(docs: DataFrame) -> DataFrame:
    """(key, before, quarter): for every key the next smaller one, round the end, and the quarter of that one's length.

    Only the keys and lengths are laid out in ranges; one row per range crosses between them.
    """
    keys = docs.groupBy("key").agg(F.max(F.floor(F.char_length("text") / 4).cast("int")).alias("quarter"))
    laid = arrange(keys, [], ["key"], hold=False)
    row = F.struct("key", "quarter")
    within = Window.partitionBy(RANGE).orderBy("key")
    last = laid.groupBy(RANGE).agg(F.max(row).alias("last"))
    ranges = Window.orderBy(RANGE)  # one row per range
    carried = last.select(RANGE, F.lag("last").over(ranges).alias("carried"))
    top = last.agg(F.max("last").alias("top"))
    return (
        laid.withColumn("earlier", F.lag(row).over(within))
        .join(F.broadcast(carried), RANGE).crossJoin(F.broadcast(top))  # one row per range, and one
        .select("key", F.coalesce("earlier", "carried", "top").alias("b"))
        .select("key", F.col("b.key").alias("before"), F.col("b.quarter").alias("quarter")))


def compare_edited(docs: DataFrame, words: int = 5) -> DataFrame:
    """Fingerprints every text of `docs` (`doc_id`, `text`), and the text with its last quarter replaced by the beginning of
    the document with the next larger doc_id (after the last: the first).

    A sketch keeps a fixed fraction of the hashes of five-word shingles, so two sketches tell how much of the shorter
    document is in the longer one, however unequal they are.

    Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint (hashes as hexadecimal digits), near_edited and
    near_next (containment of the smaller sketch in the larger), sketch and edited_sketch (array<long>).
    A NULL text is an empty one; a NULL doc_id counts as the smallest, -2^63, which is not told apart from it and comes out as NULL; of several texts under one doc_id the smallest is the
    next document's; a lone document is its own next; repeated rows come out once each; an empty table gives no rows; other
    columns are ignored. Texts are shuffled once, and of each once more the part that its neighbour needs with its sketch.
    """
    least = -(1 << 63)
    keyed = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(least)).alias("key"), F.coalesce(F.col("text"), F.lit("")).alias("text"))
    neighbours = before(keyed)
    placed = keyed.join(neighbours, "key")  # the one shuffle of the texts; both uses below share it
    heads = (
        placed.select("before", F.struct(F.expr("substring(text, 1, quarter)").alias("head"), sketch(F.col("text"), words).alias("next_sketch")).alias("next"))
        .groupBy(F.col("before").alias("key")).agg(F.min("next").alias("next")))
    replaced = F.floor(F.col("n_chars") / 4).cast("int")
    edited = (
        placed.select("key", "text", F.char_length("text").alias("n_chars")).join(heads, "key")
        .withColumn("edited", F.concat(
            F.substring(F.col("text"), F.lit(1), F.col("n_chars") - replaced), F.substring(F.col("next.head"), F.lit(1), replaced))))
    sketched = edited.select(
        "key", F.col("n_chars").cast("long").alias("n_chars"), F.sha2("edited", 256).alias("edited_sha256"),
        sketch(F.col("text"), words).alias("sketch"), sketch(F.col("edited"), words).alias("edited_sketch"), "next.next_sketch")
    return sketched.select(
        F.when(F.col("key") != least, F.col("key")).alias("doc_id"), "n_chars", "edited_sha256",
        written(F.col("sketch")).alias("fingerprint"), written(F.col("edited_sketch")).alias("edited_fingerprint"),
        containment(F.col("sketch"), F.col("edited_sketch")).alias("near_edited"),
        containment(F.col("sketch"), F.col("next_sketch")).alias("near_next"), "sketch", "edited_sketch")
