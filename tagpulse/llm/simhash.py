"""Near-duplicates: by SimHash, as fingerprints that differ in few bits share whole blocks of bits; and by shared shingles."""

from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.components import components, joined
from tagpulse.session import checkpointed

BITS = 64


def majority_bits(hashes: np.ndarray, step: int = 1 << 16) -> int:
    """The bits that are set in over half of the hashes; 0 for none."""
    counts = np.zeros(BITS, np.int64)
    for k in range(0, len(hashes), step):
        octets = np.ascontiguousarray(hashes[k:k + step], "<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(octets, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > len(hashes), bitorder="little").tobytes(), "little")


def shingle_hashes(text: bytes, words: int, seed: int) -> np.ndarray:
    """XXH64 of the runs of `words` words, lower-cased in A-Z; of all words, if there are fewer."""
    found = text.lower().split()  # of bytes: A-Z, and white space in ASCII
    if not found:
        return np.empty(0, np.uint64)
    line = b" ".join(found)
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts, ends[min(words, len(found)) - 1:])
    return np.array([digest(line[a:b - 1], seed) for a, b in spans], np.uint64)


def fingerprints(docs: DataFrame, words: int = 4, seed: int = 42) -> DataFrame:
    """(doc_id, bits): the 64-bit SimHash of each text over its shingles of `words` words, repeats included."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bits = np.array([majority_bits(shingle_hashes(t.as_py() or b"", words, seed)) for t in batch.column(1)], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(bits.view(np.int64))], names=["doc_id", "bits"])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary")).mapInArrow(run, "doc_id long, bits long")


def block_masks(blocks: int, distance: int) -> list[int]:
    """Masks of all ways to keep `blocks` - `distance` of the blocks, as signed longs."""
    cuts = [BITS * k // blocks for k in range(blocks + 1)]
    block = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(cuts, cuts[1:])]
    masks = [sum(kept) for kept in combinations(block, blocks - distance)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def block_count(fingerprints: int, distance: int, partners: int = 256) -> int:
    """The fewest blocks at which a fingerprint shares the bits of a mask with at most `partners` others by chance.

    Every mask is a row to shuffle for each fingerprint, while a partner is one operation on a vector: 5 masks do for a million
    fingerprints (at four bits), 15 for half a thousand million, 35 for thirty thousand million.
    """
    blocks = distance + 1
    while fingerprints > partners << BITS * (blocks - distance) // blocks and blocks < 4 * distance + 4:
        blocks += 1
    return blocks


def near_forest(members: np.ndarray, distance: int) -> list[tuple[int, np.ndarray]]:
    """Links that connect the members exactly as all pairs within `distance` bits would: (member, new neighbours)."""
    links, rest = [], members
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            near = np.bitwise_count(rest ^ at) <= distance
            if near.any():
                found = rest[near]
                links.append((at, found))
                reached.extend(found)
                rest = rest[~near]
    return links


def group_links(members: np.ndarray, distance: int, slab: int = 1 << 18) -> tuple[np.ndarray, np.ndarray]:
    """(left, right) of a group's links: all pairs within `distance` bits, or a forest if they are more than the members."""
    left, right, found = [members[:0]], [members[:0]], 0
    step = max(1, slab // len(members))
    for k in range(0, len(members) - 1, step):
        own, others = members[k:k + step], members[k + 1:]
        i, j = np.nonzero(np.bitwise_count(own[:, None] ^ others) <= distance)
        i, j = i[j >= i], j[j >= i]  # each pair once, and none with itself
        left.append(own[i])
        right.append(others[j])
        found += len(i)
        if found > len(members):
            forest = near_forest(members, distance)
            return np.repeat(np.array([at for at, _ in forest], np.uint64), [len(f) for _, f in forest]), np.concatenate([f for _, f in forest])
    return np.concatenate(left), np.concatenate(right)


def _forests(distance: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.empty((0, 5), np.int64)  # the last group so far: it may go on in the next batch

        def links(rows: np.ndarray):
            if not len(rows):
                return
            edge = np.flatnonzero((rows[1:, :4] != rows[:-1, :4]).any(1)) + 1
            starts, ends = np.r_[0, edge], np.r_[edge, len(rows)]
            bits = rows[:, 4].view(np.uint64) if rows[:, 4].flags.c_contiguous else rows[:, 4].copy().view(np.uint64)
            two = starts[ends - starts == 2]
            near = np.bitwise_count(bits[two] ^ bits[two + 1]) <= distance
            left, right, masks = [bits[two][near]], [bits[two + 1][near]], [rows[two, 0][near]]
            for a, b in zip(starts[ends - starts > 2], ends[ends - starts > 2]):
                one, other = group_links(bits[a:b], distance)
                left.append(one)
                right.append(other)
                masks.append(np.full(len(one), rows[a, 0]))
            columns = [pa.array(np.concatenate(x).view(np.int64)) for x in (left, right)]
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(masks).astype(np.int32)), *columns], names=["mask", "left", "right"])

        for batch in batches:
            if not batch.num_rows:
                continue
            rows = np.concatenate([held, np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(np.int64)])
            last = np.flatnonzero((rows[:, :4] != rows[-1, :4]).any(1))
            cut = last[-1] + 1 if len(last) else 0
            yield from links(rows[:cut])
            held = rows[cut:]
        yield from links(held)

    return run


def near_links(prints: DataFrame, distance: int = 4, members: int = 4096, kinds: int = 1) -> DataFrame:
    """(kind, left, right): links between distinct `bits` of one `kind` (0 to `kinds` - 1) that connect all that differ in at most
    `distance` bits, and no others.

    The bits are cut into blocks; two that are near each other agree on all but `distance` of the blocks, so they meet
    under one of the masks that keep the others. Every mask's groups of two and more are joined and verified. A group of
    over `members` is cut into that many by hash, and every two parts meet in a task of their own; from each comes a
    forest, never all pairs, so what comes out is linear in the members.
    """
    masks = block_masks(block_count(prints.count() // kinds, distance), distance)
    keys = prints.select("kind", "bits", F.posexplode(F.array(*[F.col("bits").bitwiseAND(F.lit(m)) for m in masks])).alias("mask", "key"))
    keys = keys.select("bits", (F.col("kind") * len(masks) + F.col("mask")).alias("mask"), "key")
    sizes = keys.groupBy("mask", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / members).cast("int")
    cells = (
        keys.join(sizes, ["mask", "key"])
        .select("mask", "key", "bits", parts.alias("parts"))
        .withColumn("own", F.pmod(F.xxhash64("bits"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("mask", "key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "bits"))
    group = ["mask", "key", "a", "b"]
    dealt = cells.repartition(*group).sortWithinPartitions(*group)
    links = dealt.mapInArrow(_forests(distance), "mask int, left long, right long")
    return links.select(F.floor(F.col("mask") / len(masks)).cast("int").alias("kind"), "left", "right")


def near_duplicates(docs: DataFrame, words: int = 4, seed: int = 42, distance: int = 4, members: int = 4096) -> DataFrame:
    """Per document: doc_id, bits (its SimHash) and component_id, the smallest doc_id that is reached over fingerprints
    that differ in at most `distance` bits.

    Equal texts share a fingerprint and are one row from there on. A NULL text is an empty one: fingerprint zero, linked
    like any other. A repeated row comes out as often as it goes in; a NULL doc_id is kept, and a component with no other
    has a NULL component_id; an empty table gives no rows; other columns are ignored. The fingerprints are written to the
    shared folder once.
    """
    prints = checkpointed(fingerprints(docs, words, seed))
    distinct = checkpointed(prints.groupBy("bits").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies")))
    count, total = distinct.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    roots = components(near_links(distinct.select("bits", F.lit(0).alias("kind")), distance, members))
    rooted = checkpointed(
        distinct.join(roots.select(F.col("node").alias("bits"), "root"), "bits", "left")
        .select("bits", "first", "copies", F.coalesce("root", "bits").alias("root")))
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"), F.count("*").alias("n"))
    classes = checkpointed(joined(rooted, smallest, "root", count).select("bits", "component_id", F.col("copies").alias("n")))
    return joined(prints, classes, "bits", total).select("doc_id", "bits", "component_id")


WORDS_SEED = 42  # that of the engine's own hash, so that `words_hash` gives the same


def words_hash(text: Column) -> Column:
    """The hash of a text's words, lower-cased in A-Z, as `band_prints` has it; a NULL is an empty text."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    found = F.split(F.translate(F.coalesce(text, F.lit("")), upper, upper.lower()), r"[\x20\x09-\x0D]+")
    return F.xxhash64(F.array_join(F.array_remove(found, ""), " "))


def text_shingles(found: list[bytes], words: int = 5) -> np.ndarray:
    """Sorted 64-bit hashes of the distinct runs of `words` words; of all words, if there are fewer; none for no words."""
    words = min(words, len(found))
    if not words:
        return np.empty(0, np.uint64)
    digest = xxhash.xxh64_intdigest
    own = np.array([digest(w) for w in found], np.uint64)
    count = len(own) - words + 1
    runs = np.zeros(count, np.uint64)
    for k in range(words):
        runs = (runs ^ own[k:k + count]) * np.uint64(0x9E3779B97F4A7C15)
        runs ^= runs >> np.uint64(29)
    return np.unique(runs)


def band_keys(shingles: np.ndarray, bands: int, rows: int, step: int = 1024) -> np.ndarray:
    """One key for each band of `rows` MinHashes: two texts have a band's key in common with the chance similarity ** rows."""
    if not len(shingles):
        return np.empty(0, np.uint64)
    odd = np.array([xxhash.xxh64_intdigest(b"minhash", k) | 1 for k in range(bands * rows)], np.uint64)[:, None]
    least = np.full(bands * rows, np.iinfo(np.uint64).max, np.uint64)
    for k in range(0, len(shingles), step):
        np.minimum(least, (odd * shingles[k:k + step]).min(1), out=least)
    return np.array([xxhash.xxh64_intdigest(band.tobytes(), k) for k, band in enumerate(least.reshape(bands, rows))], np.uint64)


def band_prints(docs: DataFrame, words: int, bands: int, rows: int, print_words: int = 4, print_seed: int = 42) -> DataFrame:
    """(doc_id, words, size, bits, keys): a hash of each text's words, how many distinct shingles it has, its SimHash as in
    `fingerprints`, and its keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, sizes, bits, keys = [], [], [], []
            for text in batch.column(1):
                found = (text.as_py() or b"").lower().split()
                shingles = text_shingles(found, words)
                whole.append(xxhash.xxh64_intdigest(b" ".join(found), WORDS_SEED))
                sizes.append(len(shingles))
                bits.append(majority_bits(shingle_hashes(text.as_py() or b"", print_words, print_seed)))
                keys.append(band_keys(shingles, bands, rows).view(np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(np.array(whole, np.uint64).view(np.int64)), pa.array(sizes, pa.int64()),
                 pa.array(np.array(bits, np.uint64).view(np.int64)), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "words", "size", "bits", "keys"])

    return docs.mapInArrow(run, "doc_id long, words long, size long, bits long, keys array<long>")


def print_classes(texts: DataFrame, distance: int, members: int) -> DataFrame:
    """(words, size, key): `texts` (words, size, bits), each with the smallest of the prints that its own reaches over prints that
    differ in at most `distance` bits. So any two texts whose prints are that near have one key."""
    prints = checkpointed(texts.groupBy("bits").agg(F.count("*").alias("n")))
    roots = components(near_links(prints.select("bits", F.lit(0).alias("kind")), distance, members))
    classes = checkpointed(
        prints.join(roots.select(F.col("node").alias("bits"), "root"), "bits", "left")
        .select("bits", "n", F.coalesce("root", "bits").alias("key")))
    total = classes.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    return checkpointed(joined(texts, classes, "bits", total).select("words", "size", "key"))


def shingle_sets(docs: DataFrame, words: int) -> DataFrame:
    """(words, shingles): the hash of a text's words as in `band_prints`, and its distinct shingles; a text once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 256):
                texts = [(t.as_py() or b"").lower().split() for t in batch.column(1)[k:k + 256]]
                whole = np.array([xxhash.xxh64_intdigest(b" ".join(t), WORDS_SEED) for t in texts], np.uint64)
                sets = [text_shingles(t, words).view(np.int64) for t in texts]
                yield pa.RecordBatch.from_arrays([pa.array(whole.view(np.int64)), pa.array(sets, pa.list_(pa.int64()))], names=["words", "shingles"])

    return docs.mapInArrow(run, "words long, shingles array<long>").dropDuplicates(["words"])


def similar_forest(sets: list[np.ndarray], least: float) -> list[tuple[int, int]]:
    """Links between sorted sets that connect them exactly as all pairs of a Jaccard similarity of `least` and more would."""
    sizes = np.array([len(s) for s in sets])
    links, rest = [], np.arange(len(sets))
    while len(rest) > 1:
        reached, rest = [rest[0]], rest[1:]
        while reached and len(rest):
            at = reached.pop()
            own, size = sets[at], sizes[at]
            if not size:
                continue
            fits = np.flatnonzero((sizes[rest] >= least * size * 0.999) & (sizes[rest] * least * 0.999 <= size) & (sizes[rest] > 0))
            if not len(fits):
                continue
            other = rest[fits]
            values = np.concatenate([sets[k] for k in other])
            same = own[np.minimum(np.searchsorted(own, values), size - 1)] == values
            shared = np.add.reduceat(same, np.r_[0, np.cumsum(sizes[other])[:-1]], dtype=np.int64)
            found = shared / (size + sizes[other] - shared) >= least
            links.extend((at, k) for k in other[found])
            reached.extend(other[found])
            rest = np.delete(rest, fits[found])
    return links


def _similar_forests(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, texts, sets = None, [], []

        def links() -> pa.RecordBatch:
            pairs = np.array(similar_forest(sets, least), np.int64).reshape(-1, 2)
            of = np.array(texts, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(of[pairs[:, 0]]), pa.array(of[pairs[:, 1]])], names=["left", "right"])

        for batch in batches:
            groups = zip(*(batch.column(k).to_pylist() for k in range(3)))
            for group, text, found in zip(groups, batch.column(3).to_pylist(), batch.column(4)):
                if group != now:
                    if len(sets) > 1:
                        yield links()
                    now, texts, sets = group, [], []
                texts.append(text)
                sets.append(found.values.to_numpy().view(np.uint64))
        if len(sets) > 1:
            yield links()

    return run


def similar_documents(docs: DataFrame, words: int = 5, least: float = 0.8, bands: int = 24, rows: int = 6, members: int = 4096, held: int = 1 << 21, distance: int = 4) -> DataFrame:
    """Per document: doc_id, words (the hash of its text's words), component_id over near copies, those that share `least` and more
    of their distinct shingles, and stays: whether this text under this id stands for its component (of several texts of the
    smallest id the one of the smallest hash).

    Candidates are linked by SimHash as in `near_duplicates`: all whose fingerprints differ in at most `distance` bits, none is missed.
    Copies that differ by more have a band of MinHashes in common: of pairs at 0.8 that misses (1 - 0.8 ** 6) ** 24, one in 1,460,
    and less above, wherever the copies differ. The texts of each SimHash class and of each band's key meet with all of their
    shingles and are linked where these are alike enough, and nowhere else; keys that bring the same texts together count once. A group
    of over `members` texts or `held` shingles is cut into parts, and every two parts meet in a task of their own; from each comes a
    forest, as in `near_links`.
    Texts are compared by 64-bit hashes, lower-cased in A-Z. Rows as in `near_duplicates`.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary"))
    prints = checkpointed(band_prints(docs, words, bands, rows))
    texts = checkpointed(prints.groupBy("words").agg(F.min("doc_id").alias("first"), F.any_value("size").alias("size"), F.any_value("bits").alias("bits"), F.any_value("keys").alias("keys"), F.count("*").alias("copies")))
    printed = print_classes(texts.where("size > 0").select("words", "size", "bits"), distance, members)
    keyed = printed.union(texts.select("words", "size", F.explode("keys").alias("key")))
    groups = keyed.groupBy("key").agg(F.count("*").alias("n"), F.sum("size").alias("shingles"), F.bit_xor(F.xxhash64("words")).alias("who")).where("n > 1")
    groups = groups.groupBy("who", "n", "shingles").agg(F.min("key").alias("key"))
    parts = F.greatest(F.ceil(F.col("n") / members), F.ceil(F.col("shingles") / held)).cast("int")
    cells = checkpointed(
        keyed.join(groups.select("key", parts.alias("parts")), "key")
        .withColumn("own", F.pmod(F.xxhash64("words"), F.col("parts")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select("key", F.least("own", "other").alias("a"), F.greatest("own", "other").alias("b"), "words"))
    wanted = texts.join(cells.select("words").distinct(), "words", "left_semi").where("first is not null").select(F.col("first").alias("doc_id"))
    chosen = docs.join(wanted, "doc_id", "left_semi").union(docs.where("doc_id is null"))
    group = ["key", "a", "b"]
    dealt = cells.join(shingle_sets(chosen, words), "words").select(*group, "words", "shingles").repartition(*group).sortWithinPartitions(*group)
    roots = components(dealt.mapInArrow(_similar_forests(least), "left long, right long"))
    roots = roots.select(F.col("node").alias("words"), "root")
    rooted = checkpointed(texts.join(roots, "words", "left").select("words", "first", "copies", F.coalesce("root", "words").alias("root")))
    count, total = rooted.agg(F.count("*"), F.coalesce(F.sum("copies"), F.lit(0))).first()
    own = F.when(F.col("first").isNotNull(), F.struct("first", "words"))
    smallest = rooted.groupBy("root").agg(F.min(own).alias("kept"), F.count("*").alias("n"))
    classes = joined(rooted.select("words", "copies", "root"), smallest, "root", count)
    classes = checkpointed(classes.select("words", "kept.first", F.col("kept.words").alias("of"), F.col("copies").alias("n")))
    stays = (F.col("doc_id") == F.col("first")) & (F.col("words") == F.col("of"))
    return joined(prints.select("doc_id", "words"), classes, "words", total).select(
        "doc_id", "words", F.col("first").alias("component_id"), F.coalesce(stays, F.lit(False)).alias("stays"))


def keep_one(docs: DataFrame, found: DataFrame) -> DataFrame:
    """`docs` with one row of each component in `found` (doc_id, words, stays): the text of its smallest doc_id that stays there.

    Several texts under one id are told apart: each goes or stays with its own component. Rows without a doc_id stay, as nothing
    tells them apart; of rows with one doc_id and the same words that of the smallest text stays.
    """
    kept = found.where("stays").select(F.col("doc_id").alias("_id"), F.col("words").alias("_words")).distinct()
    whole = F.struct(*docs.columns)
    rows = docs.where("doc_id is not null").select(
        F.col("doc_id").cast("long").alias("_id"), words_hash(F.col("text")).alias("_words"), whole.alias("_row"))
    ids = rows.join(kept, ["_id", "_words"], "left_semi").groupBy("_id", "_words").agg(F.min_by("_row", F.struct("_row.text")).alias("_row"))
    return ids.select("_row.*").union(docs.where("doc_id is null"))
