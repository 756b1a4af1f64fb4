"""Tokens of two tokenizers over the same bytes: groups between common ends, and the links of ids within them."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tagpulse.llm.pieces import PieceTokens
from tagpulse.llm.tokens import ByteTokens
from tagpulse.session import fresh_folder

BLOCK_BYTES = 1 << 21
BLOCKS_BITS = 16  # blocks of one partition
PLACE_BITS = 26  # distinct pairs of one block
LINKS = 1 << 21  # links held at a time


class Strings:
    """Byte strings by number, joined in bulk."""

    def __init__(self, parts: list[bytes]):
        self.bytes = np.frombuffer(b"".join(parts), np.uint8)
        self.sizes = np.array([len(p) for p in parts], np.int32)
        self.starts = np.cumsum(self.sizes, dtype=np.int64) - self.sizes

    def joined(self, numbers: np.ndarray) -> bytes:
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes, dtype=np.int64)
        if not len(ends):
            return b""
        return self.bytes[np.repeat(self.starts[numbers] - ends + sizes, sizes) + np.arange(ends[-1])].tobytes()


def coalesce(starts_a: np.ndarray, ends_a: np.ndarray, starts_b: np.ndarray, ends_b: np.ndarray):
    """The group, from 0, of each A and of each B interval: all are sorted by start, and a group breaks where a start reaches
    the largest end so far. The intervals of one side follow each other, and no interval is empty."""
    starts = np.concatenate([starts_a, starts_b])
    ends = np.concatenate([ends_a, ends_b])
    order = np.lexsort((starts,))
    reached = np.maximum.accumulate(ends[order])
    breaks = np.ones(len(order), bool)
    breaks[1:] = starts[order][1:] >= reached[:-1]
    groups = np.empty(len(order), np.int32)
    groups[order] = np.cumsum(breaks, dtype=np.int32) - 1
    return groups[: len(starts_a)], groups[len(starts_a):]


def _tallied(codes: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes and the sums of their weights."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    first = np.flatnonzero(np.append(True, codes[1:] != codes[:-1]))
    return codes[first], np.add.reduceat(weights[order], first)


def expand(ids_a, ids_b, sizes_a, sizes_b, owners, base_a: int, base_b: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct links (owner·base_a + a)·base_b + b of all groups, and how often each occurs: every A token of a group is linked
    with every B token of it. At most `LINKS` links are held at a time beside the distinct ones; a group with more is first
    reduced to its distinct ids and how often these occur."""
    first_a, first_b = np.cumsum(sizes_a) - sizes_a, np.cumsum(sizes_b) - sizes_b
    links = sizes_a.astype(np.int64) * sizes_b
    found: list[tuple[np.ndarray, np.ndarray]] = []

    def some(a, times_a, b, times_b, rep_a, rep_b, owner):
        """Links of consecutive groups that together are small, given by their sizes."""
        count = rep_a * rep_b
        at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        wide = np.repeat(rep_b, count)
        of_a = np.repeat(np.cumsum(rep_a) - rep_a, count) + at // wide
        of_b = np.repeat(np.cumsum(rep_b) - rep_b, count) + at % wide
        codes = (np.repeat(owner, count) * base_a + a[of_a]) * base_b + b[of_b]
        return _tallied(codes, times_a[of_a] * times_b[of_b])

    def merge():
        if len(found) > 1:
            found[:] = [_tallied(np.concatenate([c for c, _ in found]), np.concatenate([t for _, t in found]))]

    begin = 0
    total = np.cumsum(links)
    while begin < len(links):
        end = max(begin + 1, int(np.searchsorted(total, (total[begin - 1] if begin else 0) + LINKS, side="right")))
        a = ids_a[first_a[begin]: first_a[end - 1] + sizes_a[end - 1]].astype(np.int64)
        b = ids_b[first_b[begin]: first_b[end - 1] + sizes_b[end - 1]].astype(np.int64)
        if links[begin: end].sum() <= LINKS:
            found.append(some(a, np.ones(len(a), np.int64), b, np.ones(len(b), np.int64),
                              sizes_a[begin:end].astype(np.int64), sizes_b[begin:end].astype(np.int64), owners[begin:end]))
        else:
            (a, times_a), (b, times_b) = (np.unique(x, return_counts=True) for x in (a, b))
            step = max(LINKS // len(b), 1)
            for k in range(0, len(a), step):
                part = a[k: k + step]
                found.append(some(part, times_a[k: k + step], b, times_b, np.array([len(part)]), np.array([len(b)]), owners[begin:end]))
                if len(found) > 8:
                    merge()
        if len(found) > 8:
            merge()
        begin = end
    merge()
    return found[0] if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


class Aligner:
    """Aligns texts in bulk by the files of a byte-level BPE (A) and of a merge-type piece vocabulary (B)."""

    def __init__(self, a_file: str, b_file: str):
        self.a, self.b = ByteTokens(a_file), PieceTokens(b_file)
        self.a_bytes = Strings(self.a.entries())
        self.b_bytes = Strings(self.b.entries)
        self.base_a, self.base_b = len(self.a_bytes.sizes), len(self.b_bytes.sizes)
        decimals = [str(n).encode() for n in range(max(self.base_a, self.base_b))]
        self.written = Strings([d + mark for mark in (b",", b"|", b";", b"") for d in decimals])
        self.marks = len(decimals)

    def _ids(self, texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """The ids of both sides; none for a text that is empty or that a side's tokens don't spell."""
        none = np.zeros(0, np.int32)
        for text, of_b in zip(texts, self.b.encode(texts)):
            line = (" " + text).encode()
            of_b = np.frombuffer(of_b, "<i4")
            of_a = self.a.plain(" " + text).astype(np.int32) if text else none
            spelt = text and self.a_bytes.joined(of_a) == line and self.b_bytes.joined(of_b) == line
            yield (of_a, of_b) if spelt else (none, none)

    def run(self, texts: list[str]):
        """Per text n_a, n_b, n_groups, n_links and the groups as written; and the distinct links of each text (text, pair,
        times), ascending, a pair being a·base_b + b."""
        ids = list(self._ids(texts))
        n_a, n_b = (np.array([len(pair[side]) for pair in ids]) for side in (0, 1))
        a, b = (np.concatenate([pair[side] for pair in ids]) for side in (0, 1))
        del ids
        ends_a, ends_b = np.cumsum(self.a_bytes.sizes[a], dtype=np.int64), np.cumsum(self.b_bytes.sizes[b], dtype=np.int64)
        if len(ends_a) and ends_a[-1] < 1 << 31:
            ends_a, ends_b = ends_a.astype(np.int32), ends_b.astype(np.int32)
        # texts follow each other, and each ends with a token of both sides, so no group crosses from one to the next
        group_a, group_b = coalesce(ends_a - self.a_bytes.sizes[a], ends_a, ends_b - self.b_bytes.sizes[b], ends_b)
        del ends_a, ends_b
        sizes_a, sizes_b = np.bincount(group_a), np.bincount(group_b)
        owners = np.repeat(np.arange(len(texts)), n_a)[np.cumsum(sizes_a) - sizes_a] if len(a) else np.zeros(0, np.int64)
        n_groups = np.bincount(owners, minlength=len(texts))
        n_links = np.zeros(len(texts), np.int64)
        np.add.at(n_links, owners, sizes_a * sizes_b)
        groups = self._groups(a, b, group_a, group_b, sizes_a, sizes_b, n_a, n_b, n_groups)
        del group_a, group_b
        codes, times = expand(a, b, sizes_a, sizes_b, owners, self.base_a, self.base_b)
        owner, pair = np.divmod(codes, self.base_a * self.base_b)
        return n_a, n_b, n_groups, n_links, groups, owner, pair, times

    def _groups(self, a, b, group_a, group_b, sizes_a, sizes_b, n_a, n_b, n_groups) -> list[bytes]:
        """`a1,a2|b1;a3|b2,b3` for every text."""
        upto_a, upto_b = np.cumsum(sizes_a), np.cumsum(sizes_b)
        marked = np.empty(len(a) + len(b), np.int32)
        place_a = np.arange(len(a)) + (upto_b - sizes_b)[group_a]
        place_b = np.arange(len(b)) + upto_a[group_b]
        marked[place_a] = a
        marked[place_b] = b
        last_b = place_b[upto_b - 1]
        marked[place_a[upto_a - 1]] += self.marks
        marked[last_b] += 2 * self.marks
        closing = np.cumsum(n_groups)[n_groups > 0] - 1
        marked[last_b[closing]] += self.marks
        ends = np.cumsum(n_a + n_b).tolist()
        return [self.written.joined(marked[end - n: end]) for end, n in zip(ends, (n_a + n_b).tolist())]


ALIGNED = ("block long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
           "places binary, times binary, pairs array<long>, docs array<int>")


def _blocks(a_file: str, b_file: str, block_bytes: int, keep_groups: bool):
    """Aligns the texts of a task block by block. Of each block come a row per document, with the places of its links in
    the block's list of pairs, and a row with that list and in how many documents of the block each pair is."""

    def rows(block, doc_ids, texts, aligner):
        n_a, n_b, n_groups, n_links, groups, owner, pair, times = aligner.run(texts)
        pairs, place, docs = np.unique(pair, return_inverse=True, return_counts=True)
        if len(pairs) >= 1 << PLACE_BITS:
            raise ValueError("a block has too many distinct pairs; make blocks smaller")
        bounds = np.searchsorted(owner, np.arange(len(texts) + 1)).tolist()
        places, counts = [], []
        for begin, end in zip(bounds[:-1], bounds[1:]):
            places.append(np.diff(place[begin:end], prepend=0).astype("<i4").tobytes())  # small steps pack well
            some = times[begin:end]
            counts.append(some.astype("<i8" if len(some) and some.max() > 255 else "u1").tobytes())
        columns = {
            "block": pa.array(np.full(len(texts), block)),
            "doc_id": pa.array(doc_ids, pa.int64()), "n_a": pa.array(n_a), "n_b": pa.array(n_b),
            "n_groups": pa.array(n_groups), "n_links": pa.array(n_links),
            "groups_sha256": pa.array([hashlib.sha256(g).hexdigest() if g else "" for g in groups], pa.string()),
            "places": pa.array(places, pa.binary()), "times": pa.array(counts, pa.binary()),
            "pairs": pa.nulls(len(texts), pa.list_(pa.int64())), "docs": pa.nulls(len(texts), pa.list_(pa.int32()))}
        if keep_groups:
            columns["groups"] = pa.array([g.decode() for g in groups], pa.string())
        yield pa.RecordBatch.from_pydict(columns)
        listed = {name: pa.nulls(1, column.type) for name, column in columns.items()}
        listed["block"] = pa.array([block])
        listed["pairs"] = pa.array([pairs], pa.list_(pa.int64()))
        listed["docs"] = pa.array([docs.astype(np.int32)], pa.list_(pa.int32()))
        yield pa.RecordBatch.from_pydict(listed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = Aligner(a_file, b_file)
        block = TaskContext.get().partitionId() << BLOCKS_BITS
        last = block + (1 << BLOCKS_BITS)
        doc_ids, texts, size = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                doc_ids.append(doc_id)
                texts.append(text.as_py() or "")
                size += len(texts[-1])
                if size >= block_bytes:
                    yield from rows(block, doc_ids, texts, aligner)
                    doc_ids, texts, size, block = [], [], 0, block + 1
                    if block == last:
                        raise ValueError("a partition has too many blocks; make partitions smaller")
        if texts:
            yield from rows(block, doc_ids, texts, aligner)

    return run


def counted(aligned: DataFrame) -> DataFrame:
    """(pair, count): in how many documents a pair of ids is linked. Pairs of a task's blocks are added up before the shuffle."""
    pairs = aligned.where(F.col("pairs").isNotNull()).select(F.explode(F.arrays_zip("pairs", "docs")).alias("p"))
    return pairs.groupBy(F.col("p.pairs").alias("pair")).agg(F.sum("p.docs").alias("count"))


def align(docs: DataFrame, a_file: str, b_file: str, block_bytes: int = BLOCK_BYTES, keep_groups: bool = False) -> DataFrame:
    """Aligns the tokens of `docs` (`doc_id`, `text`) by a byte-level BPE (A) with those by a merge-type piece vocabulary (B).

    Both encode a space and the text, without special tokens. Groups lie between byte offsets where a token of either side
    ends. Per row: doc_id, n_a, n_b, n_groups, n_links (pairs of an A and a B token of one group), n_best (links whose count,
    the number of documents that hold the pair of ids linked, is the highest of their A id), count_sum (of counts over links),
    groups_sha256 (of the groups written as `a1,a2|b1;a3|b2,b3`) and, with `keep_groups`, groups.

    Texts are read and aligned once, in blocks of about `block_bytes` characters, and what is found is written to the shared
    folder. Only distinct pairs of a block, not links, are shuffled to be counted; counts come back to the blocks. A pair that
    is in every block is one row for each.
    A text that is NULL, empty or not spelt by the tokens of a side has no tokens: zeros and an empty groups_sha256. A NULL doc_id is
    kept; repeated rows are documents of their own; an empty table gives no rows; other columns are ignored. A text longer than
    a block is a block of its own; memory grows with it and with the distinct links of its groups.
    """
    spark = docs.sparkSession
    schema = ALIGNED + (", groups string" if keep_groups else "")
    folder = fresh_folder(spark, "aligned")
    docs.select(docs["doc_id"].cast("long").alias("doc_id"), "text").mapInArrow(
        _blocks(a_file, b_file, block_bytes, keep_groups), schema).write.parquet(folder)
    aligned = spark.read.schema(schema).parquet(folder)

    counts = counted(aligned)
    base_b = len(PieceTokens(b_file).entries)
    best = counts.groupBy(F.call_function("div", "pair", F.lit(base_b)).alias("a")).agg(F.max("count").alias("most"))
    rated = (
        counts.withColumn("a", F.call_function("div", "pair", F.lit(base_b)))
        .join(F.broadcast(best), "a")  # one row per id of A: as many as its vocabulary has, at most
        .select("pair", (F.shiftleft("count", 1) + (F.col("count") == F.col("most")).cast("long")).alias("rate")))
    places = (
        aligned.where(F.col("pairs").isNotNull()).select("block", F.posexplode("pairs").alias("place", "pair"))
        .select("pair", (F.shiftleft("block", PLACE_BITS) + F.col("place")).alias("at")))
    rates = places.join(rated, "pair").select("at", "rate").withColumn("block", F.shiftright("at", PLACE_BITS))
    kept = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", *(["groups"] if keep_groups else [])]
    rows = aligned.where(F.col("pairs").isNull()).select("block", *kept, "places", "times")

    def score(left: pa.Table, right: pa.Table) -> pa.Table:
        at, rate = (np.concatenate([np.asarray(c) for c in right.column(name).chunks] or [np.zeros(0, np.int64)]) for name in ("at", "rate"))
        place = at & ((1 << PLACE_BITS) - 1)
        rates = np.zeros(len(place), np.int64)
        rates[place] = rate
        n_best, count_sum = [], []
        for steps, times in zip(left.column("places"), left.column("times")):
            steps = np.frombuffer(steps.as_py(), "<i4")
            times = times.as_py()
            times = np.frombuffer(times, "u1" if len(times) == len(steps) else "<i8").astype(np.int64)
            of = rates[np.cumsum(steps)]
            n_best.append(int(times[of & 1 == 1].sum()))
            count_sum.append(int((times * (of >> 1)).sum()))
        columns = {name: left.column(name) for name in kept}
        columns["n_best"], columns["count_sum"] = pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())
        return pa.table(columns)

    fields = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
    result = ", ".join(f"{name} {fields[name]}" for name in kept) + ", n_best long, count_sum long"
    return rows.groupBy("block").cogroup(rates.groupBy("block")).applyInArrow(score, result)
