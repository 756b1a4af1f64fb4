"""Repeated passages: every window of words is hashed and counted, and repeated windows merge into removal intervals."""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BASE = np.uint64(0x9E3779B97F4A7C15 | 1)  # of the polynomial; any odd number with mixed bits will do
NO_ID = np.iinfo(np.int64).max  # a NULL doc_id comes after all others
BLOCK_WINDOWS = 1 << 20
TASK_BYTES = 16 << 20  # text whose windows meet in one task


def window_hashes(words: list[bytes], width: int) -> np.ndarray:
    """Rabin-Karp hashes, modulo 2^64, of every `width` consecutive words over the words' own hashes."""
    count = len(words) - width + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    each = np.array([xxhash.xxh64_intdigest(w) for w in words], np.uint64)
    total = each[:count].copy()
    for k in range(1, width):
        total *= BASE
        total += each[k:k + count]
    return total


def pack_arrays(*arrays: np.ndarray) -> bytes:
    """Unsigned arrays one after the other, each in the narrowest type that holds it."""
    parts = []
    for a in arrays:
        top = int(a.max()) if len(a) else 0
        width = 1 if top < 1 << 8 else 2 if top < 1 << 16 else 4 if top < 1 << 32 else 8
        parts += [bytes([width]), len(a).to_bytes(4, "little"), a.astype(f"<u{width}").tobytes()]
    return b"".join(parts)


def unpack_arrays(data: bytes) -> list[np.ndarray]:
    arrays, at = [], 0
    while at < len(data):
        width, n = data[at], int.from_bytes(data[at + 1:at + 5], "little")
        arrays.append(np.frombuffer(data, f"<u{width}", n, at + 5).astype(np.uint64))
        at += 5 + width * n
    return arrays


MARKS = pa.schema([("bucket", pa.int32()), ("marks", pa.binary())])
WINDOWS = pa.schema([*MARKS, ("windows", pa.binary())])


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], f.type) for k, f in enumerate(schema)], schema=schema)


def task_of(doc_id: Column, tag: Column, tasks: int) -> Column:
    """The task that gets the texts of a document."""
    return F.pmod(F.xxhash64(doc_id, tag), F.lit(tasks)).cast("int")


def _marks(ids: np.ndarray, tags: np.ndarray, position: np.ndarray, tasks: int) -> list[tuple[int, bytes]]:
    """Places of repeated windows, in one row for each task that gets the texts: the same tasks as task_of's."""
    documents, which = np.unique(np.column_stack([ids, tags]), axis=0, return_inverse=True)
    digest = xxhash.xxh64_intdigest
    octets = documents.astype("<i8").tobytes()
    at = range(0, len(octets), 16)
    hashed = np.array([digest(octets[k + 8:k + 16], digest(octets[k:k + 8], 42)) for k in at], np.uint64).view(np.int64)
    task = (hashed % tasks)[which.ravel()]
    order = np.argsort(task, kind="stable")
    rows = []
    for t, a, b in _runs(task[order]):
        mine = order[a:b]
        rows.append((int(t), pack_arrays(ids[mine].view(np.uint64), tags[mine].view(np.uint64), position[mine])))
    return rows


def _runs(sorted_values: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """Value, start and end of the runs of equal values."""
    starts = np.flatnonzero(np.r_[True, np.diff(sorted_values) != 0]) if len(sorted_values) else []
    return zip(sorted_values[starts], starts, [*starts[1:], len(sorted_values)])


def _hash_blocks(width: int, buckets: int):
    """Windows of blocks of documents, dealt over buckets by hash: `data` holds hashes, and documents and places as steps.

    Within a block a window is kept only for the smallest document that has it; the others are repeated for
    certain and pass on as finished marks. So a passage of many documents is one row per block, however common.
    """
    def block(held):
        held.sort(key=lambda d: d[:2])
        ids, tags = [np.array([d[k] for d in held], np.int64) for k in (0, 1)]
        counts = np.array([len(d[2]) for d in held])
        hashes = np.concatenate([d[2] for d in held])
        document = np.repeat(np.arange(len(held)), counts)
        position = np.arange(len(hashes)) - np.repeat(np.cumsum(counts) - counts, counts)
        order = np.argsort(hashes, kind="stable")  # so documents of a hash stay in order
        new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
        repeated = np.zeros(len(hashes), bool)
        repeated[order] = ids[document[order]] > ids[document[order[first]]]
        out = [(t, data, None) for t, data in _marks(ids[document[repeated]], tags[document[repeated]], position[repeated], buckets)]
        # what is left goes to its hash's bucket; the top bits choose, as the rest tells windows apart there
        left = np.flatnonzero(~repeated)
        bucket = ((hashes[left] >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)
        left = left[np.argsort(bucket, kind="stable")]
        bucket = np.sort(bucket)
        for b, a, e in _runs(bucket):
            mine = left[a:e]
            edge = np.r_[True, np.diff(document[mine]) != 0]
            steps = np.where(edge, position[mine], np.r_[0, np.diff(position[mine])])
            starts = np.flatnonzero(edge)
            here = document[mine][starts]
            lengths = np.diff(np.r_[starts, len(mine)])
            shift = ids[here].astype(np.uint64) ^ np.uint64(1 << 63)  # the same order, without a sign
            arrays = [hashes[mine], steps, lengths, shift[:1], np.diff(shift)]
            if tags.any():
                arrays.append(tags[here].astype(np.uint64))
            out.append((int(b), None, pack_arrays(*arrays)))
        return _batch(out, WINDOWS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for doc_id, tag, text in zip(*[batch.column(k).to_pylist() for k in (0, 1)], batch.column(2)):
                found = window_hashes((text.as_py() or b"").split(), width)
                if len(found):
                    held.append((NO_ID if doc_id is None else doc_id, tag, found))
                    size += len(found)
                if size >= BLOCK_WINDOWS:
                    yield block(held)
                    held, size = [], 0
        if held:
            yield block(held)

    return run


def _repeated(tasks: int):
    """From all windows of some buckets, the places of those that a smaller document has too."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, ids, tags, position = [], [], [], []
        for batch in batches:
            done = pc.is_valid(batch.column("marks"))
            yield batch.select(MARKS.names).filter(done)
            for data in batch.column("windows").filter(pc.invert(done)).to_pylist():
                own, steps, lengths, first, diffs, *tag = unpack_arrays(data)
                lengths = lengths.astype(np.int64)
                document = np.cumsum(np.r_[first, diffs], dtype=np.uint64) ^ np.uint64(1 << 63)
                starts = np.cumsum(lengths) - lengths
                total = np.cumsum(steps.astype(np.int64))
                before = total[starts] - steps[starts].astype(np.int64)
                hashes.append(own)
                position.append(total - np.repeat(before, lengths))
                ids.append(np.repeat(document.view(np.int64), lengths))
                tags.append(np.repeat(tag[0].view(np.int64), lengths) if tag else np.zeros(len(own), np.int64))
        if not hashes:
            return
        hashes, ids, tags, position = map(np.concatenate, (hashes, ids, tags, position))
        order = np.argsort(hashes)
        new = np.r_[True, hashes[order][1:] != hashes[order][:-1]]
        smallest = np.minimum.reduceat(ids[order], np.flatnonzero(new))
        mine = order[ids[order] > smallest[np.cumsum(new) - 1]]
        yield _batch(_marks(ids[mine], tags[mine], position[mine], tasks), MARKS)

    return run


def _cut(width: int, keep_text: bool):
    """Applies the marks of a task, which come ahead of its texts, to each of these."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packed, ids, tags, position = [], None, None, None
        for batch in batches:
            out = []
            for doc_id, tag, marks, text in zip(*[batch.column(k).to_pylist() for k in range(2)], *batch.columns[2:]):
                if marks.is_valid:
                    packed.append(unpack_arrays(marks.as_py()))
                    continue
                if ids is None:
                    ids, tags, position = [np.concatenate([np.empty(0, np.uint64), *c]) for c in (zip(*packed) if packed else [()] * 3)]
                    order = np.argsort(ids.view(np.int64), kind="stable")
                    ids, tags, position = ids.view(np.int64)[order], tags.view(np.int64)[order], position[order]
                words = (text.as_py() or b"").split()
                own = slice(*np.searchsorted(ids, [doc_id, doc_id + 1])) if doc_id < NO_ID else slice(np.searchsorted(ids, doc_id), None)
                spans, kept = removal(words, position[own][tags[own] == tag], width)
                line = b" ".join(kept)
                out.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(line).hexdigest(), spans)
                           + ((line,) if keep_text else ()))
            yield _batch(out, RESULT if keep_text else RESULT.remove(len(RESULT) - 1))

    return run


def removal(words: list[bytes], starts: np.ndarray, width: int) -> tuple[list[list[int]], list[bytes]]:
    """The maximal intervals that windows at these starts cover, end exclusive, and the words outside."""
    starts = np.unique(starts).astype(np.int64)
    if not len(starts):
        return [], words
    opens = np.r_[True, np.diff(starts) > width]
    spans = np.column_stack([starts[opens], starts[np.r_[opens[1:], True]] + width]).tolist()
    kept, at = [], 0
    for a, b in spans:
        kept += words[at:a]
        at = b
    return spans, kept + words[at:]


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_sha256", pa.string()),
    ("removed", pa.list_(pa.list_(pa.int64()))), ("kept", pa.binary())])


def remove_repeated(docs: DataFrame, width: int = 13, keep_text: bool = False) -> DataFrame:
    """Removes each word of a document that lies in a window of `width` words which also starts in a document with a
    smaller doc_id. Words are what ASCII white space parts, as they are; windows are judged on the input.

    Per row of `docs` (`doc_id`, `text`): doc_id, n_words, n_removed, kept_sha256 (of the kept words with one space
    between), removed (the maximal intervals of words, end exclusive); with `keep_text` also kept, the text left.
    Windows are the same if their 64-bit hashes are: of a billion windows, 0.03 pairs meet by chance.

    All windows are hashed where the text is read and dealt over tasks by hash, packed, about ten bytes each; a task
    gets those of about `TASK_BYTES` of text, and a window common to many documents once per block of a million.
    What comes back, the places of repeated windows, meets the texts by doc_id.

    A NULL text has no words; a NULL doc_id counts as larger than all others (as 2^63 - 1, which comes out as NULL too) and not as smaller than its like; rows
    with one doc_id do not repeat each other; an empty table gives no rows; other columns are ignored.
    """
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("binary").alias("text"))
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first().n
    spark = docs.sparkSession
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES)
    # two texts under one doc_id are told apart by a hash of the text; where ids are unique, none is carried
    keyed = docs.where("doc_id is not null").groupBy("doc_id").count().where("count > 1").isEmpty()
    unique = keyed and docs.where("doc_id is null").isEmpty()
    tag = F.lit(0).cast("long") if unique else F.xxhash64("text")
    tagged = docs.select("doc_id", tag.alias("tag"), "text")
    windows = tagged.mapInArrow(_hash_blocks(width, tasks), "bucket int, marks binary, windows binary")
    marks = windows.repartitionById(tasks, "bucket").mapInArrow(_repeated(tasks), "bucket int, marks binary")
    key = F.coalesce("doc_id", F.lit(NO_ID))
    none = F.lit(None).cast("binary")
    texts = tagged.select(task_of(key, F.col("tag"), tasks).alias("bucket"), key.alias("doc_id"), "tag", none.alias("marks"), "text")
    both = texts.unionByName(marks.withColumns({"doc_id": F.lit(0).cast("long"), "tag": F.lit(0).cast("long"), "text": none}))
    dealt = both.repartitionById(tasks, "bucket").sortWithinPartitions(F.col("marks").isNull())
    dealt = dealt.select("doc_id", "tag", "marks", "text")
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string, removed array<array<long>>"
    cut = dealt.mapInArrow(_cut(width, keep_text), schema + (", kept binary" if keep_text else ""))
    cut = cut.withColumn("doc_id", F.when(F.col("doc_id") != NO_ID, F.col("doc_id")))
    return cut.withColumn("kept", F.col("kept").cast("string")) if keep_text else cut
