"""Documents packed into training sequences of even attention cost."""

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tagpulse.llm.tokens import ByteTokens

SCHEMA = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, "
          "sequence_cost double")


def assign(lengths, capacity: int, linear: float, quadratic: float) -> tuple[list[tuple[int, int, int, int, int]], np.ndarray]:
    """Places documents of the given token counts into as few sequences as hold them all.

    A piece of n tokens costs linear·n + quadratic·n². Documents go in descending order to the sequence of
    the lowest cost that has room for the whole; when none has, the one of the lowest cost that has any room
    takes what fits and the rest waits its turn as a shorter document. Ties go to the earlier document and
    sequence. Gives (document, start, length, sequence, offset) and the cost of each sequence.
    """
    pieces = []
    count = -(-int(sum(lengths)) // capacity)
    cost, room = np.zeros(count), np.full(count, capacity)
    waiting: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by length: (document, start)
    full = 0
    for document, n in enumerate(lengths):
        whole, rest = divmod(int(n), capacity)
        for k in range(whole):
            pieces.append((document, k * capacity, capacity, full, 0))
            cost[full], room[full] = linear * capacity + quadratic * capacity**2, 0
            full += 1
        if rest:
            waiting[rest].append((document, whole * capacity))
    open_cost, open_room = cost[full:], room[full:]
    for n in range(capacity, 0, -1):
        for document, start in waiting[n]:
            fits = open_room >= n
            if not fits.any():
                fits = open_room > 0
            chosen = int(np.where(fits, open_cost, np.inf).argmin())
            taken = min(n, int(open_room[chosen]))
            pieces.append((document, start, taken, full + chosen, capacity - int(open_room[chosen])))
            open_room[chosen] -= taken
            open_cost[chosen] += linear * taken + quadratic * taken**2
            if taken < n:
                waiting[n - taken].append((document, start + taken))
    return pieces, cost


def pack(docs: DataFrame, tokenizer: str, capacity: int = 2048, end_id: int = 1, linear: float = 1.0,
         quadratic: float = 1 / 1024, block_tokens: int = 1 << 21, keep_ids: bool = False) -> DataFrame:
    """The pieces of all documents (`doc_id`, `text`) in sequences of at most `capacity` tokens.

    A document's ids are those of `tokenizer` (a file of a byte-level BPE, readable on every executor) and then
    `end_id`. Each task packs what it reads in blocks of about `block_tokens` tokens, in one pass and without a
    shuffle: a block leaves less than one sequence of padding in all. Sequence numbers hold the partition's, so
    they are unique, and a repeated task repeats them as its input is the same.

    Per piece: doc_id, start, length, ids_crc32 (unsigned, of the ids as little-endian uint32), doc_tokens,
    sequence_id, offset, sequence_cost; with `keep_ids` also ids (array<int>).
    A NULL or empty text is the end id alone; a NULL doc_id is kept; repeated rows are packed once each; an empty
    table gives no rows; other columns are ignored. A document longer than a block is a block of its own.
    """
    schema = SCHEMA + (", ids array<int>" if keep_ids else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = ByteTokens(tokenizer)
        end = int(end_id).to_bytes(4, "little")
        sequence = TaskContext.get().partitionId() << 33
        block: list[tuple[int | None, bytes]] = []
        size = 0

        def flush():
            nonlocal sequence
            if not block:
                return
            counts = [len(ids) // 4 for _, ids in block]
            pieces, cost = assign(counts, capacity, linear, quadratic)
            parts = [block[d][1][4 * s: 4 * (s + n)] for d, s, n, _, _ in pieces]
            columns = {
                "doc_id": pa.array([block[p[0]][0] for p in pieces], pa.int64()),
                "start": pa.array([p[1] for p in pieces], pa.int64()),
                "length": pa.array([p[2] for p in pieces], pa.int64()),
                "ids_crc32": pa.array([zlib.crc32(p) for p in parts], pa.int64()),
                "doc_tokens": pa.array([counts[p[0]] for p in pieces], pa.int64()),
                "sequence_id": pa.array([sequence + p[3] for p in pieces], pa.int64()),
                "offset": pa.array([p[4] for p in pieces], pa.int64()),
                "sequence_cost": pa.array(cost[[p[3] for p in pieces]], pa.float64()),
            }
            if keep_ids:
                columns["ids"] = pa.array([np.frombuffer(p, "<i4") for p in parts], pa.list_(pa.int32()))
            sequence += len(cost)
            block.clear()
            yield pa.RecordBatch.from_pydict(columns)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                ids = tokens.encode(text.as_py() or "") + end
                block.append((doc_id, ids))
                size += len(ids) // 4
                if size >= block_tokens:
                    size = 0
                    yield from flush()
        yield from flush()

    return docs.select("doc_id", "text").mapInArrow(run, schema)
