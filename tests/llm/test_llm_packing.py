import zlib

import numpy as np
import pytest
from llm_data import documents
from tokenizers import Tokenizer

from tagpulse.llm.packing import assign, pack
from tagpulse.llm.queries import TOKENIZER
from tagpulse.llm.tokens import ByteTokens


def check(spark_rows, texts, capacity, end_id=1):
    """Pieces give back every document's ids, and fill sequences without gaps."""
    tokenizer = Tokenizer.from_file(TOKENIZER)
    expected = sorted((tuple(tokenizer.encode(t or "", add_special_tokens=False).ids) + (end_id,)) for t in texts)
    whole, sequences = {}, {}
    for r in spark_rows:
        assert r.length == len(r.ids) and r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    # documents are told apart by their id and length; equal ones are interchangeable
    found = []
    for r in sorted(spark_rows, key=lambda r: (r.doc_id is None, r.doc_id or 0, r.doc_tokens, r.start)):
        whole.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, r.ids))
    for (_, tokens), pieces in whole.items():
        copies = sum(1 for s, _ in pieces if s == 0)
        assert sum(len(ids) for _, ids in pieces) == tokens * copies
        if copies == 1:
            found.append(tuple(t for _, ids in sorted(pieces) for t in ids))
    assert set(found) <= set(expected)
    assert sum(len(r.ids) for r in spark_rows) == sum(map(len, expected))
    return len(sequences), sum(map(len, expected))


@pytest.mark.parametrize("capacity", [2048, 64, 7])
def test_round_trip_of_odd_documents(spark, capacity):
    docs = documents(spark)
    rows = pack(docs, TOKENIZER, capacity=capacity, keep_ids=True).collect()
    used, tokens = check(rows, [r.text for r in docs.collect()], capacity)
    assert used <= -(-tokens // capacity) + docs.rdd.getNumPartitions()


def test_small_blocks_pad_at_most_one_sequence_each(spark):
    docs = documents(spark).coalesce(1)
    rows = pack(docs, TOKENIZER, capacity=128, block_tokens=1000, keep_ids=True).collect()
    check(rows, [r.text for r in docs.collect()], 128)


def test_no_documents(spark):
    assert pack(documents(spark, []), TOKENIZER).collect() == []


def test_costs_are_balanced():
    lengths = [1500, 1400, 600, 500, 400, 300, 250, 200, 120, 50] * 20
    pieces, cost = assign(lengths, 2048, 1.0, 1 / 1024)
    assert len(cost) == -(-sum(lengths) // 2048)
    assert sum(p[2] for p in pieces) == sum(lengths)
    in_order, filled = [0.0], 0
    for n in lengths:  # first come, first served
        while n:
            taken = min(n, 2048 - filled)
            in_order[-1] += taken + taken**2 / 1024
            n, filled = n - taken, filled + taken
            if filled == 2048:
                in_order.append(0.0)
                filled = 0
    assert np.std(cost[:-1]) < np.std(in_order[:-1])


def test_ids_are_the_tokenizers():
    fast, slow = ByteTokens(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in ["a  b", "a \n b", " x", " ", "  ", "", "it's  I'll <|endoftext|> q", "  <|endoftext|>", "é ü\x1c z", "　w", "a\tb \tc", "漢字😀 12ab"]:
        assert np.frombuffer(fast.encode(text), "<u4").tolist() == slow.encode(text, add_special_tokens=False).ids
