import hashlib
import random

import numpy as np
import pytest
from llm_data import documents, prose
from sentencepiece import SentencePieceProcessor

from tagpulse.llm import pieces
from tagpulse.llm.queries import PIECES, QUERIES, table

POOLS = ["abc  ▁", "the  an ", "中文字日本語の", "\u0000\n\t   ", "😀👍🏽 ‍", "<0x41></s><s>▁", "﻿�￾\U0010ffff a", "0123456789 .,_²½", "ééñß ",
         "".join(chr(random.Random(4).randrange(32, 0x2fff)) for _ in range(200))]


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=PIECES)


def odd_texts(count, seed, sizes=(1, 2, 3, 5, 10, 40, 200)):
    r = random.Random(seed)
    out = []
    for _ in range(count):
        pool = "".join(r.sample(POOLS, r.randint(1, 3)))
        out.append("".join(r.choice(pool) for _ in range(r.choice(sizes))))
    return out


def test_odd_texts_as_the_library_has_them(library):
    texts = ["", " ", "  ", "▁", "a ", *odd_texts(8000, 1), "ab " * 5000, "x" * 20_000, "中文" * 3000]
    tokens = pieces.PieceTokens(PIECES)
    for text, ids, expected in zip(texts, tokens.encode(texts), library.encode(texts)):
        assert np.frombuffer(ids, "<i4").tolist() == expected, text[:60]
        assert tokens.decode(ids) == library.decode(expected), text[:60]


def test_small_memory_gives_the_same(library):
    texts = odd_texts(300, 2)
    tokens = pieces.PieceTokens(PIECES, cached_chunks=5)
    found = [ids for k in range(0, 300, 7) for ids in tokens.encode(texts[k:k + 7])]
    assert [np.frombuffer(i, "<i4").tolist() for i in found] == library.encode(texts)


def test_any_ids_decode_as_the_library_does(library):
    r = random.Random(3)
    tokens = pieces.PieceTokens(PIECES)
    for _ in range(5000):
        ids = [r.choice((r.randrange(260), r.randrange(32_000), r.randrange(8), 28705, 259)) for _ in range(r.randrange(9))]
        assert tokens.decode(np.array(ids, "<i4").tobytes()) == library.decode(ids), ids


def test_one_agenda_and_many_agree():
    tokens = pieces.PieceTokens(PIECES)
    chunks = sorted({c for t in odd_texts(1500, 5, (3, 10, 40)) for c in pieces._CHUNKS.findall("▁" + t.replace(" ", "▁"))})
    symbols, counts = tokens._merges.run(chunks)
    assert tokens._written(symbols, counts) == [tokens._long(c) for c in chunks]


def test_agenda_takes_the_highest_score_and_then_the_leftmost():
    scores = {"ab": 1.0, "bc": 2.0, "aa": 1.0, "bcd": -3.0}
    assert pieces.agenda(list("abc"), scores) == ["a", "bc"]
    assert pieces.agenda(list("abcd"), scores) == ["a", "bcd"]
    assert pieces.agenda(list("aaa"), scores) == ["aa", "a"]
    assert pieces.agenda([], scores) == []


def test_a_difference_from_the_library_is_found():
    tokens = pieces.PieceTokens(PIECES)
    a, b = tokens.encode(["house", "mouse"])
    for chunk in ("▁house", ".\n", "   ", "word"):
        with pytest.raises(ValueError, match="encodes otherwise"):
            tokens._check({chunk: a[:4] if chunk != "▁house" else b})


def test_odd_documents_and_back(spark, library):
    docs = documents(spark)
    expected = sorted((str(r.doc_id), library.encode(r.text or ""), library.decode(library.encode(r.text or ""))) for r in docs.collect())
    found = pieces.encode(docs, PIECES, decoded=True)
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in found.collect()) == expected
    back = pieces.decode(found.select("doc_id", "ids"), PIECES)
    assert sorted((str(r.doc_id), r.decoded) for r in back.collect()) == sorted((i, t) for i, _, t in expected)
    assert pieces.encode(documents(spark, []), PIECES).collect() == []


def test_ids_that_are_null_or_none(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [None, 264]), (4, [1, 2])], "doc_id long, ids array<int>")
    assert {r.doc_id: r.decoded for r in pieces.decode(rows, PIECES).collect()} == {1: "", 2: "", 3: "a", 4: ""}


def test_one_very_long_text_in_small_slices(spark, library, monkeypatch):
    monkeypatch.setattr(pieces, "BATCH_CHARS", 1000)
    text = prose(60_000, 8) + "y" * 30_000
    assert pieces.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), PIECES).first().ids == library.encode(text)


def test_query_against_the_library(spark, library):
    sf = "/root/testdata/sf0.01"
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    expected = []
    for r in table(spark, sf, "documents").select("doc_id", "text").collect():
        ids = library.encode(r.text or "")
        expected.append((r.doc_id, len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids))))
    found = QUERIES["op13_sentencepiece"](spark, sf).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()
    assert sorted(map(tuple, found)) == sorted(expected)
