import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from llm_data import documents, prose
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tagpulse.llm import alignment
from tagpulse.llm.queries import PIECES, QUERIES, TOKENIZER, table

COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.fixture(scope="module")
def brute():
    """Rows by cutting at common ends and listing all links."""
    a = Tokenizer.from_file(TOKENIZER)
    a.encode_special_tokens = True
    b = SentencePieceProcessor(model_file=PIECES)
    letters = {chr(k): k for k in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    letters |= {chr(256 + k): n for k, n in enumerate(n for n in range(256) if n not in set(letters.values()))}

    def bytes_a(n):
        return bytes(letters[c] for c in a.id_to_token(n))

    def bytes_b(n):
        return bytes([int(b.id_to_piece(n)[3:5], 16)]) if b.is_byte(n) else b.id_to_piece(n).replace("▁", " ").encode()

    def groups_of(text):
        line = (" " + text).encode()
        sides = [(n, bytes_a(n)) for n in a.encode(" " + text, add_special_tokens=False).ids], [(n, bytes_b(n)) for n in b.encode(text)]
        if not text or any(b"".join(x for _, x in side) != line for side in sides):
            return []
        ends = [np.cumsum([len(x) for _, x in side]).tolist() for side in sides]
        groups, at = [], [0, 0]
        for cut in sorted(set(ends[0]) & set(ends[1])):
            upto = [e.index(cut) + 1 for e in ends]
            groups.append(tuple([n for n, _ in side[k:u]] for side, k, u in zip(sides, at, upto)))
            at = upto
        return groups

    def rows(docs):
        aligned = [(i, groups_of(t or "")) for i, t in docs]
        links = [[(x, y) for g, h in groups for x in g for y in h] for _, groups in aligned]
        counts = Counter(p for of in links for p in set(of))
        most = {}
        for (x, _), n in counts.items():
            most[x] = max(most.get(x, 0), n)
        out = []
        for (i, groups), of in zip(aligned, links):
            line = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
            out.append((i, sum(len(g) for g, _ in groups), sum(len(h) for _, h in groups), len(groups), len(of),
                        sum(counts[p] == most[p[0]] for p in of), sum(counts[p] for p in of),
                        hashlib.sha256(line.encode()).hexdigest() if groups else ""))
        return sorted(out, key=str)

    return rows


def found_rows(df):
    return sorted((tuple(r) for r in df.select(*COLUMNS).collect()), key=str)


@pytest.mark.parametrize("block", [200, 1 << 21])
def test_odd_documents(spark, brute, block):
    extra = [(20, "▁ a real mark"), (21, "<|endoftext|>"), (22, "é" * 40 + "漢字" * 30 + "😀👍🏽"), (23, "   spaces   \n\n\t x"), (24, "a\x00b"), (25, "aaaa" * 300)]
    rows = [(r.doc_id, r.text) for r in documents(spark, clashing=False).collect()] + extra
    docs = documents(spark, [(i, t, "en", "s", 1) for i, t in rows]).repartition(3)
    found = alignment.align(docs, TOKENIZER, PIECES, block_bytes=block, keep_groups=True)
    assert found_rows(found) == brute(rows)
    for r in found.collect():
        assert r.groups_sha256 == (hashlib.sha256(r.groups.encode()).hexdigest() if r.groups else "")
        assert r.groups.count(";") + bool(r.groups) == r.n_groups


def test_no_documents(spark):
    assert alignment.align(documents(spark, []), TOKENIZER, PIECES).collect() == []
    rows = [(1, None), (2, "")]
    found = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, PIECES)
    assert found_rows(found) == [(i, 0, 0, 0, 0, 0, 0, "") for i in (1, 2)]


def test_groups_of_intervals():
    r = random.Random(1)
    for _ in range(200):
        total = r.randint(1, 60)
        ends = [np.array(sorted({total, *r.sample(range(1, total + 1), r.randint(0, total))})) for _ in range(2)]
        a, b = alignment.coalesce(np.append(0, ends[0][:-1]), ends[0], np.append(0, ends[1][:-1]), ends[1])
        cuts = sorted(set(ends[0].tolist()) & set(ends[1].tolist()))
        assert [a.tolist(), b.tolist()] == [np.searchsorted(cuts, e).tolist() for e in ends]


@pytest.mark.parametrize("held", [3, 50, 1 << 20])
def test_groups_of_any_size_lose_no_link(monkeypatch, held):
    monkeypatch.setattr(alignment, "LINKS", held)
    r = random.Random(2)
    sizes = np.array([(r.choice((1, 1, 2, 30)), r.choice((1, 1, 3, 25))) for _ in range(60)])
    a, b = (np.array([r.randrange(7) for _ in range(s)]) for s in sizes.sum(0))
    owners = np.sort(np.array([r.randrange(5) for _ in range(60)]))
    expected, at = Counter(), [0, 0]
    for (x, y), owner in zip(sizes, owners):
        expected.update((owner * 10 + i) * 10 + j for i in a[at[0]:at[0] + x] for j in b[at[1]:at[1] + y])
        at = [at[0] + x, at[1] + y]
    codes, times = alignment.expand(a, b, sizes[:, 0], sizes[:, 1], owners, 10, 10)
    assert dict(zip(codes.tolist(), times.tolist())) == expected and codes.tolist() == sorted(codes.tolist())


def test_counts_above_a_byte(spark, brute):
    rows = [(k, "the the " * (400 if k == 3 else 1) + prose(5, k)) for k in range(12)]
    found = alignment.align(spark.createDataFrame(rows, "doc_id long, text string"), TOKENIZER, PIECES, block_bytes=100)
    assert found_rows(found) == brute(rows)


def test_query_against_brute_force(spark, brute):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    assert found_rows(QUERIES["op11_tokenizer_alignment"](spark, sf)) == brute(rows)
