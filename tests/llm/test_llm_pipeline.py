import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_data import documents, prose
from test_llm_native import base_spans
from test_llm_packing import check

import corpus_pipeline
from tagpulse.llm import mixing, packing, secret_scan, simhash, toxicity
from tagpulse.llm.queries import QUERIES, TOKENIZER, table

SF = "/root/testdata/sf0.01"


def shingles(text):
    words = (text or "").lower().split()
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))}


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """What every stage returned, written and read again."""
    out, docs = [table(spark, SF, "documents")], table(spark, SF, "documents")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        folder = str(tmp_path_factory.mktemp("stages") / str(k))
        stage(spark, docs, SF).write.parquet(folder)
        docs = spark.read.parquet(folder)
        out.append(docs)
    return out


def test_columns(stages):
    assert all(s.columns == stages[0].columns for s in stages[1:-1])
    assert [n for n, _ in corpus_pipeline.STAGES] == ["toxicity", "near_duplicates", "secrets", "mixing", "packing"]


def test_toxic_documents_go(spark, stages):
    docs = stages[0]
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, SF, "labels"))).collect()
    assert sorted(r.doc_id for r in scored if not r.predicted) == sorted(r.doc_id for r in stages[1].collect())
    assert stages[1].count() > 0.85 * docs.count()


def test_one_of_each_group_stays(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id: r.text for r in stages[2].collect()}
    assert len(after) == stages[2].count()
    sets = {i: shingles(t) for i, t in before.items()}
    near, alike = defaultdict(set), 0.0
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    for own in holders.values():
        for a in own:
            near[a].update(own)
    pairs = left = 0
    for a in before:
        for b in near[a]:
            if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b]):
                pairs += 1
                left += a in after and b in after
    assert pairs > 20 and left <= 0.05 * pairs
    for a in before.keys() - after.keys():  # nothing unlike all others has gone
        alike = max((len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in near[a] if b != a), default=0.0)
        assert alike > 0.4


def test_secrets_are_replaced(stages):
    before, after = {r.doc_id: r for r in stages[2].collect()}, {r.doc_id: r for r in stages[3].collect()}
    assert before.keys() == after.keys()
    for i, r in after.items():
        if base_spans(before[i].text):
            assert not base_spans(r.text) and "[SECRET]" in r.text and r.n_chars == len(r.text)
        elif "[SECRET]" not in r.text:
            assert r == before[i]


def test_sources_are_mixed(stages):
    docs = [r.asDict() for r in stages[3].collect()]
    read = Counter(r.doc_id for r in stages[4].collect())
    assert read.keys() == {r["doc_id"] for r in docs} and set(read.values()) <= {1, 2}
    planned = Counter(r.doc_id for r in mixing.schedule(stages[3], mixing.Mixture(repeats=2.0)).collect())
    assert read == planned


def test_all_is_packed(stages):
    rows = packing.pack(stages[4], TOKENIZER, keep_ids=True).collect()
    check(rows, [r.text for r in stages[4].collect()], 2048)
    assert sum(r.length for r in stages[5].collect()) == sum(r.length for r in rows)


def test_run_is_the_query(spark, stages):
    ran = corpus_pipeline.run(spark, SF)
    assert ran.columns == stages[5].columns
    assert Counter((r.doc_id, r.start, r.length, r.ids_crc32) for r in ran.collect()).keys() >= {(r.doc_id, 0, r.doc_tokens, r.ids_crc32) for r in stages[5].collect() if r.length == r.doc_tokens} - set()
    assert corpus_pipeline.ORACLE_SQL is None and len(QUERIES) == 10


def test_near_copies_of_long_chains(spark):
    base = prose(300, 1).split()
    rows = []
    for k in range(40):
        changed = list(base)
        changed[7 * k % 300] = f"changed{k}"
        rows.append((k, " ".join(changed), None, None, None))
    rows += [(100 + k, prose(300, 50 + k), None, None, None) for k in range(20)]
    docs = documents(spark, rows)
    kept = {r.doc_id for r in simhash.keep_one(docs, simhash.similar_documents(docs, members=8)).collect()}
    assert kept == {0} | set(range(100, 120))


def test_only_near_copies_go(stages):
    before = {r.doc_id: r.text for r in stages[1].collect()}
    after = {r.doc_id for r in stages[2].collect()}
    sets = {i: shingles(t) for i, t in before.items()}
    holders = defaultdict(set)
    for i, s in sets.items():
        for x in s:
            holders[x].add(i)
    for a in before.keys() - after:
        near = set().union(*(holders[x] for x in sets[a])) - {a}
        assert max(len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for b in near) >= 0.8


def test_copies_that_differ_by_a_block_go(spark):
    r = random.Random(3)
    text = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    rows = []
    for k in range(60):
        own, other, at = text(400), text(80 if k % 2 else 20), r.randrange(400)
        copy = [own + other, own[:330], own[:at] + other + own[at:]][k % 3]
        rows += [(2 * k, " ".join(own)), (2 * k + 1, " ".join(copy))]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    assert all(len(shingles(a) & shingles(b)) >= 0.8 * len(shingles(a) | shingles(b)) for (_, a), (_, b) in zip(rows[::2], rows[1::2]))
    found = {x.doc_id: x.component_id for x in simhash.similar_documents(docs, members=8).collect()}
    assert found == {i: i // 2 * 2 for i, _ in rows}


def test_simhash_brings_copies_that_every_band_misses(spark):
    rows, shared = [], lambda a, b, of: set(of(a)) & set(of(b))
    for k, seed in enumerate((551, 593, 6453)):
        text = " ".join([prose(100, seed + 10**6)] + [prose(30, seed)] * 8)
        rows += [(2 * k, text), (2 * k + 1, f"{text} {prose(30, seed + 2 * 10**6)}")]
    for (_, a), (_, b) in zip(rows[::2], rows[1::2]):
        assert len(shared(a, b, shingles)) >= 0.8 * len(shingles(a) | shingles(b))
        assert not shared(a, b, lambda t: simhash.band_keys(simhash.text_shingles(t.encode().split()), 24, 6).tolist())
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    assert {x.doc_id: x.component_id for x in simhash.similar_documents(docs).collect()} == {i: i // 2 * 2 for i, _ in rows}
    assert {x.doc_id for x in corpus_pipeline.without_copies(spark, docs, SF).collect()} == {0, 2, 4}


@pytest.mark.parametrize("members", [5, 4096])
def test_texts_of_near_prints_are_held_against_their_shingles(spark, members):
    rows = []
    for k in range(12):
        passage, own = prose(30, 900 + k % 3), prose(100, 950 + k % 6)  # the passage, read forty times, makes the print
        rows.append((k, " ".join([own] + [passage] * 40 + ([prose(12, 970 + k)] if k > 5 else []))))
    rows += [(k, t) for k, t in enumerate(["", None, "word", "other word", prose(40, 990)], 20)]
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows])
    prints = {x.doc_id: x.bits for x in simhash.fingerprints(docs).collect()}
    sets = {i: shingles(t) if t else set() for i, t in rows}
    near = lambda a, b: bin((prints[a] ^ prints[b]) % 2**64).count("1") <= 4
    alike = lambda a, b: not sets[a] | sets[b] or len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])
    expected = {i: min(j for j in sets if alike(i, j)) for i in sets}
    assert any(near(a, b) and not alike(a, b) for a in range(12) for b in range(a))
    assert all(near(i, e) for i, e in expected.items()) and sum(i != e for i, e in expected.items()) == 7
    found = simhash.similar_documents(docs, members=members, bands=1, rows=200)  # a band that hardly any copies share
    assert {x.doc_id: x.component_id for x in found.collect()} == expected


def test_unlike_texts_of_few_words_stay(spark):
    rows = [(k, prose(3000, 100 + k), None, None, None) for k in range(20)]
    docs = documents(spark, rows)
    assert {x.doc_id for x in simhash.keep_one(docs, simhash.similar_documents(docs)).collect()} == set(range(20))


def test_forests_of_similar_sets():
    r = np.random.default_rng(2)
    base = [r.choice(10**6, 60, replace=False) for _ in range(6)]
    sets = [np.unique(np.r_[r.choice(base[k % 6], 57, replace=False), r.choice(10**6, k % 4)]).astype(np.uint64) for k in range(90)] + [np.empty(0, np.uint64)] * 2
    alike = lambda a, b: len(a) > 0 and len(np.intersect1d(a, b)) / len(np.union1d(a, b)) >= 0.8
    pairs = [(a, b) for a in range(len(sets)) for b in range(a) if alike(sets[a], sets[b])]
    links = simhash.similar_forest(sets, 0.8)

    def roots(links):
        root = list(range(len(sets)))
        for a, b in links:
            root = [min(root[a], root[b]) if x in (root[a], root[b]) else x for x in root]
        return root

    assert roots(links) == roots(pairs) and len(links) < len(sets) < len(pairs)
    assert all(alike(sets[a], sets[b]) for a, b in links)


def test_overlapping_secrets_go_whole(spark):
    random_key = "".join(random.Random(7).choices("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", k=40))
    texts = ["😀 é MyApp2-Staging-DB-Password=hunter2xyz and on", f"{random_key}_token=abcdefgh1 x", f"a password={random_key} b password={random_key}", "nothing", None]
    docs = documents(spark, [(k, t, None, None, 1) for k, t in enumerate(texts)])
    out = {r.doc_id: (r.text, r.n_chars) for r in secret_scan.redact(docs).collect()}
    assert [out[k][0] for k in range(5)] == ["😀 é [SECRET] and on", "[SECRET] x", "a [SECRET] b [SECRET]", "nothing", None]
    assert out[0][1] == len(out[0][0]) and out[3][1] == 1


def test_odd_documents_pass_every_stage(spark):
    docs = documents(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SF)
        assert out.columns == docs.columns
        docs = spark.createDataFrame(out.collect(), out.schema)
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    assert not any(re.search("hunter22", r.text or "") for r in docs.collect())


def test_empty_table(spark):
    docs = documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).collect() == []
