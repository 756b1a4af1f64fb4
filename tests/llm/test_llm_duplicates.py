import hashlib
import itertools
import random
import re

import numpy as np
import pytest
import xxhash
from llm_data import documents, ascii_lower, prose
from pyspark.sql import functions as F

from tagpulse.llm import components as components_module
from tagpulse.llm import simhash, substrings
from tagpulse.llm.components import components, joined
from tagpulse.llm.queries import QUERIES, table


def simhash_of(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i:i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def component_ids(prints, ids, distance=4):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(prints)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= distance:
                parent[find(i)] = find(j)
    roots = [find(i) for i in range(len(prints))]
    return [min((ids[j] for j in range(len(ids)) if roots[j] == r and ids[j] is not None), default=None) for r in roots]


def spark_key(r):
    return tuple((x is None, x or 0) for x in r)


def test_simhash_of_odd_documents(spark):
    docs = documents(spark)
    rows = docs.select("doc_id", "text").collect()
    prints = [simhash_of(r.text) for r in rows]
    expected = sorted(zip([r.doc_id for r in rows], prints, component_ids(prints, [r.doc_id for r in rows])), key=spark_key)
    got = [(r.doc_id, r.bits % 2**64, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(got, key=spark_key) == expected


def test_simhash_query(spark):
    sf = "/root/testdata/sf0.001"
    rows = table(spark, sf, "documents").select("doc_id", "text").collect()
    prints = [simhash_of(r.text) for r in rows]
    expected = {r.doc_id: (f"{p:016x}", c) for r, p, c in zip(rows, prints, component_ids(prints, [r.doc_id for r in rows]))}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op4_simhash"](spark, sf).collect()}
    assert got == expected


@pytest.mark.parametrize("members", [4, 64, 4096])
def test_large_groups_are_cut_and_lose_no_link(spark, members):
    r = random.Random(1)
    centre = [r.getrandbits(64) for _ in range(3)]
    bits = {c ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 3))) for c in centre for _ in range(60)} | {r.getrandbits(64) for _ in range(40)}
    bits = sorted(bits)
    signed = [b - 2**64 if b >> 63 else b for b in bits]
    links = simhash.near_links(spark.createDataFrame([(0, s) for s in signed], "kind int, bits long"), 4, members).select("left", "right").collect()
    assert len(links) < len(bits) * 40  # not all pairs
    assert all(bin((a.left ^ a.right) % 2**64).count("1") <= 4 for a in links)
    expected = component_ids(bits, signed)
    roots = {x.node: x.root for x in components(spark.createDataFrame(links, "left long, right long")).collect()}
    assert [min(s for s, e in zip(signed, expected) if e == own) for own in expected] == [roots.get(s, s) for s in signed]


def test_no_documents(spark):
    none = documents(spark, [])
    assert simhash.near_duplicates(none).collect() == []
    assert simhash.similar_documents(none).collect() == []
    assert substrings.remove_repeated(none).collect() == []


def test_chains_of_links(spark):
    pairs = [(k, k + 1) for k in range(200)] + [(1000, 1001), (1001, 1000), (5, 5), (None, 3)]
    found = {r.node: r.root for r in components(spark.createDataFrame(pairs, "left long, right long")).collect()}
    assert found == {k: 0 for k in range(1, 201)} | {1001: 1000}


def words_of(text):
    return tuple(re.findall(r"[^\x20\x09-\x0D]+", ascii_lower(text or "")))


def expected_to_stay(rows):
    """(doc_id, words) that stay, by comparing all pairs of texts."""
    texts = {}
    for i, t in rows:
        if i is not None:
            texts[words_of(t)] = min(texts.get(words_of(t), 2**63), i)
        else:
            texts.setdefault(words_of(t), 2**63)
    shingles = {w: {w[k:k + 5] for k in range(max(len(w) - 4, 1))} for w in texts}
    root = {w: w for w in texts}

    def top(w):
        return w if root[w] == w else top(root[w])

    for a, b in itertools.combinations(texts, 2):
        if a and b and len(shingles[a] & shingles[b]) >= 0.8 * len(shingles[a] | shingles[b]):
            root[top(a)] = top(b)
    groups = {}
    for w, i in texts.items():
        groups.setdefault(top(w), []).append((i, w))
    return [min(members)[0] for members in groups.values() if min(members)[0] != 2**63], groups


def test_one_of_each_group_stays(spark):
    docs = documents(spark)
    kept = simhash.keep_one(docs, simhash.similar_documents(docs))
    assert kept.columns == docs.columns
    rows = kept.collect()
    ids, groups = expected_to_stay([(r.doc_id, r.text) for r in docs.collect()])
    assert sum(r.doc_id is None for r in rows) == 2  # without an id they can't be told apart
    assert sorted(r.doc_id for r in rows if r.doc_id is not None) == sorted(ids)
    found = {words_of(r.text) for r in rows if r.doc_id is not None}
    assert all(sum(w in found for _, w in members) == 1 for members in groups.values() if min(members)[0] != 2**63)


def test_texts_under_one_id_go_or_stay_by_themselves(spark):
    shared, own, last = prose(60, 30), prose(60, 31), prose(60, 32)
    rows = [(1, shared), (8, shared.upper()), (8, own), (9, own + " "), (8, last), (8, last), (2, own.replace(own.split()[0], "first", 1))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    for parts in (1, 5):
        dealt = docs.repartition(parts)
        kept = simhash.keep_one(dealt, simhash.similar_documents(dealt)).collect()
        assert sorted((r.doc_id, words_of(r.text)) for r in kept) == sorted([(1, words_of(shared)), (2, words_of(rows[6][1])), (8, words_of(last))])


def test_hashes_of_words_agree(spark):
    docs = documents(spark, clashing=False).select("doc_id", F.col("text").cast("binary").alias("text"))
    theirs = sorted(r.words for r in simhash.band_prints(docs, 5, 2, 2).collect())
    assert theirs == sorted(r.w for r in documents(spark).select(simhash.words_hash(F.col("text")).alias("w")).collect())


def expected_removal(rows, width=13):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    key = lambda i: 2**63 if i is None else i
    first = {}
    for (i, _), w in zip(rows, words):
        for k in range(len(w) - width + 1):
            window = tuple(w[k:k + width])
            first[window] = min(first.get(window, 2**64), key(i))
    out = []
    for (i, _), w in zip(rows, words):
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < key(i):
                gone[k:k + width] = [True] * width
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest(), kept))
    return sorted(out, key=spark_key_text)


def spark_key_text(r):
    return tuple((x is None, x if x is not None else "") for x in r)


def test_repeated_passages_of_odd_documents(spark):
    docs = documents(spark).repartition(3)
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = substrings.remove_repeated(docs, keep_text=True).select("doc_id", "n_words", "n_removed", "kept_sha256", "kept", "removed").collect()
    assert sorted(((*r[:5],) for r in found), key=spark_key_text) == expected_removal(rows)
    for r in found:
        assert sum(b - a for a, b in r.removed) == r.n_removed
        assert all(b < c for (_, b), (c, _) in zip(r.removed, r.removed[1:]))


def test_repeated_passages_query(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table(spark, sf, "documents").select("doc_id", "text").collect()]
    found = QUERIES["op7_substring_dedup"](spark, sf).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == [r[:4] for r in expected_removal(rows)]


def test_small_blocks_give_the_same(spark, monkeypatch):
    rows = [(k, prose(30, k % 7) + " " + prose(20, k % 11)) for k in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    monkeypatch.setattr(substrings, "BLOCK_WINDOWS", 100)
    found = substrings.remove_repeated(docs).select("doc_id", "n_words", "n_removed", "kept_sha256").collect()
    assert sorted(map(tuple, found)) == [r[:4] for r in expected_removal(rows)]


def test_negative_and_largest_ids(spark):
    text = prose(40, 9)
    rows = [(-(2**63), text), (2**63 - 2, text), (0, text), (None, text)]
    found = {r.doc_id: r.n_removed for r in substrings.remove_repeated(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found == {-(2**63): 0, 0: 40, 2**63 - 2: 40, None: 40}


def test_packed_arrays():
    arrays = [np.array([1, 2, 3], np.uint64), np.array([], np.uint64), np.array([2**40], np.uint64), np.array([300] * 3, np.uint64)]
    assert [a.tolist() for a in substrings.unpack_arrays(substrings.pack_arrays(*arrays))] == [a.tolist() for a in arrays]


def test_repeated_passages_query_against_sql(spark):
    from oracle import database, spark_rows, sql_rows, sql_types

    from tagpulse.llm.oracles import ORACLES

    sf = "/root/testdata/sf0.01"
    for name, sql in ORACLES.items():
        df = QUERIES[name](spark, sf)
        assert dict(df.dtypes) == sql_types(database(sf), sql)
        assert spark_rows(df) == sql_rows(database(sf), sql)


def test_hot_keys_are_joined_without_a_shuffle_of_their_rows(spark):
    large = spark.range(3000).select(F.when(F.col("id") < 2000, 7).when(F.col("id") < 2900, F.col("id")).alias("key"), "id").union(
        spark.createDataFrame([(8, 9999)], "key long, id long"))
    small = large.where("key is not null and key <> 8").groupBy("key").agg(F.max("id").alias("most"), F.count("*").alias("n"))
    got = joined(large, small, "key", 3000)
    assert sorted(got.columns) == ["id", "key", "most"]
    expected = [(7, i, 1999) for i in range(2000)] + [(i, i, i) for i in range(2000, 2900)]
    assert sorted(map(tuple, got.select("key", "id", "most").collect())) == expected
    assert joined(large.limit(0), small, "key", 0).collect() == joined(large, small.limit(0), "key", 0).collect() == []


def test_masks_grow_slowly_and_miss_no_pair():
    counts = [simhash.block_count(n, 4) for n in (0, 10**5, 10**6, 10**8, 10**10, 10**11)]
    assert counts == [5, 5, 5, 6, 7, 8]
    r = random.Random(7)
    for blocks in set(counts):
        masks = simhash.block_masks(blocks, 4)
        for _ in range(2000):
            flips = sum(1 << b for b in r.sample(range(64), 4))
            assert any(not flips & m for m in masks)


def test_links_of_a_group_connect_what_all_pairs_would():
    r = np.random.default_rng(3)
    single = np.uint64(1) << r.integers(0, 64, (300, 6), np.uint64)
    for flips in (0, 1, 3, 6):  # from one dense ball to none
        members = np.unique(np.bitwise_xor.reduce(single[:, :flips], 1) if flips else r.integers(0, 2**64, 300, np.uint64))
        left, right = simhash.group_links(members, 4, slab=1000)
        assert len(left) <= len(members) and (np.bitwise_count(left ^ right) <= 4).all()
        ids = [int(m) for m in members]
        root = {m: m for m in ids}

        def top(m):
            while root[m] != m:
                m = root[m]
            return m

        for a, b in zip(left.tolist(), right.tolist()):
            root[max(top(a), top(b))] = min(top(a), top(b))
        assert [top(m) for m in ids] == component_ids(ids, ids)


def chains_and_stars():
    links = [(k, k + 1) for k in range(40)] + [(100, 100 + k) for k in range(1, 30)] + [(500 + 7 * k % 31, 500 + 7 * (k + 1) % 31) for k in range(20)]
    return links + [(130, 129), (130, 130), (None, 3), (3, None), (0, 1)]


def roots(links):
    root = {n: n for pair in links if None not in pair for n in pair}

    def top(n):
        while root[n] != n:
            n = root[n]
        return n

    for a, b in links:
        if a is not None and b is not None:
            root[max(top(a), top(b))] = min(top(a), top(b))
    return {(n, top(n)) for n in root if top(n) != n}


@pytest.mark.parametrize("hot", [1 << 16, 4])  # joins that broadcast all keys, and joins that shuffle those that aren't hot
def test_components_by_either_join(spark, monkeypatch, hot):
    monkeypatch.setattr(components_module, "HOT", hot)
    links = spark.createDataFrame(chains_and_stars(), "left long, right long").repartition(3)
    assert sorted(map(tuple, components_module.components(links).collect())) == sorted(roots(chains_and_stars()))


@pytest.mark.parametrize("hot", [1 << 16, 8])
def test_either_join_gives_the_same(spark, monkeypatch, hot):
    monkeypatch.setattr(components_module, "HOT", hot)
    key = F.when(F.col("id") < 2000, 7).when(F.col("id") < 2900, F.col("id"))  # NULL from 2900 on
    large = spark.range(3000).select(key.alias("key"), "id").union(spark.createDataFrame([(8, 9999)], "key long, id long"))
    small = large.where("key is not null and key <> 8").groupBy("key").agg(F.max("id").alias("most"), F.count("*").alias("n"))
    got = joined(large, small, "key", 3001)
    assert got.columns == ["key", "id", "most"]
    assert sorted(map(tuple, got.collect())) == [(7, i, 1999) for i in range(2000)] + [(i, i, i) for i in range(2000, 2900)]


def test_rounds_over_few_links_are_few_tasks(spark, monkeypatch):
    """A task is two files and more of each shuffle, whatever it holds: links that fit in one are not shuffled for every join."""
    counted, state = [], components_module._state
    monkeypatch.setattr(components_module, "_state", lambda links: counted.append(1) or state(links))
    before = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    links = spark.createDataFrame([(k, k + 1) for k in range(40)], "left long, right long")
    sc = spark.sparkContext
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "16")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        sc.setJobGroup("rounds", "rounds")
        found = components_module.components(links)
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
        for k, v in before.items():
            spark.conf.set(k, v)
    assert {r.root for r in found.collect()} == {0}
    tracker = sc.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup("rounds") for s in tracker.getJobInfo(j).stageIds}
    tasks = sum(i.numCompletedTasks for i in map(tracker.getStageInfo, stages) if i)
    assert 0 < tasks < 9 * 16 * (len(counted) - 1) + 100, (tasks, len(counted))
