"""The operators that use DataFrame functions only."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
import xxhash
from llm_data import ascii_lower, documents, odd_rows, prose, python_free
from pyspark.sql import functions as F

from tagpulse.llm import licenses, mixing, secret_scan, sketches
from tagpulse.llm.queries import QUERIES, table

SF = "/root/testdata/sf0.01"
PATTERNS = [re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
            re.compile("AKIA[A-Z0-9]+"), re.compile("[0-9a-f]+")]
KINDS = ["assign", "access", "hex"]


def ordered(rows):
    return sorted(rows, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r))


def base_spans(text):
    found = []
    for k, pattern in enumerate(PATTERNS):
        for m in pattern.finditer(text):
            if len(m[2] if k == 0 else m[0]) >= (6, 20, 24)[k]:
                found.append((m.start(), k, m.end()))
    return sorted(found)


def check_secrets(rows, found):
    expected = []
    for doc_id, text in rows:
        spans = base_spans(text or "")
        line = ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)
        counts = Counter(k for _, k, _ in spans)
        expected.append((doc_id, counts[0], counts[1], counts[2], hashlib.sha256(line.encode()).hexdigest()))
    got = []
    for r in found:
        spans = [s for s in r.spans.split(",") if s]
        base = ",".join(s for s in spans if not s.startswith("random"))
        assert hashlib.sha256(base.encode()).hexdigest() == r.base_sha256
        at = [(int(s.split(":")[1]), ["assign", "access", "hex", "random"].index(s.split(":")[0])) for s in spans]
        assert at == sorted(at)
        got.append((r.doc_id, r.n_assign, r.n_access, r.n_hex, r.base_sha256))
    assert ordered(got) == ordered(expected)


def test_secrets(spark):
    docs = documents(spark)
    df = secret_scan.scan(docs)
    assert python_free(df)
    check_secrets([r[:2] for r in odd_rows()], df.collect())
    check_secrets([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()], QUERIES["op6_secret_scan"](spark, SF).collect())
    assert secret_scan.scan(documents(spark, [])).collect() == []


def test_random_tokens_are_found_and_structured_ones_not(spark):
    r = random.Random(3)
    alphabet = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    random_ones = ["".join(r.choice(alphabet) for _ in range(40)) for _ in range(60)] + ["".join(r.choice("0123456789abcdef") for _ in range(64)) for _ in range(60)]
    structured = ["Ab1" * 14, "aaaaaaaaaaBBBBBBBBBB1111111111ccccccccc", "0123456789abcdef" * 4, "aB1aB2aB3aB4aB5aB6aB7aB8aB9aB1aB2aB3aB4"] * 10
    tokens = random_ones + structured + ["pneumonoultramicroscopicsilicovolcanoconiosis"]
    docs = spark.createDataFrame([(k, f"some words {t} and more") for k, t in enumerate(tokens)], "doc_id long, text string")
    flagged = {x.doc_id for x in secret_scan.scan(docs).collect() if "random:11:" in x.spans}
    assert len(flagged & set(range(120))) >= 110
    assert not flagged & set(range(120, len(tokens)))


def test_step_up_rule(spark):
    found = spark.createDataFrame([(3, ("hex", 5), b) for b in [80] * 3 + [0] * 97] + [(3, ("hex", 6), 0)], "kind int, band struct<encoding:string,doublings:int>, bin int")
    assert {r.band.doublings: r["cut"] for r in secret_scan.structured(found, 0.05).collect()} == {5: 80}


def test_redaction(spark):
    docs = documents(spark)
    clean = secret_scan.redact(docs)
    assert clean.columns == docs.columns
    before = {(r.doc_id, r.text, r.n_chars) for r in docs.collect()}
    rows = clean.collect()
    assert len(rows) == docs.count()
    assert not any(base_spans(r.text) for r in rows if r.text)
    for r in rows:
        if r.text is None or "[SECRET]" not in r.text:
            assert (r.doc_id, r.text, r.n_chars) in before
        else:
            assert r.n_chars == len(r.text)
    assert sum("[SECRET]" in (r.text or "") for r in rows) == 1


def words_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))


def check_licenses(rows, found):
    phrases = [(label, p.split()) for label, p in licenses.PHRASES]
    expected = []
    for doc_id, text in rows:
        w = words_of(text)
        places = [(k, label) for label, p in phrases for k in range(len(w)) if w[k:k + len(p)] == p]
        at = [k for k, _ in places]
        expected.append((doc_id, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))))
    got = []
    for r in found:
        assert set(filter(None, r.base_labels.split(","))) <= set(filter(None, r.labels.split(","))) and 0 <= r.score <= 1
        assert r.score == 1 or not r.n_base
        got.append((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
    assert ordered(got) == ordered(expected)


def test_licenses(spark):
    df = licenses.scan(documents(spark))
    assert python_free(df)
    check_licenses([r[:2] for r in odd_rows()], df.collect())
    check_licenses([(r.doc_id, r.text) for r in table(spark, SF, "documents").collect()], QUERIES["op9_license_scan"](spark, SF).collect())
    assert licenses.scan(documents(spark, [])).collect() == []


def test_changed_notices_are_found_on_neighbouring_diagonals(spark):
    notice = dict(licenses.NOTICES)["bsd"].split()
    changed = notice[:7] + ["also"] + notice[7:12] + notice[13:]
    rows = [(1, prose(50, 1) + " " + " ".join(changed).upper() + " " + prose(50, 2)), (2, " ".join(notice[:6]) + " " + prose(200, 3) + " ".join(notice[6:9])),
            (3, "The mit licence, apache, cc by")]
    found = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert found[1].labels == "bsd" and 0.5 < found[1].score < 1 and found[1].base_labels == ""
    assert [(s.label, s.start, s.end) for s in found[1].spans] == [("bsd", 50, 50 + len(changed))]
    assert found[2].labels == found[3].labels == ""


def sketch_of(text, words=5):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", (text or "").lower()) if x]
    runs = [w[i:i + words] for i in range(len(w) - words + 1)] or ([[" ".join(w)]] if w else [])
    hashes = set()
    for run in runs:
        h = 42
        for x in run:
            h = xxhash.xxh64_intdigest(x.encode(), h)
        hashes.add(h)
    signed = {h - 2**64 if h >> 63 else h for h in hashes}
    kept = [h for h in signed if 0 <= h < 2**62] or ([min(signed)] if signed else [])
    return {(h % 2**62) >> 30 for h in kept}


def near(a, b):
    return 1.0 if a == b else 0.0 if not a or not b else len(a & b) / min(len(a), len(b))


def brute_notices(text, coverage=0.5, slack=3):
    """Labels, spans and the best coverage of the notices by listing all diagonals of a text."""
    found = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    spans, best = [], 0.0
    for label, notice in licenses.NOTICES:
        words = notice.split()
        places = len(words) - 2
        diagonals = {}
        for p in range(places):
            for at in range(len(found) - 2):
                if found[at:at + 3] == words[p:p + 3]:
                    diagonals.setdefault(at - p, []).append((p, at))
        groups, last = [], None
        for d in sorted(diagonals):
            seen = {p for p, _ in diagonals[d]}
            if last is None or d - last > slack or seen & {p for p, _ in diagonals[last]}:
                groups.append([])
            groups[-1] += diagonals[d]
            last = d
        for group in groups:
            start, end = min(at for _, at in group), max(at for _, at in group) + 3
            covered = len({p for p, _ in group}) / places
            if end - start <= 2 * (places + 3):
                best = max(best, min(covered, 1.0))
                if covered >= coverage:
                    spans.append((label, start, end))
    return sorted(spans), best


def test_notices_by_brute_force(spark):
    r = random.Random(8)
    rows = [(k, "all rights reserved " * n + "word") for k, n in enumerate((1, 2, 3, 4, 10, 50))]
    for k, (_, notice) in enumerate(licenses.NOTICES):
        words = notice.split()
        for trial in range(4):
            changed = [w for w in words if r.random() > 0.04 * trial]
            for _ in range(trial):
                changed.insert(r.randrange(len(changed) + 1), r.choice(words))
            rows.append((100 + 10 * k + trial, prose(20, trial) + " " + " ".join(changed * (1 + trial % 2)) + " " + prose(20, k)))
    rows += [(1000 + x.doc_id, x.text) for x in table(spark, SF, "documents").where("doc_id % 5 = 0").collect()]
    found = {x.doc_id: x for x in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for i, text in rows:
        spans, best = brute_notices(text)
        mine = [(s.label, s.start, s.end) for s in found[i].spans]
        base = set(filter(None, found[i].base_labels.split(",")))
        assert [s for s in mine if s in spans] == spans
        assert set(found[i].labels.split(",")) - {""} == base | {s[0] for s in spans}, i
        assert abs(found[i].score - (1.0 if base else best)) < 1e-12
    assert [len(found[k].spans) for k in range(6)] == [1, 2, 3, 4, 10, 50]


def test_fingerprints(spark):
    rows = [r[:2] for r in odd_rows() if r[0] not in (4, 8) and r[1] is not None or r[0] in (2,)]
    rows = {i: (i, t) for i, t in rows if i != 11}  # lower() of other alphabets is Spark's
    docs = documents(spark, [(i, t, None, None, None) for i, t in rows.values()])
    df = sketches.compare_edited(docs)
    assert python_free(df)
    line = sorted(rows.values(), key=lambda r: -(2**63) if r[0] is None else r[0])
    found = {r.doc_id: r for r in df.collect()}
    assert len(found) == len(line)
    for k, (i, text) in enumerate(line):
        text, after, r = text or "", line[(k + 1) % len(line)][1] or "", found[i]
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + after[:quarter]
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(edited.encode()).hexdigest())
        a, b, c = map(sketch_of, (text, edited, after))
        assert {h % 2**32 for h in r.sketch} == a and {h % 2**32 for h in r.edited_sketch} == b
        assert (r.near_edited, r.near_next) == pytest.approx((near(a, b), near(a, c)))
        assert len(r.fingerprint) == 8 * len(a)


def test_fingerprints_of_odd_documents(spark):
    rows = sketches.compare_edited(documents(spark)).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_chars) for r in rows) == sorted((i is None, i or 0, len(t or "")) for i, t, *_ in odd_rows())
    assert len({r.fingerprint for r in rows if r.doc_id in (5, 6)}) == 1
    assert sketches.compare_edited(documents(spark, [])).collect() == []
    alone = sketches.compare_edited(documents(spark, [(1, prose(40, 1), None, None, None)])).collect()
    assert len(alone) == 1 and alone[0].near_next == 1.0


def test_fingerprints_query(spark):
    line = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    found = {r.doc_id: r for r in QUERIES["op8_document_fingerprints"](spark, SF).collect()}
    for k, (i, text) in enumerate(line):
        quarter = len(text) // 4
        edited = text[:len(text) - quarter] + line[(k + 1) % len(line)][1][:quarter]
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
    assert sum(r.near_edited > r.near_next for r in found.values()) >= 0.97 * len(found)


def skewed(spark):
    r = random.Random(8)
    rows = []
    for k in range(900):
        source = "big" if k < 500 else None if k % 9 == 0 else f"small{k % 5}"
        rows.append((k, prose(r.randint(0, 60), k), "en", source, 0))
    return rows + rows[-3:]


def test_schedule_meets_quotas(spark):
    rows = skewed(spark)
    tokens = [len(re.findall(r"[^\x20\x09-\x0D]+", t)) + 1 for _, t, *_ in rows]
    sizes = defaultdict(int)
    for row, n in zip(rows, tokens):
        sizes[row[3]] += n
    share = {s: n / sum(tokens) for s, n in sizes.items()}
    alpha = 1 - math.log(2) / math.log(max(share.values()) / min(share.values()))
    weight = {s: p**alpha for s, p in share.items()}
    weight = {s: w / sum(weight.values()) for s, w in weight.items()}
    budget = max(sizes[s] / weight[s] for s in sizes)
    df = mixing.schedule(documents(spark, rows), mixing.Mixture(repeats=2.0, block_tokens=2000))
    assert python_free(df)
    found = df.collect()
    read = defaultdict(int)
    for r in found:
        read[r.source] += r.tokens
    for s in sizes:
        assert weight[s] * budget - 1e-3 <= read[s] <= weight[s] * budget + max(tokens) + 1e-3
    times = Counter((r.doc_id, r.copy) for r in found)
    assert set(times.values()) <= {1, 2} and len(times) == len(rows)
    assert all((r.epoch == 0) or times[r.doc_id, r.copy] == 2 for r in found)
    blocks = defaultdict(list)
    for r in found:
        blocks[r.block].append(r)
    assert len(blocks) == math.ceil(budget / 2000)
    for own in blocks.values():
        assert sorted(r.place for r in own) == list(range(len(own)))
        big = sum(r.tokens for r in own if r.source == "big") / sum(r.tokens for r in own)
        assert abs(big - weight["big"]) < 0.12
    again = mixing.schedule(documents(spark, rows).repartition(5), mixing.Mixture(repeats=2.0, block_tokens=2000)).collect()
    assert ordered(map(tuple, again)) == ordered(map(tuple, found))


def test_entropy_and_budget(spark):
    sizes = spark.createDataFrame([("a", 8000), ("b", 1000), ("c", 500), ("d", 500)], "source string, tokens long")
    rows = mixing.weights(sizes, mixing.Mixture(repeats=None, entropy=0.9)).collect()
    assert -sum(r.weight * math.log(r.weight) for r in rows) / math.log(4) == pytest.approx(0.9, abs=1e-6)
    rows = mixing.weights(sizes, mixing.Mixture(repeats=1.5, budget=5000)).collect()
    assert sum(r.quota for r in rows) == pytest.approx(5000)
    assert max(r.quota / r.tokens for r in rows) == pytest.approx(1.5, abs=1e-6)
    assert {r.weight for r in mixing.weights(sizes, mixing.Mixture(repeats=None)).collect()} == {0.25}


def test_running_before(spark):
    r = random.Random(2)
    rows = [(k % 2, r.getrandbits(64) - 2**63 if k % 3 else 7, k, r.randint(1, 9)) for k in range(500)]
    df = spark.createDataFrame(rows, "s int, draw long, row long, n long")
    found = {x.row: x.before for x in mixing.running_before(df, ["s"], "draw", "n").collect()}
    for s in (0, 1):
        total = 0
        for _, _, row, n in sorted((x for x in rows if x[0] == s), key=lambda x: (x[1] % 2**64 >> 44, x[1], x[2])):
            assert found[row] == total
            total += n


def test_mixed_rows_are_those_of_the_schedule(spark):
    docs = documents(spark)
    aim = mixing.Mixture(repeats=2.0)
    mixed = mixing.mix(docs, aim)
    assert mixed.columns == docs.columns
    planned = mixing.schedule(docs, aim).groupBy("doc_id", "text_key").count()
    got = mixed.groupBy("doc_id", F.xxhash64("text").alias("text_key")).count()
    assert ordered(map(tuple, planned.collect())) == ordered(map(tuple, got.collect()))
    assert mixing.mix(documents(spark, [])).collect() == []
    assert mixing.schedule(documents(spark, [])).collect() == []


def test_nothing_to_read(spark):
    rows = [(k, prose(10, k), "en", f"s{k % 2}", 1) for k in range(20)]
    aim = mixing.Mixture(repeats=None, budget=0)
    assert mixing.schedule(documents(spark, rows), aim).collect() == [] == mixing.mix(documents(spark, rows), aim).collect()


def battery(token, symbols):
    """The three tests and Fisher's method in plain Python."""
    n, k = len(token), len(symbols)
    tail = lambda z: math.erfc(z / math.sqrt(2)) / 2
    chi = sum((token.count(c) - n / k) ** 2 / (n / k) for c in symbols)
    spread = 2 / (9 * (k - 1))
    p1 = tail(((chi / (k - 1)) ** (1 / 3) - (1 - spread)) / math.sqrt(spread))
    high = [symbols.index(c) >= k // 2 for c in token]
    mixed = 2 * sum(high) * (n - sum(high))
    runs = 1 + sum(a != b for a, b in zip(high, high[1:]))
    deviation = math.sqrt(max(mixed * (mixed - n) / (n * n * (n - 1)), 0))
    p2 = 2 * tail(abs(runs - mixed / n - 1) / deviation) if deviation else 0
    x = [symbols.index(c) for c in token]
    mean = sum(x) / n
    square = sum((v - mean) ** 2 for v in x)
    r = sum((a - mean) * (b - mean) for a, b in zip(x, x[1:] + x[:1])) / square if square else None
    p3 = 2 * tail(abs(r + 1 / (n - 1)) * math.sqrt(n)) if square else 0
    half = -sum(math.log(max(p, 1e-15)) for p in (p1, p2, p3))
    return math.exp(-half) * (1 + half + half * half / 2)


def test_battery_against_plain_python(spark):
    r = random.Random(11)
    rows = []
    for name, _, _, symbols in secret_scan.ENCODINGS:
        rows += [("".join(r.choice(symbols) for _ in range(n)), symbols) for n in (24, 33, 64, 300)]
        rows += [("".join(r.choice(symbols[:5]) for _ in range(40)), symbols), (symbols, symbols), (symbols[0] * 30, symbols)]
    found = secret_scan.randomness(spark.createDataFrame(rows, "match string, symbols string")).collect()
    assert len(found) == len(rows)
    for x in found:
        assert math.isclose(x.p, battery(x.match, x.symbols), rel_tol=1e-3, abs_tol=1e-6), x.match


def test_keys_of_one_case_are_found_and_joined_words_are_not(spark):
    r = random.Random(12)
    lower, letters = "abcdefghijklmnopqrstuvwxyz0123456789", "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ"
    keys = ["".join(r.choice(a) for _ in range(n)) for a, n in ((lower, 32), (lower.upper(), 40), (letters, 32)) for _ in range(100)]
    words = ["rechtsschutzversicherungsgesellschaften", "internationalizations1234", "getTheNumberOfOpenSessionsOfUser", "section2introduction",
             "COUNTERREVOLUTIONARIES2024", "abcdefghijklmnopqrstuvwxyz0123456789", "ABABABABABABABABABABABABAB1A2"]
    docs = spark.createDataFrame([(k, f"the key {t} is here") for k, t in enumerate(keys + words)], "doc_id long, text string")
    found = {x.doc_id: x.spans for x in secret_scan.scan(docs).collect()}
    assert sum(found[k] == f"random:8:{8 + len(t)}" for k, t in enumerate(keys)) >= 0.9 * len(keys)
    assert [found[len(keys) + k] for k in range(len(words))] == [""] * len(words)
    clean = {x.doc_id: x.text for x in secret_scan.redact(docs).collect()}
    assert all((clean[k] == "the key [SECRET] is here") == (found[k] != "") for k in found)
