"""Toxic texts by boosted trees over dense features, calibrated."""

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType

from tagpulse.llm.boosting import fit_boosted, fit_isotonic

# Second-person words of the languages at hand, and signs that stand for letters.
SECOND_PERSON = frozenset("you your yours u ur du dich dir dein deine ihr euch tu te toi ton ta vous votre tú ti usted ustedes vosotros".split())
LETTERS_OF = str.maketrans("013457@$!", "oieastasi")
CAPITALS, MARKS = b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"!?"
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"

WORD = re.compile(r"[^\W\d_]+")
DISGUISED = re.compile(r"[^\W\d_]+(?:[0-9@$*!]+[^\W\d_]+)+")
SPACED = re.compile(r"(?<!\w)(?:[^\W\d_][ .\-]){3,}[^\W\d_](?!\w)")
STRETCHED = re.compile(r"([^\W\d_])\1\1")
PREFIXES = (4, 5, 6)  # a lexicon entry is a word, or the beginning of words, as languages inflect
NEAR = 5  # words between a lexicon word and a second person

FEATURES = ["hits", "density", "distinct", "strongest", "weighted_density", "near_second_person", "second_person", "capitals",
            "marks", "punctuation", "disguised", "disguised_hits", "spaced_hits", "stretched"]


def entries_of(word: str) -> list[str]:
    """The lexicon entries that a word can match: itself, marked by a final $, and its beginnings."""
    return [word + "$"] + [word[:k] for k in PREFIXES if len(word) >= k]


def matched(words: set[str], lexicon: dict[str, float]) -> dict[str, float]:
    """The words that match, with the weight of their strongest entry."""
    found = {}
    for w in words:
        weights = [lexicon[e] for e in entries_of(w) if e in lexicon]
        if weights:
            found[w] = max(weights)
    return found


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """FEATURES of a text; all zero for an empty one."""
    low = text.lower()
    words = WORD.findall(low)
    distinct = set(words)
    hit = matched(distinct, lexicon)
    n = max(len(words), 1)
    second = distinct & SECOND_PERSON
    places = [i for i, w in enumerate(words) if w in hit] if hit else []
    persons = [i for i, w in enumerate(words) if w in second] if second else []
    near = 0
    if places and persons:
        at = np.searchsorted(persons, places)
        left = np.abs(np.array(places) - np.array(persons)[np.maximum(at - 1, 0)])
        right = np.abs(np.array(places) - np.array(persons)[np.minimum(at, len(persons) - 1)])
        near = int((np.minimum(left, right) <= NEAR).sum())
    disguised = DISGUISED.findall(low)
    plain = {WORD.sub(lambda m: m[0], d.translate(LETTERS_OF)).replace("*", "") for d in disguised}
    spaced = {re.sub(r"[ .\-]", "", s) for s in SPACED.findall(low)}
    octets = text.encode("utf-8", "replace")
    size = max(len(octets), 1)
    share = lambda signs: (len(octets) - len(octets.translate(None, signs))) / size
    return [len(places), len(places) / n, len(hit), max(hit.values(), default=0.0), sum(hit[words[i]] for i in places) / n,
            near / n, len(persons) / n, share(CAPITALS), share(MARKS), share(PUNCTUATION), len(disguised) / n,
            len(matched(plain, lexicon)), len(matched(spaced, lexicon)), len(STRETCHED.findall(low)) / n]


def fold(doc_id: Column) -> Column:
    """A document's fold of four: crc32 of its id as text."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 4


def _count_entries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents per lexicon entry, half and class, summed over what the task reads."""
    counts = [Counter() for _ in range(4)]
    for batch in batches:
        for text, toxic, half in zip(*(c.to_pylist() for c in batch.columns)):
            counts[2 * half + toxic].update({e for w in set(WORD.findall(text.lower())) for e in entries_of(w)})
    entries = sorted(set().union(*counts))
    columns = [pa.array(entries, pa.string()), *[pa.array([c[e] for e in entries], pa.int64()) for c in counts]]
    yield pa.RecordBatch.from_arrays(columns, names=["entry", "clean0", "toxic0", "clean1", "toxic1"])


def lexicons(sample: DataFrame, size: int, support: int = 4, certainty: float = 2.0) -> list[dict[str, float]]:
    """Entries that mark toxic documents: learned from half 1, half 0 and both, each with up to `size` entries.

    An entry needs `support` toxic documents and a share of toxic ones whose lower bound is over a half; it weighs
    as much as that bound, and the entries in most toxic documents come first.
    """
    counts = (
        sample.select("text", "toxic", "half").mapInArrow(_count_entries, "entry string, clean0 long, toxic0 long, clean1 long, toxic1 long")
        .groupBy("entry").agg(*[F.sum(c).alias(c) for c in ("clean0", "toxic0", "clean1", "toxic1")]))
    counts = counts.where(F.col("toxic0") + F.col("toxic1") >= support).persist()
    try:
        learned = []
        for halves in ((1,), (0,), (0, 1)):
            hits = sum((F.col(f"toxic{h}") for h in halves), F.lit(0))
            n = sum((F.col(f"clean{h}") for h in halves), hits)
            p, z = hits / n, certainty
            low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
            best = counts.where(hits >= support).withColumn("low", low).where("low > 0.5").orderBy(hits.desc(), "entry").limit(size)
            learned.append({r.entry: r.low for r in best.select("entry", "low").collect()})  # `size` rows at most
        return learned
    finally:
        counts.unpersist()


class Scorer:
    """Chances of toxicity of texts; without labels, the share of toxic ones that training saw."""

    def __init__(self, lexicon, model, knots):
        self.lexicon, self.model, self.knots = lexicon, model, knots

    def __call__(self, texts: list[str]) -> np.ndarray:
        x = np.array([features(t, self.lexicon) for t in texts]).reshape(-1, len(FEATURES))
        return np.clip(np.interp(self.model(x), *self.knots), 0.0, 1.0)


def train(docs: DataFrame, labels: DataFrame, rows: int = 20_000, lexicon_size: int = 512) -> Scorer:
    """Learns from labelled documents outside fold 2: at most `rows` of them, chosen by a hash of the id.

    The lexicon that a row's features are taken with is learned from the other half of the rows, and the calibration from
    predictions of a model that was fitted to the other half; so neither is too sure of what it has seen.
    A NULL label or id, or a label other than 0 and 1, says nothing; of several labels of one document the largest counts.
    """
    known = (
        labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
        .where("toxic in (0, 1)").where(fold(F.col("doc_id")) != 2)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows))
    sample = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
        .join(F.broadcast(known), "doc_id")  # `rows` rows of two numbers
        .withColumn("half", F.pmod(F.hash("doc_id"), F.lit(2))).persist())
    try:
        learned = lexicons(sample, lexicon_size)

        def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                doc_id, text, toxic, half = (c.to_pylist() for c in batch.columns)
                x = [features(t, learned[h]) for t, h in zip(text, half)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(doc_id, pa.int64()), pa.array(x, pa.list_(pa.float64())), pa.array(toxic, pa.int32()), pa.array(half, pa.int32())],
                    names=["doc_id", "x", "toxic", "half"])

        found = sample.select("doc_id", "text", "toxic", "half").mapInArrow(vectors, "doc_id long, x array<double>, toxic int, half int")
        fitted = found.toArrow()  # bounded by `rows`
    finally:
        sample.unpersist()
    order = np.argsort(fitted.column("doc_id").to_numpy(), kind="stable")
    x = fitted.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))[order]
    y, half = fitted.column("toxic").to_numpy()[order].astype(float), fitted.column("half").to_numpy()[order]
    apart = np.zeros(len(y))
    for h in (0, 1):
        apart[half == h] = fit_boosted(x[half != h], y[half != h])(x[half == h])
    return Scorer(learned[2], fit_boosted(x, y), fit_isotonic(apart, y))


def score(docs: DataFrame, scorer: Scorer, threshold: float = 0.3, names: tuple[str, str] = ("score", "predicted")) -> DataFrame:
    """`docs` (`text` and others) with two columns more, by default score and predicted (1 from `threshold` on), of whole texts.

    The score is a function of the text alone; a NULL text is an empty one. All rows and other columns are kept, and columns
    of these names replaced; an empty table gives no rows.
    """
    docs = docs.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t or "" for t in batch.column("text").to_pylist()]
            chance = scorer(texts)
            columns = [*batch.columns, pa.array(chance, pa.float64()), pa.array((chance >= threshold).astype(np.int32))]
            yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names, *names])

    added = [StructField(names[0], DoubleType()), StructField(names[1], IntegerType())]
    return docs.mapInArrow(run, StructType([*docs.schema.fields, *added]))


def reject(docs: DataFrame, scorer: Scorer, threshold: float = 0.3) -> DataFrame:
    """The rows of `docs` that are not predicted toxic, unchanged."""
    free = "_" * max(len(c) for c in docs.columns)
    names = (f"{free}score", f"{free}toxic")
    return score(docs, scorer, threshold, names).where(F.col(names[1]) == 0).select(*docs.columns)
