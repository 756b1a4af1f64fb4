"""One query per operator, over its whole table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tagpulse.llm import (
    alignment, licenses, main_text, mixing, neighbours, packing, pieces, secret_scan, simhash, sketches, substrings, toxicity, whitening,
)

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
QUERIES = {}


def query(function):
    QUERIES[function.__name__] = function
    return function


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_packing(spark, sf_dir) -> DataFrame:
    """Every document in sequences of at most 2,048 tokens."""
    return packing.pack(table(spark, sf_dir, "documents"), TOKENIZER, capacity=2048, end_id=1)


@query
def op2_nearest_neighbours(spark, sf_dir) -> DataFrame:
    """The 20 nearest vectors found to every twentieth, by inner product."""
    return neighbours.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


@query
def op3_html_extraction(spark, sf_dir) -> DataFrame:
    """The main text of every page."""
    return main_text.extract(table(spark, sf_dir, "pages"))


@query
def op4_simhash(spark, sf_dir) -> DataFrame:
    """SimHash of every document, and the component of fingerprints at most four bits apart."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), words=4, seed=42, distance=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op5_mixing(spark, sf_dir) -> DataFrame:
    """When each document is read, with the sources as even as reading none over twice allows."""
    docs = table(spark, sf_dir, "documents")
    return mixing.schedule(docs, mixing.Mixture(repeats=2.0)).drop("text_key", "copy")


@query
def op6_secret_scan(spark, sf_dir) -> DataFrame:
    """Secrets in every document: patterns, and tokens that look random."""
    return secret_scan.scan(table(spark, sf_dir, "documents"))


@query
def op7_substring_dedup(spark, sf_dir) -> DataFrame:
    """Windows of 13 words that a document with a smaller id has too, removed from every document."""
    found = substrings.remove_repeated(table(spark, sf_dir, "documents"), width=13)
    return found.select("doc_id", "n_words", "n_removed", "kept_sha256")


@query
def op8_document_fingerprints(spark, sf_dir) -> DataFrame:
    """Fingerprints of every document and of its edited text, and how near they are."""
    return sketches.compare_edited(table(spark, sf_dir, "documents")).drop("sketch", "edited_sketch")


@query
def op9_license_scan(spark, sf_dir) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.scan(table(spark, sf_dir, "documents")).drop("spans")


@query
def op10_toxicity(spark, sf_dir) -> DataFrame:
    """How toxic every document is, learned from the labelled ones outside fold 2."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.fold(F.col("doc_id")) == 2, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", "predicted")


@query
def op11_tokenizer_alignment(spark, sf_dir) -> DataFrame:
    """How the byte-level tokens of every document line up with its pieces, and how common the linked ids are."""
    return alignment.align(table(spark, sf_dir, "documents"), TOKENIZER, PIECES)


@query
def op12_whitening(spark, sf_dir) -> DataFrame:
    """Every vector on the 32 leading components of the covariance of all, whitened."""
    vectors = table(spark, sf_dir, "embeddings")
    found = whitening.whiten(vectors, whitening.fit(vectors, components=32))
    return found.withColumn("deviation", F.col("deviation").cast("long"))


@query
def op13_sentencepiece(spark, sf_dir) -> DataFrame:
    """The piece ids of every document and the text that they decode to, as digests."""
    found = pieces.encode(table(spark, sf_dir, "documents"), PIECES, decoded=True)
    ids = F.array_join(F.transform("ids", lambda n: n.cast("string")), ",")
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), F.sha2(ids, 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"))
