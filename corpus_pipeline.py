"""The corpus pipeline: from documents to packed training sequences.

Every stage takes (spark, docs, sf_dir), works on all that the stage before it kept, and, but for the last, returns the
columns of documents.
"""

from pyspark.sql import DataFrame, SparkSession

from tagpulse.llm import mixing, packing, secret_scan, simhash, toxicity
from tagpulse.llm.queries import TOKENIZER, table
from tagpulse.session import fresh_folder


def without_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not predict as toxic; it learns from the table labels."""
    return toxicity.reject(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of exact and near copies: fingerprints at most four bits apart, as in
    op4_simhash, or a common band of MinHashes bring texts together, and those that share 0.8 of their shingles are copies."""
    return simhash.keep_one(docs, simhash.similar_documents(docs))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts replaced by a mark."""
    return secret_scan.redact(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document at least once, those of small sources up to twice, in blocks that hold the mixture."""
    return mixing.mix(docs, mixing.Mixture(repeats=2.0))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 2,048 tokens."""
    return packing.pack(docs, TOKENIZER, capacity=2048, end_id=1)


STAGES = [
    ("toxicity", without_toxic),
    ("near_duplicates", without_copies),
    ("secrets", without_secrets),
    ("mixing", mixed),
    ("packing", packed),
]

#: No SQL: a trained classifier and a tokenizer take part. tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage over the table documents; what the others return is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        folder = fresh_folder(spark, name)
        stage(spark, docs, sf_dir).write.parquet(folder)
        docs = spark.read.parquet(folder)
    return STAGES[-1][1](spark, docs, sf_dir)
