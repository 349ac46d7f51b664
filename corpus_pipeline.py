"""The corpus pipeline: quality, exact dedup, near dedup, mixing, token ids. Counted as part of samewise.llm.

Each stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; all but the last
return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from samewise.llm import bpe, mixing, ngram_join, quality, stream_dedup
from samewise.llm.common import stored, table, work_dir
from samewise.llm.queries import tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled ones among them, does not reject."""
    voter = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.keep_above(docs, voter, 0.5)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for the case of A-Z, the row with the largest doc_id."""
    return stream_dedup.exact_dedup(spark, docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of five-word shingle sets with Jaccard similarity 0.8 or more."""
    return ngram_join.near_dedup(spark, docs)


def mix_domains(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents drawn at the rates that bring the domains' tokens to their targets."""
    return mixing.mix(docs, table(spark, sf_dir, "labels"))


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document that is left, and the digest of the text that they decode to."""
    coded = bpe.encode_documents(docs, tokenizer_path(), decoded=True)
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded_sha256")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", drop_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("mixing to target weights", mix_domains),
    ("BPE encoding and decoding", to_ids),
]

#: The classifiers, the mixing and the encoding have no SQL form; tests hold them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a written table, read again by the next."""
    home = work_dir(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if number < len(STAGES) - 1:
            docs = stored(docs, f"{home}/{number}")
    return docs
