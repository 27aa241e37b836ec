"""Cleaning of a corpus in five stages.

`STAGES` lists (name, function) in order. A function takes the session, the documents that the
stage before it kept and the folder of the tables, and returns what it keeps, with the columns of
documents; the last one returns the tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from basketry.llm import bpe, decontam, near, passages, quality
from basketry.llm.queries import VOCABULARY, read
from basketry.llm.scratch import Scratch

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
#: Statistics, hashes of passages and fingerprints are not expressible in SQL.
ORACLE_SQL = None


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted to the labels, does not reject."""
    scratch = Scratch(spark, "pipeline")
    labels = quality.training_labels(read(spark, sf_dir, "labels"))
    stored = scratch.keep(quality.features(docs.select(F.col("doc_id").cast("long").alias("id"), "text")))
    return quality.keep_good(docs, quality.fit(stored.join(labels, "id")))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the smallest id of each group of near duplicates."""
    found = Scratch(spark, "pipeline").keep(near.near_duplicates(docs).filter("not kept").select("doc_id"))
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def own_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without passages that a document of smaller id has too."""
    found = Scratch(spark, "pipeline").keep(passages.repeated_passages(docs))
    cut = passages.without_passages(docs, found)
    return cut.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType)).select(*docs.columns)


def no_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontam.clean(docs, read(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token ids of each document, and whether what they decode to has the text's digest."""
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    both = bpe.round_trip(docs.withColumn("sha256", digest), VOCABULARY)
    return both.select(
        "doc_id", "lang", "source", F.size("ids").cast("long").alias("n_tokens"), "ids",
        (F.sha2(F.col("decoded").cast("binary"), 256) == F.col("sha256")).alias("round_trip"),
    )


STAGES = [
    ("quality classifier", good_quality),
    ("minhash near-dedup", one_of_each),
    ("substring dedup", own_passages),
    ("benchmark decontamination", no_benchmark),
    ("bpe encoding and decoding", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each is written before the next one reads it."""
    scratch = Scratch(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = scratch.keep(docs)
    return docs
