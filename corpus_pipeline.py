"""The corpus pipeline: quality, exact dedup, near-dedup, mixing, encoding, each stage written and read again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm import bpe, exact_dedup, mixing, quality, simhash
from tallyspark.llm.tables import table
from tallyspark.session import Scratch, shared_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality vote accepts; the labels of its sample come from the label table."""
    rated = quality.rate(docs.select(*COLUMNS), table(spark, sf_dir, "labels"))
    return rated.filter("predicted = 1").select(*COLUMNS)


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest doc_id, against a digest index of this run."""
    scratch, index = Scratch(spark), exact_dedup.DigestIndex(spark, f"digest_index_{uuid.uuid4().hex}")
    decisions = exact_dedup.deduplicate_all(docs, index, scratch)
    index.drop()
    return exact_dedup.kept_documents(docs, decisions).select(*COLUMNS)


def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest doc_id."""
    return simhash.one_of_each(docs, Scratch(spark)).select(*COLUMNS)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix, document by document: a row for each pass that takes words of one, with those words as its text."""
    return mixing.mixed_documents(docs, mixing.Mix(), Scratch(spark)).select(*COLUMNS)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document of the mix, with their number and whether they decode to the text again."""
    out = bpe.encode_documents(docs.select(*COLUMNS), Scratch(spark)).withColumn("n_tokens", F.size("ids").cast("long"))
    return out.select("doc_id", "lang", "source", "n_chars", "n_tokens", "ids", "exact")


STAGES = [
    ("quality classifier", keep_good),
    ("exact dedup", keep_one_copy),
    ("SimHash near-dedup", keep_one_of_near),
    ("mixing sources to target weights", mixed),
    ("BPE encoding and decoding", encoded),
]
ORACLE_SQL = None  # Voting, fingerprints, the mix and BPE aren't expressible in SQL; tests compare with brute force.


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written to the shared folder and read as the next one's input."""
    folder = shared_dir(spark)
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        path = f"{folder}/stage_{i}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
