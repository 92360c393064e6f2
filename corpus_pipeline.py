"""The corpus pipeline: five stages, each written as Parquet and read again by the next.

Rows come in with the columns of ``documents``; the first four stages return these columns
for the rows they keep, the last returns the packed pieces. A stage works on whatever its
predecessor kept, reads nothing else but ``labels`` (the first), and has a defined result
for NULLs, empty tables and extra columns, as stated by the operators it calls.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidelake.llm.catalog import QUERIES, VOCABULARY, table
from tidelake.llm.mixing import mixed
from tidelake.llm.names import fresh
from tidelake.llm.outliers import passing
from tidelake.llm.packing import pack_documents
from tidelake.llm.quality import score, train
from tidelake.llm.simhash import without_near_duplicates
from tidelake.session import new_path, use_utc

QUALITY = 0.3               # least score of a document that stays
WEIGHTS = (3, 1, 2)         # of the sources by code point, repeating
SHARE, PASSES = 1.5, 2      # budget as a share of all words, most copies of a document
CAPACITY = 2048             # tokens of a sequence


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a score of at least ``QUALITY``, learnt from the labelled ones among them."""
    forest, name = train(docs, table(spark, sf_dir, "labels")), fresh("score", docs.columns)
    return score(docs, forest, name=name).filter(F.col(name) >= QUALITY).drop(name)


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and are no outlier in their language and source."""
    return passing(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group of near-duplicates."""
    return without_near_duplicates(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, 0 to ``PASSES`` times."""
    return mixed(docs, weights=WEIGHTS, share=SHARE, passes=PASSES)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their sequences and places; a document that the mix
    takes twice has its pieces twice."""
    return pack_documents(docs, VOCABULARY, CAPACITY)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

# Boosted trees and BPE are beyond SQL; tests hold each stage against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written to the shared folder and read again."""
    sf_dir = sf_dir.rstrip("/")
    docs = table(use_utc(spark), sf_dir, "documents")
    for name, stage in STAGES:
        path = new_path(spark, f"{name}-{uuid.uuid4().hex[:8]}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs


QUERIES["pipeline"] = run
