"""Corpus pipeline: the documents table through five stages, each written and read again.

A stage is (name, function); a function takes (spark, docs, sf_dir) and returns a
DataFrame.  All but the last return the columns of the documents they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flightlake.llm.line_dedup import deduplicated
from flightlake.llm.mixing import mixed_documents
from flightlake.llm.ngram_join import group_leaders
from flightlake.llm.pieces import encode_documents
from flightlake.llm.quality import fit_quality, keep_quality
from flightlake.session import staged


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return keep_quality(docs, fit_quality(docs, labels))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts less the lines that repeat an earlier one; `n_chars` follows the text."""
    clean = deduplicated(docs, counts=False)
    if "n_chars" in docs.columns:
        clean = clean.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return clean


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of the smallest id."""
    return group_leaders(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the schedule of the sources reads them."""
    return mixed_documents(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Whole texts as piece ids, with the digests of an exact round trip."""
    return encode_documents(docs)


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("ngram_join", ngram_join),
    ("mixing", mixing),
    ("pieces", pieces),
]

ORACLE_SQL = None  # trees, classes of lines and pieces have no SQL form; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline_{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
