"""A training corpus from raw documents: each stage takes what the one before it kept.

Quality rules reject documents, then language identification does, then one document of each
near-duplicate group stays, and the rest is packed into sequences. The stages but the last
return the columns of ``documents``. Where the text is NULL or has no words, no stage keeps it;
an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starlane.llm.files import stage
from starlane.llm.languages import keep_identified
from starlane.llm.near_dups import keep_one
from starlane.llm.outliers import keep_inliers
from starlane.llm.packing import packed_documents


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_inliers(docs)


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return keep_one(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # Executors still hold what the earlier stages left, so the workers cache fewer pieces here.
    return packed_documents(docs, cached_pieces=100_000)


STAGES = [
    ("quality_rules", quality_rules),
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("packing", packing),
]

# Trained machines and the packing of token ids cannot be told in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written as Parquet and read again."""
    rows = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, function in STAGES:
        rows = stage(function(spark, rows, sf_dir), name)
    return rows
