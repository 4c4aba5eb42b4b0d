"""Training-data pipeline over ``documents``: rules, copies, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir), calls one operator of
``skyframe.llm`` and returns a DataFrame that is written as Parquet and read
again as the next stage's ``docs``. All but the last return the columns of
``documents``; the last returns the packed pieces.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from skyframe.llm.exact_dedup import drop_exact
from skyframe.llm.mixing import replicate
from skyframe.llm.ngram_join import drop_near
from skyframe.llm.packing import pack
from skyframe.llm.quality_rules import keep_by_rules
from skyframe.session import scratch_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the repetition rules keep."""
    return keep_by_rules(docs, min_words=50, max_repeat_percent=50, min_repeat=10, max_covered_percent=30, max_longest=100)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts."""
    return drop_exact(docs)


def ngram_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies."""
    return drop_near(docs, k=5, percent=75)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated to the sources' target weights, in shuffled order."""
    return replicate(docs, seed=7, temperature=0.5, epochs=1.0).select(*docs.columns)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of 2,048 tokens."""
    return pack(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=2048, end_id=0)


STAGES = [
    ("quality rules", quality_rules),
    ("exact dedup", exact_dedup),
    ("n-gram Jaccard join", ngram_join),
    ("mixing", mixing),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{i}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs


#: No SQL: near copies and packing are tested against plain versions in tests/llm.
ORACLE_SQL = None
QUERIES = {"pipeline": run}
ORACLE: dict[str, str] = {}
