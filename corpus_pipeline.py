"""A corpus pipeline of five stages: quality, near-duplicates, personal data, mixing, packing.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; its result is written as Parquet and read again as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
Every stage passes null and empty texts, repeated rows and extra columns
through as its operator's docstring says, and an empty table gives an empty table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shiftkit.llm import jaccard_join, mixing, packing, pii, quality
from shiftkit.llm.common import landed, table

_SCORE = "__quality"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents whose compression score is below one half."""
    model = quality.fit(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model, _SCORE).where(F.col(_SCORE) >= 0.5).drop(_SCORE)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near-duplicates."""
    return jaccard_join.one_of_each(docs)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data and the terms that disclose it; no document is dropped."""
    return pii.sanitised(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat or leave out documents until sources have their target weights."""
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Assign documents to length buckets and batches."""
    return packing.pack(docs)


STAGES = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_duplicate_stage),
    ("PII", pii_stage),
    ("mixing sources to target weights", mixing_stage),
    ("packing", packing_stage),
]

#: A trained classifier and corpus statistics decide; tests hold the stages against brute force instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``; the rows of the last."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = landed(stage(spark, docs, sf_dir), f"pipeline-{i}")
    return docs
