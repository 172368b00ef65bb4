"""Corpus pipeline: quality, near-duplicates, benchmark leaks, source mix, shards.

Each stage takes ``(spark, docs, sf_dir)`` and works on every row its predecessor kept.
All stages but the last return the columns of ``documents``; the last adds shard and
slot. ``run`` writes what a stage returns as Parquet in the shared checkpoint folder
and reads it back for the next one, so a lost executor never costs more than the
stage at hand.

Defined results: rows without text pass the quality stage on their score, are never
near-duplicates or leaks, and are left out by the mix, which takes words; an empty
table gives an empty result with the same columns. Columns beyond those of
``documents`` pass through, whatever their names; ``shard`` and ``slot`` are replaced.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiflow.llm import decontam, minhash, mixing, quality, sharding
from kpiflow.llm.common import cut, table

SHARDS = 16


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects; it learns from the labels outside the held-out fold."""
    labels = table(spark, sf_dir, "labels")
    return quality.keep_good(docs, labels.filter(~quality.held_out(F.col("doc_id"))))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each group of near-duplicates, at the operator's similarity of 0.85 (five-word shingles)."""
    return minhash.drop_near_duplicates(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that contain a benchmark item."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes each document as often as the mix of the sources asks for."""
    return mixing.mix(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Deals the documents to shards of near equal bytes."""
    return sharding.kd_shard(docs, SHARDS)


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

#: SQL can express neither the trained classifier nor the sketches; tests/llm/test_pipeline.py recomputes what each
#: stage keeps of its input by brute force (the classifier's scores in test_quality.py).
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
