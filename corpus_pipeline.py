"""Corpus pipeline: from documents to packed training sequences.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame that is written as Parquet and read again as the next
stage's docs.  All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from martwright.llm import line_dedup, minhash_dedup, packing, quality_knn, substring_dedup
from martwright.llm.components import stored

STAGES = [
    ("quality_classifier", quality_knn.stage),
    ("line_dedup", line_dedup.stage),
    ("minhash_dedup", minhash_dedup.stage),
    ("substring_dedup", substring_dedup.stage),
    ("best_fit_packing", packing.stage),
]

#: The classifier, the shingle links and the packing have no SQL form; the
#: stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The packed pieces of the documents that all stages keep."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
