"""The corpus pipeline: five stages over ``documents``, each written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from paragrid.llm import jaccard, linededup, packing, quality, shared, suffix
from paragrid.sources.readers import spread

#: (name, function); each function takes (spark, docs, sf_dir).
STAGES = [
    ("quality_rules", quality.quality_stage),
    ("line_dedup", linededup.line_stage),
    ("ngram_jaccard", jaccard.jaccard_stage),
    ("suffix_dedup", suffix.suffix_stage),
    ("best_fit_packing", packing.packing_stage),
]

#: Tokenization, suffix sorting and bin completion are beyond SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; the packed pieces."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    before = None
    for name, stage in STAGES:
        docs = shared.materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
        if before is not None:
            shared.drop_files(before)
        before = docs
        shared.release(spark)
    return docs
