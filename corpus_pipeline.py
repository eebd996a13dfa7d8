"""A corpus through filters, deduplication, decontamination and tokenisation; every stage is written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemill.llm import stages
from tidemill.llm.common import cut, drop

STAGES = [
    ("quality classifier", stages.quality),
    ("SimHash near-dedup", stages.near_dedup),
    ("substring dedup", stages.substring_dedup),
    ("benchmark decontamination", stages.decontamination),
    ("byte-level BPE", stages.tokens),
]
#: Trained scores, fingerprints and token ids are beyond SQL; tests hold run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = cut(docs)
            drop(before)
    return docs
