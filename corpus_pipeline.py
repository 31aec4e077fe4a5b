"""Corpus pipeline: each stage takes (spark, docs, sf_dir) and its result is the next one's docs.

Toxic documents go, one document of each SimHash component stays, documents that hold a
benchmark item go, sources are mixed towards their weights, and what is left is dealt to shards.
All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from accesslens.llm.common import stage, table
from accesslens.llm.decontamination import decontamination_stage
from accesslens.llm.mixing import mix_stage
from accesslens.llm.nearest_toxic import toxicity_stage
from accesslens.llm.sharding import shard_stage
from accesslens.llm.simhash_dedup import dedup_stage

STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash_dedup", dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mix_stage),
    ("sharding", shard_stage),
]

#: Nearest examples, XXH64 fingerprints and CRC-32 have no form in the SQL of the oracle.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = stage(step(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
