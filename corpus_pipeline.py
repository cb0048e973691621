"""The corpus pipeline: quality rules, exact and near duplicates, mixing, encoding, each over what the last one kept."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pagetables.llm import bpe, exact_dedup, jaccard_join, mixing, quality_rules
from pagetables.llm.common import shared_folder, table

STAGES = [
    ("quality_rules", quality_rules.stage),
    ("exact_dedup", exact_dedup.stage),
    ("jaccard_join", jaccard_join.stage),
    ("mixing", mixing.stage),
    ("bpe", bpe.stage),
]

#: The n-gram perplexity of the first stage and the byte-pair merges of the last can't be said in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in their order; each stage's rows are written as Parquet to the shared folder and read again."""
    base = f"{shared_folder(spark)}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
