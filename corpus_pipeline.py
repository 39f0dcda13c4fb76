"""Corpus pipeline over ``documents``: filter, de-duplicate, decontaminate and pack.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor
kept; ``run`` writes each result as Parquet to the shared folder and reads it
again as the next one's documents.  All but the last stage return the columns
of ``documents``; the last returns the place of each token piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from recspark.llm.chosen_path import dedup_stage
from recspark.llm.decontaminate import clean_stage
from recspark.llm.line_dedup import line_stage
from recspark.llm.packing import packing_stage
from recspark.llm.quality import quality_stage
from recspark.session import free_shuffles, scratch_path

STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("near-duplicates", dedup_stage),
    ("decontamination", clean_stage),
    ("packing", packing_stage),
]

#: Near-duplicate components and packing have no SQL form; the tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, "pipeline-" + name.replace(" ", "-"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        free_shuffles(spark)
    return docs
