"""From raw documents to packed training sequences.

Each stage takes (spark, docs, sf_dir) and gives the documents that stay, with the columns of
``documents``; its result is written as Parquet and read again as the next stage's input.  The last stage
gives the packed pieces.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from civicflow.llm.common import documents, stored, tokenizer
from civicflow.llm.decontam import decontaminated
from civicflow.llm.linededup import keep_first_lines
from civicflow.llm.minhash import keep_one_of_each
from civicflow.llm.packing import pack
from civicflow.llm.quality import keep_quality


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go; all others stay as they are."""
    return keep_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated runs of lines are cut out; documents of nothing else go."""
    return keep_first_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates (five-word shingles, similarity 0.8) the least id stays."""
    return keep_one_of_each(docs, width=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain a benchmark item go."""
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """What is left, as token pieces in sequences."""
    return pack(docs, tokenizer())


STAGES = [
    ("quality", quality),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: A fitted classifier and token ids cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
