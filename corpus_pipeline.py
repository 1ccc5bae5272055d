"""From raw documents to token files, in five stages.

Each stage takes (spark, docs, sf_dir) and works on all rows the stage before kept; its result is
written as Parquet and read again as the next one's docs. All stages but the last return the columns
of `documents`.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from opsloom.llm.decontamination import without_leaks
from opsloom.llm.jaccard import one_per_component
from opsloom.llm.languages import accepted_documents
from opsloom.llm.mixing import mixed_rows, shuffled
from opsloom.llm.shared import shared_folder, staged, tasks
from opsloom.llm.tokens import read_token_files, write_token_files


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; the others go."""
    return accepted_documents(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles at similarity 0.8, the one with the smallest id stays."""
    return one_per_component(docs, percent=80, size=5)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item within a fifth of its words."""
    return without_leaks(docs, spark.read.parquet(f"{sf_dir.rstrip('/')}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 3, 1, 2: a document occurs as often as the mix takes it (not at all, once or twice).

    The rows are dealt by the output shard that the splitting tree gave their blocks, and shuffled inside each.
    """
    mix = mixed_rows(docs, weights=(3, 1, 2), share=1.5, most=2.0, shards=64)
    return shuffled(mix, 64, pieces=-(-tasks(spark) // 64)).select(*docs.columns)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Huffman token files of the mix; what they hold is read back from them."""
    files = write_token_files(docs, public_tokenizers.path("byte_bpe_50k.json"), shared_folder(spark, "tokens"))
    return read_token_files(files, whole=False)


STAGES = [("language", language), ("near_copies", near_copies), ("decontamination", decontamination), ("mixing", mixing), ("tokens", tokens)]

# language models, edit distances and tokenizers are beyond SQL: tests/llm/test_pipeline.py checks against plain loops
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
