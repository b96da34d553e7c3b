"""A corpus pipeline: toxicity, near-duplicates, benchmark decontamination, source mixing, sharding."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from plumbline.llm.common import table
from plumbline.llm.decontaminate import without_leaks
from plumbline.llm.mixing import mixed_documents
from plumbline.llm.near import one_of_each
from plumbline.llm.sharding import sharded
from plumbline.llm.toxicity import without_toxic
from plumbline.session import checkpoint_dir


def toxicity(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents that the network predicts toxic go."""
    return without_toxic(docs, table(spark, folder, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """One document of each group of near copies stays."""
    return one_of_each(docs, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents with a passage within the edit limit of a benchmark item go."""
    return without_leaks(docs, table(spark, folder, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Documents, and parts of them, as often as the target weights of their sources ask for."""
    return mixed_documents(docs)


def sharding(spark: SparkSession, docs: DataFrame, folder: str) -> DataFrame:
    """Shard and slot of every row of the mix."""
    return sharded(docs)


STAGES = [("toxicity", toxicity), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing), ("sharding", sharding)]

#: Hash-based draws and trained models are beyond SQL; tests/llm compares the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, folder: str) -> DataFrame:
    """Every stage over ``documents``; what a stage keeps is written to the shared folder and read by the next one."""
    shared = checkpoint_dir(spark)
    if shared is None:
        raise ValueError("the pipeline writes its stages to the folder in spark.checkpoint.dir; set it")
    docs = table(spark, folder, "documents")
    for name, stage in STAGES[:-1]:
        path = f"{shared}/corpus-{uuid.uuid4().hex}/{name}"
        stage(spark, docs, folder).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, folder)
