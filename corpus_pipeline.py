"""A training corpus from raw documents: quality, near copies, benchmark passages, source mix, shards."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridloom.llm import decontam, jaccard, mixing, quality, sharding
from gridloom.llm.common import table
from gridloom.sources.store import Scratch, removed, shared_dir

#: Documents that score lower are rejected.
LEAST_SCORE = 0.7
SHARDS = 40


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts."""
    model = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.filter(quality.quality_score(docs, model)("text") >= LEAST_SCORE)


def near_copies_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return jaccard.keep_one(docs, 5, 0.75)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that don't repeat the benchmark."""
    return decontam.decontaminate(docs, table(spark, sf_dir, "benchmark"), "documents")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the schedule's blocks take it.  The order of slots ends with this stage, as the next one permutes all rows."""
    return mixing.mix_sources(docs, rows=True).select("row", F.explode("slots")).select("row.*")


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows with row_number, shard and slot."""
    return sharding.shard_rows(docs, SHARDS)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", quality_stage),
    ("n-gram Jaccard join", near_copies_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
    ("sharding", sharding_stage),
]

#: The quality classifier is a fitted model, which SQL can't express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written to the shared folder and read back by the next.

    What a stage stored on its way goes when its result is written, and so does the result before; the last stage
    is worked out when its rows are asked for, so what it reads stays.

    The tables may have more columns, of any names but row_number, shard and slot, which the last stage replaces.  An
    empty table, and one of which nothing is kept, gives no rows.
    """
    docs = table(spark, sf_dir, "documents")
    top = f"{shared_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for i, (_, stage) in enumerate(STAGES):
        if i + 1 == len(STAGES):
            return stage(spark, docs, sf_dir)
        with Scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(f"{top}/{i}")
        docs = spark.read.parquet(f"{top}/{i}")
        if i:
            removed(spark, f"{top}/{i - 1}")
    return docs
