"""The corpus pipeline: quality, toxicity, exact copies, near copies, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and returns a DataFrame. Stages
but the last return the columns of ``docs``; the last returns the pieces of packed sequences. ``run`` writes each
result as Parquet to the shared folder and reads it again for the next stage, so a lost executor repeats one stage at most.

A stage's result may read scratch tables of its own. The next stage deletes them, as its ``docs`` are a written copy; they
stay if ``docs`` still reads them. Nulls, empty and very long texts, repeated rows and empty tables have the
results that each operator states; columns of ``docs`` beyond doc_id and text pass through.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable
from functools import wraps

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from topicflow.llm import dedup, near, packing, quality, toxicity
from topicflow.session import discard, folders, materialize, remove, scratch

_left: list[str] = []  # scratch folders behind the result of the last stage


def stage(work: Callable[[SparkSession, DataFrame, str], DataFrame]) -> Callable[[SparkSession, DataFrame, str], DataFrame]:
    """Clears up after the stage before, on disk and in the driver's memory, then runs ``work``."""

    @wraps(work)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        clear(spark, docs)
        with scratch() as made:
            out = work(spark, docs, sf_dir)
        _left.extend(made)
        hand_back()
        return out

    return run_stage


def clear(spark: SparkSession, docs: DataFrame) -> None:
    """Deletes what the last stage left, unless ``docs`` still reads some of it."""
    names = {path.rsplit("/", 1)[1] for path in _left}
    if not names & {folder.rsplit("/", 1)[1] for folder in folders(docs)}:
        remove(spark, _left)
        _left.clear()


def hand_back() -> None:
    """Returns the driver's free memory to the system, where the C library can."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


@stage
def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the weakly supervised rules judge good."""
    return quality.drop_poor(docs)


@stage
def keep_harmless(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity stays below a half; learns from the labelled rows outside the held-out fold."""
    return toxicity.drop_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


@stage
def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each text, the one with the largest doc_id."""
    return dedup.drop_copies(docs)


@stage
def keep_one_of_near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest doc_id."""
    return near.drop_near(docs)


@stage
def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of packed sequences with their ids."""
    return packing.pack(docs)


STAGES = [
    ("quality rules", keep_quality),
    ("toxicity", keep_harmless),
    ("exact dedup", keep_one_copy),
    ("near dedup", keep_one_of_near),
    ("packing", pack),
]
ORACLE_SQL = None  # expectation-maximisation and fitted scores are beyond SQL


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; of what they wrote only the result stays."""
    docs = given = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, work in STAGES:
        before, docs = docs, materialize(work(spark, docs, sf_dir), name.replace(" ", "-"))
        if before is not given:
            discard(before)
    clear(spark, docs)
    return docs
