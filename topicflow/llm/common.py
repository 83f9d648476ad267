"""Helpers of the text operators: Arrow batches inside tasks, key filters of fixed size, split folds."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import configure, materialize

BATCH_ROWS = 1500
FILTER_BITS = 1 << 26  # 8 MB, whatever the number of keys
SEGMENT = 32768  # bits in one of Spark's bitmaps


def prepare(df: DataFrame, rows: int = BATCH_ROWS) -> DataFrame:
    """Session settings for whole texts in Arrow batches of a bounded number of rows."""
    configure(df.sparkSession)
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    return df


def per_batch(df: DataFrame, work: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str, rows: int = BATCH_ROWS) -> DataFrame:
    """``work`` on every Arrow batch of every partition, without a shuffle; a worker hands its memory back after a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield work(batch)
        pa.default_memory_pool().release_unused()

    return prepare(df, rows).mapInArrow(run, schema)


def fold(id_col: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5


def filled(batch: pa.RecordBatch, name: str = "text") -> pa.Array:
    """The text column with nulls as empty texts."""
    return pc.fill_null(batch.column(batch.schema.get_field_index(name)), "")


def split_words(texts: pa.Array) -> tuple[np.ndarray, pa.DictionaryArray]:
    """Words between ASCII white space after lower-casing A-Z: row offsets and the coded words."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts))
    flat = lists.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    before = np.concatenate([[0], np.cumsum(real.to_numpy(zero_copy_only=False), dtype=np.int64)])
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return before[offsets - offsets[0]], flat.filter(real).dictionary_encode()


def hash_words(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each text, the same on every machine."""
    if not len(words):
        return np.zeros(0, np.uint64)
    return pd.util.hash_array(words.to_numpy(zero_copy_only=False).astype(object), categorize=False)


def mix(values: np.ndarray) -> np.ndarray:
    """The finaliser of a 64-bit mixing hash."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def key_filter(keys: DataFrame, key: str, bits: int = FILTER_BITS) -> Callable[[DataFrame, str], DataFrame]:
    """A map-side test "may this key be in ``keys``", as a bitmap of ``bits`` bits.

    Returns a function that adds the boolean ``__hit`` to a table by a broadcast of at most
    ``bits / 8`` bytes. No true member is missed; others pass by chance, so an exact join has to
    follow. Beyond some 10^8 keys nearly all rows pass and only the saving is lost.
    """
    place = F.pmod(F.xxhash64(key), F.lit(bits))
    maps = keys.select(place.alias("p")).groupBy((F.col("p") / SEGMENT).cast("int").alias("__segment"))
    maps = materialize(maps.agg(F.bitmap_construct_agg(F.col("p") % SEGMENT).alias("__bits")), "filter")

    def add(df: DataFrame, column: str) -> DataFrame:
        spot = F.pmod(F.xxhash64(column), F.lit(bits))
        byte = F.substring(F.col("__bits"), (F.col("__spot") / 8).cast("int") + 1, F.lit(1))
        set_bit = F.getbit(F.conv(F.hex(byte), 16, 10).cast("int"), (F.col("__spot") % 8).cast("int"))
        keyed = df.withColumn("__segment", (spot / SEGMENT).cast("int")).withColumn("__spot", (spot % SEGMENT).cast("int"))
        joined = keyed.join(F.broadcast(maps), "__segment", "left")
        return joined.withColumn("__hit", F.coalesce(set_bit == 1, F.lit(False))).drop("__segment", "__spot", "__bits")

    return add


def without(docs: DataFrame, gone: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``docs`` without the rows whose id is in ``gone`` (a null id matches a null id).

    Rows that the key filter lets through unmatched stay where they are; only the others are shuffled.
    """
    gone = gone.select(F.col(id_col).alias("__gone"))
    tested = key_filter(gone, "__gone")(docs, id_col)
    exact = tested.where("__hit").join(gone, F.col(id_col).eqNullSafe(F.col("__gone")), "left_anti")
    return tested.where("not __hit").unionByName(exact).select(*docs.columns)
