"""Post tables: ranged scans, normalising, deltas, versions, dense indexes."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scale import dense_index

# Column names of the exchange formats.
RAW_SCHEMA = T.StructType(
    [
        T.StructField("id_post", T.LongType()),
        T.StructField("channel_name", T.StringType()),
        T.StructField("post_date", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("views", T.LongType()),
        T.StructField("reactions", T.LongType()),
        T.StructField("comments", T.LongType()),
    ]
)
RENAMES = {"id_post": "post_id", "channel_name": "channel", "post_date": "created_at"}
REQUIRED = ("post_id", "channel", "text", "created_at")


def _as_timestamp(df: DataFrame, column: str):
    kind = df.schema[column].dataType
    if isinstance(kind, T.StringType):
        return F.try_to_timestamp(F.col(column))
    return F.col(column).cast("timestamp")


def filter_range(df: DataFrame, start: str | date, end: str | date, column: str | None = None) -> DataFrame:
    """``start <= t < end + 1 day``: whole days in UTC, the last one included.

    The bounds are literals of the column's own type, so the comparison is pushed to Parquet.
    """
    column = column or ("post_date" if "post_date" in df.columns else "created_at")
    first = datetime.fromisoformat(str(start))
    last = datetime.fromisoformat(str(end)) + timedelta(days=1)
    kind = df.schema[column].dataType.simpleString()
    bound = lambda t: F.lit(t.isoformat(" ")).cast(kind)
    return df.where((F.col(column) >= bound(first)) & (F.col(column) < bound(last)))


def scan_posts_range(spark: SparkSession, path: str, start: str | date, end: str | date) -> DataFrame:
    """All Parquet files below ``path``, restricted to a date range by pushdown."""
    return filter_range(spark.read.option("recursiveFileLookup", True).parquet(path), start, end)


def _require(df: DataFrame, needed: Sequence[str]) -> None:
    missing = sorted(set(needed) - set(df.columns))
    if missing:
        raise ValueError(f"missing required columns: {missing}")


def normalize_posts(df: DataFrame, fail_if_empty: bool = False) -> DataFrame:
    """Common column names; unparsable or missing times drop the row.

    ``fail_if_empty`` runs a job that looks for one row.
    """
    renamed = df.withColumnsRenamed(RENAMES)
    _require(renamed, REQUIRED)
    out = renamed.withColumn("created_at", _as_timestamp(renamed, "created_at")).where("created_at IS NOT NULL")
    if fail_if_empty and out.isEmpty():
        raise ValueError("no records found")
    return out


def latest_n_posts(df: DataFrame, n: int, id_col: str = "post_id") -> DataFrame:
    """The newest ``n`` rows (all of them for n = 0); equal times are ordered by id.

    Counting per hour finds the hour in which the quota ends; only that hour's rows are ranked,
    everything newer passes through without a sort.
    """
    if n <= 0:
        return df
    hour = F.date_trunc("hour", F.col("created_at"))
    counts = df.groupBy(hour.alias("__hour")).agg(F.count("*").alias("__n"))
    newer_rows = F.sum("__n").over(Window.orderBy(F.desc("__hour")).rowsBetween(Window.unboundedPreceding, -1))
    running = counts.withColumn("__newer", F.coalesce(newer_rows, F.lit(0)))
    cut = running.where((F.col("__newer") < n) & (F.col("__newer") + F.col("__n") >= n)).first()
    if cut is None:
        return df
    newer = df.where(hour > F.lit(cut["__hour"]))
    edge = df.where(hour == F.lit(cut["__hour"]))
    return newer.unionByName(edge.orderBy(F.desc("created_at"), F.desc(id_col)).limit(n - cut["__newer"]))


def read_delta(spark: SparkSession, path: str) -> DataFrame:
    """New posts from CSV with a header; fails when one of the seven columns is missing."""
    header = spark.read.option("header", True).csv(path)
    _require(header, RAW_SCHEMA.names)
    rows = spark.read.option("header", True).option("multiLine", True).option("escape", '"').csv(path)
    typed = [F.col(f.name).try_cast(f.dataType).alias(f.name) for f in RAW_SCHEMA.fields]
    return rows.select(typed).withColumn("post_date", F.to_timestamp("post_date"))


def append_delta(base: DataFrame, delta: DataFrame, key: str = "id_post", dedup: bool = True, time: str = "post_date") -> DataFrame:
    """Rows to add: only keys unknown to ``base``, each once (the newest by ``time``, null dates last); all rows for dedup=False.

    Rows of one date are told apart by a hash of their content, so the choice does not depend on file order.
    """
    if not dedup:
        return delta
    fresh = delta.join(base.select(key), key, "left_anti")
    columns = [c for c in delta.columns if c != key]
    order = F.struct(*([F.col(time)] if time in columns else []), F.xxhash64(*columns).alias("__content"))
    newest = F.max_by(F.struct(*columns), order).alias("__row")
    return fresh.groupBy(key).agg(newest).select(key, *[F.col(f"__row.{c}").alias(c) for c in columns]).select(delta.columns)


def union_versions(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All Parquet files of a versioned set; columns missing in older files are null."""
    return spark.read.option("recursiveFileLookup", True).option("mergeSchema", True).parquet(*paths)


def embed_index_map(df: DataFrame, key: str = "id_post") -> DataFrame:
    """Dense 0-based index of the ids in ascending order."""
    return dense_index(df.select(key), key, "embed_idx").select("embed_idx", key)
