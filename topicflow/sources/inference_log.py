"""The prediction log, from files or a database."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

COLUMNS = ("predicted_at", "probability", "topic_id")


def read_inference_log(log: DataFrame, now: datetime, days: int, ordered: bool = False) -> DataFrame:
    """Three columns of the rows of the last ``days`` days; filter and projection are pushed down."""
    kind = log.schema["predicted_at"].dataType.simpleString()
    since = F.lit((now - timedelta(days=days)).isoformat(" ")).cast(kind)
    rows = log.where(F.col("predicted_at") >= since).select(*COLUMNS)
    return rows.orderBy("predicted_at") if ordered else rows


def scan_inference_log(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def jdbc_inference_log(
    spark: SparkSession, url: str, table: str = "inference_log", partitions: int | None = None,
    since: datetime | None = None, until: datetime | None = None, **options: str,
) -> DataFrame:
    """The log in a database, read in parallel ranges of ``predicted_at`` when bounds are given."""
    reader = spark.read.format("jdbc").option("url", url).option("dbtable", table).options(**options)
    if partitions and since and until:
        reader = (
            reader.option("partitionColumn", "predicted_at").option("numPartitions", partitions)
            .option("lowerBound", since.isoformat(" ")).option("upperBound", until.isoformat(" "))
        )
    return reader.load()
