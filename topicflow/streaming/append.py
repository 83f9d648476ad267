"""Appending new posts from a stream, each id once."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from ..sources.posts import append_delta


def unique_posts(posts: DataFrame, key: str = "id_post", time: str = "post_date", delay: str = "1 day") -> DataFrame:
    """Drops repeats of a key that arrive within the watermark delay; state is forgotten after it."""
    timed = posts.withColumn(time, F.col(time).cast("timestamp"))
    return timed.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])


def stream_append_delta(
    posts: DataFrame, table: str, checkpoint: str, key: str = "id_post", time: str = "post_date", delay: str = "1 day"
) -> StreamingQuery:
    """Append posts whose key is not in the Parquet table yet.

    The anti-join in each micro-batch reads the table as it is then, so keys that came back after
    the watermark, or a batch that runs twice, add nothing.
    """

    def run(batch: DataFrame, _: int) -> None:
        base = batch.sparkSession.read.parquet(table)
        append_delta(base, batch, key).write.mode("append").parquet(table)

    stream = unique_posts(posts, key, time, delay).writeStream.foreachBatch(run)
    return stream.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
