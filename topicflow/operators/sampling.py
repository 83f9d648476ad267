"""Samples, slices and row selection. Draws follow a hash of the id, so they repeat exactly."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import MIN_TEXT_LEN, NOISE, RANDOM_SEED, EvolutionThresholds
from ..functions.scale import hash_key, sample_per_group, top_k_per_group
from ..functions.text import min_length
from .profiling import season


def stratified_sample_season(
    df: DataFrame, target: int, since: str, min_len: int = MIN_TEXT_LEN, seed: int = RANDOM_SEED
) -> DataFrame:
    """Proportional sample by year and season of the long enough posts since a date."""
    pool = df.where((F.col("created_at") >= F.lit(since).cast("timestamp")) & min_length(F.col("text"), min_len))
    pool = pool.withColumn(
        "stratum", F.concat_ws("_", F.year("created_at").cast("string"), season(F.col("created_at")))
    )
    total = pool.count()
    # half-even rounding, like the rounding of the original shares
    quota = lambda size: F.least(F.bround(size / F.lit(float(max(total, 1))) * target, 0).cast("long"), size)
    return sample_per_group(pool, ["stratum"], "post_id", quota, seed)


def stratified_sample_channel(
    df: DataFrame, n: int, column: str = "channel", id_col: str = "post_id", seed: int = RANDOM_SEED
) -> DataFrame:
    """Per channel ceil(n * size / total) rows, then cut to ``n`` in all."""
    total = max(df.count(), 1)
    quota = lambda size: F.least(size, F.ceil(size * F.lit(n) / F.lit(float(total))))
    return sample_per_group(sample_per_group(df, [column], id_col, quota, seed), [], id_col, F.lit(n), seed)


def uniform_sample_n(df: DataFrame, n: int, id_col: str = "post_id", seed: int = RANDOM_SEED) -> DataFrame:
    """Exactly ``n`` rows in id order; all rows for n = 0 or n beyond the count."""
    return (sample_per_group(df, [], id_col, F.lit(n), seed) if n > 0 else df).orderBy(id_col)


def time_slices(df: DataFrame, bounds: Mapping[str, tuple[str, str]], column: str = "created_at") -> DataFrame:
    """Tag rows with the half-open slice they fall in; rows outside all slices are left out."""
    kind = df.schema[column].dataType.simpleString()
    tag: Column = F.lit(None).cast("string")
    for name, (start, end) in reversed(bounds.items()):
        inside = (F.col(column) >= F.lit(start).cast(kind)) & (F.col(column) < F.lit(end).cast(kind))
        tag = F.when(inside, F.lit(name)).otherwise(tag)
    first, last = min(s for s, _ in bounds.values()), max(e for _, e in bounds.values())
    ranged = df.where((F.col(column) >= F.lit(first).cast(kind)) & (F.col(column) < F.lit(last).cast(kind)))
    return ranged.withColumn("slice", tag).where("slice IS NOT NULL")


def drop_noise_docs(docs: DataFrame, topics: DataFrame, key: str = "doc_id") -> DataFrame:
    return docs.join(topics.where(F.col("topic") != NOISE).select(key), key, "left_semi")


def cap_per_group(
    df: DataFrame, group: str | Sequence[str], k: int, id_col: str = "doc_id", seed: int = RANDOM_SEED,
    drop_noise: bool = True,
) -> DataFrame:
    """At most ``k`` rows per cluster in hash order, noise left out."""
    groups = [group] if isinstance(group, str) else list(group)
    rows = df.where(F.col(groups[-1]) != NOISE) if drop_noise else df
    hashed = rows.withColumn("__h", hash_key(id_col, seed))
    return top_k_per_group(hashed, groups, [F.col("__h"), F.col(id_col)], k, id_col).drop("__h")


def sample_pairs_for_review(
    best: DataFrame, low_pairs: DataFrame, n_confident: int = 20, n_low: int = 30,
    thresholds: EvolutionThresholds = EvolutionThresholds(), seed: int = RANDOM_SEED,
) -> DataFrame:
    """All border pairs, some confident matches and some clearly different pairs.

    ``best`` has the best partner per topic; ``low_pairs`` may hold any pairs, of which those below
    the lower threshold are drawn. The two draws are reports of a fixed size.
    """
    columns = ["topic_a", "topic_b", "cosine"]
    order = F.md5(F.concat_ws("|", F.col("topic_a").cast("string"), F.col("topic_b").cast("string"), F.lit(str(seed))))
    high, low = thresholds.cosine_high, thresholds.cosine_low
    draw = lambda df, n: df.orderBy(order, "topic_a", "topic_b").limit(n)
    border = best.where((F.col("cosine") >= low) & (F.col("cosine") < high)).select(columns)
    confident = draw(best.where(F.col("cosine") >= high).select(columns), n_confident)
    different = draw(low_pairs.where(F.col("cosine") < low).select(columns), n_low)
    return (
        border.withColumn("kind", F.lit("border"))
        .unionByName(confident.withColumn("kind", F.lit("confident")))
        .unionByName(different.withColumn("kind", F.lit("low")))
    )
