"""Corpus profiles: one aggregation pass each, partial results before every shuffle."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import MIN_TEXT_LEN, SEASONS
from ..functions.text import is_blank, is_url_only, text_length


def dataset_profile(
    df: DataFrame, start: str | date | None = None, end: str | date | None = None, approx: bool = False
) -> DataFrame:
    """Rows, channels, inclusive day span (of the requested range, or of the data), first and last day."""
    channels = F.approx_count_distinct("channel") if approx else F.count_distinct("channel")
    first = F.lit(str(start)).cast("date") if start else F.to_date(F.min("created_at"))
    last = F.lit(str(end)).cast("date") if end else F.to_date(F.max("created_at"))
    return df.agg(
        F.count("*").alias("num_records"),
        channels.alias("channels_count"),
        (F.datediff(last, first) + 1).alias("date_range_days"),
        F.to_date(F.min("created_at")).alias("min_date"),
        F.to_date(F.max("created_at")).alias("max_date"),
    )


def monthly_distribution(df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    month = F.date_format("created_at", "yyyy-MM").alias("month")
    return df.groupBy(*by, month).agg(F.count("*").alias("posts")).orderBy(*by, "month")


def top_channels(df: DataFrame, k: int = 20) -> DataFrame:
    return df.groupBy("channel").agg(F.count("*").alias("posts")).orderBy(F.desc("posts"), "channel").limit(k)


def yearly_distribution(df: DataFrame) -> DataFrame:
    return df.groupBy(F.year("created_at").alias("year")).agg(F.count("*").alias("posts")).orderBy("year")


def top_months(df: DataFrame, k: int = 5) -> DataFrame:
    month = F.date_format("created_at", "yyyy-MM").alias("month")
    return df.groupBy(month).agg(F.count("*").alias("posts")).orderBy(F.desc("posts"), "month").limit(k)


def season(ts: Column) -> Column:
    expr = None
    for name, months in SEASONS.items():
        hit = F.month(ts).isin(list(months))
        expr = F.when(hit, name) if expr is None else expr.when(hit, name)
    return expr


def season_distribution(df: DataFrame) -> DataFrame:
    counts = df.groupBy(season(F.col("created_at")).alias("season")).agg(F.count("*").alias("posts"))
    total = F.sum("posts").over(Window.partitionBy(F.lit(1)))  # at most four rows
    return counts.withColumn("pct", F.round(F.col("posts") * 100.0 / total, 1))


def null_audit(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column, as rows (column, nulls), from one pass."""
    columns = list(columns or df.columns)
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    return counts.select(F.expr(f"stack({len(columns)}, {pairs}) AS (column_name, nulls)"))


def length_stats(df: DataFrame, length: Column, digits: int = 1) -> DataFrame:
    """Moments and exact linear percentiles.

    Rows are counted per length first: the percentile state then holds distinct lengths only.
    """
    counts = df.groupBy(length.alias("len")).agg(F.count("*").alias("n"))
    quantiles = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9, "p95": 0.95, "p99": 0.99}
    total, weighted = F.sum("n"), F.sum(F.col("len") * F.col("n"))
    squares = F.sum(F.col("len").cast("double") * F.col("len") * F.col("n"))
    variance = F.try_divide(squares - weighted * F.try_divide(weighted, total), total - 1)
    return counts.agg(
        total.alias("count"),
        F.round(F.try_divide(weighted, total), digits).alias("mean"),
        F.round(F.sqrt(variance), digits).alias("std"),
        F.min("len").alias("min"),
        F.max("len").alias("max"),
        *[F.round(F.percentile("len", q, F.col("n")), digits).alias(name) for name, q in quantiles.items()],
    )


def text_length_stats(df: DataFrame) -> DataFrame:
    return length_stats(df, text_length(F.col("text")))


def length_histogram(
    df: DataFrame, value: Column, bins: int, low: float, high: float, by: Sequence[str] = (), right: float | None = None
) -> DataFrame:
    """Equal-width histogram of ``value`` clipped to [low, high]; the last bin is closed."""
    clipped = F.greatest(F.least(value.cast("double"), F.lit(float(high))), F.lit(float(low)))
    place = F.floor((clipped - low) * bins / (high - low))
    binned = df.where(value.isNotNull()).select(*by, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    return binned.groupBy(*by, "bin").agg(F.count("*").alias("n"))


def quality_flags(df: DataFrame, min_len: int = MIN_TEXT_LEN) -> DataFrame:
    text = F.col("text")
    counts = df.agg(
        F.count("*").alias("total"),
        F.count_if(is_blank(text)).alias("empty"),
        F.count_if(is_url_only(text)).alias("url_only"),
        F.count_if(text_length(text) < min_len).alias("short"),
    )
    share = lambda c: F.round(F.try_divide(F.col(c) * 100.0, F.col("total")), 2).alias(f"{c}_pct")
    return counts.select("*", share("empty"), share("url_only"), share("short"))


def weighted_median(df: DataFrame, value: Column, keep: Column) -> DataFrame:
    counts = df.where(keep).groupBy(value.alias("v")).agg(F.count("*").alias("n"))
    return counts.agg(F.percentile("v", 0.5, F.col("n")).alias("median"))


def preprocessing_stats(df: DataFrame) -> DataFrame:
    """Rows left without a lemma, and two medians over the kept rows.

    ``df`` holds all rows, the blank ones included (``drop_blank=False``). The two lengths go
    through one table of counts, so no state holds rows.
    """
    blank = F.col("text_lemm") == ""
    measures = df.select(
        blank.alias("blank"),
        F.explode(
            F.array(
                F.struct(F.lit("tokens").alias("kind"), F.size(F.split("text_lemm", " ")).alias("v")),
                F.struct(F.lit("chars").alias("kind"), F.length("text_clean").alias("v")),
            )
        ).alias("m"),
    )
    counts = measures.groupBy("blank", "m.kind", "m.v").agg(F.count("*").alias("n"))
    middle = lambda kind: F.percentile(
        F.when((F.col("kind") == kind) & ~F.col("blank"), F.col("v")), 0.5, F.col("n")
    )
    return counts.agg(
        F.coalesce(F.sum(F.when(F.col("blank") & (F.col("kind") == "chars"), F.col("n"))), F.lit(0)).alias("empty_after_lemm"),
        middle("tokens").alias("median_token_count"),
        middle("chars").alias("median_char_length"),
    )
