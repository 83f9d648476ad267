"""Drift figures and streaks on a stream of predictions."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, timedelta

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..config import ENTROPY_EPS, LOW_CONFIDENCE, DriftThresholds
from ..operators.drift import CONDITIONS, drift_flags


def stream_daily_drift(
    log: DataFrame, thresholds: DriftThresholds = DriftThresholds(), delay: str = "1 hour"
) -> DataFrame:
    """Daily figures and flags, one row per day once the watermark has passed its end.

    State holds one row per day and topic; the second aggregation folds the topics of a closed day.
    Rows later than the watermark are dropped.
    """
    timed = log.withColumn("predicted_at", F.col("predicted_at").cast("timestamp")).withWatermark("predicted_at", delay)
    p = F.col("probability")
    cells = timed.groupBy(F.window("predicted_at", "1 day"), "topic_id").agg(
        F.count("*").alias("n"), F.count("probability").alias("np"), F.sum("probability").alias("sp"),
        F.count_if(p < LOW_CONFIDENCE).alias("low"),
    )
    known = F.col("topic_id").isNotNull()
    days = cells.groupBy(F.window(F.window_time("window"), "1 day").alias("w")).agg(
        F.sum("sp").alias("sp"), F.sum("np").alias("np"), F.sum("low").alias("low"), F.sum("n").alias("n"),
        F.sum(F.when(~known | (F.col("topic_id") < 0), F.col("n")).otherwise(0)).alias("noise_rows"),
        F.collect_list(F.when(known, F.col("n"))).alias("counts"),  # one number per topic
    )
    total = F.aggregate("counts", F.lit(0).cast("long"), lambda s, v: s + v)
    share = lambda v: v / F.col("t")
    entropy = F.aggregate("counts", F.lit(0.0), lambda s, v: s - share(v) * F.log2(share(v) + ENTROPY_EPS))
    return days.withColumn("t", total).select(
        F.to_date("w.start").alias("day"),
        F.coalesce(F.try_divide("sp", "np"), F.lit(0.0)).alias("avg_probability"),
        F.coalesce(F.try_divide("low", "np"), F.lit(0.0)).alias("low_confidence_ratio"),
        F.try_divide("noise_rows", "n").alias("noise_ratio_inference"),
        entropy.alias("topic_entropy"), F.col("n").alias("total_predictions"),
    ).select("*", *drift_flags(thresholds))


def stream_drift_streaks(flags: DataFrame, window_days: int = 3, calendar: bool = False, late_days: int = 0) -> DataFrame:
    """One row per condition when its first streak of ``window_days`` violating days completes.

    ``flags`` is a stream of closed days (the output table of :func:`stream_daily_drift`). A day counts once a day
    ``late_days`` after it has been seen; until then it waits in the state, and days that come in any order take their
    places. So the result equals the batch operator's over the days that count, whatever the order and the micro-batches,
    as long as no day is later than that. A day that is later still is left out; of a repeated day the first row counts.
    The state of a condition is its current run, its start, the last day that counted, whether it has fired, and the
    days that wait: at most ``late_days`` of them between micro-batches.
    """
    names = F.array(*[F.struct(F.lit(c).alias("condition"), F.col(c).alias("hit")) for c in CONDITIONS])
    long = flags.select("day", F.explode(names).alias("c")).select("c.condition", "day", "c.hit")

    def follow(key: tuple[str], frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        run, start, last, fired, days, hits = state.get if state.exists else (0, None, None, False, [], [])
        waiting = dict(zip(days, hits))
        for frame in frames:
            for day, hit in zip(frame["day"], frame["hit"]):
                if last is None or day > last:
                    waiting.setdefault(day, bool(hit))
        settled = max(waiting) - timedelta(days=late_days) if waiting else date.min
        out = []
        for day in sorted(d for d in waiting if d <= settled):
            hit = waiting.pop(day)
            gap = calendar and last is not None and day - last > timedelta(days=1)
            if gap or not hit:
                run, start = 0, None
            if hit:
                run, start = run + 1, start or day
                if run >= window_days and not fired:
                    fired = True
                    out.append((key[0], start, window_days))
            last = day
        state.update((run, start, last, fired, list(waiting), list(waiting.values())))
        yield pd.DataFrame(out, columns=["condition", "start_day", "length"])

    return long.groupBy("condition").applyInPandasWithState(
        follow, "condition string, start_day date, length int",
        "run int, start date, last date, fired boolean, days array<date>, hits array<boolean>", "append", GroupStateTimeout.NoTimeout,
    )
