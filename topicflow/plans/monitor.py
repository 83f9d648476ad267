"""Monitoring: a prediction log in, drift figures and the decision to retrain out."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame

from ..config import DriftThresholds
from ..operators.drift import daily_drift_flags, drift_metrics, drift_streaks, drift_trigger, retrain_window
from ..session import materialize
from ..sources.inference_log import read_inference_log


@dataclass(frozen=True)
class MonitorReport:
    metrics: DataFrame
    days: DataFrame
    streaks: DataFrame
    trigger: DataFrame


def monitor(log: DataFrame, now: datetime, thresholds: DriftThresholds = DriftThresholds(), days: int | None = None) -> MonitorReport:
    """Figures of the window, per-day flags, streaks and the trigger."""
    recent = read_inference_log(log, now, days or thresholds.window_days)
    flags = materialize(daily_drift_flags(recent, thresholds), "flags")
    return MonitorReport(
        drift_metrics(recent), flags, drift_streaks(flags, thresholds.window_days), drift_trigger(recent, thresholds)
    )


def posts_for_retraining(posts: DataFrame, report: MonitorReport, now: datetime, days: int = 180, latest: int = 0) -> DataFrame:
    return retrain_window(posts, report.trigger, now, days, latest)
