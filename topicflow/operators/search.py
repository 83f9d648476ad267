"""Experiment tables: ranking runs, progress, influence of parameters, the choice of a configuration.

Every function takes ``by``: one study (slice, model family) per key, many studies per job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import FAILED_SCORE, NOISE_PENALTY
from ..functions.scale import running_max, top_k_per_group

PARAMETERS = ("n_neighbors", "n_components", "min_cluster_size", "min_samples")


def trial_score(dbcv: Column, noise: Column, penalty: float = NOISE_PENALTY) -> Column:
    """DBCV minus the noise penalty; a failed or undefined run scores far below any other."""
    failed = dbcv.isNull() | F.isnan(dbcv) | noise.isNull()
    return F.when(failed, F.lit(FAILED_SCORE)).otherwise(dbcv - penalty * noise)


def rank_trials(trials: DataFrame, k: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """The ``k`` best trials by score, ties by trial id, with their rank."""
    order = [F.desc("score"), F.asc("trial_id")]
    return top_k_per_group(trials, list(by), order, k, "trial_id", "rank")


def best_so_far(trials: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Running maximum of the score in trial order within each study."""
    return running_max(trials.select(*by, "trial_id", "score"), by, "trial_id", "score", "best_score")


def param_importance(trials: DataFrame, by: Sequence[str] = (), params: Sequence[str] = PARAMETERS) -> DataFrame:
    """Absolute correlation of each parameter with the score, and the straight-line fit, ascending."""
    aggs = []
    for p in params:
        x, y = F.col(p).cast("double"), F.col("score").cast("double")
        aggs.append(F.struct(
            F.lit(p).alias("param"), F.abs(F.corr(x, y)).alias("importance"),
            F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
        ).alias(p))
    wide = trials.groupBy(*by).agg(*aggs)
    return wide.select(*by, F.explode(F.array(*params)).alias("r")).select(*by, "r.*").orderBy(*by, "importance", "param")


def select_config(
    configs: DataFrame, coherence_min: float = 0.75, penalty: float = NOISE_PENALTY, min_topics: int = 0,
    by: Sequence[str] = (), baseline: str = "Baseline",
) -> DataFrame:
    """Best coherent configuration by DBCV minus noise penalty; the baseline if none is coherent."""
    coherent = F.col("cv_coherence").isNotNull() & ~F.isnan("cv_coherence") & (F.col("cv_coherence") >= coherence_min)
    usable = coherent & (F.col("label") != baseline) & F.col("dbcv").isNotNull() & ~F.isnan("dbcv")
    if min_topics:
        usable = usable & (F.col("num_topics") >= min_topics)
    score = F.col("dbcv") - penalty * F.col("noise_ratio")
    ranked = F.struct(score.alias("score"), (-F.col("trial_id")).alias("neg"), F.col("label").alias("label"))
    chosen = configs.groupBy(*by).agg(F.max(F.when(usable, ranked)).alias("b"))
    return chosen.select(*by, F.coalesce("b.label", F.lit(baseline)).alias("label"), F.col("b.score").alias("final_score"))
