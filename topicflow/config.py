"""Thresholds and parameters, passed to operators as plain frozen values."""

from __future__ import annotations

from dataclasses import dataclass, replace
from math import floor

# Defaults that must equal the reference's for equal results.
RANDOM_SEED = 42
REFERENCE_CORPUS_SIZE = 300_000
NOISE = -1
MIN_TEXT_LEN = 50
MIN_ALPHA_RATIO = 0.3
LOW_CONFIDENCE = 0.4
FALLBACK_PROBABILITY = 0.3
NOISE_PENALTY = 0.5
FAILED_SCORE = -999.0
ENTROPY_EPS = 1e-10
RING_NAMES = ("Ядро", "Основная", "Периферия")
ZONE_NOISE = "Шум"
LABEL_UNCLASSIFIED = "Неклассифицировано"
LABEL_MISSING = "Нет метки"
PERIPHERY_MARK = " [периферия гетерогенного кластера]"
WEIGHT_GRID = ((1.0, 0.0), (0.7, 0.3), (0.5, 0.5), (0.3, 0.7), (0.0, 1.0))
CURVE_THRESHOLDS = (0.4, 0.5, 0.6, 0.7, 0.8, 0.9)
ABLATION_THRESHOLDS = tuple(i / 100 for i in range(0, 100, 5))
SEASONS = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "autumn": (9, 10, 11)}


@dataclass(frozen=True)
class EvolutionThresholds:
    cosine_high: float = 0.7
    cosine_low: float = 0.4
    cosine_weight: float = 0.7
    jaccard_weight: float = 0.3
    top_words: int = 10


@dataclass(frozen=True)
class ValidationThresholds:
    dbcv_min_relative: float = 0.95
    coherence_min: float = 0.70
    noise_max: float = 0.20
    topics_min: int = 20


@dataclass(frozen=True)
class DriftThresholds:
    avg_probability_min: float = 0.50
    low_confidence_max: float = 0.30
    noise_max: float = 0.35
    window_days: int = 3


@dataclass(frozen=True)
class OutlierThresholds:
    ctfidf: float = 0.40
    embedding: float = 0.60


@dataclass(frozen=True)
class RingConfig:
    quantiles: tuple[float, float] = (0.25, 0.60)
    sizes: tuple[int, int, int] = (5, 3, 2)
    per_topic: int = 200


@dataclass(frozen=True)
class ClusterParams:
    min_cluster_size: int = 53
    min_samples: int = 146
    n_components: int = 12
    eps: float | None = None
    method: str = "cut"  # or "hierarchy"

    def scaled(self, corpus_size: int, reference_size: int = REFERENCE_CORPUS_SIZE) -> "ClusterParams":
        """Sizes follow the corpus: floor(v * corpus / reference), at least 10 and 5."""
        share = corpus_size / reference_size
        return replace(
            self, min_cluster_size=max(10, floor(self.min_cluster_size * share)), min_samples=max(5, floor(self.min_samples * share))
        )

    def for_heterogeneous(self) -> "ClusterParams":
        """Smaller clusters for topics whose core and periphery disagree."""
        return replace(self, min_cluster_size=max(10, floor(0.7 * self.min_cluster_size)))
