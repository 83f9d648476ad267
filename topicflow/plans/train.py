"""The whole training run: posts in; a model, its evolution, its labels and its validation out."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import ClusterParams, EvolutionThresholds, OutlierThresholds, RingConfig, ValidationThresholds
from ..operators.drift import validation_gates
from ..operators.embeddings import embed_texts
from ..operators.evolution import best_matches, border_pairs, candidate_pairs, cold_start_evolution, evolution_taxonomy, match_topics
from ..operators.labeling import distance_to_centroid, inherited_labels, label_evolution_fill, label_prompts, label_topics, ring_boundaries, ring_samples
from ..operators.preprocess import preprocess_posts
from ..session import materialize
from .fit import TopicModel, fit_topics, reduce_noise

ANSWERS = "topic int, payload string"
VERDICTS = "new_topic int, old_topic int, same_topic boolean, confidence string"
OLD_LABELS = "Topic string, l1 string, l2 string, l3 string, is_heterogeneous string, coverage string"


@dataclass(frozen=True)
class Production:
    """What the run needs of the model in use: its centroids, words, label table and metrics."""

    centroids: DataFrame
    words: DataFrame
    labels: DataFrame
    metrics: DataFrame


@dataclass(frozen=True)
class TrainingRun:
    """``border`` are the pairs a judge should see and ``prompts`` the texts for a labeller; both may be answered and passed in again."""

    model: TopicModel
    reassigned: DataFrame
    border: DataFrame
    records: DataFrame
    prompts: DataFrame
    labels: DataFrame
    gates: DataFrame

    def save(self, path: str) -> None:
        """All tables below ``path``, the model in a folder of its own."""
        self.model.save(f"{path}/model")
        for field in fields(self):
            if field.name != "model":
                getattr(self, field.name).write.mode("errorifexists").parquet(f"{path}/{field.name}")


def train(
    posts: DataFrame, params: ClusterParams, production: Production | None = None, embedding_changed: bool = False,
    embed: Callable[[DataFrame], DataFrame] = embed_texts, lemmas: DataFrame | None = None,
    verdicts: DataFrame | None = None, answers: DataFrame | None = None, outliers: OutlierThresholds = OutlierThresholds(),
    evolution: EvolutionThresholds = EvolutionThresholds(), rings: RingConfig = RingConfig(), gates: ValidationThresholds = ValidationThresholds(),
) -> TrainingRun:
    """Preprocess, embed, cluster, move noise, match with production, sample and label, validate.

    ``posts`` has post_id, channel, created_at and text; ``embed`` maps (doc_id, text) to (doc_id, embedding). Verdicts on
    border pairs and answers of a labeller are tables; without them border pairs count as different and new topics stay unlabelled. Without a
    production model, or when its embeddings differ, every topic is new.
    """
    spark = posts.sparkSession
    empty = lambda schema: spark.createDataFrame([], schema)
    prep = materialize(preprocess_posts(posts, lemmas), "prep")
    docs = prep.withColumnRenamed("post_id", "doc_id")
    emb = materialize(embed(docs.select("doc_id", F.col("text_clean").alias("text"))), "embeddings")
    first = fit_topics(docs, emb, params)
    model, reassigned = reduce_noise(first, docs, emb, outliers)
    if production is None or embedding_changed:
        border = empty(VERDICTS).select("new_topic", "old_topic")
        records = cold_start_evolution(model.info, "cold_start" if production is None else "embedding_changed").drop("reason")
        old = empty(OLD_LABELS)
    else:
        pairs = materialize(candidate_pairs(model.centroids, production.centroids, model.words, production.words, evolution), "pairs")
        best = best_matches(pairs)
        border = border_pairs(best, evolution)
        records = evolution_taxonomy(match_topics(best, verdicts if verdicts is not None else empty(VERDICTS), evolution))
        old = production.labels
    records = materialize(records, "records")
    distances = materialize(distance_to_centroid(emb, model.topics, model.centroids), "distances")
    row = ring_boundaries(distances, rings).first()
    bounds = (row["q_low"] or 0.0, row["q_high"] or 0.0)
    samples = materialize(ring_samples(distances, docs.select("doc_id", "text_clean"), bounds), "samples")
    external = answers if answers is not None else empty(ANSWERS)
    labels = label_topics(model.info, samples, external, inherited_labels(old), records, bounds)
    checked = validation_gates(model.metrics, None if production is None else production.metrics, embedding_changed, gates)
    return TrainingRun(
        model, reassigned, border, records, label_prompts(model.words, samples),
        materialize(label_evolution_fill(labels, records), "labels"), materialize(checked, "gates"),
    )
