"""Training: vectors and texts in, a topic model as a bundle of tables out."""

from __future__ import annotations

import random
from collections.abc import Mapping
from dataclasses import dataclass, fields

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import NOISE, RANDOM_SEED, ClusterParams, OutlierThresholds
from ..functions.scale import side_by_side
from ..operators.clustering import core_distances, density_cluster, reduce_dims
from ..operators.hierarchy import density_hierarchy
from ..operators.neighbours import knn_cosine
from ..operators.outliers import reassignment_report, reduce_outliers_ctfidf, reduce_outliers_embedding
from ..operators.quality import dbcv, model_metrics
from ..operators.search import trial_score
from ..operators.topics import describe_topics, noise_ratio, topic_centroids, topic_info
from ..session import materialize

# Ranges of the parameter search.
SEARCH_SPACE = {
    "n_components": (5, 15),
    "min_cluster_size": (50, 200),
    "min_samples": (5, 150),
}
FEW_TOPICS = 20
HIGH_NOISE = 0.80


@dataclass(frozen=True)
class TopicModel:
    """Tables of a fitted model; ``vectors`` are the reduced ones."""

    topics: DataFrame
    vectors: DataFrame
    ctfidf: DataFrame
    words: DataFrame
    centroids: DataFrame
    info: DataFrame
    metrics: DataFrame

    def save(self, path: str) -> None:
        for field in fields(self):
            getattr(self, field.name).write.mode("errorifexists").parquet(f"{path}/{field.name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> "TopicModel":
        return cls(**{f.name: spark.read.parquet(f"{path}/{f.name}") for f in fields(cls)})


def describe_model(
    docs: DataFrame, emb: DataFrame, topics: DataFrame, vectors: DataFrame, top_n: int = 10, text: str = "text_lemm",
    centroids: DataFrame | None = None, sample: int = 0,
) -> TopicModel:
    """Everything that follows from an assignment."""
    scores, words = describe_topics(docs, topics, text, top_n)
    scores, words = materialize(scores, "ctfidf"), materialize(words, "words")
    if centroids is None:
        centroids = materialize(topic_centroids(emb, topics), "centroids")
    metrics = model_metrics(topics, words, docs, vectors, sample=sample, text=text)
    warned = metrics.withColumn("few_topics", F.col("num_topics") < FEW_TOPICS).withColumn(
        "high_noise", F.col("noise_ratio") > HIGH_NOISE
    )
    return TopicModel(topics, vectors, scores, words, centroids, topic_info(topics, words), materialize(warned, "metrics"))


def fit_assignment(emb: DataFrame, params: ClusterParams, key: str = "doc_id") -> tuple[DataFrame, DataFrame]:
    """(reduced vectors, assignment) for one parameter set, by one density cut or by the density hierarchy."""
    reduced = materialize(reduce_dims(emb, params.n_components, key), "reduced")
    if params.method == "hierarchy":
        return reduced, density_hierarchy(reduced, params.min_cluster_size, params.min_samples, key).topics.select(key, "topic")
    return reduced, materialize(density_cluster(reduced, params.min_cluster_size, params.min_samples, params.eps, key), "topics")


def fit_topics(
    docs: DataFrame, emb: DataFrame, params: ClusterParams, top_n: int = 10, text: str = "text_lemm", sample: int = 0
) -> TopicModel:
    """Reduce, cluster, describe and measure. ``docs``: doc_id and text; ``emb``: doc_id, embedding."""
    reduced, topics = fit_assignment(emb, params)
    return describe_model(docs, emb, topics, reduced, top_n, text, sample=sample)


def reduce_noise(
    model: TopicModel, docs: DataFrame, emb: DataFrame, thresholds: OutlierThresholds = OutlierThresholds(),
    text: str = "text_lemm", recompute_centroids: bool = False,
) -> tuple[TopicModel, DataFrame]:
    """Two-step noise reduction, the model described anew, and the report of what moved.

    Centroids stay those of the first assignment unless ``recompute_centroids`` is set.
    """
    first = materialize(reduce_outliers_ctfidf(docs, model.topics, model.ctfidf, thresholds.ctfidf, text), "step1")
    second = materialize(reduce_outliers_embedding(emb, first, model.centroids, thresholds.embedding), "step2")
    kept = None if recompute_centroids else model.centroids
    after = describe_model(docs, emb, second, model.vectors, text=text, centroids=kept)
    return after, reassignment_report(model.topics, first, second)


def training_points(emb: DataFrame, topics: DataFrame, min_samples: int) -> DataFrame:
    """Clustered training documents with their core distance, for classifying new documents."""
    core = core_distances(knn_cosine(emb, min_samples), min_samples)
    real = topics.where(F.col("topic") != NOISE)
    return emb.select("doc_id", "embedding").join(real.select("doc_id", "topic"), "doc_id").join(core, "doc_id")


def search_trials(
    emb: DataFrame, n: int = 10, space: Mapping[str, tuple[int, int]] = SEARCH_SPACE, seed: int = RANDOM_SEED,
    min_topics: int = 2, study: str = "study", cap: int | None = None,
) -> DataFrame:
    """Seeded random search over clustering parameters: one row per trial.

    The neighbour graph is computed once per number of components, at the largest ``min_samples``
    drawn for it. The objective rewards two clean clusters above all, so trials with fewer than
    ``min_topics`` topics count as failed. A trial that raises is recorded with the failing score and its error
    and the search goes on. The result is one row of numbers per trial.
    """
    spark = emb.sparkSession
    draw = random.Random(seed)
    trials = [{p: draw.randint(low, high) for p, (low, high) in space.items()} for _ in range(n)]
    graphs: dict[int, tuple[DataFrame, DataFrame]] = {}
    for components in sorted({t["n_components"] for t in trials}):
        deepest = max(t["min_samples"] for t in trials if t["n_components"] == components)
        reduced = materialize(reduce_dims(emb, components), "reduced")
        graphs[components] = (reduced, materialize(knn_cosine(reduced, deepest), "knn"))
    rows = []
    for number, trial in enumerate(trials):
        try:
            found = (*_tried(*graphs[trial["n_components"]], trial, cap), None)
        except Exception as error:  # noqa: BLE001  whatever ends a trial must not end the search
            found = (None, None, None, f"{type(error).__name__}: {error}"[:200])
        rows.append((study, number, *trial.values(), *found))
    kinds = ", ".join(f"{p} int" for p in space)
    table = spark.createDataFrame(rows, f"study string, trial_id int, {kinds}, noise_ratio double, n_clusters long, dbcv double, error string")
    scored = F.when(F.col("n_clusters") >= min_topics, F.col("dbcv"))
    return table.withColumn("score", trial_score(scored, F.col("noise_ratio")))


def _tried(reduced: DataFrame, knn: DataFrame, trial: Mapping[str, int], cap: int | None) -> tuple[float, int, float]:
    """Noise, number of topics and DBCV of one trial."""
    near = knn.where(F.col("rank") <= trial["min_samples"])
    topics = materialize(density_cluster(reduced, trial["min_cluster_size"], trial["min_samples"], knn=near), "topics")
    noise = noise_ratio(topics).select("noise_ratio", F.col("num_topics").alias("n_clusters"))
    row = side_by_side([noise, dbcv(reduced, topics, cap).select(F.col("dbcv_score").alias("dbcv"))]).first()
    return row["noise_ratio"], row["n_clusters"], row["dbcv"]

