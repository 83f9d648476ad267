"""Finding topics: fewer dimensions, a density graph, its connected parts."""

from __future__ import annotations

from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import NOISE
from ..functions.graph import connected_components
from ..functions.scale import exact_quantile
from ..session import materialize
from .neighbours import knn_cosine


def reduce_dims(emb: DataFrame, k: int, key: str = "doc_id") -> DataFrame:
    """Principal components of unit vectors; only the d x d covariance reaches the driver.

    A linear method takes the place of a neighbour embedding, so coordinates are not comparable.
    """
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda s, v: s + v * v))
    scaled = F.transform("embedding", lambda v: F.coalesce(F.try_divide(v.cast("double"), norm), F.lit(0.0)))
    vectors = emb.select(key, array_to_vector(scaled).alias("v"))
    model = PCA(k=k, inputCol="v", outputCol="p").fit(vectors)
    return model.transform(vectors).select(key, vector_to_array("p").alias("embedding"))


def core_distances(knn: DataFrame, m: int, key: str = "doc_id") -> DataFrame:
    """Distance to the m-th neighbour; documents with fewer neighbours have none."""
    return knn.where(F.col("rank") == m).select(key, F.round(1 - F.col("similarity"), 10).alias("core"))


def mutual_reachability(knn: DataFrame, m: int, key: str = "doc_id") -> DataFrame:
    """``src, dst, distance, reach`` over the neighbour graph: reach = max(core, core, distance)."""
    core = core_distances(knn, m, key)
    edges = knn.select(F.col(key).alias("src"), F.col("neighbour_id").alias("dst"), F.round(1 - F.col("similarity"), 10).alias("distance"))
    side = lambda i, c: core.select(F.col(key).alias(i), F.col("core").alias(c))
    joined = edges.join(side("src", "cs"), "src").join(side("dst", "cd"), "dst")
    return joined.select("src", "dst", "distance", F.greatest("cs", "cd", "distance").alias("reach"))


def density_cluster(
    emb: DataFrame, min_cluster_size: int, min_samples: int, eps: float | None = None, key: str = "doc_id",
    knn: DataFrame | None = None, eps_quantile: float = 0.9, **options: int,
) -> DataFrame:
    """``key, topic``: one density cut of the mutual reachability graph; -1 is noise.

    Documents are linked when their mutual reachability is at most ``eps`` (a quantile of the core
    distances by default). Parts smaller than ``min_cluster_size`` are noise; topics are numbered
    by size. A single cut stands in for a hierarchy over all densities.
    """
    if knn is None:
        knn = materialize(knn_cosine(emb, min_samples, key, **options), "knn")
    if eps is None:
        eps = exact_quantile(core_distances(knn, min_samples, key), "core", eps_quantile) or 0.0
    linked = mutual_reachability(knn, min_samples, key).where(F.col("reach") <= F.lit(eps))
    parts = connected_components(linked)
    sizes = parts.groupBy("component").agg(F.count("*").alias("n")).where(F.col("n") >= min_cluster_size)
    order = Window.partitionBy(F.lit(1)).orderBy(F.desc("n"), "component")  # clusters, not documents
    numbered = sizes.withColumn("topic", (F.row_number().over(order) - 1).cast("int")).select("component", "topic")
    found = parts.join(numbered, "component").select(F.col("id").alias(key), "topic")
    return emb.select(key).join(found, key, "left").select(key, F.coalesce("topic", F.lit(NOISE)).alias("topic"))
