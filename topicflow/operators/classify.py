"""Classifying new documents against a fitted model."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import FALLBACK_PROBABILITY, LABEL_MISSING, LABEL_UNCLASSIFIED, NOISE, PERIPHERY_MARK, ZONE_NOISE
from ..functions.text import is_valid_input, label_depth
from ..functions.vectors import cosine_distance
from ..session import materialize
from .labeling import assign_ring, ring_name
from .neighbours import nearest
from .topics import topic_words_row


@dataclass(frozen=True)
class TopicReference:
    """What classification needs of a model; all tables keyed by topic or document."""

    centroids: DataFrame  # topic, centroid
    labels: DataFrame  # topic, l1, l2, l3, core_topic, periphery_topic, heterogeneous
    words: DataFrame  # topic, rank, word
    bounds: tuple[float, float]
    points: DataFrame | None = None  # doc_id, embedding, topic, core: clustered training documents


def soft_assign(emb: DataFrame, centroids: DataFrame, key: str = "doc_id", **options: int) -> DataFrame:
    """Nearest real centroid; probability = 1 - cosine distance."""
    real = centroids.where(F.col("topic") != NOISE)
    found = nearest(emb, real, 1, key, "topic", "embedding", "centroid", **options)
    return found.select(F.col("qid").alias(key), F.col("iid").cast("int").alias("topic"), F.col("sim").alias("probability"))


def cluster_assign(emb: DataFrame, points: DataFrame, key: str = "doc_id", exclude_self: bool = False, **options: int) -> DataFrame:
    """Topic of the nearest clustered training document, when it lies within that document's core distance.

    Probability falls from 1 at the training document to 0 at its core distance; beyond it the
    topic is -1.
    """
    found = nearest(emb, points, 1, key, "doc_id", exclude_self=exclude_self, **options)
    known = points.select(F.col("doc_id").alias("iid"), "topic", "core")
    distance = F.round(1 - F.col("sim"), 10)
    inside = distance <= F.col("core")
    share = F.coalesce(1 - F.try_divide(distance, F.col("core")), F.lit(1.0))
    return found.join(known, "iid").select(
        F.col("qid").alias(key), F.when(inside, F.col("topic")).otherwise(NOISE).alias("topic"),
        F.when(inside, F.round(share, 10)).otherwise(0.0).alias("probability"),
    )


def choose_assignment(
    docs: DataFrame, clustered: DataFrame | None, soft: DataFrame, threshold: float = FALLBACK_PROBABILITY, key: str = "doc_id"
) -> DataFrame:
    """The clusterer's answer, or the nearest centroid where that answer is noise or too uncertain."""
    near = soft.select(key, F.col("topic").alias("st"), F.col("probability").alias("sp"))
    if clustered is None:
        joined = docs.join(near, key, "left").withColumn("ct", F.lit(None).cast("int")).withColumn("cp", F.lit(None).cast("double"))
    else:
        first = clustered.select(key, F.col("topic").alias("ct"), F.col("probability").alias("cp"))
        joined = docs.join(first, key, "left").join(near, key, "left")
    weak = F.col("ct").isNull() | (F.col("ct") == NOISE) | (F.col("cp") < threshold)
    return joined.select(
        *docs.columns, F.when(weak, F.col("st")).otherwise(F.col("ct")).alias("topic_id"),
        F.when(weak, F.col("sp")).otherwise(F.col("cp")).alias("probability"),
        F.when(weak, "soft_assign").otherwise("hdbscan").alias("assignment_method"),
    )


def assign_topic(
    emb: DataFrame, model: TopicReference, threshold: float = FALLBACK_PROBABILITY, key: str = "doc_id",
    exclude_self: bool = False, **options: int,
) -> DataFrame:
    clustered = None if model.points is None else cluster_assign(emb, model.points, key, exclude_self, **options)
    return choose_assignment(emb.select(key), clustered, soft_assign(emb, model.centroids, key, **options), threshold, key)


def zone_label(ring: Column, label: Column) -> Column:
    """Three levels in the core, two in the main ring, one on the periphery."""
    part = lambda c: F.coalesce(label[c], F.lit(""))
    mixed = F.coalesce(label["heterogeneous"], F.lit(False)) & (part("periphery_topic") != "")
    outer = F.when(mixed, F.concat(part("l1"), F.lit(PERIPHERY_MARK))).otherwise(part("l1"))
    named = (
        F.when(ring == 1, F.concat_ws(" -> ", part("l1"), part("l2"), part("l3")))
        .when(ring == 2, F.concat_ws(" -> ", part("l1"), part("l2")))
        .otherwise(outer)
    )
    return F.when(label.isNull(), F.lit(LABEL_MISSING)).otherwise(named)


_LABEL_FIELDS = ("l1", "l2", "l3", "core_topic", "periphery_topic", "heterogeneous")


def label_by_zone(rows: DataFrame, labels: DataFrame, topic: str = "topic_id", ring: str = "ring") -> DataFrame:
    """``rows`` with the label their ring allows."""
    packed = labels.select(F.col("topic").alias(topic), F.struct(*_LABEL_FIELDS).alias("__l"))
    joined = rows.join(packed, topic, "left")
    return joined.withColumn("label", zone_label(F.col(ring), F.col("__l"))).drop("__l")


def describe_assignment(assigned: DataFrame, model: TopicReference, key: str = "doc_id") -> DataFrame:
    """Zone, label and confidence of assigned documents.

    ``assigned``: key, valid, embedding, topic_id, probability, assignment_method. Works on a stream
    as well: the model tables are joined as static tables.
    """
    names = topic_words_row(model.words, 6).select(F.col("topic").alias("topic_id"), "words")
    packed = model.labels.select(F.col("topic").alias("topic_id"), F.struct(*_LABEL_FIELDS).alias("l"))
    about = model.centroids.select(F.col("topic").alias("topic_id"), "centroid").join(packed, "topic_id", "left").join(names, "topic_id", "left")
    joined = assigned.join(about, "topic_id", "left")
    distance = F.round(cosine_distance(F.col("embedding"), F.col("centroid")), 10)
    measured = joined.withColumn("d", distance)
    ring = assign_ring(F.col("d"), *model.bounds, open_end=True)
    measured = measured.withColumn("ring", ring)
    ok = F.col("valid") & F.col("topic_id").isNotNull()
    confidence = F.round(F.col("probability") * (1 - F.least("d", F.lit(1.0))), 3)
    no_words = F.array().cast("array<string>")
    text = lambda c: F.when(ok, F.coalesce(F.col(f"l.{c}"), F.lit(""))).otherwise("")
    return measured.select(
        key,
        F.when(ok, F.col("topic_id")).otherwise(NOISE).alias("topic_id"),
        F.when(ok, F.round("probability", 3)).otherwise(0.0).alias("hdbscan_prob"),
        F.when(ok, F.round("d", 3)).alias("cosine_dist"),
        F.when(ok, ring_name(F.col("ring"))).otherwise(ZONE_NOISE).alias("zone"),
        F.when(ok, F.concat(F.lit("ring_"), F.col("ring").cast("string"))).alias("ring_key"),
        F.when(ok, zone_label(F.col("ring"), F.col("l"))).otherwise(LABEL_UNCLASSIFIED).alias("label"),
        F.when(ok & F.col("l").isNotNull(), F.coalesce("words", no_words)).otherwise(no_words).alias("top_words"),
        text("core_topic").alias("core_topic"), text("periphery_topic").alias("periphery_topic"),
        (ok & F.coalesce("l.heterogeneous", F.lit(False))).alias("heterogeneous"),
        F.when(ok, confidence).otherwise(0.0).alias("confidence"),
        F.when(ok, F.col("assignment_method")).otherwise("invalid").alias("assignment_method"),
    )


def classify_documents(
    docs: DataFrame, emb: DataFrame, model: TopicReference, text: str = "text", key: str = "doc_id",
    threshold: float = FALLBACK_PROBABILITY, exclude_self: bool = False, written: bool = True,
) -> DataFrame:
    """Topic, zone, label and confidence per document; unusable texts are noise with confidence 0.

    Which texts are usable is written once for both searches and the result; with ``written=False`` each checks the texts
    again and no table is left, for the many small batches of a stream.
    """
    once = materialize if written else lambda df, name: df
    checked = once(docs.select(key, is_valid_input(F.col(text)).alias("valid")), "checked")
    usable = once(emb.join(checked.where("valid").select(key), key, "left_semi"), "usable")
    chosen = assign_topic(usable, model, threshold, key, exclude_self)
    joined = checked.join(usable.select(key, "embedding"), key, "left").join(chosen, key, "left")
    return describe_assignment(joined, model, key)


def zone_summary(classified: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Mean label depth, mean confidence and count per zone, with the mean confidence outside noise."""
    per_zone = classified.groupBy(*by, "zone").agg(
        F.avg(label_depth(F.col("label"))).alias("mean_depth"), F.avg("confidence").alias("mean_confidence"), F.count("*").alias("docs")
    )
    zones = Window.partitionBy(*(by or [F.lit(1)]))  # four zones
    real = F.col("zone") != ZONE_NOISE
    total = F.sum(F.when(real, F.col("mean_confidence") * F.col("docs"))).over(zones)
    count = F.sum(F.when(real, F.col("docs"))).over(zones)
    return per_zone.withColumn("mean_confidence_without_noise", F.try_divide(total, count))


def label_counts(classified: DataFrame, label: str = "label") -> DataFrame:
    return classified.groupBy(label).agg(F.count("*").alias("docs")).orderBy(F.desc("docs"), label)
