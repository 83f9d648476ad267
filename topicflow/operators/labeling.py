"""Distance rings around topic centroids, samples for labelling, and label tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import NOISE, RANDOM_SEED, RING_NAMES, RingConfig
from ..functions.scale import hash_key, top_k_per_group
from ..functions.text import parse_label_json
from ..functions.vectors import cosine_distance
from .profiling import length_histogram
from .sampling import cap_per_group
from .topics import topic_words_row

_DEFAULTS = RingConfig()

# Layout of the ring section of a labelling request.
RULE = "─" * 45
RING_HEADER = "\n" + RULE + "\n%s (%d документов):\n"
DOC_LINE = "  • %s\n"


def distance_to_centroid(
    emb: DataFrame, topics: DataFrame, centroids: DataFrame, key: str = "doc_id", by: Sequence[str] = ()
) -> DataFrame:
    """Cosine distance of each document to the centroid of its topic, noise left out."""
    real = topics.where(F.col("topic") != NOISE)
    joined = emb.select(key, *by, "embedding").join(real.select(key, "topic"), key)
    joined = joined.join(centroids.select(*by, "topic", "centroid"), [*by, "topic"])
    distance = F.round(cosine_distance(F.col("embedding"), F.col("centroid")), 10)
    return joined.select(key, *by, "topic", distance.alias("distance"))


def ring_boundaries(
    distances: DataFrame, config: RingConfig = _DEFAULTS, key: str = "doc_id", by: Sequence[str] = (), seed: int = RANDOM_SEED
) -> DataFrame:
    """Two linear quantiles of the pooled distances, at most ``per_topic`` documents per topic.

    Topics with a single document are skipped.
    """
    sizes = distances.groupBy(*by, "topic").agg(F.count("*").alias("n")).where("n >= 2").drop("n")
    pooled = distances.join(sizes, [*by, "topic"], "left_semi")
    capped = cap_per_group(pooled, [*by, "topic"], config.per_topic, key, seed)
    low, high = config.quantiles
    return capped.groupBy(*by).agg(F.percentile("distance", low).alias("q_low"), F.percentile("distance", high).alias("q_high"))


def assign_ring(distance: Column, q_low: Column | float, q_high: Column | float, open_end: bool = False) -> Column:
    """Ring 1, 2 or 3. Beyond distance 1 a document is in no ring, or in the last if ``open_end``."""
    lit = lambda v: v if isinstance(v, Column) else F.lit(v)
    ring = F.when((distance >= 0) & (distance < lit(q_low)), 1).when((distance >= lit(q_low)) & (distance < lit(q_high)), 2)
    if open_end:
        return F.when(distance.isNotNull(), F.coalesce(ring, F.lit(3)))
    return ring.when((distance >= lit(q_high)) & (distance < 1), 3)


def ring_name(ring: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in RING_NAMES]), ring)


def ring_samples(
    distances: DataFrame, docs: DataFrame, bounds: tuple[Column | float, Column | float], config: RingConfig = _DEFAULTS,
    key: str = "doc_id", text: str = "text_clean", seed: int = RANDOM_SEED, by: Sequence[str] = (),
) -> DataFrame:
    """``topic, ring, name, total_docs, sample_docs`` for every ring that has documents.

    ``bounds`` are two numbers, or two columns of ``distances`` when every slice has its own.
    """
    ringed = distances.withColumn("ring", assign_ring(F.col("distance"), *bounds)).where("ring IS NOT NULL")
    totals = ringed.groupBy(*by, "topic", "ring").agg(F.count("*").alias("total_docs"))
    hashed = ringed.withColumn("__h", hash_key(key, seed))
    drawn = top_k_per_group(hashed, [*by, "topic", "ring"], [F.col("__h"), F.col(key)], max(config.sizes), key, "place")
    wanted = F.element_at(F.array(*[F.lit(n) for n in config.sizes]), F.col("ring"))
    drawn = drawn.where(F.col("place") <= wanted).join(docs.select(key, F.col(text).alias("doc")), key)
    lists = drawn.groupBy(*by, "topic", "ring").agg(F.sort_array(F.collect_list(F.struct("place", key, "doc"))).alias("s"))
    joined = totals.join(lists, [*by, "topic", "ring"], "left")
    empty = F.array().cast("array<string>")
    return joined.select(
        *by, "topic", "ring", ring_name(F.col("ring")).alias("name"), "total_docs",
        F.coalesce(F.col(f"s.{key}"), F.array().cast("array<long>")).alias("sample_ids"),
        F.coalesce(F.col("s.doc"), empty).alias("sample_docs"),
    )


def label_prompts(
    words: DataFrame, samples: DataFrame, n_words: int = 15, doc_chars: int = 200, by: Sequence[str] = ()
) -> DataFrame:
    """Per topic: its key words and the ring section, ready for an external model."""
    lines = F.transform("sample_docs", lambda d: F.format_string(DOC_LINE, F.substring(d, 1, doc_chars)))
    section = F.concat(F.format_string(RING_HEADER, F.upper("name"), F.col("total_docs")), F.array_join(lines, ""))
    rings = samples.groupBy(*by, "topic").agg(F.sort_array(F.collect_list(F.struct("ring", section.alias("s")))).alias("r"))
    keyed = topic_words_row(words, n_words, by).select(*by, "topic", F.array_join("words", ", ").alias("keywords"))
    joined = keyed.where(F.col("topic") != NOISE).join(rings, [*by, "topic"], "left")
    return joined.select(*by, "topic", "keywords", F.coalesce(F.array_join("r.s", ""), F.lit("")).alias("rings"))


def inherited_labels(table: DataFrame) -> DataFrame:
    """Label rows of an older model, typed; an unknown coverage stays null."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c)
    flag = F.coalesce(F.col("is_heterogeneous").try_cast("boolean"), F.lit(False))
    return table.select(
        F.col("Topic").cast("int").alias("topic"), text("l1"), text("l2"), text("l3"),
        flag.alias("heterogeneous"), F.col("coverage").try_cast("double").alias("coverage"),
    )


def label_topics(
    info: DataFrame, samples: DataFrame, external: DataFrame, inherited: DataFrame, records: DataFrame,
    bounds: tuple[float, float], compat: bool = False,
) -> DataFrame:
    """The label table: inherited labels for stable topics, parsed external answers for the rest.

    Older labels are keyed by the old topic id, so they are looked up by the matched old topic;
    ``compat=True`` looks them up by the new id.
    """
    real = info.where(F.col("topic") != NOISE).select("topic", "count")
    stable = records.where((F.col("evolution_type") == "Stable") & F.col("new_topic_id").isNotNull())
    source = F.col("new_topic_id") if compat else F.col("matched_old_topic_id")
    stable = stable.select(F.col("new_topic_id").alias("topic"), source.alias("source"))
    old = inherited.select(F.col("topic").alias("source"), F.struct(
        "l1", "l2", "l3", F.lit("").alias("core_topic"), F.lit("").alias("periphery_topic"), "heterogeneous", "coverage"
    ).alias("old"))
    answers = external.select("topic", parse_label_json(F.col("payload")).alias("new"))
    error = parse_label_json(F.lit("{}"))
    joined = real.join(stable.join(old, "source").drop("source"), "topic", "left").join(answers, "topic", "left")
    is_old = F.col("old").isNotNull()
    labelled = joined.select(
        "topic", "count", F.when(is_old, "inherited").otherwise("llm").alias("label_source"),
        F.when(is_old, F.col("old")).otherwise(F.coalesce("new", error)).alias("l"),
    )
    rings = samples.groupBy("topic").agg(*[
        F.coalesce(F.sum(F.when(F.col("ring") == r, F.col("total_docs"))), F.lit(0)).alias(f"ring_{r}_count") for r in (1, 2, 3)
    ])
    full = labelled.join(rings, "topic", "left")
    part = lambda c: F.coalesce(F.col(f"l.{c}"), F.lit("")).alias(c)
    human = F.concat_ws(":", *[F.coalesce(F.col(f"l.{c}"), F.lit("")) for c in ("l1", "l2", "l3")])
    low, high = bounds
    calls = F.sum((F.col("label_source") == "llm").cast("int")).over(Window.partitionBy(F.lit(1)).orderBy("topic"))  # topics only
    return full.select(
        F.col("topic").alias("Topic"), human.alias("Human_Label"),
        F.coalesce("l.heterogeneous", F.lit(False)).alias("is_heterogeneous"), F.col("l.coverage").alias("coverage"),
        F.lit(f"{low:.4f},{high:.4f}").alias("zone_boundaries_q25_q60"), "label_source",
        part("l1"), part("l2"), part("l3"), part("core_topic"), part("periphery_topic"), "count",
        *[F.coalesce(f"ring_{r}_count", F.lit(0)).alias(f"ring_{r}_count") for r in (1, 2, 3)], calls.alias("calls"),
    )


def label_evolution_fill(labels: DataFrame, records: DataFrame) -> DataFrame:
    """Evolution type by new topic; topics without a record count as Emerged."""
    known = records.where("new_topic_id IS NOT NULL").select(F.col("new_topic_id").alias("Topic"), "evolution_type")
    base = labels.drop("evolution_type") if "evolution_type" in labels.columns else labels
    return base.join(known, "Topic", "left").withColumn("evolution_type", F.coalesce("evolution_type", F.lit("Emerged")))


def labeling_stats(labels: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return labels.groupBy(*by).agg(
        F.count_if(F.col("label_source") == "llm").alias("labeled_externally"),
        F.count_if(F.col("label_source") == "inherited").alias("inherited"),
        F.count_if("is_heterogeneous").alias("heterogeneous"),
        F.avg("coverage").alias("avg_coverage"),
        F.coalesce(F.max("calls"), F.lit(0)).alias("total_calls"),
    )


def label_examples(labels: DataFrame, per_type: int = 5, total: int = 20) -> DataFrame:
    """The first topics of each evolution type that continues or starts a topic."""
    types = ["Stable", "Emerged", "Split", "Merged"]
    place = F.array_position(F.array(*[F.lit(t) for t in types]), F.col("evolution_type"))
    shown = labels.where(F.col("evolution_type").isin(types))
    ranked = shown.withColumn("rn", F.row_number().over(Window.partitionBy("evolution_type").orderBy("Topic")))
    picked = ranked.where(F.col("rn") <= per_type).orderBy(place, "Topic").limit(total)
    return picked.select("Topic", "Human_Label", "is_heterogeneous", "coverage", "evolution_type")


def label_summary(labels: DataFrame, slice_col: str = "slice") -> DataFrame:
    """Per slice, and per slice and first label level: topics, documents, heterogeneous share, coverage.

    One pass with grouping sets; ``l1`` is null in the rows of a whole slice.
    """
    s = F.col(slice_col)
    grouped = labels.groupingSets([[s], [s, F.col("l1")]], s, F.col("l1"))
    return grouped.agg(
        F.count("*").alias("topics"), F.sum("count").alias("docs"),
        F.avg(F.col("is_heterogeneous").cast("double")).alias("heterogeneous_share"), F.avg("coverage").alias("mean_coverage"),
        (F.grouping("l1") == 1).alias("whole_slice"),
    )


def heterogeneous_topics(labels: DataFrame) -> DataFrame:
    return labels.where("is_heterogeneous").select("Topic", "count", "Human_Label").orderBy(F.desc("count"), "Topic")


def coverage_histogram(labels: DataFrame, slice_col: str = "slice", bins: int = 20) -> DataFrame:
    """Bins of label coverage between 0 and 1 per slice, with the slice's mean."""
    counts = length_histogram(labels, F.col("coverage"), bins, 0.0, 1.0, by=[slice_col])
    means = labels.groupBy(slice_col).agg(F.avg("coverage").alias("mean_coverage"))
    return counts.join(means, slice_col)


def distance_histogram(distances: DataFrame, bins: int = 40, by: Sequence[str] = ()) -> DataFrame:
    """Equal-width bins of distance between the smallest and largest distance of each topic."""
    keys = [*by, "topic"]
    ranges = distances.groupBy(*keys).agg(F.min("distance").alias("low"), F.max("distance").alias("high"))
    joined = distances.join(ranges, keys)
    width = F.col("high") - F.col("low")
    place = F.coalesce(F.floor(F.try_divide((F.col("distance") - F.col("low")) * bins, width)), F.lit(0))
    binned = joined.select(*keys, F.least(place, F.lit(bins - 1)).cast("int").alias("bin"))
    return binned.groupBy(*keys, "bin").agg(F.count("*").alias("n"))
