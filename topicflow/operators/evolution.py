"""Comparing two topic models: who continues, merges, splits, emerges or disappears.

Topics of the newer model are ``new``, those of the older ``old``. With ``by`` many pairs of models
(slices, channel groups) are compared in one job; each column of ``by`` joins every key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..config import CURVE_THRESHOLDS, NOISE, WEIGHT_GRID, EvolutionThresholds
from ..functions.scale import dense_index
from ..functions.text import parse_verdict_json
from ..functions.vectors import cosine_plain
from .neighbours import nearest
from .topics import topic_words_row

_DEFAULTS = EvolutionThresholds()
EVOLUTION_TYPES = ("Stable", "Merged", "Split", "Emerged", "Disappeared")


def _real(df: DataFrame) -> DataFrame:
    return df.where(F.col("topic") != NOISE)


def topic_similarity(new: DataFrame, old: DataFrame, **options: int) -> DataFrame:
    """Cosine of every (new, old) pair, noise left out: the matrix itself, in long form.

    Matching does not need it, see :func:`candidate_pairs`.
    """
    width = _real(old).count()
    found = nearest(_real(new), _real(old), max(width, 1), "topic", "topic", "centroid", "centroid", **options)
    return found.select(F.col("qid").cast("int").alias("new_topic"), F.col("iid").cast("int").alias("old_topic"), F.col("sim").alias("cosine"))


def topic_jaccard(
    new_words: DataFrame, old_words: DataFrame, n: int = _DEFAULTS.top_words, by: Sequence[str] = ()
) -> DataFrame:
    """Jaccard of the top-n word sets of each pair that shares a word; all other pairs are 0."""
    pick = lambda df, t: _real(df).where(F.col("rank") <= n).select(*by, F.col("topic").alias(t), "word").distinct()
    a, b = pick(new_words, "new_topic"), pick(old_words, "old_topic")
    sizes = lambda df, t, out: df.groupBy(*by, t).agg(F.count("*").alias(out))
    shared = a.join(b, [*by, "word"]).groupBy(*by, "new_topic", "old_topic").agg(F.count("*").alias("both"))
    counted = shared.join(sizes(a, "new_topic", "na"), [*by, "new_topic"]).join(sizes(b, "old_topic", "nb"), [*by, "old_topic"])
    return counted.select(
        *by, "new_topic", "old_topic", (F.col("both") / (F.col("na") + F.col("nb") - F.col("both"))).alias("jaccard")
    )


def combined_score(cosine: Column, jaccard: Column, thresholds: EvolutionThresholds = _DEFAULTS) -> Column:
    return thresholds.cosine_weight * cosine + thresholds.jaccard_weight * jaccard


def candidate_pairs(
    new: DataFrame, old: DataFrame, new_words: DataFrame, old_words: DataFrame,
    thresholds: EvolutionThresholds = _DEFAULTS, by: str | None = None, **options: int,
) -> DataFrame:
    """Every pair that can be the best match of either side, with cosine, jaccard and combined score.

    A pair without a common word scores its cosine alone and so cannot beat the nearest topic by
    cosine. The pairs sharing a word, plus the nearest topic of each topic in both directions,
    therefore contain each side's best match; the full matrix is never built.
    """
    if thresholds.cosine_weight <= 0 or thresholds.jaccard_weight < 0:
        raise ValueError("matching needs a positive cosine weight")
    keys = [by] if by else []
    new, old = _real(new), _real(old)
    if by:
        # topic ids repeat between slices: search by a key that is unique over all of them and keeps
        # the order of ids within a slice, so that ties go to the lower topic as without ``by``
        slices = new.select(by).unionByName(old.select(by)).where(F.col(by).isNotNull()).distinct()
        number = dense_index(slices, by, "__slice")
        key = F.col("__slice") * (1 << 32) + F.col("topic")
        left, right = (df.join(number, by).withColumn("__id", key).drop("__slice") for df in (new, old))
        forward = nearest(left, right, 1, "__id", "__id", "centroid", "centroid", by=by, **options)
        backward = nearest(right, left, 1, "__id", "__id", "centroid", "centroid", by=by, **options)
        name = lambda df, i, t: df.select(F.col("__id").alias(i), by, F.col("topic").alias(t))
        fwd = forward.join(name(left, "qid", "new_topic"), "qid").join(name(right, "iid", "old_topic").drop(by), "iid")
        bwd = backward.join(name(right, "qid", "old_topic"), "qid").join(name(left, "iid", "new_topic").drop(by), "iid")
        near = fwd.select(by, "new_topic", "old_topic").unionByName(bwd.select(by, "new_topic", "old_topic"))
    else:
        forward = nearest(new, old, 1, "topic", "topic", "centroid", "centroid", **options)
        backward = nearest(old, new, 1, "topic", "topic", "centroid", "centroid", **options)
        pair = lambda df, n, o: df.select(F.col(n).cast("int").alias("new_topic"), F.col(o).cast("int").alias("old_topic"))
        near = pair(forward, "qid", "iid").unionByName(pair(backward, "iid", "qid"))
    words = topic_jaccard(new_words, old_words, thresholds.top_words, keys)
    pairs = near.distinct().join(words, [*keys, "new_topic", "old_topic"], "full_outer")
    side = lambda df, t, v: df.select(*keys, F.col("topic").alias(t), F.col("centroid").alias(v))
    full = pairs.join(side(new, "new_topic", "vn"), [*keys, "new_topic"]).join(side(old, "old_topic", "vo"), [*keys, "old_topic"])
    scored = full.select(
        *keys, "new_topic", "old_topic", F.round(cosine_plain(F.col("vn"), F.col("vo")), 10).alias("cosine"),
        F.coalesce("jaccard", F.lit(0.0)).alias("jaccard"),
    )
    return scored.withColumn("combined", F.round(combined_score(F.col("cosine"), F.col("jaccard"), thresholds), 10))


def best_matches(pairs: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Best old topic of each new one and the reverse, tagged by ``direction``; ties go to the lower id."""
    measures = ["new_topic", "old_topic", "cosine", "jaccard", "combined"]

    def best(source: str, target: str, tag: str) -> DataFrame:
        window = Window.partitionBy(*by, source).orderBy(F.desc("combined"), target)
        ranked = pairs.withColumn("rn", F.row_number().over(window)).where("rn = 1")
        return ranked.select(*by, F.lit(tag).alias("direction"), *measures)

    return best("new_topic", "old_topic", "new2old").unionByName(best("old_topic", "new_topic", "old2new"))


def border_pairs(best: DataFrame, thresholds: EvolutionThresholds = _DEFAULTS) -> DataFrame:
    """Best new-to-old pairs that are neither a sure match nor clearly different."""
    inside = (F.col("cosine") >= thresholds.cosine_low) & (F.col("cosine") < thresholds.cosine_high)
    return best.where((F.col("direction") == "new2old") & inside)


def verdict_table(answers: DataFrame, payload: str = "payload") -> DataFrame:
    """External answers ``(new_topic, old_topic, payload)`` as verdict rows."""
    parsed = answers.withColumn("v", parse_verdict_json(F.col(payload)))
    return parsed.select(*[c for c in answers.columns if c != payload], "v.same_topic", "v.confidence", "v.reasoning")


def apply_verdicts(border: DataFrame, verdicts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Border pairs with their judgement; null where none was given."""
    keys = [*by, "new_topic", "old_topic"]
    return border.join(verdicts.select(*keys, "same_topic", "confidence"), keys, "left")


def verdict_counts(judged: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    given = judged.where("same_topic IS NOT NULL")
    level = lambda name: F.count_if(F.col("confidence") == name).alias(f"{name}_confidence")
    return given.groupBy(*by).agg(
        F.count("*").alias("border_cases"), F.count_if("same_topic").alias("same_topic"),
        F.count_if(~F.col("same_topic")).alias("different_topic"), level("high"), level("medium"), level("low"),
    )


def match_topics(
    best: DataFrame, verdicts: DataFrame, thresholds: EvolutionThresholds = _DEFAULTS, by: Sequence[str] = ()
) -> DataFrame:
    """Best pairs of both directions that count as a match, with ``matched`` and the verdict used.

    Judgements exist for border pairs of the new-to-old direction; the other direction looks the
    same pair up.
    """
    keys = [*by, "new_topic", "old_topic"]
    judged = apply_verdicts(border_pairs(best, thresholds), verdicts, by).where("same_topic IS NOT NULL")
    joined = best.join(judged.select(*keys, F.col("same_topic").alias("verdict")), keys, "left")
    sure = F.col("cosine") >= thresholds.cosine_high
    border = (F.col("cosine") >= thresholds.cosine_low) & ~sure
    return joined.withColumn("matched", sure | (border & F.coalesce("verdict", F.lit(False))))


def _records(df: DataFrame, by: Sequence[str], kind: Column, new: Column, old: Column, score: Column, inherited: Column, verdict: Column) -> DataFrame:
    return df.select(
        *by, new.cast("int").alias("new_topic_id"), kind.alias("evolution_type"), old.cast("int").alias("matched_old_topic_id"),
        score.cast("double").alias("similarity_score"), inherited.cast("int").alias("inherited_topic_id"),
        verdict.cast("boolean").alias("llm_verdict"),
    )


def evolution_taxonomy(matches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """One record per new topic and per vanished old topic.

    Several new topics on one old topic are Merged, a single one is Stable; both inherit the old
    id. Unmatched new topics are Emerged and numbered after the largest old id.
    """
    none = F.lit(None)
    vanished = matches.where((F.col("direction") == "old2new") & ~F.col("matched"))
    gone = _records(vanished, by, F.lit("Disappeared"), none, F.col("old_topic"), none, none, none)
    forward = matches.where(F.col("direction") == "new2old")
    # windows over the topics of one pair of models
    siblings = Window.partitionBy(*by, "old_topic")
    kept = forward.where("matched").withColumn("n", F.count("*").over(siblings))
    kind = F.when(F.col("n") == 1, "Stable").otherwise("Merged")
    continued = _records(kept, by, kind, F.col("new_topic"), F.col("old_topic"), F.col("cosine"), F.col("old_topic"), F.col("verdict"))
    scope = list(by) or [F.lit(1)]
    largest = F.max(F.when(F.col("direction") == "old2new", F.col("old_topic"))).over(Window.partitionBy(*scope))
    numbered = matches.withColumn("largest", F.coalesce(largest, F.lit(-1)))
    born = numbered.where((F.col("direction") == "new2old") & ~F.col("matched"))
    born = born.withColumn("place", F.row_number().over(Window.partitionBy(*scope).orderBy("new_topic")))
    emerged = _records(born, by, F.lit("Emerged"), F.col("new_topic"), none, none, F.col("largest") + F.col("place"), none)
    return gone.unionByName(continued).unionByName(emerged)


def evolution_taxonomy_research(matches: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The analysis form: one row per change, with the lists of topics on both sides.

    Merged: several old topics whose best match is one new topic. Split: an old topic that is the
    best match of several new ones and is not part of a merge.
    """
    claims = matches.where((F.col("direction") == "old2new") & F.col("matched"))
    reverse = matches.where((F.col("direction") == "new2old") & F.col("matched"))
    empty = F.array().cast("array<int>")
    row = lambda df, kind, old, new, cosine, jaccard: df.select(
        *by, F.lit(kind).alias("type"), old.cast("array<int>").alias("topics_old"), new.cast("array<int>").alias("topics_new"),
        cosine.cast("double").alias("cosine"), jaccard.cast("double").alias("jaccard"),
    )
    one = lambda c: F.array(F.col(c))
    null = F.lit(None)
    groups = claims.groupBy(*by, "new_topic").agg(
        F.sort_array(F.collect_list("old_topic")).alias("olds"),
        F.min_by("cosine", "old_topic").alias("cosine"), F.min_by("jaccard", "old_topic").alias("jaccard"),
    )
    single, many = groups.where(F.size("olds") == 1), groups.where(F.size("olds") > 1)
    merged_old = many.select(*by, F.explode("olds").alias("old_topic"))
    split = reverse.groupBy(*by, "old_topic").agg(F.sort_array(F.collect_list("new_topic")).alias("news"))
    split = split.where(F.size("news") > 1).join(merged_old, [*by, "old_topic"], "left_anti")
    own = matches.where(F.col("direction") == "old2new").select(*by, "old_topic", "cosine", "jaccard")
    split = split.join(own, [*by, "old_topic"], "left")
    emerged = matches.where((F.col("direction") == "new2old") & ~F.col("matched"))
    vanished = matches.where((F.col("direction") == "old2new") & ~F.col("matched"))
    return (
        row(emerged, "Emerged", empty, one("new_topic"), null, null)
        .unionByName(row(vanished, "Disappeared", one("old_topic"), empty, null, null))
        .unionByName(row(single, "Stable", F.col("olds"), one("new_topic"), F.col("cosine"), F.col("jaccard")))
        .unionByName(row(many, "Merged", F.col("olds"), one("new_topic"), F.col("cosine"), F.col("jaccard")))
        .unionByName(row(split, "Split", one("old_topic"), F.col("news"), F.col("cosine"), F.col("jaccard")))
    )


def cold_start_evolution(topics: DataFrame, reason: str = "cold_start", by: Sequence[str] = ()) -> DataFrame:
    """Without a comparable older model every topic is new and keeps its own id."""
    if reason not in ("cold_start", "embedding_changed"):
        raise ValueError(f"unknown reason: {reason}")
    real = _real(topics).select(*by, "topic").distinct()
    none = F.lit(None)
    out = _records(real, by, F.lit("Emerged"), F.col("topic"), none, none, F.col("topic"), none)
    return out.withColumn("reason", F.lit(reason))


def evolution_summary(records: DataFrame, by: Sequence[str] = (), column: str = "evolution_type") -> DataFrame:
    return records.groupBy(*by, column).agg(F.count("*").alias("topics")).orderBy(*by, column)


def match_threshold_curve(
    best: DataFrame, thresholds: Sequence[float] = CURVE_THRESHOLDS, direction: str = "old2new", by: Sequence[str] = ()
) -> DataFrame:
    """How many topics have a best match at or above each threshold, and their share."""
    own = best.where(F.col("direction") == direction)
    counts = own.groupBy(*by).agg(F.count("*").alias("total"), *[F.count_if(F.col("cosine") >= t).alias(f"c{i}") for i, t in enumerate(thresholds)])
    pairs = ", ".join(f"{float(t)}D, c{i}" for i, t in enumerate(thresholds))
    rows = counts.select(*by, "total", F.expr(f"stack({len(thresholds)}, {pairs}) AS (threshold, topics)"))
    pct = F.round(F.try_divide(F.col("topics") * 100.0, F.col("total")), 1)
    return rows.select(*by, "threshold", "topics", F.coalesce(pct, F.lit(0.0)).alias("pct"))


def weight_ablation(reviewed: DataFrame, weights: Sequence[tuple[float, float]] = WEIGHT_GRID) -> DataFrame:
    """Rank of the first "same" pair (by cosine) among the "different" ones, per pair of weights.

    ``reviewed`` has cosine, jaccard and same_topic of the judged pairs, a report of fixed size.
    """
    table = F.array(*[F.struct(F.lit(float(c)).alias("wc"), F.lit(float(j)).alias("wj")) for c, j in weights])
    scored = reviewed.where("same_topic IS NOT NULL").select("*", F.explode(table).alias("w")).withColumn(
        "score", F.round(F.col("w.wc") * F.col("cosine") + F.col("w.wj") * F.col("jaccard"), 4)
    )
    order = F.struct(-F.col("cosine"), F.col("new_topic"), F.col("old_topic"))
    grouped = scored.groupBy("w.wc", "w.wj").agg(
        F.min_by(F.when(F.col("same_topic"), F.col("score")), F.when(F.col("same_topic"), order)).alias("first_same"),
        F.collect_list(F.when(~F.col("same_topic"), F.col("score"))).alias("different"),
        F.count("*").alias("pairs"),
    )
    better = F.size(F.filter("different", lambda s: s > F.col("first_same")))
    rank = F.when(F.col("first_same").isNotNull() & (F.size("different") > 0), better + 1)
    return grouped.select(F.col("wc").alias("cosine_weight"), F.col("wj").alias("jaccard_weight"), rank.alias("rank"), "pairs")


def similarity_matrix_head(new: DataFrame, old: DataFrame, n: int = 30) -> DataFrame:
    """The similarity matrix of the first topics of each side, at most ``n`` by ``n``."""
    head = lambda df: _real(df).orderBy("topic").limit(n)
    size = min(n, _real(new).count(), _real(old).count())
    return topic_similarity(head(new).limit(size), head(old).limit(size))


def deprecated_topics(records: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    gone = records.where((F.col("evolution_type") == "Disappeared") & F.col("matched_old_topic_id").isNotNull())
    return gone.select(*by, F.col("matched_old_topic_id").alias("topic"))


def evolution_examples(
    records: DataFrame, new_words: DataFrame, old_words: DataFrame, new_info: DataFrame, old_info: DataFrame,
    docs: DataFrame | None = None, per_type: int = 10, stable: int = 5, n_words: int = 7,
) -> DataFrame:
    """A few topics per type (stable ones by similarity) with their size, words and first documents.

    ``docs`` has ``doc_id, topic, text`` of the newer model.
    """
    listed = records.withColumn("shown", F.coalesce("new_topic_id", "matched_old_topic_id"))
    is_stable = F.col("evolution_type") == "Stable"
    order = Window.partitionBy("evolution_type").orderBy(F.when(is_stable, -F.col("similarity_score")), "shown")
    limit = F.when(is_stable, stable).otherwise(per_type)
    picked = listed.withColumn("place", F.row_number().over(order)).where(F.col("place") <= limit)
    side = lambda words, info: topic_words_row(words, n_words).join(info.select("topic", "count"), "topic").select(
        F.col("topic").alias("shown"), F.array_join(F.array_sort("words"), " ").alias("words"), "count"
    )
    fresh = picked.where("new_topic_id IS NOT NULL").join(side(new_words, new_info), "shown", "left")
    gone = picked.where("new_topic_id IS NULL").join(side(old_words, old_info), "shown", "left")
    out = fresh.unionByName(gone).select(
        "evolution_type", "new_topic_id", "matched_old_topic_id", "similarity_score", "words", F.col("count").alias("docs")
    )
    if docs is None:
        return out
    first = Window.partitionBy("topic").orderBy("doc_id")
    heads = docs.join(fresh.select(F.col("new_topic_id").alias("topic")), "topic", "left_semi")
    heads = heads.withColumn("rn", F.row_number().over(first)).where(F.col("rn") <= 3)
    samples = heads.groupBy("topic").agg(F.sort_array(F.collect_list(F.struct("rn", F.substring("text", 1, 150).alias("t")))).alias("s"))
    samples = samples.select(F.col("topic").alias("new_topic_id"), F.col("s.t").alias("sample_docs"))
    return out.join(samples, "new_topic_id", "left")


def compare_models(
    new: DataFrame, old: DataFrame, new_words: DataFrame, old_words: DataFrame, verdicts: DataFrame,
    thresholds: EvolutionThresholds = _DEFAULTS, by: str | None = None,
) -> DataFrame:
    """Centroids and words of two models in, evolution records out."""
    keys = [by] if by else []
    best = best_matches(candidate_pairs(new, old, new_words, old_words, thresholds, by), keys)
    return evolution_taxonomy(match_topics(best, verdicts, thresholds, keys), keys)
