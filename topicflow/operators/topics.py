"""Describing topics: vocabulary, class TF-IDF, top words, centroids, counts.

A topic, the noise topic above all, may hold a third of all documents. Terms are therefore
counted per (topic, term) with partial sums before the shuffle, and totals are joined back rather
than computed in a window over a whole topic.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import NOISE
from ..functions.scale import explode_once, next_in_group, top_k_per_group
from ..functions.text import ARTIFACT_WORDS
from ..session import materialize

# Fixed value: a vocabulary word is a run of two or more word characters.
VOCABULARY_WORD = r"[\p{L}\p{N}_]{2,}"


def vocabulary_tokens(text: Column, stop_words: Sequence[str] = ARTIFACT_WORDS) -> Column:
    words = F.regexp_extract_all(F.lower(text), F.lit(VOCABULARY_WORD), F.lit(0))
    return F.filter(words, lambda t: ~t.isin(list(stop_words))) if stop_words else words


def word_ngrams(tokens: Column) -> Column:
    """Words and pairs of neighbouring words."""
    pairs = F.transform(
        F.sequence(F.lit(1), F.size(tokens) - 1),
        lambda i: F.concat_ws(" ", F.element_at(tokens, i), F.element_at(tokens, i + 1)),
    )
    return F.concat(tokens, F.when(F.size(tokens) > 1, pairs).otherwise(F.array().cast("array<string>")))


def term_counts(
    docs: DataFrame, topics: DataFrame | None, text: str = "text_lemm", key: str = "doc_id", by: Sequence[str] = (),
    stop_words: Sequence[str] = ARTIFACT_WORDS, join_documents: bool = True,
) -> DataFrame:
    """``topic, term, tf`` over the texts of each topic, joined in id order.

    Without ``topics`` the texts carry a ``topic`` column, which saves moving them for a join.

    Joining texts makes one more word pair between the end of a document and the start of the
    next; ``join_documents=False`` leaves those out.
    """
    group = [*by, "topic"]
    filled = F.filter(F.array(vocabulary_tokens(F.col(text), stop_words)), lambda w: F.size(w) > 0)
    if topics is None:
        labelled = explode_once(docs, [key, *group], filled, "w")
    else:
        labelled = explode_once(docs, [key, *by], filled, "w").join(topics.select(key, "topic"), key)
    if join_documents:
        labelled = materialize(labelled, "labelled", packed=True)  # read for the terms and, without the words between, for the ends
    terms = explode_once(labelled, group, word_ngrams(F.col("w")), "term")
    if join_documents:
        ends = labelled.select(key, *group, F.element_at("w", 1).alias("head"), F.element_at("w", -1).alias("tail"))
        linked = next_in_group(ends, group, key, "head", "next_head").where("next_head IS NOT NULL")
        terms = terms.unionByName(linked.select(*group, F.concat_ws(" ", "tail", "next_head").alias("term")))
    return terms.groupBy(*group, "term").agg(F.count("*").alias("tf"))


def topic_vocabulary(
    counts: DataFrame, by: Sequence[str] = (), max_df: float = 0.85, max_features: int = 30_000
) -> DataFrame:
    """Drop terms found in more than ``max_df`` of the topics, then keep the most frequent ones."""
    by = list(by)
    topics = counts.groupBy(*by).agg(F.count_distinct("topic").alias("topics"))
    terms = counts.groupBy(*by, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("f"))
    if by:
        allowed = terms.join(topics, by).where(F.col("df") <= F.col("topics") * max_df)
        kept = top_k_per_group(allowed, by, [F.desc("f"), F.asc("term")], max_features, "term")
    else:
        limit = (topics.first()["topics"] or 0) * max_df
        kept = terms.where(F.col("df") <= F.lit(limit)).orderBy(F.desc("f"), "term").limit(max_features)
    return counts.join(kept.select(*by, "term", "f"), [*by, "term"])


def class_tfidf(vocabulary: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """tf / topic length * ln(1 + A / term frequency), A the mean topic length as a whole number.

    Noise is a topic like any other.
    """
    by = list(by)
    lengths = vocabulary.groupBy(*by, "topic").agg(F.sum("tf").alias("words"))
    if by:
        mean = lengths.groupBy(*by).agg(F.avg("words").alias("mean_words"))
        scored = vocabulary.join(lengths, [*by, "topic"]).join(mean, by)
        average = F.floor("mean_words")
    else:
        average = F.lit(lengths.agg(F.floor(F.avg("words")).alias("m")).first()["m"])
        scored = vocabulary.join(lengths, "topic")
    weight = F.col("tf") / F.col("words") * F.log1p(average / F.col("f"))
    return scored.select(*by, "topic", "term", "tf", weight.alias("score"))


def topic_top_words(ctfidf: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """``topic, rank, word, score``: the n best terms of each topic, ties by term.

    Scores are compared to 10 digits, so that equal terms tie whatever the order of summation.
    """
    order = [F.desc(F.round("score", 10)), F.asc("term")]
    ranked = top_k_per_group(ctfidf, [*by, "topic"], order, n, "term", "rank")
    return ranked.select(*by, "topic", "rank", F.col("term").alias("word"), "score")


def topic_words_row(words: DataFrame, n: int = 10, by: Sequence[str] = ()) -> DataFrame:
    """One row per topic with its first n words in order."""
    picked = words.where(F.col("rank") <= n).groupBy(*by, "topic").agg(F.sort_array(F.collect_list(F.struct("rank", "word"))).alias("w"))
    return picked.select(*by, "topic", F.col("w.word").alias("words"))


def topic_centroids(emb: DataFrame, topics: DataFrame | None, key: str = "doc_id", by: Sequence[str] = ()) -> DataFrame:
    """Mean vector per topic, noise included; one partial sum per topic leaves each map task.

    Without ``topics`` the vectors carry a ``topic`` column.
    """
    joined = emb if topics is None else emb.select(key, *by, "embedding").join(topics.select(key, "topic"), key)
    vectors = joined.select(*by, "topic", array_to_vector(F.col("embedding").cast("array<double>")).alias("v"))
    means = vectors.groupBy(*by, "topic").agg(Summarizer.mean(F.col("v")).alias("m"))
    return means.select(*by, "topic", vector_to_array("m").alias("centroid"))


def topic_info(topics: DataFrame, words: DataFrame | None = None, by: Sequence[str] = (), name_words: int = 4) -> DataFrame:
    """Topic, document count and a name of the topic and its first words; largest first."""
    counts = topics.groupBy(*by, "topic").agg(F.count("*").alias("count"))
    if words is None:
        return counts.orderBy(*by, F.desc("count"), "topic")
    named = counts.join(topic_words_row(words, name_words, by), [*by, "topic"], "left")
    name = F.concat_ws("_", F.col("topic").cast("string"), F.array_join("words", "_"))
    return named.select(*by, "topic", "count", name.alias("name")).orderBy(*by, F.desc("count"), "topic")


def largest_topics(topics: DataFrame, k: int = 6, by: Sequence[str] = ()) -> DataFrame:
    real = topics.where(F.col("topic") != NOISE).groupBy(*by, "topic").agg(F.count("*").alias("count"))
    return top_k_per_group(real, by, [F.desc("count"), F.asc("topic")], k, "topic")


def noise_ratio(topics: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Noise share, classified share and number of real topics."""
    noise = F.try_divide(F.count_if(F.col("topic") == NOISE), F.count("*"))
    real = F.count_distinct(F.when(F.col("topic") != NOISE, F.col("topic")))
    return topics.groupBy(*by).agg(
        F.count("*").alias("docs"), noise.alias("noise_ratio"), (1 - noise).alias("classified_ratio"), real.alias("num_topics")
    )


def topic_diversity(words: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Distinct share of all top words of the real topics; 0 without words."""
    share = F.try_divide(F.count_distinct("word"), F.count("*"))
    return words.where(F.col("topic") != NOISE).groupBy(*by).agg(F.coalesce(share, F.lit(0.0)).alias("topic_diversity"))


def describe_topics(
    docs: DataFrame, topics: DataFrame | None, text: str = "text_lemm", n: int = 10, by: Sequence[str] = (),
    max_df: float = 0.85, max_features: int = 30_000,
) -> tuple[DataFrame, DataFrame]:
    """(class TF-IDF table, top words) of an assignment.

    The texts are read for the term counts only; counts and vocabulary are written, as each is
    read several times afterwards.
    """
    counts = materialize(term_counts(docs, topics, text, by=by), "counts", packed=True)
    vocabulary = materialize(topic_vocabulary(counts, by, max_df, max_features), "vocabulary")
    scores = class_tfidf(vocabulary, by)
    return scores, topic_top_words(scores, n, by)


def update_topics(
    docs: DataFrame, topics: DataFrame, emb: DataFrame | None = None, centroids: DataFrame | None = None,
    text: str = "text_lemm", recompute_centroids: bool = False, **options,
) -> dict[str, DataFrame]:
    """Words and counts for a changed assignment; centroids stay unless asked for."""
    scores, words = describe_topics(docs, topics, text, **options)
    if recompute_centroids and emb is not None:
        centroids = topic_centroids(emb, topics)
    out = {"ctfidf": scores, "words": words, "info": topic_info(topics, words)}
    return out if centroids is None else {**out, "centroids": centroids}
