"""The input tables of the operators, derived by Spark from the given Parquet tables.

The given tables hold no links, emoji or geometry, so both are planted: dirt in the texts, and
vectors pulled towards one anchor per label. ``sql.py`` states the same views for the SQL check.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import RingConfig
from ..functions.text import STOP_WORDS, clean_text
from ..operators import clustering, evolution, labeling, outliers, topics
from ..operators.classify import TopicReference
from ..operators.neighbours import knn_cosine
from ..operators.preprocess import preprocess_posts
from ..operators.search import trial_score
from ..session import configure, materialize, spread
from ..sources.posts import normalize_posts

FIXTURE_STOP_WORDS = ("the", "and", "les", "des", "der", "die", "los", "las")
ALL_STOP_WORDS = (*STOP_WORDS, *FIXTURE_STOP_WORDS)
CORE_NEIGHBOURS = 5


class Views:
    """Lazily built views over one folder of tables."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = configure(spark), folder

    def table(self, name: str) -> DataFrame:
        return spread(self.spark.read.parquet(f"{self.folder}/{name}.parquet"))

    @cached_property
    def raw_posts(self) -> DataFrame:
        i, text = F.col("doc_id"), F.col("text")
        hours = F.make_dt_interval(F.lit(0), ((i * 3701) % 26280).cast("int"))
        dirty = (
            F.when(i % 6 == 0, F.concat(text, F.lit(" https://t.me/p/"), i.cast("string")))
            .when(i % 6 == 1, F.concat(F.lit("🙏 "), text, F.lit(" **bold** _it_")))
            .when(i % 6 == 2, F.concat(text, F.lit(" www.site.ru")))
            .when((i % 6 == 3) & (i % 9 == 0), F.lit("https://t.me/only"))
            .otherwise(text)
        )
        return self.table("documents").select(
            i.alias("id_post"), F.col("source").alias("channel_name"),
            (F.lit("2022-01-01").cast("timestamp") + hours).alias("post_date"), dirty.alias("text"),
            F.col("n_chars").alias("views"), F.lit(0).cast("long").alias("reactions"), F.lit(0).cast("long").alias("comments"),
        )

    @cached_property
    def posts(self) -> DataFrame:
        return normalize_posts(self.raw_posts)

    @cached_property
    def prep(self) -> DataFrame:
        """Preprocessed posts, written once: many operators read them. Tokens hold letters only, so their text gives them back."""
        kept = materialize(preprocess_posts(self.posts, stop_words=ALL_STOP_WORDS), "prep", packed=True)
        return kept.withColumn("tokens", F.split("text_lemm", " "))

    @cached_property
    def docs(self) -> DataFrame:
        return self.prep.select(F.col("post_id").alias("doc_id"), "channel", "created_at", "text_clean", "text_lemm")

    @cached_property
    def lemmas(self) -> DataFrame:
        counts = self.prep.select(F.explode("tokens").alias("form")).groupBy("form").agg(F.count("*").alias("n"))
        top = counts.orderBy(F.desc("n"), "form").limit(200)
        return top.select("form", F.substring("form", 1, 5).alias("lemma"))

    @cached_property
    def topic_docs(self) -> DataFrame:
        """Texts with their topic: the channel number, and noise."""
        topic = F.when(F.col("doc_id") % 7 == 0, -1).otherwise(F.substring("channel", 4, 10).cast("int"))
        return self.docs.withColumn("topic", topic)

    @cached_property
    def text_topics(self) -> DataFrame:
        return self.topic_docs.select("doc_id", "topic")

    @cached_property
    def _labelled(self) -> tuple[DataFrame, DataFrame | None]:
        """Texts and topics; texts that carry their topic where an id stands for one text, which saves moving all texts for a join."""
        repeated = self.docs.groupBy("doc_id").agg(F.count("*").alias("n")).where("n > 1 OR doc_id IS NULL")
        return (self.topic_docs, None) if repeated.isEmpty() else (self.docs, self.text_topics)

    @cached_property
    def counts(self) -> DataFrame:
        return topics.term_counts(*self._labelled)

    @cached_property
    def vocabulary(self) -> DataFrame:
        return topics.topic_vocabulary(materialize(self.counts, "counts", packed=True))

    @cached_property
    def ctfidf(self) -> DataFrame:
        return self._described[0]

    @cached_property
    def _described(self) -> tuple[DataFrame, DataFrame]:
        scores, words = topics.describe_topics(*self._labelled)
        return materialize(scores, "ctfidf"), materialize(words, "words")

    @cached_property
    def words(self) -> DataFrame:
        return self._described[1]

    @cached_property
    def anchors(self) -> DataFrame:
        vector = F.col("embedding").cast("array<double>")
        return self.table("embeddings").groupBy("label").agg(F.min_by(vector, "vec_id").alias("a"))

    @cached_property
    def doc_vectors(self) -> DataFrame:
        """A vector for every document: one given vector and a quarter of another, so that no two documents share theirs."""
        given = self.table("embeddings").select("vec_id", "label", F.col("embedding").cast("array<double>").alias("e"))
        n = F.lit(given.count())
        docs = self.table("documents").select("doc_id", (F.col("doc_id") % n).alias("v1"), ((F.col("doc_id") * 7 + 3) % n).alias("v2"))
        first = given.select(F.col("vec_id").alias("v1"), "label", F.col("e").alias("e1"))
        second = given.select(F.col("vec_id").alias("v2"), F.col("e").alias("e2"))
        both = docs.join(first, "v1").join(second, "v2")
        return both.select("doc_id", "label", F.zip_with("e1", "e2", lambda x, y: x + y * 0.25).alias("e"))

    @cached_property
    def emb(self) -> DataFrame:
        i, e = F.col("doc_id"), F.col("e")
        pulled = F.zip_with("a", e, lambda a, v: a * 0.8 + v * 0.6)
        day = F.make_dt_interval((i % 30).cast("int"))
        return materialize(
            self.doc_vectors.join(self.anchors, "label").select(
                "doc_id", F.when(i % 14 == 0, e).otherwise(pulled).alias("embedding"), "label",
                F.concat(F.lit("ch"), (i % 20).cast("string")).alias("channel"),
                (F.lit("2024-01-01").cast("timestamp") + day).alias("created_at"),
                F.when(i % 7 == 0, -1).otherwise(F.col("label")).alias("topic"),
            ),
            "emb",
        )

    @cached_property
    def topics(self) -> DataFrame:
        return self.emb.select("doc_id", "topic")

    @cached_property
    def centroids(self) -> DataFrame:
        return materialize(topics.topic_centroids(self.emb, self.topics), "centroids")

    @cached_property
    def knn(self) -> DataFrame:
        return materialize(knn_cosine(self.emb, 10), "knn")

    @cached_property
    def old_centroids(self) -> DataFrame:
        """An older model: two topics are missing, two are mixtures of neighbours."""
        pair = self.anchors.alias("x").join(
            self.anchors.select((F.col("label") - 1).alias("label"), F.col("a").alias("b")), "label", "left"
        )
        mixed = (
            F.when(F.col("label") == 5, F.zip_with("a", "b", lambda p, q: p * 0.55 - q * 0.835))
            .when(F.col("label") == 2, F.zip_with("a", "b", lambda p, q: p * 0.75 + q * 0.66))
            .otherwise(F.col("a"))
        )
        return pair.where(~F.col("label").isin(3, 9)).select(F.col("label").alias("topic"), mixed.alias("centroid"))

    def _numbered(self, df: DataFrame, word) -> DataFrame:
        rows = df.where("topic <> -1").select("topic", F.explode(F.sequence(F.lit(1), F.lit(10))).alias("rank"))
        return rows.select("topic", "rank", word.alias("word"), (1.0 / F.col("rank")).alias("score"))

    @cached_property
    def new_words(self) -> DataFrame:
        return self._numbered(self.centroids, F.concat(F.lit("t"), F.col("topic").cast("string"), F.lit("_"), F.col("rank").cast("string")))

    @cached_property
    def old_words(self) -> DataFrame:
        """The last two words of an old topic belong to the next one."""
        owner = F.when(F.col("rank") <= 8, F.col("topic")).otherwise((F.col("topic") + 1) % 10)
        return self._numbered(self.old_centroids, F.concat(F.lit("t"), owner.cast("string"), F.lit("_"), F.col("rank").cast("string")))

    @cached_property
    def pairs(self) -> DataFrame:
        found = evolution.candidate_pairs(self.centroids, self.old_centroids, self.new_words, self.old_words)
        return materialize(found, "pairs")

    @cached_property
    def best(self) -> DataFrame:
        return evolution.best_matches(self.pairs)

    @cached_property
    def verdicts(self) -> DataFrame:
        """External answers for the border pairs, as JSON."""
        same = F.col("new_topic") != F.col("old_topic")
        payload = F.to_json(F.struct(same.alias("same_topic"), F.when(same, "high").otherwise("medium").alias("confidence")))
        answers = evolution.border_pairs(self.best).select("new_topic", "old_topic", payload.alias("payload"))
        return evolution.verdict_table(answers)

    @cached_property
    def matches(self) -> DataFrame:
        return evolution.match_topics(self.best, self.verdicts)

    @cached_property
    def records(self) -> DataFrame:
        return materialize(evolution.evolution_taxonomy(self.matches), "records")

    @cached_property
    def distances(self) -> DataFrame:
        return materialize(labeling.distance_to_centroid(self.emb, self.topics, self.centroids), "distances")

    @cached_property
    def bounds(self) -> tuple[float, float]:
        row = labeling.ring_boundaries(self.distances, RingConfig()).first()
        return row["q_low"], row["q_high"]

    @cached_property
    def emb_docs(self) -> DataFrame:
        """The post of every vector, that is of every document; an empty text for a post without a date."""
        posts = self.posts.select(F.col("post_id").alias("doc_id"), "text")
        joined = self.emb.select("doc_id").join(posts, "doc_id", "left")
        return joined.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))

    @cached_property
    def clean_docs(self) -> DataFrame:
        return self.emb_docs.select("doc_id", clean_text(F.col("text")).alias("text_clean"))

    @cached_property
    def samples(self) -> DataFrame:
        return materialize(labeling.ring_samples(self.distances, self.clean_docs, self.bounds), "samples")

    @cached_property
    def info(self) -> DataFrame:
        return topics.topic_info(self.topics)

    @cached_property
    def external_labels(self) -> DataFrame:
        """Answers of an external labeller; that of topic 7 is broken."""
        t = F.col("topic").cast("string")
        payload = F.to_json(F.struct(
            F.concat(F.lit("A"), (F.col("topic") % 3).cast("string")).alias("l1"), F.concat(F.lit("B"), t).alias("l2"),
            F.concat(F.lit("C"), t).alias("l3"), F.concat(F.lit("core "), t).alias("core_topic"),
            F.when(F.col("topic") % 2 == 1, F.concat(F.lit("edge "), t)).alias("periphery_topic"),
            (F.col("topic") % 4 == 1).alias("heterogeneous"), (0.9 - F.col("topic") / 100.0).alias("coverage"),
        ), {"ignoreNullFields": "false"})
        real = self.info.where("topic <> -1")
        return real.select("topic", F.when(F.col("topic") == 7, F.lit("no json")).otherwise(payload).alias("payload"))

    @cached_property
    def production_table(self) -> DataFrame:
        """A label table as an older model wrote it, all columns text."""
        t = F.col("topic").cast("string")
        return self.old_centroids.select(
            t.alias("Topic"), F.concat(F.lit("P"), (F.col("topic") % 3).cast("string")).alias("l1"),
            F.concat(F.lit("Q"), t).alias("l2"), F.when(F.col("topic") != 4, F.concat(F.lit("R"), t)).alias("l3"),
            F.when(F.col("topic") % 4 == 0, "True").otherwise("False").alias("is_heterogeneous"),
            F.when(F.col("topic") % 3 == 0, "").otherwise("0.8").alias("coverage"),
        )

    @cached_property
    def labels(self) -> DataFrame:
        table = labeling.label_topics(
            self.info, self.samples, self.external_labels, labeling.inherited_labels(self.production_table), self.records, self.bounds
        )
        return materialize(labeling.label_evolution_fill(table, self.records), "labels")

    @cached_property
    def slice_labels(self) -> DataFrame:
        """A label table over many slices: one topic per channel and month."""
        month = F.date_format("created_at", "yyyy-MM")
        number = F.substring("channel", 4, 10).cast("int")
        counts = self.posts.groupBy(month.alias("slice"), number.alias("Topic")).agg(F.count("*").alias("count"), F.min("post_id").alias("m"))
        return counts.select(
            "slice", "Topic", "count", F.concat(F.lit("L"), (F.col("Topic") % 5).cast("string")).alias("l1"),
            F.concat(F.lit("L"), F.col("Topic").cast("string"), F.lit(":x")).alias("Human_Label"),
            (F.col("m") % 4 == 0).alias("is_heterogeneous"),
            F.when(F.col("m") % 5 != 0, (F.col("m") % 100) / 100.0).alias("coverage"),
            F.when(F.col("m") % 3 == 0, "inherited").otherwise("llm").alias("label_source"),
            (F.col("Topic") + 1).alias("calls"),
        )

    @cached_property
    def reference_model(self) -> TopicReference:
        parsed = labeling.parse_label_json(F.col("payload"))
        label = self.external_labels.select("topic", parsed.alias("l")).select(
            "topic", *[F.coalesce(f"l.{c}", F.lit("")).alias(c) for c in ("l1", "l2", "l3", "core_topic", "periphery_topic")],
            F.coalesce("l.heterogeneous", F.lit(False)).alias("heterogeneous"),
        ).where("topic <> 8")
        core = clustering.core_distances(self.knn, CORE_NEIGHBOURS)
        real = self.emb.where("topic <> -1").select("doc_id", "embedding", "topic").join(core, "doc_id")
        return TopicReference(self.centroids, materialize(label, "model-labels"), self.new_words, self.bounds, materialize(real, "points"))

    @cached_property
    def text_scores(self) -> DataFrame:
        return materialize(outliers.ctfidf_scores(self.docs, self.text_topics, self.ctfidf), "scores")

    @cached_property
    def log(self) -> DataFrame:
        i, day = F.col("event_id"), F.dayofmonth("ts")
        level = F.col("value") / 100.0
        return self.table("events").select(
            F.col("ts").cast("timestamp").alias("predicted_at"),
            F.when(i % 11 != 0, F.least(F.when(day % 7 < 3, level).otherwise(level + 0.35), F.lit(1.0))).alias("probability"),
            F.when((F.col("event_type") == "error") | (day.between(20, 23) & F.col("event_type").isin("click", "view")), -1)
            .when((F.col("event_type") == "signup") & (i % 3 == 0), F.lit(None))
            .otherwise((F.col("user_id") % 10).cast("int")).alias("topic_id"),
        )

    @cached_property
    def trials(self) -> DataFrame:
        """A table of experiments: one study per supplier, one trial per order line."""
        dbcv = F.when(F.col("l_linenumber") != 7, F.col("l_extendedprice") / 110000.0)
        trial = F.col("l_orderkey") * 10 + F.col("l_linenumber")
        base = self.table("lineitem").select(
            F.col("l_suppkey").alias("study"), (trial * 1000000 + F.col("l_partkey")).alias("trial_id"),
            (15 + F.col("l_partkey") % 86).alias("n_neighbors"), (5 + F.col("l_orderkey") % 11).alias("n_components"),
            (50 + F.col("l_quantity") * 3).cast("int").alias("min_cluster_size"), (5 + F.col("l_orderkey") % 146).alias("min_samples"),
            (F.col("l_discount") + F.col("l_tax")).alias("noise_ratio"), dbcv.alias("dbcv"),
            (0.70 + F.col("l_tax")).alias("cv_coherence"),
        )
        return base.withColumn("score", trial_score(F.col("dbcv"), F.col("noise_ratio")))
