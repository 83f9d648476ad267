"""Queries over models in use: evolution, labels, classification, drift, streams."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F


from ..operators import classify, drift, evolution, labeling
from ..operators.topics import topic_centroids
from ..plans import monitor
from ..session import materialize, scratch_path
from ..streaming import append, classify as stream_cls, drift as stream_drift
from .base import joined, query, rounded
from .views import Views


@query("topic_similarity", "SELECT new_topic, old_topic, round(cosine, 6) AS cosine FROM allpairs", "allpairs")
def _(v):
    return rounded(evolution.topic_similarity(v.centroids, v.old_centroids))


@query("topic_jaccard", "SELECT new_topic, old_topic, round(jaccard, 6) AS jaccard FROM allpairs WHERE jaccard > 0", "allpairs")
def _(v):
    return rounded(evolution.topic_jaccard(v.new_words, v.old_words))


@query("combined_score", """
    SELECT new_topic, old_topic, round(combined, 6) AS combined FROM allpairs
    WHERE jaccard > 0 OR (new_topic, old_topic) IN (SELECT (new_topic, old_topic) FROM (
            SELECT *, row_number() OVER (PARTITION BY new_topic ORDER BY cosine DESC, old_topic) AS a,
                   row_number() OVER (PARTITION BY old_topic ORDER BY cosine DESC, new_topic) AS b FROM allpairs) WHERE a = 1 OR b = 1)""", "allpairs")
def _(v):
    return rounded(v.pairs.select("new_topic", "old_topic", "combined"))


_BEST = "direction, new_topic, old_topic, round(cosine, 6) AS cosine, round(jaccard, 6) AS jaccard, round(combined, 6) AS combined"


@query("best_matches", f"SELECT {_BEST} FROM best", "best")
def _(v):
    return rounded(v.best)


@query("border_pairs", f"SELECT {_BEST} FROM border", "border")
def _(v):
    return rounded(evolution.border_pairs(v.best))


@query("apply_verdicts", "SELECT new_topic, old_topic, same_topic, confidence FROM border JOIN verdicts USING (new_topic, old_topic)", "border verdicts")
def _(v):
    judged = evolution.apply_verdicts(evolution.border_pairs(v.best), v.verdicts)
    return judged.select("new_topic", "old_topic", "same_topic", "confidence")


@query("verdict_counts", """
    SELECT count(*) AS border_cases, count(*) FILTER (same_topic) AS same_topic, count(*) FILTER (NOT same_topic) AS different_topic,
           count(*) FILTER (confidence = 'high') AS high_confidence, count(*) FILTER (confidence = 'medium') AS medium_confidence,
           count(*) FILTER (confidence = 'low') AS low_confidence FROM verdicts""", "verdicts")
def _(v):
    return evolution.verdict_counts(evolution.apply_verdicts(evolution.border_pairs(v.best), v.verdicts))


@query("match_topics", "SELECT direction, new_topic, old_topic, coalesce(verdict::VARCHAR, '') AS verdict, matched FROM matches", "matches")
def _(v):
    return v.matches.select("direction", "new_topic", "old_topic", F.coalesce(F.col("verdict").cast("string"), F.lit("")).alias("verdict"), "matched")


def _flat_records(df):
    """Nullable whole numbers as floating point, booleans as text: the same in every client."""
    ids = ("new_topic_id", "matched_old_topic_id", "inherited_topic_id")
    out = df.withColumns({c: F.col(c).cast("double") for c in ids})
    return rounded(out.withColumn("llm_verdict", F.coalesce(F.col("llm_verdict").cast("string"), F.lit(""))))


_RECORDS = """new_topic_id::DOUBLE AS new_topic_id, evolution_type, matched_old_topic_id::DOUBLE AS matched_old_topic_id,
    round(similarity_score, 6) AS similarity_score, inherited_topic_id::DOUBLE AS inherited_topic_id, coalesce(llm_verdict::VARCHAR, '') AS llm_verdict"""


@query("evolution_taxonomy", f"SELECT {_RECORDS} FROM records", "records")
def _(v):
    return _flat_records(evolution.evolution_taxonomy(v.matches))


@query("evolution_taxonomy_research", """
    , claims AS (SELECT new_topic, list(old_topic ORDER BY old_topic) AS olds, arg_min(cosine, old_topic) AS cosine FROM matches
                 WHERE direction = 'old2new' AND matched GROUP BY new_topic),
    splits AS (SELECT old_topic, list(new_topic ORDER BY new_topic) AS news FROM matches WHERE direction = 'new2old' AND matched GROUP BY old_topic)
    SELECT 'Emerged' AS type, '' AS olds, new_topic::VARCHAR AS news, NULL::DOUBLE AS cosine FROM matches WHERE direction = 'new2old' AND NOT matched
    UNION ALL SELECT 'Disappeared', old_topic::VARCHAR, '', NULL FROM matches WHERE direction = 'old2new' AND NOT matched
    UNION ALL SELECT CASE WHEN len(olds) = 1 THEN 'Stable' ELSE 'Merged' END, array_to_string(olds, ','), new_topic::VARCHAR, round(cosine, 6) FROM claims
    UNION ALL SELECT 'Split', s.old_topic::VARCHAR, array_to_string(news, ','), round(m.cosine, 6) FROM splits s
              JOIN matches m ON m.direction = 'old2new' AND m.old_topic = s.old_topic
              WHERE len(news) > 1 AND NOT EXISTS (SELECT 1 FROM claims WHERE len(olds) > 1 AND list_contains(olds, s.old_topic))""", "matches")
def _(v):
    rows = evolution.evolution_taxonomy_research(v.matches)
    text = lambda c: joined(F.col(c).cast("array<string>"), ",")
    return rounded(rows.select("type", text("topics_old").alias("olds"), text("topics_new").alias("news"), "cosine"))


@query("cold_start_evolution", """
    SELECT topic AS new_topic_id, 'Emerged' AS evolution_type, topic AS inherited_topic_id, 'embedding_changed' AS reason FROM info WHERE topic <> -1""", "info")
def _(v):
    rows = evolution.cold_start_evolution(v.topics, "embedding_changed")
    return rows.select("new_topic_id", "evolution_type", "inherited_topic_id", "reason")


@query("evolution_summary", "SELECT evolution_type, count(*) AS topics FROM records GROUP BY 1", "records")
def _(v):
    return evolution.evolution_summary(v.records)


@query("match_threshold_curve", """
    SELECT threshold, count(*) FILTER (cosine >= threshold) AS topics, round(count(*) FILTER (cosine >= threshold) * 100.0::DOUBLE / count(*), 1) AS pct
    FROM best, (SELECT unnest([0.4, 0.5, 0.6, 0.7, 0.8, 0.9])::DOUBLE AS threshold) WHERE direction = 'old2new' GROUP BY threshold""", "best")
def _(v):
    return evolution.match_threshold_curve(v.best)


@query("weight_ablation", """
    , reviewed AS (SELECT new_topic, old_topic, cosine, jaccard, new_topic = old_topic OR new_topic = 3 AS same_topic FROM best WHERE direction = 'new2old'),
    w AS (SELECT unnest([1.0, 0.7, 0.5, 0.3, 0.0])::DOUBLE AS wc, unnest([0.0, 0.3, 0.5, 0.7, 1.0])::DOUBLE AS wj),
    scored AS (SELECT *, round(wc * cosine + wj * jaccard, 4) AS score FROM reviewed, w),
    firsts AS (SELECT wc, wj, arg_max(score, (cosine, -new_topic)) AS first_same FROM scored WHERE same_topic GROUP BY wc, wj)
    SELECT wc AS cosine_weight, wj AS jaccard_weight, count(*) FILTER (NOT same_topic AND score > first_same) + 1 AS rank, count(*) AS pairs
    FROM scored JOIN firsts USING (wc, wj) GROUP BY wc, wj""", "best")
def _(v):
    same = (F.col("new_topic") == F.col("old_topic")) | (F.col("new_topic") == 3)
    reviewed = v.best.where("direction = 'new2old'").withColumn("same_topic", same)
    rows = evolution.weight_ablation(reviewed)
    return rows.withColumn("rank", F.col("rank").cast("long"))


@query("similarity_matrix_head", "SELECT new_topic, old_topic, round(cosine, 6) AS cosine FROM allpairs WHERE new_topic < 5 AND old_topic IN (0, 1, 2, 4, 5)", "allpairs")
def _(v):
    return rounded(evolution.similarity_matrix_head(v.centroids, v.old_centroids, 5))


@query("deprecated_topics", "SELECT matched_old_topic_id AS topic FROM records WHERE evolution_type = 'Disappeared'", "records")
def _(v):
    return evolution.deprecated_topics(v.records)


@query("evolution_examples", """
    , ranked AS (SELECT *, coalesce(new_topic_id, matched_old_topic_id) AS shown, row_number() OVER (PARTITION BY evolution_type
            ORDER BY CASE WHEN evolution_type = 'Stable' THEN -similarity_score END, coalesce(new_topic_id, matched_old_topic_id)) AS rn FROM records)
    SELECT evolution_type, shown, coalesce((SELECT string_agg(word, ' ' ORDER BY word) FROM nwords w WHERE w.topic = shown AND rank <= 7 AND new_topic_id IS NOT NULL),
               (SELECT string_agg(word, ' ' ORDER BY word) FROM owords w WHERE w.topic = shown AND rank <= 7)) AS words,
           CASE WHEN new_topic_id IS NOT NULL THEN (SELECT count FROM info i WHERE i.topic = shown) ELSE 1 END::BIGINT AS docs,
           coalesce(array_to_string((SELECT list(doc_id ORDER BY doc_id)[1:3] FROM emb e WHERE e.topic = new_topic_id), ' '), '') AS sample_docs
    FROM ranked WHERE rn <= CASE WHEN evolution_type = 'Stable' THEN 5 ELSE 10 END""", "records nwords owords info emb")
def _(v):
    docs = v.emb.select("doc_id", "topic", F.col("doc_id").cast("string").alias("text"))
    old_info = v.old_centroids.select("topic", F.lit(1).cast("long").alias("count"))
    rows = evolution.evolution_examples(v.records, v.new_words, v.old_words, v.info, old_info, docs)
    samples = F.coalesce(joined("sample_docs"), F.lit(""))
    return rows.select("evolution_type", F.coalesce("new_topic_id", "matched_old_topic_id").alias("shown"), "words", "docs", samples.alias("sample_docs"))


_BY_SLICE = """
    , sl AS (SELECT *, 's' || doc_id % 3 AS slice FROM emb),
    sc AS MATERIALIZED (SELECT slice, topic, list(m ORDER BY i) AS centroid FROM (SELECT slice, topic, i, avg(v) AS m FROM (
        SELECT slice, topic, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS i FROM sl) GROUP BY slice, topic, i) GROUP BY slice, topic),
    sp AS MATERIALIZED (SELECT slice, new_topic, old_topic, cosine, jaccard, round(0.7::DOUBLE * cosine + 0.3::DOUBLE * jaccard, 10) AS combined FROM (
        SELECT n.slice, n.topic AS new_topic, o.topic AS old_topic, round(list_cosine_similarity(n.centroid, o.centroid), 10) AS cosine,
               coalesce(a.jaccard, 0) AS jaccard
        FROM sc n JOIN oldcent o ON true LEFT JOIN allpairs a ON a.new_topic = n.topic AND a.old_topic = o.topic WHERE n.topic <> -1))
    SELECT slice, new_topic, old_topic, round(cosine, 6) AS cosine, cosine >= 0.7 AS matched FROM (
        SELECT *, row_number() OVER (PARTITION BY slice, new_topic ORDER BY combined DESC, old_topic) AS rn FROM sp) WHERE rn = 1"""


@query("best_matches_by_slice", _BY_SLICE, "emb oldcent allpairs")
def _(v):
    """Three slices compared with the older model in one job."""
    return _slices(v)


@query("best_matches_by_slice_blocks", _BY_SLICE, "emb oldcent allpairs")
def _(v):
    """The same through the plan for centroids beyond the broadcast bound."""
    return _slices(v, broadcast_bytes=0, block_bytes=64 * 8 * 3)


def _slices(v: Views, **options: int):
    sliced = v.emb.withColumn("slice", F.concat(F.lit("s"), (F.col("doc_id") % 3).cast("string")))
    slices = F.explode(F.array(*[F.lit(f"s{i}") for i in range(3)])).alias("slice")
    new = materialize(topic_centroids(sliced, v.topics, by=["slice"]), "slice-centroids")
    every = lambda df: df.select("*", slices)
    pairs = evolution.candidate_pairs(new, every(v.old_centroids), every(v.new_words), every(v.old_words), by="slice", **options)
    best = evolution.best_matches(pairs, ["slice"]).where("direction = 'new2old'")
    return rounded(best.select("slice", "new_topic", "old_topic", "cosine", (F.col("cosine") >= 0.7).alias("matched")))


# --- rings and labels -------------------------------------------------------


@query("distance_to_centroid", "SELECT doc_id, topic, round(distance, 6) AS distance FROM dist", "dist")
def _(v):
    return rounded(labeling.distance_to_centroid(v.emb, v.topics, v.centroids))


@query("ring_boundaries", "SELECT round(q_low, 6) AS q_low, round(q_high, 6) AS q_high FROM bounds", "bounds")
def _(v):
    return rounded(labeling.ring_boundaries(v.distances))


@query("assign_ring", "SELECT doc_id, coalesce(ring, 0) AS ring, CASE WHEN distance < q_low THEN 1 WHEN distance < q_high THEN 2 ELSE 3 END AS zone FROM rings, bounds", "rings bounds")
def _(v):
    d = F.col("distance")
    closed, open_end = labeling.assign_ring(d, *v.bounds), labeling.assign_ring(d, *v.bounds, open_end=True)
    return v.distances.select("doc_id", F.coalesce(closed, F.lit(0)).alias("ring"), open_end.alias("zone"))


@query("ring_samples", "SELECT topic, ring, name, total_docs, array_to_string(sample_ids, ' ') AS sample_ids, md5(array_to_string(sample_docs, '|')) AS docs FROM samples", "samples")
def _(v):
    rows = v.samples
    return rows.select("topic", "ring", "name", "total_docs", joined(F.col("sample_ids").cast("array<string>")).alias("sample_ids"), F.md5(joined("sample_docs", "|")).alias("docs"))


@query("label_prompts", """
    SELECT topic, keywords, md5(rings) AS rings FROM (SELECT topic, string_agg(word, ', ' ORDER BY rank) AS keywords FROM nwords GROUP BY topic)
    JOIN (SELECT topic, string_agg(chr(10) || repeat('─', 45) || chr(10) || upper(name) || ' (' || total_docs || ' документов):' || chr(10)
                 || array_to_string(list_transform(sample_docs, lambda d: '  • ' || substr(d, 1, 200) || chr(10)), ''), '' ORDER BY ring) AS rings
          FROM samples GROUP BY topic) USING (topic)""", "nwords samples")
def _(v):
    return labeling.label_prompts(v.new_words, v.samples).withColumn("rings", F.md5("rings"))


@query("inherited_labels", "SELECT topic, l1, l2, l3, heterogeneous, coverage FROM prodlabels", "prodlabels")
def _(v):
    return labeling.inherited_labels(v.production_table)


_LABELS = """Topic, Human_Label, is_heterogeneous, round(coverage, 6) AS coverage, zone_boundaries_q25_q60, label_source, l1, l2, l3, core_topic,
    periphery_topic, count, ring_1_count, ring_2_count, ring_3_count, calls"""


@query("label_topics", f"SELECT {_LABELS} FROM labels", "labels")
def _(v):
    return rounded(v.labels.drop("evolution_type"))


@query("label_evolution_fill", "SELECT Topic, evolution_type FROM labels", "labels")
def _(v):
    return labeling.label_evolution_fill(v.labels, v.records).select("Topic", "evolution_type")


@query("labeling_stats", """
    SELECT slice, count(*) FILTER (label_source = 'llm') AS labeled_externally, count(*) FILTER (label_source = 'inherited') AS inherited,
           count(*) FILTER (is_heterogeneous) AS heterogeneous, round(avg(coverage), 6) AS avg_coverage, max(calls)::BIGINT AS total_calls
    FROM slabels GROUP BY slice""", "slabels")
def _(v):
    rows = labeling.labeling_stats(v.slice_labels, ["slice"])
    return rounded(rows.withColumn("total_calls", F.col("total_calls").cast("long")))


@query("label_examples", """
    SELECT Topic, Human_Label, is_heterogeneous, round(coverage, 6) AS coverage, evolution_type FROM (
        SELECT *, row_number() OVER (PARTITION BY evolution_type ORDER BY Topic) AS rn FROM labels) WHERE rn <= 5""", "labels")
def _(v):
    return rounded(labeling.label_examples(v.labels))


@query("label_summary", """
    SELECT slice, coalesce(l1, '') AS l1, grouping(l1) = 1 AS whole_slice, count(*) AS topics, sum(count)::BIGINT AS docs,
           round(avg(is_heterogeneous::INT), 6) AS heterogeneous_share, round(avg(coverage), 6) AS mean_coverage
    FROM slabels GROUP BY GROUPING SETS ((slice), (slice, l1))""", "slabels")
def _(v):
    return rounded(labeling.label_summary(v.slice_labels).withColumn("l1", F.coalesce("l1", F.lit(""))))


@query("heterogeneous_topics", "SELECT Topic, count, Human_Label FROM slabels WHERE is_heterogeneous", "slabels")
def _(v):
    return labeling.heterogeneous_topics(v.slice_labels)


@query("coverage_histogram", """
    SELECT slice, least(floor(coverage * 20), 19)::INT AS bin, count(*) AS n, round(any_value(m), 6) AS mean_coverage
    FROM slabels JOIN (SELECT slice, avg(coverage) AS m FROM slabels GROUP BY slice) USING (slice) WHERE coverage IS NOT NULL GROUP BY 1, 2""", "slabels")
def _(v):
    return rounded(labeling.coverage_histogram(v.slice_labels))


@query("distance_histogram", """
    SELECT topic, least(floor((distance - low) * 40 / (high - low)), 39)::INT AS bin, count(*) AS n
    FROM dist JOIN (SELECT topic, min(distance) AS low, max(distance) AS high FROM dist GROUP BY topic) USING (topic) GROUP BY 1, 2""", "dist")
def _(v):
    return labeling.distance_histogram(v.distances)


# --- classification ---------------------------------------------------------


@query("soft_assign", "SELECT doc_id, topic, round(probability, 6) AS probability FROM soft", "soft")
def _(v):
    return rounded(classify.soft_assign(v.emb, v.centroids))


@query("assign_topic", "SELECT doc_id, topic_id, round(probability, 6) AS probability, assignment_method FROM chosen", "chosen")
def _(v):
    return rounded(classify.assign_topic(v.emb, v.reference_model, exclude_self=True))


@query("label_by_zone", """
    SELECT doc_id, topic AS topic_id, CASE WHEN l1 IS NULL THEN 'Нет метки' WHEN zone = 1 THEN l1 || ' -> ' || l2 || ' -> ' || l3
           WHEN zone = 2 THEN l1 || ' -> ' || l2 WHEN heterogeneous AND periphery_topic <> '' THEN l1 || ' [периферия гетерогенного кластера]' ELSE l1 END AS label
    FROM (SELECT doc_id, topic, CASE WHEN distance < q_low THEN 1 WHEN distance < q_high THEN 2 ELSE 3 END AS zone FROM dist, bounds)
    LEFT JOIN (SELECT * FROM extlabels WHERE topic <> 8) USING (topic)""", "dist bounds extlabels")
def _(v):
    ring = labeling.assign_ring(F.col("distance"), *v.bounds, open_end=True)
    rows = v.distances.select("doc_id", F.col("topic").alias("topic_id"), ring.alias("ring"))
    return classify.label_by_zone(rows, v.reference_model.labels).select("doc_id", "topic_id", "label")


def _flat(df):
    return df.withColumn("top_words", joined("top_words")).withColumn("ring_key", F.coalesce("ring_key", F.lit("")))


_CLASSIFIED = "SELECT * REPLACE (coalesce(ring_key, '') AS ring_key, hdbscan_prob::DOUBLE AS hdbscan_prob, confidence::DOUBLE AS confidence) FROM {}"


@query("classify_documents", _CLASSIFIED.format("classified"), "classified")
def _(v):
    return _flat(classify.classify_documents(v.emb_docs, v.emb.select("doc_id", "embedding"), v.reference_model, exclude_self=True))


def _classified(v: Views):
    docs = classify.classify_documents(v.emb_docs, v.emb.select("doc_id", "embedding"), v.reference_model, exclude_self=True)
    return materialize(docs, "classified")


@query("zone_summary", """
    SELECT zone, round(avg(CASE WHEN label IN ('', 'Неклассифицировано') THEN 0 ELSE (length(label) - length(replace(label, '->', ''))) // 2 + 1 END), 6) AS mean_depth,
           round(avg(confidence), 6) AS mean_confidence, count(*) AS docs,
           round((SELECT avg(confidence) FROM classified WHERE zone <> 'Шум'), 6) AS mean_confidence_without_noise FROM classified GROUP BY zone""", "classified")
def _(v):
    return rounded(classify.zone_summary(_classified(v)))


@query("label_counts", "SELECT label, count(*) AS docs FROM classified GROUP BY label", "classified")
def _(v):
    return classify.label_counts(_classified(v))


# --- gates and drift --------------------------------------------------------


@query("validation_gates", """
    , m AS (SELECT study, count(*) AS n, avg(dbcv) AS dbcv, avg(noise_ratio) AS noise, avg(cv_coherence) AS cv, avg(dbcv) FILTER (l = 0) AS prod
            FROM (SELECT *, trial_id % 2 AS l FROM trials) GROUP BY study),
    c AS (SELECT study, 'dbcv' AS "check", dbcv AS new_value, dbcv >= 0.95 * prod AS passed FROM m
          UNION ALL SELECT study, 'cv_coherence', cv, cv >= 0.70 FROM m UNION ALL SELECT study, 'noise_ratio', noise, noise <= 0.2 FROM m
          UNION ALL SELECT study, 'num_topics', n, n >= 20 FROM m)
    SELECT study, "check", round(new_value, 10) AS new_value, passed, CASE WHEN bool_and(passed) OVER (PARTITION BY study) THEN 'passed' ELSE 'failed' END AS verdict,
           round((SELECT dbcv - prod FROM m WHERE m.study = c.study), 10) AS dbcv_delta FROM c""", "trials")
def _(v):
    """Every study's mean figures against those of its even trials."""
    grouped = v.trials.groupBy("study").agg(
        F.avg("dbcv").alias("dbcv_score"), F.avg("noise_ratio").alias("noise_ratio"), F.avg("cv_coherence").alias("cv_coherence"), F.count("*").alias("num_topics")
    )
    old = v.trials.where(F.col("trial_id") % 2 == 0).groupBy("study").agg(F.avg("dbcv").alias("dbcv_score"))
    rows = drift.validation_gates(grouped, old, by=["study"])
    return rounded(rows.select("study", "check", "new_value", "passed", "verdict", "dbcv_delta"), 10)


_FIGURES = "round(avg_probability, 9) AS avg_probability, round(low_confidence_ratio, 9) AS low_confidence_ratio, round(noise_ratio_inference, 9) AS noise_ratio_inference, round(topic_entropy, 9) AS topic_entropy, total_predictions"


@query("drift_metrics", """
    SELECT round(avg(probability), 6) AS avg_probability, round(count(*) FILTER (probability < 0.4) / count(probability)::DOUBLE, 6) AS low_confidence_ratio,
           round(count(*) FILTER (topic_id IS NULL OR topic_id < 0) / count(*)::DOUBLE, 6) AS noise_ratio_inference,
           round((SELECT -sum(p * log2(p + 1e-10)) FROM (SELECT count(*) / (sum(count(*)) OVER ())::DOUBLE AS p FROM log WHERE topic_id IS NOT NULL GROUP BY topic_id)), 6) AS topic_entropy,
           count(*) AS total_predictions FROM log""", "log")
def _(v):
    return rounded(drift.drift_metrics(v.log))


@query("daily_drift_flags", f"SELECT strftime(day, '%Y-%m-%d') AS day, {_FIGURES}, avg_prob, low_conf, noise FROM daily", "daily")
def _(v):
    return rounded(drift.daily_drift_flags(v.log).withColumn("day", F.col("day").cast("string")), 9)


@query("drift_streaks", "SELECT condition, strftime(start_day, '%Y-%m-%d') AS start_day, length FROM streaks", "streaks")
def _(v):
    return drift.drift_streaks(drift.daily_drift_flags(v.log)).withColumn("start_day", F.col("start_day").cast("string"))


@query("drift_trigger", """
    SELECT count(*) > 0 AS triggered, string_agg(CASE condition WHEN 'avg_prob' THEN 'avg_probability' WHEN 'low_conf' THEN 'low_confidence_ratio'
           ELSE 'noise_ratio_inference' END || ' violated for 3 consecutive days starting ' || strftime(start_day, '%Y-%m-%d'), '; ' ORDER BY condition) AS reasons
    FROM streaks""", "streaks")
def _(v):
    return drift.drift_trigger(v.log).withColumn("reasons", joined("reasons", "; "))


@query("retrain_window", """
    SELECT post_id FROM posts WHERE (SELECT count(*) FROM streaks) > 0 AND created_at >= TIMESTAMP '2024-06-04' AND created_at < TIMESTAMP '2024-12-02'
    ORDER BY created_at DESC, post_id DESC LIMIT 100""", "posts streaks")
def _(v):
    report = monitor.monitor(v.log, datetime(2024, 2, 1), days=60)
    return monitor.posts_for_retraining(v.posts, report, datetime(2024, 12, 1), latest=100).select("post_id")


# --- streams ----------------------------------------------------------------


def _files(df):
    """At least four files to arrive one after another; more where one of them would be too much for a task."""
    return df.repartition(max(4, df.rdd.getNumPartitions()))


def _drain(df, path: str, checkpoint: str) -> None:
    writer = df.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    writer.trigger(availableNow=True).start().awaitTermination()


@query("stream_classify", _CLASSIFIED.format("softclassified"), "softclassified")
def _(v):
    table, out = scratch_path(v.spark, "arriving"), scratch_path(v.spark, "out")
    arriving = v.emb_docs.join(v.emb.select("doc_id", "embedding"), "doc_id")
    arriving.repartition(4).write.parquet(table)
    stream = v.spark.readStream.schema(arriving.schema).option("maxFilesPerTrigger", 2).parquet(table)
    classified = stream_cls.stream_classify(stream, v.reference_model)
    _drain(classified, out, scratch_path(v.spark, "state"))
    return _flat(v.spark.read.schema(classified.schema).parquet(out))


def _daily_stream(v: Views):
    table, out = scratch_path(v.spark, "log"), scratch_path(v.spark, "days")
    v.log.repartitionByRange(4, "predicted_at").write.parquet(table)
    stream = v.spark.readStream.schema(v.log.schema).parquet(table)
    flags = stream_drift.stream_daily_drift(stream)
    _drain(flags, out, scratch_path(v.spark, "state"))
    return out, flags.schema


@query("stream_daily_drift", f"""
    SELECT strftime(day, '%Y-%m-%d') AS day, {_FIGURES}, avg_prob, low_conf, noise FROM daily
    WHERE day + INTERVAL 1 DAY <= (SELECT max(predicted_at) - INTERVAL 1 HOUR FROM log)""", "daily log")
def _(v):
    out, schema = _daily_stream(v)
    return rounded(v.spark.read.schema(schema).parquet(out).withColumn("day", F.col("day").cast("string")), 9)


@query("stream_drift_streaks", "SELECT condition, strftime(start_day, '%Y-%m-%d') AS start_day, length FROM streaks", "streaks")
def _(v):
    days, schema = _daily_stream(v)
    stream = v.spark.readStream.schema(schema).parquet(days)
    out = scratch_path(v.spark, "streaks")
    streaks = stream_drift.stream_drift_streaks(stream)
    _drain(streaks, out, scratch_path(v.spark, "state"))
    return v.spark.read.schema(streaks.schema).parquet(out).withColumn("start_day", F.col("start_day").cast("string"))


@query("stream_append_delta", "SELECT id_post, count(*) AS n FROM raw_posts GROUP BY id_post", "raw_posts")
def _(v):
    """A third of the posts is stored; all of them arrive, half of them twice."""
    table, arriving = scratch_path(v.spark, "posts"), scratch_path(v.spark, "arriving")
    v.raw_posts.where(F.col("id_post") % 3 == 0).write.parquet(table)
    again = v.raw_posts.where(F.col("id_post") % 2 == 0)
    _files(v.raw_posts.unionByName(again)).write.parquet(arriving)
    stream = v.spark.readStream.schema(v.raw_posts.schema).parquet(arriving)
    append.stream_append_delta(stream, table, scratch_path(v.spark, "state")).awaitTermination()
    return v.spark.read.parquet(table).groupBy("id_post").agg(F.count("*").alias("n"))
