"""Evolution, labels, classification, gates, drift and experiments on small inline cases."""

import datetime as dt
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from topicflow.config import ClusterParams, EvolutionThresholds, RingConfig
from topicflow.operators import classify, drift, evolution, labeling, outliers, search, topics
from topicflow.plans import fit

# --- evolution --------------------------------------------------------------


def centroids(spark, table):
    return spark.createDataFrame([(t, [float(x) for x in v]) for t, v in table.items()], "topic int, centroid array<double>")


def words(spark, table):
    rows = [(t, r + 1, w, 1.0 / (r + 1)) for t, ws in table.items() for r, w in enumerate(ws)]
    return spark.createDataFrame(rows, "topic int, rank int, word string, score double")


def no_verdicts(spark):
    return spark.createDataFrame([], "new_topic int, old_topic int, same_topic boolean, confidence string, reasoning string")


def full_best(new, old, wn, wo):
    """Best matches from the whole matrix."""
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    score = {}
    for a in new:
        for b in old:
            union = set(wn[a]) | set(wo[b])
            jac = len(set(wn[a]) & set(wo[b])) / len(union) if union else 0.0
            cos = round(float(unit(new[a]) @ unit(old[b])), 10)
            score[a, b] = round(0.7 * cos + 0.3 * jac, 10)
    out = {("new2old", a, min(old, key=lambda b: (-score[a, b], b))) for a in new}
    return out | {("old2new", min(new, key=lambda a: (-score[a, b], a)), b) for b in old}


@pytest.mark.parametrize("seed", range(4))
def test_best_matches_equal_the_full_matrix(spark, seed):
    rng = np.random.default_rng(seed)
    pick = random.Random(seed)
    new = {t: rng.normal(size=4) for t in range(9)}
    old = {t: (new[t % 9] + rng.normal(size=4)) for t in range(7)}
    vocabulary = [f"w{i}" for i in range(25)]
    wn, wo = ({t: pick.sample(vocabulary, 6) for t in side} for side in (new, old))
    pairs = evolution.candidate_pairs(centroids(spark, new), centroids(spark, old), words(spark, wn), words(spark, wo))
    got = {(r.direction, r.new_topic, r.old_topic) for r in evolution.best_matches(pairs).collect()}
    assert got == full_best(new, old, wn, wo)


def test_compare_models_end_to_end(spark, views):
    got = evolution.compare_models(views.centroids, views.old_centroids, views.new_words, views.old_words, views.verdicts)
    kinds = {(r.new_topic_id, r.evolution_type, r.matched_old_topic_id, r.inherited_topic_id) for r in got.collect()}
    stable = {(t, "Stable", t, t) for t in (0, 1, 4, 6, 7, 8)}
    assert kinds == stable | {(2, "Merged", 2, 2), (3, "Merged", 2, 2), (5, "Emerged", None, 9), (9, "Emerged", None, 10), (None, "Disappeared", 5, None)}


def test_equal_scores_take_the_lowest_id(spark):
    new, old = {0: [1, 0], 1: [0, 1]}, {3: [1, 0], 5: [1, 0], 8: [0, 1]}
    empty = words(spark, {0: ["x"]})
    best = evolution.best_matches(evolution.candidate_pairs(centroids(spark, new), centroids(spark, old), empty, words(spark, {3: ["y"]})))
    assert (0, 3) in {(r.new_topic, r.old_topic) for r in best.where("direction = 'new2old'").collect()}


def test_matching_needs_cosine(spark):
    c, w = centroids(spark, {0: [1, 0]}), words(spark, {0: ["x"]})
    with pytest.raises(ValueError):
        evolution.candidate_pairs(c, c, w, w, EvolutionThresholds(cosine_weight=0.0))


def test_taxonomy_types_and_ids(spark):
    rows = [  # direction, new, old, cosine, matched
        ("new2old", 0, 0, 0.9, True), ("new2old", 1, 4, 0.8, True), ("new2old", 2, 4, 0.75, True), ("new2old", 5, 0, 0.2, False),
        ("new2old", 7, 2, 0.3, False), ("old2new", 0, 0, 0.9, True), ("old2new", 1, 4, 0.8, True), ("old2new", 7, 2, 0.3, False),
    ]
    matches = spark.createDataFrame([(*r[:4], 0.0, r[3], None, r[4]) for r in rows],
                                    "direction string, new_topic int, old_topic int, cosine double, jaccard double, combined double, verdict boolean, matched boolean")
    got = {(r.new_topic_id, r.evolution_type, r.matched_old_topic_id, r.inherited_topic_id) for r in evolution.evolution_taxonomy(matches).collect()}
    assert got == {(0, "Stable", 0, 0), (1, "Merged", 4, 4), (2, "Merged", 4, 4), (5, "Emerged", None, 5), (7, "Emerged", None, 6), (None, "Disappeared", 2, None)}
    research = {(r.type, tuple(r.topics_old), tuple(r.topics_new)) for r in evolution.evolution_taxonomy_research(matches).collect()}
    assert research == {
        ("Emerged", (), (5,)), ("Emerged", (), (7,)), ("Disappeared", (2,), ()), ("Stable", (0,), (0,)), ("Stable", (4,), (1,)), ("Split", (4,), (1, 2)),
    }


def test_verdicts_count_only_for_border_pairs(spark):
    schema = "direction string, new_topic int, old_topic int, cosine double, jaccard double, combined double"
    best = spark.createDataFrame([("new2old", 0, 0, 0.5, 0.0, 0.35), ("new2old", 1, 1, 0.3, 0.0, 0.2), ("old2new", 0, 0, 0.5, 0.0, 0.35), ("old2new", 2, 1, 0.6, 0.0, 0.4)], schema)
    verdicts = spark.createDataFrame([(0, 0, True, "high"), (1, 1, True, "high"), (2, 1, True, "high")], "new_topic int, old_topic int, same_topic boolean, confidence string")
    got = {(r.direction, r.new_topic, r.old_topic): r.matched for r in evolution.match_topics(best, verdicts).collect()}
    # the pair (2, 1) was never asked in the new-to-old direction
    assert got == {("new2old", 0, 0): True, ("new2old", 1, 1): False, ("old2new", 0, 0): True, ("old2new", 2, 1): False}


def test_thresholds_are_half_open(spark):
    best = spark.createDataFrame([("new2old", i, 0, c) for i, c in enumerate([0.39, 0.4, 0.69, 0.7])], "direction string, new_topic int, old_topic int, cosine double")
    assert {r.new_topic for r in evolution.border_pairs(best).collect()} == {1, 2}


def test_cold_start(spark):
    t = spark.createDataFrame([(1, -1), (2, 3), (3, 3), (4, 0)], "doc_id long, topic int")
    assert {(r.new_topic_id, r.inherited_topic_id, r.reason) for r in evolution.cold_start_evolution(t).collect()} == {(3, 3, "cold_start"), (0, 0, "cold_start")}
    with pytest.raises(ValueError):
        evolution.cold_start_evolution(t, "other")


# --- rings and labels -------------------------------------------------------


def test_ring_edges(spark):
    d = spark.createDataFrame([(x,) for x in (0.0, 0.2, 0.3, 0.9999, 1.0, 1.2)], "d double")
    closed = [r[0] for r in d.select(labeling.assign_ring(F.col("d"), 0.2, 0.3)).collect()]
    opened = [r[0] for r in d.select(labeling.assign_ring(F.col("d"), 0.2, 0.3, open_end=True)).collect()]
    assert closed == [1, 2, 3, 3, None, None] and opened == [1, 2, 3, 3, 3, 3]


def test_boundaries_skip_single_documents(spark):
    rows = [(i, 0, i / 10) for i in range(5)] + [(99, 1, 5.0)]
    row = labeling.ring_boundaries(spark.createDataFrame(rows, "doc_id long, topic int, distance double")).first()
    values = np.array([0.0, 0.1, 0.2, 0.3, 0.4])
    assert np.allclose([row.q_low, row.q_high], np.quantile(values, [0.25, 0.60]))


def test_boundaries_cap_per_topic(spark):
    rows = [(i, i % 2, (i * 37 % 101) / 101) for i in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, topic int, distance double")
    assert labeling.ring_boundaries(df, RingConfig(per_topic=10)).count() == 1


def test_labels_follow_the_old_topic(spark):
    info = spark.createDataFrame([(-1, 9), (0, 5), (1, 4), (2, 3)], "topic int, count long")
    samples = spark.createDataFrame([(0, 1, 2)], "topic int, ring int, total_docs long")
    external = spark.createDataFrame([(1, '{"l1":"X","l2":"Y","l3":"Z","heterogeneous":true,"coverage":0.4}')], "topic int, payload string")
    inherited = spark.createDataFrame([(7, "a", "b", "c", False, None)], "topic int, l1 string, l2 string, l3 string, heterogeneous boolean, coverage double")
    records = spark.createDataFrame([(0, "Stable", 7), (1, "Emerged", None)], "new_topic_id int, evolution_type string, matched_old_topic_id int")
    rows = {r.Topic: r for r in labeling.label_topics(info, samples, external, inherited, records, (0.1, 0.2)).collect()}
    assert (rows[0].Human_Label, rows[0].label_source, rows[0].calls, rows[0].ring_1_count) == ("a:b:c", "inherited", 0, 2)
    assert (rows[1].Human_Label, rows[1].is_heterogeneous, rows[1].calls) == ("X:Y:Z", True, 1)
    assert (rows[2].Human_Label, rows[2].coverage, rows[2].calls) == ("ERROR::", None, 2)
    old = {r.Topic: r.label_source for r in labeling.label_topics(info, samples, external, inherited, records, (0.1, 0.2), compat=True).collect()}
    assert old[0] == "llm"  # looked up by the new id, which the older table does not have
    filled = {r.Topic: r.evolution_type for r in labeling.label_evolution_fill(spark.createDataFrame([(0,), (2,)], "Topic int"), records).collect()}
    assert filled == {0: "Stable", 2: "Emerged"}


# --- noise ------------------------------------------------------------------


def test_reassignment_rules(spark):
    t = spark.createDataFrame([(1, -1), (2, -1), (3, 4), (4, -1), (5, -1)], "doc_id long, topic int")
    s = spark.createDataFrame([(1, 0, 0.6), (2, 1, 0.5999), (3, 9, 1.0), (5, 2, 0.0)], "doc_id long, best int, score double")
    assert {r.doc_id: r.topic for r in outliers.reassign(t, s, 0.6).collect()} == {1: 0, 2: -1, 3: 4, 4: -1, 5: -1}
    # nothing in common is no match, even at threshold 0
    assert {r.doc_id: r.topic for r in outliers.reassign(t, s, 0.0).collect()}[5] == -1


def test_equal_centroids_take_the_lowest_topic(spark):
    emb = spark.createDataFrame([(1, [1.0, 0.0])], "doc_id long, embedding array<double>")
    t = spark.createDataFrame([(1, -1)], "doc_id long, topic int")
    c = centroids(spark, {-1: [1, 0], 5: [2, 0], 3: [1, 0]})
    assert outliers.reduce_outliers_embedding(emb, t, c).first().topic == 3


def test_report_without_moves(spark):
    t = spark.createDataFrame([(1, -1), (2, 0)], "doc_id long, topic int")
    row = outliers.reassignment_report(t, t, t).first()
    assert row.reassigned_total == 0 and row.top1_share == 0.0 and row.warning is False and row.noise_after == 0.5


def test_ctfidf_by_slice_equals_single_runs(spark):
    rows = [(i, "ab"[i % 2], i % 3, " ".join(random.Random(i).choices(["aa", "bb", "cc", "dd", "ee"], k=9))) for i in range(24)]
    docs = spark.createDataFrame(rows, "doc_id long, part string, topic int, text_lemm string")
    t = docs.select("doc_id", "topic")
    both = {(r.part, r.topic, r["rank"]): (r.word, round(r.score, 9)) for r in topics.describe_topics(docs, t, by=["part"], max_df=1.0)[1].collect()}
    for part in "ab":
        one = topics.describe_topics(docs.where(F.col("part") == part), t, max_df=1.0)[1].collect()
        assert {(part, r.topic, r["rank"]): (r.word, round(r.score, 9)) for r in one} == {k: w for k, w in both.items() if k[0] == part}


def test_texts_of_a_topic_are_joined_in_order(spark):
    docs = spark.createDataFrame([(2, "cc dd"), (1, "aa bb"), (3, "")], "doc_id long, text_lemm string")
    t = spark.createDataFrame([(1, 0), (2, 0), (3, 0)], "doc_id long, topic int")
    got = {r.term: r.tf for r in topics.term_counts(docs, t).collect()}
    assert got == {"aa": 1, "bb": 1, "cc": 1, "dd": 1, "aa bb": 1, "bb cc": 1, "cc dd": 1}
    assert "bb cc" not in {r.term for r in topics.term_counts(docs, t, join_documents=False).collect()}


def test_diversity_without_words(spark):
    empty = spark.createDataFrame([], "topic int, rank int, word string")
    assert topics.topic_diversity(empty).first().topic_diversity == 0.0


# --- classification ---------------------------------------------------------


def reference(spark, **more):
    labels = spark.createDataFrame([(0, "A", "B", "C", "core", "edge", True), (1, "D", "E", "F", "", "", True)],
                                   "topic int, l1 string, l2 string, l3 string, core_topic string, periphery_topic string, heterogeneous boolean")
    return classify.TopicReference(centroids(spark, {-1: [1, 1], 0: [1, 0], 1: [0, 1], 2: [-1, 0]}), labels, words(spark, {0: list("abcdefgh")}), (0.05, 0.2), **more)


def test_classify_documents(spark):
    good = "Погода в городе сегодня будет хорошей, ветер слабый, без осадков."
    angle = lambda a: [float(np.cos(a)), float(np.sin(a))]
    rows = [(1, good, angle(0.1)), (2, good, angle(0.5)), (3, good, angle(0.75)), (4, "💥💥💥", angle(0.0)), (5, good, angle(3.0)), (6, good, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, embedding array<double>")
    out = {r.doc_id: r for r in classify.classify_documents(docs.select("doc_id", "text"), docs.where("doc_id < 6").select("doc_id", "embedding"), reference(spark)).collect()}
    assert [out[i].label for i in (1, 2, 3)] == ["A -> B -> C", "A -> B", "A [периферия гетерогенного кластера]"]
    assert [out[i].zone for i in (1, 2, 3, 4)] == ["Ядро", "Основная", "Периферия", "Шум"]
    assert out[1].top_words == list("abcdef") and out[1].confidence == round(np.cos(0.1) ** 2, 3)
    assert (out[4].topic_id, out[4].confidence, out[4].assignment_method, out[4].cosine_dist) == (-1, 0.0, "invalid", None)
    assert out[5].label == "Нет метки" and out[5].top_words == [] and out[6].topic_id == -1
    zones = {r.zone: r for r in classify.zone_summary(spark.createDataFrame(list(out.values()))).collect()}
    assert zones["Ядро"].mean_depth == 2 / 2 + 0.5 or zones["Ядро"].docs == 2


def test_cluster_answer_before_the_nearest_centroid(spark):
    emb = spark.createDataFrame([(i, [float(np.cos(a)), float(np.sin(a))]) for i, a in [(1, 0.02), (2, 0.6), (3, 0.13)]], "doc_id long, embedding array<double>")
    points = spark.createDataFrame([(100, [1.0, 0.0], 1, 0.01)], "doc_id long, embedding array<double>, topic int, core double")
    out = {r.doc_id: r for r in classify.assign_topic(emb, reference(spark, points=points)).collect()}
    # inside the core distance; outside it; inside but below the threshold
    assert [(out[i].topic_id, out[i].assignment_method) for i in (1, 2, 3)] == [(1, "hdbscan"), (0, "soft_assign"), (0, "soft_assign")]


def test_recorded_confidence():
    """probability * (1 - distance) of recorded classifications, rounded inputs."""
    assert abs(round(0.457 * (1 - 0.252), 3) - 0.342) <= 0.0015


# --- gates and drift --------------------------------------------------------


def gates(spark, dbcv, prod=None, **more):
    m = spark.createDataFrame([(dbcv, more.pop("cv", 0.70), more.pop("noise", 0.20), more.pop("topics", 20))], "dbcv_score double, cv_coherence double, noise_ratio double, num_topics long")
    p = None if prod is None else spark.createDataFrame([(prod,)], "dbcv_score double")
    return {r.check: r for r in drift.validation_gates(m, p, **more).collect()}


def test_validation_gates(spark):
    edge = gates(spark, 0.95, 1.0)
    assert all(r.passed for r in edge.values()) and edge["dbcv"].verdict == "passed" and round(edge["dbcv"].dbcv_delta, 9) == -0.05
    assert gates(spark, 0.94, 1.0)["dbcv"].verdict == "failed"
    nan = float("nan")
    assert gates(spark, nan, 0.5)["dbcv"].passed is False
    cold = gates(spark, nan)["dbcv"]
    assert cold.passed and cold.note == "cold_start"
    changed = gates(spark, 0.1, 0.9, embedding_changed=True)["dbcv"]
    assert changed.passed and changed.note == "embedding_changed" and changed.production == 0.9
    for bad in (dict(cv=0.69), dict(cv=nan), dict(noise=0.21), dict(noise=nan), dict(topics=19)):
        assert gates(spark, 0.9, 0.9, **bad)["dbcv"].verdict == "failed"


def log(spark, rows):
    data = [(dt.datetime(2024, 1, d, h), p, t) for d, h, p, t in rows]
    return spark.createDataFrame(data, "predicted_at timestamp, probability double, topic_id int")


def test_drift_metrics_cases(spark):
    assert drift.drift_metrics(log(spark, [])).count() == 0
    row = drift.drift_metrics(log(spark, [(1, 0, None, None), (1, 1, None, -1)])).first()
    assert (row.avg_probability, row.low_confidence_ratio, row.noise_ratio_inference) == (0.0, 0.0, 1.0)
    assert abs(row.topic_entropy) < 1e-6 and row.total_predictions == 2
    row = drift.drift_metrics(log(spark, [(1, 0, 0.4, 0), (1, 1, 0.39, 1), (1, 2, 0.9, 1), (1, 3, None, 0)])).first()
    assert abs(row.avg_probability - (0.4 + 0.39 + 0.9) / 3) < 1e-12 and abs(row.low_confidence_ratio - 1 / 3) < 1e-12 and abs(row.topic_entropy - 1) < 1e-6


def bad_days(spark, days):
    return log(spark, [(d, 0, 0.1 if bad else 0.9, 1) for d, bad in days.items()])


def test_streaks(spark):
    gap = {1: True, 2: True, 4: True, 5: False, 6: True, 7: True, 8: True, 9: True}
    flags = drift.daily_drift_flags(bad_days(spark, gap))
    streaks = {r.condition: (str(r.start_day), r.length) for r in drift.drift_streaks(flags).collect()}
    assert streaks == {"avg_prob": ("2024-01-01", 3), "low_conf": ("2024-01-01", 3)}  # a day without data does not break a run
    calendar = {r.condition: str(r.start_day) for r in drift.drift_streaks(flags, calendar=True).collect()}
    assert calendar == {"avg_prob": "2024-01-06", "low_conf": "2024-01-06"}
    assert drift.drift_streaks(drift.daily_drift_flags(bad_days(spark, {1: True, 2: True, 3: False, 4: True}))).count() == 0


def test_trigger(spark):
    assert tuple(drift.drift_trigger(log(spark, [])).first()) == (False, ["no_data"])
    assert tuple(drift.drift_trigger(bad_days(spark, {1: True, 2: True})).first()) == (False, [])
    assert tuple(drift.drift_trigger(bad_days(spark, {1: False, 2: False, 3: True})).first()) == (False, [])
    row = drift.drift_trigger(bad_days(spark, {1: True, 2: True, 3: True})).first()
    assert row.triggered and row.reasons[0] == "avg_probability violated for 3 consecutive days starting 2024-01-01" and len(row.reasons) == 2


def test_retrain_only_when_triggered(spark, views):
    off = spark.createDataFrame([(False,)], "triggered boolean")
    assert drift.retrain_window(views.posts, off, dt.date(2024, 12, 1)).count() == 0


# --- experiments ------------------------------------------------------------


def test_scores_and_ranking(spark):
    nan = float("nan")
    rows = [(0, 0.625, 0.25), (1, nan, 0.1), (2, 0.75, 0.5), (3, None, 0.0), (4, 0.5, 0.0)]
    trials = spark.createDataFrame(rows, "trial_id long, dbcv double, noise_ratio double")
    scored = trials.withColumn("score", search.trial_score(F.col("dbcv"), F.col("noise_ratio")))
    assert {r.trial_id: round(r.score, 9) for r in scored.collect()} == {0: 0.5, 1: -999.0, 2: 0.5, 3: -999.0, 4: 0.5}
    assert [r.trial_id for r in search.rank_trials(scored, 3).orderBy("rank").collect()] == [0, 2, 4]


def test_select_config(spark):
    rows = [("Baseline", -1, 0.9, 0.0, 0.9), ("a", 0, 0.5, 0.2, 0.74), ("b", 1, 0.4, 0.2, 0.75), ("c", 2, 0.45, 0.1, 0.8), ("d", 3, float("nan"), 0.1, 0.8)]
    configs = spark.createDataFrame(rows, "label string, trial_id long, dbcv double, noise_ratio double, cv_coherence double")
    assert search.select_config(configs).first().label == "c"
    assert search.select_config(configs.where("label in ('Baseline', 'a')")).first().label == "Baseline"


def test_parameter_rules():
    base = ClusterParams(min_cluster_size=53, min_samples=146)
    scaled = base.scaled(100_000)
    assert (scaled.min_cluster_size, scaled.min_samples) == (17, 48)
    assert (base.scaled(100).min_cluster_size, base.scaled(100).min_samples) == (10, 5)
    assert base.for_heterogeneous().min_cluster_size == 37


def test_fit_save_and_load(spark, views, tmp_path):
    docs = views.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    model = fit.fit_topics(docs, views.emb, ClusterParams(10, 5, 8))
    model.save(f"{tmp_path}/model")
    again = fit.TopicModel.load(spark, f"{tmp_path}/model")
    assert again.metrics.first().num_topics == model.metrics.first().num_topics >= 5
    assert again.metrics.first().few_topics is True
    assert again.info.count() == again.centroids.count()


# --- many slices in one job -------------------------------------------------


@pytest.fixture(scope="module")
def sliced(spark):
    """Three slices with their own topics, vectors and texts; one slice is all noise."""
    rng = np.random.default_rng(11)
    rows = []
    for i in range(240):
        part, topic = "abc"[i % 3], int(rng.integers(-1, 4))
        topic = -1 if part == "c" else topic
        vector = rng.normal(size=3) + 5 * np.eye(3)[topic % 3]
        rows.append((i, part, topic, [float(x) for x in vector], " ".join(rng.choice(["aa", "bb", "cc", "dd", "ee", "ff"], 8))))
    return spark.createDataFrame(rows, "doc_id long, part string, topic int, embedding array<double>, text_lemm string").cache()


def test_metrics_by_slice_equal_single_runs(spark, sliced):
    from topicflow.operators import quality

    top, docs, emb = sliced.select("doc_id", "part", "topic"), sliced.select("doc_id", "part", "text_lemm"), sliced.select("doc_id", "embedding")
    _, words_by = topics.describe_topics(docs, top, by=["part"], max_df=1.0)
    got = {r.part: r for r in quality.model_metrics(top, words_by, docs, emb, by="part").collect()}
    for part in "abc":
        mine = lambda df: df.where(F.col("part") == part)
        one = quality.model_metrics(mine(top), mine(words_by), mine(docs), emb).first()
        for c in ("num_topics", "noise_ratio", "dbcv_score", "cv_coherence", "topic_diversity"):
            a, b = got[part][c], one[c]
            assert (a is None or a != a) and (b is None or b != b or b == 0.0) or abs(a - b) < 1e-9, (part, c, a, b)


def test_noise_by_slice_equals_single_runs(spark, sliced):
    top, docs, emb = sliced.select("doc_id", "part", "topic"), sliced.select("doc_id", "part", "text_lemm"), sliced.select("doc_id", "part", "embedding")
    scores, _ = topics.describe_topics(docs, top, by=["part"], max_df=1.0)
    cent = topics.topic_centroids(emb, top, by=["part"])
    step1 = outliers.reduce_outliers_ctfidf(docs, top, scores, 0.3, by=["part"])
    step2 = outliers.reduce_outliers_embedding(emb, step1, cent, 0.6, by="part")
    report = {r.part: r.asDict() for r in outliers.reassignment_report(top, step1, step2, by=["part"]).collect()}
    for part in "ab":
        mine = lambda df: df.where(F.col("part") == part)
        one1 = outliers.reduce_outliers_ctfidf(mine(docs), mine(top), mine(scores), 0.3)
        one2 = outliers.reduce_outliers_embedding(mine(emb), one1, mine(cent), 0.6)
        want = outliers.reassignment_report(mine(top), one1, one2).first().asDict()
        assert {k: v for k, v in report[part].items() if k != "part"} == want
    assert report["c"]["reassigned_total"] == 0


def test_arriving_files_follow_the_input(spark):
    """Four files whatever the size would make one task read a quarter of all posts."""
    from topicflow.registry.lifecycle import _files

    assert _files(spark.range(100).repartition(9)).rdd.getNumPartitions() == 9
    assert _files(spark.range(100).repartition(2)).rdd.getNumPartitions() == 4


def test_texts_are_checked_once(spark):
    """Two searches and the result ask which texts are usable; each text is read once for that."""
    read = spark.sparkContext.accumulator(0)

    def counted(text):
        read.add(1)
        return text

    docs = spark.createDataFrame([(i, "Погода в городе сегодня будет хорошей, ветер слабый, без осадков.") for i in range(20)], "doc_id long, text string")
    seen = docs.repartition(2).select("doc_id", F.udf(counted, "string")("text").alias("text"))
    emb = docs.select("doc_id", F.array(F.lit(1.0), F.col("doc_id") / 40.0).alias("embedding"))
    points = spark.createDataFrame([(100, [1.0, 0.0], 1, 0.01)], "doc_id long, embedding array<double>, topic int, core double")
    assert len(classify.classify_documents(seen, emb, reference(spark, points=points)).collect()) == 20
    assert read.value == 20
