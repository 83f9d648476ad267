"""Whole chains, whole tables, and executors that can't import the package."""

import subprocess
import sys
import textwrap
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from conftest import SF
from topicflow.config import ClusterParams
from topicflow.plans import fit, train, tune

ROOT = Path(__file__).resolve().parents[1]


def test_every_document_has_a_text_and_a_vector(spark, views):
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    assert views.emb.count() == n == views.emb.select("doc_id").distinct().count()
    assert views.emb_docs.where("text <> ''").count() == spark.read.parquet(f"{SF}/documents.parquet").where("text <> ''").count()
    assert views.reference_model.points.count() == views.emb.where("topic <> -1").count()
    assert views.emb.select(F.sha2(F.array_join("embedding", ","), 256)).distinct().count() == n


@pytest.fixture(scope="module")
def run(spark, views):
    posts = views.posts.select("post_id", "channel", "created_at", "text")
    vectors = views.emb.select("doc_id", "embedding")
    embed = lambda d: vectors.join(d.select("doc_id"), "doc_id", "left_semi")
    old = train.Production(views.old_centroids, views.old_words, views.production_table, spark.createDataFrame([(0.1,)], "dbcv_score double"))
    return train.train(posts, ClusterParams(5, 3, 8), old, embed=embed), posts, embed


def test_train(run, views, tmp_path):
    result, _, _ = run
    assert result.model.topics.count() == views.docs.count()
    topics = {r.topic for r in result.model.info.collect()} - {-1}
    new = [r.new_topic_id for r in result.records.collect() if r.new_topic_id is not None]
    assert topics and sorted(new) == sorted(topics)
    assert {r.Topic for r in result.labels.collect()} == topics == {r.topic for r in result.prompts.collect()}
    assert [r.check for r in result.gates.collect()] == ["dbcv", "cv_coherence", "noise_ratio", "num_topics"]
    result.save(str(tmp_path / "run"))
    assert (tmp_path / "run" / "model" / "words").exists() and (tmp_path / "run" / "gates").exists()


def test_train_without_a_model_in_use(run):
    _, posts, embed = run
    result = train.train(posts, ClusterParams(5, 3, 8), embed=embed)
    assert {r.evolution_type for r in result.records.collect()} <= {"Emerged"} and result.border.count() == 0
    assert {r.note for r in result.gates.collect() if r.check == "dbcv"} == {"cold_start"}


def test_tune(views):
    docs = views.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    space = {"n_components": (6, 8), "min_cluster_size": (4, 6), "min_samples": (3, 4)}
    found = tune.tune(docs, views.emb.select("doc_id", "embedding"), ClusterParams(5, 3, 8), 2, 100, 2, space, coherence_min=0.0)
    configs = found.configs.collect()
    assert found.trials.count() == 2 and len(configs) == 3 and configs[0].label == "Baseline"
    assert found.choice.first().label in {r.label for r in configs}


def test_a_failing_full_fit_ends_the_tuning(views, monkeypatch):
    """It must not become a row of the table that looks like a fit without figures."""
    def broken(*args, **options):
        raise ValueError("broken")

    monkeypatch.setattr(tune, "fit_topics", broken)
    monkeypatch.setattr(tune, "search_trials", lambda emb, *a: emb.sparkSession.createDataFrame(
        [("s", 0, 6, 5, 3, 0.5)], "study string, trial_id int, n_components int, min_cluster_size int, min_samples int, score double"))
    docs = views.emb_docs.select("doc_id", F.col("text").alias("text_lemm"))
    with pytest.raises(ValueError, match="broken"):
        tune.tune(docs, views.emb.select("doc_id", "embedding"), ClusterParams(5, 3, 8), 1, top=1)


def test_sweep_takes_the_best_cut(views):
    vectors = views.emb.select("doc_id", "embedding")
    eps, tried = tune.sweep_eps(vectors, ClusterParams(5, 3, 8), (0.5, 0.9))
    assert len(tried) == 2 and eps == max(tried, key=lambda t: (t[3], t[0]))[1]


def test_a_failing_trial_is_recorded(views, monkeypatch):
    plain, calls = fit.density_cluster, []

    def sometimes(*args, **options):
        calls.append(1)
        if len(calls) == 1:
            raise ValueError("broken")
        return plain(*args, **options)

    monkeypatch.setattr(fit, "density_cluster", sometimes)
    space = {"n_components": (6, 6), "min_cluster_size": (4, 6), "min_samples": (3, 4)}
    rows = sorted(fit.search_trials(views.emb, 2, space).collect(), key=lambda r: r.trial_id)
    assert rows[0].score == -999 and "broken" in rows[0].error and rows[1].error is None


def test_shipping_the_package(tmp_path):
    """Workers that start outside the repository find the package only after it was sent."""
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {str(ROOT)!r})
        from topicflow.session import build_session, ship_package
        from topicflow.functions.vectors import cosine_similarity
        from pyspark.sql import functions as F
        spark = build_session("ship", "1", shuffle=1)
        ship_package(spark)
        df = spark.createDataFrame([([1.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
        print("FOUND", df.select(cosine_similarity(F.col("a"), F.col("b"))).first()[0])
    """)
    env = {k: v for k, v in __import__("os").environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "FOUND 1.0" in out.stdout, out.stderr[-2000:]


def test_slices_break_ties_as_single_runs_do(spark):
    """Two equal old centroids: a new topic takes the lower id in every slice."""
    from topicflow.operators.evolution import best_matches, candidate_pairs

    slices = [f"s{k}" for k in range(6)]
    old = spark.createDataFrame([(s, t, [1.0, 0.0]) for s in slices for t in (5, 3)], "slice string, topic int, centroid array<double>")
    new = spark.createDataFrame([(s, 1, [1.0, 0.1]) for s in slices], "slice string, topic int, centroid array<double>")
    words = spark.createDataFrame([(s, 1, 1, "w", 1.0) for s in slices], "slice string, topic int, rank int, word string, score double")
    other = words.withColumn("word", F.lit("v"))
    best = best_matches(candidate_pairs(new, old, words, other, by="slice"), ["slice"]).where("direction = 'new2old'")
    assert {(r.slice, r.old_topic) for r in best.collect()} == {(s, 3) for s in slices}


def test_the_newest_version_of_a_key_is_kept(spark):
    from topicflow.sources.posts import append_delta

    rows = [(1, "2024-01-05", "old"), (1, "2024-02-01", "new"), (2, None, "undated"), (2, "2024-01-01", "dated"), (3, "2024-01-01", "known")]
    delta = spark.createDataFrame(rows, "id_post long, post_date string, text string")
    base = delta.where("id_post = 3")
    assert {(r.id_post, r.text) for r in append_delta(base, delta).collect()} == {(1, "new"), (2, "dated")}


def test_large_models_on_a_stream_go_in_blocks(spark, views):
    from topicflow.streaming.classify import nearest_centroid

    whole, cut = nearest_centroid(views.centroids), nearest_centroid(views.centroids, block_bytes=1200)
    rows = views.emb.select("doc_id", whole(F.col("embedding")).alias("a"), cut(F.col("embedding")).alias("b")).collect()
    assert rows and all(r.a == r.b for r in rows)


