"""Every registered query against its SQL, on the smallest tables."""

import re

import pyarrow.parquet as pq
import pytest

import __spark_entry__ as entry
from conftest import SF, ordered, plain, same
from topicflow.operators.preprocess import preprocess_posts
from topicflow.operators.topics import term_counts
from topicflow.registry import ORACLES, QUERIES
from topicflow.registry.views import ALL_STOP_WORDS, Views


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("CartesianProduct|BroadcastNestedLoopJoin", plan)
    if name not in ORACLES:
        assert rows
        return
    found = duck.execute(ORACLES[name])
    names = [d[0] for d in found.description]
    assert sorted(names) == columns
    place = [names.index(c) for c in columns]
    wanted = [tuple(plain(r[i]) for i in place) for r in found.fetchall()]
    assert len(rows) == len(wanted)
    for left, right in zip(ordered(rows), ordered(wanted)):
        assert all(same(a, b) for a, b in zip(left, right)), (left, right)


def test_entry_offers_all():
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    rows = entry.entry(spark).collect()
    assert rows and {"topic", "rank", "word", "score"} == set(rows[0].asDict())


def test_only_checks_without_sql():
    """Queries that SQL cannot state: spanning trees, principal components, whole fits."""
    assert set(QUERIES) - set(ORACLES) == {
        "reduce_dims", "fit_topics", "reduce_noise_plan", "dbcv", "model_metrics", "search_trials", "train_chain", "tune_chain", "density_hierarchy",
    }


def same_rows(left, right):
    return sorted(map(tuple, left.collect())) == sorted(map(tuple, right.collect()))


def _topic_view(spark, rows):
    view = Views(spark, SF)
    view.__dict__["docs"] = spark.createDataFrame(rows, "doc_id long, channel string, created_at timestamp, text_clean string, text_lemm string")
    return view


def test_texts_with_unique_ids_are_not_moved_for_their_topics(spark):
    rows = [(i, f"src{i % 3}", None, "", f"aa{i % 4} bb{i % 5} cc") for i in range(1, 40)]
    view = _topic_view(spark, rows)
    assert view._labelled[1] is None
    assert same_rows(view.counts, term_counts(view.docs, view.text_topics))


def test_texts_with_repeated_or_missing_ids_meet_all_topics_of_their_id(spark):
    rows = [(i % 30 or None, f"src{i % 3}", None, "", f"aa{i % 4} bb{i % 5} cc") for i in range(1, 40)]
    view = _topic_view(spark, rows)
    assert view._labelled[1] is not None
    counts = term_counts(view.docs, view.text_topics, join_documents=False)
    assert same_rows(term_counts(*view._labelled, join_documents=False), counts)


def test_core_distances_come_from_every_point(spark, views, monkeypatch):
    """No draw of so many points a topic, however large that number is."""
    from topicflow.operators import quality

    monkeypatch.setattr(quality, "cap_per_group", lambda *a, **o: pytest.fail("points were drawn"))
    assert QUERIES["dbcv_core_distances"](spark, SF).count() == views.topics.where("topic <> -1").count()


def test_written_posts_hold_their_text_once(spark):
    view = Views(spark, SF)
    files = [f.removeprefix("file:") for f in view.prep.inputFiles()]
    names = {tuple(pq.read_schema(f).names) for f in files}
    assert names == {("post_id", "channel", "created_at", "text_clean", "text_lemm")}
    kept = preprocess_posts(view.posts, stop_words=ALL_STOP_WORDS, with_tokens=True).select("post_id", "tokens")
    assert same_rows(view.prep.select("post_id", "tokens"), kept)
