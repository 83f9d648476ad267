import hashlib
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from topicflow import session
from topicflow.functions import scale
from topicflow.operators import outliers, sampling, topics
from topicflow.sources import posts as src


def key(i, seed=42):
    return hashlib.md5(f"{i}|{seed}".encode()).hexdigest()


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows in one group."""
    rows = [(i, "hot" if i % 2 else f"g{i % 7}", (i * 7919) % 1000) for i in range(4000)]
    return rows, spark.createDataFrame(rows, "id long, g string, v int").repartition(6).cache()


@pytest.fixture()
def many_ranges(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def test_sample_per_group(skewed):
    rows, df = skewed
    got = {r.id for r in scale.sample_per_group(df, ["g"], "id", F.lit(37)).collect()}
    want = set()
    for g in {r[1] for r in rows}:
        want |= set(sorted((r[0] for r in rows if r[1] == g), key=key)[:37])
    assert got == want
    assert {r.id for r in scale.sample_per_group(df, [], "id", F.lit(55)).collect()} == set(sorted((r[0] for r in rows), key=key)[:55])
    assert scale.sample_per_group(df, ["g"], "id", lambda n: n).count() == len(rows)


def test_null_group_is_a_group(spark):
    df = spark.createDataFrame([(i, None if i < 10 else "a") for i in range(30)], "id long, g string")
    counts = {r.g: r["count"] for r in scale.sample_per_group(df, ["g"], "id", F.lit(4)).groupBy("g").count().collect()}
    assert counts == {None: 4, "a": 4}


@pytest.mark.parametrize("k", [3, 150])
def test_top_k_per_group(skewed, k):
    rows, df = skewed
    got = {(r.g, r.id) for r in scale.top_k_per_group(df, ["g"], [F.desc("v"), F.asc("id")], k, "id").collect()}
    want = set()
    for g in {r[1] for r in rows}:
        best = sorted((r for r in rows if r[1] == g), key=lambda r: (-r[2], r[0]))[:k]
        want |= {(g, r[0]) for r in best}
    assert got == want


def test_dense_index_over_ranges(skewed, many_ranges):
    rows, df = skewed
    got = scale.dense_index(df, "id", "n").collect()
    assert {(r.id, r.n) for r in got} == {(i, i) for i in range(len(rows))}


def test_next_and_running_max_over_ranges(skewed, many_ranges):
    rows, df = skewed
    text = df.withColumn("v", F.col("v").cast("string"))
    nxt = {r.id: r.n for r in scale.next_in_group(text, ["g"], "id", "v", "n").collect()}
    top = {r.id: r.m for r in scale.running_max(df, ["g"], "id", "v", "m").collect()}
    for g in {r[1] for r in rows}:
        own = sorted(r for r in rows if r[1] == g)
        best = -1
        for here, after in zip(own, own[1:] + [None]):
            best = max(best, here[2])
            assert nxt[here[0]] == (str(after[2]) if after else None) and top[here[0]] == best


def test_latest_n(spark):
    random.seed(1)
    rows = [(i, f"2024-01-0{random.randint(1, 9)} 0{random.randint(0, 2)}:00:00") for i in range(300)]
    df = spark.createDataFrame(rows, "post_id long, t string").select("post_id", F.to_timestamp("t").alias("created_at"))
    for n in (1, 40, 299, 300, 1000):
        got = {r.post_id for r in src.latest_n_posts(df, n).collect()}
        assert got == {i for i, _ in sorted(rows, key=lambda r: (r[1], r[0]))[-n:]}
    assert src.latest_n_posts(df, 0).count() == 300


def test_uniform_sample_sizes(skewed):
    _, df = skewed
    assert sampling.uniform_sample_n(df, 0, "id").count() == 4000
    assert sampling.uniform_sample_n(df, 5000, "id").count() == 4000
    first, again = (sampling.uniform_sample_n(df, 17, "id").collect() for _ in range(2))
    assert first == again and len(first) == 17


def test_cap_leaves_noise_out(spark):
    df = spark.createDataFrame([(i, -1 if i < 50 else i % 3) for i in range(200)], "doc_id long, topic int")
    counts = {r.topic: r["count"] for r in sampling.cap_per_group(df, "topic", 20).groupBy("topic").count().collect()}
    assert counts == {0: 20, 1: 20, 2: 20}


def test_side_by_side(spark):
    a, b = spark.createDataFrame([(1, float("nan"))], "x int, y double"), spark.createDataFrame([(True, ["p"])], "z boolean, w array<string>")
    row = scale.side_by_side([a, b]).first()
    assert row.x == 1 and row.y != row.y and row.z is True and row.w == ["p"]


def test_shared_folder_comes_from_the_session(spark, tmp_path):
    old = spark.sparkContext.getCheckpointDir()
    spark.conf.set("spark.checkpoint.dir", str(tmp_path)) if old is None else None
    folder = session.shared_dir(spark)
    assert os.path.isabs(folder.removeprefix("file:"))
    assert session.scratch_path(spark, "x").startswith(folder.rstrip("/"))


def test_cluster_without_folder_is_an_error():
    class Context:
        master = "spark://host:7077"
        getCheckpointDir = staticmethod(lambda: None)

    class Fake:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.shared_dir(Fake())


def test_delta_rules(spark, tmp_path):
    head = "id_post,channel_name,post_date,text,views,reactions,comments\n"
    (tmp_path / "a.csv").write_text(head + '1,c,2024-01-01 10:00:00,"one, ""quoted""",5,,0\n2,c,2024-01-02 10:00:00,two,,1,0\n2,c,2024-01-02 10:00:00,two,,1,0\n')
    delta = src.read_delta(spark, str(tmp_path / "a.csv"))
    base = delta.where("id_post = 1")
    assert delta.where("id_post = 1").first().text == 'one, "quoted"'
    assert [r.id_post for r in src.append_delta(base, delta).collect()] == [2]
    assert src.append_delta(base, delta, dedup=False).count() == 3
    (tmp_path / "b.csv").write_text("id_post,text\n1,x\n")
    with pytest.raises(ValueError, match="missing"):
        src.read_delta(spark, str(tmp_path / "b.csv"))


def test_normalize_rules(spark):
    df = spark.createDataFrame([(1, "c", "t", "bad"), (2, "c", "t", "2024-01-01")], "id_post long, channel_name string, text string, post_date string")
    assert [r.post_id for r in src.normalize_posts(df).collect()] == [2]
    with pytest.raises(ValueError, match="no records"):
        src.normalize_posts(df.where("id_post = 1"), fail_if_empty=True)
    with pytest.raises(ValueError, match="channel"):
        src.normalize_posts(df.drop("channel_name"))


def test_range_scan_is_pushed_down(spark, views, tmp_path):
    views.raw_posts.write.parquet(f"{tmp_path}/deep/er")
    rows = src.scan_posts_range(spark, str(tmp_path), "2023-01-01", "2023-01-31").select("id_post")
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(post_date" in plan and "LessThan(post_date" in plan
    assert "ReadSchema: struct<id_post:bigint,post_date:timestamp>" in plan


def test_noise_texts_are_scored_in_runs_of_bounded_bytes(monkeypatch):
    monkeypatch.setattr(outliers, "TEXT_BYTES", 100)
    texts = ["ab cd"] * 50 + [None, "x" * 500, "", "ef"] + ["gh ij kl"] * 30
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "slice": [""] * len(texts), "w": texts})
    runs = list(outliers._text_runs(batch))
    assert pa.Table.from_batches(runs).to_pydict() == batch.to_pydict()
    assert max(sum(len(t or "") for t in r.column("w").to_pylist()[:-1]) for r in runs) <= 100
    assert len(runs) > 5 and list(outliers._text_runs(batch.slice(0, 0))) == []


def test_scores_do_not_depend_on_runs(spark):
    rows = [(i, -1 if i % 3 else i % 2, "ww%d ww%d vv%d" % (i % 5, i % 7, i % 4)) for i in range(90)]
    docs = spark.createDataFrame([(i, t) for i, _, t in rows], "doc_id long, text_lemm string")
    assigned = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, topic int")
    scores, _ = topics.describe_topics(docs, assigned)
    # some texts of about a run's size, so that the tasks cut their batches into several runs
    long = docs.withColumn("text_lemm", F.when(F.col("doc_id") % 10 == 1, F.repeat(F.concat("text_lemm", F.lit(" ")), 40_000)).otherwise(F.col("text_lemm")))
    found = {r.doc_id: (r.best, r.score) for r in outliers.ctfidf_scores(docs, assigned, scores).collect()}
    mixed = {r.doc_id: (r.best, r.score) for r in outliers.ctfidf_scores(long, assigned, scores).collect()}
    assert found.keys() == mixed.keys() == {i for i, t, _ in rows if t == -1}
    assert all(found[i] == mixed[i] for i in found if i % 10 != 1)
