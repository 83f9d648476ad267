import datetime as dt
import time

import pytest
from pyspark.sql import functions as F

from topicflow.operators import classify, drift
from topicflow.streaming import append, classify as stream_cls, drift as stream_drift

SCHEMA = "predicted_at timestamp, probability double, topic_id int"


def rows(days, p=0.1):
    return [(dt.datetime(2024, 1, d, h), p, h % 3 - 1) for d in days for h in (1, 13, 22)]


def put(spark, data, folder, number):
    """One file per call, in order of arrival."""
    spark.createDataFrame(data, SCHEMA).coalesce(1).write.parquet(f"{folder}/f{number}")
    time.sleep(0.05)


def drain(df, path, state):
    writer = df.writeStream.format("parquet").option("path", str(path)).option("checkpointLocation", str(state))
    writer.trigger(availableNow=True).start().awaitTermination()


def daily(spark, folder, tmp_path, per_batch=None):
    reader = spark.readStream.schema(SCHEMA).option("recursiveFileLookup", True)
    stream = (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(str(folder))
    flags = stream_drift.stream_daily_drift(stream)
    drain(flags, tmp_path / "days", tmp_path / "state")
    return spark.read.schema(flags.schema).parquet(str(tmp_path / "days"))


@pytest.mark.parametrize("per_batch", [None, 1])
def test_daily_drift_equals_batch(spark, tmp_path, per_batch):
    folder = tmp_path / "log"
    parts = [rows([1, 2]), rows([3]), rows([4, 5], 0.9), rows([6])]
    for number, part in enumerate(parts):
        put(spark, part, folder, number)
    got = daily(spark, folder, tmp_path, per_batch).orderBy("day").collect()
    batch = drift.daily_drift_flags(spark.createDataFrame(sum(parts, []), SCHEMA)).orderBy("day").collect()
    assert [r.day.day for r in got] == [1, 2, 3, 4, 5]  # the last day is still open
    for a, b in zip(got, batch):
        assert (a.day, a.avg_prob, a.low_conf, a.noise, a.total_predictions) == (b.day, b.avg_prob, b.low_conf, b.noise, b.total_predictions)
        assert abs(a.topic_entropy - b.topic_entropy) < 1e-9 and abs(a.avg_probability - b.avg_probability) < 1e-12


def test_late_rows_are_dropped(spark, tmp_path):
    folder = tmp_path / "log"
    put(spark, rows([1]), folder, 0)
    put(spark, rows([5]), folder, 1)
    put(spark, rows([6]), folder, 2)  # day 1 is closed and written with this batch
    put(spark, rows([1]), folder, 3)
    put(spark, rows([8]), folder, 4)
    got = {r.day.day: r.total_predictions for r in daily(spark, folder, tmp_path, 1).collect()}
    assert got == {1: 3, 5: 3, 6: 3}


@pytest.mark.parametrize("per_batch", [None, 1])
@pytest.mark.parametrize("calendar", [False, True])
def test_streaks_equal_batch(spark, tmp_path, per_batch, calendar):
    days = {1: True, 2: True, 4: True, 5: False, 6: True, 7: True, 8: True, 9: True}
    log = spark.createDataFrame([(dt.datetime(2024, 1, d), 0.1 if bad else 0.9, 1) for d, bad in days.items()], SCHEMA)
    flags = drift.daily_drift_flags(log)
    for number, day in enumerate(sorted(days)):
        flags.where(F.dayofmonth("day") == day).coalesce(1).write.parquet(f"{tmp_path}/flags/f{number}")
        time.sleep(0.05)
    reader = spark.readStream.schema(flags.schema).option("recursiveFileLookup", True)
    stream = (reader.option("maxFilesPerTrigger", per_batch) if per_batch else reader).parquet(f"{tmp_path}/flags")
    streaks = stream_drift.stream_drift_streaks(stream, calendar=calendar)
    drain(streaks, tmp_path / "out", tmp_path / "state")
    got = {tuple(r) for r in spark.read.schema(streaks.schema).parquet(str(tmp_path / "out")).collect()}
    assert got == {tuple(r) for r in drift.drift_streaks(flags, calendar=calendar).collect()}


@pytest.mark.parametrize("calendar", [False, True])
@pytest.mark.parametrize("order", [[3, 1, 2, 4, 6, 5, 8, 7, 9, 20], [2, 4, 1, 3, 7, 6, 5, 9, 8, 20]])
def test_streaks_with_late_days_equal_batch(spark, tmp_path, order, calendar):
    """One day per micro-batch, up to three days late: as the batch operator over the days that count."""
    good = {3, 6} if order[0] == 3 else {2}
    log = spark.createDataFrame([(dt.datetime(2024, 1, d), 0.9 if d in good else 0.1, 1) for d in order if d != 4], SCHEMA)
    flags = drift.daily_drift_flags(log)
    for number, day in enumerate(d for d in order if d != 4):
        flags.where(F.dayofmonth("day") == day).coalesce(1).write.parquet(f"{tmp_path}/flags/f{number}")
        time.sleep(0.05)
    reader = spark.readStream.schema(flags.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1)
    streaks = stream_drift.stream_drift_streaks(reader.parquet(f"{tmp_path}/flags"), calendar=calendar, late_days=3)
    drain(streaks, tmp_path / "out", tmp_path / "state")
    got = {tuple(r) for r in spark.read.schema(streaks.schema).parquet(str(tmp_path / "out")).collect()}
    counted = flags.where(F.dayofmonth("day") <= 17)
    assert got == {tuple(r) for r in drift.drift_streaks(counted, calendar=calendar).collect()} and got


def test_append_each_post_once(spark, tmp_path):
    schema = "id_post long, post_date timestamp, text string"
    at = lambda d: dt.datetime(2024, 1, d)
    table = str(tmp_path / "posts")
    spark.createDataFrame([(1, at(1), "old")], schema).write.parquet(table)
    batches = [[(1, at(1), "again"), (2, at(2), "b"), (2, at(2), "b")], [(3, at(9), "c")], [(2, at(2), "late"), (4, at(9), "d")]]
    for number, part in enumerate(batches):
        spark.createDataFrame(part, schema).coalesce(1).write.parquet(f"{tmp_path}/in/f{number}")
        time.sleep(0.05)
    for _ in range(2):  # the second run finds nothing new
        stream = spark.readStream.schema(schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        append.stream_append_delta(stream, table, str(tmp_path / "state")).awaitTermination()
    got = sorted((r.id_post, r.text) for r in spark.read.parquet(table).collect())
    assert got == [(1, "old"), (2, "b"), (3, "c"), (4, "d")]


def test_classify_batches_equals_batch(spark, views, tmp_path):
    docs = views.emb_docs.join(views.emb.select("doc_id", "embedding"), "doc_id")
    docs.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema(docs.schema).option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
    model = views.reference_model
    stream_cls.classify_batches(stream, model, f"{tmp_path}/out", f"{tmp_path}/state").awaitTermination()
    got = {r.doc_id: (r.topic_id, r.label, r.confidence) for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    batch = classify.classify_documents(docs.select("doc_id", "text"), docs.select("doc_id", "embedding"), model)
    assert got == {r.doc_id: (r.topic_id, r.label, r.confidence) for r in batch.collect()}
