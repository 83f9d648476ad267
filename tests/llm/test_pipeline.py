"""The pipeline and the registered queries."""

import collections

import corpus_pipeline
from conftest import SF, ordered, plain, same
from topicflow.llm import dedup, near, quality, toxicity
from topicflow.llm import queries as llm

import __spark_entry__ as entry


def test_every_operator_is_registered():
    numbers = [n.split("_")[0] for n in llm.QUERIES if n.startswith("op")]
    assert sorted(numbers) == sorted(f"op{k}" for k in range(1, 14)) and "pipeline" in llm.QUERIES
    assert set(llm.QUERIES) <= set(entry.queries()) and set(llm.ORACLES) <= set(entry.oracle_sql())


def test_queries_return_their_tables(spark):
    for name, build in llm.QUERIES.items():
        if name.startswith("op") and name.split("_")[0] not in ("op11", "op13"):  # one row per node or word
            wanted = spark.read.parquet(f"{SF}/{'pages' if name.startswith('op6') else 'documents'}.parquet").count()
            rows = build(spark, SF).count()
            assert rows >= wanted if name.startswith("op5") else rows == wanted, name


def test_sql(spark, duck):
    for name, sql in llm.ORACLES.items():
        df = llm.QUERIES[name](spark, SF)
        columns = sorted(df.columns)
        rows = [tuple(plain(r[c]) for c in columns) for r in df.collect()]
        found = duck.execute(sql)
        place = [[d[0] for d in found.description].index(c) for c in columns]
        wanted = [tuple(plain(r[i]) for i in place) for r in found.fetchall()]
        assert len(rows) == len(wanted)
        assert all(same(a, b) for x, y in zip(ordered(rows), ordered(wanted)) for a, b in zip(x, y)), name


def test_stages(spark):
    """Each stage keeps the columns and does what its operator says of its input."""
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    verdicts = {
        "quality rules": lambda d: {r.doc_id for r in quality.quality(d).collect() if r.kept},
        "toxicity": lambda d: {r.doc_id for r in toxicity.toxicity(d, labels).collect() if r.score < 0.5},
        "exact dedup": lambda d: {r.doc_id for r in dedup.deduplicate(d).collect() if r.kept},
        "near dedup": lambda d: {r.doc_id for r in near.near_duplicates(d).collect() if r.kept},
    }
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = spark.createDataFrame(stage(spark, docs, SF).collect(), docs.schema)
        assert after.columns == docs.columns
        assert {r.doc_id for r in after.collect()} == verdicts[name](docs)
        docs = after
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_run(spark):
    whole = corpus_pipeline.run(spark, SF).collect()
    ids = {p.doc_id for p in whole}
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert ids and ids < set(texts)
    assert len({texts[i] for i in ids}) == len(ids)
    lengths = collections.Counter()
    for p in whole:
        assert len(p.ids) == 2 * p.length
        lengths[p.doc_id] += p.length
    assert all(lengths[p.doc_id] == p.doc_tokens for p in whole)


def test_scratch_tables_are_deleted(spark, odd):
    """A stage deletes what the one before left, but not what its input still reads; columns pass through."""
    import os

    from topicflow.session import shared_dir

    folder = shared_dir(spark)
    first = corpus_pipeline.STAGES[0][1](spark, odd, SF)
    assert first.columns == odd.columns
    lazy = corpus_pipeline.STAGES[2][1](spark, first, SF)  # reads the tables of the first stage
    assert lazy.columns == odd.columns and lazy.count() <= first.count()
    before = set(os.listdir(folder.removeprefix("file:")))
    result = corpus_pipeline.run(spark, SF)
    assert result.count() > 0
    made = set(os.listdir(folder.removeprefix("file:"))) - before
    assert {name.rsplit("-", 1)[0] for name in made} == {"packing"}


def test_stages_on_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


