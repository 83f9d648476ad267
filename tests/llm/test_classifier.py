"""The quality classifier: statistics and splits by plain loops, held-out labels."""

import collections
import math

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF
from topicflow.llm import classifier

BIG = SF.replace("0.001", "0.01")


def plain(text):
    """Some of the statistics, counted one by one."""
    words = text.translate({k: k + 32 for k in range(65, 91)}).replace("\x0b", " ").replace("\x0c", " ").split(" ")
    words = [w for part in words for w in part.replace("\t", " ").replace("\n", " ").replace("\r", " ").split(" ") if w]
    lines = [x for x in text.split("\n") if x.strip()]
    counts, n = collections.Counter(words), max(len(words), 1)
    again = lambda items: len(items) - len(set(items))
    return {
        "log_chars": math.log1p(len(text)), "log_words": math.log1p(len(words)), "log_lines": math.log1p(len(lines)),
        "word_length": sum(map(len, words)) / n, "short_words": sum(len(w) <= 3 for w in words) / n, "distinct_words": len(counts) / n,
        "top_word": max(counts.values(), default=0) / n, "stutter": sum(a == b for a, b in zip(words, words[1:])) / n,
        "repeated_pairs": again(list(zip(words, words[1:]))) / n, "repeated_triples": again(list(zip(words, words[1:], words[2:]))) / n,
        "repeated_lines": again(lines) / max(len(lines), 1), "digits": sum(c in "0123456789" for c in text) / max(len(text), 1),
        "bars": text.count("|") / n, "calls": text.count("!") / n, "longest_line": math.log1p(max(map(len, text.split("\n")))),
        "wide": sum(ord(c) > 127 for c in text) / max(len(text), 1), "words_per_line": len(words) / max(len(lines), 1),
    }


def test_statistics_equal_plain_counts():
    texts = ["", " ", "\n\n", "word", "A a a b\nA a a b\n\nx1 | y!! é日本", "to be or to be or " * 700, "x" * 70_000, "é ß 😀 😀\n😀", "1 2 3\r\n1 2 3\r\n"]
    got = classifier.statistics_of(pa.array(texts))
    assert got.shape == (len(texts), len(classifier.NAMES)) and np.isfinite(got).all()
    for row, text in zip(got, texts):
        for name, value in plain(text).items():
            assert row[classifier.NAMES.index(name)] == pytest.approx(value), (name, text[:20])
    alone = np.concatenate([classifier.statistics_of(pa.array([t])) for t in texts])
    assert np.allclose(got, alone)  # neighbours in a batch do not matter


def test_best_split_equals_a_search_over_all_bounds():
    draw = np.random.default_rng(1)
    x, g, h = draw.integers(0, 12, (300, 5)).astype(float), draw.normal(size=300), draw.random(300)
    node = draw.integers(0, 3, 300)
    edges = classifier.bounds_of(x)
    binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T)], axis=1)
    gain, which, last = classifier.best_splits(g, h, node, binned, 3)
    worth = lambda s: g[s].sum() ** 2 / (h[s].sum() + classifier.SHRINK)
    for k in range(3):
        here, best = node == k, 0.0
        for j in range(5):
            for bound in edges[j]:
                left, right = here & (x[:, j] <= bound), here & (x[:, j] > bound)
                if min(h[left].sum(), h[right].sum()) >= classifier.LEAST_CURVATURE:
                    best = max(best, worth(left) + worth(right) - worth(here))
        assert gain[k] == pytest.approx(best)
        left = here & (x[:, which[k]] <= edges[which[k]][last[k]])
        assert worth(left) + worth(here & ~left) - worth(here) == pytest.approx(best)


def test_flat_traversal_equals_walking_each_tree():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(400, 6))
    y = (x[:, 0] * x[:, 1] > 0) | (x[:, 2] > 1)
    forest = classifier.grow(x, y)

    def walk(row):
        out = forest.start
        for feature, bound, value in zip(forest.feature, forest.bound, forest.value):
            k = 0
            while k < len(feature):
                k = 2 * k + (2 if row[feature[k]] > bound[k] else 1)
            out += value[k - len(feature)]
        return out

    assert np.allclose(forest.odds(x), [walk(r) for r in x])
    assert ((forest.probability(x) >= 0.5) == y).mean() > 0.97


def test_one_kind_of_label_or_none():
    x = np.zeros((3, 2))
    assert classifier.grow(x[:0], np.zeros(0)).probability(x) == pytest.approx([0.5] * 3)
    assert classifier.grow(x, np.ones(3)).probability(x) == pytest.approx([3.5 / 4] * 3)


def test_sample_is_drawn_after_the_join(spark, table):
    """Labels without a document do not use up the sample."""
    stats = classifier.statistics(table([f"word {k}" for k in range(300)]))
    labels = spark.range(100_000).selectExpr("id AS doc_id", "cast(id % 2 AS int) AS quality")
    eligible = classifier.training_rows(stats, labels, "quality").count()
    assert 220 < eligible < 260
    assert classifier.training_rows(stats, labels, "quality", most=50).count() == 50


def test_held_out_labels(spark):
    docs, labels = spark.read.parquet(f"{BIG}/documents.parquet"), spark.read.parquet(f"{BIG}/labels.parquet")
    got = classifier.quality_scores(docs, labels)
    assert got.count() == docs.count()
    rows = got.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and np.mean([r.predicted == r.quality for r in rows]) >= 0.95
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.collect())


def test_odd_rows(spark, odd):
    labels = spark.createDataFrame([(k, k % 2 if k != 3 else None) for k in range(9)] + [(4, 1), (None, 1)], "doc_id long, quality int")
    got = classifier.quality_scores(odd, labels).collect()
    assert len(got) == odd.count() and all(0 <= r.score <= 1 for r in got)
    assert {r.score for r in got if r.doc_id == 0} == {r.score for r in got if r.doc_id == 1}  # null and empty text
    assert classifier.quality_scores(odd.limit(0), labels).count() == 0
    assert {r.score for r in classifier.quality_scores(odd, labels.limit(0)).collect()} == {0.5}
