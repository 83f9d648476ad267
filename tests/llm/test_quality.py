"""Estimated trust in rules: planted votes of known accuracy, repeated rules, single objections."""

import random

import pytest
from pyspark.sql import functions as F
from topicflow.llm import quality


def planted(spark, rules, n=12_000, good=0.8, seed=5):
    """Vote patterns of documents of a known class; a rule is (share of votes, accuracy) or (objects to bad, objects to good)."""
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        truth = 1 if draw.random() < good else -1
        votes = []
        for kind, a, b in rules:
            if kind == "both":
                votes.append(0 if draw.random() >= a else truth if draw.random() < b else -truth)
            else:
                votes.append(-1 if draw.random() < (a if truth < 0 else b) else 0)
        rows.append((truth, votes))
    docs = spark.createDataFrame(rows, "truth int, votes array<int>")
    columns = [F.col("votes")[j].alias(f"v{j}") for j in range(len(rules))]
    return docs, quality.vote_patterns(docs.select(*columns), [f"v{j}" for j in range(len(rules))])


def test_planted_accuracies_are_found(spark):
    rules = [("both", 0.9, 0.95), ("both", 0.7, 0.8), ("both", 0.8, 0.65), ("objects", 0.6, 0.02), ("objects", 0.5, 0.1), ("both", 0.5, 0.9)]
    docs, patterns = planted(spark, rules)
    trust = quality.estimate(patterns, len(rules), {j for j, r in enumerate(rules) if r[0] == "both"})
    assert trust.groups == [[j] for j in range(len(rules))] and abs(trust.good - 0.8) < 0.05
    for j, (kind, a, b) in enumerate(rules):
        if kind == "both":
            assert abs(trust.accuracies()[j] - b) < 0.05
        else:
            assert abs(trust.says["bad"][j][0] - a) < 0.05 and abs(trust.says["good"][j][0] - b) < 0.05
    right = docs.where((trust.posterior(F.col("votes")) >= 0.5) == (F.col("truth") == 1)).count()
    assert right >= 0.93 * docs.count()


def test_no_count_of_objections_gives_the_verdict(spark):
    """One objection of a rule that is always right rejects, two of rules that are mostly wrong don't."""
    rules = [("objects", 0.9, 0.001), ("objects", 0.4, 0.3), ("objects", 0.4, 0.3), ("objects", 0.8, 0.01), ("both", 0.9, 0.9)]
    _, patterns = planted(spark, rules)
    trust = quality.estimate(patterns, len(rules), {4})
    judged = spark.createDataFrame([([-1, 0, 0, 0, 0],), ([0, -1, -1, 0, 0],)], "votes array<int>").select(trust.posterior(F.col("votes"))).collect()
    assert judged[0][0] < 0.5 < judged[1][0]


def test_a_rule_given_twice_counts_once(spark):
    rules = [("both", 0.9, 0.9), ("objects", 0.6, 0.05), ("both", 0.8, 0.75), ("objects", 0.5, 0.03)]
    _, patterns = planted(spark, rules)
    twice = patterns.select(F.concat("votes", F.array(F.col("votes")[1], F.col("votes")[1])).alias("votes"), "count")
    one, more = quality.estimate(patterns, 4, {0, 2}), quality.estimate(twice, 6, {0, 2})
    assert more.groups == [[0], [1, 4, 5], [2], [3]]
    assert more.good == pytest.approx(one.good) and more.accuracies() == pytest.approx(one.accuracies())
    assert more.weights() == pytest.approx(one.weights())


def test_estimates_without_documents(spark):
    trust = quality.estimate(spark.createDataFrame([], "votes array<int>, count long"), 3, {0})
    assert trust.good == pytest.approx(quality.PRIOR_GOOD) and trust.groups == [[0], [1], [2]]
    assert trust.accuracies()[0] == pytest.approx(0.85)


def test_no_rule_knows_a_language(table):
    """Plain prose of several scripts gets no objection; the posterior is the same whichever the language."""
    lines = {
        "en": "The river rose in the night, and the old bridge fell before morning came. ", "fi": "Joki nousi yöllä ja vanha silta sortui ennen aamua kylän reunalla. ",
        "hi": "रात में नदी बढ़ी और पुराना पुल सुबह से पहले गिर गया था। ", "ru": "Ночью река поднялась, и старый мост рухнул ещё до утра. ",
    }
    draw = random.Random(3)
    sentence = lambda words: " ".join(draw.sample(words, 8))
    texts = [" ".join(sentence(s[:-2].split()) + s[-2] for _ in range(15)) for s in lines.values()]
    rows = quality.quality(table(texts)).collect()
    assert all(r.kept and not r.base_failed for r in rows) and len({round(r.quality, 9) for r in rows}) == 1
