"""Spelling variants against brute force."""

import collections
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF
from topicflow.llm import spelling


def expected(rows):
    counts = collections.Counter()
    for doc_id, text in rows:
        for run in re.findall("[a-zÀ-ÿ]+", (text or "").translate({k: k + 32 for k in range(65, 91)})):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 31 == 0 else run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= 7 and n >= 2}
    alike, near, form = collections.defaultdict(set), collections.defaultdict(set), {}
    for w in words:
        for k in range(len(w)):
            rest = w[:k] + w[k + 1 :]
            alike[k, rest].add(w)
            if rest in words:
                near[w].add(rest)
                near[rest].add(w)
    for group in alike.values():
        for w in group if len(group) > 1 else ():
            near[w] |= group - {w}
    for w, n in words.items():
        best = min(near[w], key=lambda x: (-words[x], x), default=None)
        if best and words[best] >= 10 * n:
            form[w] = best

    def root(w):
        while w in form:
            w = form[w]
        return w

    return sorted((w, form.get(w), root(w), n, len(near[w]), words.get(form.get(w))) for w, n in words.items())


def check(docs):
    want = expected([(r.doc_id, r.text) for r in docs.collect()])
    assert sorted(tuple(r) for r in spelling.variants(docs).collect()) == want
    return want


def test_whole_table(spark):
    assert len(check(spark.read.parquet(f"{SF}/documents.parquet"))) > 1000


def test_small_cells(spark, monkeypatch):
    """Deep cells and many blocks of visitors give the same words."""
    monkeypatch.setattr(spelling, "CELL", 15)
    monkeypatch.setattr(spelling, "CELLS", 10**9)
    monkeypatch.setattr(spelling, "VISITORS", 30)
    check(spark.read.parquet(f"{SF}/documents.parquet"))


def test_odd_rows(odd, table):
    check(odd)
    assert spelling.variants(odd.limit(0)).count() == 0
    chain = " ".join(["abcdefgh"] * 2 + ["abcdefghi"] * 90 + ["abcdefghij"] * 2000 + ["abcdefgx"] * 2 + ["abcdefyh"] * 20 + ["abcdefzh"] * 20)
    long = "é" * 5000 + " " + "é" * 4999 + " " + "é" * 4999 + "x " + "ÀÿÀÿÀÿÀ× ÷bcdefghÿ "
    rows = check(table([chain, long, long, long, None, "", chain.upper(), "1abcdefgh2 ABCDEFGH_abcdefgh"], [1, 2, None, 2, 3, 4, 70, 5]))
    assert any(form and form != root for _, form, root, *_ in rows)


def test_words_of_one_vector(table, monkeypatch):
    """More words of one vector than a cell holds: a and q count in one group, as do b and r."""
    monkeypatch.setattr(spelling, "CELL", 20)
    draw = random.Random(2)
    words = ["".join(draw.choice("aq") if draw.random() < 0.6 else draw.choice("br") for _ in range(draw.choice([9, 10, 10, 10]))) for _ in range(900)]
    check(table([" ".join(words), " ".join(words), " ".join(words[:50] * 9)]))


def test_pairs_equal_brute_force():
    draw = random.Random(7)
    words = sorted({"".join(draw.choice("abqé") for _ in range(draw.randint(7, 9))) for _ in range(700)} | {"a" * k for k in range(12, 22)})
    column = pa.array(words)
    i, j = spelling.near_pairs(column, column)
    got = [tuple(sorted((words[a], words[b]))) for a, b in zip(i.tolist(), j.tolist())]

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        short, long = sorted((a, b), key=len)
        return len(long) == len(short) + 1 and any(long[:k] + long[k + 1 :] == short for k in range(len(long)))

    want = {(a, b) for a in words for b in words if a < b and abs(len(a) - len(b)) < 2 and near(a, b)}
    assert len(got) == len(set(got)) and set(got) == want


@pytest.mark.parametrize("level", [2, 5])
def test_search_reaches_exactly_what_the_budget_allows(level):
    draw = np.random.default_rng(4)
    counts = np.unique(draw.integers(0, 3, (300, spelling.LEVELS)).astype(np.uint64) * (np.arange(16) < 6), axis=0)
    v = np.bitwise_or.reduce(counts << (60 - 4 * np.arange(16)).astype(np.uint64), axis=1)
    cells = np.unique(spelling.prefix(v, level))
    trie = spelling.Trie(cells << np.uint64(64 - 4 * level), np.full(len(cells), level))
    got = {(int(a), int(b)) for who, where in trie.search(v) for a, b in zip(who, where)}
    want = set()
    for a, row in enumerate(counts[:, :level].astype(int)):
        for b, cell in enumerate(cells):
            change = [((int(cell) >> (4 * (level - 1 - k))) & 15) - row[k] for k in range(level)]
            spent = [c for c in change if c]
            if spent in ([], [1], [1, -1]):
                want.add((a, b))
    assert got == want
