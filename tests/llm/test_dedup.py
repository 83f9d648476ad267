"""Exact and near duplicates against brute force."""

import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import SF
from topicflow.llm import common, dedup, near


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def expected_exact(rows):
    groups = {}
    for r in rows:
        groups.setdefault(lower(r.text), []).append(r.doc_id)
    key = lambda i: (i is not None, i or 0)
    return [(r.doc_id, max(groups[lower(r.text)], key=key), len(groups[lower(r.text)])) for r in rows]


def check_exact(docs, **options):
    rows, got = docs.collect(), dedup.deduplicate(docs, **options).collect()
    assert sorted(map(str, expected_exact(rows))) == sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got)
    assert sum(r.kept for r in got) == len({lower(r.text) for r in rows})
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_exact_on_odd_rows(odd):
    check_exact(odd)
    assert dedup.deduplicate(odd.limit(0)).count() == 0
    kept = dedup.drop_copies(odd)
    assert kept.columns == odd.columns
    assert sorted(lower(r.text) for r in kept.collect()) == sorted({lower(r.text) for r in odd.collect()})


def test_colliding_digests_are_told_apart(table):
    texts = [f"text {k % 40}" for k in range(160)]
    check_exact(table(texts), digest=lambda c: F.substring(F.sha2(c, 256), 1, 1))


def test_hot_group(table):
    check_exact(table(["Same text"] * 700 + [f"own {k}" for k in range(900)]))


def test_state_goes_on(spark, table, tmp_path):
    """A later run finds the earlier rows in the store."""
    marks, store = str(tmp_path / "marks"), str(tmp_path / "store")
    row = lambda digest, rank: f"SELECT '{digest}' AS digest, {rank}L AS rank, {rank * 10}L AS place"
    spark.sql(row("a", 1) + " UNION ALL " + row("b", 2)).write.parquet(marks)
    first = {r.digest: (r.n, r.top, r.at) for r in dedup.remember(spark, marks, store).collect()}
    spark.sql(row("a", 5) + " UNION ALL " + row("b", 0)).write.mode("append").parquet(marks)
    second = {r.digest: (r.n, r.top, r.at) for r in dedup.remember(spark, marks, store).collect()}
    assert first == {"a": (1, 1, 10), "b": (1, 2, 20)} and second == {"a": (2, 5, 50), "b": (2, 2, 20)}


BATCHES = [[(1, "One"), (5, "two"), (3, None), (3, None), (2, "shared")], [(9, "one"), (4, "TWO"), (None, ""), (6, "tale"), (8, "shared")], [(7, "tow"), (11, "shared"), (11, "SHARED"), (12, "alone")]]


@pytest.mark.parametrize("weak", [False, True])
def test_batches_with_one_store_equal_one_run(table, tmp_path, weak):
    """Three calls with one store: the last state equals one run over the union; each batch is judged against all before it."""
    digest = {"digest": lambda c: F.substring(c, 1, 1)} if weak else {}
    store, seen = str(tmp_path / "store"), []
    for batch in BATCHES:
        seen += batch
        docs = table([t for _, t in batch], [i for i, _ in batch])
        got = dedup.deduplicate(docs, store=store, **digest).collect()
        union = expected_exact(table([t for _, t in seen], [i for i, _ in seen]).collect())
        assert sorted(map(str, union[-len(batch):])) == sorted(str((r.doc_id, r.keep_id, r.group_size)) for r in got)
    union = table([t for _, t in seen], [i for i, _ in seen])
    every = dedup.Store(union.sparkSession, store, **digest).verdicts().collect()
    assert sorted(map(str, every)) == sorted(map(str, dedup.deduplicate(union, **digest).collect()))
    assert sum(r.kept for r in every) == len({lower(t) for _, t in seen})


def test_store_with_an_empty_batch_and_a_hot_text(table, tmp_path):
    store = str(tmp_path / "store")
    assert dedup.deduplicate(table([]), store=store).count() == 0
    docs = table(["same text"] * 700 + ["other"], range(701))
    check_exact(docs, store=store)
    again = dedup.deduplicate(table(["Same text"], [9000]), store=store).collect()
    assert [(r.doc_id, r.keep_id, r.group_size, r.kept) for r in again] == [(9000, 9000, 701, True)]


def test_key_filter(spark):
    keys = spark.range(0, 3000, 3).withColumnRenamed("id", "k")
    hit = common.key_filter(keys, "k")(spark.range(3000), "id").where("__hit").select("id")
    found = {r.id for r in hit.collect()}
    assert set(range(0, 3000, 3)) <= found and len(found) < 1100
    assert {r.id for r in common.without(spark.range(3000), keys.withColumnRenamed("k", "id"), "id").collect()} == set(range(3000)) - set(range(0, 3000, 3))


def shingle_set(text, words):
    found = re.findall("[^\x20\x09-\x0d]+", lower(text))
    if not found:
        return frozenset()
    return frozenset(tuple(found[k : k + words]) for k in range(max(len(found) - words + 1, 1)))


def expected_near(rows, words=4):
    sets = [shingle_set(r.text, words) for r in rows]
    up = list(range(len(rows)))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    by_shingle = {}
    for k, s in enumerate(sets):
        for x in s:
            by_shingle.setdefault(x, []).append(k)
    met = {(a, b) for group in by_shingle.values() for a in group for b in group if a < b} if len(rows) <= 1500 else None
    for a, b in sorted(met):
        both = len(sets[a] & sets[b])
        if 100 * both >= 80 * (len(sets[a]) + len(sets[b]) - both):
            up[find(a)] = find(b)
    parts = {}
    key = lambda i: (i is None, i or 0)
    for k, r in enumerate(rows):
        parts.setdefault(find(k), []).append(r.doc_id)
    return [(r.doc_id, len(sets[k]), min(parts[find(k)], key=key) if sets[k] else r.doc_id) for k, r in enumerate(rows)]


def check_near(docs, **options):
    rows, got = docs.collect(), near.near_duplicates(docs, **options).collect()
    assert sorted(map(str, expected_near(rows))) == sorted(str((r.doc_id, r.n_shingles, r.component_id)) for r in got)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_on_the_table(spark):
    check_near(spark.read.parquet(f"{SF}/documents.parquet").where("length(text) < 8000"))


def test_near_on_odd_rows(odd):
    check_near(odd)
    assert near.near_duplicates(odd.limit(0)).count() == 0
    assert near.drop_near(odd).columns == odd.columns


def edited(words, share, draw):
    return " ".join(draw.choice("abcdefgh") + str(draw.randrange(999)) if draw.random() < share else w for w in words)


def test_drop_near_by_row(table):
    """Rows without an id, or with the same id, don't go with one another; each component keeps one row."""
    draw = random.Random(6)
    fresh = lambda: [f"w{draw.randrange(10**6)}" for _ in range(150)]
    one, two, three, four, five = (fresh() for _ in range(5))
    near_copy = lambda words: " ".join([*words[:70], "other", *words[71:]])
    rows = [(1, " ".join(one)), (None, near_copy(one)), (None, " ".join(two)), (None, " ".join(three)), (None, near_copy(three)), (None, ""), (None, None)]
    rows += [(5, " ".join(four)), (5, " ".join(five)), (4, near_copy(four)), (9, "a single row"), (7, "twice the same row"), (7, "twice the same row")]
    got = near.drop_near(table([t for _, t in rows], [i for i, _ in rows])).collect()
    left = sorted(str((r.doc_id, r.text)) for r in got if r.text not in (" ".join(three), near_copy(three)))
    want = [r for k, r in enumerate(rows) if k not in (1, 3, 4, 7, 12)]
    assert left == sorted(map(str, want))
    assert len(got) == len(want) + 1


def test_near_groups(table):
    """Groups about one text, chains of small edits, and texts that share a long passage but are no copies."""
    draw = random.Random(1)
    fresh = lambda n: [f"w{draw.randrange(4000)}" for _ in range(n)]
    texts, passage = [], fresh(120)
    for _ in range(8):
        base = fresh(150)
        texts += [edited(base, draw.choice([0.005, 0.01, 0.03]), draw) for _ in range(draw.randrange(2, 9))]
    chain = fresh(200)
    for k in range(20):
        chain = [*chain[:k * 8], *fresh(4), *chain[k * 8 + 4 :]]
        texts.append(" ".join(chain))
    texts += [" ".join(passage + fresh(60)) for _ in range(40)]
    draw.shuffle(texts)
    check_near(table(texts))


def test_large_cluster(table, monkeypatch):
    """One cluster dealt to blocks gives the same parts."""
    monkeypatch.setattr(near, "BLOCK_SETS", 16)
    monkeypatch.setattr(near, "PIVOTS", 2)
    draw = random.Random(2)
    base, other = [f"w{k}" for k in range(200)], [f"v{k}" for k in range(200)]
    texts = [edited(base, 0.012, draw) for _ in range(90)] + [edited(other, 0.01, draw) for _ in range(30)]
    check_near(table(texts))


def test_links_across_blocks(table, monkeypatch):
    """Copies that are linked with their base alone, and with nothing else, in a cluster of many blocks."""
    monkeypatch.setattr(near, "BLOCK_SETS", 16)
    monkeypatch.setattr(near, "PIVOTS", 2)
    draw = random.Random(3)
    texts = []
    for g in range(3):
        base = [f"g{g}w{k}" for k in range(200)]
        texts.append(" ".join(base))
        for c in range(100):
            words = list(base)
            for k in range(4):
                words[draw.randrange(50 * k + 4, 50 * k + 46)] = f"own{g}_{c}_{k}"
            texts.append(" ".join(words))
    for c in range(30):  # pairs of 0.82 whose ends are 0.7 from all others
        words = [f"g0w{k}" for k in range(200)]
        words[20:44] = [f"two{c}_{k}" for k in range(24)]
        texts.append(" ".join(words))
        texts.append(" ".join(words[:100] + [f"end{c}_{k}" for k in range(15)] + words[115:]))
    draw.shuffle(texts)
    check_near(table(texts))


def test_pairs_in_hot_regions(table, monkeypatch):
    """Pairs of 0.82 among texts that share a long passage, in regions cut by label and salt."""
    monkeypatch.setattr(near, "HOT_ROWS", 2)
    monkeypatch.setattr(near, "HOT_SHARE", 10**6)
    draw = random.Random(4)
    passage, texts = [f"p{k}" for k in range(143)], []
    for c in range(400):
        own = [f"own{c}_{k}" for k in range(57)]
        texts.append(" ".join(passage + own))
        if c < 40:
            texts.append(" ".join(passage + own[:20] + [f"new{c}_{k}" for k in range(16)] + own[36:]))
    draw.shuffle(texts)
    check_near(table(texts))


@pytest.mark.parametrize("similarity", [0.8, 0.85, 0.9])
def test_recall_of_the_forest(similarity):
    """Pairs at the threshold meet in some order, among unrelated texts."""
    draw = np.random.default_rng(5)
    n, hits, trials = 400, 0, 60
    for _ in range(trials):
        union = draw.integers(0, 2**63, n, dtype=np.uint64)
        shared = int(round(n * similarity))
        rest = (n - shared) // 2
        a, b = union[: shared + rest], np.concatenate([union[:shared], union[shared + rest :]])
        x, y = near.signature(np.unique(a)), near.signature(np.unique(b))
        same = (x == y).reshape(near.TREES, near.DEPTH)
        hits += bool(same[:, : near.SHALLOW].all(axis=1).any() and (x == y).mean() >= near.AGREE)
    assert hits >= trials - 1
