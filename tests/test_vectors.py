import numpy as np
import pytest
from pyspark.sql import functions as F

from topicflow.functions.vectors import cosine_distance, cosine_plain, cosine_similarity
from topicflow.operators import clustering, quality
from topicflow.operators.neighbours import knn_cosine, nearest


def frame(spark, matrix, ids=None):
    ids = range(len(matrix)) if ids is None else ids
    return spark.createDataFrame([(int(i), [float(x) for x in row]) for i, row in zip(ids, matrix)], "doc_id long, embedding array<double>")


def brute(queries, items, k, exclude_self):
    unit = lambda m: np.divide(m, np.linalg.norm(m, axis=1, keepdims=True), out=np.zeros_like(m), where=np.linalg.norm(m, axis=1, keepdims=True) > 0)
    sims = np.round(unit(queries) @ unit(items).T, 10)
    out = {}
    for i, row in enumerate(sims):
        order = sorted((j for j in range(len(items)) if not (exclude_self and i == j)), key=lambda j: (-row[j], j))[:k]
        out[i] = [(j, float(row[j])) for j in order]
    return out


def clouds(seed=0, n=400, d=12):
    """Clustered points with copies, a zero vector and one cloud holding half of them."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(6, d)) * 4
    label = np.where(rng.random(n) < 0.5, 0, rng.integers(0, 6, n))
    points = centre[label] + rng.normal(size=(n, d))
    points[5] = points[9] = points[17]
    points[33] = 0
    return points


PLANS = [dict(), dict(broadcast_bytes=0, cells=8, block_bytes=12 * 8 * 40), dict(broadcast_bytes=0, cells=1, block_bytes=12 * 8 * 1000)]


@pytest.mark.parametrize("options", PLANS)
@pytest.mark.parametrize("k", [1, 7])
def test_knn_equals_brute_force(spark, options, k):
    points = clouds()
    want = brute(points, points, k, True)
    got = {}
    for r in knn_cosine(frame(spark, points), k, **options).collect():
        got.setdefault(r.doc_id, []).append((r["rank"], r.neighbour_id, r.similarity))
    assert set(got) == set(want)
    for i, rows in got.items():
        found = [(j, s) for _, j, s in sorted(rows)]
        assert [j for j, _ in found] == [j for j, _ in want[i]], i
        assert np.allclose([s for _, s in found], [s for _, s in want[i]], atol=1e-9)


@pytest.mark.parametrize("options", PLANS[:2])
def test_nearest_with_fewer_items_than_k_and_by(spark, options):
    points = clouds(3, 60)
    queries = frame(spark, points[:20]).withColumn("g", F.col("doc_id") % 3)
    items = frame(spark, points[20:], range(20, 60)).withColumn("g", F.col("doc_id") % 4)
    got = {}
    for r in nearest(queries, items, 30, by="g", **options).collect():
        got.setdefault(r.qid, set()).add(r.iid)
    assert got == {i: {j for j in range(20, 60) if j % 4 == i % 3} for i in range(20)}


def test_ties_go_to_the_lower_id(spark):
    items = frame(spark, [[0, 1.0], [1, 0], [1, 0], [2, 0]], [9, 7, 3, 5])
    found = nearest(frame(spark, [[1.0, 0]]), items, 2).collect()
    assert sorted(r.iid for r in found) == [3, 5]


def test_cosine(spark):
    rows = [([1.0, 0.0], [1.0, 0.0]), ([1.0, 0.0], [-2.0, 0.0]), ([0.0, 0.0], [1.0, 1.0]), (None, [1.0, 0.0])]
    df = spark.createDataFrame(rows, "a array<double>, b array<double>")
    out = df.select(cosine_similarity(F.col("a"), F.col("b")).alias("s"), cosine_distance(F.col("a"), F.col("b")).alias("d"), cosine_plain(F.col("a"), F.col("b")).alias("p")).collect()
    assert [r.s for r in out] == [1, -1, 0, None] and [r.p for r in out[:3]] == [1, -1, 0]
    assert [r.d for r in out[:3]] == [0, 2, 1]


def test_vectors_of_different_widths_are_an_error(spark):
    from pyspark.errors import PythonException

    df = spark.createDataFrame([([1.0, 0.0, 0.0], [1.0])], "a array<double>, b array<double>")
    with pytest.raises(PythonException, match="different widths"):
        df.select(cosine_similarity(F.col("a"), F.col("b"))).collect()


def test_exact_quantile(spark):
    from topicflow.functions.scale import exact_quantile

    values = np.random.default_rng(3).integers(0, 15_000, 20_000) / 7.0
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    for q in (0.0, 0.25, 0.9, 1.0):
        assert exact_quantile(df, "v", q) == np.sort(values)[max(0, int(np.ceil(round(q * len(values), 9))) - 1)]
    assert exact_quantile(df.limit(0), "v", 0.5) is None


def components(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return {x: find(x) for x in parent}


@pytest.mark.parametrize("shape", ["path", "star", "random"])
def test_connected_components(spark, shape):
    rng = np.random.default_rng(1)
    if shape == "path":
        order = rng.permutation(60)
        edges = list(zip(order[:-1], order[1:]))
    elif shape == "star":
        edges = [(50, i) for i in range(50)] + [(60, 61)]
    else:
        edges = [tuple(rng.integers(0, 120, 2)) for _ in range(90)]
    check_components(spark, edges)


@pytest.mark.parametrize("shape", ["ascending", "descending", "grid"])
def test_long_chains_settle_in_few_rounds(spark, shape, monkeypatch):
    from topicflow.functions import graph

    rounds, plain = [], graph.discard
    monkeypatch.setattr(graph, "discard", lambda *tables: (rounds.append(1), plain(*tables)))
    n = 2000
    edges = [(k, k + 1) for k in range(n)] if shape != "grid" else [(x * 30 + y, x * 30 + y + s) for x in range(29) for y in range(29) for s in (1, 30)]
    check_components(spark, [(n - a, n - b) for a, b in edges] if shape == "descending" else edges)
    assert len(rounds) <= 25


def check_components(spark, edges):
    edges = [(int(a), int(b)) for a, b in edges if a != b]
    got = {r.id: r.component for r in clustering.connected_components(spark.createDataFrame(edges, "src long, dst long")).collect()}
    assert got == components(edges)


def rand_index(a, b):
    """Adjusted Rand index."""
    from collections import Counter
    from math import comb

    pairs = sum(comb(n, 2) for n in Counter(zip(a, b)).values())
    left, right = (sum(comb(n, 2) for n in Counter(x).values()) for x in (a, b))
    expected, total = left * right / comb(len(a), 2), (left + right) / 2
    return (pairs - expected) / (total - expected)


def test_clusters_recover_planted_topics(spark, views):
    found = clustering.density_cluster(views.emb, 10, 5)
    both = found.join(views.emb.where("doc_id % 14 <> 0").select("doc_id", "label"), "doc_id").collect()
    assert rand_index([r.topic for r in both], [r.label for r in both]) >= 0.8


def numpy_dbcv(points, labels):
    """All at once, from the definition."""
    n_all, dims, scores, parts = len(points), points.shape[1], 0.0, {}
    for t in np.unique(labels):
        x = points[labels == t]
        dist = np.sqrt(((x[:, None] - x[None]) ** 2).sum(-1))
        inverse = np.where(dist > 0, 1 / np.where(dist > 0, dist, 1), 0) ** dims
        core = (inverse.sum(1) / (len(x) - 1)) ** (-1 / dims)
        reach = np.maximum(dist, np.maximum(core[:, None], core[None]))
        inside, tree = [0], []
        while len(inside) < len(x):
            outside = [j for j in range(len(x)) if j not in inside]
            w, j = min((min(reach[i, j] for i in inside), j) for j in outside)
            tree.append((w, min(i for i in inside if np.isclose(reach[i, j], w)), j))
            inside.append(j)
        degree = np.bincount([i for _, a, b in tree for i in (a, b)], minlength=len(x))
        inner = degree > 1
        inside = [w for w, a, b in tree if inner[a] and inner[b]] or [w for w, _, _ in tree]
        parts[t] = (x[inner], core[inner], max(inside), len(x))
    for t, (x, core, sparse, size) in parts.items():
        sep = min(
            np.maximum(np.sqrt(((x[:, None] - y[None]) ** 2).sum(-1)), np.maximum(core[:, None], other[None])).min()
            for u, (y, other, _, _) in parts.items() if u != t
        )
        scores += size / n_all * (sep - sparse) / max(sep, sparse)
    return scores


@pytest.mark.parametrize("block_rows", [4096, 20])
def test_dbcv_equals_its_definition(spark, block_rows):
    rng = np.random.default_rng(4)
    labels = rng.integers(0, 3, 90)
    points = rng.normal(size=(90, 3)) + labels[:, None] * 4.0
    vectors = frame(spark, points)
    topics = spark.createDataFrame([(i, int(t)) for i, t in enumerate(labels)], "doc_id long, topic int")
    row = quality.dbcv(vectors, topics, block_rows=block_rows).first()
    assert abs(row.dbcv_score - numpy_dbcv(points, labels)) < 1e-9 and row.clusters == 3


def test_dbcv_undefined(spark):
    vectors = frame(spark, np.random.default_rng(0).normal(size=(30, 2)))
    one = vectors.select("doc_id", F.lit(0).alias("topic"))
    few = vectors.select("doc_id", F.when(F.col("doc_id") < 4, F.col("doc_id").cast("int") % 2).otherwise(-1).alias("topic"))
    noise = vectors.select("doc_id", F.lit(-1).alias("topic"))
    for topics in (one, few, noise):
        score = quality.dbcv(vectors, topics).first().dbcv_score
        assert score != score


def plain_cv(texts, topics, window):
    words = {w for t in topics for w in t}
    docs = [d for d in texts if words & set(d)]
    windows = [set(d[i : i + window]) for d in docs for i in range(max(1, len(d) - window + 1))]
    p = lambda *ws: sum(all(w in x for w in ws) for x in windows) / len(windows)
    scores, eps = [], 1e-12
    for topic in topics:
        known = [w for w in topic if p(w) > 0]
        if len(known) < 2:
            continue
        npmi = np.array([[np.log((p(a, b) + eps) / (p(a) * p(b))) / -np.log(p(a, b) + eps) for b in known] for a in known])
        total = npmi.sum(0)
        scores.append(np.mean([row @ total / np.linalg.norm(row) / np.linalg.norm(total) for row in npmi]))
    return float(np.mean(scores))


def test_places_of_words_do_not_carry_their_topics(spark, monkeypatch):
    """A word of 300 topics is one number at each of its places, and pairs are looked up a few at a time with the same counts."""
    from topicflow.operators import quality as q

    docs = spark.createDataFrame([(i, "a b c a d" if i % 2 else "b a e e a") for i in range(6)], "doc_id long, text_lemm string")
    rows = [(t, r, w) for t in range(300) for r, w in enumerate(["a", "b", "c", f"only{t}"])] + [(300, 0, "d"), (300, 1, "e")]
    words = spark.createDataFrame(rows, "topic int, rank int, word string")
    want = {r.topic: r.cv for r in q.coherence_cv(docs, words, window=3, per_topic=True).collect()}
    few = {r.topic: r.cv for r in q.coherence_cv(docs, words.where("topic in (0, 300)"), window=3, per_topic=True).collect()}
    assert set(want) == set(range(301)) and abs(want[0] - want[299]) < 1e-12 and abs(want[300] - few[300]) < 1e-12 and abs(want[0] - few[0]) < 1e-12
    doc, word, pos = np.repeat([0, 1], 5), np.array([0, 1, 2, 0, 3, 1, 0, 4, 4, 0]), np.tile(np.arange(5), 2)
    pairs, total = np.array([1, 2, 7]), np.array([3, 3])  # 0-1, 0-2, 1-2 of five words
    whole = [x.tolist() for x in q.window_counts(doc, total, word, pos, pairs, 5, 3)]
    assert dict(zip(*whole)) == {0: 6, 6: 3, 12: 3, 18: 1, 24: 3, 1: 3, 2: 3, 7: 2}
    monkeypatch.setattr(q, "_CANDIDATES", 1)
    assert [x.tolist() for x in q.window_counts(doc, total, word, pos, pairs, 5, 3)] == whole


def test_coherence_equals_its_definition(spark):
    rng = np.random.default_rng(7)
    vocabulary = [f"w{i}" for i in range(14)]
    texts = [[vocabulary[j] for j in rng.integers(0, 14, rng.integers(1, 25))] for _ in range(40)] + [["zz"] * 5]
    topics = [["w0", "w1", "w2", "w0 w1"], ["w3", "w4", "absent"], ["absent", "w5"]]
    docs = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(texts)], "doc_id long, text_lemm string").repartition(3)
    words = spark.createDataFrame([(t, r, w) for t, ws in enumerate(topics) for r, w in enumerate(ws)], "topic int, rank int, word string")
    got = quality.coherence_cv(docs, words, window=6).first().cv_coherence
    assert abs(got - plain_cv(texts, topics, 6)) < 1e-9
    none = quality.coherence_cv(docs, words.where("topic = 2"), window=6).first().cv_coherence
    assert none != none


@pytest.mark.parametrize("channels", [1, 2, 30])
def test_cross_channel_pairs(spark, channels):
    """One channel may hold nearly everything; then all rows are searched."""
    from topicflow.operators.embeddings import cross_channel_pairs

    rows = [(i, f"c{i % channels if i % 50 == 0 else 0}") for i in range(900)]
    df = spark.createDataFrame(rows, "doc_id long, channel string")
    import hashlib

    order = sorted(rows, key=lambda r: hashlib.md5(f"{r[0]}|42".encode()).hexdigest())
    want = [(a[0], b[0]) for a, b in zip(order[::2], order[1::2]) if a[1] != b[1]][:12]
    assert sorted((r.a, r.b) for r in cross_channel_pairs(df, 12).collect()) == sorted(want)


def blocks_of(points, labels):
    rng = np.random.default_rng(8)
    order = rng.permutation(len(points))
    return points[order], labels[order]


def prim_dbcv(points, labels):
    """The definition with whole matrices per cluster; ties between edges go to the lower places."""
    from test_hierarchy import kruskal

    n, dims, parts = len(points), points.shape[1], {}
    for t in np.unique(labels):
        x = points[labels == t]
        square = (x**2).sum(1)
        dist = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * x @ x.T, 0))
        np.fill_diagonal(dist, np.inf)
        core = ((dist**-dims).sum(1) / (len(x) - 1)) ** (-1 / dims)
        np.fill_diagonal(dist, 0)
        tree = kruskal(np.maximum(dist, np.maximum(core[:, None], core[None])))
        degree = np.bincount([i for _, a, b in tree for i in (a, b)], minlength=len(x))
        inner = degree > 1
        parts[t] = (x[inner], core[inner], max([w for w, a, b in tree if inner[a] and inner[b]] or [w for w, _, _ in tree]), len(x))
    score = 0.0
    for t, (x, core, sparse, size) in parts.items():
        sep = min(
            np.maximum(np.sqrt(np.maximum((x**2).sum(1)[:, None] + (y**2).sum(1)[None] - 2 * x @ y.T, 0)), np.maximum(core[:, None], other[None])).min()
            for u, (y, other, _, _) in parts.items() if u != t
        )
        score += size / n * (sep - sparse) / max(sep, sparse)
    return score


@pytest.mark.parametrize("sizes,block_rows", [((140, 60, 30), 40), ((5000, 5000), 4096)])
def test_dbcv_of_large_clusters(spark, sizes, block_rows):
    """Core distances from blocks, trees from rounds, separation from pruned cells."""
    rng = np.random.default_rng(6)
    labels = np.repeat(np.arange(len(sizes)), sizes)
    points, labels = blocks_of(rng.normal(size=(len(labels), 4)) * (1 + labels[:, None]) + labels[:, None] * 9.0, labels)
    topics = spark.createDataFrame([(i, int(t)) for i, t in enumerate(labels)], "doc_id long, topic int")
    small = 50 if len(sizes) == 3 else quality.SMALL_CLUSTER
    row = quality.dbcv(frame(spark, points), topics, block_rows=block_rows, small=small).first()
    assert row.points == len(labels) and row.clusters == len(sizes)
    assert abs(row.dbcv_score - prim_dbcv(points, labels)) < 1e-9


@pytest.mark.parametrize("shape", ["clouds", "copies", "narrow"])
def test_search_block_equals_brute_force(shape):
    from topicflow.functions.vectors import unit
    from topicflow.operators.neighbours import _search_block

    rng = np.random.default_rng(4)
    items = clouds(4, 6000, 8)
    if shape == "copies":
        items[100:1500] = items[100]  # more ties than are listed, zero vectors too
        items[2000:2400] = 0
    elif shape == "narrow":
        items = 5.0 + rng.normal(size=items.shape) * 1e-5  # closer than single precision tells
    items = unit(items)
    some = np.concatenate([np.arange(0, 6000, 37), [100, 101, 2000, 2001]])
    want = brute(items[some], items, 6, False)
    found = _search_block(some, items[some], np.arange(6000), items, 5, True)
    got = {}
    for q, i, s in zip(*(found.column(c).to_pylist() for c in range(3))):
        got.setdefault(q, []).append((i, s))
    for place, q in enumerate(some.tolist()):
        rows = [(j, s) for j, s in want[place] if j != q][:5]
        sims = {j: s for j, s in got[q]}
        assert len(got[q]) >= 5 and np.allclose(sorted(sims.values()), sorted(s for _, s in rows), atol=2e-10), q
    bound = np.array([want[p][4][1] for p in range(len(some))])
    again = _search_block(some, items[some], np.arange(6000), items, 5, True, floor=bound)
    assert {(q, i) for q, i, s in zip(*(again.column(c).to_pylist() for c in range(3)))} <= {(q, i) for q, v in got.items() for i, _ in v}


def test_rows_with_nan_and_repeated_ids():
    from topicflow.functions.vectors import unit
    from topicflow.operators.neighbours import _search_block

    items = unit(clouds(5, 50, 4))
    items[7] = np.nan
    ids = np.arange(50) // 2  # every id twice
    found = _search_block(ids, items, ids, items, 3, True)
    rows = list(zip(*(found.column(c).to_pylist() for c in range(3))))
    assert all(q != i and np.isfinite(s) for q, i, s in rows) and len(rows) == 49 * 3


def test_search_lists_few_pairs_in_full(monkeypatch):
    """Ordinary vectors are told apart by products of single precision; no similarity of all pairs is sorted."""
    from topicflow.functions.vectors import unit
    from topicflow.operators import neighbours

    items = unit(np.random.default_rng(6).normal(size=(20_000, 16)))
    monkeypatch.setattr(neighbours, "_best_k", lambda *a: pytest.fail("all pairs were sorted"))
    assert neighbours._search_block(np.arange(500), items[:500], np.arange(20_000), items, 10, True).num_rows == 5000


def test_small_blocks_grow_with_the_vectors(spark):
    """Blocks of one row would copy every query to 300 blocks; at most 64 are cut while they stay within the usual size."""
    from topicflow.operators import neighbours

    points, seen = clouds(7, 300, 4), []
    plain = neighbours._search_cells
    neighbours._search_cells = lambda *a, **o: (seen.append(a[4]), plain(*a, **o))[1]
    try:
        found = {(r.doc_id, r.neighbour_id) for r in knn_cosine(frame(spark, points), 3, broadcast_bytes=0, cells=2, block_bytes=1).collect()}
    finally:
        neighbours._search_cells = plain
    assert set(seen) == {5}
    assert found == {(i, j) for i, rows in brute(points, points, 3, True).items() for j, _ in rows}


def test_searching_cells_moves_queries_once(spark, monkeypatch):
    """Neither side is copied per block: tasks read blocks from the shared folder, so nothing is cogrouped, and narrow vectors go that way too."""
    from topicflow.operators import neighbours

    monkeypatch.setattr(neighbours, "BROADCAST_ROWS", 100)
    points = clouds(11, 300, 4)
    found = knn_cosine(frame(spark, points), 3, block_bytes=32 * 20)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "CoGroup" not in plan and "Generate" not in plan and plan.count("MapInArrow") == 1
    assert {(r.doc_id, r.neighbour_id) for r in found.collect()} == {(i, j) for i, rows in brute(points, points, 3, True).items() for j, _ in rows}


def test_a_chunk_keeps_the_best_of_all_blocks():
    from topicflow.functions.vectors import chunks
    from topicflow.operators.neighbours import _Best

    best = _Best(3, 2)
    best.add(np.array([0, 0, 2]), np.array([5, 6, 7]), np.array([0.5, 0.9, 0.1]))
    best.add(np.array([0, 2, 2]), np.array([1, 3, 4]), np.array([0.5, 0.1, 0.1]))
    assert best.floor().tolist() == [0.5, -np.inf, 0.1]
    rows = list(zip(*(c.to_pylist() for c in best.batch(np.array([10, 11, 12])).columns)))
    assert rows == [(10, 6, 0.9), (10, 1, 0.5), (12, 3, 0.1), (12, 4, 0.1)]
    import pyarrow as pa

    batches = [pa.RecordBatch.from_pydict({"x": list(range(i, i + 5))}) for i in range(0, 35, 5)]
    parts = [t.column("x").to_pylist() for t in chunks(iter(batches), 8)]
    assert sum(parts, []) == list(range(35)) and [len(p) for p in parts] == [8, 8, 8, 8, 3]


@pytest.mark.parametrize("shape", ["clouds", "copies", "repeated ids"])
def test_search_by_angle_equals_search_of_all(shape):
    """Items in the order of their angle to a pivot give the rows of a search without one, whatever the pivot."""
    from topicflow.functions.vectors import unit
    from topicflow.operators.neighbours import _search_block

    items = clouds(8, 9000, 6)
    if shape == "copies":
        items[100:1500], items[2000:2400] = items[100], 0
    items = unit(items)
    items[8000] = np.nan
    ids = np.arange(9000) // (2 if shape == "repeated ids" else 1)
    some = np.concatenate([np.arange(0, 9000, 41), [100, 2000, 8000]])
    rows = lambda **o: sorted(zip(*(c.to_pylist() for c in _search_block(ids[some], items[some], ids, items, 5, True, **o).columns)))
    plain = rows()
    for pivot in (items[3], items[100], -items[3], np.zeros(6)):
        assert rows(pivot=pivot) == plain
    assert len(plain) >= 5 * (len(some) - 3)


def test_angles_spare_products():
    """Items that angles rule out are not multiplied: these would be the best if they were."""
    from topicflow.operators.neighbours import _COLUMNS, _likely

    items = np.ones((2 * _COLUMNS, 2), np.float32)
    items[_COLUMNS:] = 9
    angles = np.array([0.1]), np.repeat([0.2, 1.5], _COLUMNS)
    row, column, dense = _likely(np.array([[0.5, 0.4]], np.float32), items[:], 1, np.array([0.8], np.float32), None, None, None, angles)
    assert not (column >= _COLUMNS).any() and (len(row) or len(dense))


def test_pivots_are_centres():
    """Eight pivots find eight clouds, so that cells are narrow, however few of the first vectors lie in some of them."""
    from topicflow.functions.vectors import unit
    from topicflow.operators.neighbours import _centres

    rng = np.random.default_rng(9)
    middle = np.eye(8)
    label = np.concatenate([np.arange(8), rng.integers(0, 8, 2000)])
    sample = unit(middle[label] + rng.normal(size=(len(label), 8)) * 0.1)
    pivots = _centres(sample, 8)
    assert ((middle @ pivots.T).max(axis=1) > 0.995).all()
    assert _centres(sample[:3], 8).shape == (3, 8)
