"""Spanning trees and the density hierarchy against plain single-machine versions."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from test_vectors import frame
from topicflow.functions import tree
from topicflow.operators import clustering, hierarchy
from topicflow.session import materialize


def kruskal(weights):
    """Edges (w, a, b) of the minimum spanning tree, ties by the lower ids."""
    n, up, out = len(weights), list(range(len(weights))), []

    def find(x):
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    i, j = np.triu_indices(n, 1)
    for k in np.lexsort((j, i, weights[i, j])).tolist():
        a, b = find(i[k]), find(j[k])
        if a != b:
            up[a] = b
            out.append((float(weights[i[k], j[k]]), int(i[k]), int(j[k])))
    return out


def reach(points, core):
    distance = np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1))
    return np.maximum(distance, np.maximum(core[:, None], core[None]))


def cloud(n, seed=0):
    rng = np.random.default_rng(seed)
    points = np.concatenate([rng.normal(size=(n // 2, 4)) * 0.3, rng.normal(size=(n - n // 2, 4)) + 3])
    points[7] = points[9] = points[11]
    core = np.sort(np.sqrt(((points[:, None] - points[None]) ** 2).sum(-1)), axis=1)[:, 5]
    return points, core


def frame_of(spark, points, core, group=lambda k: ""):
    rows = [(k, group(k), p.tolist(), float(c)) for k, (p, c) in enumerate(zip(points, core))]
    return spark.createDataFrame(rows, "id long, grp string, vec array<double>, core double").repartition(5)


@pytest.mark.parametrize("options", [dict(), dict(small=0), dict(small=0, block_bytes=4 * 8 * 50, cells=9)])
def test_spanning_tree_is_exact(spark, options):
    points, core = cloud(220)
    got = sorted((r.w, r.a, r.b) for r in tree.spanning_forest(frame_of(spark, points, core), **options).collect())
    assert got == sorted(kruskal(reach(points, core)))


def test_spanning_tree_per_group(spark):
    points, core = cloud(150, 3)
    df = frame_of(spark, points, core, lambda k: "abc"[k % 3] if k else "alone")
    got = sorted((r.grp, r.w, r.a, r.b) for r in tree.spanning_forest(df, small=45, block_bytes=4 * 8 * 20, cells=4).collect())
    want = []
    for g in range(3):
        ids = np.array([k for k in range(1, 150) if k % 3 == g])
        want += [("abc"[g], w, int(ids[a]), int(ids[b])) for w, a, b in kruskal(reach(points[ids], core[ids]))]
    assert got == sorted(want)
    assert tree.spanning_forest(df.limit(0)).count() == 0


def test_spanning_tree_from_files(spark, monkeypatch):
    """Tasks that read the cells they visit find the same trees, ties and copies included, and nothing is copied to cells."""
    monkeypatch.setattr(tree, "READ_BYTES", 0)
    monkeypatch.setattr(tree.Shelves, "_search", lambda *a: pytest.fail("points were copied to cells"))
    points, core = cloud(150, 5)
    df = frame_of(spark, points, core, lambda k: "ab"[k % 2])
    got = sorted((r.grp, r.w, r.a, r.b) for r in tree.spanning_forest(df, small=0, block_bytes=4 * 8 * 20, cells=4).collect())
    want = []
    for g in range(2):
        ids = np.arange(g, 150, 2)
        want += [("ab"[g], w, int(ids[a]), int(ids[b])) for w, a, b in kruskal(reach(points[ids], core[ids]))]
    assert got == sorted(want)


def plain_hierarchy(points, min_cluster_size, min_samples):
    """Labels by the textbook: dendrogram, condensed from the top, clusters of most excess mass."""
    unit = points / np.linalg.norm(points, axis=1, keepdims=True)
    sims = np.round(unit @ unit.T, 10)
    np.fill_diagonal(sims, -np.inf)
    core = np.sort(np.round(1 - sims, 10), axis=1)[:, min_samples - 1]
    chord = np.sqrt(2 * np.maximum(core, 0))
    edges = sorted((w * w / 2, a, b) for w, a, b in kruskal(reach(unit, chord)))
    n = len(points)
    node, children, size, height = list(range(n)), {}, {k: 1 for k in range(n)}, {}
    up = list(range(n))

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for k, (w, a, b) in enumerate(edges):
        a, b = find(a), find(b)
        children[n + k], height[n + k], size[n + k] = (node[a], node[b]), w, size[node[a]] + size[node[b]]
        up[a] = b
        node[b] = n + k

    def leaves(x):
        stack, out = [x], []
        while stack:
            y = stack.pop()
            if y < n:
                out.append(y)
            else:
                stack += children[y]
        return out

    clusters, todo = [], [(2 * n - 2, None, 0.0)]
    while todo:
        x, above, birth = todo.pop()
        me = len(clusters)
        clusters.append({"parent": above, "birth": birth, "points": {}, "kids": []})
        if above is not None:
            clusters[above]["kids"].append(me)
        while True:
            a, b = children[x]
            density = 1 / max(height[x], 1e-12)
            big = [c for c in (a, b) if size[c] >= min_cluster_size]
            for c in (a, b):
                if c not in big:
                    clusters[me]["points"].update({p: density for p in leaves(c)})
            if len(big) == 1:
                x = big[0]
                continue
            todo += [(c, me, density) for c in big]
            clusters[me]["split"] = density if big else None
            break
    total = lambda c: len(clusters[c]["points"]) + sum(total(k) for k in clusters[c]["kids"])
    chosen, value = {}, {}
    for c in range(len(clusters) - 1, -1, -1):
        own = sum(d - clusters[c]["birth"] for d in clusters[c]["points"].values())
        own += sum(total(k) * (clusters[k]["birth"] - clusters[c]["birth"]) for k in clusters[c]["kids"])
        below = sum(value[k] for k in clusters[c]["kids"])
        take = below <= own and c != 0
        value[c] = own if take else below
        chosen[c] = take
    labels = np.full(n, -1)
    for c, info in enumerate(clusters):
        at, found = c, None
        while at is not None:
            found = at if chosen[at] else found
            at = clusters[at]["parent"]
        if found is not None:
            labels[list(info["points"])] = found
    return labels


def unequal(seed=1, n=2000):
    """Two tight clouds close to each other, a wide one and scattered points, as directions."""
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(3, 6))
    centre /= np.linalg.norm(centre, axis=1, keepdims=True)
    near = centre[0] + 0.15 * centre[1]
    parts = [(centre[0], 0.015, 0.3), (near, 0.015, 0.3), (-centre[2], 0.2, 0.3)]
    points, label = [], []
    for k, (c, spread, share) in enumerate(parts):
        points.append(c + rng.normal(size=(int(n * share), 6)) * spread)
        label += [k] * int(n * share)
    points.append(rng.normal(size=(n - len(label), 6)))
    label += [-1] * (n - len(label))
    return np.concatenate(points), np.array(label)


def finds_all(got, label):
    """Each planted cloud has a topic of its own that holds half of it and little else."""
    for k in range(3):
        topics, counts = np.unique(got[(label == k) & (got >= 0)], return_counts=True)
        if not len(topics) or counts.max() < 0.5 * (label == k).sum() or counts.max() < 0.9 * (got == topics[counts.argmax()]).sum():
            return False
    return True


def same_partition(a, b):
    pairs = set(zip(a, b))
    return len({x for x, _ in pairs}) == len(pairs) == len({y for _, y in pairs}) and all((x == -1) == (y == -1) for x, y in pairs)


def test_hierarchy_equals_a_plain_one(spark):
    points, label = unequal()
    found = hierarchy.density_hierarchy(frame(spark, points), 40, 10)
    rows = sorted(found.topics.collect())
    got = np.array([r.topic for r in rows])
    assert same_partition(got, plain_hierarchy(points, 40, 10))
    assert len(rows) == len(points) and all((r.topic == -1) == (r.probability == 0) and 0 <= r.probability <= 1 for r in rows)
    sizes = [int((got == t).sum()) for t in range(got.max() + 1)]
    assert sizes == sorted(sizes, reverse=True)
    assert finds_all(got, label)
    tree_rows = found.clusters.collect()
    assert sum(r.parent is None for r in tree_rows) == 1 and max(r["size"] for r in tree_rows) == len(points)


def test_one_cut_cannot_find_them(spark):
    """A low cut leaves the wide cloud out, a high one joins the two tight ones."""
    points, label = unequal()
    vectors = frame(spark, points)
    knn = materialize(clustering.knn_cosine(vectors, 10), "knn")
    for quantile in (0.55, 0.9):
        rows = sorted(clustering.density_cluster(vectors, 40, 10, knn=knn, eps_quantile=quantile).collect())
        assert not finds_all(np.array([r.topic for r in rows]), label)


def test_rounds_and_driver_agree_on_small_clusters(spark):
    rng = np.random.default_rng(9)
    points = rng.normal(size=(200, 3))
    points[5] = points[6] = points[7] = points[8]
    points[20] = 0
    want = plain_hierarchy(np.delete(points, 20, axis=0), 5, 3)
    for local in (10**6, 40, 0):
        rows = sorted(hierarchy.density_hierarchy(frame(spark, points), 5, 3, local=local).topics.collect())
        assert rows[20].topic == -1
        assert same_partition([r.topic for r in rows if r.doc_id != 20], want)


def test_slices_equal_single_runs(spark):
    points, _ = unequal(4, 400)
    vectors = frame(spark, points).withColumn("slice", F.when(F.col("doc_id") % 2 == 0, "even").otherwise("odd"))
    both = {r.doc_id: r.topic for r in hierarchy.density_hierarchy(vectors, 12, 5, by="slice").topics.collect()}
    for name in ("even", "odd"):
        alone = hierarchy.density_hierarchy(vectors.where(F.col("slice") == name), 12, 5).topics.collect()
        assert {r.doc_id: r.topic for r in alone} == {i: t for i, t in both.items() if (i % 2 == 0) == (name == "even")}


def test_tiny_and_empty_tables(spark):
    few = frame(spark, np.eye(3))
    assert {r.topic for r in hierarchy.density_hierarchy(few, 5, 2).topics.collect()} == {-1}
    assert hierarchy.density_hierarchy(few, 2, 1, whole=True).topics.count() == 3
    assert hierarchy.density_hierarchy(few.limit(0), 5, 2).topics.count() == 0


def plain_least(points, core, part, others, other_core, other_part, other_id):
    who, weight = np.zeros(len(points), int), np.full(len(points), np.inf)
    for i, p in enumerate(points):
        reach = np.maximum(np.sqrt(((p - others) ** 2).sum(axis=1)), np.maximum(core[i], other_core))
        reach[other_part == part[i]] = np.inf
        j = np.lexsort((other_id, reach))[0]
        if np.isfinite(reach[j]):
            who[i], weight[i] = other_id[j], reach[j]
    return who, weight


@pytest.mark.parametrize("dims, away, size", [(3, 0, 1.0), (8, 100, 1e-4), (8, 0, 1e-25), (64, 1, 1e20)])
def test_least_outside_equals_all_pairs(dims, away, size):
    from topicflow.functions.tree import least_outside

    rng = np.random.default_rng(11)
    others = (rng.normal(size=(5000, dims)) + (away / size if away > 1 else away)) * size
    others[10:40] = others[10]  # copies: the lower id wins
    core = rng.random(5000) * size * (0.5 if dims < 64 else 9)
    ids, part = rng.permutation(5000) + 5, rng.integers(0, 40, 5000)
    asked = others[:300], core[:300], part[:300]
    want = plain_least(*asked, others, core, part, ids)
    found = least_outside(*asked, others, core, part, ids)
    assert (found[0] == want[0]).all() and (found[1] == want[1]).all()
    bound = want[1] * np.where(np.arange(300) % 2, 1, 0.99)
    found = least_outside(*asked, others, core, part, ids, bound)
    assert (found[0][1::2] == want[0][1::2]).all() and np.isinf(found[1][::2]).all()


def test_inverse_powers_equal_differences():
    from topicflow.operators.quality import inverse_powers

    rng = np.random.default_rng(12)
    for dims, away, size in ((3, 0, 1.0), (7, 100, 1e-4), (64, 1, 1.0)):
        points = rng.normal(size=(3000, dims)) * size + away
        points[5:9], points[11, 0] = points[5], np.nan
        with np.errstate(all="ignore"):
            want = [(np.where((d := np.sqrt(((points - p) ** 2).sum(axis=1))) > 0, d, np.inf) ** -float(dims)).sum() for p in points[:200]]
        assert np.allclose(np.array(want) ** (-1 / dims), inverse_powers(points[:200], points) ** (-1 / dims), rtol=1e-9)


def test_points_are_copied_to_few_blocks(spark):
    """Blocks of a few points would copy each point to hundreds of blocks and fill the disk."""
    from topicflow.functions.tree import LEAST_BLOCKS, Shelves

    rows = [(i, "", [float(v) for v in p], 0.1) for i, p in enumerate(np.random.default_rng(13).normal(size=(600, 512)))]
    shelves = Shelves(spark.createDataFrame(rows, "id long, grp string, vec array<double>, core double"), rows=2)
    assert len(shelves.pivots) <= LEAST_BLOCKS and shelves.cells.agg({"nblk": "sum"}).first()[0] <= 3 * LEAST_BLOCKS
    shelves.discard()
