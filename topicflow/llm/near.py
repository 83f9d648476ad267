"""Near-duplicates by an LSH forest over MinHash signatures, links confirmed on full shingle sets.

Texts with equal shingle sets form one class, and the rest works on classes. Each of ``TREES`` orders sorts
the classes by its own ``DEPTH`` hash values. A region is a run of classes with a common prefix of at least
``SHALLOW`` values; inside it each class is held against those that follow in sorted order, the nearest at the
shallow depth, farther ones only while they share a longer prefix, so dense regions go deeper. Pairs whose
whole signatures agree well enough join a candidate cluster. A region that holds a thousandth of all rows is cut by
full label and salt. Both only lower the work: classes of any region in which not all rows meet go to the exact join below.

Candidate clusters are confirmed on full sets, all pairs of a cluster in one bounded task. Clusters too
large for that are dealt to blocks that share a few pivots; classes of theirs and of dense regions that end up in different
parts are compared by a prefix join on full sets, which misses no link. Classes in one confirmed part never meet again, and copies are never expanded.

Two texts of similarity 0.8 meet in at least one order with probability 1 - (1 - 0.8^5)^24 > 0.9999.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.graph import connected_components
from ..session import materialize
from .common import filled, hash_words, key_filter, mix, per_batch, prepare, split_words

WORDS = 4
SIMILARITY = 80  # percent
TREES, DEPTH, SHALLOW = 24, 8, 5
REACH = 64  # neighbours at the shallow depth; eight times as many per further value
AGREE = 0.68  # of a signature: four standard deviations below 0.8
HOT_ROWS, HOT_SHARE = 5000, 1000
BLOCK_SETS, BLOCK_SHINGLES, PIVOTS = 256, 2_000_000, 8
SLOTS = 1 << 18  # that shingles are counted in, to put rare ones first; the order changes the work, not the links
LAST = 2**63 - 1  # stands for a null doc_id, which is larger than any other
MULTIPLIERS = np.random.default_rng(41).integers(0, 2**63, TREES * DEPTH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
CHUNK = 2048


def shingles(texts: pa.Array, words: int) -> Iterator[np.ndarray]:
    """Per text the sorted distinct 64-bit hashes of its shingles; a shorter text is one shingle."""
    offsets, coded = split_words(texts)
    hashes = hash_words(coded.dictionary)[coded.indices.to_numpy()] if len(coded) else np.zeros(0, np.uint64)
    n = len(hashes)
    with np.errstate(over="ignore"):
        rolled = np.full(max(n - words + 1, 0), words, np.uint64)
        for k in range(words):
            rolled = mix(rolled * np.uint64(0x9E3779B97F4A7C15) + hashes[k : n - words + 1 + k])
        for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
            if b - a >= words:
                yield np.unique(rolled[a : b - words + 1])
            elif b > a:
                whole = np.full(1, b - a, np.uint64)
                for k in range(a, b):
                    whole = mix(whole * np.uint64(0x9E3779B97F4A7C15) + hashes[k : k + 1])
                yield whole
            else:
                yield np.zeros(0, np.uint64)


def signature(found: np.ndarray) -> np.ndarray:
    """One byte per hash function: a byte of the smallest hash value, so unequal minima agree by chance in 1 of 256."""
    least = np.full(len(MULTIPLIERS), 2**64 - 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(0, len(found), CHUNK):
            least = np.minimum(least, (found[k : k + CHUNK, None] * MULTIPLIERS).min(axis=0))
        return (mix(least) & np.uint64(255)).astype(np.uint8)


def class_of(found: np.ndarray) -> tuple[int, int]:
    """Two independent 64-bit sums over a set; equal sets have equal sums."""
    with np.errstate(over="ignore"):
        sums = np.array([found.sum(dtype=np.uint64), mix(found + np.uint64(97)).sum(dtype=np.uint64)], np.uint64)
        return tuple(mix(sums + np.uint64(len(found))).view(np.int64).tolist())


def sketches(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, rank (doc_id, null last), n_shingles, class (two numbers) and signature (null without shingles)."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sizes, first, second, signs = [], [], [], []
        for found in shingles(filled(batch), words):
            a, b = class_of(found)
            sizes.append(len(found))
            first.append(a)
            second.append(b)
            signs.append(signature(found).tobytes() if len(found) else None)
        columns = [batch.column(0), batch.column(2), pa.array(sizes, pa.int64()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), pa.array(signs, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "rank", "n_shingles", "set_a", "set_b", "sign"])

    rows = docs.select("doc_id", "text", F.coalesce("doc_id", F.lit(LAST)).alias("rank"))
    return per_batch(rows, work, "doc_id long, rank long, n_shingles long, set_a long, set_b long, sign binary")


def forest_rows(classes: DataFrame) -> DataFrame:
    """One row per class and order: region (order and shallow prefix), label, signature."""
    each = classes.select("class", "sign", F.explode(F.sequence(F.lit(0), F.lit(TREES - 1))).alias("tree"))
    label = F.substring(F.col("sign"), F.col("tree") * DEPTH + 1, F.lit(DEPTH))
    return each.withColumn("label", label).withColumn("region", F.xxhash64("tree", F.substring("label", 1, SHALLOW)))


def regions(classes: DataFrame) -> DataFrame:
    """Rows of regions with more than one class (and a few lone ones), each with the key of its task."""
    rows = forest_rows(classes)
    crowded = rows.groupBy("region").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    crowded = materialize(crowded, "regions")
    total = classes.count() * TREES
    hot = crowded.where((F.col("n") >= HOT_ROWS) & (F.col("n") * HOT_SHARE >= total))  # at most a thousand
    met = key_filter(crowded, "region")(rows, "region").where("__hit").drop("__hit")
    met = met.join(F.broadcast(hot.withColumnRenamed("n", "hot")), "region", "left")
    salt = F.pmod(F.xxhash64("class", "tree"), F.ceil(F.col("hot") / HOT_ROWS))
    return met.withColumn("key", F.when(F.col("hot").isNull(), F.col("region")).otherwise(F.xxhash64("region", "label", salt))).select("key", "label", "class", "sign", F.col("hot").isNotNull().alias("hot"))


class Parts:
    """Disjoint sets of row numbers."""

    def __init__(self, n: int):
        self.up = np.arange(n)

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return int(x)

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b

    def flat(self) -> np.ndarray:
        while (self.up[self.up] != self.up).any():
            self.up = self.up[self.up]
        return self.up


def depth_at(distance: int) -> int:
    depth, reach = SHALLOW, REACH
    while distance > reach and depth < DEPTH:
        depth, reach = depth + 1, reach * 8
    return depth


def neighbours(key: np.ndarray, label: np.ndarray, sign: np.ndarray) -> tuple[list[tuple[int, int]], np.ndarray]:
    """Pairs of rows, sorted by key and label, that agree well and connect what was apart, and the part of each row."""
    parts, pairs = Parts(len(key)), []
    active, distance = np.arange(len(key)), 0
    while len(active):
        distance += 1
        active = active[active + distance < len(key)]
        other = active + distance
        unlike = label[active] ^ label[other]
        near = (key[active] == key[other]) & (unlike >> np.uint64(8 * (DEPTH - depth_at(distance))) == 0)
        active = active[near]
        root = parts.flat()
        test = active[root[active] != root[active + distance]]
        for k in range(0, len(test), 20_000):
            some = test[k : k + 20_000]
            agree = (sign[some] == sign[some + distance]).mean(axis=1) >= AGREE
            pairs += [(a, a + distance) for a in some[agree].tolist() if parts.join(a, a + distance)]
    return pairs, parts.flat()


def candidates(classes: DataFrame) -> DataFrame:
    """a, b, top: pairs of classes whose signatures agree, and the part of their region that they belong to.

    Where a region holds more rows than a row is held against, a pair of each class with itself says so.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.Table] = []

        def found(table: pa.Table) -> pa.RecordBatch:
            key = table.column("key").to_numpy()
            label = np.array([int.from_bytes(x, "big") for x in table.column("label").to_pylist()], np.uint64)
            sign = np.frombuffer(b"".join(table.column("sign").to_pylist()), np.uint8).reshape(len(key), -1)
            pairs, part = neighbours(key, label, sign)
            names = table.column("class").to_numpy()
            begins = np.flatnonzero(np.diff(key, prepend=key[0] - 1))
            size = np.diff(np.append(begins, len(key)))
            dense = np.flatnonzero((np.repeat(size, size) > REACH + 1) | table.column("hot").to_numpy())
            a, b = np.concatenate([np.array(pairs, np.int64).reshape(-1, 2).T, [dense, dense]], axis=1)
            return pa.RecordBatch.from_arrays([pa.array(names[a]), pa.array(names[b]), pa.array(names[part[a]])], ["a", "b", "top"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(pa.table(batch))
            key = batch.column(0).to_numpy()
            if key[0] == key[-1]:
                continue  # the region may go on
            whole = pa.concat_tables(held)
            cut = whole.num_rows - int((key == key[-1]).sum())
            yield found(whole.slice(0, cut))
            held = [whole.slice(cut)]
        if held:
            yield found(pa.concat_tables(held))

    rows = regions(classes)
    ordered = rows.repartition("key").sortWithinPartitions("key", "label", "class")
    return materialize(ordered.mapInArrow(work, "a long, b long, top long"), "candidates")


def shared(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity, counted on the full sets."""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < SIMILARITY * len(large):
        return False
    at = np.searchsorted(large, small)
    both = int((large[np.minimum(at, len(large) - 1)] == small).sum())
    return 100 * both >= SIMILARITY * (len(a) + len(b) - both)


def sets_of(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """class and full set of the given classes (class, rank, set_a, set_b), from the text of one document each.

    Only texts whose id passes the key filter leave their place.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = list(shingles(filled(batch), words))
        keys = [class_of(s) for s in sets]
        columns = [batch.column(0), pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64()), pa.array([s.tobytes() for s in sets], pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["rank", "set_a", "set_b", "shingles"])

    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("rank"), "text")
    rows = key_filter(classes, "rank")(rows, "rank").where("__hit").select("rank", "text")
    found = per_batch(rows, work, "rank long, set_a long, set_b long, shingles binary")
    return found.join(classes.select("class", "rank", "set_a", "set_b"), ["rank", "set_a", "set_b"]).select("class", "shingles")


def confirmed_in_blocks(members: DataFrame) -> DataFrame:
    """src, dst: links that connect all classes of a block which full sets connect."""

    def work(table: pa.Table) -> pa.Table:
        names, first = np.unique(table.column("class").to_numpy(), return_index=True)
        sets = [np.frombuffer(table.column("shingles")[int(k)].as_buffer(), np.uint64) for k in first]
        parts, links = Parts(len(sets)), []
        for i in range(len(sets)):
            for j in range(i):
                if parts.find(i) != parts.find(j) and shared(sets[i], sets[j]):
                    parts.join(i, j)
                    links.append((names[i], names[j]))
        a, b = np.array(links, np.int64).reshape(-1, 2).T
        return pa.table({"src": a, "dst": b})

    return members.groupBy("cluster", "block").applyInArrow(work, "src long, dst long")


def confirmed_pairs(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (src, dst) whose full sets are similar enough."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        sides = [[np.frombuffer(x, np.uint64) for x in batch.column(k).to_pylist()] for k in (2, 3)]
        good = pa.array([shared(a, b) for a, b in zip(*sides)], pa.bool_())
        return pa.RecordBatch.from_arrays([batch.column(0).filter(good), batch.column(1).filter(good)], ["src", "dst"])

    side = lambda end, name: sets.select(F.col("class").alias(end), F.col("shingles").alias(name))
    both = pairs.join(side("src", "x"), "src").join(side("dst", "y"), "dst")
    return per_batch(both.select("src", "dst", "x", "y"), work, "src long, dst long")


def links(docs: DataFrame, classes: DataFrame, words: int) -> DataFrame:
    """src, dst: confirmed links between classes, enough to connect all that meet in some order and are similar."""
    pairs = candidates(classes)
    dense = materialize(pairs.where("a = b").select(F.col("a").alias("class")).distinct(), "dense")
    pairs = pairs.where("a <> b")
    tops = pairs.select(F.col("top").alias("src"), F.col("a").alias("dst")).unionByName(pairs.select(F.col("top").alias("src"), F.col("b").alias("dst")))
    clusters = materialize(connected_components(tops).select(F.col("id").alias("class"), F.col("component").alias("cluster")), "clusters")
    lone = dense.join(clusters, "class", "left_anti").select("class", F.col("class").alias("cluster"))
    members = clusters.unionByName(lone).join(classes.select("class", "rank", "set_a", "set_b", "n_shingles"), "class")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), F.sum("n_shingles").alias("total"))
    sizes = sizes.withColumn("blocks", F.greatest(F.ceil(F.col("n") / BLOCK_SETS), F.when(F.col("n") > 2, F.ceil(F.col("total") / BLOCK_SHINGLES)).otherwise(1)).cast("int"))
    members = materialize(members.join(sizes.select("cluster", "blocks", "n"), "cluster"), "members")
    sets = sets_of(docs, members, words).join(members.select("class", "cluster", "blocks", "n"), "class")
    sets = materialize(sets.dropDuplicates(["class"]), "sets")
    pivots = members.where("blocks > 1").groupBy("cluster").agg(F.slice(F.array_sort(F.collect_set(F.when(F.pmod(F.xxhash64("class"), F.col("blocks") * (BLOCK_SETS // PIVOTS)) == 0, F.col("class")))), 1, PIVOTS).alias("pivots"))
    dealt = sets.where("n > 1").join(pivots, "cluster", "left")
    own = F.array(F.pmod(F.xxhash64("class", F.lit(3)), F.col("blocks")).cast("int"))
    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    dealt = dealt.withColumn("block", F.explode(F.when(F.coalesce(F.array_contains("pivots", F.col("class")), F.lit(False)), everywhere).otherwise(own)))
    found = materialize(confirmed_in_blocks(dealt.select("cluster", "block", "class", "shingles")), "links")
    large = members.where("blocks > 1").select("class", "cluster", own[0].alias("block"))
    exact = large.select("class").unionByName(dense).distinct()
    if exact.isEmpty():
        return found
    if not large.isEmpty():
        found = materialize(found.unionByName(_links_of_hubs(found, large, sets)), "links")
    return found.unionByName(_links_by_prefix(found, exact, sets))


def _parted(found: DataFrame, table: DataFrame) -> DataFrame:
    """``table`` (class, ...) with the part that the links found so far put each class in."""
    part = connected_components(found).select(F.col("id").alias("class"), "component")
    return table.join(part, "class", "left").withColumn("part", F.coalesce("component", "class")).drop("component")


def _links_of_hubs(found: DataFrame, large: DataFrame, sets: DataFrame) -> DataFrame:
    """Links of the best connected classes of a large cluster with members that other blocks hold; leaves less to the prefixes."""
    ends = found.select(F.col("src").alias("class")).unionByName(found.select(F.col("dst").alias("class")))
    known = materialize(_parted(found, large), "parts")
    degree = ends.groupBy("class").agg(F.count(F.lit(1)).alias("links")).join(known, "class")
    best = degree.groupBy("cluster", "block").agg(F.max(F.struct("links", "class", "part")).alias("best"))
    hubs = best.groupBy("cluster").agg(F.explode(F.slice(F.sort_array(F.collect_list("best"), asc=False), 1, PIVOTS)).alias("hub"))
    pairs = known.join(hubs, "cluster").where(F.col("part") != F.col("hub.part")).select(F.col("class").alias("src"), F.col("hub.class").alias("dst"))
    return confirmed_pairs(materialize(pairs, "hubs"), sets)


def _links_by_prefix(found: DataFrame, exact: DataFrame, sets: DataFrame) -> DataFrame:
    """All links between classes of ``exact`` that are in different parts so far, by a prefix join on full sets.

    Shingles have one order, rarest first by the counts of their slots. Two sets that reach the similarity share a shingle
    that has enough shingles after it in both, so each set shows only the shingles of its prefix. A shingle that only one
    part shows is dropped. Crowded shingles are cut into salts that are held against all rows of the shingle.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SLOTS, np.int64)
        for batch in batches:
            if batch.num_rows:
                total += np.bincount(_slots(np.concatenate([np.frombuffer(x.as_buffer(), np.uint64) for x in batch.column(0)])), minlength=SLOTS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["slot", "n"])

    wanted = materialize(_parted(found, exact).join(sets.select("class", "shingles"), "class"), "exact")
    counts = wanted.select("shingles").mapInArrow(count, "slot long, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int64)
    often[counts.column("slot").to_numpy()] = counts.column("n").to_numpy()
    often = wanted.sparkSession.sparkContext.broadcast(often)

    def prefixes(batch: pa.RecordBatch) -> pa.RecordBatch:
        shown, size = [], []
        for one in batch.column(2):
            found = np.frombuffer(one.as_buffer(), np.uint64)
            order = np.lexsort((found, often.value[_slots(found)]))
            size.append(len(found))
            shown.append(found[order[: len(found) - -(-SIMILARITY * len(found) // 100) + 1]])
        each = np.array([len(x) for x in shown], np.int64)
        row = np.repeat(np.arange(len(each)), each)
        place = np.arange(len(row)) - np.repeat(np.cumsum(each) - each, each)
        columns = [pa.array(np.concatenate(shown).view(np.int64)), batch.column(0).take(pa.array(row)), batch.column(1).take(pa.array(row)), pa.array(np.array(size, np.int64)[row]), pa.array(place)]
        return pa.RecordBatch.from_arrays(columns, ["shingle", "class", "part", "n", "place"])

    rows = materialize(per_batch(wanted.select("class", "part", "shingles"), prefixes, "shingle long, class long, part long, n long, place long"), "prefixes")
    met = rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("rows"), F.min("part").alias("low"), F.max("part").alias("high"))
    met = met.where("low <> high").select("shingle", F.ceil(F.col("rows") / HOT_ROWS).cast("int").alias("salts"))
    rows = materialize(rows.join(met, "shingle"), "met")
    left = rows.withColumn("salt", F.pmod(F.xxhash64("class"), F.col("salts")).cast("int")).drop("salts")
    right = rows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).select("shingle", "salt", *[F.col(c).alias(f"o_{c}") for c in ("class", "part", "n", "place")])
    both = left.join(right, ["shingle", "salt"]).where("class < o_class and part <> o_part")
    least = SIMILARITY * (F.col("n") + F.col("o_n"))  # (100 + SIMILARITY) times the shingles that must be shared
    both = both.where(((100 + SIMILARITY) * (F.col("n") - F.col("place")) >= least) & ((100 + SIMILARITY) * (F.col("o_n") - F.col("o_place")) >= least))
    pairs = both.select(F.col("class").alias("src"), F.col("o_class").alias("dst")).distinct()
    return confirmed_pairs(materialize(pairs, "apart"), sets)


def _slots(found: np.ndarray) -> np.ndarray:
    return (found & np.uint64(SLOTS - 1)).astype(np.int64)


def near_duplicates(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable over links), kept per row of ``docs``.

    A text without words, empty or null, has an empty set and is linked with nothing. A null doc_id is larger than
    any other and is returned as null where nothing smaller is reachable. Repeated rows share their class. An empty table gives no rows.
    """
    rows, named = _components(docs, words)
    told = rows.select("doc_id", "rank", "n_shingles", "set_a", "set_b").join(named.select("set_a", "set_b", "first"), ["set_a", "set_b"], "left")
    lowest = F.when(F.col("n_shingles") > 0, F.col("first.rank")).otherwise(F.col("rank"))
    return told.select("doc_id", "n_shingles", F.when(lowest != LAST, lowest).alias("component_id"), (F.col("rank") == lowest).alias("kept"))


def _components(docs: DataFrame, words: int) -> tuple[DataFrame, DataFrame]:
    """The sketches, and per class (set_a, set_b) the first (rank, set_a, set_b) of its component and the rows that has."""
    docs = prepare(docs).select("doc_id", "text")
    rows = materialize(sketches(docs, words), "sketches")
    real = rows.where("n_shingles > 0")
    classes = real.groupBy("set_a", "set_b").agg(F.min("rank").alias("rank"), F.first("n_shingles").alias("n_shingles"), F.first("sign").alias("sign"), F.count(F.lit(1)).alias("copies"))
    classes = materialize(classes.withColumn("class", F.xxhash64("set_a", "set_b")), "classes")
    part = connected_components(links(docs, classes, words)).select(F.col("id").alias("class"), "component")
    joined = classes.select("set_a", "set_b", "class", "rank", "copies").join(part, "class", "left").withColumn("component", F.coalesce("component", "class"))
    firsts = joined.groupBy("component").agg(F.min(F.struct("rank", "set_a", "set_b")).alias("first"), F.sum("copies").alias("n_rows"))
    return rows, joined.join(firsts, "component").select("set_a", "set_b", "first", "n_rows")


def drop_near(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """``docs`` with exactly one row of each component, one with the smallest doc_id, and all rows without words.

    Rows are told apart by doc_id and shingle set, so rows that share a doc_id, or have none, don't go with one another.
    Rows whose id is that of no row with a near copy stay where they are.
    """
    rows, named = _components(docs, words)
    many = materialize(named.where("n_rows > 1").select(F.col("set_a").alias("__a"), F.col("set_b").alias("__b"), F.col("first").alias("__first")), "many")
    touched = rows.join(many, (F.col("set_a") == F.col("__a")) & (F.col("set_b") == F.col("__b")), "left_semi").select("rank").distinct()
    tested = key_filter(touched, "rank")(docs.withColumn("__rank", F.coalesce("doc_id", F.lit(LAST))), "__rank")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        keys = [class_of(s) for s in shingles(filled(batch), words)]
        sums = [pa.array([k[0] for k in keys], pa.int64()), pa.array([k[1] for k in keys], pa.int64())]
        return pa.RecordBatch.from_arrays([*batch.columns, *sums], [*batch.schema.names, "__a", "__b"])

    hits = tested.where("__hit").drop("__hit")
    schema = T.StructType([*hits.schema.fields, T.StructField("__a", T.LongType()), T.StructField("__b", T.LongType())])
    marked = per_batch(hits, work, schema).join(many, ["__a", "__b"], "left")
    alone = marked.where("__first is null")
    first = marked.where("__first.rank = __rank and __first.set_a = __a and __first.set_b = __b").dropDuplicates(["__a", "__b"])
    return tested.where("not __hit").select(*docs.columns).unionByName(alone.select(*docs.columns)).unionByName(first.select(*docs.columns))
