"""Prefix trie of conversations by collapsing whole sequences.

A turn is known by a digest of its role and text, a prefix by its depth and the exclusive or of one 64-bit hash per
(place, turn) pair, twice with other seeds: 128 bits, which any range of a long conversation can add to on its own. Texts are read
once and never shuffled. Identical conversations collapse into one weighted sequence with the list of its ends; a sequence
whose key is a proper prefix of another is dropped by an anti-join, the rest are the leaves. What a node counts is a sum over
the prefixes of distinct sequences, never over pairs of a node and its ancestors.

Each node belongs to its smallest member, so a sequence owns a chain of nodes that reaches down to its end. What a node saves
below itself is the tail of its own chain plus the whole chains of the other sequences that pass through it.

A conversation may hold a third of all turns, a sequence a third of all conversations: ordered work
(``running``, ``end_digests``) goes by ranges of rows, and the driver links the ranges through one row of each.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import prepare

GROUP = 5  # conversations that share a beginning
SHARED = 8  # most turns of it that one of them takes
CHUNK = 4096  # ids of an end list that are joined into one row
ROWS = 20_000  # of an Arrow batch; these rows hold numbers only
HOT = 1000  # parents with at least this share of all branches are broadcast, so there are fewer than this many
KEY = ["d", "k1", "k2"]
OPS = {"sum": (np.cumsum, np.subtract, np.add), "xor": (np.bitwise_xor.accumulate, np.bitwise_xor, np.bitwise_xor)}


def running(df: DataFrame, group: str, order: list[str], values: dict[str, tuple[str, str]]) -> DataFrame:
    """``df`` and running totals (name -> (long column, "sum" or "xor")) over each group's rows in ``order``, each row included.

    Rows are dealt into ranges of (group, order), so a hot group spreads over many tasks. Every task streams its range; where
    a group goes on in the next one, the totals so far follow from one row per range. ``group`` must not be null.
    """
    spark, kept = df.sparkSession, df.columns
    whole = materialize(prepare(df, ROWS), "unordered")  # dealing into ranges reads it twice

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slot, first, last, so_far, schema = TaskContext.get().partitionId(), None, None, {}, None
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            g = batch.column(group).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(np.append(True, g[1:] != g[:-1]))
            size = np.diff(np.append(starts, n))
            first = g[0] if first is None else first
            totals = []
            for name, (column, op) in values.items():
                accumulate, undo, join = OPS[op]
                total = accumulate(batch.column(column).to_numpy(zero_copy_only=False).astype(np.int64))
                total = undo(total, np.repeat(np.append(0, total)[starts], size))
                if last == g[0]:
                    total[: size[0]] = join(total[: size[0]], so_far[name])
                so_far[name] = total[-1]
                totals.append(pa.array(total))
            last, schema = g[-1], batch.schema
            flags = [pa.array(g == first), pa.repeat(False, n), pa.repeat(pa.scalar(slot, pa.int32()), n), pa.nulls(n, pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *totals, *flags], [*kept, *values, "__open", "__edge", "__slot", "__first"])
        if schema is not None:
            row = [pa.array([last if f.name == group else None], f.type) for f in schema]
            row += [pa.array([v], pa.int64()) for v in so_far.values()]
            row += [pa.array([True]), pa.array([True]), pa.array([slot], pa.int32()), pa.array([first], pa.int64())]
            yield pa.RecordBatch.from_arrays(row, [*kept, *values, "__open", "__edge", "__slot", "__first"])

    kinds = [f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema] + [f"`{name}` long" for name in values]
    dealt = whole.repartitionByRange(group, *order).sortWithinPartitions(group, *order)
    table = materialize(dealt.mapInArrow(run, ", ".join([*kinds, "__open boolean, __edge boolean, __slot int, __first long"])), "running")
    discard(whole)
    edges = table.where("__edge").select("__slot", "__first", F.col(group).alias("__last"), *values).collect()  # one row per range
    carried, before = [], None
    for edge in sorted(edges, key=lambda e: e["__slot"]):
        totals = [int(edge[name]) for name in values]
        if before and before[0] == edge["__first"]:
            carried.append((edge["__slot"], *before[1]))
            if edge["__last"] == edge["__first"]:
                totals = [int(OPS[op][2](np.int64(a), np.int64(b))) for a, b, (_, op) in zip(totals, before[1], values.values())]
        before = (edge["__last"], totals)
    rows = table.where("not __edge")
    if carried:
        schema = "__slot int, " + ", ".join(f"`__{name}` long" for name in values)
        rows = rows.join(F.broadcast(spark.createDataFrame(carried, schema)), "__slot", "left")  # one row per range
        for name, (_, op) in values.items():
            more = F.when(F.col("__open"), F.coalesce(F.col(f"__{name}"), F.lit(0))).otherwise(0)
            rows = rows.withColumn(name, F.col(name) + more if op == "sum" else F.col(name).bitwiseXOR(more))
    return rows.select(*kept, *values)


def turns(conversations: DataFrame) -> DataFrame:
    """c, at (place among the conversation's turns, from 1), a, b (digest of role and text), bytes of the text.

    Turns are ordered by ``turn``, null first; equal ones by their digest. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.sha2(F.concat(F.length(role).cast("string"), F.lit(":"), role, text), 256)
    word = lambda k: F.conv(F.substring(digest, 15 * k + 1, 15), 16, 10).cast("long")
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("c"), F.col("turn").cast("long").alias("turn"), word(0).alias("a"), word(1).alias("b"),
        F.octet_length(text).cast("long").alias("bytes"), F.lit(1).cast("long").alias("one"),
    )
    return running(rows, "c", ["turn", "a", "b"], {"at": ("one", "sum")}).select("c", "at", "a", "b", "bytes")


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Sequences c, d, a, b, bytes: the first h turns of c - c % 5, then c's own after its first h (h = crc32(c) % 9); row d = 0 for each c.

    Only the first eight turns of a conversation are ever copied, to at most eight others.
    """
    own = turns(conversations)
    base = F.col("c") - F.col("c") % GROUP
    heads = own.where(f"at = 1 or (c % {GROUP} = 0 and at <= {SHARED})").withColumn("base", base)
    shared = F.sort_array(F.collect_list(F.when(F.col("c") == F.col("base"), F.struct("at", "a", "b", "bytes"))))
    groups = heads.groupBy("base").agg(F.collect_set("c").alias("convs"), shared.alias("shared"))
    each = groups.select("base", "shared", F.explode_outer("convs").alias("c"))
    skip = F.when(F.col("c") == F.col("base"), 0).otherwise(F.crc32(F.col("c").cast("string")) % 9)
    each = each.withColumn("skip", skip.cast("int")).withColumn("m", F.least("skip", F.size("shared")))
    each = materialize(each.select("c", "skip", "m", F.slice("shared", 1, F.col("m")).alias("shared")), "beginnings")
    none = F.lit(0).cast("long")
    first = each.select("c", none.alias("d"), none.alias("a"), none.alias("b"), none.alias("bytes"))
    taken = each.select("c", F.explode_outer("shared").alias("s")).where("s is not null").select("c", F.col("s.at").alias("d"), "s.a", "s.b", "s.bytes")
    rest = own.join(each.select("c", "skip", "m"), "c").where("at > skip")  # one row per conversation; a hot one is split by AQE
    rest = rest.select("c", (F.col("at") - F.col("skip") + F.col("m")).alias("d"), "a", "b", "bytes")
    return first.unionByName(taken).unionByName(rest)


def end_digests(ends: DataFrame) -> DataFrame:
    """Per key the SHA-256 of its members' decimal ids, ascending, joined by commas (ends: d, k1, k2, c).

    Ranges of ids are joined into chunks first; then one task streams the chunks of a key through the hash, so that a long list is
    never held anywhere.
    """

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            keys = [batch.column(name).to_numpy() for name in KEY]
            ids, new = batch.column("c").to_numpy(), np.append(True, np.zeros(n - 1, bool))
            for k in keys:
                new[1:] |= k[1:] != k[:-1]
            starts = np.flatnonzero(new | (np.arange(n) % CHUNK == 0))
            parts = [",".join(map(str, ids[a:b].tolist())) for a, b in zip(starts, np.append(starts[1:], n))]
            yield pa.RecordBatch.from_arrays([*(pa.array(k[starts]) for k in keys), pa.array(ids[starts]), pa.array(parts)], [*KEY, "at", "ids"])

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, state = None, None
        for batch in batches:
            done = []
            for d, k1, k2, ids in zip(*(batch.column(name).to_pylist() for name in [*KEY, "ids"])):
                if now == (d, k1, k2):
                    state.update(b"," + ids.encode())
                    continue
                if now:
                    done.append((*now, state.hexdigest()))
                now, state = (d, k1, k2), hashlib.sha256(ids.encode())
            yield listed(done)
        yield listed([(*now, state.hexdigest())] if now else [])

    def listed(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], [*KEY, "sha"])

    dealt = ends.repartitionByRange(*KEY, "c").sortWithinPartitions(*KEY, "c")
    chunks = dealt.mapInArrow(join, "d long, k1 long, k2 long, at long, ids string")
    return chunks.repartition(*KEY).sortWithinPartitions(*KEY, "at").mapInArrow(digest, "d long, k1 long, k2 long, sha string")


def prefix_trie(sequences: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Nodes and ends of a table of sequences (c, d, a, b, bytes; d from 1 without gaps, and a row d = 0 for each c).

    Nodes: d, k1, k2 (key), conv_id (smallest member), parent_conv_id, n_convs, n_children, n_leaves, saved, sha. Ends: c and the key of
    its last node. An empty table has neither, not even a root.
    """
    place = lambda *v: F.when(F.col("d") > 0, F.xxhash64("d", *v)).otherwise(0)
    hashed = sequences.select("c", "d", "bytes", place("a", "b", F.lit(1)).alias("w1"), place("b", "a", F.lit(2)).alias("w2"))
    rows = running(hashed, "c", ["d"], {"k1": ("w1", "xor"), "k2": ("w2", "xor")})

    last = rows.groupBy("c").agg(F.max(F.struct(*KEY)).alias("e"))
    ends = materialize(last.select("c", "e.*"), "ends")
    weighted = materialize(ends.groupBy(*KEY).agg(F.count("*").alias("n"), F.min("c").alias("c")), "sequences")
    whole = weighted.select("c", "n", F.col("d").alias("length"))
    prefixes = materialize(rows.join(whole, "c"), "prefixes")
    discard(rows)
    inner = prefixes.where("d < length").select(*KEY).distinct()
    leaves = weighted.join(inner, KEY, "left_anti").select("c", F.lit(1).alias("leaf"))

    one = prefixes.groupBy(*KEY).agg(
        F.min("c").alias("conv_id"), F.sum("n").alias("n_convs"), F.max("bytes").alias("bytes"), F.max("w1").alias("w1"), F.max("w2").alias("w2")
    )
    one = one.withColumn("own", (F.col("n_convs") - 1) * F.col("bytes")).withColumn("up", -F.col("d")).drop("bytes")
    chains = running(one, "conv_id", ["up"], {"saved": ("own", "sum")})
    owned = chains.groupBy(F.col("conv_id").alias("c")).agg(F.max("saved").alias("total"), F.min("d").alias("top"))
    facts = weighted.select("c").join(leaves, "c", "left").join(owned, "c", "left")
    passing = materialize(prefixes.join(facts, "c"), "passing")
    discard(prefixes)

    zero, mine = F.lit(0).cast("long"), F.col("top").isNotNull() & (F.col("d") >= F.col("top"))
    through = passing.select(
        *KEY, F.when(mine, zero).otherwise(F.coalesce("total", zero)).alias("saved"), F.coalesce("leaf", F.lit(0)).alias("leaf"),
        F.when(mine & (F.col("d") < F.col("length")), 1).otherwise(0).alias("child"), F.when(mine & (F.col("d") == F.col("top")), 1).alias("begins"),
    )
    up = [(F.col("d") - 1).alias("d"), *(F.col(f"k{i}").bitwiseXOR(F.col(f"w{i}")).alias(f"k{i}") for i in (1, 2))]
    branches = passing.where(mine & (F.col("d") == F.col("top")) & (F.col("d") > 0)).select(*up, F.lit(1).alias("branch"))
    stacked = chains.drop("own", "up")
    for part in (through, branches, end_digests(ends)):
        stacked = stacked.unionByName(part, allowMissingColumns=True)
    total = lambda name: F.coalesce(F.sum(name), zero)
    nodes = materialize(stacked.groupBy(*KEY).agg(
        *(F.max(name).alias(name) for name in ("conv_id", "n_convs", "w1", "w2", "sha", "begins")), total("saved").alias("saved"),
        total("leaf").alias("n_leaves"), total("branch").alias("branches"), (total("child") + total("branch")).alias("n_children"),
    ), "nodes")
    discard(passing, chains, weighted)
    return with_parents(nodes), ends


def with_parents(nodes: DataFrame) -> DataFrame:
    """The parent's smallest member: inside a chain the node's own, at the top of a chain that of the node it hangs from."""
    most = nodes.agg(F.sum("branches").alias("n")).first()["n"] or 0
    known = nodes.where("begins is null or d = 0").withColumn("parent_conv_id", F.when(F.col("d") > 0, F.col("conv_id")))
    up = [F.col("d") - 1, *(F.col(f"k{i}").bitwiseXOR(F.col(f"w{i}")) for i in (1, 2))]
    tops = nodes.where("begins = 1 and d > 0").withColumns({f"__{name}": c for name, c in zip(KEY, up)})
    parents = nodes.where("branches > 0").select(*(F.col(name).alias(f"__{name}") for name in KEY), F.col("conv_id").alias("parent_conv_id"), "branches")
    hot = parents.where(F.col("branches") > most / HOT).drop("branches")  # fewer than HOT rows
    above = [f"__{name}" for name in KEY]
    apart = tops.join(F.broadcast(hot), above, "left")
    found = apart.where("parent_conv_id is not null")
    others = apart.where("parent_conv_id is null").drop("parent_conv_id").join(parents.drop("branches"), above)
    rest = found.unionByName(others).drop(*above)
    return known.unionByName(rest).drop("w1", "w2", "begins", "branches")


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The nodes of the rebuilt conversations (columns conv_id, turn, role, text).

    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 per node. Null roles and texts count as empty, a
    null turn comes first, equal turns of a conversation are ordered by a digest of role and text, repeated rows are turns of their own, rows
    without a conv_id are no conversation. An empty table has no nodes.
    """
    nodes, _ = prefix_trie(rebuilt(conversations))
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return nodes.select(
        "conv_id", F.col("d").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha", nothing).alias("ends_sha256"),
    )
