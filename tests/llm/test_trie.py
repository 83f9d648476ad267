"""The conversation trie against brute force."""

import hashlib
import random
import zlib

import numpy as np
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF
from topicflow.llm import trie

SCHEMA = T.StructType([
    T.StructField("conv_id", T.LongType()), T.StructField("turn", T.LongType()), T.StructField("role", T.StringType()),
    T.StructField("text", T.StringType()), T.StructField("d", T.StringType()), T.StructField("k1", T.LongType()), T.StructField("c", T.LongType()),
])


def make(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], SCHEMA)


def rebuilt(rows):
    digest = lambda r, t: hashlib.sha256(f"{len(r)}:{r}{t}".encode()).hexdigest()
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append(((turn is not None, turn or 0), digest(role or "", text or ""), (role or "", text or "")))
    convs = {c: [t[2] for t in sorted(s)] for c, s in convs.items()}
    first = lambda c: zlib.crc32(str(c).encode()) % 9
    return {c: s if c % 5 == 0 else convs.get(c - c % 5, [])[: first(c)] + s[first(c) :] for c, s in convs.items()}


def expected(rows):
    whole, nodes, children, saved, leaves = rebuilt(rows), {}, {}, {}, {}
    for c, s in whole.items():
        for d in range(len(s) + 1):
            nodes.setdefault(tuple(s[:d]), []).append(c)
    for k in nodes:
        if k:
            children.setdefault(k[:-1], []).append(k)
    for k in sorted(nodes, key=len, reverse=True):
        below = children.get(k, [])
        own = (len(nodes[k]) - 1) * len(k[-1][1].encode()) if k else 0
        saved[k], leaves[k] = own + sum(saved[x] for x in below), sum(leaves[x] for x in below) or 1
    out = []
    for k, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(k))))
        up = min(nodes[k[:-1]]) if k else None
        out.append((min(members), len(k), up, len(members), len(children.get(k, [])), leaves[k], saved[k], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: r[:2])


def check(spark, rows):
    got = sorted((tuple(r) for r in trie.conversation_trie(make(spark, rows)).collect()), key=lambda r: r[:2])
    assert got == expected(rows)


def test_whole_table(spark):
    table = spark.read.parquet(f"{SF}/conversations.parquet")
    got = sorted((tuple(r) for r in trie.conversation_trie(table).collect()), key=lambda r: r[:2])
    assert got == expected([tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()])


def test_odd_rows(spark):
    rows = [
        (0, None, None, None), (0, None, "user", ""), (0, 1, None, "é" * 50_000), (0, 1, None, "é" * 50_000), (1, 0, "", None), (2, 5, "user", "own"),
        (None, 0, "user", "nobody"), (7, 0, "a", "one turn, no base"), (11, 0, "u", "x"), (11, 0, "ux", ""), (10, 0, "u", "x"), (4, 1, "b", "y"), (4, 0, "b", "z"),
    ]
    check(spark, rows)
    assert trie.conversation_trie(make(spark, [])).count() == 0


def test_copies_branches_and_a_long_conversation(spark, monkeypatch):
    """Hot sequences and a conversation longer than a range, with end lists over many chunks."""
    monkeypatch.setattr(trie, "CHUNK", 7)
    draw = random.Random(3)
    rows = []
    for c in range(0, 600):
        kind = draw.random()
        size = draw.randint(1, 12)
        words = (["same"] * 9 if kind < 0.4 else ["same"] * draw.randint(1, 4) + [str(draw.randint(0, 2)) for _ in range(size)])
        rows += [(c, k, "user" if k % 2 else None, w) for k, w in enumerate(words)]
    rows += [(995, k, "u", "same" if k < 5 else str(k % 7)) for k in range(900)]
    check(spark, rows)


def test_running_totals_over_ranges(spark):
    """One group in nearly all ranges, others inside one: totals equal those of a plain loop."""
    draw = random.Random(5)
    rows = [(draw.choice([1, 1, 1, 1, 2, 3]), k, draw.randint(-(2**40), 2**40)) for k in range(3000)] + [(9, 0, 5)]
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    df = spark.createDataFrame(rows, "g long, at long, v long").repartition(5)
    got = {(r.g, r.at): (r.s, r.x) for r in trie.running(df, "g", ["at"], {"s": ("v", "sum"), "x": ("v", "xor")}).collect()}
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    s, x = {}, {}
    for g, at, v in sorted(rows):
        s[g], x[g] = s.get(g, 0) + v, x.get(g, 0) ^ v
        assert got[g, at] == (s[g], x[g])
    assert len(got) == len(rows)


def test_hot_parents_and_others_agree(spark, monkeypatch):
    rows = [(c, 0, "u", str(c % 3)) for c in range(0, 200, 5)] + [(c, 1, "u", str(c)) for c in range(0, 200, 5)]
    for bound in (1, 10**9):
        monkeypatch.setattr(trie, "HOT", bound)
        check(spark, rows)


def test_end_digests(spark):
    ends = spark.range(9000).select(F.lit(2).cast("long").alias("d"), (F.col("id") % 3).alias("k1"), F.lit(0).cast("long").alias("k2"), F.col("id").alias("c"))
    got = {r.k1: r.sha for r in trie.end_digests(ends.repartition(6)).collect()}
    assert got == {k: hashlib.sha256(",".join(map(str, np.arange(k, 9000, 3))).encode()).hexdigest() for k in range(3)}
