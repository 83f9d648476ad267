"""Spelling variants: words of a corpus at edit distance one, found in a trie of letter-group counts.

A word's vector counts its letters in 16 groups (code point minus one, modulo 16), each count up to 15, packed into 64 bits; a
prefix of the bits is a node of the trie whose levels are the groups in turn. One inserted, deleted or replaced letter raises one count
and lowers one at most, so a depth-first search with a budget of one surplus and one deficit reaches every leaf that can hold a near
word. Each pair is sought once, from the shorter word, or from the one with the smaller vector: the deficit may only follow the surplus.
Words of a leaf that share a half with the word sought are compared letter by letter.

The trie is cut into cells of at most ``CELL`` words (a ``CELLS``-th of all where that is more), counted over the whole vocabulary; the
cells are the only thing that is broadcast, fewer than ``CELLS`` x 16 x 16. A word visits the cells within its budget, and each cell is searched
in a task of its own. Cells whose words all have one vector are searched in blocks, and so are crowds of visitors.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import filled, prepare

LETTERS = "a-zÀ-ÿ"
SHORTEST = 7  # letters of a word
LEAST = 2  # occurrences
TIMES = 10  # a form occurs so many times as often as its variant
SPELLED = 31  # one in so many runs of a document loses a letter
LEVELS = 16
FIRST = 3  # levels of the coarsest cells
CELL = 10_000
CELLS = 2000
VISITORS = 100_000  # in one block
HELD = 100_000  # different words that a task counts before it hands them on
PIECE = 2_000_000  # letters compared at a time
MOVES = {0: ((0, 0), (1, 1)), 1: ((0, 1), (-1, 2)), 2: ((0, 2),)}  # budget spent -> (change of a count, budget spent then)
BASE = np.uint64(0x9E3779B97F4A7C15)


def runs(docs: DataFrame) -> DataFrame:
    """word, n: runs of letters of all whole texts, A-Z lower-cased, some with a letter deleted; counted per task, so words repeat."""
    pattern = re.compile(f"[{LETTERS}]{{{SHORTEST},}}")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter[str] = Counter()
        for batch in batches:
            for doc_id, text in zip(filled(batch, "doc_id").to_pylist(), pc.ascii_lower(filled(batch)).to_pylist()):
                start = crc32(f"{doc_id}:".encode())
                for run, n in Counter(pattern.findall(text)).items():
                    h = crc32(run.encode(), start)
                    if h % SPELLED == 0:
                        k = h % len(run)
                        run = run[:k] + run[k + 1 :]
                    counts[run] += n
                if len(counts) >= HELD:
                    yield counted(counts)
                    counts.clear()
        yield counted(counts)

    def counted(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], ["word", "n"])

    texts = prepare(docs).select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return texts.mapInArrow(work, "word string, n long").where(F.length("word") >= SHORTEST)


def letters(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All letters of some words in a row (their code points fit a byte) and the number of letters of each word."""
    size = pc.utf8_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    return np.frombuffer("".join(words.to_pylist()).encode("latin-1"), np.uint8), size


def vectors(words: pa.Array) -> np.ndarray:
    """The packed counts of each word."""
    flat, size = letters(words)
    cell = np.repeat(np.arange(len(size)) * LEVELS, size) + ((flat.astype(np.int64) - 1) % LEVELS)
    counts = np.minimum(np.bincount(cell, minlength=len(size) * LEVELS), 15).reshape(-1, LEVELS).astype(np.uint64)
    return np.bitwise_or.reduce(counts << (60 - 4 * np.arange(LEVELS)).astype(np.uint64), axis=1) if len(size) else np.zeros(0, np.uint64)


def prefix(v: np.ndarray, level: int) -> np.ndarray:
    return v >> np.uint64(64 - 4 * level) if level else np.zeros(len(v), np.uint64)


def find(among: np.ndarray, what: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each value in a sorted array of different ones, and whether it is there."""
    if not len(among):
        return np.zeros(len(what), np.int64), np.zeros(len(what), bool)
    at = np.minimum(np.searchsorted(among, what), len(among) - 1)
    return at, among[at] == what


class Trie:
    """Nodes per level as sorted prefixes; ``ends[level]`` are the leaves there and their numbers."""

    def __init__(self, start: np.ndarray, level: np.ndarray):
        self.nodes = [np.unique(prefix(start[level >= k], k)) for k in range(LEVELS + 1)]
        self.ends = []
        for k in range(LEVELS + 1):
            here = np.flatnonzero(level == k)
            own = prefix(start[here], k)
            order = np.argsort(own)
            self.ends.append((own[order], here[order]))

    def search(self, v: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(places in ``v``, leaves) within the budget, depth first; words that spent alike go down together."""
        stack = [(0, np.arange(len(v)), np.zeros(len(v), np.uint64), 0)]
        while stack:
            level, who, at, spent = stack.pop()
            ends, numbers = self.ends[level]
            place, here = find(ends, at)
            if here.any():
                yield who[here], numbers[place[here]]
                who, at = who[~here], at[~here]
            if level == LEVELS or not len(who):
                continue
            count = ((v[who] >> np.uint64(60 - 4 * level)) & np.uint64(15)).astype(np.int64)
            for change, then in MOVES[spent]:
                fits = (count + change >= 0) & (count + change <= 15)
                child = (at[fits] << np.uint64(4)) | (count[fits] + change).astype(np.uint64)
                _, there = find(self.nodes[level + 1], child)
                if there.any():
                    stack.append((level + 1, who[fits][there], child[there], then))


def half_hashes(flat: np.ndarray, size: np.ndarray, half: np.ndarray, whole: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the first ``half`` letters and of the last ``whole - half`` letters of each word."""
    starts = np.cumsum(size) - size
    at = np.arange(len(flat)) - np.repeat(starts, size)
    power = np.cumprod(np.concatenate([[np.uint64(1)], np.full(max(int(size.max()), 1), BASE)]))
    code, cut, tail = flat.astype(np.uint64) + np.uint64(1), np.repeat(half, size), np.repeat(size - (whole - half), size)
    first = np.add.reduceat(np.where(at < cut, code * power[at], np.uint64(0)), starts)
    last = np.add.reduceat(np.where(at >= tail, code * power[np.maximum(at - tail, 0)], np.uint64(0)), starts)
    return first, last


def keyed(leaf: np.ndarray, length: np.ndarray, value: np.ndarray) -> np.ndarray:
    key = value ^ ((leaf.astype(np.uint64) * np.uint64(4096) + length.astype(np.uint64)) * BASE)
    return (key ^ (key >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)


def gather(starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The places start, start + 1, ... of each range in turn."""
    return np.repeat(starts - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))


def one_apart(a: tuple, b: tuple, i: np.ndarray, j: np.ndarray, longer: bool) -> np.ndarray:
    """Whether word i of ``a`` and word j of ``b`` (as long, or one letter longer) are one edit apart."""
    (flat_a, size_a), (flat_b, size_b) = a, b
    start_a, start_b = np.cumsum(size_a) - size_a, np.cumsum(size_b) - size_b
    out, done, length = np.zeros(len(i), bool), np.cumsum(size_a[i]), size_a[i]
    for k in range(0, int(done[-1]) // PIECE + 1 if len(i) else 0):
        some = np.flatnonzero((done - 1) // PIECE == k)
        if not len(some):
            continue
        n = length[some]
        begins, at = np.cumsum(n) - n, gather(np.zeros(len(some), np.int64), n)
        left, right = flat_a[np.repeat(start_a[i[some]], n) + at], np.repeat(start_b[j[some]], n) + at
        same = left == flat_b[right]
        if longer:
            ahead = np.minimum.reduceat(np.where(same, np.repeat(n, n), at), begins)
            behind = n - 1 - np.maximum.reduceat(np.where(left == flat_b[right + 1], -1, at), begins)
            out[some] = ahead + behind >= n
        else:
            out[some] = np.add.reduceat((~same).astype(np.int64), begins) == 1
    return out


def near_pairs(seen: pa.Array, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (visitor, resident) one edit apart, the resident longer or, at equal length, later by (vector, word)."""
    if not len(seen) or not len(words):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    v, w = vectors(seen), vectors(words)
    leaves, leaf = np.unique(w, return_inverse=True)
    a, b = letters(seen), letters(words)
    found = list(Trie(leaves, np.full(len(leaves), LEVELS)).search(v))
    who, where = (np.concatenate(x) for x in zip(*found)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    first, last = half_hashes(*a, a[1] // 2, a[1])
    out = []
    for longer in (False, True):
        plain = b[1] - longer  # letters that both have
        heads, tails = half_hashes(*b, plain // 2, plain)
        for own, theirs in ((first, heads), (last, tails)):
            key = keyed(leaf, plain, theirs)
            order = np.argsort(key, kind="stable")
            ask = keyed(where, a[1][who], own[who])
            low, high = np.searchsorted(key[order], ask, "left"), np.searchsorted(key[order], ask, "right")
            i, j = np.repeat(who, high - low), order[gather(low, high - low)]
            fits = a[1][i] == plain[j]
            if own is last:  # found by the first half already
                fits &= first[i] != heads[j]
            if not longer:
                fits &= v[i] <= w[j]
            i, j = i[fits], j[fits]
            near = one_apart(a, b, i, j, longer)
            out.append((i[near], j[near], np.full(near.sum(), longer)))
    i, j, longer = (np.concatenate(x) for x in zip(*out))
    tie = ~longer & (v[i] == w[j])  # one vector: each pair meets twice, the later word counts
    rank = pc.greater(words.take(pa.array(j)), seen.take(pa.array(i))).to_numpy(zero_copy_only=False) if len(i) else np.zeros(0, bool)
    return i[~tie | rank], j[~tie | rank]


def cells(vocabulary: DataFrame, total: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First vector, level and number of words of each cell; every round counts the next level of the cells that are too large."""
    spark, most = vocabulary.sparkSession, max(CELL, total // CELLS)
    bits = lambda level: F.expr(f"shiftrightunsigned(v, {64 - 4 * level})") if level < LEVELS else F.col("v")
    level, rest, done = FIRST, vocabulary, []
    while True:
        rows = rest.groupBy(bits(level).alias("p")).agg(F.count("*").alias("n")).collect()  # at most 16 x CELLS rows, at first 16 ** FIRST
        large = [r["p"] for r in rows if r["n"] > most] if level < LEVELS else []
        done += [(r["p"] % 2**64 << (64 - 4 * level), level, r["n"]) for r in rows if r["n"] <= most or level == LEVELS]
        if not large:
            break
        above = F.broadcast(spark.createDataFrame([(p,) for p in large], "p long"))  # fewer than CELLS rows
        rest = vocabulary.join(above, bits(level) == F.col("p"), "left_semi")
        level += 1
    done.sort()
    start, level, n = (np.array([d[k] for d in done], kind) for k, kind in enumerate((np.uint64, np.int64, np.int64)))
    return start, level, n


def neighbours(vocabulary: DataFrame, total: int) -> DataFrame:
    """word, n_near, best (least of (-n, word) over its near words) from vocabulary (word, n, v); a word may come from many cells."""
    start, level, size = cells(vocabulary, total)
    trie, most = Trie(start, level), max(CELL, total // CELLS)

    def packed(batch: pa.RecordBatch) -> np.ndarray:
        return batch.column("v").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)

    def visits(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(start), np.int64)
        for batch in batches:
            for _, where in trie.search(packed(batch)):
                n += np.bincount(where, minlength=len(start))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], ["cell", "n"])

    seen = np.zeros(len(start), np.int64)
    for row in vocabulary.select("v").mapInArrow(visits, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect():  # one row per cell
        seen[row["cell"]] = row["n"]
    salts = np.maximum(-(-size // most), 1)  # more than one only for words of one vector
    chunks = np.maximum(-(-seen // max(VISITORS, 10 * most)), 1)
    first_block = np.cumsum(salts * chunks) - salts * chunks

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Residents to all chunks of their salt, visitors to all salts of their chunk: each pair meets once."""
        for batch in batches:
            if not batch.num_rows:
                continue
            v, word = packed(batch), np.array([crc32(w.encode()) for w in batch.column("word").to_pylist()], np.int64)
            own = np.searchsorted(start, v, "right") - 1
            who = np.repeat(np.arange(len(v)), chunks[own])
            block = first_block[own[who]] + (word[who] % salts[own[who]]) * chunks[own[who]] + gather(np.zeros(len(v), np.int64), chunks[own])
            out = [(who, block, np.ones(len(who), bool))]
            for guest, where in trie.search(v):
                who = np.repeat(np.arange(len(guest)), salts[where])
                at, cell = guest[who], where[who]
                chunk = word[at] // 7 % chunks[cell]
                out.append((at, first_block[cell] + gather(np.zeros(len(guest), np.int64), salts[where]) * chunks[cell] + chunk, np.zeros(len(at), bool)))
            who, block, lives = (np.concatenate(x) for x in zip(*out))
            rows = batch.select(["word", "n"]).take(pa.array(who))
            yield pa.RecordBatch.from_arrays([pa.array(block), pa.array(lives), *rows.columns], ["block", "lives", "word", "n"])

    def search(block: pa.Table) -> pa.Table:
        lives = block.column("lives").combine_chunks()
        guests, residents = block.filter(pc.invert(lives)), block.filter(lives)
        words = [t.column("word").combine_chunks() for t in (guests, residents)]
        counts = [t.column("n").to_numpy() for t in (guests, residents)]
        i, j = near_pairs(*words)
        names, n = pa.concat_arrays(words), np.concatenate(counts)
        left, right = np.concatenate([i, j + len(guests)]), np.concatenate([j + len(guests), i])
        rank = np.empty(len(names), np.int64)
        rank[pc.sort_indices(names).to_numpy()] = np.arange(len(names))
        order = np.lexsort((rank[right], -n[right], left))
        left, right = left[order], right[order]
        firsts = np.flatnonzero(np.append(True, left[1:] != left[:-1])) if len(left) else left
        found = [names.take(pa.array(left[firsts])), pa.array(np.diff(np.append(firsts, len(left)))), pa.array(-n[right[firsts]]), names.take(pa.array(right[firsts]))]
        return pa.table(found, ["word", "n_near", "less", "form"])

    dealt = prepare(vocabulary, 5000).select("word", "n", "v").mapInArrow(deal, "block long, lives boolean, word string, n long")
    found = dealt.groupBy("block").applyInArrow(search, "word string, n_near long, less long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct("less", "form")).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word, root: the forms (word, form) followed to the last by pointer doubling; n rises tenfold at each step, so rounds are few."""
    now = materialize(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        up = now.select(F.col("word").alias("root"), F.col("root").alias("above"))
        then = materialize(now.join(up, "root", "left").select("word", F.coalesce("above", "root").alias("root"), F.col("above").isNotNull().alias("moved")), "roots")
        discard(now)
        if then.where("moved").isEmpty():
            return then.select("word", "root")
        now = then.drop("moved")


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n per word of ``docs`` (doc_id, text) with seven letters and two occurrences.

    A null text has no words; a null doc_id counts as the empty text. Repeated rows count again. Of near words that occur
    equally often the first in code-point order is the form. An empty table gives no rows.
    """
    kept = runs(docs).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= LEAST)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = vectors(batch.column("word")).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(v, pa.int64())], ["word", "n", "v"])

    vocabulary = materialize(kept.mapInArrow(packed, "word string, n long, v long"), "vocabulary")
    near = neighbours(vocabulary, vocabulary.count())
    much = (F.col("best.less") * -1) >= F.col("n") * TIMES
    linked = vocabulary.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(much, F.col("best.form")).alias("form"),
        F.when(much, -F.col("best.less")).alias("form_n"),
    )
    linked = materialize(linked, "linked")
    discard(vocabulary)
    ends = roots(linked.where("form is not null"))
    return linked.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
