"""Quality classifier: histogram gradient-boosted trees over statistics of whole documents.

Statistics are taken once, in one pass over the texts, and written as a narrow table (``NAMES``); training and scoring read only
that. A tree is grown level by level: one histogram of gradients per (node, statistic, bin) gives all splits of a level. Trees are complete
binary trees in arrays (split statistic and bound per inner node, value per leaf), so a batch of rows goes down all of them by
array look-ups, without a branch.

The fit takes at most ``SAMPLE_ROWS`` labelled documents, drawn by a hash of doc_id after labels and documents were joined, so labels
without a document take nobody's place. Statistics cover every character of every document, and every document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import filled, fold, hash_words, mix, per_batch, prepare, split_words

SAMPLE_ROWS = 40_000
BINS = 64
DEPTH = 4
TREES = 120
RATE = 0.1
SHRINK = 1.0  # added to the curvature of a leaf
LEAST_CURVATURE = 2.0  # of a leaf
LEAST_GAIN = 1e-3
SIGNS = "#*$%&|<>!?.,;:'\"()[]{}-_/\\=+@~^`"
KINDS = ("upper", "lower", "digit", "blank", "break", "wide")
NAMES = (
    "log_chars", "log_words", "log_lines", "word_length", "word_length_spread", "short_words", "long_words", "words_per_line", "longest_line",
    "distinct_words", "top_word", "stutter", "repeated_pairs", "repeated_triples", "repeated_lines", "repeated_line_chars", "capitals", "digits", "blanks",
    "wide", "signs", "kinds_of_signs", "top_sign", "stops", "calls", "bars", "marks", "line_stops", "sentence_words", "letter_entropy",
)


def _table() -> np.ndarray:
    """Class of each byte: first the kinds, then one class per sign, the last for all others."""
    kind = np.full(256, len(KINDS) + len(SIGNS), np.int64)
    kind[65:91], kind[97:123], kind[48:58], kind[[9, 11, 12, 13, 32]], kind[10] = 0, 1, 2, 3, 4
    kind[0xC0:0x100] = 5  # first byte of a character beyond ASCII
    for k, sign in enumerate(SIGNS):
        kind[ord(sign)] = len(KINDS) + k
    return kind


BYTES, CLASSES = _table(), len(KINDS) + len(SIGNS) + 1


def share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def repeated(row: np.ndarray, key: np.ndarray, weight: np.ndarray, n: int) -> np.ndarray:
    """Per row the weight of the keys that it has met before."""
    if not len(key):
        return np.zeros(n)
    both = mix(key ^ mix(row.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(both, kind="stable")
    later = np.zeros(len(key), bool)
    later[order[1:]] = both[order[1:]] == both[order[:-1]]
    return np.bincount(row[later], weight[later], n)


def statistics_of(texts: pa.Array) -> np.ndarray:
    """One row of ``NAMES`` per text."""
    n = len(texts)
    size = pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.frombuffer("".join(texts.to_pylist()).encode(), np.uint8)
    of = np.repeat(np.arange(n), size)
    counts = np.bincount(of * CLASSES + BYTES[flat], minlength=n * CLASSES).reshape(n, CLASSES).astype(float)
    kind = dict(zip(KINDS, counts.T))
    signs = counts[:, len(KINDS) : len(KINDS) + len(SIGNS)]
    sign = lambda which: signs[:, [SIGNS.index(s) for s in which]].sum(axis=1)
    chars = pc.utf8_length(texts).to_numpy(zero_copy_only=False).astype(float)
    letters = counts[:, [0, 1]].sum(axis=1) + kind["wide"]
    spread = counts / np.maximum(size, 1)[:, None]
    entropy = -(spread * np.log(np.maximum(spread, 1e-12))).sum(axis=1)

    ends, words = split_words(texts)
    per = np.diff(ends).astype(float)
    row = np.repeat(np.arange(n), np.diff(ends))
    long = pc.utf8_length(words.dictionary).to_numpy(zero_copy_only=False).astype(float)[words.indices.to_numpy()] if len(words) else np.zeros(0)
    total = lambda v: np.bincount(row, v, n)
    mean = share(total(long), per)
    code = hash_words(words.dictionary)[words.indices.to_numpy()] if len(words) else np.zeros(0, np.uint64)
    one = np.ones(len(code))
    first_seen = per - repeated(row, code, one, n)
    most = np.zeros(n)
    if len(code):
        _, at, often = np.unique(mix(code ^ mix(row.astype(np.uint64) + np.uint64(1))), return_index=True, return_counts=True)
        np.maximum.at(most, row[at], often)
    pair, triple = (row[k:] == row[:-k] if len(row) > k else np.zeros(0, bool) for k in (1, 2))
    two = mix(code[:-1] * np.uint64(3) + code[1:])[pair] if len(pair) else code[:0]
    three = mix(mix(code[:-2] * np.uint64(3) + code[1:-1]) * np.uint64(3) + code[2:])[triple] if len(triple) else code[:0]
    row2, row3 = row[: len(pair)][pair], row[: len(triple)][triple]
    stutter = np.bincount(row2[(code[:-1] == code[1:])[pair]], minlength=n) if len(pair) else np.zeros(n)

    split = pc.split_pattern(texts, "\n")
    line, within = split.flatten(), np.repeat(np.arange(n), np.diff(split.offsets.to_numpy()))
    wide = pc.utf8_length(line).to_numpy(zero_copy_only=False).astype(float)
    full = pc.greater(pc.binary_length(pc.utf8_trim_whitespace(line)), 0).to_numpy(zero_copy_only=False)
    stopped = pc.match_substring_regex(line, r"[.!?]\s*$").to_numpy(zero_copy_only=False)
    lines = np.bincount(within[full], minlength=n).astype(float)
    coded = line.dictionary_encode()
    names = hash_words(coded.dictionary)[coded.indices.to_numpy()][full] if full.any() else np.zeros(0, np.uint64)
    widest = np.zeros(n)
    np.maximum.at(widest, within, wide)
    values = (
        np.log1p(chars), np.log1p(per), np.log1p(lines), mean, np.sqrt(np.maximum(share(total(long**2), per) - mean**2, 0)), share(total(long <= 3), per),
        share(total(long > 12), per), share(per, lines), np.log1p(widest), share(first_seen, per), share(most, per), share(stutter, per),
        share(repeated(row2, two, np.ones(len(two)), n), per), share(repeated(row3, three, np.ones(len(three)), n), per),
        share(repeated(within[full], names, np.ones(len(names)), n), lines), share(repeated(within[full], names, wide[full], n), chars),
        share(kind["upper"], letters), share(kind["digit"], chars), share(kind["blank"], chars), share(kind["wide"], chars), share(signs.sum(axis=1), per),
        (signs > 0).sum(axis=1), share(signs.max(axis=1), per), share(sign(".,;:?"), per), share(sign("!"), per), share(sign("|"), per),
        share(sign("#*$%&<>=@~^_"), per), share(np.bincount(within[stopped & full], minlength=n), lines), per / (sign(".!?") + 1), entropy,
    )
    return np.stack([np.asarray(v, float) for v in values], axis=1)


@dataclass
class Forest:
    """Trees as arrays: statistic and bound of the inner nodes, value of the leaves; the children of node k are 2k + 1 and 2k + 2."""

    start: float
    feature: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1), np.int64))
    bound: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH - 1)))
    value: np.ndarray = field(default_factory=lambda: np.zeros((0, 2**DEPTH)))

    def odds(self, x: np.ndarray) -> np.ndarray:
        """Log-odds of each row; a value that equals the bound goes left."""
        rows, out = np.arange(len(x)), np.full(len(x), self.start)
        for feature, bound, value in zip(self.feature, self.bound, self.value):
            at = np.zeros(len(x), np.int64)
            for _ in range(DEPTH):
                at = 2 * at + 1 + (x[rows, feature[at]] > bound[at])
            out += value[at - (2**DEPTH - 1)]
        return out

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-self.odds(x)))


def bounds_of(x: np.ndarray) -> list[np.ndarray]:
    """Bounds between bins: middles between neighbouring values, or between quantiles where a statistic has more than BINS values."""
    out = []
    for column in x.T:
        values = np.unique(column)
        if len(values) > BINS:
            values = np.unique(np.quantile(column, np.linspace(0, 1, BINS)))
        out.append((values[:-1] + values[1:]) / 2)
    return out


def best_splits(g: np.ndarray, h: np.ndarray, node: np.ndarray, binned: np.ndarray, nodes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per node the gain, statistic and last left bin of the best split, from one histogram over (node, statistic, bin)."""
    width = binned.shape[1]
    cell = ((node[:, None] * width + np.arange(width)) * BINS + binned).ravel()
    shape = (nodes, width, BINS)
    left_g = np.bincount(cell, np.repeat(g, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
    left_h = np.bincount(cell, np.repeat(h, width), nodes * width * BINS).reshape(shape).cumsum(axis=2)
    all_g, all_h = left_g[:, :, -1:], left_h[:, :, -1:]
    right_g, right_h = all_g - left_g, all_h - left_h
    gain = left_g**2 / (left_h + SHRINK) + right_g**2 / (right_h + SHRINK) - all_g**2 / (all_h + SHRINK)
    gain[(left_h < LEAST_CURVATURE) | (right_h < LEAST_CURVATURE)] = 0
    best = gain.reshape(nodes, -1).argmax(axis=1)
    return gain.reshape(nodes, -1)[np.arange(nodes), best], best // BINS, best % BINS


def grow(x: np.ndarray, y: np.ndarray) -> Forest:
    """Second-order boosting of the logistic loss; with labels of one kind only, or none, every row gets their smoothed rate."""
    y = np.asarray(y, float)
    rate = (y.sum() + 0.5) / (len(y) + 1)
    forest = Forest(float(np.log(rate / (1 - rate))))
    if not len(y) or y.min() == y.max():
        return forest
    edges = bounds_of(x)
    binned = np.stack([np.searchsorted(e, c, side="left") for e, c in zip(edges, x.T)], axis=1)
    padded = np.stack([np.append(e, np.full(BINS - len(e), np.inf)) for e in edges])
    odds, inner = np.full(len(y), forest.start), 2**DEPTH - 1
    feature, bound, value = np.zeros((TREES, inner), np.int64), np.full((TREES, inner), np.inf), np.zeros((TREES, inner + 1))
    for t in range(TREES):
        p = 1 / (1 + np.exp(-odds))
        g, h, at = y - p, p * (1 - p), np.zeros(len(y), np.int64)
        for level in range(DEPTH):
            first = 2**level - 1
            gain, which, last = best_splits(g, h, at - first, binned, 2**level)
            here = np.flatnonzero(gain > LEAST_GAIN)  # elsewhere all rows go left
            feature[t, first + here], bound[t, first + here] = which[here], padded[which[here], last[here]]
            at = 2 * at + 1 + (x[np.arange(len(y)), feature[t][at]] > bound[t][at])
        leaf = at - inner
        value[t] = RATE * np.bincount(leaf, g, inner + 1) / (np.bincount(leaf, h, inner + 1) + SHRINK)
        odds += value[t][leaf]
    forest.feature, forest.bound, forest.value = feature, bound, value
    return forest


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and ``NAMES`` per row of ``docs`` (doc_id, text); a null text counts as empty."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = statistics_of(filled(batch))
        return pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c) for c in x.T)], ["doc_id", *NAMES])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return per_batch(docs.select("doc_id", "text"), work, ", ".join([f"doc_id {kind}", *(f"{name} double" for name in NAMES)]))


def training_rows(stats: DataFrame, labels: DataFrame, label: str, most: int = SAMPLE_ROWS) -> DataFrame:
    """At most ``most`` rows (``NAMES``, label) of documents with a label outside the held-out fold.

    Labels of several rows of one doc_id count by their largest; null labels and ids are left out. A threshold on the hash leaves little
    more than ``most`` rows to be ranked.
    """
    known = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).alias("__label"))
    both = stats.where(fold() != 0).join(known.where(fold() != 0), "doc_id").withColumn("__at", F.xxhash64("doc_id", F.lit(11)))
    n = both.count()
    if n > most:
        span = 2**63 * 2 * 1.2 * most / n - 2**63
        both = both.where(F.col("__at") <= int(min(span, 2**63 - 1))).orderBy("__at", "doc_id", *NAMES).limit(most)
    return both.select(*NAMES, "__label")


def train(stats: DataFrame, labels: DataFrame, label: str = "quality") -> Forest:
    """A forest from statistics and labels (doc_id and 0 or 1 in ``label``)."""
    rows = training_rows(stats, labels, label).toArrow()
    x = np.stack([rows.column(name).to_numpy() for name in NAMES], axis=1) if rows.num_rows else np.zeros((0, len(NAMES)))
    y = rows.column("__label").to_numpy().astype(float)
    order = np.lexsort(x.T)  # rows arrive in any order; sums shall not depend on it
    return grow(x[order], y[order])


def apply(stats: DataFrame, forest: Forest) -> DataFrame:
    """doc_id and score (probability of label 1) per row of statistics."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.stack([batch.column(name).to_numpy(zero_copy_only=False) for name in NAMES], axis=1)
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(forest.probability(x))], ["doc_id", "score"])

    kind = stats.schema["doc_id"].dataType.simpleString()
    return per_batch(stats.select("doc_id", *NAMES), work, f"doc_id {kind}, score double", 20_000)


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3) -> DataFrame:
    """doc_id, held_out, score, predicted per document; held-out ones are never learnt from.

    Nulls and empty texts have the statistics of an empty text; repeated rows score alike; a null doc_id belongs to the fold of the empty
    text and learns from no label. An empty table gives no rows.
    """
    prepare(docs)
    stats = materialize(statistics(docs), "statistics")
    scored = materialize(apply(stats, train(stats, labels)), "scores")
    discard(stats)
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
