"""Toxicity by multiple-instance learning: document labels train a scorer of sentences.

A sentence's probability is logistic in its words; a document's is their noisy-or, one minus the
product of (1 - p). Fitting that against document labels alone tells which sentences carry a label,
so a scored document also lists its offending sentences.

The fit uses at most ``SAMPLE_ROWS`` labelled documents and ``SAMPLE_CHARS`` characters of whole
texts, the first in the order of a hash of doc_id. Features are words and their first four letters
(for inflected languages); of these the fit keeps at most ``VOCABULARY`` that occur in ``LEAST_DOCS``
documents and in toxic ones more often than by chance (``LEAST_Z`` standard deviations). Every
document is scored.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import filled, fold, per_batch, prepare

SAMPLE_ROWS = 8000
SAMPLE_CHARS = 32_000_000
LONGEST = SAMPLE_CHARS // 100  # so that a long text cannot use up the sample
VOCABULARY = 20_000
LEAST_DOCS = 4
LEAST_Z = 4.0
STEM = 4
ROUNDS = 150
RATE = 0.2
SHRINK = 5e-6
START = -9.0  # log-odds of a sentence without any known word
CHUNK = 500  # documents of the sample that are cut into words at a time
SPAN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("score", pa.float64())])


def sentences(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Row, first character and length of each sentence with a word, and the words with their sentence.

    Sentences end at ``.``, ``!``, ``?`` or a line break. A word is a run of letters and digits, A-Z lower-cased.
    """
    lists = pc.split_pattern_regex(pc.ascii_lower(texts), "[.!?\n]")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets -= offsets[0]
    flat = lists.flatten()
    size = pc.utf8_length(flat).to_numpy(zero_copy_only=False).astype(np.int64)
    row = np.repeat(np.arange(len(texts)), np.diff(offsets))
    ends = np.concatenate([[0], np.cumsum(size + 1)])
    start = ends[:-1] - ends[offsets[:-1]][row] if len(row) else ends[:0]
    words = pc.ascii_split_whitespace(pc.replace_substring_regex(flat, "[^\\pL\\pN]+", " "))
    each = words.flatten()
    real = pc.greater(pc.binary_length(each), 0)
    of = np.repeat(np.arange(len(flat)), np.diff(words.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    kept, of = np.unique(of, return_inverse=True)  # sentences that have a word
    return row[kept], start[kept], size[kept], of, each.filter(real).dictionary_encode()


def stems(words: pa.Array) -> pa.Array:
    """The first letters of each word, marked so that they differ from whole words."""
    return pc.binary_join_element_wise(pc.utf8_slice_codeunits(words, 0, STEM), "", "*")


@dataclass
class Scorer:
    """Weights of words and stems, and the log-odds of a sentence without any."""

    features: list[str] = field(default_factory=list)
    weights: np.ndarray = field(default_factory=lambda: np.zeros(0))
    base: float = START

    def odds(self, of: np.ndarray, words: pa.DictionaryArray, n: int) -> np.ndarray:
        weights, per_word = np.append(self.weights, 0.0), 0.0
        for named in (words.dictionary, stems(words.dictionary)):
            place = pc.index_in(named, pa.array(self.features, named.type))
            per_word = per_word + weights[pc.fill_null(place, len(self.features)).to_numpy(zero_copy_only=False)]
        return self.base + np.bincount(of, per_word[words.indices.to_numpy()], n)


def softplus(x: np.ndarray) -> np.ndarray:
    return np.logaddexp(0.0, x)


def named_features(words: pa.DictionaryArray) -> tuple[pa.Array, np.ndarray]:
    """Features of some words, and the two feature numbers (word, stem) of each word in turn."""
    both = pa.concat_arrays([words.dictionary, stems(words.dictionary)]).dictionary_encode()
    codes, n, at = both.indices.to_numpy(), len(words.dictionary), words.indices.to_numpy()
    return both.dictionary, np.concatenate([codes[:n][at], codes[n:][at]]) if len(at) else codes[:0]


def screened(texts: pa.Array, y: np.ndarray) -> tuple[pa.Array, np.ndarray]:
    """The features that toxic documents hold more often than chance, counted chunk by chunk, and their log-odds ratio."""
    counts = []
    for k in range(0, len(texts), CHUNK):
        row, _, _, of, words = sentences(texts[k : k + CHUNK])
        names, token = named_features(words)
        held = np.unique(row[np.concatenate([of, of])].astype(np.int64) * max(len(names), 1) + token)
        feature, doc = held % max(len(names), 1), held // max(len(names), 1)
        toxic = np.bincount(feature, y[k + doc], len(names)) if len(held) else np.zeros(len(names))
        counts.append(pa.table({"name": names, "df": np.bincount(feature, minlength=len(names)), "toxic": toxic}))
    table = pa.concat_tables(counts).group_by("name").aggregate([("df", "sum"), ("toxic", "sum")]).sort_by("name")
    df, toxic, rate = table.column("df_sum").to_numpy(), table.column("toxic_sum").to_numpy(), y.mean()
    z = (toxic - df * rate) / np.sqrt(np.maximum(df * rate * (1 - rate), 1e-9))
    z[df < LEAST_DOCS] = -np.inf
    chosen = np.argsort(-z, kind="stable")[:VOCABULARY]
    chosen = np.sort(chosen[z[chosen] >= LEAST_Z])
    ratio = np.log((toxic + 0.5) / (df - toxic + 0.5)) - np.log(rate / (1 - rate))
    return table.column("name").combine_chunks().take(pa.array(chosen)), ratio[chosen]


def fit(texts: pa.Array, labels: np.ndarray) -> Scorer:
    """Full-batch descent on the noisy-or likelihood; without rows of both labels the starting scorer comes back.

    Sentences without a chosen feature are alike, so only their number per document is kept. Features start from their
    log-odds ratio in documents: once one of its words explains a document, noisy-or asks nothing more of the others.
    """
    y = np.asarray(labels, bool)
    if not y.any() or y.all():
        return Scorer()
    features, ratio = screened(texts, y)
    plain, docs, sentence, token, n = np.zeros(len(y)), [], [], [], 0
    for k in range(0, len(texts), CHUNK):
        row, _, _, of, words = sentences(texts[k : k + CHUNK])
        names, found = named_features(words)
        place = pc.fill_null(pc.index_in(names, features), -1).to_numpy(zero_copy_only=False)[found] if len(found) else found
        kept, own = np.unique(np.concatenate([of, of])[place >= 0], return_inverse=True)
        plain[k : k + CHUNK] = np.bincount(row, minlength=len(plain[k : k + CHUNK])) - np.bincount(row[kept], minlength=len(plain[k : k + CHUNK]))
        docs.append(k + row[kept])
        sentence.append(n + own)
        token.append(place[place >= 0])
        n += len(kept)
    row, of, token = np.concatenate(docs).astype(np.int64), np.concatenate(sentence).astype(np.int64), np.concatenate(token).astype(np.int64)
    weights = np.append(ratio, START)
    speed, power = np.zeros_like(weights), np.zeros_like(weights)
    for step in range(1, ROUNDS + 1):
        z, base = weights[-1] + np.bincount(of, weights[token], n), weights[-1]
        total = np.bincount(row, softplus(z), len(y)) + plain * softplus(base)
        pull = np.where(y, -1.0 / np.expm1(np.clip(total, 1e-9, 500.0)), 1.0) / len(y)  # of the loss by the sum
        by_sentence = pull[row] / (1.0 + np.exp(-np.clip(z, -500.0, 500.0)))
        of_base = by_sentence.sum() + (pull * plain).sum() / (1.0 + np.exp(-np.clip(base, -500.0, 500.0)))
        slope = np.append(np.bincount(token, by_sentence[of], len(features)), of_base)
        slope[:-1] += SHRINK * weights[:-1]
        speed = 0.9 * speed + 0.1 * slope
        power = 0.99 * power + 0.01 * slope**2
        weights -= RATE * (speed / (1 - 0.9**step)) / (np.sqrt(power / (1 - 0.99**step)) + 1e-8)
    return Scorer(features.to_pylist(), weights[:-1], float(weights[-1]))


def training_sample(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The bounded sample of labelled documents outside the held-out fold: (text, toxic).

    Ids are drawn among those that have both a label and a text of at most ``LONGEST`` characters, so that labels
    without a document and very long texts take no place. Only ids and labels are shuffled for the draw.
    """
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).where(F.length("text") <= LONGEST)
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.where(fold() != 0).join(texts.select("doc_id").distinct(), "doc_id", "left_semi")
    known = known.withColumn("__at", F.xxhash64("doc_id", F.lit(7))).orderBy("__at", "doc_id").limit(SAMPLE_ROWS)
    both = texts.join(F.broadcast(known), "doc_id").orderBy("__at", "doc_id", F.xxhash64("text")).limit(SAMPLE_ROWS)
    so_far = F.sum(F.length("text")).over(Window.orderBy("__at", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    return both.withColumn("__so_far", so_far).where(F.col("__so_far") <= SAMPLE_CHARS).select("text", "toxic")


def train(docs: DataFrame, labels: DataFrame) -> Scorer:
    """A scorer from documents and their labels (columns doc_id, text; doc_id, toxic).

    Labels of several rows of one doc_id count by their largest; null labels and ids are left out. An empty table, or one without
    labelled rows of both kinds, gives the starting scorer.
    """
    prepare(docs)
    table = training_sample(docs, labels).toArrow()
    scorer = fit(table.column("text").combine_chunks(), table.column("toxic").to_numpy())
    pa.default_memory_pool().release_unused()
    return scorer


def noisy_or(row: np.ndarray, z: np.ndarray, n: int) -> np.ndarray:
    return -np.expm1(-np.bincount(row, softplus(z), n))


def score(docs: DataFrame, scorer: Scorer) -> DataFrame:
    """All columns of ``docs`` and ``__toxicity`` (0 to 1) and ``__offending`` (spans of sentences with p >= 0.5).

    A null or empty text has no sentence and scores 0. Rows keep their place; repeated rows score alike.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        row, start, size, of, words = sentences(filled(batch))
        z = scorer.odds(of, words, len(row))
        bad = np.flatnonzero(z >= 0)
        spans = pa.StructArray.from_arrays([pa.array(start[bad]), pa.array(size[bad]), pa.array(1 / (1 + np.exp(-z[bad])))], fields=list(SPAN))
        ends = np.concatenate([[0], np.cumsum(np.bincount(row[bad], minlength=batch.num_rows))]).astype(np.int32)
        offending = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), spans)
        found = [pa.array(noisy_or(row, z, batch.num_rows)), offending]
        return pa.RecordBatch.from_arrays([*batch.columns, *found], [*batch.schema.names, "__toxicity", "__offending"])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return per_batch(docs, work, f"{kinds}, __toxicity double, __offending array<struct<start:bigint,length:bigint,score:double>>")


def drop_toxic(docs: DataFrame, labels: DataFrame, threshold: float = 0.5) -> DataFrame:
    """``docs`` without the documents whose score reaches ``threshold``; the scorer learns from ``docs`` itself."""
    return score(docs, train(docs, labels)).where(F.col("__toxicity") < threshold).select(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted, offending (spans of sentences) per document, held-out ones never learnt from."""
    scored = score(docs.select("doc_id", "text"), train(docs, labels))
    return scored.select(
        "doc_id", (fold() == 0).alias("held_out"), F.col("__toxicity").alias("score"),
        (F.col("__toxicity") >= 0.5).cast("int").alias("predicted"), F.col("__offending").alias("offending"),
    )
