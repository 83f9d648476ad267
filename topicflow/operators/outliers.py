"""Moving noise documents into topics, and reports about it."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import ABLATION_THRESHOLDS, NOISE, RANDOM_SEED, OutlierThresholds
from ..functions.scale import hash_key
from ..session import materialize
from .neighbours import nearest
from .topics import topic_words_row, vocabulary_tokens

_DEFAULTS = OutlierThresholds()
BLOCK_BYTES = 64 << 20
DENSE_CELLS = 1 << 22  # documents x topics of one product
TEXT_BYTES = 1 << 20  # text of the documents that a task scores at a time (one document may be longer)


def ctfidf_scores(
    docs: DataFrame, topics: DataFrame, ctfidf: DataFrame, text: str = "text_lemm", key: str = "doc_id", by: Sequence[str] = (),
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Best topic of each noise document by cosine of document and topic class TF-IDF: ``key, best, score``.

    A document vector weighs its term counts with the weights the topics use, ln(1 + A / f). A document without any known
    term is absent. With ``by``, documents only meet topics of their own slice.

    The topics are cut into blocks of at most ``block_bytes`` (a topic alone may be larger), each a sparse matrix that goes to the tasks.
    Every Arrow batch of documents meets every block where it is, ``TEXT_BYTES`` of text at a time: no term is shuffled and no row per
    document and topic exists, one best topic per document and block does. Slices go one after another inside a block.
    """
    by = list(by)
    # written, so that Spark knows its size: a small table of ids goes to the texts and no text is shuffled
    noise = materialize(topics.where(F.col("topic") == NOISE).select(key), "noise-ids")
    tokens = docs.select(key, *by, vocabulary_tokens(F.col(text)).alias("w")).join(noise, key, "left_semi")
    slice_of = F.to_json(F.struct(*by)) if by else F.lit("")
    rows = tokens.select(F.col(key).cast("long").alias("id"), slice_of.alias("slice"), F.array_join("w", " ").alias("w"))
    model = _topic_weights(ctfidf, by, slice_of)
    blocks = _topic_blocks(model, block_bytes)
    if len(blocks) > 1:
        rows = materialize(rows, "noise", packed=True)  # the texts are cut into words once, not once per block
    found = [_block_scores(rows, model, block) for block in blocks] or [docs.sparkSession.createDataFrame([], _FOUND)]
    best = reduce(DataFrame.unionByName, found)
    if len(blocks) > 1:
        best = best.groupBy("id").agg(
            F.max(F.struct("s", (-F.col("topic")).alias("neg"))).alias("b"), F.max("norm").alias("norm")
        ).select("id", F.col("b.s").alias("s"), (-F.col("b.neg")).cast("int").alias("topic"), "norm")
    cosine = F.try_divide("s", "norm")
    return best.select(F.col("id").alias(key), F.col("topic").alias("best"), F.round(cosine, 10).alias("score"))


_FOUND = "id long, topic int, s double, norm double"


def _topic_weights(ctfidf: DataFrame, by: Sequence[str], slice_of) -> DataFrame:
    """slice, topic, term, score and the idf of the term, the same in every topic: score / (tf / words)."""
    lengths = ctfidf.groupBy(*by, "topic").agg(F.sum("tf").alias("words"))
    rated = ctfidf.join(lengths, [*by, "topic"]).withColumn("idf", F.col("score") * F.col("words") / F.col("tf"))
    idf = rated.groupBy(*by, "term").agg(F.max("idf").alias("idf"))
    named = ctfidf.join(idf, [*by, "term"]).select(slice_of.alias("slice"), "topic", "term", "score", "idf")
    return materialize(named, "weights")


def _topic_blocks(model: DataFrame, block_bytes: int) -> list[list[tuple[str, int]]]:
    """(slice, topic) in runs of about ``block_bytes``; sizes are one row per topic."""
    size = F.sum(F.octet_length("term") + 32).alias("bytes")
    sizes = model.groupBy("slice", "topic").agg(size).orderBy("slice", "topic").collect()
    out, held = [], 0
    for r in sizes:
        if not out or held + r["bytes"] > block_bytes:
            out.append([])
            held = 0
        out[-1].append((r["slice"], r["topic"]))
        held += r["bytes"]
    return out


def _block_scores(rows: DataFrame, model: DataFrame, block: list[tuple[str, int]]) -> DataFrame:
    """The best topic of a block for each document: the product of sparse rows, one topic's column after another.

    Terms of the noise topic weigh into a document's length but are no choice. The norm of a document counts all its known
    terms, so every block carries the idf of its slices' whole vocabulary.
    """
    slices = sorted({s for s, _ in block})
    chosen = model.where(F.col("slice").isin(slices))
    wanted = set(block)
    vocabulary = chosen.select("slice", "term", "idf").distinct().toArrow()
    scores = chosen.select("slice", "topic", "term", "score").where(F.concat_ws("|", "slice", "topic").isin([f"{s}|{t}" for s, t in wanted]) & (F.col("topic") != NOISE)).toArrow()
    shared = rows.sparkSession.sparkContext.broadcast(_matrices(vocabulary, scores))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in _text_runs(batch):
                slices_of = np.asarray(part.column("slice").to_pylist(), dtype=object)
                for name, matrix in shared.value.items():
                    mine = part.filter(pa.array(slices_of == name))
                    if mine.num_rows:
                        yield matrix.best(mine.column("id"), mine.column("w"))

    return rows.mapInArrow(score, _FOUND)


def _text_runs(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in runs that begin within the same ``TEXT_BYTES`` of text; what a run needs in memory is many times its text."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column("w")), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    begins = np.flatnonzero(np.diff(np.append(0, ends[:-1]) // TEXT_BYTES, prepend=-1)) if len(ends) else []
    for first, last in zip(begins, [*begins[1:], batch.num_rows]):
        yield batch.slice(first, last - first)


def _matrices(vocabulary: pa.Table, scores: pa.Table) -> dict[str, TermMatrix]:
    out = {}
    for name in pc.unique(vocabulary.column("slice")).to_pylist():
        words = vocabulary.filter(pc.equal(vocabulary.column("slice"), name))
        cells = scores.filter(pc.equal(scores.column("slice"), name))
        terms = words.column("term").combine_chunks()
        place = pc.index_in(cells.column("term").combine_chunks(), terms).to_numpy(zero_copy_only=False).astype(np.int64)
        out[name] = TermMatrix(terms, words.column("idf").to_numpy(), place, cells.column("topic").to_numpy(), cells.column("score").to_numpy())
    return out


class TermMatrix:
    """Scores by term and topic of one slice, kept by term, and the idf of every term."""

    def __init__(self, terms: pa.Array, idf: np.ndarray, term: np.ndarray, topic: np.ndarray, score: np.ndarray):
        self.terms, self.idf = terms, idf
        self.topics, column = np.unique(topic, return_inverse=True)
        self.norms = np.sqrt(np.bincount(column, score * score, len(self.topics)))
        order = np.argsort(term, kind="stable")
        self.column, self.score = column[order], score[order]
        self.start = np.searchsorted(term[order], np.arange(len(terms) + 1))

    def best(self, ids: pa.Array, texts: pa.Array) -> pa.RecordBatch:
        """The topic of the largest product per text, ties to the lower topic, and the length of the text's vector."""
        doc, term = self._terms(texts)
        cell, counts = np.unique(doc * max(len(self.terms), 1) + term, return_counts=True)
        doc, term = cell // max(len(self.terms), 1), cell % max(len(self.terms), 1)
        weight = counts * self.idf[term]
        n, norm = len(ids), np.sqrt(np.bincount(doc, weight * weight, len(ids)))
        found, best, topic = np.zeros(n, bool), np.full(n, -np.inf), np.zeros(n, np.int64)
        ends, step = np.searchsorted(doc, np.arange(n + 1)), max(1, DENSE_CELLS // max(len(self.topics), 1))
        for first in range(0, n, step):  # a dense block of documents x topics of bounded size
            part = slice(ends[first], ends[min(first + step, n)])
            size = self.start[term[part] + 1] - self.start[term[part]]
            at = np.repeat(self.start[term[part]] - (np.cumsum(size) - size), size) + np.arange(size.sum())
            row = np.repeat(doc[part] - first, size)
            rows, width = min(step, n - first), max(len(self.topics), 1)
            place = row * width + self.column[at]
            dots = np.bincount(place, np.repeat(weight[part], size) * self.score[at], rows * width).reshape(rows, width)
            met = np.bincount(place, minlength=rows * width).reshape(rows, width) > 0
            value = np.where(met, np.round(dots / np.where(self.norms > 0, self.norms, 1) if len(self.norms) else dots, 10), -np.inf)
            choice = value.argmax(axis=1)
            here = slice(first, first + rows)
            best[here], found[here] = value[np.arange(rows), choice], met.any(axis=1)
            topic[here] = self.topics[choice] if len(self.topics) else 0
        keep = pa.array(found)
        columns = [ids.filter(keep), pa.array(topic[found].astype(np.int32)), pa.array(best[found]), pa.array(norm[found])]
        return pa.RecordBatch.from_arrays(columns, ["id", "topic", "s", "norm"])

    def _terms(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Document and number of each known word and known pair of neighbouring words."""
        lists = pc.split_pattern(pc.fill_null(texts, ""), " ")
        doc = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
        words = lists.flatten()
        near = doc[1:] == doc[:-1]
        both = pc.binary_join_element_wise(words[:-1], words[1:], " ").filter(pa.array(near)) if len(words) > 1 else words[:0]
        term = pc.index_in(pa.concat_arrays([words, both]), self.terms.cast(words.type))
        doc = np.concatenate([doc, doc[1:][near]])
        known = pc.is_valid(term).to_numpy(zero_copy_only=False)
        return doc[known].astype(np.int64), term.drop_null().to_numpy().astype(np.int64)


def embedding_scores(
    emb: DataFrame, topics: DataFrame, centroids: DataFrame, key: str = "doc_id", by: str | None = None, **options: int
) -> DataFrame:
    """Nearest real centroid of each noise document by cosine: ``key, best, score``."""
    noise = topics.where(F.col("topic") == NOISE).select(key)
    queries = emb.select(key, *([by] if by else []), "embedding").join(noise, key, "left_semi")
    real = centroids.where(F.col("topic") != NOISE)
    found = nearest(queries, real, 1, key, "topic", "embedding", "centroid", by=by, **options)
    return found.select(F.col("qid").alias(key), F.col("iid").cast("int").alias("best"), F.col("sim").alias("score"))


def reassign(topics: DataFrame, scores: DataFrame, threshold: float, key: str = "doc_id") -> DataFrame:
    """Noise documents whose best score is positive and reaches the threshold take that topic."""
    joined = topics.join(scores, key, "left")
    moved = (F.col("topic") == NOISE) & (F.col("score") >= threshold) & (F.col("score") > 0)
    others = [c for c in topics.columns if c not in (key, "topic")]
    return joined.select(key, *others, F.when(moved, F.col("best")).otherwise(F.col("topic")).alias("topic"))


def reduce_outliers_ctfidf(
    docs: DataFrame, topics: DataFrame, ctfidf: DataFrame, threshold: float = _DEFAULTS.ctfidf,
    text: str = "text_lemm", key: str = "doc_id", by: Sequence[str] = (),
) -> DataFrame:
    return reassign(topics, ctfidf_scores(docs, topics, ctfidf, text, key, by), threshold, key)


def reduce_outliers_embedding(
    emb: DataFrame, topics: DataFrame, centroids: DataFrame, threshold: float = _DEFAULTS.embedding,
    key: str = "doc_id", by: str | None = None, **options: int,
) -> DataFrame:
    return reassign(topics, embedding_scores(emb, topics, centroids, key, by, **options), threshold, key)


def assignment_steps(before: DataFrame, step1: DataFrame, step2: DataFrame, key: str = "doc_id", by: Sequence[str] = ()) -> DataFrame:
    """The three assignments side by side."""
    name = lambda df, n: df.select(key, F.col("topic").alias(n))
    return before.select(key, *by, F.col("topic").alias("t0")).join(name(step1, "t1"), key).join(name(step2, "t2"), key)


def reassignment_report(
    before: DataFrame, step1: DataFrame, step2: DataFrame, key: str = "doc_id", warn_share: float = 0.30, by: Sequence[str] = ()
) -> DataFrame:
    """Noise before and after, documents moved per step, and whether one topic took too many."""
    steps = assignment_steps(before, step1, step2, key, by)
    is_noise = lambda c: F.col(c) == NOISE
    moved = is_noise("t0") & ~is_noise("t2")
    # one row per receiving topic, then totals: the second aggregation sees topics, not documents
    cells = steps.groupBy(*by, F.when(moved, F.col("t2")).alias("to")).agg(
        F.count("*").alias("docs"), F.count_if(is_noise("t0")).alias("n0"), F.count_if(is_noise("t1")).alias("n1"),
        F.count_if(is_noise("t2")).alias("n2"),
    )
    received = F.col("to").isNotNull()
    ratio = lambda c: F.try_divide(F.sum(c), F.sum("docs"))
    top = F.try_divide(F.max(F.when(received, F.col("docs"))), F.sum(F.when(received, F.col("docs"))))
    return cells.groupBy(*by).agg(
        ratio("n0").alias("noise_before"),
        ratio("n1").alias("noise_step1"),
        ratio("n2").alias("noise_after"),
        (ratio("n2") - ratio("n0")).alias("delta_noise"),
        (F.sum("n0") - F.sum("n1")).alias("reassigned_step1"),
        (F.sum("n1") - F.sum("n2")).alias("reassigned_step2"),
        (F.sum("n0") - F.sum("n2")).alias("reassigned_total"),
        F.count_if(received).alias("receiving_topics"),
        F.coalesce(top, F.lit(0.0)).alias("top1_share"),
        F.coalesce(top > warn_share, F.lit(False)).alias("warning"),
    )


def receiving_topics(before: DataFrame, after: DataFrame, key: str = "doc_id", by: Sequence[str] = ()) -> DataFrame:
    """Documents each topic received from noise, with their share; most first."""
    steps = assignment_steps(before, before, after, key, by)
    moved = steps.where((F.col("t0") == NOISE) & (F.col("t2") != NOISE))
    counts = moved.groupBy(*by, F.col("t2").alias("topic")).agg(F.count("*").alias("docs"))
    share = F.col("docs") / F.sum("docs").over(Window.partitionBy(*(by or [F.lit(1)])))  # one row per topic
    return counts.withColumn("share", share).orderBy(*by, F.desc("docs"), "topic")


def threshold_ablation(
    topics: DataFrame, scores: DataFrame, thresholds: Sequence[float] = ABLATION_THRESHOLDS, key: str = "doc_id",
    by: Sequence[str] = (),
) -> DataFrame:
    """Noise, classified and reassigned counts for every threshold, from one pass over the scores.

    Each document is counted under the number of thresholds its score reaches; the results are
    running sums over that table of at most ``len(thresholds) + 1`` rows.
    """
    limits = sorted(thresholds)
    joined = topics.join(scores.select(key, "score"), key, "left")
    is_noise = F.col("topic") == NOISE
    reached = sum((F.when((F.col("score") >= t) & (F.col("score") > 0), 1).otherwise(0) for t in limits), F.lit(0))
    counts = joined.groupBy(*by, F.when(is_noise, reached).alias("reached")).agg(F.count("*").alias("n"))
    table = F.array(*[F.struct(F.lit(float(t)).alias("threshold"), F.lit(i + 1).alias("need")) for i, t in enumerate(limits)])
    spread = counts.select(*by, "reached", "n", F.explode(table).alias("t"))
    stays = F.sum(F.when(F.col("reached") < F.col("t.need"), F.col("n")).otherwise(0))
    moves = F.sum(F.when(F.col("reached") >= F.col("t.need"), F.col("n")).otherwise(0))
    out = spread.groupBy(*by, F.col("t.threshold").alias("threshold")).agg(
        (stays / F.sum("n")).alias("noise_ratio"), moves.alias("reassigned")
    )
    return out.withColumn("classified_ratio", 1 - F.col("noise_ratio")).orderBy(*by, "threshold")


METRICS = ("num_topics", "noise_ratio", "classified_ratio", "cv_coherence", "topic_diversity", "dbcv_score")


def metrics_before_after(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two metric rows and their difference (after - before)."""
    columns = [c for c in METRICS if c in before.columns and c in after.columns]
    pick = lambda df, stage: df.select(F.lit(stage).alias("stage"), *[F.col(c).cast("double").alias(c) for c in columns])
    both = pick(before, "before").unionByName(pick(after, "after"))
    value = lambda c, stage: F.max(F.when(F.col("stage") == stage, F.col(c)))
    delta = both.agg(*[(value(c, "after") - value(c, "before")).alias(c) for c in columns])
    return both.unionByName(delta.withColumn("stage", F.lit("delta")))


def reassigned_examples(
    before: DataFrame, after: DataFrame, words: DataFrame, docs: DataFrame, n: int = 10, key: str = "doc_id",
    text: str = "text_clean", seed: int = RANDOM_SEED,
) -> DataFrame:
    """A few moved documents with the first words of both topics and a preview."""
    steps = assignment_steps(before, before, after, key)
    moved = steps.where((F.col("t0") == NOISE) & (F.col("t2") != NOISE))
    drawn = moved.orderBy(hash_key(key, seed), key).limit(n)
    named = topic_words_row(words, 5)
    side = lambda t, out: named.select(F.col("topic").alias(t), F.array_join("words", ", ").alias(out))
    label = lambda t, w: F.when(F.col(t) == NOISE, F.lit("Noise")).otherwise(F.col(w))
    preview = F.regexp_replace(F.substring(text, 1, 150), "\n", " ")
    joined = docs.select(key, preview.alias("preview")).join(F.broadcast(drawn), key)  # n rows
    joined = joined.join(side("t0", "w0"), "t0", "left").join(side("t2", "w2"), "t2", "left")
    return joined.select(
        key, F.col("t0").alias("old_topic"), label("t0", "w0").alias("old_words"),
        F.col("t2").alias("new_topic"), label("t2", "w2").alias("new_words"), "preview",
    )
