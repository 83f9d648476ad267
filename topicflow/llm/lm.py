"""Language-model scores from a log-frequency Bloom filter.

An n-gram of count c has the level 1 + floor(log2 c) and is entered once for each level up to its
own; asking for level 1, 2, ... until the filter denies one gives its quantised count. N-grams are
counted per key bucket, and the task that merges a bucket builds the bucket's own segment of the
filter, so no task or driver holds counts of more than one bucket. The filter grows with the n-grams, at the same bits
an entry at every size, and so does the number of buckets.

Texts are cut into words once and kept as chunks of word codes. A filter of at most ``FILTER_BYTES`` is broadcast and probed where the
chunks are. A larger one stays where it is: each chunk sends its different keys to their buckets, whose tasks probe the segment and send levels back. Both ways
probe the same segments, so scores do not depend on the choice, and the work grows with the tokens, not with tokens times blocks. The exact unigram counts
behind the base score are always asked for in this way. Words are known by a 64-bit hash, pairs by a 48-bit one, whose
collisions are rarer than the filter's false hits.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import filled, fold, hash_words, mix, prepare, split_words

UNSEEN_FOLD = 1
END = "\n"  # no word holds white space
BITS_PER_ENTRY = 10
PROBES = 4
FILTER_BYTES = 10 << 20  # of a filter that is broadcast; Spark's own bound for the table of a broadcast join
BLOCK_BYTES = 8 << 20  # of keys that a bucket gets, if all of them differ
CHUNK_BYTES = 4 << 20  # of text in a chunk; a longer text is a chunk of its own
FETCH_BYTES = 8 << 20  # that the driver fetches of the model at a time
BATCH_ROWS = 1000
BATCH_CHUNKS = 4
HELD = 2_000_000  # n-grams that a task gathers before it passes them on
TOP_LEVEL = 48
PULL = 20.0  # weight of the unigram model within a pair's probability, in occurrences of the first word
CHUNKS = "chunk long, n_tokens long, doc_ids array<bigint>, learnt binary, offsets binary, codes binary, hashes binary"
COUNTS = "bucket int, kind int, keys binary, counts binary"
MODEL = "bucket int, keys binary, counts binary, tokens long, bits binary, n_bits long"
ASKED = "bucket int, chunk long, words binary, pairs binary"
TOLD = "bucket int, chunk long, counts binary, words binary, pairs binary"
TEXT_SCORES = "doc_id long, n_tokens long, n_known long, base double, score double"


def columns(schema: str, *values) -> pa.RecordBatch:
    """A batch whose columns, in order, have the names and types of ``schema``."""
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "array<bigint>": pa.list_(pa.int64())}
    named = [c.split() for c in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(v, kinds[kind]) for v, (_, kind) in zip(values, named)], [name for name, _ in named])


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes of all tokens one after another with an end after each text, row offsets, and the hash of each code."""
    offsets, words = split_words(texts)
    hashes = np.append(hash_words(words.dictionary), hash_words(pa.array([END])))
    n = len(texts)
    ends = offsets[1:] - offsets[0] + np.arange(n)
    codes = np.full(len(words) + n, len(hashes) - 1, np.int64)
    plain = np.ones(len(codes), bool)
    plain[ends] = False
    codes[plain] = words.indices.to_numpy()
    return codes, np.concatenate([[0], ends + 1]), hashes


def pair_keys(hashes: np.ndarray, codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Key of each token with the one before it; a text begins after an end."""
    before = np.empty_like(codes)
    before[1:] = codes[:-1]
    before[offsets[:-1]] = len(hashes) - 1
    with np.errstate(over="ignore"):
        return mix(hashes[before] * np.uint64(0x9E3779B97F4A7C15) + hashes[codes]) & ~np.uint64(0xFFFF)


def packed(keys: np.ndarray) -> bytes:
    """Keys of pairs without their two low bytes, which are 0."""
    return keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, 2:].tobytes()


def unpacked(value: bytes) -> np.ndarray:
    short = np.frombuffer(value, np.uint8).reshape(-1, 6)
    out = np.zeros((len(short), 8), np.uint8)
    out[:, 2:] = short
    return out.view("<u8").ravel()


def counted(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys and the sums of their counts."""
    if not parts:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    keys, place = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return keys, np.bincount(place, np.concatenate([p[1] for p in parts]), len(keys)).astype(np.int64)


def bucket_of(keys: np.ndarray, bits: int) -> np.ndarray:
    return (keys >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)


def cut(docs: DataFrame) -> DataFrame:
    """The texts of ``docs`` (doc_id, text, learnt) as chunks of word codes, one row per chunk."""

    def chunk(number: int, held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
        codes, offsets, hashes = tokens(filled(rows))
        kind = np.uint16 if len(hashes) < 1 << 16 else np.uint32
        learnt = rows.column("learnt").to_numpy(zero_copy_only=False).astype(np.uint8)
        values = (number, len(codes), rows.column("doc_id"), learnt.tobytes(), offsets.astype(np.int64).tobytes(), codes.astype(kind).tobytes(), hashes.tobytes())
        return columns(CHUNKS, *[[v] for v in values])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, held, size = TaskContext.get().partitionId() << 33, [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            ends = np.cumsum(pc.binary_length(filled(batch)).to_numpy().astype(np.int64))
            starts = np.flatnonzero(np.diff(ends // CHUNK_BYTES, prepend=-1))
            for i, j in zip(starts, [*starts[1:], batch.num_rows]):
                held.append(batch.slice(i, j - i))
                size += int(ends[j - 1] - (ends[i - 1] if i else 0))
                if size >= CHUNK_BYTES:
                    yield chunk(number, held)
                    number, held, size = number + 1, [], 0
        if held:
            yield chunk(number, held)
        pa.default_memory_pool().release_unused()

    return materialize(docs.mapInArrow(work, CHUNKS), "chunks")


def read_chunks(table: pa.RecordBatch | pa.Table) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Codes, row offsets, hashes and the learnt flag of each row, for each chunk."""
    for row in table.select(["learnt", "offsets", "codes", "hashes"]).to_pylist():
        hashes = np.frombuffer(row["hashes"], np.uint64)
        codes = np.frombuffer(row["codes"], np.uint16 if len(hashes) < 1 << 16 else np.uint32).astype(np.int64)
        yield codes, np.frombuffer(row["offsets"], np.int64), hashes, np.frombuffer(row["learnt"], np.uint8).astype(bool)


def by_bucket(keys: np.ndarray, bucket_bits: int) -> np.ndarray:
    """Where each bucket begins in sorted keys, and their end."""
    return np.searchsorted(bucket_of(keys, bucket_bits), np.arange((1 << bucket_bits) + 1))


def gather(chunks: DataFrame, bucket_bits: int) -> DataFrame:
    """Counts of words and pairs of the learnt texts, one row per task, bucket and kind."""

    def rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> list[tuple]:
        at = by_bucket(keys, bucket_bits)
        written = packed if kind else np.ndarray.tobytes
        return [(b, kind, written(keys[i:j]), counts[i:j].astype(np.uint32).tobytes()) for b, (i, j) in enumerate(zip(at[:-1], at[1:])) if j > i]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, pairs, held = [], [], 0

        def passed_on() -> pa.RecordBatch:
            made = rows(0, *counted(words)) + rows(1, *counted(pairs))
            return columns(COUNTS, *zip(*made))

        for batch in batches:
            for codes, offsets, hashes, learnt in read_chunks(batch):
                mine = np.repeat(learnt, np.diff(offsets))
                if not mine.any():
                    continue
                found = np.bincount(codes[mine], minlength=len(hashes))
                words.append((hashes[found > 0], found[found > 0]))
                pairs.append(np.unique(pair_keys(hashes, codes, offsets)[mine], return_counts=True))
                held += len(pairs[-1][0])
                if held >= HELD:
                    yield passed_on()
                    words, pairs, held = [], [], 0
        if held:
            yield passed_on()
        pa.default_memory_pool().release_unused()

    return prepare(chunks, BATCH_CHUNKS).mapInArrow(count, COUNTS)


def spots(keys: np.ndarray, level: int, probe: int, n_bits: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        hashed = mix(keys + np.uint64((level * 0x9E3779B97F4A7C15) % 2**64))
        return ((hashed + np.uint64(probe) * (mix(hashed) | np.uint64(1))) % n_bits.astype(np.uint64)).astype(np.int64)


def word_keys(hashes: np.ndarray) -> np.ndarray:
    """Keys of single words in the filter, in the bucket of the word."""
    return hashes


def levels(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts, 1))).astype(np.int64) + 1


def build(counts: DataFrame, bucket_bits: int) -> DataFrame:
    """Per bucket the merged word counts and the segment of the filter that holds its words and pairs."""
    def merge(table: pa.Table) -> pa.Table:
        parts: list[list] = [[], []]
        for kind, keys, found in zip(table.column("kind").to_pylist(), table.column("keys").to_pylist(), table.column("counts").to_pylist()):
            parts[kind].append((unpacked(keys) if kind else np.frombuffer(keys, np.uint64), np.frombuffer(found, np.uint32)))
        words, word_counts = counted(parts[0])
        pairs, pair_counts = counted(parts[1])
        keys, level = np.concatenate([word_keys(words), pairs]), np.concatenate([levels(word_counts), levels(pair_counts)])
        n_bits = int(max(BITS_PER_ENTRY * level.sum(), 64)) // 8 * 8
        bits, size = np.zeros(n_bits, bool), np.array([n_bits])
        for step in range(1, int(level.max(initial=0)) + 1):
            mine = keys[level >= step]
            for probe in range(PROBES):
                bits[spots(mine, step, probe, size)] = True
        row = (table.column("bucket")[0].as_py(), words.tobytes(), word_counts.tobytes(), int(word_counts.sum()), np.packbits(bits).tobytes(), n_bits)
        return pa.Table.from_batches([columns(MODEL, *[[v] for v in row])])

    return materialize(counts.groupBy("bucket").applyInArrow(merge, MODEL), "model")


class Filter:
    """The segments of some buckets, one after another; the others hold nothing."""

    def __init__(self, bits: np.ndarray, starts: np.ndarray, sizes: np.ndarray, bucket_bits: int):
        self.bits, self.starts, self.sizes, self.bucket_bits = bits, starts, sizes, bucket_bits

    def holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        bucket = bucket_of(keys, self.bucket_bits)
        size, yes = self.sizes[bucket], np.flatnonzero(self.sizes[bucket] > 0)
        for probe in range(PROBES):
            spot = self.starts[bucket[yes]] + spots(keys[yes], level, probe, size[yes])
            yes = yes[(self.bits[spot >> 3] >> (7 - (spot & 7)).astype(np.uint8)) & 1 == 1]
        out = np.zeros(len(keys), bool)
        out[yes] = True
        return out

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The highest level of each key up to which none is denied; 0 where level 1 is."""
        level, left = np.zeros(len(keys), np.int64), np.arange(len(keys))
        for step in range(1, TOP_LEVEL + 1):
            left = left[self.holds(keys[left], step)]
            if not len(left):
                break
            level[left] = step
        return level


def middle(level: np.ndarray) -> np.ndarray:
    """The middle of the counts of a level; 0 for level 0."""
    return np.where(level > 0, (3.0 * 2.0 ** (level.astype(float) - 1) - 1) / 2, 0.0)


def log_terms(alone: np.ndarray, both: np.ndarray, offsets: np.ndarray, total: float) -> np.ndarray:
    """The log probability of each token from the levels of the tokens and of the pairs they end; each text ends with an end."""
    alone, both = middle(alone), middle(both)
    of_first = np.append(0.0, alone[:-1])
    of_first[offsets[:-1]] = alone[offsets[1:] - 1]
    p = (np.minimum(both, of_first) + PULL * (alone + 0.5) / total) / (of_first + PULL)
    return np.log10(np.minimum(p, 1.0))


def answers(chunks: DataFrame, model: DataFrame, bucket_bits: int, pairs: bool) -> DataFrame:
    """Counts and levels of each chunk's words, and levels of its pairs if asked for, one row per chunk and bucket, in key order."""

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, (codes, offsets, hashes, _) in zip(batch.column(batch.schema.get_field_index("chunk")).to_pylist(), read_chunks(batch)):
                words = np.unique(hashes)
                both = np.unique(pair_keys(hashes, codes, offsets)) if pairs else np.zeros(0, np.uint64)
                of_word, of_pair = by_bucket(words, bucket_bits), by_bucket(both, bucket_bits)
                used = np.flatnonzero((np.diff(of_word) > 0) | (np.diff(of_pair) > 0))
                yield columns(ASKED, used, [number] * len(used), [words[of_word[b] : of_word[b + 1]].tobytes() for b in used], [packed(both[of_pair[b] : of_pair[b + 1]]) for b in used])
        pa.default_memory_pool().release_unused()

    def tell(asked: pa.Table, segment: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in asked.column("words").to_pylist()]
        both = [unpacked(p) for p in asked.column("pairs").to_pylist()]
        if not words:
            return pa.Table.from_batches([columns(TOLD, [], [], [], [], [])])
        keys, pair = np.concatenate(words), np.concatenate(both)
        counts, levels_ = np.zeros(len(keys), np.int64), np.zeros(len(keys) + len(pair), np.uint8)
        if segment.num_rows:
            row = segment.to_pylist()[0]
            known, found = np.frombuffer(row["keys"], np.uint64), np.frombuffer(row["counts"], np.int64)
            place = np.minimum(np.searchsorted(known, keys), max(len(known) - 1, 0))
            counts = np.where(known[place] == keys, found[place], 0) if len(known) else counts
            own = Filter(np.frombuffer(row["bits"], np.uint8), np.zeros(1, np.int64), np.array([row["n_bits"]]), 0)
            levels_ = own.levels(np.concatenate([word_keys(keys), pair])).astype(np.uint8)
        of_word, of_pair = np.cumsum([0] + [len(w) for w in words]), np.cumsum([0] + [len(p) for p in both])
        cuts = lambda x, ends: [x[i:j].tobytes() for i, j in zip(ends[:-1], ends[1:])]
        told = columns(TOLD, asked.column("bucket").to_pylist(), asked.column("chunk").to_pylist(), cuts(counts, of_word), cuts(levels_[: len(keys)], of_word), cuts(levels_[len(keys) :], of_pair))
        return pa.Table.from_batches([told])

    asked = prepare(chunks, BATCH_CHUNKS).mapInArrow(ask, ASKED)
    return materialize(asked.groupBy("bucket").cogroup(model.groupBy("bucket")).applyInArrow(tell, TOLD), "answers")


def score(docs: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score per row of ``docs``.

    Learns from rows outside the fold ``UNSEEN_FOLD`` of doc_id (a null id counts as the empty text). A null or empty
    text is the end token alone. Repeated rows are learnt as often as they occur and score alike; an empty table gives no rows, and with
    nothing to learn from all counts are 0. A bucket gets about ``block_bytes`` of keys at most.
    """
    spark = docs.sparkSession
    texts = prepare(docs, BATCH_ROWS).select("doc_id", F.coalesce("text", F.lit("")).alias("text"), (fold() != UNSEEN_FOLD).alias("learnt"))
    chunks = cut(texts)
    all_tokens = chunks.agg(F.coalesce(F.sum("n_tokens"), F.lit(0))).first()[0]
    bucket_bits = max(2, math.ceil(math.log2(max(1, 8 * all_tokens / block_bytes))))
    model = build(gather(chunks, bucket_bits), bucket_bits)
    n, v, n_bits = model.agg(*[F.coalesce(F.sum(c), F.lit(0)) for c in ("tokens", F.octet_length("keys") / 8, "n_bits")]).first()
    total = max(n + 0.5 * (v + 1), 0.5)
    shared = None
    if n_bits <= 8 * FILTER_BYTES:
        shared = spark.sparkContext.broadcast(_filter(model, model.select("bucket", "n_bits").collect(), bucket_bits))
    told = answers(chunks, model, bucket_bits, pairs=shared is None)

    def work(chunk: pa.Table, found: pa.Table) -> pa.Table:
        found = found.sort_by("bucket")  # buckets are runs of the keys' order, so all answers stand in it
        column = lambda name, kind: np.frombuffer(b"".join(found.column(name).to_pylist()), kind)
        codes, offsets, hashes, _ = next(read_chunks(chunk))
        at = np.unique(hashes, return_inverse=True)[1]
        c, keys = column("counts", np.int64)[at], pair_keys(hashes, codes, offsets)
        if shared:
            alone, both = shared.value.levels(word_keys(hashes)), shared.value.levels(keys)
        else:
            alone, both = column("words", np.uint8)[at], column("pairs", np.uint8)[np.unique(keys, return_inverse=True)[1]]
        n_rows = len(offsets) - 1
        row = np.repeat(np.arange(n_rows), np.diff(offsets))
        sums = lambda x: np.bincount(row, x, n_rows)
        base, known = np.log10((c + 0.5) / total), sums((c > 0)[codes]).astype(np.int64)
        terms = log_terms(alone[codes], both, offsets, total)
        ids = chunk.column("doc_ids").combine_chunks().flatten()
        return pa.Table.from_batches([columns(TEXT_SCORES, ids, np.diff(offsets), known, sums(base[codes]), sums(terms))])

    scored = chunks.groupBy("chunk").cogroup(told.groupBy("chunk")).applyInArrow(work, TEXT_SCORES)
    return scored.select("doc_id", (fold() == UNSEEN_FOLD).alias("held_out"), "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")


def _read(model: DataFrame, buckets: list[int], column: str, kind: type, total: int) -> np.ndarray:
    """One column of some buckets in bucket order, fetched a few megabytes at a time into one array."""
    out, at = np.zeros(total, kind), 0
    step = max(1, len(buckets) * FETCH_BYTES // max(total * np.dtype(kind).itemsize, 1))
    for k in range(0, len(buckets), step):
        some = model.where(F.col("bucket").isin(buckets[k : k + step])).select("bucket", column).toArrow().sort_by("bucket")
        for value in some.column(column):
            piece = np.frombuffer(value.as_buffer(), kind)
            out[at : at + len(piece)] = piece
            at += len(piece)
    return out


def _filter(model: DataFrame, rows: list, bucket_bits: int) -> Filter:
    """The filter of the buckets in ``rows``, for the broadcast."""
    starts, sizes = np.zeros(1 << bucket_bits, np.int64), np.zeros(1 << bucket_bits, np.int64)
    for r in rows:
        sizes[r["bucket"]] = r["n_bits"]
    starts[1:] = np.cumsum(sizes)[:-1]
    bits = _read(model, sorted(r["bucket"] for r in rows), "bits", np.uint8, int(sizes.sum()) // 8 + 1)
    return Filter(bits, starts, sizes, bucket_bits)
