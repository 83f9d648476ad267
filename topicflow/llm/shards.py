"""Token ids in binary shards with a minimal perfect hash index.

A shard ``ids-<number>.bin`` is nothing but the ids of its documents, unsigned 16-bit little-endian,
in ascending order of doc_id over all shards. An index bucket ``index-<number>.npz`` holds a minimal
perfect hash of its keys: per level a bit array in which the keys that hash alone have their bit set;
keys that collide go on to the next level. The rank of the bit is the slot, and the slot holds a
fingerprint of the key, the shard, and where in it the document's ids start and how many they are. So a
lookup reads one bucket and one range of one shard. Files are written under a name of the attempt and
then renamed, so a repeated task replaces a file by an equal one.
"""

from __future__ import annotations

import io
import math
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize, scratch_path
from .bpe import TOKENIZER
from .common import filled, mix, prepare
from .tokens import BATCH_ROWS, encode_with_end

END_ID = 2
WIDTH = 2  # bytes of an id
KEYS_PER_BUCKET = 50_000
SPARE = 2.0  # bits of a level per key that reaches it
FIELDS = ("shard", "start", "n_tokens")


def key_hash(doc_id: np.ndarray, copy: np.ndarray, seed: int) -> np.ndarray:
    return mix(mix(doc_id.astype(np.int64).view(np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64)) ^ copy.astype(np.uint64))


class PerfectIndex:
    """A minimal perfect hash of (doc_id, copy) keys and the values in their slots."""

    def __init__(self, levels: list[np.ndarray], fingerprints: np.ndarray, values: dict[str, np.ndarray]):
        self.levels, self.fingerprints, self.values = levels, fingerprints, values
        self.ranks = [np.cumsum(level) for level in levels]
        self.before = np.concatenate([[0], np.cumsum([int(r[-1]) for r in self.ranks])]).astype(np.int64)

    @classmethod
    def build(cls, doc_id: np.ndarray, copy: np.ndarray, values: dict[str, np.ndarray]) -> PerfectIndex:
        levels, left = [], np.arange(len(doc_id))
        while len(left):
            if len(levels) >= 200:
                raise ValueError("keys are not distinct")
            size = max(int(SPARE * len(left)), 2)
            spot = (key_hash(doc_id[left], copy[left], len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(spot, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[spot]]
        index = cls(levels, np.zeros(len(doc_id), np.uint32), {})
        slot = index.slots(doc_id, copy)
        index.fingerprints[slot] = cls.fingerprint(doc_id, copy)
        for name, column in values.items():
            index.values[name] = np.empty_like(column)
            index.values[name][slot] = column
        return index

    @staticmethod
    def fingerprint(doc_id: np.ndarray, copy: np.ndarray) -> np.ndarray:
        return key_hash(doc_id, copy, 1 << 20).astype(np.uint32)

    def slots(self, doc_id: np.ndarray, copy: np.ndarray) -> np.ndarray:
        out, open_ = np.full(len(doc_id), -1, np.int64), np.arange(len(doc_id))
        for k, level in enumerate(self.levels):
            spot = (key_hash(doc_id[open_], copy[open_], k) % np.uint64(len(level))).astype(np.int64)
            here = level[spot]
            out[open_[here]] = self.before[k] + self.ranks[k][spot[here]] - 1
            open_ = open_[~here]
        return out

    def find(self, doc_id: np.ndarray, copy: np.ndarray) -> tuple[np.ndarray, dict[str, np.ndarray]]:
        """Which keys are held, by their fingerprints, and the values of those."""
        slot = self.slots(doc_id, copy)
        known = slot >= 0
        known[known] = self.fingerprints[slot[known]] == self.fingerprint(doc_id[known], copy[known])
        return known, {name: column[slot[known]] for name, column in self.values.items()}

    def dump(self) -> bytes:
        out, levels = io.BytesIO(), {f"level{k}": np.packbits(level) for k, level in enumerate(self.levels)}
        sizes = np.array([len(level) for level in self.levels], np.int64)
        np.savez(out, sizes=sizes, fingerprints=self.fingerprints, **levels, **{f"value_{n}": c for n, c in self.values.items()})
        return out.getvalue()

    @classmethod
    def load(cls, data: bytes) -> PerfectIndex:
        held = np.load(io.BytesIO(data))
        levels = [np.unpackbits(held[f"level{k}"], count=int(n)).astype(bool) for k, n in enumerate(held["sizes"])]
        return cls(levels, held["fingerprints"], {n.removeprefix("value_"): held[n] for n in held.files if n.startswith("value_")})


def store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def shard_name(folder: str, shard: int) -> str:
    return f"{folder}/ids-{shard:06d}.bin"


def index_name(folder: str, bucket: int) -> str:
    return f"{folder}/index-{bucket:06d}.npz"


def write_shards(docs: DataFrame, folder: str, path: str, end_id: int) -> DataFrame:
    """Writes the shards, one per key range; returns doc_id, copy (0, 1, ... of equal ids), shard, start in it, n_tokens."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = store(folder)
        shard, at, last, copy = TaskContext.get().partitionId(), 0, object(), 0
        part = f"{root}/part-{uuid.uuid4().hex}"
        with system.open_output_stream(part) as out:
            for batch in batches:
                ids = encode_with_end(filled(batch), path, end_id)
                copies, starts = [], []
                for doc_id, mine in zip(batch.column(0).to_pylist(), ids):
                    last, copy = doc_id, copy + 1 if doc_id == last else 0
                    copies.append(copy)
                    starts.append(at)
                    at += len(mine)
                    out.write(mine.tobytes())
                sizes = pa.array([len(x) for x in ids], pa.int64())
                columns = [batch.column(0), pa.array(copies, pa.int64()), pa.array([shard] * len(ids), pa.int64()), pa.array(starts, pa.int64()), sizes]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "copy", *FIELDS])
        system.move(part, shard_name(root, shard))

    ordered = prepare(docs, BATCH_ROWS).select("doc_id", "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    entries = ordered.mapInArrow(write, "doc_id long, copy long, shard long, start long, n_tokens long")
    return materialize(entries, "entries")


def bucket_of(buckets: int):
    return F.pmod(F.xxhash64("doc_id", "copy"), F.lit(buckets))


def _keys(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """A null doc_id has a key of its own: the lowest number, with copies below zero."""
    doc_id, copy = table.column("doc_id"), table.column("copy").to_numpy()
    missing = doc_id.is_null().to_numpy()
    return doc_id.fill_null(-(2**63)).to_numpy(), np.where(missing, -1 - copy, copy)


def write_index(entries: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Writes one index file per bucket of keys; returns bucket, n_keys."""

    def write(table: pa.Table) -> pa.Table:
        system, root = store(folder)
        bucket, part = table.column("bucket")[0].as_py(), f"{root}/part-{uuid.uuid4().hex}"
        data = PerfectIndex.build(*_keys(table), {n: table.column(n).to_numpy() for n in FIELDS}).dump()
        with system.open_output_stream(part) as out:
            out.write(data)
        system.move(part, index_name(root, bucket))
        return pa.table({"bucket": [bucket], "n_keys": [table.num_rows]})

    return materialize(entries.withColumn("bucket", bucket_of(buckets)).groupBy("bucket").applyInArrow(write, "bucket long, n_keys long"), "index")


def look_up(keys: DataFrame, folder: str, buckets: int) -> DataFrame:
    """Keys (doc_id, copy) with shard, start and n_tokens from the index; unknown keys are left out."""

    def read(table: pa.Table) -> pa.Table:
        system, root = store(folder)
        with system.open_input_stream(index_name(root, table.column("bucket")[0].as_py())) as file:
            index = PerfectIndex.load(file.read())
        known, values = index.find(*_keys(table))
        found = table.filter(pa.array(known))
        return pa.table({"doc_id": found.column("doc_id"), "copy": found.column("copy"), **values})

    return keys.withColumn("bucket", bucket_of(buckets)).groupBy("bucket").applyInArrow(read, "doc_id long, copy long, shard long, start long, n_tokens long")


def read_ids(places: DataFrame, folder: str) -> DataFrame:
    """The ids (32-bit little-endian) of each place, read from the shards by range."""

    def read(table: pa.Table) -> pa.Table:
        system, root = store(folder)
        table = table.sort_by("start")
        ids = []
        with system.open_input_file(shard_name(root, table.column("shard")[0].as_py())) as file:
            for start, n in zip(table.column("start").to_pylist(), table.column("n_tokens").to_pylist()):
                data = np.frombuffer(file.read_at(n * WIDTH, start * WIDTH), np.uint16).astype("<u4").tobytes()
                ids.append(zlib.crc32(data))
        return table.append_column("ids_crc32", pa.array(ids, pa.int64()))

    return places.groupBy("shard").applyInArrow(read, "doc_id long, copy long, shard long, start long, n_tokens long, ids_crc32 long")


def round_trip(docs: DataFrame, folder: str | None = None, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Writes shards and index, looks every document up in them and reads its ids back.

    Returns doc_id, start (ids of all documents before it), n_tokens, ids_crc32. A null or empty text is the end id
    alone; a null doc_id comes first; repeated rows follow each other in the order of a hash of the text. An empty table gives no rows.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    folder = folder or scratch_path(docs.sparkSession, "ids")
    system, root = store(folder)
    system.create_dir(root, recursive=True)
    entries = write_shards(docs, folder, path, end_id)
    buckets = max(1, math.ceil(entries.count() / KEYS_PER_BUCKET))
    write_index(entries, folder, buckets)
    sizes = entries.groupBy("shard").agg(F.sum("n_tokens").alias("n"))  # one row per shard
    bases = sizes.select("shard", F.coalesce(F.sum("n").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    copies = docs.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    keys = copies.select("doc_id", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)).alias("copy"))
    found = read_ids(look_up(keys, folder, buckets), folder).join(bases, "shard")
    return found.select("doc_id", (F.col("base") + F.col("start")).alias("start"), "n_tokens", "ids_crc32")
