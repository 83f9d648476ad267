"""Packing token ids into sequences of bounded length: first-fit decreasing per randomised group.

Documents are encoded, dealt to groups by a hash, and packed group by group. A document's whole
sequences stand alone; the rest of it is an item. Items in falling length go to the first open bin
with room, found by descending a tournament tree over the room left in the bins. Gaps that remain
are closed by cutting pieces of the emptiest bins, and the group's last bin is cut at powers of two,
which need no padding.
"""

from __future__ import annotations

import math
import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .bpe import TOKENIZER
from .common import filled, per_batch
from .tokens import BATCH_ROWS, encode_with_end

LENGTH = 4096
END_ID = 2
DOCS_PER_GROUP = 1024
LEAST_GAP = 16  # smaller gaps of a full-sized sequence stay as padding
PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class Bins:
    """The room left in up to ``n`` bins, as a tournament tree: a node holds the larger room below it."""

    def __init__(self, n: int, room: int):
        self.size = 1 << max(n - 1, 0).bit_length()
        self.tree = [room] * (2 * self.size)

    def first(self, need: int) -> int:
        """The leftmost bin with that room, which shrinks by it."""
        tree, at = self.tree, 1
        while at < self.size:
            at *= 2
            if tree[at] < need:
                at += 1
        found = at - self.size
        tree[at] -= need
        at >>= 1
        while at:
            tree[at] = max(tree[2 * at], tree[2 * at + 1])
            at >>= 1
        return found


def first_fit_decreasing(sizes: list[int], length: int) -> list[list[int]]:
    """Items of each bin. Every size is between 1 and ``length``; ties go by place in the list."""
    bins, out = Bins(len(sizes), length), []
    for item in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        at = bins.first(sizes[item])
        if at == len(out):
            out.append([])
        out[at].append(item)
    return out


def close_gaps(bins: list[list[tuple]], length: int, least: int) -> list[list[tuple]]:
    """Bins of pieces (document, start, size): the emptiest fill the gaps of the fullest, cut where needed."""
    filled_by = [sum(p[2] for p in b) for b in bins]
    order = sorted(range(len(bins)), key=lambda k: -filled_by[k])
    bins, room = [list(bins[k]) for k in order], [length - filled_by[k] for k in order]
    first, last = 0, len(bins) - 1
    while first < last:
        if room[first] < max(least, 1):
            first += 1
            continue
        doc, start, size = bins[last].pop()
        moved = min(size, room[first])
        bins[first].append((doc, start + size - moved, moved))
        room[first] -= moved
        room[last] += moved
        if moved < size:
            bins[last].append((doc, start, size - moved))
        if not bins[last]:
            last -= 1
    return [b for b in bins if b]


def powers_of_two(pieces: list[tuple], length: int, least: int) -> list[list[tuple]]:
    """One bin as sequences of the powers of two in its size; a bin that is nearly full stays whole."""
    total = sum(p[2] for p in pieces)
    if length - total < least:
        return [pieces]
    out, rest = [], list(pieces)
    for bit in range(total.bit_length() - 1, -1, -1):
        want = total & (1 << bit)
        if not want:
            continue
        out.append([])
        while want:
            doc, start, size = rest.pop(0)
            taken = min(size, want)
            out[-1].append((doc, start, taken))
            want -= taken
            if taken < size:
                rest.insert(0, (doc, start + taken, size - taken))
    return out


def pack_group(sizes: list[int], length: int = LENGTH, least: int = LEAST_GAP) -> list[list[tuple]]:
    """Sequences of pieces (document, start, size) that hold each document of ``sizes`` ids exactly once."""
    whole = [[(doc, k * length, length)] for doc, size in enumerate(sizes) for k in range(size // length)]
    rests = [(doc, size - size % length, size % length) for doc, size in enumerate(sizes) if size % length]
    bins = close_gaps([[rests[k] for k in b] for b in first_fit_decreasing([r[2] for r in rests], length)], length, least)
    return whole + bins[:-1] + (powers_of_two(bins[-1], length, least) if bins else [])


def pack(docs: DataFrame, path: str | None = None, length: int = LENGTH, end_id: int = END_ID, docs_per_group: int = DOCS_PER_GROUP, with_ids: bool = True) -> DataFrame:
    """One row per piece, with its ids (unsigned 16-bit, little-endian) if asked for.

    A null or empty text is the end id alone. Repeated rows are packed as often as they occur; rows of null doc_id
    are dealt out by their place. An empty table gives no rows. A group is a bounded number of documents on average.
    """
    path = path or public_tokenizers.path(TOKENIZER)
    groups = max(1, math.ceil(docs.count() / docs_per_group))

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = [x.tobytes() for x in encode_with_end(filled(batch), path, end_id)]
        return pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(ids, pa.binary())], ["doc_id", "group", "ids"])

    def packed(table: pa.Table) -> pa.Table:
        table = table.sort_by([("doc_id", "ascending")])
        ids = [np.frombuffer(x, np.uint16) for x in table.column("ids").to_pylist()]
        doc_ids, first = table.column("doc_id").to_pylist(), table.column("group")[0].as_py() << 32
        rows = []
        for number, sequence in enumerate(pack_group([len(x) for x in ids], length)):
            offset = 0
            for doc, start, size in sequence:
                piece = ids[doc][start : start + size]
                row = (doc_ids[doc], start, size, zlib.crc32(piece.astype("<u4").tobytes()), len(ids[doc]), first + number, offset)
                rows.append((*row, piece.tobytes()) if with_ids else row)
                offset += size
        return pa.table(list(map(list, zip(*rows))), schema=schema)

    names = [n.split()[0] for n in PIECES.split(", ")]
    schema = pa.schema([(n, pa.int64()) for n in names] + ([("ids", pa.binary())] if with_ids else []))
    place = F.coalesce(F.col("doc_id"), F.monotonically_increasing_id())
    dealt = docs.select("doc_id", "text", F.pmod(F.xxhash64(place, F.lit(11)), F.lit(groups)).alias("group"))
    encoded = per_batch(dealt, encode, "doc_id long, group long, ids binary", BATCH_ROWS)
    return encoded.groupBy("group").applyInArrow(packed, PIECES + (", ids binary" if with_ids else ""))
