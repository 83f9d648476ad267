"""Byte-pair encoding and decoding by a segment tree over the ranks of adjacent pairs.

The pair of lowest rank, and among equals the leftmost, is what the root of the tree holds. A
merge changes two pairs and removes one, each a point update of logarithmic cost, so a "word" of
100 000 characters takes n log n steps. Texts are cut at white space, each different piece of a
batch is encoded once, and the results are put together by Arrow.
"""

from __future__ import annotations

import hashlib
import json
import unicodedata
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import public_tokenizers
import regex
from pyspark.sql import DataFrame

from .common import filled, per_batch

TOKENIZER = "word_bpe_49k.json"
BATCH_ROWS = 3000
CACHED_PIECES = 500_000
NEVER = 1 << 62
SCHEMA = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: printable Latin-1 for itself, the others from U+0100 on."""
    printable = {*range(ord("!"), ord("~") + 1), *range(ord("¡"), ord("¬") + 1), *range(ord("®"), ord("ÿ") + 1)}
    others = [b for b in range(256) if b not in printable]
    return [chr(b) if b in printable else chr(256 + others.index(b)) for b in range(256)]


def pair(left: int, right: int) -> int:
    return left << 32 | right


def merge_symbols(symbols: list[int], pairs: dict[int, tuple[int, int]]) -> list[int]:
    """All merges of one word. ``pairs`` maps ``pair(a, b)`` to (rank, merged symbol)."""
    n = len(symbols)
    if n < 2:
        return symbols
    symbols = list(symbols)
    size = 1 << (n - 1).bit_length()
    tree = [NEVER] * (2 * size)
    following, previous = list(range(1, n + 1)), list(range(-1, n - 1))

    def key(at: int) -> int:
        after = following[at]
        if after >= n:
            return NEVER
        found = pairs.get(symbols[at] << 32 | symbols[after])
        return found[0] * n + at if found else NEVER  # the smallest key: lowest rank, then leftmost

    def put(at: int, value: int) -> None:
        at += size
        while tree[at] != value:
            tree[at] = value
            at >>= 1
            if not at:
                break
            left, right = tree[2 * at], tree[2 * at + 1]
            value = left if left < right else right

    for at in range(n - 1):
        tree[size + at] = key(at)
    for at in range(size - 1, 0, -1):
        left, right = tree[2 * at], tree[2 * at + 1]
        tree[at] = left if left < right else right
    while (best := tree[1]) < NEVER:
        at = best % n
        gone = following[at]
        symbols[at] = pairs[symbols[at] << 32 | symbols[gone]][1]
        after = following[at] = following[gone]
        if after < n:
            previous[after] = at
        symbols[gone] = -1
        put(gone, NEVER)
        put(at, key(at))
        if previous[at] >= 0:
            put(previous[at], key(previous[at]))
    return [s for s in symbols if s >= 0]


class Codec:
    """Encodes and decodes whole texts with the vocabulary of one tokenizer file."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocab, self.suffix = model["vocab"], model["end_of_word_suffix"]
        self.names = {i: t for t, i in self.vocab.items()} | {t["id"]: t["content"] for t in spec["added_tokens"]}
        self.pairs = {}
        for rank, (a, b) in enumerate(model["merges"]):
            self.pairs.setdefault(pair(self.vocab[a], self.vocab[b]), (rank, self.vocab[a + b]))
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.cut_added = regex.compile("(" + "|".join(map(regex.escape, sorted(self.added, key=len, reverse=True))) + ")")
        self.cut = regex.compile(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        library = Tokenizer.from_file(path)  # its normaliser and splitter serve for rare scripts
        self.normalizer, self.splitter = library.normalizer, library.pre_tokenizer
        self.signs = byte_alphabet()
        self.pieces: dict[str, tuple[int, str, str]] = {}

    def piece(self, piece: str) -> tuple[int, str, str]:
        """Of one piece in the byte alphabet: number of ids, ids in decimal, and tokens, both joined by spaces."""
        found = self.pieces.get(piece)
        if found is None:
            if len(self.pieces) >= CACHED_PIECES:
                self.pieces.clear()
            symbols = [self.vocab[c] for c in piece[:-1]] + [self.vocab[piece[-1] + self.suffix]]
            found = self.pieces[piece] = self.told(merge_symbols(symbols, self.pairs))
        return found

    def told(self, ids: list[int]) -> tuple[int, str, str]:
        """This vocabulary names no decoder, so decoding joins tokens by spaces, special ones included."""
        return len(ids), " ".join(map(str, ids)), " ".join([self.names[i] for i in ids])

    def split(self, text: str) -> list[str]:
        """Pieces in the byte alphabet. Simple Latin text is cut here, the rest by the library's own rules."""
        if text.isascii() and text.isprintable():
            return self.cut.findall(text.lower())
        if max(text) < "ɐ" and text.isprintable() and "İ" not in text and unicodedata.is_normalized("NFC", text):
            return ["".join([self.signs[b] for b in p.encode()]) for p in self.cut.findall("".join([c.lower() for c in text]))]
        return [p for p, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text))]

    def encode(self, text: str) -> tuple[int, str, str]:
        """Number of ids, ids in decimal, and the decoded text of a text without spaces or of a whole one."""
        parts: list[tuple[int, str, str]] = []
        for k, part in enumerate(self.cut_added.split(text) if "<|" in text else [text]):
            if k % 2:
                parts.append(self.told([self.added[part]]))
            elif part:
                parts += [self.piece(p) for p in self.split(part)]
        if len(parts) == 1:
            return parts[0]
        return sum([p[0] for p in parts]), " ".join([p[1] for p in parts]), " ".join([p[2] for p in parts])


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    return Codec(path)


def encode_decode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Per document: number of ids, and digests of its ids and of the text decoded from them.

    A null text is an empty one: no ids, digests of the empty text. Repeated rows give repeated
    results; an empty table gives none. Only doc_id and text are read, so other columns may have
    any name.
    """
    path = path or public_tokenizers.path(TOKENIZER)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        tool = codec(path)
        lists = pc.split_pattern(pc.replace_substring(filled(batch), "\n", " "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        known = [tool.encode(w) for w in coded.dictionary.to_pylist()]
        sizes = np.array([k[0] for k in known], np.int64)
        codes = coded.indices.to_numpy()
        taken = sizes[codes] > 0  # words of no ids leave no space behind
        codes = codes[taken]
        before = np.concatenate([[0], np.cumsum(taken, dtype=np.int64)])[offsets - offsets[0]]
        total = np.concatenate([[0], np.cumsum(sizes[codes])])
        digests = [[], []]
        for which, column in enumerate(digests):
            parts = [k[1 + which] for k in known]
            at = codes.tolist()
            for first, last in zip(before[:-1].tolist(), before[1:].tolist()):
                column.append(hashlib.sha256(" ".join([parts[c] for c in at[first:last]]).encode()).hexdigest())
        counts = total[before[1:]] - total[before[:-1]]
        return pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts), pa.array(digests[0]), pa.array(digests[1])], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return per_batch(docs.select("doc_id", "text"), work, SCHEMA, BATCH_ROWS)
