"""Encoders against the library, packing and shards by exact round trips."""

import hashlib
import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from conftest import SF
from topicflow.llm import bpe, packing, shards
from topicflow.llm.tokens import WordEncoder

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def wanted(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


@given(st.lists(st.text(max_size=40), max_size=6))
@settings(max_examples=60, deadline=None)
def test_encoders_equal_the_library(texts):
    tool = bpe.codec(PATH)
    ids, ends = WordEncoder(PATH).encode(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        want = wanted(text)
        assert ids[ends[k] : ends[k + 1]].tolist() == want
        said = [tool.encode(w) for w in text.replace("\n", " ").split(" ")]
        assert [int(i) for s in said for i in s[1].split()] == want


def test_merges_equal_plain_merging():
    draw = random.Random(3)
    pairs = {}
    for rank in range(60):
        pairs.setdefault(bpe.pair(draw.randrange(12), draw.randrange(12)), (rank, draw.randrange(12)))
    for _ in range(300):
        symbols = [draw.randrange(8) for _ in range(draw.randrange(40))]
        plain = list(symbols)
        while True:
            ranks = [(pairs[bpe.pair(a, b)][0], k) for k, (a, b) in enumerate(zip(plain, plain[1:])) if bpe.pair(a, b) in pairs]
            if not ranks:
                break
            _, k = min(ranks)
            plain[k : k + 2] = [pairs[bpe.pair(plain[k], plain[k + 1])][1]]
        assert bpe.merge_symbols(symbols, pairs) == plain


def test_codec_on_odd_rows(odd):
    rows = odd.collect()
    got = bpe.encode_decode(odd).collect()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = []
    for r in rows:
        ids = wanted(r.text)
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))))
    assert sorted(map(str, want)) == sorted(str(tuple(r)) for r in got)
    assert bpe.encode_decode(odd.limit(0)).count() == 0


def held(pieces, texts):
    """Checks that pieces hold each document once, gapless, and returns the padding share."""
    by_doc, by_sequence = {}, {}
    for p in pieces:
        by_doc.setdefault((p.doc_id, p.doc_tokens), []).append(p)
        by_sequence.setdefault(p.sequence_id, []).append(p)
    total = padding = 0
    for sequence in by_sequence.values():
        sequence.sort(key=lambda p: p.offset)
        assert [p.offset for p in sequence] == np.cumsum([0] + [p.length for p in sequence])[:-1].tolist()
        size = sum(p.length for p in sequence)
        assert 0 < size <= 4096
        total += size
        padding += 4096 - size if size & (size - 1) else 0
    for (doc_id, _), parts in by_doc.items():
        ids = [*wanted(texts[doc_id]), 2]
        parts.sort(key=lambda p: p.start)
        times = sum(p.length for p in parts) // len(ids)
        assert sum(p.length for p in parts) == times * len(ids)
        for p in parts:
            assert p.ids_crc32 == crc(ids[p.start : p.start + p.length])
    return padding / max(total, 1)


def test_packing(spark, odd):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    assert held(packing.pack(docs, with_ids=False, docs_per_group=64).collect(), texts) < 0.01
    assert held(packing.pack(odd, with_ids=False).collect(), {r.doc_id: r.text for r in odd.collect()}) < 0.01
    assert packing.pack(odd.limit(0)).count() == 0


@given(st.lists(st.integers(1, 40), max_size=30))
@settings(max_examples=200, deadline=None)
def test_first_fit_decreasing_equals_plain(sizes):
    got, bins = packing.first_fit_decreasing(sizes, 40), []
    for k in sorted(range(len(sizes)), key=lambda k: -sizes[k]):
        spot = next((b for b in bins if sum(sizes[j] for j in b) + sizes[k] <= 40), None)
        bins.append([k]) if spot is None else spot.append(k)
    assert got == bins


@given(st.lists(st.integers(1, 300), max_size=30))
@settings(max_examples=200, deadline=None)
def test_group_holds_every_id_once(sizes):
    sequences = packing.pack_group(sizes, 64, 4)
    seen = sorted((d, s + k) for sequence in sequences for d, s, n in sequence for k in range(n))
    assert seen == [(d, k) for d, n in enumerate(sizes) for k in range(n)]
    padding = sum(64 - n for n in (sum(p[2] for p in s) for s in sequences) if n & (n - 1))
    assert padding <= 3 * len(sequences)


def test_shards(spark, odd):
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        texts = sorted(((r.doc_id is not None, r.doc_id or 0, r.text) for r in docs.collect()), key=lambda x: x[:2])
        got = sorted((tuple(r) for r in shards.round_trip(docs).collect()), key=lambda r: r[1])
        at = 0
        assert len(got) == len(texts)
        for (known, doc_id, text), (got_id, start, n, check) in zip(texts, got):
            ids = [*wanted(text), 2]
            assert (got_id, start, n, check) == (doc_id if known else None, at, len(ids), crc(ids))
            at += n
    assert shards.round_trip(odd.limit(0)).count() == 0


@pytest.mark.parametrize("n", [0, 1, 5000])
def test_perfect_index(n):
    ids, copies = np.arange(n) * 977 - 5, np.arange(n) % 3
    values = {"start": np.arange(n) * 10}
    index = shards.PerfectIndex.load(shards.PerfectIndex.build(ids, copies, values).dump())
    assert sorted(index.slots(ids, copies).tolist()) == list(range(n))
    known, found = index.find(ids, copies)
    assert known.all() and (found["start"] == values["start"]).all()
    strange, _ = index.find(ids + 1_000_000_007, copies)
    assert strange.sum() <= 1
