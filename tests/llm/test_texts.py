"""Toxicity, quality, licences and language-model scores against held-out labels and brute force."""

import collections
import math
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

from conftest import SF
from topicflow.llm import licenses, lm, quality, toxicity

MEDIUM = "/root/testdata/sf0.01"


def words_of(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def base_counts(text):
    words, text = words_of(text), text or ""
    seen = collections.Counter(zip(words, words[1:], words[2:]))
    covered = {k + j for k in range(len(words) - 2) if seen[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [x for x in text.split("\n") if words_of(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)


def test_quality_counts_and_labels(spark):
    docs, labels = spark.read.parquet(f"{MEDIUM}/documents.parquet"), spark.read.parquet(f"{MEDIUM}/labels.parquet")
    texts, good = {r.doc_id: r.text for r in docs.collect()}, {r.doc_id: r.quality for r in labels.collect()}
    wrong = 0
    for r in quality.quality(docs).collect():
        n_words, chars, symbols, lines, repeats = base_counts(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == (n_words, chars, symbols, lines, repeats)
        assert r.base_failed == (n_words < 50 or 100 * repeats > 50 * n_words)
        assert not (r.base_failed and r.kept)
        wrong += r.doc_id in good and not r.base_failed and r.kept != bool(good[r.doc_id])
    assert wrong <= 4


def test_quality_on_odd_rows(odd, table):
    got = collections.Counter((r.doc_id, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in quality.quality(odd).collect())
    assert got == collections.Counter((r.doc_id, *base_counts(r.text)) for r in odd.collect())
    assert quality.quality(odd.limit(0)).count() == 0
    fine = table(["The cat of the house and the dog of the farm went to a town. " + " ".join(f"word{k} and the" if k % 9 == 0 else f"word{k}" for k in range(120))])
    assert quality.drop_poor(fine).collect() == fine.collect()


def test_toxicity_on_held_out_rows(spark):
    docs, labels = spark.read.parquet("/root/testdata/sf0.1/documents.parquet"), spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    toxic = {r.doc_id: r.toxic for r in labels.collect()}
    rows = [r for r in toxicity.toxicity(docs, labels).collect()]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == int(r.score >= 0.5) and 0 <= r.score <= 1 for r in rows)
    unseen = [r for r in rows if r.held_out and r.doc_id in toxic]
    assert np.mean([r.predicted == toxic[r.doc_id] for r in unseen]) > 0.97  # measured: 0.978; what is missed holds no word that tells
    found = [r for r in rows if r.predicted and toxic.get(r.doc_id)]
    assert np.mean([bool(r.offending) for r in found]) > 0.9


def test_labels_without_documents_and_long_texts_take_no_place(spark, table, monkeypatch):
    monkeypatch.setattr(toxicity, "SAMPLE_ROWS", 300)
    docs = table([f"word {k}" if k % 4 else "long " * (toxicity.LONGEST // 4) for k in range(40)], ids=list(range(0, 40_000, 1000)))
    labels = spark.range(40_000).selectExpr("id AS doc_id", "CAST(id % 2 AS int) AS toxic")
    wanted = [k for k in range(40) if k % 4 and zlib.crc32(str(1000 * k).encode()) % 5]
    assert sorted(r.text for r in toxicity.training_sample(docs, labels).collect()) == sorted(f"word {k}" for k in wanted)


def test_toxicity_on_odd_rows(spark, odd):
    labels = spark.createDataFrame([(0, 1), (4, 0), (4, 1), (6, None), (None, 1), (7, 0)], "doc_id long, toxic int")
    rows = toxicity.toxicity(odd, labels).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert toxicity.toxicity(odd.limit(0), labels).count() == 0
    assert toxicity.toxicity(odd, labels.limit(0)).count() == odd.count()
    assert toxicity.drop_toxic(odd, labels).columns == odd.columns


def test_sentence_spans():
    texts = ["One two. Bad idiot!\n x", None, "", "é ü. 日本 is fine"]
    arr = pa.array([t or "" for t in texts])
    row, start, size, of, words = toxicity.sentences(arr)
    assert [(texts[r] or "")[s : s + n] for r, s, n in zip(row, start, size)] == ["One two", " Bad idiot", " x", "é ü", " 日本 is fine"]
    assert row.tolist() == [0, 0, 0, 3, 3]


def license_words(text):
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower(text))


def expected_license(text):
    words, starts, base = license_words(text), [], set()
    for phrase, label in licenses.PHRASES:
        parts = phrase.split()
        hits = [k for k in range(len(words)) if words[k : k + len(parts)] == parts]
        starts += hits
        base |= {label} if hits else set()
    blocks = re.split(r"\n|[.!?] ", lower(text))
    best, labels = 0.0, set(base)
    for block in blocks:
        held = set(license_words(block))
        for label, template in licenses.TEMPLATES:
            wanted = set(template.split())
            share = len(wanted & held) / len(wanted)
            if share >= licenses.THRESHOLD - 1e-12:
                labels.add(label)
                best = max(best, share)
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(base)), ",".join(sorted(labels)), best


def check_licenses(docs):
    want = collections.Counter((r.doc_id, *expected_license(r.text)) for r in docs.collect())
    got = collections.Counter((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.scan(docs).collect())
    assert got == want


def test_licenses(spark, odd, table):
    check_licenses(spark.read.parquet(f"{SF}/documents.parquet"))
    check_licenses(odd)
    check_licenses(table([
        "Released under the MIT License.", "code. Licensed under the GNU General Public License, version 3! More", "CC-BY cc by CC BY 4.0 licensed under",
        "All rights reserved. ALL RIGHTS RESERVED", "Copyright 2020. Rights reserved: all", "the license mit under", None,
    ]))
    assert licenses.scan(odd.limit(0)).count() == 0


@pytest.mark.parametrize("ending", ["\n", "\r\n * "])
def test_wrapped_licenses(table, ending):
    """Each template wrapped after each of its words, in a text with other sentences."""
    texts, labels = [], []
    for label, template in licenses.TEMPLATES:
        words = template.split()
        for k in range(1, len(words)):
            texts.append("Some code by somebody.\n" + " ".join(words[:k]) + ending + " ".join(words[k:]) + ".\nOther words. More of them")
            labels.append(label)
    for r, label in zip(sorted(licenses.scan(table(texts)).collect(), key=lambda r: r.doc_id), labels):
        assert label in r.labels.split(",") and r.score == 1.0 and max(m.containment for m in r.matches) == 1.0
    bsd = "Redistribution and use in source and binary forms, with or without\nmodification, are permitted"
    apart = bsd.replace("\n", ".\n"), bsd.replace("\n", "\n\n"), bsd.replace("\n", " word" * 40 + "\n" + "word " * 40)
    assert [r.labels for r in licenses.scan(table([bsd, *apart])).collect()] == ["bsd", "", "", ""]


def expected_lm(rows):
    unseen = lambda r: zlib.crc32(str(r.doc_id).encode() if r.doc_id is not None else b"") % 5 == 1
    tokens = {id(r): [*words_of(lower(r.text)), "\n"] for r in rows}
    counts = collections.Counter(t for r in rows if not unseen(r) for t in tokens[id(r)])
    pairs = collections.Counter(p for r in rows if not unseen(r) for p in zip(["\n", *tokens[id(r)]], tokens[id(r)]))
    n, v = sum(counts.values()), len(counts)
    total = n + 0.5 * (v + 1)
    middle = lambda c: (3 * 2 ** (math.floor(math.log2(c))) - 1) / 2 if c else 0
    out = []
    for r in rows:
        mine = tokens[id(r)]
        base = sum(math.log10((counts[t] + 0.5) / total) for t in mine)
        score = 0.0
        for a, b in zip(["\n", *mine], mine):
            first = middle(counts[a])
            score += math.log10(min((min(middle(pairs[a, b]), first) + lm.PULL * (middle(counts[b]) + 0.5) / total) / (first + lm.PULL), 1))
        out.append((r.doc_id, unseen(r), len(mine), sum(counts[t] > 0 for t in mine), n, base, score))
    return out


def check_lm(docs, **options):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    want, got = sorted(expected_lm(docs.collect()), key=key), sorted(map(tuple, lm.score(docs, **options).collect()), key=key)
    assert len(got) == len(want)
    for w, g in zip(want, got):
        assert w[:5] == g[:5] and math.isclose(w[5], g[5], rel_tol=1e-9, abs_tol=1e-9)
    error = np.array([(g[6] - w[6]) / w[2] for w, g in zip(want, got)])
    assert abs(error.mean()) < 0.05 and np.abs(error).max() < 0.5  # the filter answers yes too often, seldom


@pytest.mark.parametrize("block_bytes", [lm.BLOCK_BYTES, 50_000])
def test_lm(spark, odd, block_bytes):
    check_lm(spark.read.parquet(f"{SF}/documents.parquet"), block_bytes=block_bytes)
    check_lm(odd, block_bytes=block_bytes)


def test_lm_empty(odd):
    assert lm.score(odd.limit(0)).count() == 0
    only = odd.where("doc_id = 6")  # nothing or itself to learn from
    assert lm.score(only).count() == 1


def test_filter_has_no_false_negatives():
    keys = np.arange(1, 3000, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    bits, size = np.zeros(40_000, bool), np.array([40_000])
    for probe in range(lm.PROBES):
        bits[lm.spots(keys, 1, probe, size)] = True
    held = lm.Filter(np.packbits(bits), np.zeros(1, np.int64), size, 0)
    assert held.holds(keys, 1).all()
    assert held.holds(keys + np.uint64(12345), 1).mean() < 0.1


def test_filter_in_blocks(spark, odd, monkeypatch):
    """A filter of many blocks knows as much as one of a single block."""
    for docs in (spark.read.parquet(f"{SF}/documents.parquet"), odd):
        told = lambda: sorted((str((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens)), round(r.base_score, 6), round(r.score, 6)) for r in lm.score(docs).collect())  # noqa: B023, E731
        whole = told()
        with monkeypatch.context() as small:
            small.setattr(lm, "FILTER_BYTES", 1024)
            assert told() == whole
