"""Licence scans: an exact set-similarity join of text blocks with licence templates.

A block (sentence or line) meets a template when it holds at least ``threshold`` of the template's
different words. Sentences that go on over single line breaks are also read in overlapping windows of twice the
longest template, so that wrapped notices are met. Words have one global order, rarest in the corpus first, counted over all texts. Every
template has a prefix so long that a block without any word of it can't reach the threshold; only blocks
that hold a prefix word become candidates, those with too few template words (length) or too few
left behind the meeting place (position) are dropped, and the rest are counted out on full sets. The
filters never drop a pair that meets the threshold. The templates are a small table that goes to every task.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import filled, per_batch, prepare

THRESHOLD = 0.8
NOT_WORDS = "[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
# fixed values of the contract
PHRASES = (("cc by", "cc-by"), ("general public license", "gpl"), ("all rights reserved", "reserved"))
# notices of well-known licences: (label, text)
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2.0", "licensed under the apache license version 2 0"),
    ("gpl", "licensed under the gnu general public license version 3"),
    ("lgpl", "licensed under the gnu lesser general public license"),
    ("agpl", "licensed under the gnu affero general public license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2.0", "subject to the terms of the mozilla public license"),
    ("cc-by", "licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under a creative commons attribution sharealike 4 0 international license"),
    ("cc0", "dedicated to the public domain under cc0"),
    ("reserved", "copyright all rights reserved"),
    ("reserved", "no part of this publication may be reproduced without prior written permission"),
)
SCAN = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, matches array<struct<template:int,block:int,containment:double>>"
MATCH = pa.struct([("template", pa.int32()), ("block", pa.int32()), ("containment", pa.float64())])


def block_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.DictionaryArray]:
    """Row, block and sentence (within the batch) of each word, and the words.

    Blocks end at a line break or a full stop, ! or ? before a space; sentences go on over a line break, but not over a line without words.
    """
    lower = pc.ascii_lower(texts)
    for stop in ".!?":
        lower = pc.replace_substring(lower, f"{stop} ", "\n\0")  # the zero, no part of a word, tells this end from a line break
    lists = pc.split_pattern(lower, "\n")
    row = np.repeat(np.arange(len(texts)), np.diff(lists.offsets.to_numpy()))
    words = pc.ascii_split_whitespace(pc.replace_substring_regex(lists.flatten(), NOT_WORDS, " "))
    flat = words.flatten()
    real = pc.greater(pc.binary_length(flat), 0)
    block = np.repeat(np.arange(len(row)), np.diff(words.offsets.to_numpy()))[real.to_numpy(zero_copy_only=False)]
    pieces = lists.flatten()
    begins = pc.or_(pc.starts_with(pieces, "\0"), pc.equal(pc.binary_length(pieces), 0)).to_numpy(zero_copy_only=False)
    ends = pc.match_substring_regex(pieces, "[.!?]\\s*$").to_numpy(zero_copy_only=False) | (np.bincount(block, minlength=len(row)) == 0)
    begins = begins | (np.diff(row, prepend=-1) != 0) | np.append(True, ends[:-1])[: len(row)]
    return row[block], block, np.cumsum(begins)[block], flat.filter(real).dictionary_encode()


def wrapped_windows(block: np.ndarray, sentence: np.ndarray, step: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows of ``2 * step`` words, one each ``step`` words of a sentence, that lie in more than one block: first word of
    the window and place of each of its words, and by first word the last one."""
    n = len(block)
    begins = np.flatnonzero(np.diff(sentence, prepend=-1))
    size = np.diff(np.append(begins, n))
    first, end = np.repeat(begins, size), np.repeat(begins + size, size)
    at = np.arange(n)
    start = first + (at - first) // step * step
    last = np.minimum(at + 2 * step, end) - 1  # of a window that begins at this word
    place, of = np.concatenate([at, at]), np.concatenate([start, start - step])
    real = of >= np.concatenate([first, first])
    place, of = place[real], of[real]
    wrapped = block[of] != block[last[of]]
    return of[wrapped], place[wrapped], last


def vocabulary(templates: Sequence[tuple[str, str]]) -> list[str]:
    return sorted({w for _, text in templates for w in text.split()})


def frequencies(docs: DataFrame, words: list[str]) -> dict[str, int]:
    """How often each word of the templates occurs in all texts: one row per word reaches the driver."""
    known = pa.array(words, pa.string())

    def count(batch: pa.RecordBatch) -> pa.RecordBatch:
        _, _, _, coded = block_words(filled(batch, "text"))
        place = pc.fill_null(pc.index_in(coded.dictionary, known), len(words)).to_numpy(zero_copy_only=False)
        total = np.bincount(place[coded.indices.to_numpy()], minlength=len(words) + 1)[:-1]
        return pa.RecordBatch.from_arrays([pa.array(np.arange(len(words))), pa.array(total.astype(np.int64))], ["word", "n"])

    rows = per_batch(docs.select("text"), count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")).collect()
    return {words[r["word"]]: r["n"] for r in rows}


@dataclass
class Join:
    """The templates as sets of ranks, rarest word first, and the index of their prefixes."""

    words: list[str]  # by rank
    sets: list[np.ndarray]  # ranks of each template, ascending
    needed: list[int]  # words that must be shared

    @classmethod
    def of(cls, templates: Sequence[tuple[str, str]], counts: dict[str, int], threshold: float) -> Join:
        words = sorted(vocabulary(templates), key=lambda w: (counts.get(w, 0), w))
        rank = {w: k for k, w in enumerate(words)}
        sets = [np.array(sorted({rank[w] for w in text.split()}), np.int64) for _, text in templates]
        return cls(words, sets, [math.ceil(threshold * len(s) - 1e-9) for s in sets])

    def pairs(self, block: np.ndarray, rank: np.ndarray) -> list[tuple[int, int, int]]:
        """(template, block, shared words) of all pairs that meet the threshold; ``block, rank`` are distinct and sorted."""
        if not len(block):
            return []
        begins = np.flatnonzero(np.diff(block, prepend=-1))
        size = np.diff(np.append(begins, len(block)))
        of = np.repeat(np.arange(len(begins)), size)
        place = np.arange(len(block)) - begins[of]
        found = []
        for template, (ranks, needed) in enumerate(zip(self.sets, self.needed)):
            prefix = ranks[: len(ranks) - needed + 1]
            met = np.isin(rank, prefix)
            met &= size[of] >= needed  # length
            at = np.searchsorted(ranks, rank[met])
            left = np.minimum(len(ranks) - at, size[of[met]] - place[met])
            before = np.minimum(at, place[met])  # words that may have met earlier
            candidates = np.unique(of[met][before + left >= needed])  # position
            if not len(candidates):
                continue
            chosen = np.isin(of, candidates)
            shared = np.bincount(of[chosen][np.isin(rank[chosen], ranks)], minlength=len(begins))
            found += [(template, int(block[begins[b]]), int(shared[b])) for b in candidates if shared[b] >= needed]
        return found


def phrase_starts(codes: np.ndarray, row: np.ndarray, dictionary: pa.Array, phrase: str) -> np.ndarray:
    """Places in the batch at which the words of a phrase stand one after another in one row."""
    words = phrase.split()
    at = pc.index_in(pa.array(words, dictionary.type), dictionary)
    if at.null_count or len(codes) < len(words):
        return np.zeros(0, np.int64)
    wanted, n = at.to_numpy(zero_copy_only=False), len(codes) - len(words) + 1
    hit = row[:n] == row[len(words) - 1 :]
    for k, code in enumerate(wanted):
        hit &= codes[k : k + n] == code
    return np.flatnonzero(hit)


def scan(docs: DataFrame, templates: Sequence[tuple[str, str]] = TEMPLATES, threshold: float = THRESHOLD, phrases: Sequence[tuple[str, str]] = PHRASES) -> DataFrame:
    """Per row of ``docs``: words, places of the phrases, labels, the best containment of a template (0 without any
    that meets the threshold) and all matches (template, block of the text, containment); a wrapped notice is given with the block its window begins in.

    A null or empty text has no words, no labels (the empty string) and score 0. Repeated rows give repeated results; an empty
    table gives none.
    """
    prepare(docs)
    join = Join.of(templates, frequencies(docs, vocabulary(templates)), threshold)
    labels_of = [label for label, _ in templates]
    ranked = pa.array(join.words, pa.string())
    step = max((len(text.split()) for _, text in templates), default=1)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.num_rows
        row, block, sentence, coded = block_words(filled(batch, "text"))
        codes = coded.indices.to_numpy()
        n_words = np.bincount(row, minlength=n)
        first_of = np.concatenate([[0], np.cumsum(n_words)])
        n_base, low, high = np.zeros(n, np.int64), np.full(n, -1), np.full(n, -1)
        base: list[set] = [set() for _ in range(n)]
        for phrase, label in phrases:
            starts = phrase_starts(codes, row, coded.dictionary, phrase)
            of = row[starts]
            n_base += np.bincount(of, minlength=n)
            for r, at in zip(of.tolist(), (starts - first_of[of]).tolist()):
                base[r].add(label)
                low[r] = at if low[r] < 0 else min(low[r], at)
                high[r] = max(high[r], at)
        rank = pc.fill_null(pc.index_in(coded.dictionary, ranked), -1).to_numpy(zero_copy_only=False)[codes] if len(codes) else codes
        known = rank >= 0
        both = np.unique(block[known].astype(np.int64) * max(len(ranked), 1) + rank[known])
        row_of = dict(zip(block.tolist(), row.tolist())) if len(both) else {}
        first_block: dict[int, int] = {}
        matches: list[list] = [[] for _ in range(n)]
        labels = [set(b) for b in base]
        for template, at, shared in join.pairs(both // max(len(ranked), 1), both % max(len(ranked), 1)):
            r = row_of[at]
            if r not in first_block:
                first_block[r] = int(block[first_of[r]])
            matches[r].append({"template": template, "block": at - first_block[r], "containment": shared / len(join.sets[template])})
            labels[r].add(labels_of[template])
        window, place, last = wrapped_windows(block, sentence, step)
        real = rank[place] >= 0
        both = np.unique(window[real] * max(len(ranked), 1) + rank[place[real]])
        for template, at, shared in join.pairs(both // max(len(ranked), 1), both % max(len(ranked), 1)):
            r, share = int(row[at]), shared / len(join.sets[template])
            begin = int(block[first_of[r]])
            low_block, high_block = int(block[at]) - begin, int(block[last[at]]) - begin
            met = [m for m in matches[r] if m["template"] == template and low_block <= m["block"] <= high_block]
            for m in met:  # the same notice, met in one of its lines or in the window before
                m["containment"] = max(m["containment"], share)
            if not met:
                matches[r].append({"template": template, "block": low_block, "containment": share})
                labels[r].add(labels_of[template])
        told = lambda sets: pa.array([",".join(sorted(s)) for s in sets], pa.string())
        score = [max((m["containment"] for m in found), default=0.0) for found in matches]
        where = lambda x: pa.array(x.astype(np.int64), pa.int64(), mask=x < 0)
        columns = [batch.column(0), pa.array(n_words.astype(np.int64)), pa.array(n_base), where(low), where(high), told(base), told(labels), pa.array(score, pa.float64()), pa.array(matches, pa.list_(MATCH))]
        return pa.RecordBatch.from_arrays(columns, [c.split()[0] for c in SCAN.split(", ")])

    return per_batch(docs.select("doc_id", "text"), work, SCAN)
