"""Token ids of whole texts by the tokenizers library, each different word of a batch encoded once."""

from __future__ import annotations

import json
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex

MARK = "\x01"
BATCH_ROWS = 2500  # larger batches hold relatively fewer different words
CACHED_WORDS = 1_000_000
WORDS_PER_CALL = 4000


class WordEncoder:
    """No token crosses a space or a line break, so words between them are encoded apart and remembered."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        (self.mark,) = self._call([MARK])[0]
        with open(path, encoding="utf-8") as file:
            self.cut = regex.compile(json.load(file)["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        self._forget()

    def _call(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _forget(self) -> None:
        self.known = pa.array([], pa.string())
        self.ids, self.starts = np.zeros(0, np.uint16), np.zeros(1, np.int64)

    def _learn(self, new: pa.Array) -> None:
        """Printable ASCII words are cut by the library's pattern and go to its model at once. Others go
        through the whole library, many at a time with a mark between them, those holding the mark alone."""
        words = new.to_pylist()
        easy = [w.isascii() and w.isprintable() and "<|" not in w for w in words]
        simple, rest = [w for w, e in zip(words, easy) if e], [w for w, e in zip(words, easy) if not e]
        plain, odd = [w for w in rest if MARK not in w], [w for w in rest if MARK in w]
        model, pieces, found, sizes = self.library.model, {}, [], []
        for word in simple:
            ids = []
            for piece in self.cut.findall(word.lower()):
                if piece not in pieces:
                    pieces[piece] = [t.id for t in model.tokenize(piece)]
                ids += pieces[piece]
            found += ids
            sizes.append(len(ids))
        groups = [np.array(found, np.uint16)]
        for k in range(0, len(plain), WORDS_PER_CALL):
            group = plain[k : k + WORDS_PER_CALL]
            ids = np.array(self._call([f" {MARK} ".join([*group, ""])])[0], np.uint16)
            ends = np.flatnonzero(ids == self.mark)
            sizes += (np.diff(ends, prepend=-1) - 1).tolist()
            groups.append(ids[ids != self.mark])
        for ids in self._call(odd):
            sizes.append(len(ids))
            groups.append(np.array(ids, np.uint16))
        self.known = pa.concat_arrays([self.known, pa.array(simple + plain + odd, pa.string())])
        self.ids = np.concatenate([self.ids, *groups])
        self.starts = np.concatenate([self.starts, self.starts[-1] + np.cumsum(np.array(sizes, np.int64))])

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts one after another, and the row offsets into them."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        offsets = lists.offsets.to_numpy().astype(np.int64)
        coded = lists.flatten().dictionary_encode()
        words = coded.dictionary
        if len(self.known) + len(words) > CACHED_WORDS:
            self._forget()
        self._learn(words.filter(pc.is_null(pc.index_in(words, self.known))))
        entry = pc.index_in(words, self.known).to_numpy(zero_copy_only=False).astype(np.int64)[coded.indices.to_numpy()]
        starts, sizes = self.starts[entry], self.starts[entry + 1] - self.starts[entry]
        ends = np.concatenate([[0], np.cumsum(sizes)])
        taken = np.repeat(starts - ends[:-1], sizes) + np.arange(ends[-1])
        return self.ids[taken], ends[offsets - offsets[0]]


@lru_cache(maxsize=2)
def encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


def encode_with_end(texts: pa.Array, path: str, end_id: int) -> list[np.ndarray]:
    """Per text its ids as little-endian unsigned 32-bit numbers, with the end id."""
    ids, offsets = encoder(path).encode(texts)
    return [np.append(ids[a:b], np.uint16(end_id)) for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
