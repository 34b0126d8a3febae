"""Token ids of whole texts by the tokenizers library, each distinct piece encoded once a worker."""

from __future__ import annotations

import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from cadastre.llm import shared, words

_LETTER, _SYMBOL = 1, 2
#: Under the vocabulary's splitting pattern a piece always ends between a letter and an ASCII
#: symbol, in either order; only the apostrophe, which begins contractions, may belong to both.
#: Letters known here are the ASCII ones and U+00C0 to U+00FF, whose first byte is 0xC3.
_KIND = np.zeros(256, np.uint8)
_KIND[ord("a"):ord("z") + 1] = _LETTER
_KIND[list(b'!"#$%&()*+,-./:;<=>?@[\\]^_`{|}~')] = _SYMBOL


class WordIds:
    """Encode texts as ids.

    The vocabulary splits at white space and lower-cases, so a text's ids are those of its
    words in a row, and those of a word are those of its letters and symbols in a row.  Encoded
    pieces are kept until they are more than ``keep``, then the table starts anew.
    """

    def __init__(self, path: str, code: str = "<u4", keep: int = 800_000, step: int = 4 << 20):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.code, self.keep, self.step = np.dtype(code), keep, step
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.ids, self.starts = np.zeros(0, self.code), np.zeros(1, np.int64)

    def _places(self, pieces: list[bytes]) -> np.ndarray:
        """Place of each of these distinct pieces in the table; unknown ones are encoded first."""
        known = self.known
        fresh = [p for p in pieces if p not in known]
        if fresh and known and len(known) + len(fresh) > self.keep:
            self._forget()
            known, fresh = self.known, pieces
        if fresh:
            made = [e.ids for e in self.tokenizer.encode_batch_fast(
                [p.decode() for p in fresh], add_special_tokens=False)]
            known.update(zip(fresh, range(len(known), len(known) + len(fresh))))
            ends = np.cumsum([len(m) for m in made]) + len(self.ids)
            self.ids = np.concatenate([self.ids, np.array([i for m in made for i in m], self.code)])
            self.starts = np.concatenate([self.starts, ends])
        return np.array([known[p] for p in pieces], np.int64)

    def _spans(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
        """Cut the bytes into spans of about ``step`` that end at white space or with a text."""
        if len(data) <= self.step:
            yield 0, len(data)
            return
        cuts = np.union1d(np.flatnonzero(~words.NOT_SPACE[data]), offsets)
        start = 0
        while start < len(data):
            at = np.searchsorted(cuts, start + self.step)
            end = int(cuts[at]) if at < len(cuts) else len(data)
            yield start, end
            start = end

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row and where each text's begin (one entry more than texts)."""
        data, offsets = words.text_bytes(texts)
        parts, bounds, total = [], np.zeros(len(offsets), np.int64), 0
        for start, end in self._spans(data, offsets):
            inner = np.searchsorted(offsets, start, "right"), np.searchsorted(offsets, end, "right")
            ids, ends = self._encode_span(data[start:end], offsets[slice(*inner)] - start)
            bounds[slice(*inner)] = ends + total
            parts.append(ids)
            total += len(ids)
        return np.concatenate(parts) if parts else np.zeros(0, self.code), bounds

    def _encode_span(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of a span, and how many of them lie before each of these places."""
        data = words.LOWER[data]
        inside, kind = words.NOT_SPACE[data], _KIND[data]
        accented = np.flatnonzero(data[:-1] == 0xC3)
        accented = accented[(data[accented + 1] != 0x97) & (data[accented + 1] != 0xB7)]  # signs
        kind[accented] = kind[accented + 1] = _LETTER
        first = inside.copy()
        first[1:] &= ~inside[:-1] | (kind[1:] ^ kind[:-1] == _LETTER ^ _SYMBOL)
        at = ends[ends < len(data)]
        first[at] = inside[at]
        starts = np.flatnonzero(first)
        if not len(starts):
            return np.zeros(0, self.code), np.zeros(len(ends), np.int64)
        packed = data[inside]
        places = np.append(np.cumsum(inside, dtype=np.int32)[starts].astype(np.int64) - 1, len(packed))
        coded = pa.LargeBinaryArray.from_buffers(
            pa.large_binary(), len(starts),
            [None, pa.py_buffer(places), pa.py_buffer(packed)]).dictionary_encode()
        of = self._places(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        begin = self.starts[of]
        sizes = self.starts[of + 1] - begin
        upto = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.ids[np.arange(upto[-1]) + np.repeat(begin - upto[:-1], sizes)]
        return ids, upto[np.searchsorted(starts, ends)]


_OPEN: dict[tuple[str, str], WordIds] = {}


def word_ids(path: str, code: str = "<u4") -> WordIds:
    """The worker's encoder for a vocabulary file; it lives as long as the worker."""
    key = (path, code)
    if key not in _OPEN:
        _OPEN[key] = WordIds(path, code)
    return _OPEN[key]


def forget() -> None:
    """Drop the worker's encoders; a worker outlives its stage, and steps that do not encode need the room."""
    if _OPEN:
        _OPEN.clear()
        shared.give_back()
