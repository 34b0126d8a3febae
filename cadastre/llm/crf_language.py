"""Language of words and texts by a linear-chain conditional random field.

Words are lower-cased letter runs, and single letters in scripts written without spaces.  A word's state scores are sums of learned weights of hashed
features: its prefixes and suffixes (affixes), its inner n-grams, and itself (lexicon).  Learned
transitions tie neighbours together; forward-backward gives every word's probability of each
language.  A text's language is the one with the largest share of letters, and that share is its
score.

Labels belong to texts.  For transitions, training sequences are spliced from runs of words of
labelled texts, so that they switch language like code-switched text does.  Training uses at most
``sample_rows`` texts; labelling takes whole texts.

Edge cases: a null text or one without a letter is ``und`` with score 0; with no labelled text
all are ``und``; labels are read as text; repeated rows are labelled alike; a null key is kept;
an empty table gives no row; other columns of the table do not matter.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cadastre.llm import shared, words
from cadastre.llm.text_stats import held_out

_LETTER = regex.compile(r"\p{L}")
_SIZES = (2, 3, 4)
#: so many places of words are looked at together
_PLACES = 1 << 20
#: scripts written without spaces between words: each letter is a word, with the marks that follow it
_UNSPACED = ((0x0E00, 0x1000), (0x1000, 0x10A0), (0x1780, 0x1800), (0x1950, 0x19E0), (0x1A20, 0x1AB0),
             (0x2E80, 0x2FE0), (0x3005, 0x3008), (0x3021, 0x3030), (0x3031, 0x3130), (0x31A0, 0x3200),
             (0x3400, 0x4DC0), (0x4E00, 0xA4D0), (0xA980, 0xA9E0), (0xA9E0, 0xAA00), (0xAA60, 0xAAE0),
             (0xF900, 0xFB00), (0xFF66, 0xFFA0), (0x1AFF0, 0x1B170), (0x20000, 0x32400))
_OUT, _SPACED, _ALONE, _MARK = range(4)


@cache
def _kinds() -> np.ndarray:
    """Kind of each character: no part of a word, part of one, a word of its own, or a mark on the one before."""
    kinds = np.zeros(0x110000, np.uint8)
    for code in range(0x110000):
        category = unicodedata.category(chr(code))[0]
        kinds[code] = _SPACED if category == "L" else _MARK if category == "M" else _OUT
    for a, z in _UNSPACED:
        part = kinds[a:z]
        part[part == _SPACED] = _ALONE
    kinds[[0x200C, 0x200D]] = _MARK  # joiners inside words
    return kinds


def find_units(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each letter run, or letter of an unspaced script, and the first of each text."""
    if not len(data) or data.max() < 128:
        return words.find_words(data, offsets, words.LETTERS)
    at = np.flatnonzero((data & 0xC0) != 0x80)
    code = data[at].astype(np.int32)
    for low, high, more in ((0xC0, 0xE0, 1), (0xE0, 0xF0, 2), (0xF0, 0xF8, 3)):
        some = np.flatnonzero((data[at] >= low) & (data[at] < high))
        value = data[at[some]].astype(np.int32) & (0x3F >> more)
        for k in range(1, more + 1):
            value = value << 6 | (data[np.minimum(at[some] + k, len(data) - 1)] & 0x3F)
        code[some] = value
    kind = _kinds()[code]
    before = np.zeros_like(kind)
    before[1:] = kind[:-1]
    firsts = np.searchsorted(at, offsets[:-1])
    before[firsts[firsts < len(at)]] = _OUT
    # a mark goes on with what it stands on: a run of letters, or one letter; the last base decides
    base = np.maximum.accumulate(np.where(kind != _MARK, np.arange(len(kind)), 0))
    under = kind[np.concatenate([[0], base[:-1]])]
    goes_on = ((kind == _MARK) & (before != _OUT)) | (
        (kind == _SPACED) & ((before == _SPACED) | ((before == _MARK) & (under == _SPACED))))
    starts = at[(kind != _OUT) & ~goes_on]
    last = (kind != _OUT) & ~np.append(goes_on[1:], False)
    ends = np.append(at[1:], len(data))[last]
    return starts, ends, np.searchsorted(starts, offsets)


def _feature_parts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray,
                   bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word, feature) of all affix, n-gram and lexicon features of the words, some places at a time."""
    def numbered(x: np.ndarray) -> np.ndarray:
        return (x >> np.uint64(64 - bits)).astype(np.int64)

    yield np.arange(len(starts)), numbered(words.mix(hashes ^ np.uint64(0xA5)))
    sizes = ends - starts + 2  # with a mark before and behind
    bounds = np.concatenate([[0], np.cumsum(sizes)])
    for a in range(0, int(bounds[-1]), _PLACES):
        z = min(a + _PLACES, int(bounds[-1]))
        place = np.arange(a, min(z + max(_SIZES) - 1, int(bounds[-1])))
        word = np.searchsorted(bounds, place, "right") - 1
        inner = place - bounds[word]
        left = sizes[word] - inner
        symbol = words.LOWER[data[np.clip(starts[word] + inner - 1, 0, len(data) - 1)]].astype(np.uint64) + np.uint64(1)
        symbol[inner == 0] = 300
        symbol[left == 1] = 301
        for size in _SIZES:
            n = min(z - a, len(place) - size + 1)
            if n <= 0:
                continue
            grams = np.zeros(n, np.uint64)
            for k in range(size):
                grams = grams * np.uint64(1000003) + symbol[k:n + k]
            grams *= np.uint64(8)
            whole = np.flatnonzero(left[:n] >= size)
            yield word[whole], numbered(words.mix(grams[whole] + np.uint64(size)))
            enough = sizes[word[:n]] > size
            for tag, there in ((5, (inner[:n] == 0) & enough), (6, (left[:n] == size) & enough)):
                there = np.flatnonzero(there)
                yield word[there], numbered(words.mix((grams[there] + np.uint64(tag)) ^ np.uint64(size)))


def features(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray,
             bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(word, feature) of all affix, n-gram and lexicon features of the words."""
    parts = list(_feature_parts(data, starts, ends, hashes, bits))
    return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


@dataclass
class Field:
    languages: list[str]
    weights: np.ndarray      # 2^bits x languages
    moves: np.ndarray        # languages x languages
    bits: int

    def states(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
               hashes: np.ndarray) -> np.ndarray:
        """State score of each word for each language; each distinct word is looked at once."""
        _, first, back = np.unique(hashes, return_index=True, return_inverse=True)
        out = np.zeros((len(first), len(self.languages)))
        for a in range(0, len(first), 50_000):
            some = first[a:a + 50_000]
            for owner, feature in _feature_parts(data, starts[some], ends[some], hashes[some], self.bits):
                for label in range(len(self.languages)):
                    out[a:a + len(some), label] += np.bincount(owner, self.weights[feature, label], len(some))
        return out[back]

    def marginals(self, states: np.ndarray, firsts: np.ndarray) -> np.ndarray:
        """Probability of each language for each word, texts side by side, by forward-backward."""
        return forward_backward(states, self.moves, firsts)[0]


def forward_backward(states: np.ndarray, moves: np.ndarray,
                     firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of each word, and the expected count of each move summed over all texts.

    Texts are walked together, longest first, so a step works on all that are still going on.
    """
    if not len(states):
        return states, np.zeros_like(moves)
    lengths = np.diff(firsts)
    order = np.argsort(-lengths, kind="stable")
    begin, lengths = firsts[:-1][order], lengths[order]
    longest = int(lengths[0])
    going = np.searchsorted(-lengths, -np.arange(longest), "left")  # texts longer than t
    e = np.exp(states - states.max(axis=1, keepdims=True))
    t = np.exp(moves - moves.max())
    alpha = np.empty_like(e)
    now = e[begin[:going[0]]]
    now /= now.sum(axis=1, keepdims=True)
    alpha[begin[:going[0]]] = now
    for k in range(1, longest):
        at = begin[:going[k]] + k
        now = (now[:going[k]] @ t) * e[at]
        now /= now.sum(axis=1, keepdims=True)
        alpha[at] = now
    marginal = np.empty_like(e)
    counts = np.zeros_like(moves)
    last = np.ones((len(begin), e.shape[1]))
    for k in range(longest - 1, -1, -1):
        m = going[k]
        at = begin[:m] + k
        if k + 1 < longest:
            more = going[k + 1]
            ahead = e[at[:more] + 1] * last[:more]
            joint = alpha[at[:more]][:, :, None] * t[None] * ahead[:, None, :]
            counts += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
            back = ahead @ t.T
            last[:more] = back / back.sum(axis=1, keepdims=True)
        both = alpha[at] * last[:m]
        marginal[at] = both / both.sum(axis=1, keepdims=True)
    return marginal, counts


def _splice(firsts: np.ndarray, label: np.ndarray, count: int, length: int,
            rng: np.random.Generator) -> tuple[np.ndarray, np.ndarray]:
    """Word numbers and labels of ``count`` sequences of runs from texts, switching now and then."""
    rows, truth = [], []
    usable = np.flatnonzero(np.diff(firsts) > 0)
    kinds = [usable[label[usable] == k] for k in np.unique(label[usable])]
    for _ in range(count):
        have = 0
        while have < length:
            own = kinds[rng.integers(len(kinds))]
            text = own[rng.integers(len(own))]
            a, z = firsts[text], firsts[text + 1]
            run = min(int(rng.integers(4, 25)), z - a, length - have)
            at = int(rng.integers(a, z - run + 1))
            rows.append(np.arange(at, at + run))
            truth.append(np.full(run, label[text]))
            have += run
    return np.concatenate(rows), np.concatenate(truth)


def fit(texts: pa.Array, labels: list[str], *, bits: int = 16, sequences: int = 4000, length: int = 48,
        passes: int = 4, batch: int = 100, rate: float = 0.05, decay: float = 1e-5, seed: int = 3) -> Field:
    """Maximise the conditional likelihood of spliced sequences by AdaGrad."""
    languages = sorted(set(labels))
    data, offsets = words.text_bytes(texts)
    starts, ends, firsts = find_units(data, offsets)
    field = Field(languages, np.zeros((1 << bits, len(languages))), np.zeros((len(languages),) * 2), bits)
    if not len(starts):
        return Field([], field.weights[:, :0], field.moves[:0, :0], bits)
    label = np.array([languages.index(x) for x in labels])
    hashes = words.hash_words(data, starts, ends)
    rng = np.random.default_rng(seed)
    square, square_m = np.full_like(field.weights, 1e-6), np.full_like(field.moves, 1e-6)
    for _ in range(passes):
        rows, truth = _splice(firsts, label, sequences, length, rng)
        for s in range(0, len(rows), batch * length):
            at, y = rows[s:s + batch * length], truth[s:s + batch * length]
            n = len(at) // length
            bounds = np.arange(n + 1) * length
            owner, feature = features(data, starts[at], ends[at], hashes[at], bits)
            states = np.stack([np.bincount(owner, field.weights[feature, k], len(at))
                               for k in range(len(languages))], axis=1)
            marginal, moves = forward_backward(states, field.moves, bounds)
            marginal[np.arange(len(at)), y] -= 1
            touched, place = np.unique(feature, return_inverse=True)
            grad = np.stack([np.bincount(place, marginal[owner, k], len(touched))
                             for k in range(len(languages))], axis=1) / n + decay * field.weights[touched]
            square[touched] += grad ** 2
            field.weights[touched] -= rate * grad / np.sqrt(square[touched])
            steps = np.setdiff1d(np.arange(1, len(at)), bounds)
            np.subtract.at(moves, (y[steps - 1], y[steps]), 1)
            moves = moves / n + decay * field.moves
            square_m += moves ** 2
            field.moves -= rate * moves / np.sqrt(square_m)
    return field


def learn_from(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang",
               sample_rows: int = 3000, **options) -> Field:
    """Fit on at most ``sample_rows`` texts with a label that are not held out."""
    rows = (docs.where(F.col(lang).isNotNull() & F.col(text).isNotNull() & F.col(key).isNotNull()
                       & ~held_out(F.col(key)))
            .select(F.col(key).cast("long").alias("key"), F.col(lang).cast("string").alias("lang"),
                    F.xxhash64(F.col(key).cast("long")).alias("h"))
            .orderBy("h", "key").limit(sample_rows))
    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text")) \
        .join(F.broadcast(rows), "key")  # at most `sample_rows` small rows
    table = picked.select("key", "lang", "text").orderBy("key").toArrow()
    return fit(table.column("text").combine_chunks(), table.column("lang").to_pylist(), **options)


def _labelled(block: pa.RecordBatch, field: Field):
    """Words of a block, their marginals, and the first word of each text."""
    data, offsets = words.text_bytes(block.column("text"))
    starts, ends, firsts = find_units(data, offsets)
    hashes = words.hash_words(data, starts, ends)
    return starts, ends, firsts, offsets, field.marginals(field.states(data, starts, ends, hashes), firsts)


def label_texts(docs: DataFrame, field: Field, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: key, held_out, lang_pred, score, and n_spans (runs of words of one language)."""
    shipped = docs.sparkSession.sparkContext.broadcast(field)  # fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        names = np.array([*model.languages, "und"], object)
        for block in shared.blocks(batches, "text"):
            share = np.zeros((block.num_rows, len(model.languages)))
            spans = np.zeros(block.num_rows, np.int64)
            some = np.array([bool(x and model.languages and _LETTER.search(x))
                             for x in block.column("text").to_pylist()])
            if some.any():
                starts, ends, firsts, _, marginal = _labelled(block, model)
                owner = np.repeat(np.arange(block.num_rows), np.diff(firsts))
                for k in range(len(model.languages)):
                    share[:, k] = np.bincount(owner, marginal[:, k] * (ends - starts), block.num_rows)
                best = marginal.argmax(axis=1)
                new = np.ones(len(best), bool)
                new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
                spans = np.bincount(owner, new, block.num_rows).astype(np.int64)
                share /= np.maximum(share.sum(axis=1, keepdims=True), 1e-300)
            top = share.argmax(axis=1) if share.shape[1] else np.zeros(block.num_rows, np.int64)
            score = np.where(some, share.max(axis=1) if share.shape[1] else 0.0, 0.0)
            yield pa.RecordBatch.from_arrays(
                [block.column("key"), pa.array(names[np.where(some, top, len(model.languages))], pa.string()),
                 pa.array(np.clip(score, 0, 1)), pa.array(np.where(some, spans, 0))],
                names=["key", "lang_pred", "score", "n_spans"])

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "key long, lang_pred string, score double, n_spans long").select(
        F.col("key").alias(key), held_out(F.col("key")).alias("held_out"), "lang_pred", "score", "n_spans")


def label_spans(docs: DataFrame, field: Field, *, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row a run of words of one language: key, start and end (bytes of the UTF-8 text), lang."""
    shipped = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shipped.value
        for block in shared.blocks(batches, "text"):
            starts, ends, firsts, offsets, marginal = _labelled(block, model)
            if not len(starts) or not model.languages:
                continue
            owner = np.repeat(np.arange(block.num_rows), np.diff(firsts))
            best = marginal.argmax(axis=1)
            new = np.ones(len(best), bool)
            new[1:] = (best[1:] != best[:-1]) | (owner[1:] != owner[:-1])
            a = np.flatnonzero(new)
            z = np.append(a[1:], len(best)) - 1
            yield pa.RecordBatch.from_arrays(
                [block.column("key").take(pa.array(owner[a])), pa.array(starts[a] - offsets[owner[a]]),
                 pa.array(ends[z] - offsets[owner[a]]),
                 pa.array([model.languages[k] for k in best[a].tolist()])],
                names=["key", "start", "end", "lang"])

    picked = docs.select(F.col(key).cast("long").alias("key"), F.col(text).cast("string").alias("text"))
    return picked.mapInArrow(run, "key long, start long, end long, lang string").withColumnRenamed("key", key)
