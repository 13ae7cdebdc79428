"""Toxicity scores (operator 6): a subsequence string-kernel support vector machine with
Nystroem landmarks.

Strings are words: a white-space token in lower case without its punctuation, between two
end marks; a run of four or more single characters ("s p a c e d") is one word too. Letters of
all scripts are told apart: a triple of Latin letters and digits has a weight of its own,
one with other letters shares a table of hashed triples. The kernel counts common subsequences of three characters, each occurrence discounted by the
characters it skips (up to two), so inserted and gapped characters cost a little and not
everything.

Labels are known for documents only. Each different sentence of the sample has its
document's label (clean, if any clean document has it), and a toxic one is represented by
its witness words, those that are common in toxic and rare in clean sentences; each
witness also trains with a character inserted. Words of clean sentences are
negatives; those that score worst are added in rounds. The machine is linear in the
kernel's values at the landmarks, and so is one weight per character triple. A document's
probability is a logistic function of its worst word's margin, of the (soft) number of
its words beyond the margin, and of their share, fitted on the sample.

It is fitted on at most ``SAMPLE`` labelled documents of each label, the smallest by a
hash of the id; every document is scored, whole. Cases: null, empty and wordless texts
have the score of a word without evidence; without labelled rows of both kinds all
scores are 0; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm import _labels
from candleworks.llm._store import written
from candleworks.llm._words import _buffers, make_room, mix, release

SAMPLE = 2000
NEGATIVE_WORDS = 40_000
WITNESS_WORDS = 1500
#: Toxic sentences that a witness has, per toxic document of the sample.
WITNESS_SHARE = 0.01
LANDMARKS = 256
ROUNDS = 4
#: Price of a violated margin, and the share of it for a witness's variant.
COST = 10.0
VARIANT_COST = 0.3
#: How much more frequent a witness is in toxic sentences.
LIFT = 8
#: Bytes of text that are scored together; whole texts, so no score depends on it.
CHUNK = 1 << 17
DECAY = 0.6
#: Distances between the three characters of a subsequence.
STEPS = ((1, 1), (1, 2), (2, 1), (1, 3), (2, 2), (3, 1))
#: Symbols whose triples have a weight of their own; triples with others share as many hashed ones.
SYMBOLS = 32
TRIPLES = 2 * SYMBOLS ** 3
#: Code points from here on have no upper case.
CASED = 0x20000


def _symbols() -> np.ndarray:
    """Symbol of each code point: 0 ends a word, 1-26 letters, 27 digits, from 32 on other
    letters and digits (one symbol each, in lower case); -1 white space, -2 dropped."""
    out = np.full(CASED, -2, dtype=np.int32)
    for i in range(128, CASED):
        c = chr(i)
        if c.isspace():
            out[i] = -1
        elif unicodedata.category(c)[0] in "LNM":
            low = ord(c.lower()[0])
            out[i] = SYMBOLS + low if low >= 128 else low - 96
    out[[0x20, *range(9, 14)]] = -1
    out[48:58] = 27
    out[65:91] = np.arange(1, 27)
    out[97:123] = np.arange(1, 27)
    return out


_SYMBOL = _symbols()


def _points(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Code points of UTF-8 bytes, and the texts' offsets in them."""
    if len(data) == 0 or data.max() < 128:
        return data, off
    lead = (data & 0xC0) != 0x80
    at = np.flatnonzero(lead)
    point = data[at].astype(np.uint32)
    more = np.concatenate([data & 0x3F, np.zeros(3, np.uint8)]).astype(np.uint32)
    for least, below, mask, n in ((0xC0, 0xE0, 0x1F, 1), (0xE0, 0xF0, 0x0F, 2), (0xF0, 0x100, 0x07, 3)):
        long = np.flatnonzero((data[at] >= least) & (data[at] < below))
        value = point[long] & mask
        for k in range(1, n + 1):
            value = (value << 6) | more[at[long] + k]
        point[long] = value
    return point, np.concatenate([[0], np.cumsum(lead)])[off]


def _codes(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Where the weight of each triple of symbols stands."""
    code = (a * SYMBOLS + b) * SYMBOLS + c
    other = np.flatnonzero((a >= SYMBOLS) | (b >= SYMBOLS) | (c >= SYMBOLS))
    if len(other):
        x, y, z = (v[other].astype(np.uint64) for v in (a, b, c))
        hashed = mix((x << np.uint64(42)) | (y << np.uint64(21)) | z)
        code[other] = SYMBOLS ** 3 + (hashed % np.uint64(TRIPLES - SYMBOLS ** 3)).astype(np.int64)
    return code


def _strings(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Symbols of all words of some texts, each word from one end mark to the next; where
    words start in them; and the text of each word."""
    data, off = _points(data, off)
    symbol = _SYMBOL[data] if data.dtype == np.uint8 else np.where(
        data < CASED, _SYMBOL[np.minimum(data, CASED - 1)], data.astype(np.int32) + SYMBOLS)
    text = np.repeat(np.arange(len(off) - 1), np.diff(off))
    solid = symbol > 0
    gap = np.concatenate([[0], np.cumsum(symbol == -1)])[:-1]
    s, t, g = symbol[solid], text[solid], gap[solid]
    if len(s) == 0:
        return np.zeros(0, np.int32), np.zeros(0, np.int64), np.zeros(0, np.int64)
    begin = np.flatnonzero(np.concatenate([[True], (g[1:] != g[:-1]) | (t[1:] != t[:-1])]))
    owner, length = t[begin], np.diff(np.concatenate([begin, [len(s)]]))
    # Runs of four or more single characters are a word as well.
    single = length == 1
    edge = np.flatnonzero(np.diff(np.concatenate([[0], single.astype(np.int8), [0]])))
    extra = []
    for a, b in zip(edge[::2], edge[1::2]):
        run = np.split(np.arange(a, b), np.flatnonzero(np.diff(owner[a:b])) + 1)
        extra += [(s[begin[r]], owner[r[0]]) for r in run if len(r) >= 4]
    if extra:
        s = np.concatenate([s, *[e for e, _ in extra]])
        begin = np.concatenate([begin, len(s) - np.cumsum([len(e) for e, _ in extra][::-1])[::-1]])
        owner = np.concatenate([owner, [o for _, o in extra]])
        length = np.concatenate([length, [len(e) for e, _ in extra]])
    out = np.zeros(len(s) + len(begin) + 1, dtype=np.int32)
    out[np.arange(len(s)) + np.repeat(np.arange(len(begin)), length) + 1] = s
    return out, begin + np.arange(len(begin)), owner


def _occurrences(symbols: np.ndarray, begin: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, float]]:
    """Word, subsequence code and weight of every occurrence, per pair of steps."""
    word = np.repeat(np.arange(len(begin)), np.diff(np.concatenate([begin, [len(symbols) - 1]])))
    first = symbols[:-1].astype(np.int64)
    stop = np.concatenate([begin[1:], [len(symbols) - 1]])[word]  # where the word's closing mark stands
    for a, b in STEPS:
        at = np.flatnonzero(np.arange(len(first)) + a + b <= stop)
        yield word[at], _codes(first[at], symbols[at + a], symbols[at + a + b]), DECAY ** (a + b - 2)


def _norms(begin: np.ndarray, end: int) -> np.ndarray:
    """Root of the summed squared weights of a word's occurrences, which depend on its length."""
    size = np.diff(np.concatenate([begin, [end]])) + 1
    return np.sqrt(sum(np.maximum(size - a - b, 0) * DECAY ** (2 * (a + b - 2)) for a, b in STEPS))


def word_values(symbols: np.ndarray, begin: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Sum over a word's occurrences of weight times ``weights[code]``, over its norm."""
    total = np.zeros(len(begin))
    for word, code, w in _occurrences(symbols, begin):
        total += np.bincount(word, weights[code], len(begin)) * w
    return total / np.maximum(_norms(begin, len(symbols) - 1), 1e-9)


def _features(words: list[str], columns: np.ndarray | None = None) -> np.ndarray:
    """Normalised subsequence counts of each word, one row per word; of all triples, or of
    those that ``columns`` names."""
    raw = [w.encode() for w in words]
    off = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    symbols, begin, owner = _strings(np.frombuffer(b"".join(raw), np.uint8), off)
    width = TRIPLES if columns is None else len(columns)
    place = np.full(TRIPLES, width)
    place[slice(None) if columns is None else columns] = np.arange(width)
    out = np.zeros((len(words), width), dtype=np.float32)
    for word, code, w in _occurrences(symbols, begin):
        named = place[code] < width
        np.add.at(out, (owner[word[named]], place[code[named]]), w)
    norm = np.ones(len(words))
    norm[owner] = _norms(begin, len(symbols) - 1)
    return out / np.maximum(norm, 1e-9)[:, None]


def _values_of(words: list[str], weights: np.ndarray) -> np.ndarray:
    raw = [w.encode() for w in words]
    symbols, begin, owner = _strings(np.frombuffer(b"".join(raw), np.uint8), np.concatenate([[0], np.cumsum([len(r) for r in raw])]))
    out = np.zeros(len(words))
    out[owner] = word_values(symbols, begin, weights)
    return out


def _svm(z: np.ndarray, y: np.ndarray, cost: np.ndarray, steps: int = 60) -> np.ndarray:
    """Weights (the last is the bias) of least norm and squared hinge loss, by Newton steps
    that are halved until the loss falls."""
    z = np.hstack([z, np.ones((len(z), 1))])
    w = np.zeros(z.shape[1])
    loss = lambda v: v @ v + cost @ np.maximum(0, 1 - y * (z @ v)) ** 2
    now = loss(w)
    for _ in range(steps):
        on = y * (z @ w) < 1
        a, c = z[on], cost[on]
        step = np.linalg.solve(np.eye(len(w)) + (a * c[:, None]).T @ a, (a * c[:, None]).T @ y[on]) - w
        size = 1.0
        while (new := loss(w + size * step)) > now and size > 1e-4:
            size /= 2
        if new > now * (1 - 1e-7):
            break
        w, now = w + size * step, new
    return w


def fit_words(positive: dict[str, int], negative: list[str]) -> tuple[np.ndarray, float]:
    """A weight per character triple and a bias, from witness words (with the number of
    their toxic sentences) and words of clean sentences."""
    seen = sorted(positive, key=lambda w: (-positive[w], w))
    good = seen + [v for w in seen for v in variant(w)]
    price = np.array([1.0] * len(seen) + [VARIANT_COST] * (len(good) - len(seen)))
    bad = negative[:4000]
    for r in range(ROUNDS):
        half = LANDMARKS // 2
        marks = _features(list(dict.fromkeys(good[:half] + bad[-half:])))
        used = np.flatnonzero(marks.any(axis=0))
        marks = marks[:, used]
        k = (marks @ marks.T).astype(np.float64)
        values, vectors = np.linalg.eigh(k)
        keep = values > 1e-4 * values.max()
        root = vectors[:, keep] / np.sqrt(values[keep])
        rows = good + bad
        z = np.vstack([_features(rows[i:i + 500], used) @ marks.T for i in range(0, len(rows), 500)]).astype(np.float64) @ root
        y = np.array([1.0] * len(good) + [-1.0] * len(bad))
        cost = COST * np.concatenate([price * len(bad) / len(good) / 4, np.ones(len(bad))])
        w = _svm(z, y, cost)
        weights, bias = np.zeros(TRIPLES), float(w[-1])
        weights[used] = marks.T.astype(np.float64) @ (root @ w[:-1])
        if r + 1 < ROUNDS:
            worst = _values_of(negative, weights)
            known = set(bad)
            bad = bad + [w for w in (negative[i] for i in np.argsort(-worst, kind="stable")[:1500]) if w not in known]
    return weights, bias


def variant(word: str) -> list[str]:
    """The word with a character inserted, at a place that the word fixes."""
    at = 1 + sum(map(ord, word)) % max(len(word) - 2, 1)
    return [word[:at] + "x" + word[at:]] if len(word) >= 4 else []


class Model:
    """Scores of texts: word weights and bias, and the logistic that makes probabilities."""

    def __init__(self, weights: np.ndarray, bias: float) -> None:
        self.weights, self.bias = weights.astype(np.float64), bias
        self.slopes = np.zeros(4)

    def evidence(self, column: pa.Array) -> np.ndarray:
        """Per text: the worst margin, the soft number of words beyond it, their share, and 1."""
        make_room("toxicity")
        off, raw = _buffers(column)
        worst, many, words = np.full(len(column), self.bias), np.zeros(len(column)), np.zeros(len(column))
        a = 0
        while a < len(column):
            b = min(len(column), max(a + 1, int(np.searchsorted(off, off[a] + CHUNK, side="right")) - 1))
            symbols, begin, owner = _strings(raw[off[a]:off[b]], off[a:b + 1] - off[a])
            if len(begin):
                margin = word_values(symbols, begin, self.weights) + self.bias
                np.maximum.at(worst, a + owner, margin)
                many += np.bincount(a + owner, 1 / (1 + np.exp(-8 * margin)), len(column))
                words += np.bincount(a + owner, minlength=len(column))
            a = b
        release()
        return np.stack([worst, np.log1p(many), many / np.maximum(words, 1), np.ones(len(column))], axis=1)

    def scores(self, column: pa.Array) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.evidence(column) @ self.slopes, -50, 50)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Slopes of the likeliest logistic, lightly drawn to zero."""
    scale = np.maximum(x.std(axis=0), 1e-6)
    scale[-1] = 1
    z, w = x / scale, np.zeros(x.shape[1])
    for _ in range(80):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve(z.T @ (z * (weight * p * (1 - p))[:, None]) + 0.05 * np.eye(len(w)), z.T @ (weight * (y - p)) - 0.05 * w)
        w = w + step * min(1, 5 / np.abs(step).max())
        if np.abs(step).max() < 1e-8:
            break
    return w / scale


_SENTENCE_END = re.compile(r"[.!?\n]+(?=\s|$)|\n+")


def _sentences(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The sentences of every labelled text: a hash, the label and the different words, in
    lower case and without punctuation."""
    make_room("toxicity")
    for batch in batches:
        for y, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            parts = _SENTENCE_END.split(text or "")
            words = [sorted({w for t in p.split() if (w := "".join(c.lower()[0] for c in t if unicodedata.category(c)[0] in "LNM"))}) for p in parts]
            keys = [int.from_bytes(hashlib.blake2b(" ".join(w).encode(), digest_size=8).digest(), "little", signed=True) for w in words]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array([y] * len(parts), pa.int32()), pa.array(words, pa.list_(pa.string()))],
                                             names=["key", "_y", "words"])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        folds: int = 4, held_out: int = 2, sample: int = SAMPLE) -> Model | None:
    """A model from at most ``sample`` labelled documents of each label outside the held-out fold."""
    rows = _labels.training(labels, id_col, label_col, folds, held_out)
    all_sizes = {r[0]: r[1] for r in rows.groupBy("_y").count().collect()}
    if len(all_sizes) < 2:
        return None
    chosen = None
    for y in (0, 1):
        part = rows.where(F.col("_y") == y).orderBy(F.xxhash64("_id"), "_id").limit(sample)
        chosen = part if chosen is None else chosen.unionByName(part)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).join(F.broadcast(chosen), "_id")
    texts = written(texts.select("_y", "_text"), "toxicity-sample")
    sentences = texts.mapInArrow(_sentences, "key bigint, _y int, words array<string>").where(F.size("words") > 0)
    sentences = written(sentences.groupBy("key").agg(F.min("_y").alias("_y"), F.first("words").alias("words")), "toxicity-sentences")
    sizes = {r[0]: r[1] for r in sentences.groupBy("_y").count().collect()}
    if len(sizes) < 2:
        return None
    counts = sentences.select("_y", F.explode("words").alias("word")).groupBy("word").agg(
        F.sum("_y").alias("t"), F.sum(1 - F.col("_y")).alias("c"))
    odd = (F.col("t") >= max(3, WITNESS_SHARE * min(all_sizes[1], sample))) & (F.col("t") / sizes[1] >= LIFT * (F.col("c") + 0.5) / (sizes[0] + 0.5))
    counts = written(counts, "toxicity-words")
    positive = {r[0]: r[1] for r in counts.where(odd).orderBy(F.desc("t"), "word").limit(WITNESS_WORDS).select("word", "t").collect()}
    negative = [r[0] for r in counts.where("c >= 1").where(~odd).orderBy(F.xxhash64("word"), "word").limit(NEGATIVE_WORDS).select("word").collect()]
    if not positive or not negative:
        return None
    model = Model(*fit_words(positive, negative))

    def evidence(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(model.evidence(batch.column(1))), pa.list_(pa.float64()))], names=["_y", "x"])

    got = texts.mapInArrow(evidence, "_y int, x array<double>").collect()
    y = np.array([r[0] for r in got], dtype=float)
    seen = {v: max((y == v).sum(), 1) for v in (0, 1)}
    model.slopes = _logistic(np.array([r[1] for r in got]), y, np.array([all_sizes[int(v)] / seen[int(v)] for v in y]))
    return model


def score(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col`` and ``score`` of every row."""
    if model is None:
        return docs.select(id_col, F.lit(0.0).alias("score"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(batch.column(1)))], names=[id_col, "score"])

    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {docs.schema[id_col].dataType.simpleString()}, score double")


def below(docs: DataFrame, model: Model | None, bound: float, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that score below ``bound``, with all their columns."""
    if model is None:
        return docs
    at = docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(model.scores(batch.column(at)) < bound))

    return docs.mapInArrow(run, docs.schema)
