"""The learned scores (quality, toxicity) against plain sums: statistics, normal equations, isotonic steps, kernel values."""

import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from candleworks.llm import _labels, quality, toxicity
from candleworks.llm._store import workers_find_package

SCHEMA = "doc_id bigint, text string, _x string, _y string, score string"


@pytest.fixture(scope="module")
def sp(spark):
    workers_find_package(spark)
    return spark


def some_texts(seed, n):
    rng = random.Random(seed)
    words = ["alpha", "Beta.", "x", "7", "été,", "gamma", "gamma", "#", "delta!", "it"]
    return [" ".join(rng.choice(words) for _ in range(rng.randrange(1, 60))) for _ in range(n)]


def test_statistics_by_hand():
    texts = [*some_texts(1, 30), "", None, " \n\t ", "a", "a a a a", "word " * 5000]
    got = quality.statistics(pa.array(texts))
    for row, text in zip(got, texts):
        text = text or ""
        words = text.split()
        n, count = len(words), Counter(words)
        triples = Counter(zip(words, words[1:], words[2:]))
        size = [len(w.encode()) for w in words]
        kinds = row[2:2 + quality.KINDS]
        want = [np.mean(size) if n else 0, np.std(size) if n else 0, len(count) / max(n, 1), max(count.values(), default=0) / max(n, 1),
                len(triples) / max(n - 2, 1), max(triples.values(), default=0) / max(n - 2, 1),
                sum(a == b for a, b in zip(words, words[1:])) / max(n, 1)]
        assert np.isclose(row[0], np.log1p(len(text.encode()))) and np.isclose(row[1], np.log1p(n))
        assert np.isclose(kinds.sum(), 1 if text else 0)
        assert np.allclose(row[2 + quality.KINDS:2 + quality.KINDS + 7], want, atol=1e-6)


def test_normal_equations_are_the_sums_over_all_rows(sp):
    texts = some_texts(2, 240)
    docs = sp.createDataFrame([(i, t, "a", "b", "c") for i, t in enumerate(texts)], SCHEMA).repartition(5)
    labels = sp.createDataFrame([(i, int(len(t) % 3 > 0)) for i, t in enumerate(texts)], "doc_id bigint, quality int")
    described = quality.describe(docs)
    model = quality.fit(described, labels)
    rows = described.join(_labels.training(labels, "doc_id", "quality", 3, 1), "_id").select("_id", "_x", "_y").collect()
    assert 100 < len(rows) < 240
    x, y = np.array([r._x for r in rows], dtype=float), np.array([r._y for r in rows], dtype=float)
    assert np.allclose(model.mean, x.mean(axis=0)) and np.allclose(model.spread, np.maximum(x.std(axis=0), 1e-6))
    z = model.features(x)
    size = quality.FEATURES + 1
    assert np.allclose(model.weights, np.linalg.solve(z.T @ z + quality.RIDGE * len(x) / quality.FEATURES * np.eye(size), z.T @ y), atol=1e-6)
    got = {r.doc_id: r.score for r in quality.score(described, model).collect()}
    assert np.allclose([got[r._id] for r in rows], model.scores(x)) and all(0 <= s <= 1 for s in got.values())


def test_cosines_stand_for_a_gaussian_kernel():
    rng = np.random.default_rng(4)
    x = rng.normal(size=(40, 24))
    model = quality.Model(np.zeros(24), np.ones(24))
    z = model.features(x)[:, :-1]
    spread = (quality.WIDTH * np.sqrt(24) / 2) ** 2
    want = np.exp(-((x[:, None] - x[None]) ** 2).sum(axis=2) / (2 * spread))
    assert np.abs(z @ z.T - want).max() < 0.3 and np.abs(z @ z.T - want).mean() < 0.06


def test_isotonic_steps_are_the_best_rising_ones():
    rng = np.random.default_rng(5)
    for _ in range(50):
        total = rng.integers(1, 9, 12).astype(float)
        good = np.minimum(rng.integers(0, 9, 12), total).astype(float)
        mean = lambda a, b: good[a:b + 1].sum() / total[a:b + 1].sum()
        want = [max(min(mean(a, b) for b in range(i, 12)) for a in range(i + 1)) for i in range(12)]
        assert np.allclose(quality.rising(total, good), want)


def plain_triples(word):
    """Weight of every triple of symbols of a word between its end marks, gaps counted by hand."""
    symbols = [0, *[27 if c.isdigit() else ord(c) - 96 for c in word], 0]
    out = Counter()
    for i in range(len(symbols)):
        for j in range(i + 1, len(symbols)):
            for k in range(j + 1, len(symbols)):
                if (j - i, k - j) in toxicity.STEPS:
                    out[symbols[i], symbols[j], symbols[k]] += toxicity.DECAY ** (k - i - 2)
    return out


def test_kernel_values_are_the_counted_subsequences():
    rng = random.Random(6)
    words = ["idiot", "id1ot", "idxiot", "a", "ab", "abc", "aaaa"] + ["".join(rng.choice("abcdeft1") for _ in range(rng.randrange(1, 12))) for _ in range(40)]
    got = toxicity._features(words)
    for row, word in zip(got, words):
        counted = plain_triples(word)
        value = {c: row[(c[0] * toxicity.SYMBOLS + c[1]) * toxicity.SYMBOLS + c[2]] for c in counted}
        scale = [value[c] / w for c, w in counted.items()]
        assert np.allclose(scale, scale[0], rtol=1e-4) and np.isclose(row.sum(), sum(value.values()), rtol=1e-4)
    # so kernels are the counted products, each word scaled by one number
    size = np.array([sum(plain_triples(w).values()) for w in words]) / got.sum(axis=1)
    for a in range(8):
        for b in range(8):
            x, y = plain_triples(words[a]), plain_triples(words[b])
            assert np.isclose(float(got[a] @ got[b]) * size[a] * size[b], sum(w * y[c] for c, w in x.items()), rtol=1e-3, atol=1e-6)
    near = lambda a, b: float(got[words.index(a)] @ got[words.index(b)])
    assert near("idiot", "idxiot") > near("idiot", "abc") and near("idiot", "id1ot") > near("idiot", "aaaa")


def test_scores_of_very_long_empty_and_null_texts():
    texts = ["", None, "word " * 400_000, "x" * 1_000_000]
    assert quality.statistics(pa.array(texts)).shape[0] == 4 and np.isfinite(quality.statistics(pa.array(texts))).all()
    rng = np.random.default_rng(7)
    model = toxicity.Model(rng.normal(size=toxicity.TRIPLES) / 100, -1.0)
    model.slopes = np.array([1.0, 0.1, 0.1, 0.0])
    got = model.scores(pa.array(texts))
    assert np.isfinite(got).all() and ((got >= 0) & (got <= 1)).all() and got[0] == got[1]
