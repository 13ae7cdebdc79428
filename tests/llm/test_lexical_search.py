"""Ranked lexical search against scoring every document, and on nulls, ties, long texts and empty tables."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from candleworks.llm import lexical_search as search
from candleworks.llm._store import workers_find_package

DOCS = "doc_id bigint, text string, score string, item string, rank string, term string, n string"
ITEMS = "item_id string, text string, doc_id string, term string"


@pytest.fixture(scope="module")
def sp(spark):
    workers_find_package(spark)
    return spark


def docs_frame(sp, docs):
    return sp.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in docs], DOCS)


def items_frame(sp, items):
    return sp.createDataFrame([(i, t, "x", "y") for i, t in items], ITEMS)


def plain_terms(text):
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", low)


def plain(docs, items, top=10):
    held = [(i, Counter(plain_terms(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total = len(held), sum(sum(c.values()) for _, c in held)
    df = Counter(t for _, c in held for t in c)
    asked = {}
    for i, t in items:
        if i is not None:
            asked.setdefault(i, set()).update(plain_terms(t))
    out = []
    for item, terms in asked.items():
        scored = []
        for i, c in held:
            m = 100 - 90 + 90 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 8 * m)) for t in terms if c[t])
            if s > 0 and i is not None:
                scored.append((-s, i))
        out += [(item, k, i, -s) for k, (s, i) in enumerate(sorted(scored)[:top], 1)]
    return sorted(out)


def corpus(seed, docs=400, items=30):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(120)] + ["Été", "中文", "İx", "B-c", "it's", "9a_b"]
    pick = lambda: words[min(int(rng.expovariate(0.04)), len(words) - 1)]
    text = lambda n: "".join(pick() + rng.choice([" ", ", ", "\n", "--", ".", "/"]) for _ in range(n))
    rows = [(i, text(rng.choice([3, 10, 10, 60, 300]))) for i in range(docs)]
    rows += [(1000 + i, rows[5][1]) for i in range(30)]  # ties
    rows += [(2000, None), (2001, ""), (2002, " ,;! "), (None, "w1 w2 w3"), (7, "w90 w91 w92"), (2003, "w100 " * 3000)]
    asked = [(f"q{i}", text(rng.choice([1, 4, 40, 400]))) for i in range(items)] + [("none", "zzz yyy"), ("empty", None), (None, "w1"), ("q1", "w7 w8"), ("copy", rows[5][1]),
                                                                                   ("wide", " ".join(words) + " " + " ".join(f"w{i}" for i in range(119, -1, -1)))]
    return rows, asked


@pytest.mark.parametrize("seed", [1, 2])
def test_search_is_the_plain_ranking(sp, seed):
    docs, items = corpus(seed)
    got = search.search(docs_frame(sp, docs).repartition(4), items_frame(sp, items))
    assert got.schema["rank"].dataType.simpleString() == "int" and got.schema["score"].dataType.simpleString() == "bigint"
    assert sorted((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()) == plain(docs, items)


def test_items_in_several_blocks_and_another_top(sp, monkeypatch):
    docs, items = corpus(3, docs=150, items=12)
    monkeypatch.setattr(search, "BLOCK_BYTES", 6000)
    got = search.search(docs_frame(sp, docs), items_frame(sp, items), top=3)
    assert sorted((r.item_id, r.rank, r.doc_id, r.score) for r in got.collect()) == plain(docs, items, top=3)


def test_empty_tables(sp):
    docs, items = corpus(4, docs=10, items=2)
    for got in (search.search(docs_frame(sp, []), items_frame(sp, items)), search.search(docs_frame(sp, docs), items_frame(sp, [])),
                search.search(docs_frame(sp, [(1, None), (2, " . ")]), items_frame(sp, items)), search.search(docs_frame(sp, docs), items_frame(sp, [("a", None)]))):
        assert got.collect() == [] and got.columns == ["item_id", "rank", "doc_id", "score"]


def test_masks_of_more_than_64_terms_and_small_blocks():
    rng = np.random.default_rng(6)
    held = [np.sort(rng.choice(200, rng.integers(1, 90), replace=False)) for _ in range(500)]
    share = [rng.integers(1, 1000, len(h)) for h in held]
    wanted, weights = np.arange(0, 200, 2), rng.integers(1, 50, 100)
    by_term = np.zeros(200, np.int64)
    by_term[wanted] = weights
    exact = sorted((-int((by_term[h] * s).sum()), i) for i, (h, s) in enumerate(zip(held, share)))
    for size in (500, 37, 1):
        best, every = search.Best(10), np.zeros(200, np.int64)
        for a in range(0, 500, size):
            part = slice(a, a + size)
            first = np.concatenate([[0], np.cumsum([len(h) for h in held[part]])])
            search.Block(np.arange(500)[part], first, np.concatenate(held[part]), np.concatenate(share[part])).search(wanted, weights, every, best)
            assert not every.any()
        assert best.rows == exact[:10]


def test_slices_cut_no_term():
    text = " ".join(f"wörd{i}, X{i}" for i in range(500)).encode().lower()
    whole = search._TERM.findall(text)
    for most in (1, 3, 50, 10_000):
        assert [t for part in search.slices(text, most) for t in search._TERM.findall(part)] == whole


def test_length_measure_is_exact_past_64_bits():
    n, documents, total = 10**8, 10**12, 10**14
    assert search.lengths([n], documents, total).tolist() == [10 + 90 * n * documents // total]
