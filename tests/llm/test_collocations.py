"""Collocations against a plain count of every phrase, and on nulls, long texts, ties and empty tables."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from candleworks.llm import collocations as col
from candleworks.llm._store import workers_find_package

SCHEMA = "doc_id bigint, text string, lang string, phrase string, k string, f string, score string, rank string"


@pytest.fixture(scope="module")
def sp(spark):
    workers_find_package(spark)
    return spark


def frame(sp, docs):
    return sp.createDataFrame([(i, t, lang, "x", "y", "z", "s", "r") for i, t, lang in docs], SCHEMA)


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def plain_counts(docs, longest=3):
    f, n = Counter(), Counter()
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang or "und"] += len(words)
            for k in range(1, longest + 1):
                f.update((lang or "und", tuple(words[i:i + k])) for i in range(len(words) - k + 1))
    return f, n


def plain(docs, longest=3, least=10, top=2000):
    f, n = plain_counts(docs, longest)
    candidates = [(p, a) for p, a in f.items() if len(p[1]) > 1 and a >= least]
    inside = lambda s, t: any(t[i:i + len(s)] == s for i in range(len(t) - len(s) + 1))
    out = {}
    for (lang, words), a in candidates:
        if any(x == lang and len(t) > len(words) and inside(words, t) and 100 * b >= 50 * a for (x, t), b in candidates):
            continue
        cuts = [(10**6 * a * a // (f[lang, words[:k]] * f[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), f[lang, words[:k]], f[lang, words[k:]]))
    return sorted((lang, i, p.decode(), -a, left, right, n[lang], -s) for lang, rows in out.items()
                  for i, (s, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def corpus(seed, docs=260):
    rng = random.Random(seed)
    # Few words with a steep fall, so that many phrases lie around the bound and the sample errs.
    words = [f"w{i}" for i in range(45)] + ["Été", "中文", "İx", "B-c", "it's"]
    pick = lambda: words[min(int(rng.expovariate(0.12)), len(words) - 1)]
    out = []
    for i in range(docs):
        text = "".join(pick() + rng.choice([" ", " ", " ", " ", "\t ", ". ", ",", "\n", " ? ", "  "]) for _ in range(rng.randrange(60)))
        out.append((i, text, rng.choice(["en", "en", "en", "de", None, "und"])))
    return out + [(900, None, "en"), (901, "", "de"), (None, "w1 W2 w3 w4", "en"), (902, " . , ", "xx"), (3, out[3][1], out[3][2])]


@pytest.mark.parametrize("seed", [1, 2])
def test_collocations_are_the_plain_ones(sp, seed):
    docs = corpus(seed)
    got = sorted(map(tuple, col.collocations(frame(sp, docs).repartition(5)).collect()))
    assert got == plain(docs) and len(got) > 50


def test_every_frequent_phrase_is_counted_whole(sp):
    docs = corpus(4)
    f, n = plain_counts(docs)
    rows = col.mine(frame(sp, docs)).collect()
    got = [(r.lang, tuple(r.phrase.split(" "))) for r in rows if r.phrase is not None]
    assert len(got) == len(set(got)) and {(r.lang, tuple(r.phrase.split(" "))): r.f for r in rows if r.phrase is not None} == {p: a for p, a in f.items() if a >= 10}
    assert {r.lang: r.f for r in rows if r.phrase is None} == {x: a for x, a in n.items() if x != "xx"}


def test_longer_phrases_ties_and_top(sp):
    docs = [(i, "one two three four. Alpha beta; alpha beta. gamma delta, q r s t", "en") for i in range(12)]
    docs += [(i, "alpha x beta y", "en") for i in range(100, 109)]
    got = sorted(map(tuple, col.collocations(frame(sp, docs), longest=4, top=3).collect()))
    assert got == plain(docs, longest=4, top=3)
    assert [r[2] for r in got] == ["gamma delta", "one two three four", "q r s t"]


def test_what_the_sample_misses_is_found_by_expansion(sp, monkeypatch):
    # No document is in the sample: everything is a failure of the (empty) proposal's border.
    docs = [(i, "red green blue. red green", "en") for i in range(10)]
    monkeypatch.setattr(col, "SAMPLE_ONE_OF", 10**9)
    assert sorted(map(tuple, col.collocations(frame(sp, docs)).collect())) == plain(docs)


def test_empty_tables(sp):
    none = col.collocations(frame(sp, []))
    assert none.collect() == [] and none.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert col.collocations(frame(sp, [(1, None, None), (2, "a few words", "en")])).collect() == []


def test_slices_of_a_long_text_count_each_phrase_once():
    rng = random.Random(2)
    text = "".join(rng.choice(["ab", "c", "dd"]) + rng.choice([" ", "  \t", ". ", "\n", " " * 30]) for _ in range(300))
    want, _ = plain_counts([(1, text, "en")])
    data = np.frombuffer(text.encode(), np.uint8)
    for most in (1, 5, 17, 400, 10_000):
        got = Counter()
        for part, own in col.long_slices(data, most, 3):
            found = col.tokens(part, np.array([0, len(part)]))
            names = [w.decode() for w in found.names.to_pylist()]
            for _, lang, _, parts, count in col.count_chunk(found, np.array([0]), ["en"], 3, None, None, own):
                for i, c in enumerate(count.tolist()):
                    if c:
                        got["en", tuple(names[p[i]] for p in parts)] += c
        assert got == want


def test_the_bit_table_holds_what_was_put_in():
    rng = np.random.default_rng(1)
    h = rng.integers(0, 2**63, 500).astype(np.uint64)
    words = np.zeros(1 << 10, np.uint64)
    table = col.Proposal(words)
    for p in np.concatenate(table.places(h)).tolist():
        words[p >> 6] |= np.uint64(1 << (p & 63))
    assert table.has(h).all() and table.has(rng.integers(0, 2**63, 5000).astype(np.uint64)).mean() < 0.05


def test_a_chance_hit_of_the_bit_table_loses_nothing():
    docs = corpus(7)
    f, _ = plain_counts(docs)
    by_lang = {}
    for _, text, lang in docs:
        by_lang.setdefault(lang or "und", []).append(text or "")
    langs, rng = sorted(by_lang), np.random.default_rng(3)
    data = [(i, t.encode()) for i, lang in enumerate(langs) for t in by_lang[lang]]
    off = np.cumsum([0, *[len(t) for _, t in data]])
    found = col.tokens(np.frombuffer(b"".join(t for _, t in data), np.uint8), off)
    names = [w.decode() for w in found.names.to_pylist()]
    words, before, got = np.zeros(8, np.uint64), None, Counter()
    while not before or (before.words != ~np.uint64(0)).any():  # random bits: each pass admits by chance
        if before is not None:
            words = words | rng.integers(0, 2**63, 8).astype(np.uint64) * np.uint64(2) & rng.integers(0, 2**63, 8).astype(np.uint64) * np.uint64(2)
            if (words == before.words).all() or (np.bitwise_count(words).sum() > 400):
                words = np.full(8, ~np.uint64(0))
        now = col.Proposal(words)
        for _, lang, _, parts, count in col.count_chunk(found, np.array([i for i, _ in data]), langs, 3, now, before):
            for i in np.flatnonzero(count).tolist():
                phrase = langs[lang[i]], tuple(names[p[i]] for p in parts)
                assert phrase not in got
                got[phrase] = int(count[i])
        before = now
    assert got == f


def test_buckets_are_packed_and_merged(monkeypatch):
    import pyarrow as pa

    rng = np.random.default_rng(2)
    want, rows = Counter(), []
    for _ in range(30):
        keys = [f"la\nng{i % 3}\n" + f"w{i} é{i}" * (i % 7 > 0) for i in rng.integers(0, 200, 90).tolist()]
        count = rng.integers(1, 9, 90)
        for k, c in zip(keys, count.tolist()):
            want[k] += c
        bucket = np.array([sum(k.encode()) % 5 for k in keys], np.int32)
        rows += [o for out in col._packed(bucket, pa.array([k.encode() for k in keys], pa.large_binary()), count) for o in out.to_pylist()]
    rows.sort(key=lambda r: r["bucket"])
    monkeypatch.setattr(col, "MERGED_TOGETHER", 100)
    batches = [pa.RecordBatch.from_pylist(rows[a:a + 7]) for a in range(0, len(rows), 7)]
    got = [r for out in col._merge(batches, 60) for r in out.to_pylist()]
    assert {(r["lang"] + "\n" + (r["phrase"] or "")): r["f"] for r in got} == {k: c for k, c in want.items() if c >= 60 or k.endswith("\n")}
    assert all(r["k"] == (2 if r["phrase"] else 0) for r in got)
