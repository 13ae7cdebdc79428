"""The training-text operators against brute force, and on nulls, empty and odd tables."""

import hashlib
import random
import re

import numpy as np
import pytest

import corpus_pipeline
from candleworks.llm import (bpe, components, decontaminate, exact_dedup, license_scan, line_dedup, ngram_join,
                             quality, queries, secret_scan, substring_dedup, toxicity)
from candleworks.llm._store import workers_find_package
from tests.conftest import SF_SMALL
from tests.helpers import multiset, rows

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, n_words string, kept string, score string"
BENCH = "item_id bigint, text string"


@pytest.fixture(scope="module")
def sp(spark):
    workers_find_package(spark)
    return spark


def texts():
    rng = random.Random(7)
    words = ["alpha", "beta", "gamma", "delta", "eta", "CC", "BY", "Ünï", "é"]
    make = lambda n: " ".join(rng.choice(words) + str(rng.randrange(40)) for _ in range(n))
    base, long = make(60), make(4000)
    out = [None, "", " \t\n", "one", "two words", base, base, base.replace(" ", "\t\t"), base + " tail", make(5) + " " + base + " " + make(5),
           long, long[: len(long) // 2], make(9), make(9), "x" * 30_000, "cc by\nCC-BY 4.0 all rights reserved", "a\nb\nc\nd\ne", "z\na\nb\nc\nd\ny",
           "a\nb\nc\na\nb\nc", "password = hunter22 AKIA" + "A1" * 10 + " " + "ab12" * 8]
    for n in (10, 11, 12, 19, 20, 21, 30):
        t = make(n).split()
        out += [" ".join(t), " ".join(t[:-1]), " ".join(t[1:]), " ".join([*t, "more"])]
    return out


@pytest.fixture(scope="module")
def docs(sp):
    return frame(sp, list(enumerate(texts())))


def frame(sp, pairs):
    return sp.createDataFrame([(i, t, "en", "s", 1, "x", "y", "z") for i, t in pairs], SCHEMA)


def by_id(df, key="doc_id"):
    return {r[key]: r.asDict() for r in df.collect()}


def test_exact_dedup_tells_texts_of_one_digest_apart(sp, docs):
    from pyspark.sql import functions as F

    want = {}
    for i, t in enumerate(texts()):
        want.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    for digest in (exact_dedup.sha256, lambda t: F.lit("same")):
        got = by_id(exact_dedup.decide(docs, digest=digest))
        for group in want.values():
            for i in group:
                assert (got[i]["keep_id"], got[i]["group_size"], got[i]["kept"]) == (group[0], len(group), i == group[0])


def test_exact_dedup_of_one_hot_text_and_null_ids(sp):
    got = exact_dedup.decide(frame(sp, [(i % 400, "hot") for i in range(800)] + [(None, "hot"), (None, "alone")])).collect()
    assert {(r.keep_id, r.group_size) for r in got if r.group_size > 1} == {(0, 801)}
    assert [r.kept for r in got if r.group_size == 1] == [True]


def test_bpe_is_the_library(sp, docs):
    from tokenizers import Tokenizer

    lib = Tokenizer.from_file(bpe.default_path())
    got = by_id(bpe.encode(docs, bpe.default_path()))
    for i, t in enumerate(texts()):
        ids = lib.encode(t or "", add_special_tokens=False).ids
        assert got[i]["ids"] == b"".join(x.to_bytes(4, "little") for x in ids)
        assert got[i]["decoded"] == lib.decode(ids, skip_special_tokens=False)


def test_bpe_of_odd_characters():
    from tokenizers import Tokenizer

    lib, enc, rng = Tokenizer.from_file(bpe.default_path()), bpe.Encoder(bpe.default_path()), random.Random(3)
    letters = "ab'sT 9.!\x1c\x85\t\n é́İΣς中🙂ﬁ"
    odd = ["".join(rng.choice(letters) for _ in range(rng.randrange(60))) for _ in range(500)] + ["x<|endoftext|>y<|startoftext|>"]
    split = [bpe.pieces_of(t) for t in odd]
    enc.learn(set().union(*split))
    for t, ids, shown in zip(odd, *enc.texts(split)):
        want = lib.encode(t, add_special_tokens=False).ids
        assert ids == b"".join(x.to_bytes(4, "little") for x in want) and shown == lib.decode(want, skip_special_tokens=False)


def test_licence_places(sp, docs):
    got = by_id(license_scan.summary(license_scan.scan(docs)))
    for i, t in enumerate(texts()):
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
        at = [(k, v) for p, v in license_scan.BASE_PHRASES.items() for k in range(len(words)) if words[k:k + len(p.split())] == p.split()]
        starts = [k for k, _ in at]
        assert (got[i]["n_words"], got[i]["n_base"], got[i]["first_word"], got[i]["last_word"]) == (
            len(words), len(at), min(starts, default=None), max(starts, default=None))
        assert got[i]["base_labels"] == ",".join(sorted({v for _, v in at})) and 0 <= got[i]["score"] <= 1


@pytest.mark.parametrize("text, value", [
    ("MIT OR GPL-3.0 AND ISC", ("(mit or (gpl-3.0 and isc))", 0)), ("(MIT or GPL-3.0) and gpl-2.0", ("((mit or gpl-3.0) and gpl-2.0)", 2)),
    ("GPL-2.0 WITH Classpath-exception-2.0 or", ("(gpl-2.0 with classpath-exception-2.0)", 1)), ("((MIT", ("mit", 0)), ("and MIT", None), ("", None)])
def test_licence_expressions(text, value):
    parts = license_scan.postfix(text.lower())
    got = license_scan.evaluate(parts) if parts else None
    assert (got and (got[0], got[2])) == value


@pytest.mark.parametrize("text, value", [
    ("MIT AND Artistic-2.0", ("(mit and artistic-2.0)", ["mit", "artistic-2.0"], 4)), ("Artistic-2.0 OR MIT", ("(artistic-2.0 or mit)", ["artistic-2.0", "mit"], 0)),
    ("MIT AND LicenseRef-Proprietary", ("(mit and licenseref-proprietary)", ["mit", "licenseref-proprietary"], 4)),
    ("GPL-2.0 WITH Linux-syscall-note", ("(gpl-2.0 with linux-syscall-note)", ["gpl-2.0"], 2)),
    ("DocumentRef-a.b:LicenseRef-x OR ISC", ("(documentref-a.b:licenseref-x or isc)", ["documentref-a.b:licenseref-x", "isc"], 0))])
def test_licence_expressions_of_unknown_identifiers(text, value):
    assert license_scan.evaluate(license_scan.postfix(text.lower())) == value
    machine = license_scan._automaton((("tag", license_scan.TAG, ""),))
    got = license_scan.scan_text(f"x\n# SPDX-License-Identifier: {text}\ny".encode(), machine)[3]
    assert [(g["expression"], g["rank"]) for g in got] == [(value[0], value[2])]
    assert license_scan.scan_text(b"an SPDX license identifier is needed", machine)[3] == []


def test_any_symbols_give_a_whole_expression():
    rng = random.Random(5)
    for _ in range(3000):
        parts = license_scan.postfix(" ".join(rng.choice(["mit", "gpl-2.0", "and", "or", "with", "llvm-exception", "(", ")", "foo"]) for _ in range(rng.randrange(9))))
        if parts:
            license_scan.evaluate(parts)


def test_secret_spans(sp, docs):
    got = by_id(secret_scan.scan(docs))
    all_rules = (*secret_scan.BASE_RULES, *secret_scan.MORE_RULES)
    for i, t in enumerate(texts()):
        want = sorted((m.start(), k, m.end()) for k, r in enumerate(all_rules)
                      for m in re.finditer(r.pattern, t or "", re.ASCII | (re.I if r.any_case else 0)) if len(m[r.group]) >= r.least)
        assert [(s["kind"], s["start"], s["end"]) for s in got[i]["spans"]] == [(all_rules[k].kind, a, b) for a, k, b in want]


def test_trigram_queries():
    assert secret_scan.trigram_query("AKIA[A-Z0-9]+") == ("and", ("aki", "kia"))
    assert secret_scan.trigram_query("[0-9a-f]+") is True


def test_near_copies_are_components(sp, docs):
    for n, percent in ((3, 90), (5, 80)):
        sets = []
        for t in texts():
            w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))
            sets.append({tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else {tuple(w)} if w else set())
        root = list(range(len(sets)))
        for _ in sets:
            for i, a in enumerate(sets):
                for j, b in enumerate(sets):
                    if a and b and 100 * len(a & b) >= percent * len(a | b):
                        root[i] = root[j] = min(root[i], root[j])
        got = by_id(ngram_join.join(docs, n=n, percent=percent))
        assert [(got[i]["n_shingles"], got[i]["component_id"]) for i in range(len(sets))] == [(len(s), r) for s, r in zip(sets, root)]


def test_every_link_of_a_group_of_near_copies(sp):
    base = [f"w{k}" for k in range(60)]
    some = [" ".join([*base, f"tail{i % 7}"]) for i in range(9)] + [" ".join(base[:59]), "else where"]
    sets = [{tuple(t.split()[k:k + 3]) for k in range(max(len(t.split()) - 2, 1))} for t in some]
    linked = {(i, j) for i, a in enumerate(sets) for j, b in enumerate(sets) if i != j and 100 * len(a & b) >= 90 * len(a | b)}
    df = frame(sp, list(enumerate(some)))
    _, found = ngram_join.links(df)
    assert {(r.a, r.b) for r in found.collect()} == {(i, j) for i, j in linked if i < j and not {i, j} & {7, 8}}
    got = by_id(ngram_join.join_links(df))
    assert [got[i]["n_links"] for i in range(11)] == [sum(a == i for a, _ in linked) for i in range(11)]


def test_subset_keys_meet_for_light_sets():
    import numpy as np

    a = np.arange(1, 12, dtype=np.uint64) * np.uint64(7919)
    for boundary in (12, 20):
        mine = set(ngram_join.subset_keys(a, ngram_join.subset_sizes(11, boundary, 90)).tolist())
        other = set(ngram_join.subset_keys(a[:-1], ngram_join.subset_sizes(10, boundary, 90)).tolist())
        assert mine & other


def test_chain_is_one_component(sp):
    links = sp.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (7, 7)], "a bigint, b bigint")
    got = {r.node: r.root for r in components.roots(links).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, 101: 100}


def repeated(units, size):
    """(document, position) of every unit that a window of an earlier start covers."""
    seen, gone = set(), set()
    for d, u in enumerate(units):
        for k in range(len(u) - size + 1):
            key = tuple(u[k:k + size])
            if key in seen:
                gone.update((d, k + i) for i in range(size))
            seen.add(key)
    return gone


def test_substring_dedup(sp, docs):
    for window in (20, 3):
        units = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts()]
        gone = repeated(units, window)
        got = by_id(substring_dedup.dedup(docs, window=window))
        for d, u in enumerate(units):
            kept = [w for k, w in enumerate(u) if (d, k) not in gone]
            assert (got[d]["n_words"], got[d]["n_removed"], got[d]["kept"]) == (len(u), len(u) - len(kept), " ".join(kept))


def test_line_dedup(sp, docs):
    units = [t.split("\n") if t else [] for t in texts()]
    gone = repeated(units, 3)
    got = by_id(line_dedup.dedup(docs))
    for d, u in enumerate(units):
        kept = [w for k, w in enumerate(u) if (d, k) not in gone]
        assert (got[d]["n_lines"], got[d]["n_removed"], got[d]["kept"]) == (len(u), len(u) - len(kept), "\n".join(kept))


def test_line_dedup_of_passages_by_words(sp):
    long, half = " ".join(f"w{k}" for k in range(50)), " ".join(f"h{k}" for k in range(25))
    some = [long, f"a\n{long}\nb", f"{half}\n{half}x\nc", f"d\n{half}\n{half}x", f"{half}\ne", f"{long}\n{long}"]
    got = by_id(line_dedup.dedup(frame(sp, list(enumerate(some))), words=50))
    assert [got[i]["kept"] for i in range(6)] == [long, "a\nb", some[2], "d", some[4], ""]
    assert [r["n_removed"] for r in by_id(line_dedup.dedup(frame(sp, list(enumerate(some))))).values()] == [0] * 6


def test_decontamination(sp, docs):
    base = texts()[5].split()
    items = sp.createDataFrame([(1, " ".join(base[5:40]).upper()), (2, None), (3, "two words"), (4, " ".join([*base[5:30], "q", "r", "s", "t", "u", "v", "w", "x"])), (1, " ".join(base[5:40]))], BENCH)
    got = {(r.doc_id, r.item_id) for r in decontaminate.find(docs, items).collect()}
    assert got == {(i, 1) for i in (5, 6, 7, 8, 9)} | {(4, 3)}
    assert decontaminate.find(docs, items.limit(0)).count() == 0
    assert sorted(r.doc_id for r in decontaminate.clean(docs, items).collect()) == [i for i in range(len(texts())) if i not in (4, 5, 6, 7, 8, 9)]


def classifier_docs(sp, words, n=240):
    rng = random.Random(1)
    out, labels = [], []
    for i in range(n):
        body = [rng.choice(["the", "house", "green", "water", "stone", "light", "seven", "road"]) + rng.choice(["", "s", "er", "ing"]) for _ in range(40)]
        if i % 3 == 0:
            body[10:10] = rng.sample(words, 2)
        out.append((i, " ".join(body) + "."))
        labels.append((i, int(i % 3 == 0), int(i % 3 == 0)))
    return frame(sp, out), sp.createDataFrame(labels, "doc_id bigint, quality int, toxic int")


def test_toxicity_held_out_and_gapped(sp):
    df, labels = classifier_docs(sp, ["blockhead", "numbskull", "nitwit", "dunderpate"])
    model = toxicity.fit(df, labels)
    got = {r.doc_id: r.score for r in toxicity.score(df, model).collect()}
    from candleworks.llm import _labels
    held = {r.doc_id for r in df.where(_labels.fold(df.doc_id, 4) == 2).collect()}
    assert held and all((got[i] >= 0.3) == (i % 3 == 0) for i in held)
    odd = frame(sp, [(0, "you b.l.o.c.k.h.e.a.d now"), (1, "a n u m b s k u l l here"), (2, "the green house"), (3, None), (4, "")])
    scores = {r.doc_id: r.score for r in toxicity.score(odd, model).collect()}
    assert scores[0] >= 0.3 and scores[1] >= 0.3 and max(scores[2], scores[3], scores[4]) < 0.3
    assert toxicity.fit(df, labels.where("toxic = 0")) is None


def test_letters_of_all_scripts_are_told_apart():
    import numpy as np
    import pyarrow as pa

    letters = [chr(i) for i in range(0x430, 0x450)]
    x = toxicity._features([a + b + c for a in letters[:8] for b in letters[8:16] for c in letters[16:20]])
    same = x @ x.T
    assert (same > 0.99).sum() == len(x)  # each is like itself only
    assert (toxicity._features(["ДУРАК", "Größe", "naïve", "𐐀b9"]) == toxicity._features(["дурак", "gröSSe".replace("SS", "ß"), "NAÏVE", "𐐨B9"])).all()
    bad, clean = {"дурак": 9, "болван": 9, "тупица": 9}, ["дорога", "рукава", "карьер", "бокал", "вокзал", "трубица", "молоко", "страница"]
    weights, bias = toxicity.fit_words(bad, clean)
    model = toxicity.Model(weights, bias)
    worst = model.evidence(pa.array(["они ДУРАК там", "это «болван»!", "т у п и ц а", "дорога и бокал", "вокзал, молоко", "a plain text", "", "𠀀𠀁𠀂𠀃"]))[:, 0]
    assert worst[:3].min() > max(worst[3:].max(), 0)


def test_quality_held_out(sp):
    df, labels = classifier_docs(sp, ["$$$", "###", "%%%", "&&&"])
    described = quality.describe(df)
    got = {r.doc_id: r.score for r in quality.score(described, quality.fit(described, labels)).collect()}
    from candleworks.llm import _labels
    held = {r.doc_id for r in df.where(_labels.fold(df.doc_id, 3) == 1).collect()}
    assert sum((got[i] >= 0.5) == (i % 3 == 0) for i in held) >= 0.9 * len(held)
    assert quality.fit(described, labels.limit(0)) is None


def test_rising_shares():
    import numpy as np

    assert quality.rising(np.array([2.0, 2, 2]), np.array([1.0, 0, 2])).tolist() == [0.25, 0.25, 1.0]


OPERATORS = {
    "licence": lambda d, b, lab: license_scan.summary(license_scan.scan(d)), "exact": lambda d, b, lab: exact_dedup.decide(d),
    "secret": lambda d, b, lab: secret_scan.summary(secret_scan.scan(d)), "bpe": lambda d, b, lab: bpe.digests(bpe.encode(d, bpe.default_path())),
    "quality": lambda d, b, lab: quality.score(quality.describe(d), quality.fit(quality.describe(d), lab)),
    "toxicity": lambda d, b, lab: toxicity.score(d, toxicity.fit(d, lab)), "near": lambda d, b, lab: ngram_join.join(d),
    "lines": lambda d, b, lab: line_dedup.dedup(d), "substring": lambda d, b, lab: substring_dedup.dedup(d)}


@pytest.mark.parametrize("name", OPERATORS)
def test_empty_table_and_null_or_repeated_rows(sp, name):
    labels = sp.createDataFrame([(0, 1, 0), (None, 0, 1), (1, None, None)], "doc_id bigint, quality int, toxic int")
    items = sp.createDataFrame([(None, "a b c d e f")], BENCH)
    some = frame(sp, [(0, "same text here"), (0, "same text here"), (None, "same text here"), (None, None), (1, "")])
    assert OPERATORS[name](some.limit(0), items, labels).count() == 0
    assert OPERATORS[name](some, items, labels).count() == 5
    assert decontaminate.find(some, items).count() == 0


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_sql(sp, duck, key):
    df = queries.queries()[key](sp, SF_SMALL)
    cur = duck.execute(queries.oracle_sql()[key])
    cols, want = [d[0] for d in cur.description], cur.fetchall()
    assert sorted(cols) == sorted(df.columns) and multiset(df.columns, rows(df)) == multiset(cols, want)


def kept_texts(df):
    return sorted((r.doc_id is None, r.doc_id or 0, r.text) for r in df.collect())


def test_repeated_and_null_ids_lose_no_text(sp):
    a, b, c = (" ".join(f"{x}{k}" for k in range(30)) for x in "abc")
    some = frame(sp, [(5, a), (5, b), (3, b), (9, a), (None, c), (None, c), (None, a), (7, "x"), (7, "x")])
    want = [(False, 3, b), (False, 5, a), (False, 7, "x"), (True, 0, c)]
    assert kept_texts(exact_dedup.keep_first(some)) == want
    from pyspark.sql import functions as F
    assert kept_texts(exact_dedup.keep_first(some, digest=lambda t: F.lit("same"))) == want
    near = some.unionByName(frame(sp, [(5, b + " tail"), (2, c + " tail"), (5, a + " more words")]))
    assert kept_texts(ngram_join.keep_one(near, n=5, percent=80)) in [
        [(False, 2, c + " tail"), (False, 3, b), (False, 5, first), (False, 7, "x")] for first in (a, a + " more words")]


def test_pipeline_stages_take_effect(sp):
    docs = sp.read.parquet(f"{SF_SMALL}/documents.parquet")
    kept = docs
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(sp, kept, SF_SMALL)
        assert out.columns == docs.columns
        kept = sp.createDataFrame(out.collect(), docs.schema)
    last = corpus_pipeline.run(sp, SF_SMALL)
    assert sorted(r.doc_id for r in last.collect()) == sorted(r.doc_id for r in kept.collect())
    texts_left = [hashlib.sha256(" ".join(r.text.split()).encode()).hexdigest() for r in kept.collect()]
    assert len(set(texts_left)) == len(texts_left) < docs.count()


ODD = "doc_id bigint, text string, _doc string, _row string, _leak string, _id string, body string"


def odd(sp, rows_):
    return sp.createDataFrame([(i, t, "a", "b", "c", "d", "e") for i, t in rows_], ODD)


def test_repeated_ids_of_different_texts_lose_nothing_in_line_dedup(sp):
    got = line_dedup.dedup(odd(sp, [(1, "\n".join(["x"] * 5)), (1, "x\ny"), (2, "a\nb\nc"), (2, "q\na\nb\nc"), (None, "a\nb\nc")])).collect()
    kept = {(r.doc_id, r.n_lines): r.kept for r in got}
    assert kept[1, 2] == "x\ny" and kept[1, 5] == "x" and kept[None, 3] == "a\nb\nc"
    assert sorted([kept[2, 3], kept[2, 4]]) in (["", "q\na\nb\nc"], ["a\nb\nc", "q"])


def test_repeated_ids_of_different_texts_lose_nothing_in_substring_dedup(sp):
    long = " ".join(f"w{i}" for i in range(100))
    short, other = "one two three", " ".join(f"v{i}" for i in range(60))
    got = substring_dedup.dedup(odd(sp, [(1, long), (1, short), (1, long), (2, long + " tail"), (3, other), (None, long)])).collect()
    kept = sorted((str(r.doc_id), r.n_words, r.n_removed) for r in got)
    assert kept == sorted([("1", 100, 0), ("1", 100, 0), ("1", 3, 0), ("2", 101, 100), ("3", 60, 0), ("None", 100, 0)])


def test_clean_judges_each_row_by_its_own_text(sp):
    item = "the quick brown fox jumps over the lazy dog again"
    words = item.split()
    bench = sp.createDataFrame([(1, item), (2, None), (None, "some other item of more words here")], BENCH)
    rows_ = [(1, f"x {item} y"), (1, "clean text"), (2, " ".join(words[:7])), (2, " ".join(words[4:])), (None, item), (None, "free"), (3, None), (4, "")]
    got = decontaminate.clean(odd(sp, rows_), bench)
    assert got.columns == [c.split()[0] for c in ODD.split(", ")]
    assert sorted(map(str, [(r.doc_id, r.text) for r in got.collect()])) == sorted(map(str, [r for r in rows_ if r[1] is None or item not in r[1]]))
    assert decontaminate.clean(odd(sp, rows_), bench.where("false")).count() == len(rows_)
    assert decontaminate.clean(odd(sp, []), bench).count() == 0


def test_keep_first_and_keep_one_on_empty_tables_and_odd_names(sp):
    for keep in (exact_dedup.keep_first, ngram_join.keep_one):
        assert keep(odd(sp, [])).collect() == []
        got = keep(odd(sp, [(2, "same text here now"), (1, "same text here now"), (1, "another one of them")])).collect()
        assert sorted((r.doc_id, r.text, r.body) for r in got) == [(1, "another one of them", "e"), (1, "same text here now", "e")]


def test_near_copies_cost_pairs_in_proportion(sp, monkeypatch):
    asked = []
    plain = ngram_join._candidates

    def counted(*args):
        got = plain(*args)
        asked.append(got.count())
        return got

    monkeypatch.setattr(ngram_join, "_candidates", counted)
    totals = []
    for n in (100, 400):
        rng = random.Random(1)
        base = [f"w{rng.randrange(10**6)}" for _ in range(100)]
        docs_ = []
        for i in range(n):
            words = list(base)
            for _ in range(2):
                words[rng.randrange(100)] = f"z{rng.randrange(10**7)}"
            docs_.append(words)
        asked.clear()
        got = ngram_join.keep_one(frame(sp, [(i, " ".join(w)) for i, w in enumerate(docs_)]), n=5, percent=80).count()
        sets = [{tuple(w[i:i + 5]) for i in range(96)} for w in docs_]
        root = list(range(n))

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for i in range(n):
            for j in range(i):
                same = len(sets[i] & sets[j])
                if 100 * same >= 80 * (len(sets[i]) + len(sets[j]) - same):
                    root[find(i)] = find(j)
        assert got == len({find(i) for i in range(n)})
        totals.append(sum(asked))
    assert totals[1] <= 16 * max(totals[0], 50) and totals[1] < 400 * 399 / 2 / 20  # far from all pairs


def test_a_megabyte_of_tags_is_read_in_one_pass():
    import time

    machine = license_scan._automaton((("tag", license_scan.TAG, ""),))
    for raw, n in ((b"// SPDX-License-Identifier: MIT OR Apache-2.0\nwords\n" * 20_000, 20_000), (b"SPDX-License-Identifier: MIT " * 36_000, 36_000),
                   (b"SPDX-License-Identifier: " + b"MIT AND " * 100_000, 1), (b"SPDX-License-Identifier: " + b"(" * 10**5 + b"MIT" + b")" * 10**5, 1)):
        t0 = time.process_time()
        assert len(license_scan.scan_text(raw, machine)[3]) == n
        assert time.process_time() - t0 < 5


def test_licence_expressions_against_a_plain_evaluator():
    rng = random.Random(11)
    names = {**license_scan.LICENCES, "my-own-1.0": license_scan.UNKNOWN}

    def make(depth):
        if depth == 0 or rng.random() < 0.3:
            name = rng.choice(sorted(names))
            if rng.random() < 0.2:
                exc = rng.choice(sorted(license_scan.EXCEPTIONS))
                return f"{name} with {exc}", f"({name} with {exc})", [name], min(names[name], 1) if names[name] < license_scan.UNKNOWN else names[name]
            return name, name, [name], names[name]
        op = rng.choice(["and", "or"])
        (ta, sa, ia, ra), (tb, sb, ib, rb) = make(depth - 1), make(depth - 1)
        return f"({ta}) {op} ({tb})", f"({sa} {op} {sb})", ia + ib, min(ra, rb) if op == "or" else max(ra, rb)

    for _ in range(300):
        text, shown, ids, rank = make(4)
        assert license_scan.evaluate(license_scan.postfix(text)) == (shown, ids, rank)


def test_bpe_of_a_very_long_word_and_a_full_cache(monkeypatch):
    from tokenizers import Tokenizer

    lib, enc = Tokenizer.from_file(bpe.default_path()), bpe.Encoder(bpe.default_path())
    word = ("qwertyuiopasdfghjklzxcvbnm" * 4000)[:100_000]
    enc.learn({word})
    (ids,), (shown,) = enc.texts([[word]])
    enc.forget()
    want = lib.encode(word, add_special_tokens=False).ids
    assert ids == b"".join(x.to_bytes(4, "little") for x in want) and shown == lib.decode(want, skip_special_tokens=False)
    assert word not in enc.known and word not in enc.words
    monkeypatch.setattr(bpe, "CACHE_PIECES", 60)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 60)
    for a in range(0, 1200, 40):
        texts_ = [f"qzx{i}; vbn-{i * 7919} kept <|endoftext|> zq" for i in range(a, a + 40)]
        split = [bpe.pieces_of(t) for t in texts_]
        enc.learn(set().union(*split))
        for t, got in zip(texts_, enc.texts(split)[0]):
            assert got == b"".join(x.to_bytes(4, "little") for x in lib.encode(t, add_special_tokens=False).ids)


def test_bpe_handles_a_batch_in_small_groups_and_gives_memory_back(monkeypatch):
    import gc

    import pyarrow as pa
    from tokenizers import Tokenizer

    released = []
    monkeypatch.setattr(bpe, "release", lambda: released.append(1), raising=False)
    texts_ = ["some words of a long text " * 10_000, None, "a b", "other words, too. " * 20_000, ""] * 2
    batch = pa.RecordBatch.from_arrays([pa.array(range(10), pa.int64()), pa.array(texts_, pa.string())], names=["doc_id", "text"])
    try:
        got = list(bpe._encoded([batch], bpe.default_path(), "doc_id"))
    finally:  # the worker's settings aren't for this process
        gc.enable()
        gc.unfreeze()
    lib = Tokenizer.from_file(bpe.default_path())
    assert [i for b in got for i in b.column(0).to_pylist()] == list(range(10))
    assert [r for b in got for r in b.column(1).to_pylist()] == [b"".join(i.to_bytes(4, "little") for i in lib.encode(t or "", add_special_tokens=False).ids) for t in texts_]
    assert max(sum(len(texts_[i] or "") for i in b.column(0).to_pylist()) for b in got) < 1 << 20
    assert len(got) == 3 and len(released) >= len(got)


def test_bpe_keeps_frequent_pieces_and_leaves_the_worker_to_other_operators(monkeypatch):
    import gc
    import weakref

    import pyarrow as pa

    from candleworks.llm import _words, toxicity

    monkeypatch.setattr(bpe, "BRIEF_PIECES", 30)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 30)
    enc = bpe._encoder(bpe.default_path())
    for a in range(60):  # two frequent pieces among ever new ones
        enc.learn({"often", "again;", *(f"once{a}x{i}" for i in range(20))})
        enc.forget()
        assert len(enc.pieces.once) <= 30 + 20 and len(enc.pieces.again) <= 30
    assert {"often", "again;"} <= enc.pieces.again.keys() and "once0x0" not in enc.pieces
    batch = pa.RecordBatch.from_arrays([pa.array([1], pa.int64()), pa.array(["a few words"], pa.string())], names=["doc_id", "text"])
    gone = weakref.ref(enc)
    del enc
    try:
        list(bpe._encoded([batch], bpe.default_path(), "doc_id"))
        assert gone() is not None and not gc.isenabled()  # kept for the worker's next task
        toxicity.Model(np.zeros(toxicity.TRIPLES), 0.0).scores(batch.column(1))
        assert gone() is None and gc.isenabled() and not _words._KEPT
    finally:
        gc.enable()
        gc.unfreeze()


def test_bpe_fits_by_the_merges_of_the_file():
    import json

    with open(bpe.default_path(), encoding="utf-8") as f:
        model = json.load(f)["model"]
    rank = {tuple(m) if isinstance(m, list) else tuple(m.split(" ")): i for i, m in enumerate(model["merges"])}
    enc, rng = bpe._encoder(bpe.default_path()).bpe, random.Random(5)
    for _ in range(2000):
        want = [rng.choice("abcdehimnorstu") for _ in range(rng.randint(1, 9))]
        want[-1] += "</w>"
        got = enc.merge(want)
        while (pairs := [(rank[p], i) for i, p in enumerate(zip(want, want[1:])) if p in rank]):
            i = min(pairs)[1]
            want[i:i + 2] = [want[i] + want[i + 1]]
        assert got == want


def test_bpe_by_shares_keeps_less_and_gives_the_same(monkeypatch):
    import gc

    import pyarrow as pa

    monkeypatch.setattr(bpe, "GROUP_CHARS", 4_000)
    monkeypatch.setattr(bpe, "BRIEF_PIECES", 400)
    monkeypatch.setattr(bpe, "CACHE_PIECES", 400)
    texts_ = [" ".join(f"word{(i * j) % 997}" for j in range(40)) for i in range(200)] + [None, "", "a b" * 5_000]
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(texts_)), pa.int64()), pa.array(texts_, pa.string())], names=["doc_id", "text"])
    try:
        whole, parts = (list(bpe._encoded([batch], bpe.default_path(), "doc_id", share)) for share in (1, 4))
        enc = bpe._encoder(bpe.default_path())
        assert enc.share == 4 and len(enc.pieces.again) <= 100 and len(enc.pieces.once) <= 100 + 40
    finally:
        bpe._drop()
    assert len(parts) > 2 * len(whole)
    for a in range(3):
        assert [r for b in parts for r in b.column(a).to_pylist()] == [r for b in whole for r in b.column(a).to_pylist()]


def test_tables_without_rows_start_no_python_workers(sp):
    from pyspark.sql import types as T

    from candleworks.llm._store import empty

    made = empty(sp, "node bigint, root bigint")
    assert made.count() == 0 and made.dtypes == [("node", "bigint"), ("root", "bigint")]
    odd = T.StructType([T.StructField("item", T.StringType()), T.StructField("a b", T.ArrayType(T.LongType()))])
    assert empty(sp, odd).schema == odd and empty(sp, odd).collect() == []
    assert "ExistingRDD" not in made._jdf.queryExecution().executedPlan().toString()  # of a Python list
    links = sp.createDataFrame([(1, 2), (2, 3)], "a bigint, b bigint")
    assert sorted(map(tuple, components.joined(made, links).collect())) == [(2, 1), (3, 1)]
