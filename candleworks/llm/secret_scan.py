"""Secret scan (operator 3): a trigram index chooses the texts that a rule's regular
expression is run on.

From the parse tree of each expression a Boolean query over lower-case trigrams is
derived (alternatives give *or*, what must follow gives *and*). Texts are indexed in
segments, the postings hold the trigrams that any query names, a rule's postings are
united and intersected, and the expression is run over the whole texts that remain. A
rule without a mandatory trigram is run over every text.

Cases: a null or empty text has no spans; offsets are code points, ends exclusive;
matches of a rule never overlap each other (leftmost first), matches of different rules
may; repeated rows are scanned alike; extra columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import lru_cache
from re import _parser as parse_tree

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from candleworks.llm._words import CHUNK_BYTES, _LOWER, _buffers


@dataclass(frozen=True)
class Rule:
    """A kind of secret. ``group`` of a match must have ``least`` characters or more;
    matches that don't are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1
    any_case: bool = False


# The kinds of the contract, in its order.
BASE_RULES = (
    Rule("assign", r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6, True),
    Rule("access", "AKIA[A-Z0-9]+", 0, 20),
    Rule("hex", "[0-9a-f]+", 0, 24),
)
# Further public token formats.
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 0, 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 0, 15),
    Rule("google", "AIza[0-9A-Za-z_-]+", 0, 39),
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)

#: A query is True (every text), a trigram, or ("and" | "or", queries).
Query = bool | str | tuple
MOST_STRINGS = 64


def _both(kind: str, parts: Iterable[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    if kind == "or" and True in parts:
        return True
    parts = [p for p in parts if p is not True]
    return True if not parts else parts[0] if len(parts) == 1 else (kind, tuple(parts))


def _holds(strings: set[str]) -> Query:
    """A text that holds one of the strings holds all its trigrams."""
    return _both("or", (_both("and", (s[i:i + 3] for i in range(len(s) - 2))) for s in sorted(strings)))


def _alternatives(item) -> set[str] | None:
    """The lower-case strings that a node of the tree can match, if they are few."""
    op, arg = str(item[0]), item[1]
    if op == "LITERAL":
        return {chr(arg).lower()} if arg < 128 else None
    if op == "IN" and all(str(k) == "LITERAL" and v < 128 for k, v in arg) and len(arg) <= 6:
        return {chr(v).lower() for _, v in arg}
    if op == "SUBPATTERN":
        return _strings(arg[-1])
    if op == "BRANCH":
        sets = [_strings(b) for b in arg[1]]
        return set().union(*sets) if all(s is not None for s in sets) else None
    if op == "MAX_REPEAT" and arg[1] == 1:
        inner = _strings(arg[2])
        return None if inner is None else inner | ({""} if arg[0] == 0 else set())
    return None


def _strings(items) -> set[str] | None:
    out = {""}
    for item in items:
        more = _alternatives(item)
        if more is None or len(out) * len(more) > MOST_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _query_of(items) -> Query:
    parts: list[Query] = []
    run = {""}
    for item in items:
        more = _alternatives(item)
        if more is not None and len(run) * len(more) <= MOST_STRINGS:
            run = {a + b for a in run for b in more}
            continue
        parts.append(_holds(run))
        run = {""} if more is None else more
        op, arg = str(item[0]), item[1]
        if more is None and op == "SUBPATTERN":
            parts.append(_query_of(arg[-1]))
        elif more is None and op == "BRANCH":
            parts.append(_both("or", (_query_of(b) for b in arg[1])))
        elif more is None and op == "MAX_REPEAT" and arg[0] >= 1:
            parts.append(_query_of(arg[2]))
    parts.append(_holds(run))
    return _both("and", parts)


def trigram_query(pattern: str) -> Query:
    """What the trigrams of any text that ``pattern`` matches in fulfil."""
    return _query_of(parse_tree.parse(pattern))


def _named(query: Query) -> set[str]:
    return set() if query is True else {query} if isinstance(query, str) else set().union(*map(_named, query[1]))


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = rules
        self.compiled = [re.compile(self._fast(r), re.ASCII | (re.IGNORECASE if r.any_case else 0)) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        self.trigrams = sorted(set().union(*map(_named, self.queries)))
        self.slot = np.zeros(1 << 24, dtype=np.uint16)
        for i, t in enumerate(self.trigrams, 1):
            a, b, c = t.encode("ascii")
            self.slot[a << 16 | b << 8 | c] = i

    @staticmethod
    def _fast(rule: Rule) -> str:
        """A rule that is one repeated class has maximal runs as matches, so the least
        length can be asked of the run itself."""
        tree = parse_tree.parse(rule.pattern)
        single = len(tree) == 1 and str(tree[0][0]) == "MAX_REPEAT" and tree[0][1][:2] == (1, parse_tree.MAXREPEAT)
        return f"(?:{rule.pattern[:-1]}){{{rule.least},}}" if single and rule.group == 0 and rule.pattern.endswith("]+") else rule.pattern

    def postings(self, data: np.ndarray, off: np.ndarray) -> list[np.ndarray]:
        """Rows of a segment that hold each named trigram."""
        docs = len(off) - 1
        if len(data) < 3:
            return [np.zeros(0, np.int64)] * len(self.trigrams)
        low = _LOWER[data].astype(np.uint32)
        slots = self.slot[low[:-2] << 16 | low[1:-1] << 8 | low[2:]]
        at = np.flatnonzero(slots)
        row = np.searchsorted(off, at, side="right") - 1
        inside = at + 2 < off[row + 1]
        pair = np.unique(slots[at[inside]].astype(np.int64) * docs + row[inside])
        which = pair // docs
        cut = np.searchsorted(which, np.arange(1, len(self.trigrams) + 2))
        return [pair[cut[i]:cut[i + 1]] % docs for i in range(len(self.trigrams))]

    def _rows(self, query: Query, postings: list[np.ndarray]) -> np.ndarray:
        if isinstance(query, str):
            return postings[self.trigrams.index(query)]
        kind, parts = query
        out = self._rows(parts[0], postings)
        for p in parts[1:]:
            out = (np.intersect1d if kind == "and" else np.union1d)(out, self._rows(p, postings))
        return out

    def scan(self, texts: pa.Array) -> list[list[dict]]:
        """Spans of each text of a segment, by start, then by the order of the rules."""
        off, raw = _buffers(texts)
        postings = self.postings(raw[off[0]:off[-1]], off - off[0])
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        text = texts.to_pylist()
        for k, (rule, pattern, query) in enumerate(zip(self.rules, self.compiled, self.queries)):
            for i in range(len(text)) if query is True else self._rows(query, postings):
                for m in pattern.finditer(text[i] or ""):
                    if m.end(rule.group) - m.start(rule.group) >= rule.least:
                        found[i].append((m.start(), k, m.end()))
        return [[{"kind": self.rules[k].kind, "start": a, "end": b} for a, k, b in sorted(spans)] for spans in found]


@lru_cache(maxsize=2)
def _scanner(rules: tuple[Rule, ...]) -> Scanner:
    return Scanner(rules)


def _segments(column: pa.Array) -> Iterator[tuple[int, int]]:
    """Runs of whole rows of about CHUNK_BYTES."""
    off, _ = _buffers(column)
    a = 0
    while a < len(column):
        b = min(len(column), max(a + 1, int(np.searchsorted(off, off[a] + CHUNK_BYTES, side="right")) - 1))
        yield a, b
        a = b


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = (*BASE_RULES, *MORE_RULES)) -> DataFrame:
    """Per row: the id and ``spans``, an array of kind, start and end."""
    kind_of = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _scanner(rules)
        for batch in batches:
            for a, b in _segments(batch.column(1)):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(scanner.scan(batch.column(1).slice(a, b - a)), kind_of)],
                                                 names=[id_col, "spans"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, spans array<struct<kind:string,start:bigint,end:bigint>>")


def _written(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and digests of the base kinds, and all spans as text."""
    of = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    kinds = [r.kind for r in BASE_RULES]
    return scanned.select(id_col, *map(of, kinds),
                          F.sha2(_written(F.filter("spans", lambda s: s["kind"].isin(kinds))).cast("binary"), 256).alias("base_sha256"),
                          _written(F.col("spans")).alias("spans"))
