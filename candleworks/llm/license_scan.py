"""Licence scan (operator 1): an Aho-Corasick automaton over the words of whole texts
finds notice phrases and identifier tags; a shunting-yard parser evaluates the
and/or/with expression that follows a tag.

Words are runs of digits, letters a-z (A-Z lowered) and bytes from 0x80 on. Each text
becomes its words between single spaces, so that a phrase is found exactly where its
words stand consecutively, overlapping places included.

After a tag with its colon, any well-formed identifier is an operand or an exception
(``LicenseRef-`` and ``DocumentRef-`` ones too): what the tables don't hold is labelled as
it stands and has the rank ``UNKNOWN``, above all others. Words of a note that follows
``and``, ``or`` or ``with`` on the tag's line can't be told from identifiers.

Cases: a null or empty text has no words, places, notices or expressions; an expression
ends where no licence can follow, and a dangling operator or open bracket is dropped;
after a tag without a colon (prose) only known identifiers count; repeated rows are scanned alike; extra columns are ignored; a text is scanned
whole, whatever its length.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import deque
from collections.abc import Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The phrases and labels of the contract.
BASE_PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}

# Notices and the identifier each stands for.
NOTICES = {
    "apache license version 2 0": "apache-2.0",
    "licensed under the apache license": "apache-2.0",
    "mit license": "mit",
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms": "bsd-3-clause",
    "gnu general public license version 2": "gpl-2.0",
    "gnu general public license version 3": "gpl-3.0",
    "gnu lesser general public license": "lgpl-3.0",
    "gnu affero general public license": "agpl-3.0",
    "mozilla public license version 2 0": "mpl-2.0",
    "cc by 4 0": "cc-by-4.0",
    "cc by sa 4 0": "cc-by-sa-4.0",
    "cc by nc 4 0": "cc-by-nc-4.0",
    "cc by nd 4 0": "cc-by-nd-4.0",
    "cc0 1 0": "cc0-1.0",
    "creative commons attribution": "cc-by",
}

# Identifiers, from 0 (permissive) over 1 (weak) and 2 (strong copyleft) to 3 (restricted use).
LICENCES = {
    "mit": 0, "apache-2.0": 0, "bsd-2-clause": 0, "bsd-3-clause": 0, "isc": 0, "zlib": 0, "unlicense": 0,
    "cc0-1.0": 0, "cc-by-4.0": 0, "0bsd": 0, "bsl-1.0": 0,
    "mpl-2.0": 1, "lgpl-2.1": 1, "lgpl-2.1-only": 1, "lgpl-2.1-or-later": 1, "lgpl-3.0": 1, "lgpl-3.0-only": 1,
    "lgpl-3.0-or-later": 1, "epl-2.0": 1, "cddl-1.0": 1,
    "gpl-2.0": 2, "gpl-2.0-only": 2, "gpl-2.0-or-later": 2, "gpl-3.0": 2, "gpl-3.0-only": 2, "gpl-3.0-or-later": 2,
    "agpl-3.0": 2, "agpl-3.0-only": 2, "agpl-3.0-or-later": 2, "cc-by-sa-4.0": 2,
    "cc-by-nc-4.0": 3, "cc-by-nd-4.0": 3, "cc-by-nc-sa-4.0": 3, "cc-by-nc-nd-4.0": 3,
}
# Exceptions that may follow "with".
EXCEPTIONS = {"classpath-exception-2.0", "llvm-exception", "gcc-exception-3.1", "bison-exception-2.2", "autoconf-exception-3.0"}
#: Rank of a licence that the table doesn't hold.
UNKNOWN = 4

TAG = "spdx license identifier"
BINDS = {"or": 1, "and": 2, "with": 3}
_SYMBOL = re.compile(r"[ \t]*([()]|(?:documentref-[a-z0-9.-]+:)?[a-z0-9][a-z0-9.+-]*)")
_IDENTIFIER = re.compile(r"(?:documentref-[a-z0-9.-]+:licenseref-)?[a-z0-9][a-z0-9.-]*\+?")


def _operand(symbol: str, exception: bool, known: bool) -> bool:
    """Whether a symbol can be a licence, or an exception."""
    if symbol in EXCEPTIONS or symbol.rstrip("+") in LICENCES:
        return exception == (symbol in EXCEPTIONS)
    return not known and symbol not in BINDS and _IDENTIFIER.fullmatch(symbol) is not None


def postfix(text: str, known: bool = False, at: int = 0, end: int | None = None) -> list[str]:
    """The expression in ``text`` from ``at`` on (up to ``end``) in postfix order, by the shunting yard.

    Reading stops at the first symbol that can't continue it; with ``known``, also at an
    identifier that the tables don't hold."""
    out: list[str] = []
    stack: list[str] = []
    operand_next, end = True, len(text) if end is None else end
    brackets = 0
    while m := _SYMBOL.match(text, at, end):
        symbol = m[1].rstrip(".") if m[1] not in LICENCES else m[1]
        exception = bool(stack) and stack[-1] == "with"
        if operand_next and symbol == "(" and not exception:
            stack.append(symbol)
            brackets += 1
        elif operand_next and _operand(symbol, exception, known):
            out.append(symbol)
            operand_next = False
        elif not operand_next and symbol in BINDS:
            while stack and stack[-1] != "(" and BINDS[stack[-1]] >= BINDS[symbol]:
                out.append(stack.pop())
            stack.append(symbol)
            operand_next = True
        elif not operand_next and symbol == ")" and brackets:
            brackets -= 1
            while (top := stack.pop()) != "(":
                out.append(top)
        else:
            break
        at = m.end()
    if operand_next and out:  # the last operator has no right side
        while stack and stack[-1] == "(":
            stack.pop()
        if stack:
            stack.pop()
    out += [s for s in reversed(stack) if s != "("] if out else []
    return out


def evaluate(parts: list[str]) -> tuple[str, list[str], int]:
    """The expression with brackets, its licences, and the rank of what it asks for:
    ``or`` lets the reader choose the lesser, ``and`` asks for the greater, and an
    exception turns strong into weak copyleft (an unknown one leaves the rank, and nothing
    but ``or`` lessens an unknown licence)."""
    stack: list[tuple[deque, deque, int]] = []
    for p in parts:
        if p in BINDS:
            (b, ids_b, rank_b), (a, ids_a, rank_a) = stack.pop(), stack.pop()
            if p == "with":
                shown, ids, rank = b[0], ids_a, min(rank_a, 1) if b[0] in EXCEPTIONS and rank_a < UNKNOWN else rank_a
                a.extend((" with ", shown))
            else:
                a.append(f" {p} ")
                a, ids = _chained(a, b), _chained(ids_a, ids_b)
                rank = min(rank_a, rank_b) if p == "or" else max(rank_a, rank_b)
            a.appendleft("(")
            a.append(")")
            stack.append((a, ids, rank))
        elif p in EXCEPTIONS:
            stack.append((deque([p]), deque(), 0))
        else:
            stack.append((deque([p]), deque([p.rstrip("+")]), LICENCES.get(p.rstrip("+"), UNKNOWN)))
    shown, ids, rank = stack[0]
    return "".join(shown), list(ids), rank


def _chained(a: deque, b: deque) -> deque:
    """``a`` and then ``b``; the shorter one is moved."""
    if len(b) <= len(a):
        a.extend(b)
        return a
    b.extendleft(reversed(a))
    return b


# Every byte that is part of no word becomes a space; A-Z are lowered.
_TO_WORDS = bytes(b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else b + 32 if 65 <= b <= 90 else 32 for b in range(256))
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_BLANK, _LEAD = re.compile(r"[ \t]*"), re.compile(r"[: \t]*")


@lru_cache(maxsize=4)
def _automaton(phrases: tuple[tuple[str, str, str], ...]):
    import ahocorasick

    found: dict[str, list] = {}
    for kind, phrase, label in phrases:
        found.setdefault(f" {phrase} ", []).append((kind, label, phrase.count(" ") + 1))
    machine = ahocorasick.Automaton()
    for key, values in found.items():
        machine.add_word(key, values)
    machine.make_automaton()
    return machine


class _Lines:
    """Where the words and lines of a text end, found once for all its tags."""

    def __init__(self, raw: bytes) -> None:
        lowered = raw.lower()
        self.text = lowered.decode("latin-1")  # one character a byte; symbols are ASCII
        self.words = [m.end() for m in _WORD.finditer(lowered)]
        self.breaks = [m.start() for m in re.finditer(rb"\n", lowered)]

    def expression(self, word: int) -> tuple[str, list[str], int] | None:
        """The evaluated expression on the line after the word number ``word``."""
        at = self.words[word]
        i = bisect_left(self.breaks, at)
        end = self.breaks[i] if i < len(self.breaks) else len(self.text)
        at = _BLANK.match(self.text, at, end).end()
        tagged = self.text.startswith(":", at, end)
        parts = postfix(self.text, not tagged, _LEAD.match(self.text, at, end).end(), end)
        return evaluate(parts) if parts else None


def scan_text(raw: bytes, machine) -> tuple[int, list, list, list]:
    """Number of words, base places, notices (label and first word) and expressions."""
    words = raw.translate(_TO_WORDS).split()
    lines: _Lines | None = None
    places, notices, expressions = [], [], []
    if words:
        joined = " " + b" ".join(words).decode("latin-1") + " "
        counted, upto = 0, 0
        for end, values in machine.iter(joined):
            counted, upto = counted + joined.count(" ", upto, end), end
            for kind, label, n in values:
                start = counted - n
                if kind == "base":
                    places.append({"label": label, "start": start})
                elif kind == "notice":
                    notices.append({"label": label, "start": start})
                else:
                    lines = lines or _Lines(raw)
                    if got := lines.expression(start + n - 1):
                        expressions.append({"expression": got[0], "licences": sorted(set(got[1])), "rank": got[2], "start": start})
    return len(words), places, notices, expressions


_PLACES = "array<struct<label:string,start:bigint>>"
_EXPRESSIONS = "array<struct<expression:string,licences:array<string>,rank:int,start:bigint>>"


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: dict[str, str] | None = None,
         notices: dict[str, str] | None = None) -> DataFrame:
    """Per row: the id, ``n_words``, ``places`` of the base phrases, ``notices`` and ``expressions``."""
    phrases = (*[("base", p, v) for p, v in (BASE_PHRASES if base is None else base).items()],
               *[("notice", p, v) for p, v in (NOTICES if notices is None else notices).items()], ("tag", TAG, ""))
    place = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64())]))
    expression = pa.list_(pa.struct([("expression", pa.string()), ("licences", pa.list_(pa.string())), ("rank", pa.int32()), ("start", pa.int64())]))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = _automaton(phrases)
        for batch in batches:
            rows = [scan_text(t or b"", machine) for t in batch.column(1).cast(pa.binary()).to_pylist()]
            n, places, found, expressions = zip(*rows) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(n, pa.int64()), pa.array(places, place), pa.array(found, place),
                                              pa.array(expressions, expression)],
                                             names=[id_col, "n_words", "places", "notices", "expressions"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(
        run, f"`{id_col}` {kind}, n_words bigint, places {_PLACES}, notices {_PLACES}, expressions {_EXPRESSIONS}")


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def summary(scanned: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts, labels and a score: each distinct label is independent evidence, a base
    phrase worth 0.5, a notice 0.8 and an evaluated expression 0.95."""
    base, notices = F.array_distinct(F.col("places.label")), F.array_distinct(F.col("notices.label"))
    ids = F.flatten(F.col("expressions.licences"))
    starts = F.col("places.start")
    doubt = lambda labels, left: F.pow(F.lit(left), F.size(labels))
    return scanned.select(
        id_col, "n_words", F.size("places").cast("long").alias("n_base"), F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"), _joined(base).alias("base_labels"),
        _joined(F.concat(base, notices, ids)).alias("labels"),
        (1.0 - doubt(base, 0.5) * doubt(notices, 0.2) * doubt(F.col("expressions"), 0.05)).alias("score"),
        F.array_join(F.col("expressions.expression"), ",").alias("expressions"),
        F.array_max(F.col("expressions.rank")).alias("rank"))
