"""BPE encoding and decoding over a trie of distinct words (operator 4).

The texts of an Arrow batch are cut at ASCII white space; each distinct piece is
normalised and pre-tokenised once by the tokenizer file's own rules, and its words
are encoded by :class:`PrefixEncoder`. The encoder walks the trie of all distinct
words depth first and carries, per node, the last token of the encoding of the
prefix that the node spells. A token ``t`` ends the encoding of a prefix exactly if
the merges leave the pair (last token before ``t``, ``t``) alone, so a node needs
its ancestors' states only, and the encoding of a shared prefix is computed once.

Cases: a null text counts as empty; an empty text has no ids and decodes to an
empty text; special-token strings inside a text become their ids, as the library
does; repeated rows are encoded alike; a text of any length is encoded whole.
"""

from __future__ import annotations

import gc
import json
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm._words import make_room, release

SUFFIX = "</w>"
#: Pieces and words that a Python worker keeps between groups: those seen in one group so far, and those seen again.
BRIEF_PIECES, CACHE_PIECES = 100_000, 170_000
BRIEF_WORDS, CACHE_WORDS = 70_000, 100_000
#: Longer pieces (characters) aren't kept.
CACHE_CHARS = 64
CACHE_PAIRS = 200_000
CACHE_NODES = 400_000
#: Characters of the texts that are handled together; memory beside the caches follows it and the longest text.
GROUP_CHARS = 1 << 19
#: Pieces that are normalised and split in one call.
SPLIT_TOGETHER = 2_000


class PrefixEncoder:
    """Encodes words (strings over the vocabulary's alphabet) by their shared prefixes."""

    def __init__(self, vocab: dict[str, int], merges: Iterable[tuple[str, str]], suffix: str = SUFFIX) -> None:
        self.suffix = suffix
        own = {token: token for token in vocab}  # one string each
        self.rank = {(own.get(a, a), own.get(b, b)): i for i, (a, b) in enumerate(merges)}
        n = len(suffix)
        self.inner: dict[str, int] = {}
        self.final: dict[str, int] = {}
        for token, i in vocab.items():
            if not token or self.merge(self.symbols(token)) != [token]:  # no merge makes it
                continue
            if token.endswith(suffix) and len(token) > n:
                self.final[token[:-n]] = i
            else:
                self.inner[token] = i
        self.starts = {t[:n] for t in (*self.inner, *self.final) for n in range(len(t) + 1)}
        self.longest = max(map(len, self.starts), default=0)
        #: Per text end to match on from, where each letter leads.
        self.nodes: dict[str, dict[str, tuple[dict, list, list]]] = {"": {}}
        self.steps = 0
        self.size = max(vocab.values(), default=0) + 1
        self.token = [""] * self.size
        for token, i in vocab.items():
            self.token[i] = token
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        #: Whether two tokens fit, by left * size + right.
        self.pairs: dict[int, bool] = {}

    def symbols(self, token: str) -> list[str]:
        """The symbols that a token's merges begin with."""
        letters = list(token)
        if token.endswith(self.suffix) and len(token) > len(self.suffix):
            del letters[-len(self.suffix):]
            letters[-1] += self.suffix
        return letters

    def merge(self, symbols: Iterable[str]) -> list[str]:
        """The merges in order of rank, leftmost first."""
        parts, rank, none = list(symbols), self.rank, len(self.rank)
        ranks = [rank.get(pair, none) for pair in zip(parts, parts[1:])]
        while ranks and (best := min(ranks)) < none:
            i = ranks.index(best)
            parts[i:i + 2] = [parts[i] + parts[i + 1]]
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank.get((parts[i], parts[i + 1]), none)
            if i:
                ranks[i - 1] = rank.get((parts[i - 1], parts[i]), none)
        return parts

    def fits(self, left: int, right: int) -> bool:
        """Whether the merges leave ``left`` and ``right`` side by side as they are."""
        pair = left * self.size + right
        known = self.pairs.get(pair)
        if known is None:
            both = [self.token[left], self.token[right]]
            known = self.merge(self.symbols(both[0]) + self.symbols(both[1])) == both
            if len(self.pairs) >= CACHE_PAIRS:
                self.pairs.clear()
            self.pairs[pair] = known
        return known

    def node(self, row: dict, text: str) -> tuple[dict, list, list]:
        """Where the last letter of ``text`` leads from ``row``: the row of the longest text end
        that starts a token, and the inner and the final tokens (with their lengths) that end there."""
        letter, text = text[-1], text[-self.longest:]
        while text not in self.starts:
            text = text[1:]
        ends = [text[i:] for i in range(len(text))]
        found = (self.nodes.setdefault(text, {}), [(self.inner[e], len(e)) for e in ends if e in self.inner],
                 [(self.final[e], len(e)) for e in ends if e in self.final])
        row[letter] = found
        self.steps += 1
        return found

    def encode(self, words: Iterable[str]) -> dict[str, bytes]:
        """The packed ids of each distinct word.

        Sorted words are the trie's leaves in depth-first order. Along the current path
        ``last`` holds each prefix's last token, ``back`` where that token starts, ``rows`` the
        steps from the text end to match on from; a word's encoding is read from its end back to its start."""
        out: dict[str, bytes] = {}
        if self.steps > CACHE_NODES:
            for row in self.nodes.values():  # rows refer to each other
                row.clear()
            self.nodes, self.steps = {"": {}}, 0
        last: list[int] = [-1]
        back: list[int] = [0]
        path = ""
        rows: list[dict] = [self.nodes[""]]
        node, fits, known, packed, size, reach = self.node, self.fits, self.pairs, self.packed, self.size, self.longest + 1
        for word in sorted(set(words)):
            n = len(word)
            same = min(len(path), n - 1)
            if path[:same] != word[:same]:
                same = _common(path, word, same)
            del last[same + 1:], back[same + 1:], rows[same + 1:]
            row, end, path = rows[same], same, word[:-1]
            for letter in path[same:]:
                end += 1
                row, inner, _ = row.get(letter) or node(row, word[max(0, end - reach):end])
                for t, length in inner:
                    at = end - length
                    if not at:
                        break
                    fit = known.get(last[at] * size + t)
                    if fit or fit is None and fits(last[at], t):
                        break
                else:
                    raise ValueError(f"no token ends {word[:end]!r}")
                last.append(t)
                rows.append(row)
                back.append(at)
            _, _, final = row.get(word[-1]) or node(row, word[max(0, n - reach):])
            for t, length in final:
                at = n - length
                if not at or fits(last[at], t):
                    break
            else:
                raise ValueError(f"no token ends {word!r}")
            if at:
                ids = [packed[t]]
                while at:
                    ids.append(packed[last[at]])
                    at = back[at]
                ids.reverse()
                out[word] = b"".join(ids)
            else:
                out[word] = packed[t]
        return out


def _common(a: str, b: str, most: int) -> int:
    """Length of the common start of two strings that differ before ``most``, by halving."""
    low, high = 0, most
    while high - low > 1:
        middle = (low + high) // 2
        low, high = (middle, high) if a[low:middle] == b[low:middle] else (low, middle)
    return low


class Kept:
    """A bounded cache: what was seen once goes soon, so that rare entries don't drive out frequent ones."""

    def __init__(self) -> None:
        self.once: dict[str, bytes] = {}
        self.again: dict[str, bytes] = {}

    def __contains__(self, key: str) -> bool:
        return key in self.once or key in self.again

    def find(self, keys: set[str]) -> tuple[dict[str, bytes], list[str]]:
        """The kept entries of ``keys``, and the keys that aren't kept."""
        once, again = self.once, self.again
        found = {k: again[k] for k in again.keys() & keys}
        rest = keys.difference(found)
        for k in once.keys() & rest:
            found[k] = again[k] = once.pop(k)
        return found, list(rest.difference(found))

    def add(self, made: dict[str, bytes], used: dict[str, bytes], most_once: int, most_again: int) -> None:
        """Keep new entries; the oldest go first, but for those that are ``used`` now."""
        self.once.update(made)
        for k in [k for k in made if len(k) > CACHE_CHARS]:
            del self.once[k]
        for entries, most in ((self.once, most_once), (self.again, most_again)):
            if len(entries) > most:
                old = (k for k in entries if k not in used)
                for k in list(islice(old, len(entries) - most * 3 // 4)):
                    del entries[k]


class Encoder:
    """A tokenizer file: pieces to ids and decoded tokens, with a bounded cache."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or model.get("end_of_word_suffix") != SUFFIX or spec.get("decoder"):
            raise ValueError("a BPE file with word ends and without a decoder is needed")
        rules = Tokenizer.from_file(path)
        self.normalizer, self.splitter = rules.normalizer, rules.pre_tokenizer
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.bpe = PrefixEncoder(model["vocab"], pairs)
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.special_ids = {i: i.to_bytes(4, "little") for i in self.special.values()}
        shown = dict(enumerate(self.bpe.token)) | {i: s for s, i in self.special.items()}
        self.shown = pa.array([shown.get(i, "") for i in range(max(shown, default=-1) + 1)], pa.string())
        #: Pieces of the texts at hand; pieces and words of earlier ones.
        self.known: dict[str, bytes] = {}
        self.pieces, self.words = Kept(), Kept()
        #: One of how many parts of the usual entries is kept.
        self.share = 1

    def _split(self, text: str) -> list[str]:
        """Words of a text without special tokens, by the file's own rules."""
        return [w for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text) if self.normalizer else text)]

    def _parts(self, piece: str) -> list[int | str]:
        """Special ids and words of one piece."""
        out: list[int | str] = []
        for part in self.cut.split(piece) if self.cut else [piece]:
            if part in self.special:
                out.append(self.special[part])
            elif part:
                out += self._split(part)
        return out

    def _parts_of(self, pieces: list[str]) -> Iterator[list[int | str]]:
        """As :meth:`_parts` of each, with one call for many pieces: they are joined by
        spaces, which the rules drop, so a gap between two words starts the next piece."""
        for a in range(0, len(pieces), SPLIT_TOGETHER):
            some = pieces[a:a + SPLIT_TOGETHER]
            text = " ".join(some)
            found: list[list[int | str]] = []
            if not (self.cut and self.cut.search(text)):
                end = -1
                for w, (start, stop) in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(text) if self.normalizer else text):
                    if start != end:
                        found.append([])
                    found[-1].append(w)
                    end = stop
            yield from found if len(found) == len(some) else map(self._parts, some)

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that aren't known yet."""
        known, new = self.pieces.find(pieces)
        parts = list(self._parts_of(new))
        made, unmade = self.words.find({w for ws in parts for w in ws if w.__class__ is str})
        fresh = self.bpe.encode(unmade)
        made |= fresh
        made |= self.special_ids
        learnt = {p: made[ws[0]] if len(ws) == 1 else b"".join([made[w] for w in ws]) for p, ws in zip(new, parts)}
        self.pieces.add(learnt, known, BRIEF_PIECES // self.share, CACHE_PIECES // self.share)
        self.words.add(fresh, made, BRIEF_WORDS // self.share, CACHE_WORDS // self.share)
        known |= learnt
        self.known = known

    def forget(self) -> None:
        """Drop the pieces of the texts that were last encoded, but for those that are kept."""
        self.known = {}

    def texts(self, split: list[list[str]]) -> tuple[list[bytes], list[str]]:
        """Packed ids and decoded text of each list of known pieces."""
        ids = [b"".join(map(self.known.__getitem__, pieces)) for pieces in split]
        tokens = self.shown.take(pa.array(np.frombuffer(b"".join(ids), "<u4")))
        starts = pa.array(np.cumsum([0, *[len(i) // 4 for i in ids]]), pa.int32())
        return ids, pc.binary_join(pa.ListArray.from_arrays(starts, tokens), " ").to_pylist()


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def _drop() -> None:
    """Give up this worker's encoder and the settings that went with it."""
    _encoder.cache_clear()
    gc.unfreeze()
    gc.enable()


# Separators U+001C to U+001F are no white space for the tokenizer, but are for str.split().
_ODD_SEPARATORS = re.compile("[\x1c-\x1f]")
_ASCII_SPACE = re.compile("[^ \t-\r]+")


def pieces_of(text: str) -> list[str]:
    return _ASCII_SPACE.findall(text) if _ODD_SEPARATORS.search(text) else text.split()


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def _groups(texts: Iterable[str], most: int = GROUP_CHARS) -> Iterator[list[str]]:
    """Consecutive texts of about ``most`` characters together."""
    group, size = [], 0
    for t in texts:
        group.append(t)
        size += len(t)
        if size >= most:
            yield group
            group, size = [], 0
    if group:
        yield group


def _encoded(batches: Iterable[pa.RecordBatch], path: str, id_col: str, share: int = 1) -> Iterator[pa.RecordBatch]:
    """Groups of encoded rows; what a group took goes back to the system before the next one."""
    make_room("bpe", _drop)
    enc = _encoder(path)
    enc.share = share
    release()
    gc.freeze()  # the caches make no garbage; don't walk them again and again
    gc.disable()
    for batch in batches:
        done = 0
        for group in _groups((t.as_py() or "" for t in batch.column(1)), max(GROUP_CHARS // share, 1)):
            split = [pieces_of(t) for t in group]
            enc.learn(set().union(*split))
            ids, shown = enc.texts(split)
            enc.forget()
            out = pa.RecordBatch.from_arrays(
                [batch.column(0).slice(done, len(group)), pa.array(ids, pa.binary()), pa.array(shown, pa.string())],
                names=[id_col, "ids", "decoded"])
            done += len(group)
            del group, split, ids, shown
            yield out
            del out
            release()


def encode(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", share: int = 1) -> DataFrame:
    """``id_col``, ``ids`` (packed little-endian unsigned 32-bit integers) and
    ``decoded`` (the decoding of those ids) of every row. ``path`` names the
    tokenizer file, which every executor must be able to open. With ``share`` n, a worker keeps the n-th part
    of the usual entries and handles the n-th part of the characters together: less memory, more CPU time, the
    same rows."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _encoded(batches, path, id_col, share)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids binary, decoded string")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token counts and SHA-256 digests of what :func:`encode` returns."""
    return encoded.select(id_col, (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                          F.sha2(F.col("ids"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"))
