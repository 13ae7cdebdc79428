"""Byte-level BPE encoding and decoding by segment trees (operator 12).

A text is cut into pieces by the vocabulary's pattern; each piece is merged apart from
the others. Over the byte positions of a piece lies a segment tree: the leaf of a
position holds the rank of the pair that starts there (with the position, so that of
equal ranks the leftmost is the smallest), an inner node the minimum of its two children.
The root so names the next merge. A merge changes three leaves (the merged position,
its left live neighbour, and the right half, which is live no more), and each
climbs to the root in a logarithmic number of steps. Short pieces are merged many at a
time, their trees side by side in one array, a merge of each per round; a long piece has a tree of
its own. A piece of ``n`` bytes takes ``O(n log n)`` steps, whatever its length.

As the rank library does, a piece that is a token as a whole is that token, whatever its merges.

Cases: a null text counts as empty; an empty text has no ids and decodes to nothing;
special-token strings in a text are ordinary text; repeated rows are encoded alike; texts
and pieces of any length are encoded whole, long texts in slices that end before white space
(where no piece can go on); extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm._words import text_groups

#: Pieces kept between the groups of a Python worker; past it only what the current texts use stays.
CACHE_PIECES = 300_000
#: Longer pieces (characters) aren't kept.
CACHE_CHARS = 64
#: Bytes of texts that are handled together, and characters of a slice of a long text.
GROUP_BYTES = 4 << 20
SLICE_CHARS = 1 << 20
#: Pieces of up to this many bytes are merged side by side.
TOGETHER_BYTES = 256
#: Tree cells that are held at once.
TREE_CELLS = 1 << 21
_NONE = np.int64(1) << np.int64(62)
_PLACE = np.int64(32)


class Merger:
    """The merges of a rank file: ``ranks`` maps the bytes of a token to its rank, which is its id."""

    def __init__(self, ranks: dict[bytes, int]) -> None:
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        self.ranks = ranks
        self.bytes_of = {i: t for t, i in ranks.items()}
        self.byte_id = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int64)
        pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                a, b = ranks.get(token[:cut]), ranks.get(token[cut:])
                if a is not None and b is not None:
                    pairs[a << 32 | b] = rank
        self.pair_rank = pairs
        self.pair_keys = np.array(sorted(pairs), dtype=np.int64)
        self.pair_values = np.array([pairs[k] for k in self.pair_keys.tolist()], dtype=np.int64)

    def _leaves(self, left: np.ndarray, right: np.ndarray, at: np.ndarray) -> np.ndarray:
        """What the tree holds for the pairs (``left``, ``right``) that start at ``at``."""
        key = left << np.int64(32) | right
        if len(self.pair_keys) == 0:
            return np.full(len(key), _NONE)
        i = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[i] == key, self.pair_values[i] << _PLACE | at, _NONE)

    def many(self, words: list[bytes]) -> list[bytes]:
        """Packed ids of every word; all of them have two bytes or more, up to ``width`` + 1."""
        out: list[bytes] = [b""] * len(words)
        length = np.fromiter(map(len, words), np.int64, len(words))
        for power in range(int(length.max() - 1).bit_length() + 1):
            width = 1 << power  # pairs of the longest word
            of_width = np.flatnonzero((length - 1 <= width) & (length - 1 > width >> 1))
            for a in range(0, len(of_width), max(1, TREE_CELLS // width)):
                some = of_width[a:a + max(1, TREE_CELLS // width)]
                for i, ids in zip(some.tolist(), self._side_by_side([words[i] for i in some.tolist()], length[some], width)):
                    out[i] = ids
        return out

    def _side_by_side(self, words: list[bytes], length: np.ndarray, width: int) -> list[bytes]:
        count, cols = len(words), width + 2
        place = np.arange(cols, dtype=np.int64)
        inside = place < length[:, None]
        token = np.zeros((count, cols), dtype=np.int64)
        token[inside] = self.byte_id[np.frombuffer(b"".join(words), dtype=np.uint8)]
        tree = np.full((count, 2 * width), _NONE)
        row, at = np.nonzero(inside[:, 1:])
        tree[row, width + at] = self._leaves(token[row, at], token[row, at + 1], at)
        size = width
        while size > 1:
            half = size >> 1
            tree[:, half:size] = np.minimum(tree[:, size:2 * size:2], tree[:, size + 1:2 * size:2])
            size = half
        live = inside
        after = np.tile(place + 1, (count, 1))
        before = np.tile(place - 1, (count, 1))
        rows = np.arange(count)
        while len(rows):
            top = tree[rows, 1]
            rows, top = rows[top != _NONE], top[top != _NONE]
            if len(rows) == 0:
                break
            at, merged = top & np.int64(0xFFFFFFFF), top >> _PLACE
            gone = after[rows, at]
            right, left = after[rows, gone], before[rows, at]
            token[rows, at], after[rows, at], before[rows, right], live[rows, gone] = merged, right, at, False
            # The three leaves; a missing left neighbour sets the merged position's leaf again.
            whole = right < length[rows]
            own = np.where(whole, self._leaves(merged, token[rows, right], at), _NONE)
            first = left < 0
            other = np.where(first, own, self._leaves(token[rows, left], merged, left))
            leaf = np.concatenate([at, np.where(first, at, left), gone])
            three = np.concatenate([rows, rows, rows])
            inner = leaf < width  # the last byte of the longest words starts no pair
            three, node = three[inner], leaf[inner] + width
            tree[three, node] = np.concatenate([own, other, np.full(len(rows), _NONE)])[inner]
            for _ in range(width.bit_length() - 1):
                node >>= 1
                tree[three, node] = np.minimum(tree[three, 2 * node], tree[three, 2 * node + 1])
        ids = token[live].astype("<u4").tobytes()
        ends = np.cumsum(live.sum(axis=1)) * 4
        return [ids[a:b] for a, b in zip([0, *ends[:-1].tolist()], ends.tolist())]

    def one(self, word: bytes) -> bytes:
        """Packed ids of a long word, with a tree of its own."""
        n = len(word)
        width = 1 << max(n - 2, 0).bit_length()
        none = int(_NONE)
        token = self.byte_id[np.frombuffer(word, dtype=np.uint8)]
        base = np.full(2 * width, _NONE)
        base[width:width + n - 1] = self._leaves(token[:-1], token[1:], np.arange(n - 1))
        size = width
        while size > 1:
            half = size >> 1
            base[half:size] = np.minimum(base[size:2 * size:2], base[size + 1:2 * size:2])
            size = half
        tree, ids = base.tolist(), token.tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n))
        rank = self.pair_rank

        def put(at: int, value: int) -> None:
            node = width + at
            tree[node] = value
            node >>= 1
            while node:
                a, b = tree[2 * node], tree[2 * node + 1]
                least = a if a < b else b
                if tree[node] == least:
                    return
                tree[node] = least
                node >>= 1

        def leaf(at: int, to: int) -> int:
            found = rank.get(ids[at] << 32 | ids[to])
            return none if found is None else found << 32 | at

        while tree[1] != none:
            at, merged = tree[1] & 0xFFFFFFFF, tree[1] >> 32
            gone = after[at]
            right, left = after[gone], before[at]
            ids[at], ids[gone], after[at], before[right] = merged, -1, right, at
            if gone < width:
                put(gone, none)
            put(at, leaf(at, right) if right < n else none)
            if left >= 0:
                put(left, leaf(left, at))
        return np.array([i for i in ids if i >= 0], dtype="<u4").tobytes()


class Encoder:
    """Texts to packed ids and back, with a bounded cache of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str) -> None:
        self.merger = Merger(ranks)
        self.pattern = regex.compile(pattern)
        self.whole = {}
        for token, i in ranks.items():
            try:
                self.whole[token.decode("utf-8")] = i.to_bytes(4, "little")
            except UnicodeDecodeError:
                continue  # part of a character is never a whole piece
        self.known: dict[str, bytes] = dict(self.whole)

    def learn(self, pieces: set[str]) -> dict[str, bytes]:
        """The packed ids of (at least) the given pieces."""
        new = pieces - self.known.keys()
        if len(self.known) + len(new) > CACHE_PIECES + len(self.whole):
            self.known = self.whole | {p: self.known[p] for p in pieces if p in self.known}
        coded = [(p, p.encode("utf-8")) for p in new]
        short = [c for c in coded if len(c[1]) <= TOGETHER_BYTES]
        made = dict(zip([p for p, _ in short], self.merger.many([b for _, b in short]))) if short else {}
        made.update((p, self.merger.one(b)) for p, b in coded if len(b) > TOGETHER_BYTES)
        kept = {p: ids for p, ids in made.items() if len(p) <= CACHE_CHARS}
        self.known |= kept
        return self.known if len(kept) == len(made) else self.known | made

    def encode(self, texts: list[str]) -> list[bytes]:
        """Packed ids of each text; a text is worked off slice by slice."""
        out = [[] for _ in texts]
        held: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for part in slices(text):
                held.append((i, self.pattern.findall(part)))
                size += len(part)
                if size >= SLICE_CHARS:
                    self._flush(held, out)
                    size = 0
        self._flush(held, out)
        return [b"".join(parts) for parts in out]

    def _flush(self, held: list[tuple[int, list[str]]], out: list[list[bytes]]) -> None:
        table = self.learn(set().union(*[pieces for _, pieces in held]))
        for i, pieces in held:
            out[i].append(b"".join(map(table.__getitem__, pieces)))
        held.clear()

    def decode(self, ids: bytes) -> bytes:
        """The bytes that packed ids stand for."""
        return b"".join(map(self.merger.bytes_of.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_CUT = regex.compile(r"\S(?=\s)")


def slices(text: str, most: int = SLICE_CHARS) -> Iterator[str]:
    """Slices of ``most`` characters or a little more, each but the first starting with the white
    space that follows a word: a piece never holds white space after another character."""
    a = 0
    while len(text) - a > most:
        cut = _CUT.search(text, a + most)
        if cut is None:
            break
        yield text[a:cut.end()]
        a = cut.end()
    if a < len(text):
        yield text[a:]


def read_ranks(path: str) -> dict[bytes, int]:
    """The tokens and ranks of a rank file (a base64 token and its rank on each line)."""
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, filter(bytes.strip, f))}


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def encode(docs: DataFrame, path: str, pattern: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``id_col``, ``ids`` (an array) and ``decoded`` (the bytes that those ids decode to) of
    every row. ``path`` names the rank file, which every executor must be able to open."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = _encoder(path, pattern)
        for batch in batches:
            for start, texts in text_groups(batch.column(1), GROUP_BYTES):
                packed = enc.encode(texts)
                ends = np.concatenate([[0], np.cumsum([len(p) // 4 for p in packed])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(ends), pa.array(np.frombuffer(b"".join(packed), dtype="<u4").astype(np.int32)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(texts)), ids, pa.array(list(map(enc.decode, packed)), pa.binary())],
                    names=[id_col, "ids", "decoded"])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(id_col, text_col).mapInArrow(run, f"`{id_col}` {kind}, ids array<int>, decoded binary")


def digests(encoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Token counts and SHA-256 digests of what :func:`encode` returns."""
    decimal = F.array_join(F.col("ids").cast("array<string>"), ",")
    return encoded.select(id_col, F.size("ids").cast("long").alias("n_tokens"), F.sha2(decimal.cast("binary"), 256).alias("ids_sha256"),
                          F.sha2(F.col("decoded"), 256).alias("decoded_sha256"))
