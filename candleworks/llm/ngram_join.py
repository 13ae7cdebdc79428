"""Jaccard join of documents' word-shingle sets (operator 8): a size-aware heavy-light join.

Equal sets are one class, represented by their smallest doc_id. Two classes link if
``100 * intersection >= percent * union``. Which pairs are compared depends on size:

* Light sets (below the boundary): a link of sizes s and t needs at least c(s, t) common
  shingles, so both sets have a common subset of exactly that many. Each light set
  enumerates its subsets of those sizes, and equal subsets meet.
* Heavy sets: each is entered in the inverted lists of its first ``s - ceil(p s) + 1``
  shingles, in an order that all sets share (very frequent shingles last); linked sets
  meet in at least one list. Sets a little below the boundary are entered too, as a
  heavy set may link to them. An entry knows its place in the order: sets of sizes s and
  t that need c common shingles share one of the first s - c + 1 of one and t - c + 1 of
  the other, so a pair only counts where it meets within these places.

The boundary is where the estimated number of subsets plus list entries is least. List
pairs are pruned by size, by place and by a parity bitmap (each differing shingle flips one bit, so
differing bits never exceed the symmetric difference), again by a longer bitmap, and
then proven on the whole sets.
A long list is cut into blocks and its pairs of blocks are dealt to different tasks.
Rows that are known to be of one component aren't compared. First come neighbour rounds: every
row goes to one of its lists (the one of smallest hash, another order each round, so rows that share
most lists meet) and asks there for its nearest rows (by bitmap) of other components, in blocks that are dealt
anew each round, while a round still joins a good part of what it asked for. That
is at most two pairs a row, and it joins nearly all of a group of near copies, whether
or not its members link with one another. Then all pairs between the components that are left follow.
``links`` and ``join_links`` leave the neighbour rounds
out: every pair is compared, so every link between different sets is reported (as a pair of
class representatives) and counted (``n_links``, by the documents of the classes).
Nothing is capped: frequent shingles only come last in the order.

Shingles are compared by 64-bit hashes. Cases: null and wordless texts have no shingles
and link with nothing; a text with fewer words than a shingle has one, its whole
sequence; rows that repeat a doc_id with an equal text are one document, and with other
texts are compared and placed as the rows they are (documents are known by a 64-bit hash of
id and text inside); rows with a null doc_id are compared as well, and have a null component
if nothing they link with has an id; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from itertools import combinations
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from candleworks.llm import components
from candleworks.llm._store import empty, one_each, same_class_small, written
from candleworks.llm._words import Words, chunks, grams, mix

SHINGLE_WORDS = 3
PERCENT = 90
#: Shingles in at least this share of the documents come last in the order. At most
#: (mean set size / share) shingles can be so frequent, which bounds what is broadcast.
FREQUENT_SHARE = 1e-4
FREQUENT_LEAST = 16
LARGEST_BOUNDARY = 40
BLOCK_ROWS = 256
SKETCH_WORDS = 8
BROADCAST_ROWS = 500_000
SALTS = 32
#: Pairs of one first row that are kept in mind (past it, some may be asked for twice).
SEEN_PAIRS = 200_000
#: Rows that a row of a list asks for in a neighbour round.
NEIGHBOURS = 2
#: Neighbour rounds go on while one joins this many components for each pair that it asks for.
ROUND_JOINS = 0.1
#: Bytes of text whose shingles are made together.
CHUNK_BYTES = 1 << 19
#: Shingles that are counted together before the shuffle.
COUNTED_TOGETHER = 500_000


def need(s, t, percent: int):
    """Common shingles that a link of sizes ``s`` and ``t`` needs."""
    return -(-percent * (s + t) // (100 + percent))


def first_entries(s: int, percent: int) -> int:
    """Inverted lists that a set of size ``s`` is entered in."""
    return s - -(-percent * s // 100) + 1


def subset_sizes(s: int, boundary: int, percent: int) -> list[int]:
    """Sizes of common subsets with other light sets of a size that can link."""
    partners = [t for t in range(1, boundary) if min(s, t) * 100 >= percent * max(s, t)]
    sizes = sorted({need(s, t, percent) for t in partners})
    return [] if partners == [s] and sizes == [s] else sizes  # only an equal set could link


def choose_boundary(sizes: dict[int, int], entries_from: dict[int, float], percent: int) -> int:
    """The boundary of least cost. ``sizes``: sets of each small size; ``entries_from[x]``:
    list entries (times their mean list length) of all sets of size ``x`` or more."""
    def cost(x: int) -> float:
        light = sum(n * sum(comb(s, c) for c in subset_sizes(s, x, percent)) for s, n in sizes.items() if s < x)
        return light + entries_from[-(-percent * x // 100)]
    return min(range(1, LARGEST_BOUNDARY + 1), key=cost)


def shingle_sets(words: Words, n: int) -> list[np.ndarray]:
    """The sorted set of shingle hashes of every document of a chunk."""
    all_grams = grams(words.hash, n)
    out = []
    for a, b in zip(words.first[:-1].tolist(), words.first[1:].tolist()):
        if b - a >= n:
            out.append(np.unique(all_grams[a:b - n + 1]))
        elif b > a:
            out.append(grams(words.hash[a:b], b - a) ^ np.uint64(b - a))
        else:
            out.append(all_grams[:0])
    return out


def parity(tokens: np.ndarray) -> bytes:
    """Bit i is set if an odd number of shingles falls on it."""
    bits = np.bincount((tokens >> np.uint64(55)).astype(np.int64), minlength=SKETCH_WORDS * 64) & 1
    return np.packbits(bits.astype(np.uint8)).tobytes()


_INFO = "doc bigint, n int, digest binary, sketch binary, token bigint, seen int"


def _describe(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """A row per document, and a row per shingle that several sets of the batch share."""
    schema = pa.schema([("doc", pa.int64()), ("n", pa.int32()), ("digest", pa.binary()), ("sketch", pa.binary()), ("token", pa.int64()), ("seen", pa.int32())])
    def shared(sets: list[np.ndarray]) -> pa.RecordBatch:
        token, count = np.unique(np.concatenate(sets), return_counts=True)
        token, count = token[count > 1], count[count > 1]
        none = [None] * len(token)
        return pa.RecordBatch.from_arrays([pa.array(none, pa.int64()), pa.array(none, pa.int32()), pa.array(none, pa.binary()), pa.array(none, pa.binary()),
                                           pa.array(token.view(np.int64)), pa.array(count.astype(np.int32))], schema=schema)

    for batch in batches:
        seen: set[bytes] = set()
        sets: list[np.ndarray] = []
        for words in chunks(batch.column(1), lower=True, most=CHUNK_BYTES):
            own = shingle_sets(words, n)
            if sum(map(len, sets)) > COUNTED_TOGETHER:
                yield shared(sets)
                sets = []
            digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in own]
            for d, s in zip(digests, own):
                if d is not None and d not in seen:
                    seen.add(d)
                    sets.append(s)
            none = [None] * len(own)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.rows.start, len(own)), pa.array([len(s) for s in own], pa.int32()),
                                              pa.array(digests, pa.binary()), pa.array([parity(s) for s in own], pa.binary()),
                                              pa.array(none, pa.int64()), pa.array(none, pa.int32())], schema=schema)
        if sets:
            yield shared(sets)


def subset_keys(tokens: np.ndarray, sizes: list[int]) -> np.ndarray:
    """One hash per subset of the given sizes; it doesn't depend on an order."""
    value = mix(tokens)
    total = int(value.sum(dtype=np.uint64))
    value = value.tolist()
    keys = [total - sum(value[i] for i in left) + c * 0x9E3779B97F4A7C15
            for c in sizes for left in combinations(range(len(value)), len(value) - c)]
    return mix(np.array([k % (1 << 64) for k in keys], dtype=np.uint64))


def _enter(batches: Iterable[pa.RecordBatch], n: int, percent: int, boundary: int, frequent: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Subset keys of light sets and list entries of heavy ones; once per distinct set of a batch."""
    heavy_from = -(-percent * boundary // 100)
    for batch in batches:
        ids = batch.column(0)
        seen: set[bytes] = set()
        for words in chunks(batch.column(1), lower=True, most=CHUNK_BYTES):
            rows, keys, places = [], [], []
            for i, s in enumerate(shingle_sets(words, n), words.rows.start):
                if len(s) == 0 or (d := hashlib.blake2b(s.tobytes(), digest_size=16).digest()) in seen:
                    continue
                seen.add(d)
                if len(s) < boundary and (sizes := subset_sizes(len(s), boundary, percent)):
                    rows.append(np.full(len(k := subset_keys(s, sizes)), i))
                    keys.append(k)
                    places.append(np.zeros(len(k), np.int32))  # a common subset is no place in an order
                if len(s) >= heavy_from:
                    often = frequent[np.minimum(np.searchsorted(frequent, s), len(frequent) - 1)] == s if len(frequent) else np.zeros(len(s), bool)
                    k = np.concatenate([s[~often], s[often]])[:first_entries(len(s), percent)]
                    rows.append(np.full(len(k), i)), keys.append(k), places.append(np.arange(len(k), dtype=np.int32))
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).view(np.int64)), ids.take(pa.array(np.concatenate(rows))),
                                                  pa.array(np.concatenate(places))], names=["key", "doc", "place"])


#: A list and a pair of its blocks.
LIST = ("key", "x", "y")


def _nearest(i: np.ndarray, j: np.ndarray, slack: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Of the pairs of rows (``i``, ``j``), those that are among the ``most`` of greatest slack of either row."""
    row, other = np.concatenate([i, j]), np.concatenate([j, i])
    order = np.lexsort([other, -np.concatenate([slack, slack]), row])
    row, other = row[order], other[order]
    begin = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    rank = np.arange(len(row)) - np.repeat(begin, np.diff(np.concatenate([begin, [len(row)]])))
    return row[rank < most], other[rank < most]


def _scan_lists(batches: Iterable[pa.RecordBatch], percent: int, near: bool) -> Iterator[pa.RecordBatch]:
    """Pairs of different components that may link, from rows sorted by list and pair of
    blocks. ``near``: each row's nearest ones only, met at any place."""
    def pairs(t: pa.Table) -> pa.RecordBatch:
        col = {c: t.column(c).combine_chunks() for c in (*LIST, "block", "rep", "root", "n", "place")}
        v = {c: a.to_numpy(zero_copy_only=False) for c, a in col.items()}
        bits = np.frombuffer(b"".join(t.column("sketch").to_pylist()), dtype=np.uint64).reshape(-1, SKETCH_WORDS)
        new = np.concatenate([[True], np.any([v[c][1:] != v[c][:-1] for c in LIST], axis=0)])
        group = np.cumsum(new)
        out_i, out_j, out_slack = [], [], []
        left = np.arange(len(group))
        for lag in range(1, len(group)):
            left = left[left + lag < len(group)]
            left = left[group[left] == group[left + lag]]
            if len(left) == 0:
                break
            i, j = left, left + lag
            apart = (v["root"][i] != v["root"][j]) & ((v["x"][i] == v["y"][i]) | (v["block"][i] != v["block"][j]))
            s, u = v["n"][i].astype(np.int64), v["n"][j].astype(np.int64)
            small, big = np.minimum(s, u), np.maximum(s, u)
            common = need(s, u, percent)
            ok = apart & (small * 100 >= percent * big) & (near | ((v["place"][i] <= s - common) & (v["place"][j] <= u - common)))
            i, j, most = i[ok], j[ok], (s + u - 2 * common)[ok]
            slack = most - np.bitwise_count(bits[i] ^ bits[j]).sum(axis=1, dtype=np.int64)
            ok = slack >= 0
            out_i.append(i[ok]), out_j.append(j[ok]), out_slack.append(slack[ok])
        i, j, slack = (np.concatenate(o) if o else np.zeros(0, np.int64) for o in (out_i, out_j, out_slack))
        if near and len(i):
            i, j = _nearest(i, j, slack, NEIGHBOURS)
        a, b = v["rep"][i], v["rep"][j]
        found = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(found[0]), pa.array(found[1])], names=["a", "b"])

    seen: set[tuple[int, int]] = set()
    lead: int | None = None

    def once(t: pa.Table) -> pa.RecordBatch:
        """The pairs of some lists without those that lists of the same first row have just given."""
        nonlocal seen, lead
        found = pairs(t)
        names = list(zip(*(c.to_pylist() for c in found.columns)))
        fresh = [p not in seen for p in names]
        last = t.column("lead")[t.num_rows - 1].as_py()
        seen = seen if last == lead and len(seen) < SEEN_PAIRS else set()
        lead = last
        seen.update(names)
        return found.filter(pa.array(fresh, pa.bool_()))

    held: pa.Table | None = None
    for batch in batches:
        if batch.num_rows == 0:
            continue
        now = pa.Table.from_batches([batch])
        now = now if held is None else pa.concat_tables([held, now])
        # The last group may go on in the next batch.
        end = now.num_rows
        ends = [now.column(c)[end - 1].as_py() for c in LIST]
        tail = np.flatnonzero(~np.all([now.column(c).to_numpy() == e for c, e in zip(LIST, ends)], axis=0))
        cut = int(tail[-1]) + 1 if len(tail) else 0
        if cut:
            yield once(now.slice(0, cut).combine_chunks())
        held = now.slice(cut)
    if held is not None and held.num_rows:
        yield once(held.combine_chunks())


def wide_parity(tokens: np.ndarray) -> bytes:
    """A parity bitmap with about as many bits as there are shingles (a power of two)."""
    power = max(9, int(len(tokens)).bit_length())
    return np.packbits((np.bincount((tokens >> np.uint64(64 - power)).astype(np.int64), minlength=1 << power) & 1).astype(np.uint8)).tobytes()


def differing_bits(x: bytes, y: bytes) -> int:
    """A lower bound of the symmetric difference; the longer bitmap is folded to the shorter."""
    a, b = sorted((np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)), key=len)
    if len(b) > len(a):
        bits = np.unpackbits(b.view(np.uint8)).reshape(len(a) * 64, -1)
        b = np.packbits(np.bitwise_xor.reduce(bits, axis=1)).view(np.uint64)
    return int(np.bitwise_count(a ^ b).sum())


def _prune(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = [differing_bits(x, y) <= s + t - 2 * need(s, t, percent) for s, t, x, y in zip(*(batch.column(i).to_pylist() for i in range(2, 6)))]
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _sets(batches: Iterable[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for words in chunks(batch.column(1), lower=True, most=CHUNK_BYTES):
            own = shingle_sets(words, n)
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(words.rows.start, len(own)), pa.array([len(s) for s in own], pa.int32()), pa.array([wide_parity(s) for s in own], pa.binary()),
                                              pa.array([s.tobytes() for s in own], pa.binary())], names=["doc", "n", "bits", "tokens"])


def _prove(batches: Iterable[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep = []
        for x, y in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist()):
            s, t = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            keep.append(len(np.intersect1d(s, t, assume_unique=True)) >= need(len(s), len(t), percent))
        yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))


def _open_lists(rows: DataFrame, known: DataFrame | None) -> tuple[DataFrame, bool]:
    """The rows (``key``, ``rep``, ``place``, ``root``) of lists that hold several components, with the
    ``size`` and the first row (``lead``) of their list, and whether there are any. ``rows`` are the open rows of the
    round before; ``known`` are the components that their roots have become part of."""
    if known is not None:
        rows = rows.join(known.select(F.col("node").alias("root"), F.col("root").alias("to")), "root", "left").select(
            "key", "rep", "place", F.coalesce("to", "root").alias("root"))
    lists = rows.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("root").alias("low"), F.max("root").alias("high"),
                                    F.min("rep").alias("lead")).where("low < high")
    still = written(rows.select("key", "rep", "place", "root").join(lists.select("key", "size", "lead"), "key"), "shingle-open")
    return still, not still.isEmpty()


def _candidates(rooted: DataFrame, sets: DataFrame, percent: int, turn: int) -> DataFrame:
    """Pairs to prove: of the lists' rows, those between components of the links so far.
    Sizes and bitmaps (``sets``) are attached last, for the one shuffle that needs them.
    ``turn`` is the number of the neighbour round, which fixes its blocks; 0 asks for all pairs."""
    if turn:  # every row goes to one of its lists, the same for rows that share most of them
        one = F.min(F.struct(F.xxhash64("key", F.lit(turn)).alias("_h"), "key", "size", "lead", "place", "root"))
        rooted = rooted.groupBy("rep").agg(one.alias("l")).select("rep", "l.key", "l.size", "l.lead", "l.place", "l.root")
    rooted = rooted.withColumn("blocks", F.ceil(F.col("size") / BLOCK_ROWS).cast("int"))
    rooted = rooted.withColumn("block", F.pmod(F.xxhash64("rep", F.lit(turn)), F.col("blocks")).cast("int"))
    if turn:  # rows of one block meet
        dealt = rooted.withColumn("x", F.col("block")).withColumn("y", F.col("block"))
    else:
        dealt = rooted.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumn(
            "x", F.least("block", "other")).withColumn("y", F.greatest("block", "other"))
    # Lists of one group of near copies mostly have the same first row; dealt by it, they meet, and a
    # pair that stands in many of them is asked for once.
    by = ("lead", "x", "y")
    dealt = dealt.select(*LIST, "lead", "block", "rep", "root", "place").join(sets, "rep").select(
        *LIST, "lead", "block", "rep", "root", "place", "n", "sketch").repartition(*by).sortWithinPartitions(*by, "key", "rep")
    return written(dealt.mapInArrow(lambda it: _scan_lists(it, percent, turn > 0), "a bigint, b bigint").distinct(), "shingle-pairs")


def _proven(pairs: DataFrame, texts: DataFrame, n: int, percent: int) -> DataFrame:
    """The pairs that link, decided on the whole sets of the documents that they name."""
    named = pairs.select("a").unionByName(pairs.select(F.col("b").alias("a"))).distinct().withColumnRenamed("a", "doc")
    named = F.broadcast(named) if same_class_small(named, BROADCAST_ROWS) else named
    sets = written(texts.join(named, "doc", "left_semi").mapInArrow(lambda it: _sets(it, n), "doc bigint, n int, bits binary, tokens binary"), "shingle-proof")
    side = lambda at, *names: sets.select(F.col("doc").alias(at), *[F.col(c).alias(f"{c}_{at}") for c in names])
    both = pairs.join(side("a", "n", "bits"), "a").join(side("b", "n", "bits"), "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b")
    likely = written(both.mapInArrow(lambda it: _prune(it, percent), "a bigint, b bigint"), "shingle-likely")
    sides = likely.join(side("a", "tokens"), "a").join(side("b", "tokens"), "b").select("a", "b", "tokens_a", "tokens_b")
    return written(sides.mapInArrow(lambda it: _prove(it, percent), "a bigint, b bigint").distinct(), "shingle-links")


def _entered(docs: DataFrame, id_col: str, text_col: str, n: int, percent: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The texts; per document its size and class; the rows of the lists; the classes."""
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    told = written(texts.mapInArrow(lambda it: _describe(it, n), _INFO), "shingle-sets")
    info = told.where("n is not null").select("doc", "n", "digest", "sketch", F.pmod(F.xxhash64("doc"), F.lit(SALTS)).alias("salt"))
    salted = info.where("digest is not null").groupBy("digest", "salt").agg(F.min("doc").alias("least"))
    reps = salted.select("digest", "salt", F.min("least").over(Window.partitionBy("digest")).alias("rep"))
    info = written(info.join(reps, ["digest", "salt"], "left").select("doc", "n", "sketch", "rep"), "shingle-classes")

    # The order's frequent shingles, and the boundary by cost.
    distinct = info.where("doc = rep").select("rep", "n", "sketch").dropDuplicates(["rep"])
    total, = distinct.agg(F.count(F.lit(1))).first()
    counts = told.where("token is not null").groupBy("token").agg(F.sum("seen").alias("seen"))
    most = max(FREQUENT_LEAST, total * FREQUENT_SHARE)
    frequent = np.sort(counts.where(F.col("seen") >= most).select("token").toPandas()["token"].to_numpy(np.int64).view(np.uint64))
    shared, = told.agg(F.sum("seen")).first()
    small = {r[0]: r[1] for r in distinct.where(F.col("n") <= LARGEST_BOUNDARY).groupBy("n").count().collect()}
    large, tokens = distinct.agg(F.sum(F.when(F.col("n") > LARGEST_BOUNDARY, F.col("n") - F.ceil(F.col("n") * percent / 100) + 1)), F.sum("n")).first()
    length = 1 + (shared or 0) / max(tokens or 0, 1)
    entries_from = {x: length * ((large or 0) + sum(c * first_entries(s, percent) for s, c in small.items() if s >= x)) for x in range(LARGEST_BOUNDARY + 1)}
    boundary = choose_boundary(small, entries_from, percent)

    sent = spark.sparkContext.broadcast(frequent)
    entries = texts.where("doc is not null").mapInArrow(lambda it: _enter(it, n, percent, boundary, sent.value), "key bigint, doc bigint, place int")
    entries = written(entries, "shingle-lists")
    lists = entries.groupBy("key").count().where("count > 1")
    rows = entries.join(lists.select("key"), "key").join(info.select("doc", "rep").distinct(), "doc").select("key", "rep", "place").distinct()
    rows = written(rows, "shingle-rows")
    distinct = written(distinct, "shingle-distinct")
    return texts, info, rows, distinct


def classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Per document ``doc``, its ``n_shingles`` and its class ``rep``; and ``node``, ``root``
    of every class that links lead to a smaller one."""
    spark = docs.sparkSession
    texts, info, rows, distinct = _entered(docs, id_col, text_col, n, percent)
    known, turn = None, 1
    fresh = None
    open_rows = rows.withColumn("root", F.col("rep"))
    while True:
        open_rows, some = _open_lists(open_rows, fresh)
        if not some:
            break
        asked = _candidates(open_rows, distinct, percent, turn)
        found = _proven(asked, texts, n, percent)
        if not found.isEmpty():
            known = components.joined(known if known is not None else empty(spark, "node bigint, root bigint"), found)
            fresh = known
        else:
            fresh = None
        if not turn:
            break
        # A round joins at most as many components as it has links that lead to different ones.
        turn = turn + 1 if fresh is not None and _joins(open_rows, known) >= ROUND_JOINS * asked.count() else 0
    known = known if known is not None else empty(spark, "node bigint, root bigint")
    return info.select("doc", F.col("n").cast("long").alias("n_shingles"), "rep"), known


def _joins(rows: DataFrame, known: DataFrame) -> int:
    """How many components of open rows have become part of another."""
    return rows.select(F.col("root").alias("node")).distinct().join(known.select("node"), "node", "left_semi").count()


def links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """Per document ``doc``, its ``n_shingles`` and its class ``rep``; and every link between
    two classes, ``a`` < ``b``. No star round: pairs of one component are compared as well."""
    texts, info, rows, distinct = _entered(docs, id_col, text_col, n, percent)
    open_rows, _ = _open_lists(rows.withColumn("root", F.col("rep")), None)
    found = _proven(_candidates(open_rows, distinct, percent, 0), texts, n, percent)
    return info.select("doc", F.col("n").cast("long").alias("n_shingles"), "rep"), found


def weighted(info: DataFrame, found: DataFrame) -> DataFrame:
    """``rep`` and ``n_links`` of every class: the documents that each of its members links
    with, those of its own class (equal sets) and those of the classes it links with."""
    members = info.where("doc is not null and rep is not null").select("doc", "rep").distinct().groupBy("rep").agg(F.count(F.lit(1)).alias("members"))
    members = written(members, "shingle-members")
    both = found.select(F.col("a").alias("rep"), F.col("b").alias("other")).unionByName(found.select(F.col("b").alias("rep"), F.col("a").alias("other")))
    beyond = both.join(members.select(F.col("rep").alias("other"), "members"), "other").groupBy("rep").agg(F.sum("members").alias("beyond"))
    return members.join(beyond, "rep", "left").select("rep", (F.col("members") - 1 + F.coalesce("beyond", F.lit(0))).alias("n_links"))


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row with ``_row``, which tells rows of one id and different texts apart."""
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"), F.xxhash64(id_col, text_col).alias("_row"))


def _placed(keyed: DataFrame, info: DataFrame, known: DataFrame) -> DataFrame:
    """Per row: ``_id``, ``_row``, ``n_shingles``, ``rep`` and the ``root`` of its component."""
    rows = keyed.select("_id", "_row").join(info.distinct(), F.col("_row") == F.col("doc"))
    rows = rows.join(known, F.col("rep") == F.col("node"), "left")
    return written(rows.select("_id", "_row", "n_shingles", "rep", F.coalesce("root", "rep", "_row").alias("root"),
                               F.pmod(F.xxhash64("_row"), F.lit(SALTS)).alias("salt")), "shingle-placed")


def _with_component(placed: DataFrame) -> DataFrame:
    """``component_id``: the smallest id of a row's component."""
    least = placed.groupBy("root", "salt").agg(F.min("_id").alias("least")).select(
        "root", "salt", F.min("least").over(Window.partitionBy("root")).alias("component_id"))
    return placed.join(least, ["root", "salt"])


def join_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """As :func:`join`, and ``n_links``, the number of documents that a document links with."""
    keyed = _keyed(docs, id_col, text_col)
    info, found = links(keyed, "_row", "_text", n, percent)
    rows = _with_component(_placed(keyed, info, components.roots(found))).join(weighted(info, found), "rep", "left")
    return rows.select(F.col("_id").alias(id_col), "n_shingles", "component_id", F.coalesce("n_links", F.lit(0)).alias("n_links"))


def join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """Per row: the id, ``n_shingles`` and ``component_id``, the smallest id that links lead to."""
    keyed = _keyed(docs, id_col, text_col)
    rows = _with_component(_placed(keyed, *classes(keyed, "_row", "_text", n, percent)))
    return rows.select(F.col("_id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", n: int = SHINGLE_WORDS, percent: int = PERCENT) -> DataFrame:
    """One row of every component, of its smallest id (a null id comes last), with all its columns."""
    keyed = _keyed(docs, id_col, text_col)
    placed = _placed(keyed, *classes(keyed, "_row", "_text", n, percent))
    first = placed.groupBy("root").agg(F.min(F.struct(F.col("_id").isNull().alias("none"), "_id", "_row")).alias("f"))
    kept = written(first.select(F.col("f._row").alias("_kept")), "shingle-kept")
    rows = docs.select(F.struct("*").alias("_doc"), F.xxhash64(id_col, text_col).alias("_row"))
    return one_each(rows.join(kept, F.col("_row") == F.col("_kept"), "left_semi"), "_row").select("_doc.*")
