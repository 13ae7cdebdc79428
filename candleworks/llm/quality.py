"""Quality scores (operator 5): random Fourier features of document statistics, ridge
regression by partition-summed normal equations, isotonic calibration.

The statistics of a text (shares of capitals, digits, symbols and line ends, word lengths,
repeated words, triples and lines, and so on) are computed once for every document and
written. Labelled rows are standardised by their own mean and spread, mapped to cosines
that approximate a Gaussian kernel, and each partition sums its part of the normal
equations; Spark adds the parts, of a size that the number of features fixes. Scores of
the labelled rows are counted in ``BINS`` bins, pooled to a rising step function, and that
turns ridge scores into probabilities. All labelled rows outside the held-out fold count.

Cases: a null text counts as empty, whose statistics are zeros; without labelled rows of
both kinds every score is 0.5; repeated rows score alike; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from candleworks.llm import _labels
from candleworks.llm._store import written
from candleworks.llm._words import _buffers, chunks, grams

FEATURES = 512
WIDTH = 2.0
RIDGE = 1e-3
BINS = 400
SEED = 11

_KIND = np.zeros(256, dtype=np.int8)  # 0 other ASCII, 1 small, 2 capital, 3 digit, 4 . and comma, 5 other mark, 6 white space, 7 line end, 8 beyond ASCII
_KIND[33:127] = 5
_KIND[97:123], _KIND[65:91], _KIND[48:58] = 1, 2, 3
_KIND[[44, 46]] = 4
_KIND[[32, 9, 11, 12, 13]] = 6
_KIND[10] = 7
_KIND[128:] = 8
KINDS = 9


def _distinct(values: np.ndarray, owner: np.ndarray, docs: int) -> tuple[np.ndarray, np.ndarray]:
    """Number of different values per document, and how often its commonest occurs."""
    if len(values) == 0:
        return np.zeros(docs), np.zeros(docs)
    order = np.lexsort((values, owner))
    v, o = values[order], owner[order]
    new = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (o[1:] != o[:-1])]))
    runs = np.diff(np.concatenate([new, [len(v)]]))
    most = np.zeros(docs)
    np.maximum.at(most, o[new], runs)
    return np.bincount(o[new], minlength=docs).astype(float), most


def statistics(column: pa.Array) -> np.ndarray:
    """One row of document statistics per text."""
    out = []
    off_all, _ = _buffers(column)
    for words in chunks(column):
        docs = len(words.first) - 1
        off = off_all[words.rows.start:words.rows.stop + 1] - off_all[words.rows.start]
        doc_of_byte = np.repeat(np.arange(docs), np.diff(off))
        kinds = np.bincount(doc_of_byte * KINDS + _KIND[words.data], minlength=docs * KINDS).reshape(docs, KINDS).astype(float)
        size = np.maximum(np.diff(off), 1)[:, None]
        owner = np.repeat(np.arange(docs), np.diff(words.first))
        n = np.diff(words.first).astype(float)
        at_least = np.maximum(n, 1)
        length = (words.end - words.start).astype(float)
        mean = np.bincount(owner, length, docs) / at_least
        spread = np.sqrt(np.maximum(np.bincount(owner, length ** 2, docs) / at_least - mean ** 2, 0))
        different, commonest = _distinct(words.hash, owner, docs)
        triples = grams(words.hash, 3)
        inside = owner[:len(triples)] == owner[2:2 + len(triples)] if len(triples) else np.zeros(0, bool)
        triple_kinds, triple_most = _distinct(triples[inside], owner[:len(triples)][inside], docs)
        again = np.bincount(owner[1:], (words.hash[1:] == words.hash[:-1]) & (owner[1:] == owner[:-1]), docs) if len(owner) else np.zeros(docs)
        first, last = _KIND[words.data[words.start]], _KIND[words.data[words.end - 1]]
        share = lambda flag: np.bincount(owner, flag, docs) / at_least
        lone = (length == 1) & (first == 5)
        out.append(np.column_stack([
            np.log1p(np.diff(off)), np.log1p(n), kinds / size, mean, spread, different / at_least, commonest / at_least,
            triple_kinds / np.maximum(n - 2, 1), triple_most / np.maximum(n - 2, 1), again / at_least,
            share(first == 2), share(last == 5), share(last == 4), share(lone), share(length <= 2), np.minimum(n / np.maximum(kinds[:, 7] + 1, 1), 100) / 100]))
    return np.vstack(out) if out else np.zeros((0, 0))


def describe(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``_id`` and ``_x``, the statistics, of every row."""
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = statistics(batch.column(1)).astype(np.float32)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(rows), pa.list_(pa.float32()))], names=["_id", "_x"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col)).mapInArrow(run, f"_id {docs.schema[id_col].dataType.simpleString()}, _x array<float>")


class Model:
    """Mean and spread of the statistics, random directions, ridge weights, and the steps of the calibration."""

    def __init__(self, mean: np.ndarray, spread: np.ndarray) -> None:
        random = np.random.default_rng(SEED)
        self.mean, self.spread = mean, np.maximum(spread, 1e-6)
        self.directions = random.normal(size=(len(mean), FEATURES)) / (WIDTH * np.sqrt(len(mean)) / 2)
        self.phase = random.uniform(0, 2 * np.pi, FEATURES)
        self.weights = np.zeros(FEATURES + 1)
        self.steps, self.values = np.zeros(1), np.full(1, 0.5)

    def features(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.spread, -5, 5)
        return np.hstack([np.sqrt(2 / FEATURES) * np.cos(z @ self.directions + self.phase), np.ones((len(x), 1))])

    def ridge(self, x: np.ndarray) -> np.ndarray:
        return self.features(x) @ self.weights

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.ridge(x), self.steps, self.values), 0, 1)


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=np.float64)


def rising(total: np.ndarray, good: np.ndarray) -> np.ndarray:
    """The rising shares nearest to good / total (pool adjacent violators)."""
    blocks: list[list[float]] = []
    for t, g in zip(total.tolist(), good.tolist()):
        blocks.append([t, g, 1])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            t2, g2, k2 = blocks.pop()
            blocks[-1] = [blocks[-1][0] + t2, blocks[-1][1] + g2, blocks[-1][2] + k2]
    return np.concatenate([np.full(int(k), g / t) for t, g, k in blocks])


def fit(described: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality", folds: int = 3, held_out: int = 1) -> Model | None:
    """A model from every labelled row outside the held-out fold; ``described`` comes from :func:`describe`."""
    rows = written(described.join(_labels.training(labels, id_col, label_col, folds, held_out), "_id").select("_x", "_y"), "quality-rows")
    if rows.select("_y").distinct().count() < 2:
        return None
    cell = rows.select(F.posexplode("_x").alias("i", "v"))
    moments = cell.groupBy("i").agg(F.avg("v"), F.stddev_pop("v")).orderBy("i").collect()
    model = Model(np.array([r[1] for r in moments]), np.array([r[2] for r in moments]))

    def equations(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        total = np.zeros((size, size + 1))
        for batch in batches:
            z, y = model.features(_matrix(batch.column(0))), batch.column(1).to_numpy().astype(float)
            total += np.hstack([z.T @ z, (z.T @ y)[:, None]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size), pa.int64()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.mapInArrow(equations, "i bigint, row array<double>").select("i", F.posexplode("row").alias("j", "v"))
    total = np.zeros((FEATURES + 1, FEATURES + 2))
    summed = parts.groupBy("i", "j").agg(F.sum("v").alias("v")).toPandas()
    total[summed["i"], summed["j"]] = summed["v"]
    n = total[-1, -2]
    model.weights = np.linalg.solve(total[:, :-1] + RIDGE * n / FEATURES * np.eye(FEATURES + 1), total[:, -1])

    def binned(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.clip(np.floor((model.ridge(_matrix(batch.column(0))) + 0.5) / 2 * BINS), 0, BINS - 1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(at), batch.column(1)], names=["bin", "_y"])

    counts = rows.mapInArrow(binned, "bin bigint, _y int").groupBy("bin").agg(F.count(F.lit(1)), F.sum("_y")).orderBy("bin").collect()
    bins, all_rows, good = np.array([tuple(r) for r in counts], dtype=float).T
    model.steps, model.values = (bins + 0.5) / BINS * 2 - 0.5, rising(all_rows, good)
    return model


def score(described: DataFrame, model: Model | None, id_col: str = "doc_id") -> DataFrame:
    """``id_col`` and ``score`` of every described row."""
    if model is None:
        return described.select(F.col("_id").alias(id_col), F.lit(0.5).alias("score"))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.scores(_matrix(batch.column(1))))], names=[id_col, "score"])

    return described.mapInArrow(run, f"`{id_col}` {described.schema['_id'].dataType.simpleString()}, score double")
