"""Text quality by a generalised additive model with pairwise interactions.

Shallow trees on one feature at a time are boosted in cycles and add up to one lookup table per feature;
the strongest pairs then get tables of their own. A score is the sum of table entries, found by binning.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .arrays import slices, text_bytes, words_of
from .language import held_out
from .store import written

#: Labelled rows that the fit sees at most: those with the smallest hash of their id.
TRAIN_ROWS = 40_000
BINS, PAIR_BINS, PAIRS = 32, 8, 8
ROUNDS, PAIR_ROUNDS, RATE, RIDGE = 150, 60, 0.1, 1.0
THRESHOLD = 0.3
FEATURES = (
    "log_words", "mean_word", "upper_share", "digit_share", "mark_share", "symbol_share", "high_byte_share", "double_mark_share",
    "line_words", "distinct_share", "top_word_share", "repeat_share", "marked_word_share", "longest_word", "repeated_line_share",
)

_byte = np.arange(256)
UPPER = (_byte >= 65) & (_byte <= 90)
LOWER = (_byte >= 97) & (_byte <= 122)
DIGIT = (_byte >= 48) & (_byte <= 57)
MARK = (_byte > 32) & (_byte < 127) & ~UPPER & ~LOWER & ~DIGIT
PROSE = np.isin(_byte, [ord(c) for c in ".,;:'\"-()?"])


def features_of(column: pa.Array) -> np.ndarray:
    """One row of ``FEATURES`` for each text; all zero for a text without words."""
    data, offsets = text_bytes(column)
    out = np.zeros((len(offsets) - 1, len(FEATURES)))
    for i, j in slices(offsets):
        own, at = data[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]
        words = words_of(own, at)
        if len(words.starts):
            out[i:j] = _slice_features(own, at, words)
    return out


def _slice_features(data: np.ndarray, offsets: np.ndarray, words) -> np.ndarray:
    texts = len(offsets) - 1
    n_words = np.diff(words.bounds)
    some = np.maximum(n_words, 1)

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags)])
        return sums[offsets[1:]] - sums[offsets[:-1]]

    size = words.ends - words.starts
    owner = words.texts()
    letters = np.bincount(owner, weights=size, minlength=texts)
    solid = np.maximum(letters, 1)
    mark = MARK[data]
    marks = np.concatenate([[0], np.cumsum(mark)])
    hashes = words.hashes()
    same = np.zeros(len(hashes), dtype=bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (owner[1:] == owner[:-1])
    order = np.lexsort((hashes, owner))
    heads = np.flatnonzero(np.concatenate([[True], (hashes[order][1:] != hashes[order][:-1]) | (owner[order][1:] != owner[order][:-1])]))
    counts = np.diff(np.append(heads, len(order)))
    top = np.zeros(texts)
    np.maximum.at(top, owner[order][heads], counts)
    longest = np.zeros(texts)
    np.maximum.at(longest, owner, size)
    double = np.zeros(len(data), dtype=bool)
    double[1:] = mark[1:] & mark[:-1]
    lines = per_text(data == 10) + 1
    repeated = np.zeros(texts)
    for k in np.flatnonzero(lines > 2).tolist():
        held = data[offsets[k] : offsets[k + 1]].tobytes().split(b"\n")
        repeated[k] = 1 - len(set(held)) / len(held)
    columns = [
        np.log1p(n_words), letters / some, per_text(UPPER[data]) / np.maximum(per_text(UPPER[data] | LOWER[data]), 1), per_text(DIGIT[data]) / solid,
        per_text(mark) / solid, per_text(mark & ~PROSE[data]) / solid, per_text(data > 127) / solid, per_text(double) / solid,
        np.log1p(n_words / lines), np.bincount(owner[order][heads], minlength=texts) / some, top / some, np.bincount(owner, weights=same, minlength=texts) / some,
        np.bincount(owner, weights=marks[words.ends] > marks[words.starts], minlength=texts) / some, np.log1p(longest), repeated,
    ]
    return np.where(n_words[:, None] > 0, np.stack(columns, axis=1), 0.0)


class Model(NamedTuple):
    """Bin edges and tables of the features, and of the pairs on coarser bins."""

    base: float
    edges: list[np.ndarray]
    tables: list[np.ndarray]
    pairs: list[tuple[int, int]]
    pair_edges: list[np.ndarray]
    pair_tables: list[np.ndarray]

    def scores(self, x: np.ndarray) -> np.ndarray:
        total = np.full(len(x), self.base)
        for k, (edges, values) in enumerate(zip(self.edges, self.tables)):
            total += values[np.searchsorted(edges, x[:, k], side="right")]
        for (a, b), values in zip(self.pairs, self.pair_tables):
            total += values[np.searchsorted(self.pair_edges[a], x[:, a], side="right"), np.searchsorted(self.pair_edges[b], x[:, b], side="right")]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _edges(values: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(values, np.arange(1, bins) / bins))


def _tree(gradient: np.ndarray, weight: np.ndarray, leaves: int = 4) -> np.ndarray:
    """Leaf value for each bin of a tree that splits the ordered bins where the gain is largest."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    value = lambda a, b: (g[b] - g[a]) ** 2 / (h[b] - h[a] + RIDGE)
    parts = [(0, len(gradient))]
    while len(parts) < leaves:
        best, chosen = 1e-9, None
        for a, b in parts:
            if b - a < 2:
                continue
            cut = np.arange(a + 1, b)
            gain = value(a, cut) + value(cut, b) - value(a, b)
            if gain.max() > best:
                best, chosen = gain.max(), (a, int(cut[gain.argmax()]), b)
        if chosen is None:
            break
        parts.remove((chosen[0], chosen[2]))
        parts += [chosen[:2], chosen[1:]]
    out = np.zeros(len(gradient))
    for a, b in parts:
        out[a:b] = (g[b] - g[a]) / (h[b] - h[a] + RIDGE)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray) -> tuple[float, np.ndarray]:
    """The best tree of one cut on each axis: its gain and its value for each cell."""
    g = np.pad(gradient.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    h = np.pad(weight.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    m, n = gradient.shape
    best, out = 0.0, np.zeros_like(gradient)
    for i in range(1, m):
        for j in range(1, n):
            cells = [(slice(0, i), slice(0, j)), (slice(0, i), slice(j, n)), (slice(i, m), slice(0, j)), (slice(i, m), slice(j, n))]
            sums = [(g[r.stop, c.stop] - g[r.start, c.stop] - g[r.stop, c.start] + g[r.start, c.start], h[r.stop, c.stop] - h[r.start, c.stop] - h[r.stop, c.start] + h[r.start, c.start]) for r, c in cells]
            gain = sum(a * a / (b + RIDGE) for a, b in sums)
            if gain > best:
                best, out = gain, np.zeros_like(gradient)
                for (r, c), (a, b) in zip(cells, sums):
                    out[r, c] = a / (b + RIDGE)
    return best, out


def fit(x: np.ndarray, y: np.ndarray) -> Model:
    """Boost the tables in cycles over the features, then over the strongest pairs, by Newton steps."""
    width = len(FEATURES)
    if len(y) == 0:
        empty = [np.empty(0)] * width
        return Model(0.0, empty, [np.zeros(1)] * width, [], empty, [])
    share = np.clip(y.mean(), 1e-3, 1 - 1e-3)
    base = float(np.log(share / (1 - share)))
    edges = [_edges(x[:, k], BINS) for k in range(width)]
    bins = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(edges)]
    tables = [np.zeros(len(e) + 1) for e in edges]
    total = np.full(len(y), base)
    for _ in range(ROUNDS):
        for k in range(width):
            p = 1 / (1 + np.exp(-total))
            size = len(tables[k])
            step = RATE * _tree(np.bincount(bins[k], y - p, size), np.bincount(bins[k], p * (1 - p), size))
            tables[k] += step
            total += step[bins[k]]
    coarse = [_edges(x[:, k], PAIR_BINS) for k in range(width)]
    place = [np.searchsorted(e, x[:, k], side="right") for k, e in enumerate(coarse)]

    def histograms(a: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        shape = (len(coarse[a]) + 1, len(coarse[b]) + 1)
        cell = place[a] * shape[1] + place[b]
        return np.bincount(cell, y - p, shape[0] * shape[1]).reshape(shape), np.bincount(cell, p * (1 - p), shape[0] * shape[1]).reshape(shape)

    gains = {(a, b): _quadrants(*histograms(a, b))[0] for a, b in combinations(range(width), 2)}
    pairs = sorted(gains, key=lambda k: -gains[k])[:PAIRS]
    pair_tables = [np.zeros((len(coarse[a]) + 1, len(coarse[b]) + 1)) for a, b in pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(pairs):
            step = RATE * _quadrants(*histograms(a, b))[1]
            pair_tables[k] += step
            total += step[place[a], place[b]]
    return Model(base, edges, tables, pairs, coarse, pair_tables)


def text_features(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every whole text; a null text counts as empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = features_of(batch.column("text"))
            flat = pa.array(values.ravel(), pa.float64())
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(values) + 1) * len(FEATURES), pa.int32()), flat)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], names=["doc_id", "features"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, features array<double>")


def learn(labelled: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """Fit on the ``train_rows`` rows (doc_id, features, quality) whose ids have the smallest hashes."""
    chosen = labelled.orderBy(F.xxhash64("doc_id"), "doc_id").limit(train_rows).select("features", "quality").toArrow()
    features = chosen.column("features").combine_chunks()
    x = np.asarray(features.flatten()).reshape(-1, len(FEATURES)) if len(features) else np.empty((0, len(FEATURES)))
    return fit(x, np.asarray(chosen.column("quality").cast(pa.float64())))


def score_quality(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """Score every whole text; learn from labels whose crc32(doc_id) mod 5 is not 0.

    ``docs`` has doc_id and text, ``labels`` doc_id and quality (0 or 1; null is no label; of repeated
    labels the lowest counts). Result, one row per row of ``docs``: doc_id, held_out, score, predicted. A
    null or empty text has features of its own and a score like any other; without labels all score 0.5.
    Other columns are not read.
    """
    features = written(text_features(docs), "features")
    marks = labels.filter("quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").cast("int").alias("quality"))
    marks = marks.filter(~held_out(F.col("doc_id"), 5, 0))
    sent = docs.sparkSession.sparkContext.broadcast(learn(features.join(marks, "doc_id")))  # tables of a few KB

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        for batch in batches:
            x = np.asarray(batch.column("features").flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(model.scores(x))], names=["doc_id", "score"])

    scored = features.mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id"), 5, 0).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
