"""Text quality by a generalised additive model with pairwise interactions, trained in numpy on a bounded labelled sample.

Every text becomes a row of surface features, all of it read, none of its other columns. Shallow trees are boosted on one
feature after the other, round and round, and what they add is kept as a lookup table per feature; trees over the
strongest pairs of features follow. A score is the sum of a text's table entries through the logistic function.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import store, text_of
from mercato.llm.langid import held_out
from mercato.llm.shingles import mix64, word_hashes

SAMPLE_ROWS = 20_000  # labelled rows training may read: the first in hash order
BINS, PAIR_BINS = 32, 8  # of a feature alone, and of each side of a pair
PAIRS = 6
ROUNDS, PAIR_ROUNDS = 120, 40
RATE = 0.1
RIDGE = 1.0  # added to every leaf's weight
THRESHOLD = 0.3

FEATURES = (
    "log_chars", "upper", "lower", "digit", "space", "newline", "exclamation", "symbol", "bar", "stop", "other", "entropy",
    "log_words", "word_length", "distinct_words", "repeated_words", "top_word", "distinct_pairs", "repeated_lines",
)
_CLASSES = {
    "upper": b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", "lower": b"abcdefghijklmnopqrstuvwxyz", "digit": b"0123456789", "space": b" \t\x0b\x0c\r\n",
    "newline": b"\n", "exclamation": b"!", "symbol": b"#$%&*", "bar": b"|", "stop": b".,;:?", "other": b"\"'()+-/<=>@[\\]^_`{}~",
}
_MEMBERS = np.array([[b in chars for chars in _CLASSES.values()] for b in range(256)], dtype=np.float64)
_PAIR = np.uint64(0x9E3779B97F4A7C15)


def _longest_run(ordered: np.ndarray) -> tuple[int, int]:
    """Distinct values of a sorted array, and how often the most frequent one stands there."""
    edges = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1], [True]]))
    return len(edges) - 1, int(np.diff(edges).max())


def features_of(texts: list[str]) -> np.ndarray:
    """A row of FEATURES per text; an empty text has zeros."""
    out = np.zeros((len(texts), len(FEATURES)))
    for i, (text, hashes) in enumerate(zip(texts, word_hashes(texts), strict=True)):
        data = np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8)
        if not len(data):
            continue
        counts = np.bincount(data, minlength=256)
        chars = len(data) - int(counts[128:192].sum())  # continuation bytes begin no character
        part = counts[counts > 0] / len(data)
        row = out[i]
        row[0], row[11] = np.log1p(chars), -(part * np.log2(part)).sum()
        row[1:11] = counts @ _MEMBERS / chars
        n = len(hashes)
        if n:
            different, most = _longest_run(np.sort(hashes))
            row[12:15] = np.log1p(n), (chars - int(counts[32] + counts[9:14].sum())) / n, different / n
            row[16] = most / n
        if n > 1:
            row[15] = (hashes[1:] == hashes[:-1]).sum() / (n - 1)
            row[17] = _longest_run(np.sort(mix64(hashes[:-1] * _PAIR + hashes[1:])))[0] / (n - 1)
        lines = [x for x in text.split("\n") if x]
        row[18] = 1 - len(set(lines)) / len(lines) if lines else 0
    return out


@dataclass
class Additive:
    """Lookup tables of single features and of pairs; ``edges`` cut features into bins, ``coarse`` the sides of pairs."""

    intercept: float
    edges: list[np.ndarray] = field(default_factory=list)
    tables: list[np.ndarray] = field(default_factory=list)
    coarse: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    grids: list[np.ndarray] = field(default_factory=list)

    def logits(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.intercept)
        for j, (edges, table) in enumerate(zip(self.edges, self.tables, strict=True)):
            out += table[np.searchsorted(edges, x[:, j], side="right")]
        for (a, b), grid in zip(self.pairs, self.grids, strict=True):
            out += grid[np.searchsorted(self.coarse[a], x[:, a], side="right"), np.searchsorted(self.coarse[b], x[:, b], side="right")]
        return out

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.logits(x))


def _logistic(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def _cuts(column: np.ndarray, bins: int) -> np.ndarray:
    return np.unique(np.quantile(column, np.arange(1, bins) / bins))


def _gain(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    return g * g / (h + RIDGE)


def _best_cut(g: np.ndarray, h: np.ndarray) -> tuple[float, int]:
    """Gain and place of the best cut of a line of bins; place 0 is no cut."""
    if len(g) < 2:
        return 0.0, 0
    left_g, left_h = np.cumsum(g)[:-1], np.cumsum(h)[:-1]
    gains = _gain(left_g, left_h) + _gain(g.sum() - left_g, h.sum() - left_h) - _gain(g.sum(), h.sum())
    at = int(gains.argmax())
    return (float(gains[at]), at + 1) if gains[at] > 1e-9 else (0.0, 0)


def _line_tree(g: np.ndarray, h: np.ndarray) -> np.ndarray:
    """What a tree of depth two over a line of bins adds to each of them: a Newton step per leaf."""
    out = np.zeros(len(g))
    _, middle = _best_cut(g, h)
    for a, b in ((0, middle), (middle, len(g))):
        if a < b:
            _, at = _best_cut(g[a:b], h[a:b])
            for c, d in ((a, a + at), (a + at, b)):
                if c < d:
                    out[c:d] = g[c:d].sum() / (h[c:d].sum() + RIDGE)
    return out


def _grid_tree(g: np.ndarray, h: np.ndarray) -> tuple[float, np.ndarray]:
    """Gain of a tree over a grid, cut along one side and each half along the other, and what it adds to each cell."""
    best, found = 0.0, np.zeros_like(g)
    for turned in (False, True):
        tg, th = (g.T, h.T) if turned else (g, h)
        for cut in range(1, len(tg)):
            total, add = 0.0, np.zeros_like(tg)
            for a, b in ((0, cut), (cut, len(tg))):
                hg, hh = tg[a:b].sum(axis=0), th[a:b].sum(axis=0)
                gain, at = _best_cut(hg, hh)
                total += gain + float(_gain(hg.sum(), hh.sum()))
                for c, d in ((0, at), (at, tg.shape[1])):
                    if c < d:
                        add[a:b, c:d] = hg[c:d].sum() / (hh[c:d].sum() + RIDGE)
            if total > best:
                best, found = total, add.T if turned else add
    return best, found


def train(x: np.ndarray, y: np.ndarray) -> Additive:
    """Cyclic boosting on the logistic loss: every feature in turn, then the pairs that explain most of what is left."""
    rate = float(np.clip(y.mean(), 1e-3, 1 - 1e-3))
    model = Additive(float(np.log(rate / (1 - rate))))
    if y.min() == y.max():
        return model
    n, features = x.shape
    model.edges = [_cuts(x[:, j], BINS) for j in range(features)]
    model.coarse = [_cuts(x[:, j], PAIR_BINS) for j in range(features)]
    bins = [np.searchsorted(model.edges[j], x[:, j], side="right") for j in range(features)]
    model.tables = [np.zeros(len(e) + 1) for e in model.edges]
    z = np.full(n, model.intercept)

    def sums(cell: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
        p = _logistic(z)
        return np.bincount(cell, y - p, size), np.bincount(cell, p * (1 - p), size)

    for _ in range(ROUNDS):
        for j in range(features):
            add = RATE * _line_tree(*sums(bins[j], len(model.tables[j])))
            model.tables[j] += add
            z += add[bins[j]]
    sides = [np.searchsorted(c, x[:, j], side="right") for j, c in enumerate(model.coarse)]
    widths = [len(c) + 1 for c in model.coarse]

    def grid_of(a: int, b: int) -> tuple[np.ndarray, tuple[np.ndarray, np.ndarray]]:
        cell, shape = sides[a] * widths[b] + sides[b], (widths[a], widths[b])
        g, h = sums(cell, widths[a] * widths[b])
        return cell, (g.reshape(shape), h.reshape(shape))

    ranked = sorted(((-_grid_tree(*grid_of(a, b)[1])[0], (a, b)) for a, b in itertools.combinations(range(features), 2)))
    model.pairs = [pair for _, pair in ranked[:PAIRS]]
    model.grids = [np.zeros((widths[a], widths[b])) for a, b in model.pairs]
    for _ in range(PAIR_ROUNDS):
        for k, (a, b) in enumerate(model.pairs):
            cell, (g, h) = grid_of(a, b)
            add = RATE * _grid_tree(g, h)[1]
            model.grids[k] += add
            z += add.ravel()[cell]
    return model


def featured(docs: DataFrame) -> DataFrame:
    """doc_id and the features of every row's whole text, stored: the text is read once, for training and scoring."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = features_of(batch.column("text").to_pylist())
            cells = pa.FixedSizeListArray.from_arrays(pa.array(found.ravel()), len(FEATURES)).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), cells], names=["doc_id", "features"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return store(docs.select("doc_id", text_of().alias("text")).mapInArrow(run, f"doc_id {kind}, features array<double>"), "quality-features")


def fit(rows: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> Additive:
    """Train on at most ``sample_rows`` rows of ``featured`` outside the held-out fold that ``labels`` marks 0 or 1.

    They are the first in hash order, equal rows once; of labels that repeat a doc_id the mean counts, a half as 1. With
    no labels every score is 0.5, with one kind only it is close to that kind. Only rows below a hash that lets a few more
    than wanted through are put in order, so that what tasks send does not grow with their number.
    """
    marks = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isin(0, 1)).groupBy("doc_id").agg((F.avg("quality") >= 0.5).alias("good"))
    usable = rows.where(~held_out() & F.col("doc_id").isNotNull()).join(marks, "doc_id").select("doc_id", "features", "good").distinct()
    usable = store(usable.withColumn("order", F.xxhash64("doc_id", "features")), "quality-labelled")
    share = min(1.0, (sample_rows + 6 * sample_rows**0.5 + 10) / max(1, usable.count()))
    limit = min((1 << 63) - 1, int((2 * share - 1) * (1 << 63)))
    few = usable.where(F.col("order") <= F.lit(limit))
    taken = few.orderBy("order", "doc_id").limit(sample_rows).select("features", "good").collect()
    if not taken:
        return Additive(0.0)
    return train(np.array([r["features"] for r in taken]), np.array([float(r["good"]) for r in taken]))


def score(rows: DataFrame, model: Additive) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``featured``."""
    sent = rows.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = batch.column("features").flatten().to_numpy(zero_copy_only=False).reshape(-1, len(FEATURES))
            found = pa.array(sent.value.scores(x), pa.float64())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), found], names=["doc_id", "held_out", "score"])

    kind = rows.schema["doc_id"].dataType.simpleString()
    scored = rows.withColumn("held_out", held_out()).mapInArrow(run, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def classified(docs: DataFrame, labels: DataFrame, *, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score at least ``THRESHOLD``) of every row.

    A null text is the empty one, whose features are zeros; very long texts are read whole. Repeated rows are each
    scored, alike; rows without doc_id are scored and never learned from. Other columns of ``docs`` are not looked at.
    An empty table gives no rows.
    """
    rows = featured(docs)
    return score(rows, fit(rows, labels, sample_rows=sample_rows))
