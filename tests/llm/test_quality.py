"""The additive quality model: its features one by one, its trees by trying all cuts, its held-out accuracy."""

from __future__ import annotations

import collections
import itertools
import math
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.llm import quality
from mercato.session import configure


@pytest.fixture(autouse=True)
def _configured(spark):
    configure(spark)


def plain_features(text: str) -> list[float]:
    if not text:
        return [0.0] * len(quality.FEATURES)
    data, chars = text.encode(), len(text)
    share = lambda members: sum(c in members for c in text) / chars
    words = [w.lower() if w.isascii() else "".join(c.lower() if c.isascii() else c for c in w) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    counts = collections.Counter(data)
    entropy = -sum(n / len(data) * math.log2(n / len(data)) for n in counts.values())
    spaces = sum(c in " \t\n\x0b\x0c\r" for c in text)
    n, pairs = len(words), list(itertools.pairwise(words))
    lines = [x for x in text.split("\n") if x]
    return [
        math.log1p(chars), share("ABCDEFGHIJKLMNOPQRSTUVWXYZ"), share("abcdefghijklmnopqrstuvwxyz"), share("0123456789"), spaces / chars,
        share("\n"), share("!"), share("#$%&*"), share("|"), share(".,;:?"), share("\"'()+-/<=>@[\\]^_`{}~"), entropy,
        math.log1p(n), (chars - spaces) / n if n else 0, len(set(words)) / n if n else 0, sum(a == b for a, b in pairs) / len(pairs) if pairs else 0,
        max(collections.Counter(words).values()) / n if n else 0, len(set(pairs)) / len(pairs) if pairs else 0,
        1 - len(set(lines)) / len(lines) if lines else 0,
    ]


def test_features_are_those_of_the_whole_text():
    rng = random.Random(2)
    texts = ["", " \n", "One", "a a a B!", "é É\tx|y\n\nx|y\nx|y", "z" * 70_000, "#$ 12 <x> " * 30]
    texts += [" ".join(rng.choice(("the", "THE", "of", "x1", "é.", "stop,", "\n")) for _ in range(rng.randint(1, 400))) for _ in range(30)]
    assert np.allclose(quality.features_of(texts), [plain_features(t) for t in texts], atol=1e-12)


def test_line_trees_take_the_best_cuts():
    rng = np.random.default_rng(3)
    for _ in range(30):
        g, h = rng.normal(size=6), rng.random(6)
        gain = lambda a, b: g[a:b].sum() ** 2 / (h[a:b].sum() + quality.RIDGE)
        got, at = quality._best_cut(g, h)
        want = max(gain(0, c) + gain(c, 6) - gain(0, 6) for c in range(1, 6))
        assert got == pytest.approx(max(want, 0), abs=1e-9) and (at == 0) == (want <= 1e-9)
        leaves = quality._line_tree(g, h)
        edges = [0, *(np.flatnonzero(np.diff(leaves)) + 1).tolist(), 6]
        assert len(edges) <= 5
        assert all(leaves[a] == pytest.approx(g[a:b].sum() / (h[a:b].sum() + quality.RIDGE)) for a, b in itertools.pairwise(edges))


def test_grid_trees_take_the_best_cuts():
    rng = np.random.default_rng(4)
    for _ in range(20):
        g, h = rng.normal(size=(4, 3)), rng.random((4, 3))
        one = lambda box: g[box].sum() ** 2 / (h[box].sum() + quality.RIDGE)
        best = 0.0
        for cut in range(1, 4):
            halves = [max([one(np.s_[a:b])] + [one(np.s_[a:b, :c]) + one(np.s_[a:b, c:]) for c in range(1, 3)]) for a, b in ((0, cut), (cut, 4))]
            best = max(best, sum(halves))
        for cut in range(1, 3):
            halves = [max([one(np.s_[:, a:b])] + [one(np.s_[:c, a:b]) + one(np.s_[c:, a:b]) for c in range(1, 4)]) for a, b in ((0, cut), (cut, 3))]
            best = max(best, sum(halves))
        assert quality._grid_tree(g, h)[0] == pytest.approx(best)


def test_interactions_are_learned():
    """Neither feature says anything alone; their pair says all."""
    x = np.random.default_rng(5).random((4000, 2))
    y = ((x[:, 0] > 0.5) ^ (x[:, 1] > 0.5)).astype(float)
    model = quality.train(x, y)
    assert model.pairs == [(0, 1)] and ((model.scores(x) >= 0.5) == y).mean() > 0.97
    alone = quality.Additive(model.intercept, model.edges, model.tables)
    assert ((alone.scores(x) >= 0.5) == y).mean() < 0.65


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{sf}/{t}.parquet") for t in ("documents", "labels"))
    out = quality.classified(docs, labels).join(labels, "doc_id").where("held_out").collect()
    right = sum(r["predicted"] == r["quality"] for r in out)
    always = sum(r["quality"] for r in out)  # what naming the commoner label reaches
    assert len(out) > 50 and right > always and right / len(out) > 0.93
    good, bad = ([r["score"] for r in out if r["quality"] == q] for q in (1, 0))
    assert sum((a > b) + (a == b) / 2 for a in good for b in bad) / (len(good) * len(bad)) > 0.97


ROWS = [(1, "Clean words of a text."), (2, None), (3, ""), (None, "no id"), (4, "X!! " * 9000), (5, "same"), (5, "same"), (6, "123 \t")]


def test_quality_of_odd_tables(spark):
    docs = spark.createDataFrame([(i, t, 0.5, True, [1.0], 3) for i, t in ROWS], "doc_id long, text string, score double, held_out boolean, features array<double>, predicted int")
    labels = spark.createDataFrame([(1, 1, 0), (4, 0, 0), (4, 0, 1), (5, None, 0), (None, 1, 0), (6, 7, 0)], "doc_id long, quality int, toxic int")
    out = quality.classified(docs, labels).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0) for r in out) == sorted((i is None, i or 0) for i, _ in ROWS)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) and r["held_out"] is not None for r in out)
    assert len({r["score"] for r in out if r["doc_id"] in (2, 3)}) == 1 and len({r["score"] for r in out if r["doc_id"] == 5}) == 1
    unlabelled = quality.classified(docs, labels.where("false")).collect()
    assert {r["score"] for r in unlabelled} == {0.5}
    assert quality.classified(docs.where("false"), labels).collect() == []


def test_the_sample_is_bounded_by_rows(spark):
    """However many rows one id has, and in whatever partitions they lie, training reads the same few of them."""
    docs = spark.range(3000).select((F.col("id") % 3 + 1).alias("doc_id"), F.concat(F.lit("word "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, 1)], "doc_id long, quality int")
    seen = []
    for parts in (2, 7):
        rows = quality.featured(docs.repartition(parts))
        original = quality.train
        try:
            quality.train = lambda x, y: seen.append((len(x), x.sum(), y.sum())) or original(x, y)
            quality.fit(rows, labels, sample_rows=40)
        finally:
            quality.train = original
    assert seen[0] == seen[1] and seen[0][0] <= 40
