"""Pruned lists of the best items against scoring everything."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from mercato.operators import ml
from mercato.operators.topn import top_by_product


def _frame(spark, vectors):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(vectors)], "id int, features array<float>")


def _all_pairs(users, items, n):
    scores = users.astype(np.float32).astype(np.float64) @ items.astype(np.float32).astype(np.float64).T
    return [[(int(i), row[i]) for i in sorted(range(len(row)), key=lambda i: (-row[i], i))[:n]] for row in scores]


@pytest.mark.parametrize("chunk_bytes", [1, 8 * 6 * 300, 1 << 24])
def test_lists_equal_those_of_all_pairs(spark, chunk_bytes):
    """Items of very different and of equal lengths, ties, repeated vectors, users of length 0 and with negative scores."""
    rng = np.random.default_rng(5)
    small = chunk_bytes == 1
    items = rng.normal(size=(12 if small else 1500, 4)) * rng.pareto(1.0, size=(12 if small else 1500, 1))
    items[5], items[7] = items[3], 0
    users = np.vstack([rng.normal(size=(20, 4)), np.zeros((1, 4)), -np.abs(items[:3])])
    rows = top_by_product(_frame(spark, users), _frame(spark, items), 10, chunk_bytes).collect()
    assert sorted(r["user"] for r in rows) == list(range(len(users)))
    for r in rows:
        expected = _all_pairs(users, items, 10)[r["user"]]
        assert list(r["items"]) == [i for i, _ in expected]
        assert list(r["scores"]) == pytest.approx([s for _, s in expected])
    if not small:
        assert sum(r["scored"] for r in rows) < 0.7 * len(users) * len(items)


def test_fewer_items_than_places_no_items_and_no_users(spark):
    few = top_by_product(_frame(spark, [[1.0, 0.0]]), _frame(spark, [[1.0, 2.0], [3.0, 0.0]]), 10).first()
    assert list(few["items"]) == [1, 0] and few["scored"] == 2
    none = spark.createDataFrame([], "id int, features array<float>")
    assert [list(r["items"]) for r in top_by_product(_frame(spark, [[1.0]]), none, 3).collect()] == [[]]
    assert top_by_product(none, _frame(spark, [[1.0]]), 3).collect() == []
    with pytest.raises(ValueError):
        top_by_product(none, none, 0)


def test_recommendations_are_those_of_the_model(spark):
    lines = spark.range(4000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(90))).alias("u"), F.pmod(F.hash("id"), F.lit(70)).alias("i")
    )
    model = ml.Recommender.fit(ml.interactions(lines, "u", "i"))
    found = {r["user"]: list(zip(r["items"], r["scores"], strict=True)) for r in model.best(10).collect()}
    theirs = {r["user_ix"]: [tuple(x) for x in r["recommendations"]] for r in model.model.recommendForAllUsers(10).collect()}
    assert found.keys() == theirs.keys()
    for user, best in theirs.items():
        assert [s for _, s in found[user]] == pytest.approx([s for _, s in best], abs=1e-5)
    top = model.top(10)
    assert top.columns == ["user", "rank", "item", "score"] and top.count() == 10 * len(theirs)


def test_a_list_is_sorted_only_where_a_strip_can_change_it(monkeypatch):
    """Items of equal length keep every user to the end; few of their strips hold a better item."""
    from mercato.operators import topn

    rng = np.random.default_rng(3)
    items, users, rows = rng.normal(size=(40 * topn.STRIP, 4)), rng.normal(size=(50, 4)), []
    items /= np.linalg.norm(items, axis=1, keepdims=True)
    best = topn._best
    monkeypatch.setattr(topn, "_best", lambda scores, ids, n: rows.append(len(scores)) or best(scores, ids, n))
    top, ids, scored, finished = topn._walk(
        users, np.full((50, 10), -np.inf), np.full((50, 10), np.iinfo(np.int64).max), items, np.arange(len(items)), -1.0
    )
    assert [[i for i, _ in e] for e in _all_pairs(users, items, 10)] == [list(map(int, r)) for r in ids]
    assert finished.all() and sum(rows) < 0.8 * sum(-(-scored // topn.STRIP))
