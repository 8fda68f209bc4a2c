"""Subtotals from the finest grain against a plain count per level."""

from __future__ import annotations

import itertools

import pytest
from pyspark.sql import functions as F

from mercato.operators import metrics

ROWS = [
    (a, b, c, who, price)
    for i, (a, b, c) in enumerate(itertools.product(["x", "y", None], ["p", "q"], [1, None]))
    for who, price in [(-5, 1.5), (63, 2.0), (64, None), (64, 0.25), (None, 4.0), (10**15 + i % 2, 1.0)]
]
SCHEMA = "a string, b string, c int, who bigint, price double"


def _expected(keys, sets):
    found = {}
    for chosen in sets:
        level = sum(1 << (len(keys) - 1 - i) for i, k in enumerate(keys) if k not in chosen)
        for row in ROWS:
            named = dict(zip(("a", "b", "c"), row[:3], strict=True))
            cell = found.setdefault((*(named[k] if k in chosen else None for k in keys), level), [0.0, set()])
            cell[0] += row[4] or 0
            cell[1] |= {row[3]} - {None}
    return {k: (v, len(who)) for k, (v, who) in found.items()}


@pytest.mark.parametrize("cube", [False, True])
@pytest.mark.parametrize("text", [False, True])
def test_levels_by_hand(spark, cube, text):
    keys = ["a", "b", "c"]
    sets = [s for n in range(4) for s in itertools.combinations(keys, n)] if cube else [keys[:n] for n in range(4)]
    df = spark.createDataFrame(ROWS, SCHEMA)
    df = df.withColumn("who", F.col("who").cast("string")) if text else df
    rows = metrics.revenue_totals(df, keys, cube=cube, distinct="who").collect()
    expected = _expected(keys, sets)
    assert len(rows) == len(expected)
    assert {(r["a"], r["b"], r["c"], r["level"]): (r["revenue"], r["distinct_who"]) for r in rows} == expected


def test_plain_totals_and_an_empty_table(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    ours = metrics.revenue_totals(df, ["a", "c"], cube=True)
    theirs = df.cube("a", "c").agg(F.sum("price").alias("revenue"), F.grouping_id().alias("level"))
    assert ours.columns == theirs.columns
    assert sorted(ours.collect(), key=str) == sorted(theirs.collect(), key=str)
    assert metrics.revenue_totals(df.limit(0), ["a"], distinct="who").collect() == []
