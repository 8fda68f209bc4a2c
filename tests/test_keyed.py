"""The keyed table: replays, torn batches, incremental compaction, reads of one key."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from mercato.session import configure, scratch_path
from mercato.streaming.keyed import KeyedTable

KIND = "k string, d int, v long"


@pytest.fixture(autouse=True)
def _configured(spark):
    configure(spark)


def batch(spark, rows):
    return spark.createDataFrame(rows, KIND)


def content(table):
    return {(r["k"], r["d"]): r["v"] for r in table.read().collect()}


def new(spark, **options):
    return KeyedTable(spark, scratch_path(spark, "keyed"), ["k", "d"], buckets=4, **options)


def test_random_batches_replays_and_compactions_agree_with_a_dict(spark):
    rng, table, want, stored = random.Random(4), new(spark), {}, {}
    for i in range(7):
        keys = rng.sample([(k, d) for k in ("a", "b", None, "é") for d in (1, 2, None)], rng.randint(1, 9))
        stored[i] = [(*k, rng.randrange(100)) for k in keys]
        table.upsert(batch(spark, stored[i]), i)
        want.update({(k, d): v for k, d, v in stored[i]})
        if i == 4:
            assert 0 < len(table.compact(most=2)) <= 2
            table.upsert(batch(spark, stored[4]), 4)  # folded in some buckets, not in others
        if i % 2:
            table.upsert(batch(spark, stored[i]), i)
        assert content(table) == want
    assert table.compact() and content(table) == want
    assert table.compact() == []
    table.upsert(batch(spark, [("a", 1, -1)]), 3)  # a replay of what is folded
    assert content(table) == want
    m = table.manifest()
    assert not m.deltas and len({f for f, _ in m.bases.values()}) == 1


def test_a_torn_batch_is_not_there(spark, monkeypatch):
    table = new(spark)
    table.upsert(batch(spark, [("a", 1, 1)]), 0)
    monkeypatch.setattr(table, "_commit", lambda m: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.upsert(batch(spark, [("a", 1, 2), ("b", 1, 2)]), 1)
    with pytest.raises(OSError):
        table.compact()
    assert content(table) == {("a", 1): 1}
    monkeypatch.undo()
    again = KeyedTable(spark, table.root, ["k", "d"])
    assert len(again.files.names("data")) == 3  # what the failed steps left
    again.upsert(batch(spark, [("a", 1, 3), ("b", 1, 2)]), 1)
    assert content(again) == {("a", 1): 3, ("b", 1): 2} and len(again.files.names("data")) == 2


def test_compaction_rewrites_only_its_buckets_and_deletes_what_nobody_reads(spark):
    table = new(spark)
    for i in range(5):
        table.upsert(batch(spark, [(f"k{j}", i, i) for j in range(40)] + [("x", 0, i)]), i)
    before = table.manifest()
    one = table.compact(most=1)
    after = table.manifest()
    assert len(one) == 1 and set(after.bases) == set(one) and after.deltas == before.deltas
    held = table.read()  # a reader of the manifest before
    assert len(table.compact()) == 3
    assert held.count() == 201  # still finds its files
    table.compact()
    table.upsert(batch(spark, [("y", 0, 1)]), 5)
    table.upsert(batch(spark, [("y", 0, 2)]), 6)
    folders = table.files.names("data")
    assert sorted(f.split("-")[0] for f in folders) == ["base", "base", "delta", "delta"]
    assert content(table)[("x", 0)] == 4 and content(table)[("y", 0)] == 2 and len(content(table)) == 202


def test_one_key_is_read_from_one_bucket(spark):
    table = new(spark)
    for i in range(2):
        table.upsert(batch(spark, [(f"k{j}", j, i * j) for j in range(200)] + [(None, None, 9 + i)]), i)
    table.compact(most=2)
    for k, d, v in (("k7", 7, 7), (None, None, 10)):
        found = table.read(k=k, d=d)
        assert [tuple(r) for r in found.collect()] == [(k, d, v)]
        assert len({p.rsplit("_bucket=", 1)[1].split("/")[0] for p in found.inputFiles()}) == 1
    assert table.read(k="none", d=1).collect() == []
    with pytest.raises(ValueError):
        table.read(k="k7")


def test_rows_no_delta_touches_are_not_moved(spark):
    table = new(spark)
    table.upsert(batch(spark, [(f"k{j}", 0, j) for j in range(1000)]), 0)
    table.compact()
    assert "Exchange" not in table.read()._jdf.queryExecution().executedPlan().toString()
    table.upsert(batch(spark, [("k5", 0, -5), ("new", 0, 1)]), 1)
    plan = table.read()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("LeftAnti") == 1 and "rightHint=(strategy=broadcast)" in plan
    assert table.read().agg(F.sum("v")).first()[0] == 999 * 500 - 5 - 5 + 1


def test_a_merge_of_its_own_adds_up(spark):
    sums = lambda rows: rows.groupBy("k", "d").agg(F.sum("v").alias("v"), F.max("_batch").alias("_batch"))
    table = new(spark, merge=sums)
    for i in range(4):
        table.upsert(batch(spark, [("a", 1, 1), ("b", 1, i)]), i)
        if i == 2:
            table.compact(most=1)
    table.upsert(batch(spark, [("a", 1, 1), ("b", 1, 3)]), 3)
    assert content(table) == {("a", 1): 4, ("b", 1): 6}


def test_a_bucket_with_one_delta_is_read_as_it_is(spark):
    table, rows = new(spark), [(f"k{i}", i % 3, i) for i in range(40)]
    table.upsert(batch(spark, rows), 0)
    table.upsert(batch(spark, []), 1)
    plan = table.read()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Aggregate" not in plan
    assert content(table) == {(k, d): v for k, d, v in rows}
    # a later batch touches one bucket: that one is merged, the others are not
    table.upsert(batch(spark, [("k7", 1, 700)]), 2)
    assert content(table) == {**{(k, d): v for k, d, v in rows}, ("k7", 1): 700}
    assert table.read().count() == 40 and table.read(k="k7", d=1).count() == 1
    # with a merge of its own, what one batch holds of a key is still brought to one
    own = new(spark, merge=lambda rows: rows.groupBy("k", "d").agg(F.sum("v").alias("v"), F.max("_batch").alias("_batch")))
    own.upsert(batch(spark, [("a", 1, 1), ("a", 1, 2)]), 0)
    assert content(own) == {("a", 1): 3}


def test_new_columns_are_null_in_older_rows(spark):
    table = new(spark)
    table.upsert(batch(spark, [("a", 1, 1)]), 0)
    table.upsert(spark.createDataFrame([("b", 1, 2, "new")], f"{KIND}, more string"), 1)
    assert sorted((r["k"], r["more"]) for r in table.read().collect()) == [("a", None), ("b", "new")]
    with pytest.raises(ValueError, match="keyed by"):
        KeyedTable(spark, table.root, ["k"]).upsert(batch(spark, [("a", 1, 1)]), 2)
    with pytest.raises(FileNotFoundError):
        new(spark).read()
