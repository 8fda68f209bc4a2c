"""Skew-safe building blocks against the plain form, and the shape of plans."""

from __future__ import annotations

import collections
import itertools
import random
import time
from collections import Counter
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from mercato.operators import graph, joins, quality, skew, windows
from mercato.plans import scans
from mercato.plans import tables as t
from mercato.session import pin
from mercato.streaming.windows import batch_sessions, sessions


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows have key 1, among them many identical copies; some have none."""
    key = F.when(F.col("id") % 3 == 0, 1).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 97)
    return spark.range(30_000).select(key.cast("int").alias("k"), (F.col("id") % 5).alias("v")).cache()


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_skew_join_equals_join(spark, skewed, how):
    right = spark.range(0, 60).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("w"))
    plain = skewed.join(right, ["k"], how)
    salted = skew.skew_join(skewed, right, ["k"], how, rows_per_task=500, max_bytes=0)
    assert sorted(map(str, plain.collect())) == sorted(map(str, salted.collect()))


def test_hot_copies_spread_over_tasks(spark):
    copies = spark.range(0, 20_000, 1, 8).select(F.lit(7).alias("k"), F.lit("same").alias("v"))
    right = spark.createDataFrame([(7, "x")], "k int, w string")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = skew.skew_join(copies, right, ["k"], rows_per_task=2_000, max_bytes=0)
        per_task = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert sum(r["count"] for r in per_task) == 20_000 and len(per_task) > 3


def test_every_hot_key_is_split(spark):
    """No bound on the number of hot keys: 20,000 of them are all on the list."""
    df = spark.range(60_000).select((F.col("id") % 20_000).alias("k"))
    assert skew.hot_keys(df, ["k"], rows_per_task=2).count() == 20_000


def test_star_with_large_dimensions_scans_each_side_once(spark, sf, monkeypatch):
    monkeypatch.setattr(skew, "fits", lambda *_: False)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = joins.star(t.orders(spark, sf), t.items(spark, sf), t.products(spark, sf), t.sellers(spark, sf), t.customers(spark, sf))
        text = df._jdf.queryExecution().sparkPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("l_orderkey") and len([x for x in text.splitlines() if "FileScan parquet" in x and "l_orderkey" in x]) == 1


def test_paths_and_components_of_a_long_chain(spark):
    edges = spark.range(56).select(F.col("id").cast("string").alias("src"), (F.col("id") + 1).cast("string").alias("dst"))
    ends = spark.createDataFrame([("56",)], "id string")
    found = {r["id"]: r["distance"] for r in graph.shortest_paths(edges, ends).collect()}
    assert found == {str(i): 56 - i for i in range(57)}


def _hops(edges, ends):
    """Breadth-first search backwards from every landmark: (vertex, landmark) → distance."""
    into, found = {}, {}
    for a, b in edges:
        if a is not None and b is not None:
            into.setdefault(b, set()).add(a)
    for end in set(ends) - {None}:
        layer, far = {end}, 0
        while layer:
            found.update({(v, end): far for v in layer})
            layer = {a for v in layer for a in into.get(v, ()) if (a, end) not in found}
            far += 1
    return found


@pytest.mark.parametrize(("words", "rows_per_task"), [(1, 20), (16, 10**6)])
def test_paths_to_many_landmarks(spark, words, rows_per_task):
    """A hub, repeated edges, ends that are null, landmarks without edges, and more landmarks than a column has bits."""
    edges = [(i * 7 % 60, i * i % 60 if i % 3 else 0) for i in range(300)] + [(None, 3), (4, None)]
    ends = [*range(75), None, 3]
    rows = graph.shortest_paths(
        spark.createDataFrame(edges, "src int, dst int"), spark.createDataFrame([(e,) for e in ends], "id int"), words, rows_per_task
    ).collect()
    assert len(rows) == len({(r["id"], r["landmark"]) for r in rows})
    assert {(r["id"], r["landmark"]): r["distance"] for r in rows} == _hops(edges, ends)


def test_edges_get_their_numbers_without_a_join(spark):
    edges = spark.range(1000).select(F.concat(F.lit("a"), F.col("id") % 50).alias("src"), F.concat(F.lit("b"), F.col("id") % 70).alias("dst"))
    numbered, pairs, _ = graph._in_numbers(edges, edges.select(F.col("src").alias("id")))
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan
    assert numbered.count() == numbered.select("v").distinct().count() == 120 and pairs.count() == 1000


@pytest.mark.parametrize("shared", [False, True])
def test_undirected_paths_whether_or_not_hashes_are_shared(spark, monkeypatch, shared):
    """Both ways along repeated edges, a loop and a hub; where two ids have the same hash, they stay apart."""
    if shared:
        monkeypatch.setattr(graph, "_hash", lambda id: F.pmod(F.xxhash64(id), F.lit(5)))
    edges = [(f"v{i * 7 % 40}", f"v{i * i % 40 if i % 3 else 0}") for i in range(60)] + [("v1", "v1"), ("x", "y"), (None, "x"), ("y", None)]
    ends = ["v0", "x", "alone", None]
    frame = spark.createDataFrame(edges, "src string, dst string")
    rows = graph.shortest_paths(frame, spark.createDataFrame([(e,) for e in ends], "id string"), rows_per_task=20, undirected=True).collect()
    assert {(r["id"], r["landmark"]): r["distance"] for r in rows} == _hops(edges + [(b, a) for a, b in edges], ends)
    assert len(rows) == len({(r["id"], r["landmark"]) for r in rows})


def test_paths_without_edges_or_landmarks(spark):
    edges, none = spark.createDataFrame([(1, 2)], "src int, dst int"), spark.createDataFrame([], "id int")
    assert graph.shortest_paths(edges, none).collect() == []
    alone = graph.shortest_paths(edges.limit(0), spark.createDataFrame([(1,)], "id int")).collect()
    assert [tuple(r) for r in alone] == [(1, 1, 0)]


def test_a_step_of_the_paths_shuffles_what_is_sent_and_nothing_else(spark):
    links = graph._bucketed(spark.range(100).select(F.col("id").alias("s"), (F.col("id") + 1).alias("d")), "d", 8)
    state = graph._bucketed(spark.range(101).select(F.col("id").alias("v"), F.col("id").alias("seen0"), F.col("id").alias("fresh0")), "v", 8)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = graph._next_reach(links, None, state, 1)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
        graph._drop(links), graph._drop(state)
    assert plan.count("Exchange") == 1


def test_pagerank_leaves_only_its_ranks(spark, tmp_path):
    import os

    from mercato.session import shared_dir

    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a"), ("d", "a")], "src string, dst string")
    nodes = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "id string")
    folder = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder))
    assert graph.pagerank(nodes, edges).count() == 4
    assert len({x for x in set(os.listdir(folder)) - before if x.startswith("pinned")}) == 1


def test_a_rank_round_shuffles_contributions_only(spark):
    """With nothing small enough to broadcast, edges and ranks stay in their buckets."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    tables = []
    try:
        n = int(spark.conf.get("spark.sql.shuffle.partitions"))
        links = spark.range(5000).select((F.col("id") % 97).alias("s"), (F.col("id") * 7 % 101).alias("d"), F.lit(50).cast("long").alias("out"))
        nodes = spark.range(101).select(F.col("id").alias("v"))
        tables = [graph._bucketed(links.repartition(n, "s"), "s", n), graph._bucketed(nodes.repartition(n, "v"), "v", n)]
        tables.append(graph._bucketed(tables[1].withColumn("rank", F.lit(1.0)), "v", n))
        after = graph._next_ranks(tables[1], tables[0], None, tables[2], 0.15)
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 1 and plan.count("SortMergeJoin") == 2
        assert after.agg(F.sum("rank")).first()[0] == pytest.approx(0.15 * 101 + 0.85 * 5000 / 50)
    finally:
        for table in tables:
            graph._drop(table)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_pagerank_of_hubs_and_unknown_ends(spark):
    """A source with more edges than a task should take, edges to and from vertices that are not in the list."""
    rng = random.Random(6)
    pairs = {("hub", f"n{i}") for i in range(40)} | {(f"n{rng.randrange(40)}", f"n{rng.randrange(40)}") for _ in range(60)}
    pairs |= {("n1", "unknown"), ("unknown", "n2"), ("n3", "hub")}
    names = ["hub", *[f"n{i}" for i in range(40)], "alone"]
    ranks = dict.fromkeys(names, 1.0)
    out = collections.Counter(s for s, _ in pairs)
    for _ in range(4):
        received = collections.Counter()
        for s, d in pairs:
            received[d] += ranks.get(s, 0.0) / out[s]
        ranks = {v: 0.15 + 0.85 * received[v] for v in names}
    scale = len(names) / sum(ranks.values())
    edges = spark.createDataFrame(sorted(pairs) * 2, "src string, dst string")
    nodes = spark.createDataFrame([(v,) for v in names], "id string")
    for most in (1_000_000, 5):
        found = graph.pagerank(nodes, edges, iterations=4, rows_per_task=most).collect()
        assert {r["id"]: r["pagerank"] for r in found} == pytest.approx({v: x * scale for v, x in ranks.items()})


def test_a_rank_round_over_the_grid_shuffles_vectors_only(spark):
    """Both ways, with an unknown end and one without a name; edges stay in their buckets, and no join is in the plan."""
    pairs = [("a", "b"), ("a", "c"), ("b", "c"), ("c", "x"), ("y", "a"), ("d", None), ("d", "d")]
    edges = spark.createDataFrame(pairs * 2, "src string, dst string")
    nodes = spark.createDataFrame([(v,) for v in "abcde"], "id string")
    both = {(s, d) for p in pairs for s, d in (p, p[::-1])}
    ranks, out = dict.fromkeys("abcde", 1.0), collections.Counter(s for s, _ in both)
    for _ in range(3):
        ranks = {v: 0.15 + 0.85 * sum(ranks.get(s, 0.0) / out[s] for s, d in both if d == v) for v in "abcde"}
    found = graph.pagerank(nodes, edges, iterations=3, undirected=True, rows_per_task=0).collect()
    scale = 5 / sum(ranks.values())
    assert {r["id"]: r["pagerank"] for r in found} == pytest.approx({v: x * scale for v, x in ranks.items()})

    numbers = spark.createDataFrame([(0, 1), (1, 2), (2, 0)], "s long, d long")
    packed = numbers.mapInArrow(graph._cells(2, False), "cell int, s binary, d binary")
    cells = graph._bucketed(packed, "cell", 8)
    vectors = spark.createDataFrame([(0, -1, bytes(16)), (1, -1, bytes(8))], graph._VECTOR)
    try:
        plan = graph._next_stripes(cells, vectors, vectors, 2, 3, 0.15, True)._jdf.queryExecution().executedPlan().toString()
    finally:
        graph._drop(cells)
    # the vectors sent, and those that come back
    assert plan.count("Exchange") == 2 and "Join" not in plan and "Bucketed: true" in plan


def test_triangles_of_a_hub_and_a_clique(spark):
    """A hub beside a clique and a random graph, in few and in many colours, and no list of neighbours in the plan."""
    rng = random.Random(9)
    pairs = {(f"c{i}", f"c{j}") for i in range(12) for j in range(i)} | {("hub", f"n{i}") for i in range(80)}
    pairs |= {(f"n{rng.randrange(80)}", f"n{rng.randrange(80)}") for _ in range(200)} | {("x", "y"), ("x", "x")}
    around = collections.defaultdict(set)
    for a, b in pairs:
        if a != b:
            around[a].add(b), around[b].add(a)
    want = {v: sum(len(around[v] & around[w]) for w in near) // 2 for v, near in around.items()}
    edges = spark.createDataFrame(sorted(pairs) + sorted((b, a) for a, b in pairs)[::2], "src string, dst string")
    for most in (2_000_000, 20):
        found = graph.triangle_counts(edges, edges_per_task=most)
        assert {r["id"]: r["triangles"] for r in found.collect()} == want
        assert "collect_list" not in plan(found)
    assert graph.triangle_counts(edges.filter("false")).collect() == []


def test_wedges_in_slices_are_the_same(monkeypatch):
    rng = np.random.default_rng(2)
    pairs = np.unique(np.sort(rng.integers(0, 30, (200, 2)), axis=1), axis=0)
    a, b = pairs[pairs[:, 0] < pairs[:, 1]].T
    colour = rng.integers(0, 2, 30)
    whole = [graph._closed(a, b, colour, mixed) for mixed in (False, True)]
    monkeypatch.setattr(graph, "WEDGES", 3)
    assert all((graph._closed(a, b, colour, mixed) == one).all() for mixed, one in zip((False, True), whole, strict=True))
    assert whole[0].sum() > whole[1].sum() > 0


def test_skew_join_refuses_outer(spark, skewed):
    with pytest.raises(ValueError, match="full"):
        skew.skew_join(skewed, skewed, ["k"], "full")


@pytest.fixture
def many_chunks(spark):
    """Small data would be merged into one chunk, and then nothing is carried."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


@pytest.mark.parametrize("inclusive", [True, False])
def test_running_equals_window(spark, skewed, many_chunks, inclusive):
    df = skewed.withColumn("id", F.monotonically_increasing_id())
    w = Window.partitionBy("k").orderBy("id").rowsBetween(Window.unboundedPreceding, 0 if inclusive else -1)
    expected = df.select("k", "id", F.sum("v").over(w).alias("s"), F.max("v").over(w).alias("m"), F.min("v").over(w).alias("n"))
    found = skew.running(
        df, ["k"], [F.col("id")], {"s": ("sum", F.col("v")), "m": ("max", F.col("v")), "n": ("min", F.col("v"))}, inclusive
    ).select("k", "id", "s", "m", "n")
    assert expected.exceptAll(found).isEmpty() and found.exceptAll(expected).isEmpty()


def test_chunks_split_a_hot_key(spark, skewed, many_chunks):
    chunks = skew.chunked(skewed, ["k"], [F.col("v")])
    sizes = [r["count"] for r in chunks.groupBy("_chunk").count().collect()]
    assert sum(sizes) == 30_000 and max(sizes) < 10_000


def test_exact_quantiles_equal_numpy(spark, many_chunks):
    rng = np.random.default_rng(7)
    values = np.concatenate([rng.normal(size=20_000), np.full(9_000, 0.25)])
    df = spark.createDataFrame([(float(x), int(i) if i % 2 else None) for i, x in enumerate(values)], "a double, b int")
    found = {
        (r["column_name"], r["probability"]): r["quantile"]
        for r in skew.exact_quantiles(df, ["a", "b"], [0.0, 0.1, 0.25, 0.5, 0.75, 1.0]).collect()
    }
    odd = np.arange(1, len(values), 2)
    for p in (0.0, 0.1, 0.25, 0.5, 0.75, 1.0):
        assert found[("a", p)] == pytest.approx(np.quantile(values, p), abs=1e-12)
        assert found[("b", p)] == pytest.approx(np.quantile(odd, p), abs=1e-9)


def test_outliers_of_unknown_columns(spark):
    df = spark.createDataFrame([(1, None), (2, float("nan"))], "a int, b double")
    found = {r["column_name"]: r["outliers"] for r in quality.outlier_report(df).collect()}
    assert found == {"a": 0, "b": 0}


def test_dense_ids(spark, skewed, many_chunks):
    ids = [tuple(r) for r in skew.dense_ids(skewed, "k", "ix").orderBy("ix").collect()]
    assert [i for _, i in ids] == list(range(len(ids))) and [k for k, _ in ids] == sorted(k for k, _ in ids)


def test_sessions_equal_session_windows(spark):
    """Gaps below, at and above the limit."""
    seconds = [0, 1799, 1800 + 1799, 3600 + 1799 + 1, 10_000, 11_800, 13_601, 13_602]
    df = spark.createDataFrame([(1, s) for s in seconds] + [(2, 5)], "u int, s int").withColumn(
        "ts", F.timestamp_seconds("s")
    )
    native = sessions(df, "ts", "1800 seconds", ["u"], [F.count(F.lit(1)).alias("n")])
    ours = batch_sessions(df, "ts", 1800, ["u"], {"n": F.lit(1)})
    assert sorted(map(str, native.collect())) == sorted(map(str, ours.collect()))


def test_co_occurrence_large_groups_equal_brute_force(spark):
    rng = np.random.default_rng(3)
    cells = {(int(g), int(m)) for g in range(12) for m in rng.choice(200, size=90 if g < 2 else 6, replace=False)}
    df = spark.createDataFrame(sorted(cells), "g int, m int")
    expected: dict = {}
    for g in range(12):
        members = sorted(m for x, m in cells if x == g)
        for i, a in enumerate(members):
            for b in members[i + 1 :]:
                expected[(a, b)] = expected.get((a, b), 0) + 1
    for small, block in ((64, 16), (1, 50), (1000, 16)):
        found = {(r["a"], r["b"]): r["n"] for r in graph.co_occurrence(df, "g", "m", small=small, block=block).collect()}
        assert found == expected
    twice = {(r["a"], r["b"]) for r in graph.co_occurrence(df, "g", "m", min_count=2).collect()}
    assert twice == {p for p, n in expected.items() if n >= 2}


def test_edges_are_packed_for_their_triples(spark):
    """An edge is sent p times; a row of its own for each would be some 100 bytes."""
    pairs = spark.range(20_000).selectExpr("id % 100 a", "100 + (id * 31) % 997 b").distinct()
    dealt = pairs.coalesce(1).mapInArrow(graph._edge_blobs(5), "triple bigint, low binary, n binary, high binary")
    low, n, high = dealt.agg(*[F.sum(F.octet_length(c)) for c in ("low", "n", "high")]).first()
    edges = pairs.count()
    assert high == 4 * 5 * edges and low + n + high < 8 * 5 * edges


def test_blocks_of_many_small_groups_send_few_rows(spark):
    """A row must not go to every block that anything near it has: 3,000 groups of three meet 1,250 blocks."""
    cells = spark.range(9000).selectExpr("cast(id % 3000 as int) grp", "cast((id * 7919) % 20000 as int) member").distinct()
    dealt, most = graph._dealt(cells, 16)
    assert dealt.count() <= most <= 2 * 3 * 3000 + 2 * 9000
    pairs = graph.co_occurrence(cells, "grp", "member", small=1, block=16)
    same = graph.co_occurrence(cells, "grp", "member")
    assert pairs.count() > 0 and pairs.exceptAll(same).isEmpty() and same.exceptAll(pairs).isEmpty()


def test_full_cells_equal_written_out_pairs(spark):
    """Groups that share most of their members are matrix products; names are text here."""
    cells = spark.range(40 * 60).selectExpr("concat('g', id % 40) grp", "concat('m', (id * 37 + id % 40) % 97) member").distinct()
    full = graph.co_occurrence(cells, "grp", "member", small=1, block=64)
    same = graph.co_occurrence(cells, "grp", "member", small=1000)
    assert full.agg(F.max("n")).first()[0] > 10
    assert full.exceptAll(same).isEmpty() and same.exceptAll(full).isEmpty()


def test_graph_algorithms_by_hand(spark):
    edges = spark.createDataFrame(
        [("a", "b"), ("b", "c"), ("c", "a"), ("c", "d"), ("x", "y")], "src string, dst string"
    )
    nodes = spark.createDataFrame([(v,) for v in "abcdxyz"], "id string")
    found = {r["id"]: r["component"] for r in graph.connected_components(nodes, edges).collect()}
    assert found == {"a": "a", "b": "a", "c": "a", "d": "a", "x": "x", "y": "x", "z": "z"}
    triangles = {r["id"]: r["triangles"] for r in graph.triangle_counts(edges).collect()}
    assert triangles == {"a": 1, "b": 1, "c": 1, "d": 0, "x": 0, "y": 0}
    hops = {(r["id"], r["landmark"]): r["distance"] for r in graph.shortest_paths(edges, nodes.filter("id = 'd'")).collect()}
    assert hops == {("d", "d"): 0, ("c", "d"): 1, ("b", "d"): 2, ("a", "d"): 3}
    ranks = graph.pagerank(nodes, edges).agg(F.sum("pagerank")).first()[0]
    assert ranks == pytest.approx(7.0)


def _reach(edges):
    """Smallest id per connected component, by repeated merging."""
    label = {v: v for e in edges for v in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            low = min(label[a], label[b])
            changed |= label[a] != low or label[b] != low
            label[a] = label[b] = low
    return label


@pytest.mark.parametrize("shared", [False, True])
def test_components_are_named_by_ids_whether_or_not_hashes_are_shared(spark, monkeypatch, shared):
    """Rounds see numbers, names are the smallest ids: also of a vertex that only edges know, and of vertices without edges."""
    if shared:
        monkeypatch.setattr(graph, "_hash", lambda id: F.pmod(F.xxhash64(id), F.lit(5)))
    edges = [(f"v{i}", f"v{i * 3 % 45}") for i in range(45)] + [("x", "B"), ("y", "x"), ("y", "x"), ("z", "z")]
    nodes = sorted({v for e in edges for v in e} - {"B"}) + ["alone", None]
    frame = spark.createDataFrame([*edges, (None, "x"), ("v1", None)], "src string, dst string")
    found = graph.connected_components(spark.createDataFrame([(v,) for v in nodes], "id string"), frame)
    expected = {**_reach(edges), "alone": "alone", None: None}
    assert sorted((r["id"] or "", r["component"] or "") for r in found.collect()) == sorted((v or "", expected[v] or "") for v in nodes)


def test_rounds_of_components_see_no_text(spark, monkeypatch):
    seen, star = [], graph._large_star
    monkeypatch.setattr(graph, "_large_star", lambda links: seen.append(dict(links.dtypes)) or star(links))
    edges = spark.range(20).select(F.concat(F.lit("a"), "id").alias("src"), F.concat(F.lit("a"), F.col("id") + 1).alias("dst"))
    nodes = spark.range(21).select(F.concat(F.lit("a"), "id").alias("id"))
    assert graph.connected_components(nodes, edges).select("component").distinct().collect() == [("a0",)]
    assert seen and all(set(kinds.values()) == {"bigint"} for kinds in seen)


def test_long_chain_is_one_component(spark):
    edges = spark.range(200).select(F.col("id").alias("src"), (F.col("id") + 1).alias("dst"))
    nodes = spark.range(201)
    assert graph.connected_components(nodes, edges).select("component").distinct().count() == 1


def test_motif_rows_equal_counts(spark):
    edges = spark.createDataFrame(
        [("c1", "p", "purchases"), ("c2", "p", "purchases"), ("s1", "p", "sells"), ("s2", "q", "sells"), ("c1", "q", "reviews")],
        "src string, dst string, relationship string",
    )
    matches = sorted(tuple(r) for r in graph.motif_rows(edges).collect())
    assert matches == [("c1", "p", "s1"), ("c2", "p", "s1")]
    assert [tuple(r) for r in graph.motif_counts(edges, "seller").collect()] == [("s1", 2)]


# --- plans -------------------------------------------------------------------------------------------------------


def test_small_dimension_is_broadcast_and_large_is_not(spark, sf):
    small = joins.dim_join(t.items(spark, sf), t.products(spark, sf), ["product_id"])
    assert "BroadcastHashJoin" in plan(small)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        large = joins.dim_join(t.items(spark, sf), t.products(spark, sf), ["product_id"], max_bytes=0)
        assert "SortMergeJoin" in plan(large)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scan_reads_only_what_is_asked(spark, sf):
    df = t.orders(spark, sf).filter(F.col("order_id") == 7).select("customer_id")
    text = plan(df)
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint>" in text
    assert "EqualTo(o_orderkey,7)" in text


def test_bucketed_join_has_no_exchange(spark, sf):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        left, right = scans.bucketed_pair(spark, sf)
        text = plan(left.join(right, "order_id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_rank_filter_prunes_before_the_shuffle(spark, sf):
    df = t.items(spark, sf)
    for method in ("rank", "dense_rank", "row_number"):
        text = plan(windows.top_n(df, ["return_flag"], [F.desc("price")], 5, method))
        assert "WindowGroupLimit" in text and "Partial" in text


def test_partition_filter_prunes_folders(spark, sf, tmp_path):
    from mercato.operators.shaping import with_calendar
    from mercato.sources.files import read_table
    from mercato.sources.sinks import write_layer

    df = with_calendar(t.items(spark, sf), "ship_date")
    write_layer(df, "silver", "items", str(tmp_path), partition_by=["year", "month"])
    stored = read_table(spark, "silver", "items", str(tmp_path))
    assert "PartitionFilters: [isnotnull(year" in plan(stored.filter("year = 1997"))


def test_revenue_groups_before_it_joins(spark, sf):
    from mercato.operators.metrics import revenue_via

    text = plan(revenue_via(t.items(spark, sf), t.products(spark, sf), "product_id", "category"))
    assert text.index("Join") < text.rindex("HashAggregate")
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text


def test_pairs_are_packed_before_they_are_shuffled(spark):
    """A pair takes few bytes, repeated ones are added up, and no row per pair meets an exchange."""
    rng = np.random.default_rng(4)
    lists = [sorted(rng.choice(3000, rng.integers(1, 40), replace=False).tolist()) for _ in range(800)]
    want = Counter(pair for x in lists for pair in itertools.combinations(x, 2))
    p, m = 5, 3000 // 5 + 1
    batch = pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int64()))], names=["m"])
    blobs = pa.Table.from_batches(graph._pair_blobs(p, m, graph._of_lists)(iter([batch])))
    assert sum(len(x) for x in blobs.column("keys").to_pylist()) < 2 * want.total()
    found = [graph._totals_of_cell(p, m, pa.int64())(blobs.slice(k, 1)).to_pylist() for k in range(blobs.num_rows)]
    assert {(r["a"], r["b"]): r["n"] for x in found for r in x} == want and sum(map(len, found)) == len(want)

    rows = [(g, x, f"{x:05}", x - 1500) for g, xs in enumerate(lists) for x in xs]
    df = spark.createDataFrame(rows, "g int, x int, name string, low bigint")
    out = graph.co_occurrence(df, "g", "x")
    assert "hashpartitioning(a" not in out._jdf.queryExecution().executedPlan().toString()
    assert out.dtypes == [("a", "int"), ("b", "int"), ("n", "bigint")]
    assert {(r["a"], r["b"]): r["n"] for r in out.collect()} == want
    assert {(int(r["a"]), int(r["b"])): r["n"] for r in graph.co_occurrence(df, "g", "name").collect()} == want
    assert {(r["a"] + 1500, r["b"] + 1500): r["n"] for r in graph.co_occurrence(df, "g", "low").collect()} == want


def test_triangles_are_counted_in_passes(spark, monkeypatch):
    """A pass shuffles an edge a bounded number of times, whatever the colours; its shuffle is gone before the next."""
    rng = np.random.default_rng(9)
    pairs = [tuple(map(int, x)) for x in rng.integers(0, 90, (900, 2))]
    around = collections.defaultdict(set)
    for x, y in pairs:
        if x != y:
            around[x].add(y), around[y].add(x)
    want = {v: sum(len(around[v] & around[w]) for w in around[v]) // 2 for v in around}
    stored, pin = [], graph.pin
    monkeypatch.setattr(graph, "pin", lambda df: stored.append(df) or pin(df))
    for kind in ("bigint", "string"):
        edges = spark.createDataFrame(pairs, "src bigint, dst bigint").selectExpr(f"CAST(src AS {kind}) AS src", f"CAST(dst AS {kind}) AS dst")
        stored.clear()
        out = graph.triangle_counts(edges, edges_per_task=50, copies=2)
        assert {int(r["id"]): r["triangles"] for r in out.collect()} == want
        # p is the prime 11 from the root of 6 · 900 / 50, so six passes
        assert sum("triple" in df._jdf.queryExecution().toString() for df in stored) == 6


def test_a_stored_table_leaves_no_shuffle(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    files = lambda: {x for d in manager.localDirs() for x in Path(d.toString()).rglob("shuffle_*.data")}
    before, df = files(), spark.range(100_000).groupBy((F.col("id") % 1009).alias("k")).count()
    assert pin(df).count() == 1009 and pin(df).groupBy("k").count().count() == 1009 and df.count() == 1009
    before |= files()
    stored = pin(df)
    for _ in range(50):
        if files() <= before:
            break
        time.sleep(0.1)
    assert files() <= before and stored.count() == 1009
