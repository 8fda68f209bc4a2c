"""Near-duplicate documents: banded min-hash candidates, sequential Bayesian pruning, exact verification on full sets.

1. Equal word sequences become one class. Every class has a min-hash signature and its band hashes.
2. Classes that share a band are candidates. Their signatures are compared a batch of hashes at a time, and a pair goes
   as soon as, by the posterior of its similarity, a similarity at the threshold has less than the miss probability.
3. What survives is joined into candidate clusters, and within a cluster all pairs are verified on full shingle sets.
4. Verified links give components; every document takes the smallest id of its component.

No pair is ever a row: tasks compare blocks of members and give back a forest of the links found, at most one row per
member. Buckets and clusters of any size are cut into blocks by hash, and pairs of blocks go to tasks of their own.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import discard, store, text_of
from mercato.llm.shingles import MinHash, band_hashes, digest8, sequence_key, shingle_set, word_hashes

ROWS, BANDS = 5, 32  # at the threshold 0.8 a pair shares no band with probability (1 - 0.8^5)^32 = 3e-6
STEP = 32  # hashes compared at a time
MISS = 1e-6  # a pair is pruned when its similarity reaches the threshold with at most this probability
BUCKET_BLOCK = 256
CLUSTER_BLOCK = 128
PAIRS = 1 << 18  # pairs compared at once


def least_matches(threshold: float, hashes: int, miss: float = MISS) -> list[int]:
    """After each batch, the fewest matches with which a pair goes on.

    Under a uniform prior the posterior of the match rate is Beta(m + 1, n - m + 1), whose upper tail at the rate t is
    a binomial sum. Eight-bit digests of different minima agree once in 256, so the threshold is raised to that rate.
    """
    t = threshold + (1 - threshold) / 256
    out = []
    for n in range(STEP, hashes + 1, STEP):
        tail, m = 0.0, 0
        while m <= n:
            # P(rate >= t | m of n) = P(Binomial(n + 1, t) <= m)
            tail += math.comb(n + 1, m) * t**m * (1 - t) ** (n + 1 - m)
            if tail > miss:
                break
            m += 1
        out.append(m)
    return out


def forest(a: np.ndarray, b: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest member of its component) of a graph on 0..n-1, for members that are not the smallest."""
    label = np.arange(n)
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = np.minimum(new, new[new])
        if (new == label).all():
            moved = np.flatnonzero(label != np.arange(n))
            return moved, label[moved]
        label = new


def signed(docs: DataFrame, *, width: int, id_column: str = "doc_id") -> DataFrame:
    """(id, uid, key, n, sig, bands) of every row, stored; key is null where there are no words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(ROWS * BANDS)
        for batch in batches:
            keys, sizes, sigs, bands = [], [], [], []
            for words in word_hashes(batch.column("text").to_pylist()):
                shingles = shingle_set(words, width)
                sizes.append(len(shingles))
                if len(words):
                    mins = hasher(shingles)
                    keys.append(sequence_key(words)), sigs.append(digest8(mins)), bands.append(band_hashes(mins, ROWS))
                else:
                    keys.append(None), sigs.append(None), bands.append(None)
            columns = [pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays([batch.column("id"), *columns], names=["id", "key", "n", "sig", "bands"])

    rows = docs.select(F.col(id_column).alias("id"), text_of().alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    out = rows.mapInArrow(run, f"id {kind}, key binary, n long, sig binary, bands array<long>")
    return store(out.withColumn("uid", F.monotonically_increasing_id()), "near-signed")


def blocks(rows: DataFrame, key: str, members: int) -> DataFrame:
    """Every row once per pair of blocks of its group: adds i, j (the pair) and own (its block).

    Groups are cut by a hash of uid into blocks of about ``members``; sizes are counted, rows are not ranked.
    """
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_m")).where("_m > 1")
    k = F.ceil(F.col("_m") / F.lit(members)).cast("int")
    cut = rows.join(counts, key).withColumn("own", F.pmod(F.xxhash64(F.lit(3), "uid"), k).cast("int"))
    pair = F.explode(F.transform(F.sequence(F.lit(0), k - 1), lambda o: F.struct(F.least("own", o).alias("i"), F.greatest("own", o).alias("j"))))
    return cut.withColumn("_p", pair).select("*", "_p.i", "_p.j").drop("_p", "_m")


def _by_group(rows: DataFrame, keys: list[str], compare: Callable[[dict[str, np.ndarray | pa.Array], np.ndarray], tuple[np.ndarray, np.ndarray]], columns: list[str]) -> DataFrame:
    """(uid, low): what ``compare`` links in each group of equal ``keys``, as a forest.

    Groups lie side by side in sorted partitions; whole groups are compared a batch at a time.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, keys):
            yield linked(table, group)

    def linked(table: pa.Table, group: np.ndarray) -> pa.RecordBatch:
        uid = table.column("uid").to_numpy()
        a, b = compare({c: table.column(c).combine_chunks() for c in columns}, group)
        names, at = np.unique(uid, return_inverse=True)
        member, low = forest(at[a], at[b], len(names))
        return pa.RecordBatch.from_arrays([pa.array(names[member]), pa.array(names[low])], names=["uid", "low"])

    dealt = rows.repartition(*keys).sortWithinPartitions(*keys)
    return dealt.select("uid", *dict.fromkeys([*keys, *columns])).mapInArrow(run, "uid long, low long").distinct()


def whole_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[pa.Table, np.ndarray]]:
    """Rows sorted by ``keys``, whole groups of equal keys a batch at a time, with the number of every row's group."""
    rest: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        group = _runs(table, keys)
        whole = int(np.searchsorted(group, group[-1])) if len(group) else 0
        rest = table.slice(whole)
        if whole:
            yield table.slice(0, whole), group[:whole]
    if rest is not None and rest.num_rows:
        yield rest, _runs(rest, keys)


def _runs(table: pa.Table, keys: list[str]) -> np.ndarray:
    """Number of the run of equal keys that a row is in."""
    change = np.zeros(table.num_rows, dtype=bool)
    for k in keys:
        v = table.column(k).to_numpy()
        change[1:] |= v[1:] != v[:-1]
    return np.cumsum(change)


def block_pairs(group: np.ndarray, own: np.ndarray, i: np.ndarray, j: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs to compare: across the two blocks, or within the block when both are the same."""
    starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
    held_a, held_b, n = [], [], 0
    for s, e in zip(starts, np.r_[starts[1:], len(group)], strict=True):
        if i[s] == j[s]:
            if e - s == 2:
                a, b = np.array([s]), np.array([s + 1])
            else:
                a, b = np.triu_indices(e - s, 1)
                a, b = a + s, b + s
        else:
            left, right = s + np.flatnonzero(own[s:e] == i[s]), s + np.flatnonzero(own[s:e] == j[s])
            a, b = np.repeat(left, len(right)), np.tile(right, len(left))
        held_a.append(a), held_b.append(b)
        n += len(a)
        if n >= PAIRS:
            yield np.concatenate(held_a), np.concatenate(held_b)
            held_a, held_b, n = [], [], 0
    if n:
        yield np.concatenate(held_a), np.concatenate(held_b)


def surviving(sig: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray, least: list[int], percent: int) -> np.ndarray:
    """Which of the pairs (a, b) the sequential test lets through; set sizes too far apart go first."""
    alive = np.flatnonzero(np.minimum(n[a], n[b]) * 100 >= percent * np.maximum(n[a], n[b]))
    matches = np.zeros(len(alive), dtype=np.int32)
    for step, fewest in enumerate(least):
        cols = slice(step * STEP, (step + 1) * STEP)
        matches += (sig[a[alive], cols] == sig[b[alive], cols]).sum(axis=1, dtype=np.int32)
        keep = matches >= fewest
        alive, matches = alive[keep], matches[keep]
    return alive


def _candidates(percent: int):
    least = least_matches(percent / 100, ROWS * BANDS)

    def compare(col: dict, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        sig = np.frombuffer(b"".join(col["sig"].to_pylist()), dtype=np.uint8).reshape(len(group), -1)
        n, own, i, j = (col[c].to_numpy() for c in ("n", "own", "i", "j"))
        found = [(a[k], b[k]) for a, b in block_pairs(group, own, i, j) for k in [surviving(sig, n, a, b, least, percent)]]
        return _joined(found)

    return compare


def _joined(found: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    none = np.zeros(0, dtype=np.int64)
    return tuple(np.concatenate([none, *[f[k] for f in found]]) for k in (0, 1))


def _verified(percent: int, width: int):
    """All pairs of a group by the exact sizes of their intersections: rows times columns of the shingles they share."""

    def compare(col: dict, group: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        own, i, j = (col[c].to_numpy() for c in ("own", "i", "j"))
        starts = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        texts, found = col["text"], []
        for s, e in zip(starts, np.r_[starts[1:], len(group)], strict=True):
            sets = [shingle_set(w, width) for w in word_hashes(texts.slice(s, e - s).to_pylist())]
            n = np.array([len(x) for x in sets])
            both = _intersections(sets)
            ok = (both * 100 >= percent * (n[:, None] + n[None, :] - both)) & (n[:, None] > 0)
            across = (own[s:e, None] == i[s]) & (own[None, s:e] == j[s])
            a, b = np.nonzero(ok & across & (~np.eye(e - s, dtype=bool)))
            found.append((a + s, b + s))
        return _joined(found)

    return compare


def _intersections(sets: list[np.ndarray]) -> np.ndarray:
    """Exact intersection sizes of all pairs; shingles that only one set has do not count and are left out."""
    rows = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    every = np.concatenate(sets) if sets else np.zeros(0, dtype=np.uint64)
    values, at, counts = np.unique(every, return_inverse=True, return_counts=True)
    shared = counts > 1
    column = np.cumsum(shared) - 1
    keep = shared[at]
    rows, cols, total = rows[keep], column[at[keep]], int(shared.sum())
    out = np.zeros((len(sets), len(sets)), dtype=np.int64)
    order = np.argsort(cols, kind="stable")
    rows, cols = rows[order], cols[order]
    for c in range(0, total, 4096):
        lo, hi = np.searchsorted(cols, [c, c + 4096])
        part = np.zeros((len(sets), min(4096, total - c)), dtype=np.float32)  # sums below 2^24 are exact
        part[rows[lo:hi], cols[lo:hi] - c] = 1
        out += (part @ part.T).astype(np.int64)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(uid, root) for every node of the graph with edges (uid, low) but the roots: root is the smallest node connected.

    Large-star and small-star steps: every node hands its larger neighbours, then all its smaller ones, to its smallest
    neighbour, until only stars are left. Rounds grow with the logarithm of the longest path; each is stored once and the
    one before it deleted. A hub is a minimum that combines before the shuffle and a join that may be split.
    """
    now = store(edges.where("uid <> low").select(F.greatest("uid", "low").alias("uid"), F.least("uid", "low").alias("low")).distinct(), "near-edges")
    while not _only_stars(now):
        both = now.union(now.select("low", "uid"))
        least = both.groupBy("uid").agg(F.least(F.min("low"), F.col("uid")).alias("m"))
        large = both.where("low > uid").join(least, "uid").select(F.col("low").alias("uid"), F.col("m").alias("low"))
        first = large.groupBy("uid").agg(F.min("low").alias("m"))
        ends = F.array(F.struct("uid", F.col("m").alias("low")), F.struct(F.col("low").alias("uid"), F.col("m").alias("low")))
        small = large.join(first, "uid").select(F.inline(ends))
        last, now = now, store(small.where("uid <> low").distinct(), "near-edges")
        discard(last)
    return now.select("uid", F.col("low").alias("root"))


def _only_stars(edges: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = edges.select(F.col("uid").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("low", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.sum("down").alias("down")).where("up > 1 or (up = 1 and down > 0)").isEmpty()


def near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80, id_column: str = "doc_id") -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) for every row of ``docs``.

    Words are lower-cased in A-Z. A document's set is its distinct shingles of ``width`` words; with fewer words the whole
    sequence is one shingle; without words, or with null text, the set is empty and linked with nothing. Documents are
    linked when 100 * |A and B| >= percent * |A or B|. The component is the smallest id reachable, itself included. Rows
    with a null id take no part in links and have a null component. Repeated rows fall into one component.
    """
    sigs = signed(docs, width=width, id_column=id_column)
    worded = sigs.where("key is not null and id is not null")
    classes = worded.groupBy("key").agg(F.min("uid").alias("rep"))
    reps = store(worded.join(classes, "key").where("uid = rep").select("uid", "id", "key", "n", "sig", "bands"), "near-classes")
    banded = reps.select("uid", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count(F.lit(1)).alias("m")).where("m > 1").select("band")
    buckets = store(banded.join(shared, "band").join(reps.select("uid", "n", "sig"), "uid"), "near-buckets")
    blocked = blocks(buckets, "band", BUCKET_BLOCK)
    maybe = store(_by_group(blocked, ["band", "i", "j"], _candidates(percent), ["sig", "n", "own", "i", "j"]), "near-maybe")
    discard(buckets)
    clusters = components(maybe)
    rooted = clusters.unionByName(clusters.select(F.col("root").alias("uid"), "root").distinct())
    named = rooted.join(reps.select("uid", "id", "key"), "uid")
    verified = store(_verified_links(docs, named, width=width, percent=percent, id_column=id_column), "near-links")
    roots = components(verified)
    node = sigs.join(classes, "key", "left").select("id", "n", F.when(F.col("id").isNotNull(), F.coalesce("rep", "uid")).alias("node"))
    placed = node.join(roots.select(F.col("uid").alias("node"), "root"), "node", "left").withColumn("root", F.coalesce("root", "node"))
    smallest = placed.groupBy("root").agg(F.min("id").alias("least"))
    out = placed.join(smallest, "root", "left")
    least = F.when(F.col("root").isNotNull(), F.col("least"))
    return out.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"), least.alias("component_id"), F.coalesce(F.col("id") == least, F.lit(False)).alias("kept"))


def _verified_links(docs: DataFrame, named: DataFrame, *, width: int, percent: int, id_column: str) -> DataFrame:
    """Links between the class representatives ``named`` (uid, root, id, key), on the full sets of their texts."""
    texts = docs.select(F.col(id_column).alias("id"), text_of().alias("text"))
    rows = texts.join(named, "id")
    kind = rows.schema["id"].dataType.simpleString()

    def own_text(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # an id that is not unique may bring texts of another class
        for batch in batches:
            keys = batch.column("key").to_pylist()
            keep = [k == sequence_key(w) for k, w in zip(keys, word_hashes(batch.column("text").to_pylist()), strict=True)]
            yield batch.filter(pa.array(keep, pa.bool_()))

    rows = rows.select("id", "text", "uid", "root", "key").mapInArrow(own_text, f"id {kind}, text string, uid long, root long, key binary")
    texts = store(rows.groupBy("uid", "root").agg(F.first("text").alias("text")), "near-texts")
    blocked = blocks(texts, "root", CLUSTER_BLOCK)
    return _by_group(blocked, ["root", "i", "j"], _verified(percent, width), ["text", "own", "i", "j"])


def without_near_duplicates(docs: DataFrame, *, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs``, all columns, with one row per component: the smallest doc_id, null last, and of equal ids one row.

    Rows count, not ids: repeated rows, rows that share an id, and rows without an id each take part by their own text.
    Rows without words are linked with nothing and stay.
    """
    rows = store(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("uid")), "near-rows")
    found = near_duplicates(rows.select("uid", "row.text"), width=width, percent=percent, id_column="uid").select("uid", "component_id")
    place = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("uid"))
    first = found.join(rows.select("uid", "row.doc_id"), "uid").groupBy("component_id").agg(F.min(place).alias("first"))
    return rows.join(first.select("first.uid"), "uid", "left_semi").select("row.*")
