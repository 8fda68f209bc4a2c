"""Min-hash fingerprints of documents: universal hash permutations of word shingles, bands joined in Spark.

``fingerprinted`` gives every text and an edited form of it their fingerprints; ``near_pairs`` compares all that share a
signature band and verifies the Jaccard similarity of what is left.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import store, text_of
from mercato.llm.neardup import BUCKET_BLOCK, block_pairs, blocks, least_matches, surviving, whole_groups
from mercato.llm.shingles import MinHash, band_hashes, digest8, sequence_key, shingle_set, word_hashes

PERMUTATIONS = 128
WIDTH = 5
BAND_ROWS = 4  # 32 bands: a pair at 0.8 shares none with probability (1 - 0.8^4)^32 = 5e-8


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Similarity that two rows of eight-bit digests show; digests of different minima agree once in 256."""
    agree = (a == b).mean(axis=-1)
    return np.clip((agree - 1 / 256) / (1 - 1 / 256), 0.0, 1.0)


def _digests(texts: list[str], hasher: MinHash) -> np.ndarray:
    out = [digest8(hasher(shingle_set(w, WIDTH))) for w in word_hashes(texts, lower=False)]
    return np.frombuffer(b"".join(out), dtype=np.uint8).reshape(len(out), PERMUTATIONS)


def edited(text: str, following: str) -> str:
    """The last third (rounded down) of the code points replaced by as many from the start of the following text, or all of it."""
    cut = len(text) // 3
    return text[: len(text) - cut] + following[:cut]


_SCHEMA = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, "
    "part int, edge string, text string"
)


def fingerprinted(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next of every row.

    The next document is the one with the next smaller doc_id, after the last the first; a null doc_id comes last, rows
    with the same id lie in the order of a hash of their text. Null text is the empty text. Words are runs of anything
    but ASCII white space; a text with fewer words than a shingle is one shingle, and texts without words have the
    fingerprint of the empty set, alike among themselves and unlike all others. A single row is its own next document.

    Rows are ranged by doc_id once; a partition's last row meets the first of the next partition in a second, small join.
    """
    spark = docs.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(n, F.col("doc_id").desc_nulls_last()).sortWithinPartitions(*order)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        part = TaskContext.get().partitionId()
        held: tuple[int | None, str] | None = None
        for batch in batches:
            if not batch.num_rows:
                continue
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()
            first = held is None
            if not first:
                ids, texts = [held[0], *ids], [held[1], *texts]
            else:
                yield _edge(part, "head", ids[0], texts[0])
            held = (ids[-1], texts[-1])
            if len(ids) > 1:
                yield _described(ids[:-1], texts, hasher)
        if held is not None:
            yield _edge(part, "tail", *held)

    found = store(ranged.mapInArrow(run, _SCHEMA), "fingerprints")
    edges = found.where("edge is not null")
    heads = edges.where("edge = 'head'").select("part", F.col("text").alias("following"))
    # one row per partition: which partition follows, the first after the last
    parts = heads.select("part").withColumn("next", F.coalesce(F.lead("part").over(Window.orderBy("part")), F.min("part").over(Window.partitionBy())))
    tails = edges.where("edge = 'tail'").select("doc_id", "text", "part").join(parts, "part")
    pairs = tails.join(heads.withColumnRenamed("part", "next"), "next").select("doc_id", "text", "following")

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        for batch in batches:
            for i, t, f in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "following")), strict=True):
                yield _described([i], [t, f], hasher)

    return found.where("edge is null").unionByName(pairs.mapInArrow(last, _SCHEMA)).drop("part", "edge", "text")


def _columns(ids: list, values: list[list], part: int | None, edge: str | None, texts: list) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int32(), pa.string(), pa.string()]
    names = [c.split()[0] for c in _SCHEMA.split(", ")]
    columns = [ids, *values, [part] * len(ids), [edge] * len(ids), texts]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _edge(part: int, edge: str, doc_id: int | None, text: str) -> pa.RecordBatch:
    return _columns([doc_id], [[None]] * 6, part, edge, [text])


def _described(ids: list, texts: list[str], hasher: MinHash) -> pa.RecordBatch:
    """Rows for ``ids``; ``texts`` holds one text more, which follows the last."""
    changed = [edited(t, f) for t, f in zip(texts, texts[1:], strict=False)]
    own, new = _digests(texts, hasher), _digests(changed, hasher)
    values = [
        [len(t) for t in texts[:-1]], [hashlib.sha256(t.encode()).hexdigest() for t in changed],
        [d.tobytes().hex() for d in own[:-1]], [d.tobytes().hex() for d in new],
        likeness(own[:-1], new).tolist(), likeness(own[:-1], own[1:]).tolist(),
    ]
    return _columns(ids, values, None, None, [None] * len(ids))


def near_pairs(docs: DataFrame, *, threshold: float = 0.8) -> DataFrame:
    """(a, b, jaccard), a < b: all pairs of classes at or above ``threshold`` by their smallest ids, and every class's members.

    Texts with equal shingle sets are one class; each of its other ids comes once, with the smallest and jaccard 1. Of
    two classes that share a band the signatures are compared and then Jaccard is computed on both full sets, whichever
    else the band holds. A pair at the threshold is missed by the bands with 5e-8 (at 0.8) and by the signatures with
    about 1e-6. Bands are compared in blocks within tasks, so only pairs that their signatures leave become rows. Ids
    must be unique and not null.
    """
    least = least_matches(threshold, PERMUTATIONS)

    def signatures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = MinHash(PERMUTATIONS)
        for batch in batches:
            ids, keys, sizes, sigs, bands = [], [], [], [], []
            for i, words in zip(batch.column("id").to_pylist(), word_hashes(batch.column("text").to_pylist(), lower=False), strict=True):
                if len(words):
                    shingles = shingle_set(words, WIDTH)
                    mins = hasher(shingles)
                    ids.append(i), keys.append(sequence_key(shingles)), sizes.append(len(shingles))
                    sigs.append(digest8(mins)), bands.append(band_hashes(mins, BAND_ROWS))
            columns = [pa.array(ids, pa.int64()), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()), pa.array(sigs, pa.binary()), pa.array(bands, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=["uid", "key", "n", "sig", "bands"])

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, group in whole_groups(batches, ["band", "i", "j"]):
            uid, n, own, i, j = (table.column(c).to_numpy() for c in ("uid", "n", "own", "i", "j"))
            sig = np.frombuffer(b"".join(table.column("sig").to_pylist()), dtype=np.uint8).reshape(len(group), -1)
            for x, y in block_pairs(group, own, i, j):
                left = surviving(sig, n, x, y, least, 100 * threshold - 1e-6)
                u, v = uid[x[left]], uid[y[left]]
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(u, v)), pa.array(np.maximum(u, v))], names=["a", "b"])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = (list(word_hashes(batch.column(c).to_pylist(), lower=False)) for c in ("ta", "tb"))
            sims = []
            for x, y in zip(left, right, strict=True):
                sx, sy = shingle_set(x, WIDTH), shingle_set(y, WIDTH)
                both = len(np.intersect1d(sx, sy, assume_unique=True))
                sims.append(both / (len(sx) + len(sy) - both))
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(sims, pa.float64())], names=["a", "b", "jaccard"])

    rows = docs.select(F.col("doc_id").cast("long").alias("id"), text_of().alias("text"))
    signed = store(rows.mapInArrow(signatures, "uid long, key binary, n long, sig binary, bands array<long>"), "fingerprint-bands")
    classes = signed.groupBy("key").agg(F.min("uid").alias("a"))
    members = signed.join(classes, "key").where("uid > a").select("a", F.col("uid").alias("b"), F.lit(1.0).alias("jaccard"))
    firsts = signed.join(classes.select(F.col("a").alias("uid")), "uid", "left_semi")
    buckets = store(firsts.select("uid", "n", "sig", F.explode("bands").alias("band")), "fingerprint-buckets")
    keys = ["band", "i", "j"]
    dealt = blocks(buckets, "band", BUCKET_BLOCK).repartition(*keys).sortWithinPartitions(*keys).select("uid", "n", "sig", "own", *keys)
    met = dealt.mapInArrow(meet, "a long, b long").distinct()
    texts = met.join(rows.select(F.col("id").alias("a"), F.col("text").alias("ta")), "a").join(rows.select(F.col("id").alias("b"), F.col("text").alias("tb")), "b")
    return texts.mapInArrow(verify, "a long, b long, jaccard double").where(F.col("jaccard") >= threshold).unionByName(members)
