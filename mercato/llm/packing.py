"""Best-fit packing planned on the histogram of lengths; pieces take planned places by rank within their length.

The plan works on counts: it holds one row per (length, group of equal sequences), so it costs the same for a thousand
documents and for a trillion. Pieces find their place by joining on length and rank.
"""

from __future__ import annotations

import base64
import functools
import json
import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import rank_within, small_table, store

CAPACITY = 2048
END_ID = 0
# The vocabulary's own split pattern in possessive form: the same pieces with less backtracking.
SPLIT = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def default_vocabulary() -> str:
    """The ranks of byte_bpe_50k.json; the library that reads them encodes five times as fast, with the same ids."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


def added_tokens(path: str) -> dict[str, int]:
    """Strings that are one id wherever they stand in a text, longest first, from the .json beside the ranks, where there is one."""
    beside = Path(path).with_suffix(".json")
    added = json.loads(beside.read_text(encoding="utf-8"))["added_tokens"] if beside.exists() else []
    for t in added:
        if any(t[flag] for flag in ("single_word", "lstrip", "rstrip")):
            raise ValueError(f"added token {t['content']!r} takes its surroundings into account")
    return {t["content"]: t["id"] for t in sorted(added, key=lambda t: -len(t["content"]))}


@functools.lru_cache(maxsize=2)
def encoder(path: str):
    """Text to ids by the ranks at ``path``, a file every executor has; added tokens in a text are their own ids."""
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    added = added_tokens(path)
    encoding = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens=added)
    every = set(added)

    def encode(text: str) -> list[int]:
        if any(token in text for token in every):
            return encoding.encode(text, allowed_special=every, disallowed_special=())
        return encoding.encode_ordinary(text)

    return encode


def cut(n: int, capacity: int) -> list[int]:
    """Piece boundaries of a document of ``n`` ids: whole when it fits, else full pieces after a first that may be shorter."""
    first = n - (-(-n // capacity) - 1) * capacity
    return [0, *range(first, n + 1, capacity)]


@dataclass(frozen=True)
class Place:
    """Ranks from ``first`` of one length: layer (rank - first) div bins, sequence ``sequence`` + (rank - first) mod bins."""

    length: int
    first: int
    last: int
    bins: int
    sequence: int
    offset: int


def plan_places(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[Place], int]:
    """Best-fit decreasing over counts: all places and the number of sequences.

    Longest first, every piece goes to the fullest sequence that still takes it. A sequence filled so is again the
    fullest, so it takes as many pieces of this length as fit before the next one is looked at; that makes whole groups
    of equal sequences move at once.
    """
    rooms: dict[int, list[tuple[int, int]]] = {}  # room left -> intervals of sequences
    places: list[Place] = []
    opened = 0

    def put(length: int, room: int, start: int, bins: int, first: int, left: int) -> tuple[int, int]:
        """Fill up to ``bins`` sequences from ``start``; returns pieces placed and sequences used."""
        per = room // length
        full = min(bins, left // per)
        done = full * per
        if full:
            places.append(Place(length, first, first + done, full, start, capacity - room))
            rooms.setdefault(room - per * length, []).append((start, start + full))
        rest = min(left - done, per - 1) if full < bins else 0
        if rest:
            places.append(Place(length, first + done, first + done + rest, 1, start + full, capacity - room))
            rooms.setdefault(room - rest * length, []).append((start + full, start + full + 1))
        return done + rest, full + (rest > 0)

    for length in sorted((x for x, n in histogram.items() if n), reverse=True):
        left, first = histogram[length], 0
        for room in sorted(r for r in rooms if r >= length):
            spans, kept = rooms.pop(room), []
            for a, b in spans:
                placed, used = put(length, room, a, b - a, first, left) if left else (0, 0)
                first, left = first + placed, left - placed
                if used < b - a:
                    kept.append((a + used, b))
            if kept:
                rooms.setdefault(room, []).extend(kept)
            if not left:
                break
        if left:
            bins = -(-left // (capacity // length))
            put(length, capacity, opened, bins, first, left)
            opened += bins
    return places, opened


def pieces(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32[, ids], part, uid), stored. Null text is the empty text: just the end id."""
    path = vocabulary or default_vocabulary()
    rows = docs.select("doc_id", F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path)
        for batch in batches:
            at, piece, start, length, crc, kept = [], [], [], [], [], []
            for row, text in enumerate(batch.column("text")):
                ids = np.array([*encode(text.as_py()), END_ID], dtype="<u4")
                edges = cut(len(ids), capacity)
                for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
                    at.append(row), piece.append(n), start.append(a), length.append(b - a), crc.append(zlib.crc32(ids[a:b]))
                    if with_ids:
                        kept.append(ids[a:b].astype(np.int32))
            columns = [batch.column("doc_id").take(pa.array(at, pa.int64())), pa.array(piece, pa.int32())]
            columns += [pa.array(x, pa.int64()) for x in (start, length, crc)]
            if with_ids:
                columns.append(pa.array(kept, pa.list_(pa.int32())))
            yield pa.RecordBatch.from_arrays(columns, names=names)

    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if with_ids else [])]
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    found = rows.mapInArrow(split, schema)
    return store(found.withColumn("part", F.spark_partition_id()).withColumn("uid", F.monotonically_increasing_id()), "pack-pieces")


def pack(docs: DataFrame, *, capacity: int = CAPACITY, vocabulary: str | None = None, with_ids: bool = False) -> DataFrame:
    """Pack every document into sequences of at most ``capacity`` tokens.

    A document is its ids and an end id. Only longer ones are cut, into full pieces after a first that may be shorter.
    Returns a row per piece: doc_id, piece, start (the document's ids before it), length, ids_crc32, sequence_id, offset
    (tokens before it in its sequence, gapless) and, on request, ids. Repeated rows are separate documents; null ids are
    kept. An empty table gives no rows.
    """
    cut_up = pieces(docs, capacity=capacity, vocabulary=vocabulary, with_ids=with_ids)
    # as many rows as there are lengths: at most the capacity
    histogram = {r["length"]: r["n"] for r in cut_up.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    places, _ = plan_places(histogram, capacity)
    rows = [(p.length, p.first, p.last, p.bins, p.sequence, p.offset) for p in places]
    plan = small_table(docs.sparkSession, rows, "length long, first long, last long, bins long, sequence long, base long")
    ranked = rank_within(cut_up, ["length"], ["uid"], "rank")
    placed = ranked.join(plan, (ranked["length"] == plan["length"]) & (F.col("rank") >= F.col("first")) & (F.col("rank") < F.col("last"))).drop(plan["length"])
    layer = F.expr("(rank - first) div bins")
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("sequence") + F.pmod(F.col("rank") - F.col("first"), F.col("bins"))).alias("sequence_id"),
        (F.col("base") + layer * F.col("length")).alias("offset"), *(["ids"] if with_ids else []),
    )
