"""Removal of repeated byte strings with suffix arrays: what a smaller document also holds goes.

Every ``length`` bytes of text hold an anchor: the gram with the smallest hash in that window, the same wherever the
string occurs. Anchors that only one text has cannot lie in a repeat, so only the surroundings of shared anchors are
compared. They are dealt out by anchor hash; a task sorts them shard by shard into suffix arrays, finds equal strings
by common prefixes, merges the shards of one anchor, and answers what stretches of the surroundings smaller documents hold.

Surroundings that are equal leave a home once, and those of an anchor in very many documents are cut into pieces that
are dealt out by more than the anchor, so no task gets all occurrences of a passage. A home finds its occurrences again
when the answers come. Text is shuffled once; the steps exchange packed arrays: anchor hashes, surroundings, stretches.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import store, text_of
from mercato.llm.shingles import mix64

LENGTH = 50
GRAM = 20
CHUNK = 1 << 18  # bytes whose anchors are found at once; one longer text is taken alone
BLOB_ANCHORS = 1 << 19  # anchors a task gathers before it packs them by range
SLICE = 1 << 15  # surroundings looked at together, but whole anchors
SHARD = 1 << 18  # bytes of surroundings in one suffix array; building it takes some 200 times as much memory
HOT = 1 << 17  # documents with an anchor beyond which its surroundings are cut into pieces
CLASSES = 4  # pieces they are cut into; three bits hold their number
HELD = 1 << 22  # bytes of surroundings that a home gathers before it packs them by range
MERGED = 1 << 16  # windows of one anchor that are compared at once
_ROOT = 0x9E3779B97F4A7C55
_ROOTS: list[np.ndarray] = []


def _root_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the rolling hash's base and of its inverse modulo 2^64."""
    if not _ROOTS or len(_ROOTS[0]) < n:
        size = max(n, 2 * CHUNK)
        _ROOTS[:] = [np.multiply.accumulate(np.r_[np.uint64(1), np.full(size, base, dtype=np.uint64)]) for base in (_ROOT, pow(_ROOT, -1, 1 << 64))]
    return _ROOTS[0], _ROOTS[1]


def _slide(x: np.ndarray, width: int, f: np.ufunc) -> np.ndarray:
    """f over every run of ``width`` values."""
    n, y = 1, x
    while n * 2 <= width:
        y = f(y[:-n], y[n:])
        n *= 2
    m = len(x) - width + 1
    return f(y[:m], y[width - n : width - n + m])


def anchors(texts: list[bytes], length: int = LENGTH, gram: int = GRAM) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, position, text number) of all anchors; positions count in the joined texts, windows stay within a text."""
    sizes = np.array([len(t) for t in texts])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    if len(data) < length:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    up, down = _root_powers(len(data) + 1)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)])]
    hashes = mix64((sums[gram:] - sums[:-gram]) * down[: len(data) - gram + 1])
    width = length - gram + 1
    least = _slide(hashes, width, np.minimum)
    ends = np.repeat(np.cumsum(sizes), sizes)[: len(least)]
    least = np.where(np.arange(len(least)) + length <= ends, least, np.uint64(0))
    edge = np.zeros(width - 1, dtype=np.uint64)
    chosen = _slide(np.concatenate([edge, least, edge]), width, np.maximum)[: len(hashes)]
    at = np.flatnonzero(hashes == chosen)
    return hashes[at], at, np.searchsorted(np.cumsum(sizes), at, side="right")


def _chunks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) of bounded bytes."""
    first, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield first, texts[first : i + 1]
            first, size = i + 1, 0
    if first < len(texts):
        yield first, texts[first:]


def suffix_array(data: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in order of their first ``depth`` bytes at least, and every suffix's rank.

    Larsson-Sadakane refinement: sorted by eight bytes first, then groups of equal suffixes, and only these, are sorted
    by the ranks of the suffixes that far behind, which doubles the depth each time.
    """
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, dtype=np.uint8)])
    keys = np.zeros(n, dtype=np.uint64)
    for j in range(8):
        keys = (keys << np.uint64(8)) | padded[j : j + n]
    order = np.argsort(keys)
    new = np.r_[True, keys[order[1:]] != keys[order[:-1]]] if n else np.zeros(0, dtype=bool)
    first = np.flatnonzero(new)
    rank = np.empty(n + 1, dtype=np.int64)
    rank[n] = -1  # behind the end
    rank[order] = np.repeat(first, np.diff(np.r_[first, n]))
    sorted_by = 8
    open_slots = np.flatnonzero(~(new & np.r_[new[1:], True])) if n else first
    while sorted_by < depth and len(open_slots):
        at = order[open_slots]
        behind = rank[np.minimum(at + sorted_by, n)]
        group = rank[at]
        inner = np.argsort(group * (n + 1) + behind + 1)  # both are below n, and a buffer is far below 2^31
        at, behind, group = at[inner], behind[inner], group[inner]
        order[open_slots] = at
        new = np.r_[True, (group[1:] != group[:-1]) | (behind[1:] != behind[:-1])]
        starts = np.flatnonzero(new)
        rank[at] = np.repeat(open_slots[starts], np.diff(np.r_[starts, len(at)]))
        open_slots = open_slots[~(new & np.r_[new[1:], True])]
        sorted_by *= 2
    if len(open_slots):
        # what is still equal lies in text order, so that neighbours of neighbours stay neighbours
        at = order[open_slots]
        order[open_slots] = at[np.argsort(rank[at] * (n + 1) + at)]
    return order, rank[:n]


def common_prefixes(data: np.ndarray, order: np.ndarray, breaks: np.ndarray, cap: int) -> np.ndarray:
    """For every place in ``order`` the bytes shared with the suffix before it, counted up to ``cap``.

    Kasai's observation, in text order: where the bytes before a suffix and before its neighbour agree, its common
    prefix is one less than its predecessor's. Only the others, and those at ``breaks``, are compared byte by byte.
    """
    n = len(order)
    before = np.full(n, -1, dtype=np.int64)
    before[order[1:]] = order[:-1]
    i = np.arange(n)
    agree = (before > 0) & (i > 0) & (data[np.maximum(i, 1) - 1] == data[np.maximum(before, 1) - 1])
    # the predecessor's neighbour must be the neighbour's predecessor for its value to carry over
    agree[1:] &= before[:-1] == before[1:] - 1
    agree[breaks] = False
    direct = np.flatnonzero(~agree)
    value = np.zeros(n, dtype=np.int64)
    alive = direct[before[direct] >= 0]
    padded = np.concatenate([data.astype(np.int16), np.full(cap + 8, -1, dtype=np.int16)])
    done = 0
    while len(alive) and done < cap:
        a, b = alive + done, before[alive] + done
        same = np.ones(len(alive), dtype=bool)
        for j in range(8):
            same &= padded[np.minimum(a + j, n + cap)] == padded[np.minimum(b + j, n + cap)]
            same &= a + j < n
            value[alive[same]] += 1
        alive = alive[same]
        done += 8
    last = np.maximum.accumulate(np.where(agree, 0, i))
    text_order = np.where(agree, np.maximum(value[last] - (i - last), 0), value)
    return text_order[order]


class _Windows:
    """Equal strings of one range's surroundings, shard by shard, with the smallest document of each."""

    def __init__(self, length: int):
        self.length = length

    def shard(self, parts: list[bytes], docs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For every window of the surroundings ``parts``: (part, offset, smallest document holding its string here)."""
        sizes = np.array([len(p) for p in parts])
        data = np.frombuffer(b"\0".join([*parts, b""]), dtype=np.uint8)
        starts = np.cumsum(sizes + 1) - (sizes + 1)
        owner = np.repeat(np.arange(len(parts)), sizes + 1)
        offset = np.arange(len(data)) - starts[owner]
        valid = offset + self.length <= sizes[owner]
        order, _ = suffix_array(data, self.length)
        shared = common_prefixes(data, order, starts, 2 * int(sizes.max()) + 8)
        group = np.cumsum(np.r_[0, shared[1:] < self.length] if len(order) else shared)
        keep = valid[order]  # suffixes with a whole window; equal windows stay neighbours
        order, group = order[keep], group[keep]
        if not len(order):
            return order, order, order
        edges = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        least = np.minimum.reduceat(docs[owner[order]], edges)
        least = np.repeat(least, np.diff(np.r_[edges, len(order)]))
        return owner[order], offset[order], least


def _joined(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and where every part begins."""
    sizes = np.array([len(p) for p in parts], dtype=np.int64)
    return np.frombuffer(b"".join(parts), dtype=np.uint8), np.cumsum(sizes) - sizes


def _least_of_equal(data: np.ndarray, at: np.ndarray, docs: np.ndarray, length: int) -> np.ndarray:
    """For the windows of ``data`` that begin ``at``: the smallest document among equal ones. Windows are dealt by a hash and
    a bounded number is compared at once; the comparison is of the bytes."""
    windows, least, deals = np.lib.stride_tricks.sliding_window_view(data, length), docs.copy(), -(-len(at) // MERGED)
    factors = _root_powers(length)[0][:length]
    hashed = [mix64(windows[at[k : k + MERGED]].astype(np.uint64) @ factors) for k in range(0, len(at), MERGED)]
    deal = np.concatenate(hashed) % np.uint64(deals)
    for k in range(deals):
        rows = np.flatnonzero(deal == np.uint64(k))
        if len(rows):
            # all have one length, so fixed-width strings compare them exactly
            names = np.ascontiguousarray(windows[at[rows]]).view(f"S{length}").ravel()
            by = np.argsort(names, kind="stable")
            new = np.flatnonzero(np.r_[True, names[by[1:]] != names[by[:-1]]])
            least[rows[by]] = np.repeat(np.minimum.reduceat(docs[rows[by]], new), np.diff(np.r_[new, len(by)]))
    return least


def smallest_holders(
    hashes: np.ndarray, docs: np.ndarray, most: np.ndarray, parts: list[bytes], length: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(part, offset, smallest document with that string) for the windows of the surroundings, by part and offset.

    ``hashes`` are the anchors of the parts, in order; ``docs`` and ``most`` the smallest and the largest document of
    each part. Windows that no document of a part could lose are left out.
    """
    finder = _Windows(length)
    cuts, size = [0], 0
    for k, p in enumerate(parts):
        size += len(p) + 1
        if size >= SHARD:
            cuts.append(k + 1)
            size = 0
    if cuts[-1] < len(parts):
        cuts.append(len(parts))
    border = np.array(sorted({int(hashes[c]) for c in cuts[1:-1] if hashes[c - 1] == hashes[c]}), dtype=hashes.dtype)
    shards = []
    for a, b in zip(cuts, cuts[1:], strict=False):
        owner, offset, least = finder.shard(parts[a:b], docs[a:b])
        keep = (least < most[owner + a]) | np.isin(hashes[owner + a], border)
        shards.append([(owner[keep] + a).astype(np.int32), offset[keep].astype(np.int16), least[keep]])
    # an anchor whose surroundings lie in several shards: its windows are compared once more, all together
    data, begin = _joined(parts) if len(border) else (None, None)
    for h in border:
        lo, hi = np.searchsorted(hashes, h, side="left"), np.searchsorted(hashes, h, side="right")
        rows = [np.flatnonzero((s[0] >= lo) & (s[0] < hi)) for s in shards]
        at = np.concatenate([begin[s[0][k]] + s[1][k] for s, k in zip(shards, rows, strict=True)])
        if len(at):
            low = _least_of_equal(data, at, np.concatenate([s[2][k] for s, k in zip(shards, rows, strict=True)]), length)
            for s, k, own in zip(shards, rows, np.split(low, np.cumsum([len(k) for k in rows])[:-1]), strict=True):
                s[2][k] = own
    kinds = (np.int32, np.int16, np.int64)
    owner, offset, least = (np.concatenate([np.zeros(0, kind), *[s[k] for s in shards]]) for k, kind in enumerate(kinds))
    by = np.lexsort((offset, owner))
    return owner[by], offset[by], least[by]


def _bytes(batch: pa.RecordBatch | pa.Table) -> list[bytes]:
    return [t.encode() for t in batch.column("text").to_pylist()]


def _anchor_blobs(bits: int, length: int):
    """Per hash range: each document's distinct anchors, with the print of its text and its home. Many batches make one blob."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, ...]] = []
        docs, size = 0, 0
        for batch in batches:
            texts = _bytes(batch)
            homes = batch.column("d").to_numpy().astype(np.uint32)
            kinds = np.array([int.from_bytes(hashlib.blake2b(t, digest_size=4).digest(), "big") for t in texts], dtype=np.uint32)
            found = [(h >> np.uint64(32 - bits), doc + first) for first, some in _chunks(texts) for h, _, doc in [anchors(some, length)]]
            key, doc = (np.concatenate([f[k] for f in found]) if found else np.zeros(0, dtype=np.int64) for k in (0, 1))
            held.append((key.astype(np.uint64), doc.astype(np.int64) + docs, kinds, homes))
            docs, size = docs + len(texts), size + len(key)
            if size >= BLOB_ANCHORS:
                yield blobs(held)
                held, docs, size = [], 0, 0
        if size:
            yield blobs(held)

    def blobs(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
        key, doc, kinds, homes = (np.concatenate([x[k] for x in held]) for k in range(4))
        by = np.lexsort((key, doc, key >> np.uint64(32)))
        key, doc = key[by], doc[by]
        fresh = np.r_[True, (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])]
        key, doc = key[fresh], doc[fresh]
        limits = np.searchsorted(key >> np.uint64(32), np.arange((1 << bits) + 1, dtype=np.uint64))
        out = []
        for r in range(1 << bits):
            a, b = limits[r], limits[r + 1]
            if a < b:
                who, n = np.unique(doc[a:b], return_counts=True)
                out.append((r, key[a:b].astype(np.uint32).tobytes(), n.astype(np.uint32).tobytes(), kinds[who].tobytes(), homes[who].tobytes()))
        return _batch(out, _BLOBS)

    return run


_BLOBS = (("r", pa.int32()), ("hashes", pa.binary()), ("counts", pa.binary()), ("kinds", pa.binary()), ("homes", pa.binary()))
_SHARED = (("d", pa.int32()), ("keys", pa.binary()), ("hot", pa.binary()))
_AROUND = (("r", pa.int32()), ("d", pa.int32()), ("keys", pa.binary()), ("origins", pa.binary()), ("least", pa.binary()), ("most", pa.binary()), ("sizes", pa.binary()), ("text", pa.binary()))
_STRETCHES = (("d", pa.int32()), ("origins", pa.binary()), ("prints", pa.binary()), ("starts", pa.binary()), ("ends", pa.binary()), ("lows", pa.binary()))
_RESULT = (("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string()))


def _batch(rows: list[tuple], fields: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, (_, kind) in enumerate(fields)], names=[n for n, _ in fields])


def _ddl(fields: tuple) -> str:
    names = {pa.int32(): "int", pa.int64(): "long", pa.binary(): "binary", pa.string(): "string"}
    return ", ".join(f"{n} {names[k]}" for n, k in fields)


def _join(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    return np.frombuffer(b"".join(x for x in column.to_pylist() if x is not None), dtype=kind)


def _shared_anchors(hot: int):
    """Of one hash range: for every home, the anchors of its documents that two different texts have, and which of them more
    than ``hot`` documents have."""

    def run(table: pa.Table) -> pa.Table:
        r = table.column("r")[0].as_py()
        hashes, counts = _join(table.column("hashes"), np.uint32), _join(table.column("counts"), np.uint32)
        kind, home = np.repeat(_join(table.column("kinds"), np.uint32), counts), np.repeat(_join(table.column("homes"), np.uint32), counts)
        by = np.argsort(hashes, kind="stable")
        hashes, kind, home = hashes[by], kind[by], home[by]
        starts = np.flatnonzero(np.r_[True, hashes[1:] != hashes[:-1]])
        both, n = np.minimum.reduceat(kind, starts) != np.maximum.reduceat(kind, starts), np.diff(np.r_[starts, len(hashes)])
        many, keep = hashes[starts[n > hot]], np.repeat(both, n)
        pairs = np.unique((home[keep].astype(np.uint64) << np.uint64(32)) | hashes[keep])
        homes, first = np.unique(pairs >> np.uint64(32), return_index=True)
        lists = np.split(pairs & np.uint64(0xFFFFFFFF), first[1:])
        rows = []
        for d, x in zip(homes, lists, strict=False):  # no anchors: one empty list
            rows.append((int(d), *((y | np.uint64(r << 32)).tobytes() for y in (x, x[np.isin(x, many)]))))
        return pa.Table.from_batches([_batch(rows, _SHARED)])

    return run


def _copies(table: pa.Table) -> set[tuple[int, int]]:
    return {(c["doc_id"], c["print"]) for x in table.column("copies").to_pylist() for c in x or ()}


def _is_copy(copies: set[tuple[int, int]], ids: set[int], doc_id: int | None, text: bytes) -> bool:
    if doc_id not in ids:
        return False
    value = xxhash.xxh64_intdigest(text, seed=42)  # the same as Spark's xxhash64
    return (doc_id, value - (1 << 64) if value >> 63 else value) in copies


def _occurrences(texts: list[bytes], keys: np.ndarray, hot: np.ndarray, bits: int, length: int):
    """(origin, key, piece, document number, start) of what lies around the anchors ``keys``, of a bounded number of texts at
    once.

    An origin is an anchor and, in its three lowest bits, a class. Class 0 is all of its surroundings and has the anchor's
    hash as its key. Those of a ``hot`` anchor are cut by how many bytes of a window lie before the anchor: the windows of a
    class all hold the same longer string, a hash of which is the key, and their piece has no other window.
    """
    extra = length - GRAM
    cuts = [extra * c // CLASSES + (c > 0) for c in range(CLASSES + 1)]
    for first, some in _chunks(texts):
        h, at, doc = anchors(some, length)
        key = h >> np.uint64(32 - bits)
        hit = keys[np.minimum(np.searchsorted(keys, key), len(keys) - 1)] == key
        key, at, doc = key[hit], at[hit], doc[hit]
        ends = np.cumsum([len(t) for t in some])
        begins = np.r_[0, ends[:-1]]
        joined = b"".join(some)
        many = np.isin(key, hot)
        whole = np.flatnonzero(~many)
        lo, hi = np.maximum(at - extra, begins[doc]), np.minimum(at + length, ends[doc])
        pieces = [joined[a:b] for a, b in zip(lo[whole].tolist(), hi[whole].tolist(), strict=True)]
        out = [(key[whole] << np.uint64(3), key[whole], pieces, doc[whole] + first, (lo - begins[doc])[whole])]
        for c in range(CLASSES if many.any() else 0):
            low, high = cuts[c], cuts[c + 1] - 1  # bytes before the anchor
            rows = np.flatnonzero(many & (at - low >= begins[doc]) & (at + length - high <= ends[doc]))
            if low <= high and len(rows):
                named = [xxhash.xxh64_intdigest(joined[x - low : x + length - high], seed=c) for x in at[rows].tolist()]
                lo, hi = np.maximum(at[rows] - high, begins[doc[rows]]), np.minimum(at[rows] + length - low, ends[doc[rows]])
                pieces = [joined[a:b] for a, b in zip(lo.tolist(), hi.tolist(), strict=True)]
                named = np.array(named, dtype=np.uint64) >> np.uint64(32 - bits)
                out.append(((key[rows] << np.uint64(3)) | np.uint64(c + 1), named, pieces, doc[rows] + first, lo - begins[doc[rows]]))
        origin, named, doc, start = (np.concatenate([x[k] for x in out]) for k in (0, 1, 3, 4))
        yield origin, named, [x for o in out for x in o[2]], doc, start


def _surroundings(bits: int, length: int):
    """Of one home: the text around its documents' shared anchors, by hash range. Equal ones stand once, with the smallest and
    the largest document that has them; copies of smaller documents are left out."""

    def run(texts: pa.Table, shared: pa.Table) -> pa.Table:
        keys, hot, batches = np.sort(_join(shared.column("keys"), np.uint64)), _join(shared.column("hot"), np.uint64), []
        held: dict[tuple[int, int, bytes], int] = {}
        spans: list[tuple[np.ndarray, np.ndarray]] = []

        def packed() -> pa.RecordBatch:
            part, docs = (np.concatenate([x[k] for x in spans]) for k in (0, 1))
            least, most = np.full(len(held), np.iinfo(np.int64).max), np.full(len(held), np.iinfo(np.int64).min)
            np.minimum.at(least, part, docs)
            np.maximum.at(most, part, docs)
            origin, key = (np.array([x[k] for x in held], dtype=np.uint64) for k in (0, 1))
            pieces, out = [x[2] for x in held], []
            size = np.array([len(x) for x in pieces], dtype=np.uint16)
            cut = (origin & np.uint64(7)) > 0
            by = np.lexsort((key, cut, key >> np.uint64(32)))
            group = (key[by] >> np.uint64(32)).astype(np.int64) * 2 + cut[by]
            for k in np.split(by, np.flatnonzero(group[1:] != group[:-1]) + 1):
                origins = origin[k].tobytes() if cut[k[0]] else None  # else they follow from the keys
                row = (key[k].astype(np.uint32).tobytes(), origins, least[k].tobytes(), most[k].tobytes(), size[k].tobytes())
                out.append((int(key[k[0]] >> np.uint64(32)), d, *row, b"".join([pieces[i] for i in k])))
            held.clear(), spans.clear()
            return _batch(out, _AROUND)

        if len(keys) and texts.num_rows:
            d, copies, size = texts.column("d")[0].as_py(), _copies(shared), 0
            copied = {i for i, _ in copies}
            rows = [(i, t) for i, t in zip(texts.column("doc_id").to_pylist(), _bytes(texts), strict=True) if i is not None and not _is_copy(copies, copied, i, t)]
            ids = np.array([i for i, _ in rows], dtype=np.int64)
            for origin, key, pieces, doc, _ in _occurrences([t for _, t in rows], keys, hot, bits, length):
                before = len(held)
                named = zip(origin.tolist(), key.tolist(), pieces, strict=True)
                part = np.array([held.setdefault(x, len(held)) for x in named], dtype=np.int64)
                spans.append((part, ids[doc]))
                size += 2 * length * (len(held) - before)
                if size >= HELD:
                    batches.append(packed())
                    size = 0
            if held:
                batches.append(packed())
        return pa.Table.from_batches(batches or [_batch([], _AROUND)])

    return run


def covered_stretches(keys: np.ndarray, least: np.ndarray, most: np.ndarray, texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """(row, start, end, smallest document) of the stretches of ``texts``, which come in order of their anchors, that also
    stand in a document smaller than the largest one that has the row."""
    # equal surroundings of several homes stand once
    names: dict[tuple[int, bytes], int] = {}
    part = np.array([names.setdefault(x, len(names)) for x in zip(keys.tolist(), texts, strict=True)], dtype=np.int64)
    low_of, most_of = np.full(len(names), np.iinfo(np.int64).max), np.full(len(names), np.iinfo(np.int64).min)
    np.minimum.at(low_of, part, least)
    np.maximum.at(most_of, part, most)
    owner, offset, low = smallest_holders(np.array([h for h, _ in names], dtype=np.int64), low_of, most_of, [b for _, b in names], length)
    limits = np.searchsorted(owner, np.arange(len(names) + 1))
    found = [(np.zeros(0, dtype=np.int64),) * 4]
    for a in range(0, len(keys), SLICE // 2):
        p = part[a : a + SLICE // 2]
        n = limits[p + 1] - limits[p]
        row = np.repeat(np.arange(a, a + len(p)), n)
        at = np.arange(int(n.sum())) + np.repeat(limits[p] - (np.cumsum(n) - n), n)
        hit = low[at] < most[row]
        row, at = row[hit], at[hit]
        if len(at):
            first = np.r_[True, (row[1:] != row[:-1]) | (offset[at[1:]] != offset[at[:-1]] + 1) | (low[at[1:]] != low[at[:-1]])]
            edge = np.flatnonzero(first)
            last = np.r_[edge[1:], len(at)] - 1
            found.append((row[edge], offset[at[edge]].astype(np.int64), offset[at[last]].astype(np.int64) + length, low[at[edge]]))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(4))


def _prints(texts: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh64_intdigest(x) for x in texts], dtype=np.uint64)


def _stretches(length: int):
    """Of one hash range: the stretches of surroundings that smaller documents also hold, by home."""

    def run(table: pa.Table) -> pa.Table:
        r, counts = table.column("r")[0].as_py(), [len(x) // 4 for x in table.column("keys").to_pylist()]
        keys, least, most = _join(table.column("keys"), np.uint32), _join(table.column("least"), np.int64), _join(table.column("most"), np.int64)
        whole = np.repeat([x is None for x in table.column("origins").to_pylist()], counts)
        origins = (keys.astype(np.uint64) | np.uint64(r << 32)) << np.uint64(3)
        origins[~whole] = _join(table.column("origins"), np.uint64)
        sizes, home = _join(table.column("sizes"), np.uint16).astype(np.int64), np.repeat(table.column("d").to_numpy(), counts)
        text, ends = b"".join(table.column("text").to_pylist()), np.cumsum(sizes)
        by = np.argsort(keys, kind="stable")
        found, first = [], 0
        # a slice of whole anchors at a time: what a task holds beside its input is bounded by the slice
        while first < len(by):
            last = min(first + SLICE, len(by))
            last = first + int(np.searchsorted(keys[by[first:]], keys[by[last - 1]], side="right"))
            at = by[first:last]
            texts = [text[x:y] for x, y in zip((ends[at] - sizes[at]).tolist(), ends[at].tolist(), strict=True)]
            row, start, end, low = covered_stretches(keys[at], least[at], most[at], texts, length)
            rows, place = np.unique(row, return_inverse=True)
            found.append((home[at[row]], origins[at[row]], _prints([texts[i] for i in rows])[place], start.astype(np.uint16), end.astype(np.uint16), low))
            first = last
        if not any(len(f[0]) for f in found):
            return pa.Table.from_batches([_batch([], _STRETCHES)])
        home, *arrays = (np.concatenate([f[k] for f in found]) for k in range(6))
        order = np.argsort(home, kind="stable")
        homes, first = np.unique(home[order], return_index=True)
        rows = [(int(h), *(x[k].tobytes() for x in arrays)) for h, k in zip(homes, np.split(order, first[1:]), strict=True)]
        return pa.Table.from_batches([_batch(rows, _STRETCHES)])

    return run


def _covered(texts: list[bytes], ids: np.ndarray, found: pa.Table, bits: int, length: int):
    """(text number, starts, ends) of what the answers ``found`` say about the texts, all stretches of one text together."""
    origins, prints, lows = _join(found.column("origins"), np.uint64), _join(found.column("prints"), np.uint64), _join(found.column("lows"), np.int64)
    starts, ends = (_join(found.column(c), np.uint16).astype(np.int64) for c in ("starts", "ends"))
    if not len(origins):
        return
    name = mix64(origins) ^ prints
    by = np.argsort(name, kind="stable")
    name, lows, starts, ends = name[by], lows[by], starts[by], ends[by]
    keys, hot = np.unique(origins >> np.uint64(3)), np.unique(origins[(origins & np.uint64(7)) > 0] >> np.uint64(3))
    for origin, _, pieces, doc, start in _occurrences(texts, keys, hot, bits, length):
        own = mix64(origin) ^ _prints(pieces)
        a = np.searchsorted(name, own, side="left")
        n = np.searchsorted(name, own, side="right") - a
        at = np.arange(int(n.sum())) + np.repeat(a - (np.cumsum(n) - n), n)
        doc, start = np.repeat(doc, n), np.repeat(start, n)
        hit = lows[at] < ids[doc]
        at, doc, start = at[hit], doc[hit], start[hit]
        order = np.argsort(doc, kind="stable")
        some, first = np.unique(doc[order], return_index=True)
        for i, k in zip(some.tolist(), np.split(order, first[1:]), strict=False):
            yield i, start[k] + starts[at[k]], start[k] + ends[at[k]]


def _kept(bits: int, length: int, with_text: bool):
    """Of one home: every document without its covered stretches."""

    def run(texts: pa.Table, found: pa.Table) -> pa.Table:
        copies = _copies(found)
        copied = {i for i, _ in copies}
        ids, bodies, rows = texts.column("doc_id").to_pylist(), _bytes(texts), []
        whole = [i is not None and len(t) >= length and _is_copy(copies, copied, i, t) for i, t in zip(ids, bodies, strict=True)]
        alive = [k for k, (i, t) in enumerate(zip(ids, bodies, strict=True)) if i is not None and len(t) >= length and not whole[k]]
        left: dict[int, tuple[bytes, int, int]] = {}
        for k, starts, ends in _covered([bodies[k] for k in alive], np.array([ids[k] for k in alive], dtype=np.int64), found, bits, length):
            t = bodies[alive[k]]
            steps = np.zeros(len(t) + 1, dtype=np.int32)
            np.add.at(steps, starts, 1)
            np.add.at(steps, ends, -1)
            gone = np.cumsum(steps[: len(t)]) > 0
            left[alive[k]] = np.frombuffer(t, dtype=np.uint8)[~gone].tobytes(), int(gone[0]) + int((gone[1:] & ~gone[:-1]).sum()), int(gone.sum())
        for k, (i, t) in enumerate(zip(ids, bodies, strict=True)):
            kept, spans, removed = (b"", 1, len(t)) if whole[k] else left.get(k, (t, 0, 0))
            rows.append((i, len(t), removed, spans, hashlib.sha256(kept).hexdigest(), *([kept] if with_text else [])))
        return pa.Table.from_batches([_batch(rows, _RESULT + ((("kept", pa.binary()),) if with_text else ()))])

    return run


def remove_repeats(docs: DataFrame, *, length: int = LENGTH, with_text: bool = False, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the remaining bytes) of every row.

    A byte goes when a string of ``length`` bytes (at most 200) covers it that also starts in a row with a smaller
    doc_id. Strings lie within one text, overlaps count, and all is judged on the input. Null text is the empty text; a
    row with a null doc_id is neither changed nor looked at for others; rows that share a doc_id do not change each other.
    The surroundings of an anchor that more than ``hot`` documents have are cut and dealt out by more than the anchor.
    """
    if not GRAM < length <= 200:
        raise ValueError(f"length must be in {GRAM + 1} to 200")
    spark = docs.sparkSession
    # four to eight ranges and homes a partition: a worker holds one at a time, several times over
    bits = max(1, (int(spark.conf.get("spark.sql.shuffle.partitions")) - 1).bit_length() + 2)
    home = F.pmod(F.xxhash64(F.lit(29), F.col("doc_id")), F.lit(1 << bits)).cast("int")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")).withColumn("d", home)
    texts = rows.groupBy("d")

    prints = rows.where("doc_id is not null").select("d", "doc_id", F.xxhash64("text").alias("print"), F.sha2("text", 256).alias("sha"))
    least = prints.groupBy("sha").agg(F.min("doc_id").alias("least"))
    copies = prints.join(least, "sha").where("doc_id > least").groupBy("d").agg(F.collect_list(F.struct("doc_id", "print")).alias("copies"))
    copies = store(copies, "repeat-copies")

    blobs = rows.where(f"doc_id is not null and octet_length(text) >= {length}").select("d", "text").mapInArrow(_anchor_blobs(bits, length), _ddl(_BLOBS))
    shared = blobs.groupBy("r").applyInArrow(_shared_anchors(hot), _ddl(_SHARED))
    none, no_copies = F.lit(None).cast("binary"), F.lit(None).cast(copies.schema["copies"].dataType)

    def with_copies(df: DataFrame) -> DataFrame:
        own = copies.select("d", *[none.alias(c) for c in df.columns if c != "d"], "copies")
        return df.withColumn("copies", no_copies).unionByName(own)

    around = texts.cogroup(with_copies(shared).groupBy("d")).applyInArrow(_surroundings(bits, length), _ddl(_AROUND))
    stretches = around.groupBy("r").applyInArrow(_stretches(length), _ddl(_STRETCHES))
    return texts.cogroup(with_copies(stretches).groupBy("d")).applyInArrow(_kept(bits, length, with_text), _ddl(_RESULT) + ", kept binary" * with_text)
