"""Alignment of two tokenizers over the same bytes, and how often their ids meet across the corpus.

Both sides tile the same bytes, so a pandas ``merge_asof`` finds for every token start the other side's token that covers
it; both directions together are all overlaps, and overlaps with equal ends close a group. Tokens of a group are linked.

Documents are aligned in chunks of bounded size. A chunk's documents refer to the chunk's own list of linked id pairs, so
only these lists, a fraction of all links, are counted across the corpus, and each chunk gets its counts back.

No token of either side spans a single space between two words, so a word's tokens are found once per task and not each
time it stands in a text.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import store, text_of
from mercato.llm.packing import SPLIT

CHUNK_CHARS = 4 << 20  # text of the documents that share a list of pairs, and the last one's
ALIGN_CHARS = 1 << 19  # text aligned at once, likewise
LINKS = 1 << 20  # links of groups made at once, if no single pair of id and group has more
B_BITS = 20  # room for the other side's ids in a pair's number
CUT = re.compile(r"(?<=\S) (?=\S)")  # where texts fall into words
WORDS = 512  # new words encoded at once
KNOWN_WORDS, KNOWN_TOKENS = 1 << 18, 1 << 21  # beyond either, all words are forgotten before the next texts


def default_vocabularies() -> tuple[str, str]:
    """The ranks of byte_bpe_50k (the library that reads them has the same ids) and the piece model."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.path("piece_bpe_32k.model")


def piece_bytes(piece: str) -> bytes:
    """<0xHH> is that byte, U+2581 a space, everything else itself in UTF-8."""
    if len(piece) == 6 and piece.startswith("<0x") and piece.endswith(">"):
        return bytes([int(piece[3:5], 16)])
    return piece.replace("▁", " ").encode()


class Side:
    """One tokenizer: encodes whole texts and knows the bytes of its ids; ``by_word``: a text's ids are those of its words."""

    def __init__(self, encode, tokens: list[bytes], by_word: bool = False):
        self.encode = encode
        self.tokens = tokens
        self.by_word = by_word
        self.lengths = np.array([len(t) for t in tokens], dtype=np.int64)

    def joined(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids.tolist()))


def _merges_within_words(model) -> bool:
    """Whether a piece model merges pairs, changes no character and has no piece with a space after something else."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto.FromString(model.serialized_model_proto())
    trained, norm = proto.trainer_spec, proto.normalizer_spec
    plain = norm.add_dummy_prefix and not (norm.precompiled_charsmap or norm.remove_extra_whitespaces)
    plain = plain and norm.escape_whitespaces and not trained.treat_whitespace_as_suffix
    inside = any("▁" in p.piece.lstrip("▁") or p.type == p.USER_DEFINED for p in proto.pieces)
    return trained.model_type == trained.BPE and plain and not inside


@functools.lru_cache(maxsize=2)
def sides(path_a: str, path_b: str) -> tuple[Side, Side]:
    """A reads a space and the text, B the text, to which it adds the space; strings of special tokens are plain text."""
    import sentencepiece
    import tiktoken

    with open(path_a, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    encoding = tiktoken.Encoding("ranks", pat_str=SPLIT, mergeable_ranks=ranks, special_tokens={})
    tokens = [b""] * (max(ranks.values()) + 1)
    for data, rank in ranks.items():
        tokens[rank] = data
    model = sentencepiece.SentencePieceProcessor(model_file=path_b)
    pieces = [piece_bytes(model.id_to_piece(i)) for i in range(model.get_piece_size())]
    if len(pieces) > 1 << B_BITS:
        raise ValueError(f"{len(pieces)} ids do not fit into {B_BITS} bits")
    return (
        Side(lambda text: encoding.encode_to_numpy(" " + text, disallowed_special=()).astype(np.int64), tokens, True),
        Side(lambda text: np.array(model.encode(text, num_threads=1), dtype=np.int64), pieces, _merges_within_words(model)),
    )


class Words:
    """The tokens of words that were met lately: ids of both sides, and for every word's number where they begin and how many.

    New words are encoded many at a time, as one text. A word that its tokens do not give back has the number -1.
    """

    def __init__(self, a: Side, b: Side):
        self.sides, self.by_word = (a, b), a.by_word and b.by_word
        self.forget()

    def forget(self) -> None:
        none = np.zeros(0, dtype=np.int64)
        self.number: dict[str, int] = {}
        self.ids, self.begin, self.size = [none, none], [none, none], [none, none]

    def _encoded(self, words: list[str]) -> list[tuple[np.ndarray, np.ndarray]] | None:
        """On both sides the ids of all words and how many each has; None if the words are not given back."""
        own = [word.encode("utf-8", "surrogatepass") for word in words]
        whole, stops, out = b" " + b" ".join(own), np.cumsum([len(w) + 1 for w in own]), []
        for side in self.sides:
            ids = side.encode(" ".join(words))
            if side.joined(ids) != whole:
                return None
            one = len(words) == 1
            out.append((ids, np.array([len(ids)]) if one else np.diff(np.searchsorted(np.cumsum(side.lengths[ids]), stops) + 1, prepend=0)))
        return out

    def add(self, words: list[str], at_once: int) -> list[int]:
        """Numbers for words, or one by one for whole texts."""
        numbers, found, count = [], [], len(self.size[0])
        left = [words[at : at + at_once] for at in range(0, len(words), at_once)][::-1]
        while left:
            some = left.pop()
            tokens = self._encoded(some)
            if tokens:
                numbers += range(count, count + len(some))
                found.append(tokens)
                count += len(some)
            elif len(some) == 1:
                numbers.append(-1)
            else:
                left += [some[len(some) // 2 :], some[: len(some) // 2]]
        for side in range(2):
            self.ids[side] = np.concatenate([self.ids[side], *[f[side][0] for f in found]])
            self.size[side] = np.concatenate([self.size[side], *[f[side][1] for f in found]])
            self.begin[side] = np.cumsum(self.size[side]) - self.size[side]
        return numbers

    def numbers(self, texts: list[str]) -> list[np.ndarray]:
        """Of every text's words in order; none if its tokens do not give it back."""
        # pieces spell a space as this mark, so a text that holds it is not given back by its words either
        cut = [CUT.split(text) if self.by_word and "▁" not in text else [] for text in texts]
        new = list(dict.fromkeys(w for words in cut for w in words if w not in self.number))
        # with white space at an end, which only a text's first and last word have, a word would not keep to itself
        edged = [w for w in new if w[0].isspace() or w[-1].isspace()]
        plain = [w for w in new if not (w[0].isspace() or w[-1].isspace())]
        self.number.update(zip(plain + edged, self.add(plain, WORDS) + self.add(edged, 1), strict=True))
        found = [np.fromiter(map(self.number.__getitem__, words), np.int64, len(words)) for words in cut]
        # what is wrong with a word may be right in the whole text
        whole = [i for i, own in enumerate(found) if not len(own) or len(own) > 1 and (own < 0).any()]
        for i, number in zip(whole, self.add([texts[i] for i in whole], 1), strict=True):
            found[i] = np.array([number])
        return [own[own >= 0] for own in found]


@functools.lru_cache(maxsize=2)
def _words(a: Side, b: Side) -> Words:
    return Words(a, b)


def tokenized(texts: list[str], a: Side, b: Side) -> tuple[list[int], list[np.ndarray], list[np.ndarray]]:
    """Which texts have tokens; how many, and all ids, on both sides."""
    words = _words(a, b)
    if len(words.size[0]) > KNOWN_WORDS or len(words.ids[0]) > KNOWN_TOKENS:
        words.forget()
    given = [i for i, text in enumerate(texts) if text]
    found = [(i, x) for i, x in zip(given, words.numbers([texts[i] for i in given]), strict=True) if len(x)]
    if not found:
        return [], [], []
    place, first = np.concatenate([x for _, x in found]), np.cumsum([0, *[len(x) for _, x in found[:-1]]])
    counts, ids = [], []
    for side in range(2):
        n = words.size[side][place]
        shift = np.repeat(words.begin[side][place] - (np.cumsum(n) - n), n)
        ids.append(words.ids[side][np.arange(len(shift)) + shift])
        counts.append(np.add.reduceat(n, first))
    return [i for i, _ in found], counts, ids


def overlaps(doc: tuple[np.ndarray, np.ndarray], ends: tuple[np.ndarray, np.ndarray], lengths: tuple[np.ndarray, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """All (A token, B token) whose bytes meet, once each; places are on one axis over all documents, in order."""
    frames = [
        pd.DataFrame({"doc": d, "at": e - n, "token": np.arange(len(d))}) for d, e, n in zip(doc, ends, lengths, strict=True)
    ]
    a, b = frames
    of_a = pd.merge_asof(a, b, on="at", by="doc", suffixes=("_a", "_b"))
    of_b = pd.merge_asof(b, a, on="at", by="doc", suffixes=("_b", "_a"))
    # a pair met both ways begins at one byte: it is kept from A's direction
    fresh = ends[0][of_b["token_a"].to_numpy()] - lengths[0][of_b["token_a"].to_numpy()] < of_b["at"].to_numpy()
    left = np.concatenate([of_a["token_a"].to_numpy(), of_b["token_a"].to_numpy()[fresh]])
    right = np.concatenate([of_a["token_b"].to_numpy(), of_b["token_b"].to_numpy()[fresh]])
    return left, right


def _runs(key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a key in order and how often each stands in it."""
    ordered = np.sort(key)
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[first], np.diff(np.append(first, len(ordered)))


def _summed(key: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of a key in order with the weights of each added up."""
    order = np.argsort(key, kind="stable")
    ordered = key[order]
    first = np.flatnonzero(np.concatenate([[True], ordered[1:] != ordered[:-1]])) if len(ordered) else np.zeros(0, dtype=np.int64)
    return ordered[first], np.add.reduceat(weight[order], first) if len(first) else weight[:0]


def _linked(doc: np.ndarray, group: tuple[np.ndarray, np.ndarray], ids: tuple[np.ndarray, np.ndarray], groups: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, pair, links): distinct id pairs of every document and how many links each has there.

    ``doc`` is the document of every group. Equal ids of a group are one with a count, so that a group of very many
    tokens, such as a long run of one character, costs its distinct ids; groups go through in slices of bounded links.
    """
    top = int(max(x.max(initial=0) for x in ids)) + 1
    kept = []
    for g, i in zip(group, ids, strict=True):
        key, n = _runs(g * top + i)
        kept.append((key // top, key % top, n))
    (ga, ia, na), (gb, ib, nb) = kept
    many = np.bincount(gb, minlength=groups)  # distinct B ids of every group
    begin = np.cumsum(many) - many
    out = []
    size = np.cumsum(many[ga])
    at = 0
    while at < len(ga):
        stop = max(at + 1, int(np.searchsorted(size, (size[at - 1] if at else 0) + LINKS, side="right")))
        per = many[ga[at:stop]]
        left = np.repeat(np.arange(at, stop), per)
        right = np.arange(len(left)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(begin[ga[at:stop]], per)
        key = (doc[ga[left]] << 40) | (ia[left] << B_BITS) | ib[right]
        out.append(_summed(key, na[left] * nb[right]))
        at = stop
    key, n = _summed(np.concatenate([k for k, _ in out]), np.concatenate([n for _, n in out])) if out else (ga, na)
    return key >> 40, key & ((1 << 40) - 1), n


@functools.lru_cache(maxsize=2)
def _spelled(n_a: int, n_b: int) -> np.ndarray:
    """Ids in decimal with what follows them: inside and at the end of a group's A ids, then of its B ids."""
    out = [f"{i},".encode() for i in range(n_a)] + [f"{i}|".encode() for i in range(n_a)]
    out += [f"{i},".encode() for i in range(n_b)] + [f"{i};".encode() for i in range(n_b)]
    return np.array(out, dtype=object)


EMPTY = (0, 0, 0, 0, "", np.zeros(0, np.int64), np.zeros(0, np.int64))


def align(texts: list[str], a: Side, b: Side) -> list[tuple]:
    """(n_a, n_b, n_groups, n_links, groups_sha256, pairs, links) of every text.

    ``pairs`` are numbers A id << B_BITS | B id, distinct and in order, ``links`` how often each is linked. Texts that are
    empty, or whose tokens of either side do not give back a space and the text, have no tokens.
    """
    out: list[tuple] = [EMPTY] * len(texts)
    rows, counts, ids = tokenized(texts, a, b)
    if not rows:
        return out
    doc = tuple(np.repeat(np.arange(len(rows)), n) for n in counts)
    lengths = a.lengths[ids[0]], b.lengths[ids[1]]
    ends = np.cumsum(lengths[0]), np.cumsum(lengths[1])
    left, right = overlaps(doc, ends, lengths)
    closing = ends[0][left] == ends[1][right]
    cuts = np.sort(left[closing]), np.sort(right[closing])  # the last tokens of every group
    n_groups = len(cuts[0])
    last = tuple(np.zeros(len(i), dtype=np.int64) for i in ids)
    for x, c in zip(last, cuts, strict=True):
        x[c] = 1
    group = tuple(np.cumsum(x) - x for x in last)
    tokens = tuple(np.bincount(g, minlength=n_groups) for g in group)
    doc_of = doc[0][cuts[0]]
    per_doc = np.bincount(doc_of, minlength=len(rows))
    n_links = np.bincount(doc_of, tokens[0] * tokens[1], len(rows)).astype(np.int64)
    owner, pair, n = _linked(doc_of, group, ids, n_groups)
    pair_cuts = np.searchsorted(owner, np.arange(len(rows) + 1))
    # A ids of a group, then its B ids; the last of each is spelled with its own mark
    n_a, n_b = len(a.tokens), len(b.tokens)
    code = np.empty(len(ids[0]) + len(ids[1]), dtype=np.int64)
    upto = tuple(np.cumsum(t) for t in tokens)
    code[np.arange(len(ids[0])) + (upto[1] - tokens[1])[group[0]]] = ids[0] + last[0] * n_a
    code[np.arange(len(ids[1])) + upto[0][group[1]]] = 2 * n_a + ids[1] + last[1] * n_b
    words = _spelled(n_a, n_b)
    stops = np.cumsum(counts[0] + counts[1])
    for k, i in enumerate(rows):
        text = b"".join(words[code[stops[k] - counts[0][k] - counts[1][k] : stops[k]]])[:-1]
        p, q = pair_cuts[k], pair_cuts[k + 1]
        out[i] = (int(counts[0][k]), int(counts[1][k]), int(per_doc[k]), int(n_links[k]), hashlib.sha256(text).hexdigest(), pair[p:q], n[p:q])
    return out


_COUNTS = ("n_a", "n_b", "n_groups", "n_links")


def _chunks(path_a: str, path_b: str):
    """Rows of documents (``at``: places in their chunk's list, ``links``) and, after them, their chunk's row (``pairs``, ``docs``)."""
    names = ["chunk", "doc_id", *_COUNTS, "groups_sha256", "at", "links", "pairs", "docs"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = sides(path_a, path_b)
        number = TaskContext.get().partitionId() << 32
        held, ids, size = [], [], 0

        def flush() -> pa.RecordBatch:
            every = np.concatenate([h[5] for h in held])
            pairs, docs = _runs(every)
            at = np.searchsorted(pairs, every).astype(np.int32)
            edges = np.cumsum([0, *[len(h[5]) for h in held]]).astype(np.int32)
            n = len(held)
            lists = lambda values, offsets, t: pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, t))
            none = [None]
            columns = [pa.array([number] * (n + 1), pa.int64()), pa.concat_arrays([pa.concat_arrays(ids), pa.nulls(1, ids[0].type)])]
            columns += [pa.array([h[i] for h in held] + none, pa.int64()) for i in range(4)]
            columns.append(pa.array([h[4] for h in held] + none, pa.string()))
            for values, t in ((at, pa.int32()), (np.concatenate([h[6] for h in held]), pa.int64())):
                columns.append(pa.concat_arrays([lists(values, edges, t), pa.nulls(1, pa.list_(t))]))
            for values in (pairs, docs):
                columns.append(pa.concat_arrays([pa.nulls(n, pa.list_(pa.int64())), lists(values, [0, len(values)], pa.int64())]))
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            texts = batch.column("text").to_pylist()
            start, taken = 0, 0
            for i, text in enumerate(texts):
                taken += len(text)
                if taken >= ALIGN_CHARS or i + 1 == len(texts):
                    held += align(texts[start : i + 1], a, b)
                    ids.append(batch.column("doc_id").slice(start, i + 1 - start))
                    size += taken
                    start, taken = i + 1, 0
                    if size >= CHUNK_CHARS:
                        yield flush()
                        number, held, ids, size = number + 1, [], [], 0
        if held:
            yield flush()

    return run


def aligned(docs: DataFrame, *, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256 of every row of ``docs``.

    An id pair's count is the number of rows, repeated ones included, that hold it linked. n_best counts the links whose
    count is the highest of their A id, ties included, count_sum adds up the counts of all links. Null and empty texts,
    and those that either tokenizer does not give back, have no tokens: zeros, and '' in place of the hash. Rows without
    doc_id are rows like others; other columns are not looked at; an empty table gives no rows.
    """
    path_a, path_b = vocabularies or default_vocabularies()
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", text_of().alias("text"))
    digests = f"doc_id {kind}, n_a long, n_b long, n_groups long, n_links long"
    schema = f"chunk long, {digests}, groups_sha256 string, at array<int>, links array<long>, pairs array<long>, docs array<long>"
    found = store(rows.mapInArrow(lambda it: _chunks(path_a, path_b)(it), schema), "alignment")
    lists = found.where("pairs is not null").select("chunk", F.posexplode(F.arrays_zip("pairs", "docs")).alias("at", "p"))
    entries = lists.select("chunk", "at", F.col("p.pairs").alias("pair"), F.col("p.docs").alias("docs"))
    counts = entries.groupBy("pair").agg(F.sum("docs").alias("count")).withColumn("a", F.shiftright("pair", B_BITS))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    known = counts.join(highest, "a").select("pair", "count", (F.col("count") == F.col("highest")).alias("best"))
    told = entries.join(known, "pair").select(F.col("chunk").alias("of"), "at", "count", "best")
    documents = found.where("pairs is null").select("chunk", "doc_id", *_COUNTS, "groups_sha256", "at", "links")
    out = f"{digests}, n_best long, count_sum long, groups_sha256 string"
    return documents.groupBy("chunk").cogroup(told.groupBy("of")).applyInArrow(_scored, out)


def _scored(documents: pa.Table, told: pa.Table) -> pa.Table:
    """One chunk's documents with the sums over their links; ``told`` has the corpus-wide count of each of its pairs."""
    at = told.column("at").to_numpy()
    count, best = np.zeros(len(at), dtype=np.int64), np.zeros(len(at), dtype=np.int64)
    count[at] = told.column("count").to_numpy()
    best[at] = told.column("best").to_numpy()
    places, links = documents.column("at").combine_chunks(), documents.column("links").combine_chunks()
    here, n = places.flatten().to_numpy(), links.flatten().to_numpy()
    edges = np.cumsum([0, *places.value_lengths().to_pylist()])
    upto = [np.concatenate([[0], np.cumsum(x[here] * n)])[edges] for x in (best, count)]
    sums = [pa.array(np.diff(x), pa.int64()) for x in upto]
    columns = {c: documents.column(c) for c in ("doc_id", *_COUNTS)}
    return pa.table({**columns, "n_best": sums[0], "count_sum": sums[1], "groups_sha256": documents.column("groups_sha256")})
