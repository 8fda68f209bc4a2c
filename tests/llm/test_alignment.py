"""Token groups, links and their counts against a plain version with the libraries' own tokens."""

from __future__ import annotations

import collections
import hashlib
import random

import numpy as np
import pytest

from mercato.llm import alignment
from mercato.session import configure


@pytest.fixture(autouse=True)
def _configured(spark):
    configure(spark)


def byte_of_char() -> dict[str, int]:
    """The printable stand-ins of byte-level vocabularies."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {**{chr(b): b for b in plain}, **{chr(256 + n): b for n, b in enumerate(rest)}}


@pytest.fixture(scope="module")
def tokenizers():
    import public_tokenizers
    import sentencepiece
    from tokenizers import Tokenizer

    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    back = byte_of_char()
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def of_a(text):
        ids = a.encode(" " + text, add_special_tokens=False).ids
        return [(i, bytes(back[c] for c in a.id_to_token(i))) for i in ids]

    def of_b(text):
        return [(i, alignment.piece_bytes(b.id_to_piece(i))) for i in b.encode(text)]

    return of_a, of_b


def plain(texts, of_a, of_b):
    """(n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) of every text."""
    groups_of = []
    for text in texts:
        groups, x, y = [], (of_a(text) if text else []), (of_b(text) if text else [])
        whole = b" " + (text or "").encode()
        if b"".join(t for _, t in x) == whole == b"".join(t for _, t in y):
            i = j = at_a = at_b = 0
            open_a, open_b = [], []
            while i < len(x) or j < len(y):
                if at_a <= at_b and i < len(x):
                    open_a.append(x[i][0])
                    at_a, i = at_a + len(x[i][1]), i + 1
                else:
                    open_b.append(y[j][0])
                    at_b, j = at_b + len(y[j][1]), j + 1
                if at_a == at_b:
                    groups.append((open_a, open_b))
                    open_a, open_b = [], []
        groups_of.append(groups)
    links = [collections.Counter((a, b) for x, y in groups for a in x for b in y) for groups in groups_of]
    counts = collections.Counter(pair for found in links for pair in found)
    highest = collections.Counter()
    for (a, _), n in counts.items():
        highest[a] = max(highest[a], n)
    out = []
    for groups, found in zip(groups_of, links, strict=True):
        spelled = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups)
        best = sum(n for (a, b), n in found.items() if counts[a, b] == highest[a])
        total = sum(n * counts[pair] for pair, n in found.items())
        digest = hashlib.sha256(spelled.encode()).hexdigest() if groups else ""
        out.append((sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(found.values()), best, total, digest))
    return out


COLUMNS = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")


def odd_texts():
    rng = random.Random(5)
    texts = [" ".join(rng.choice(("the", "Straße", "naïve", "x9", "of", "漢字", "don't", "—", "ünder", "2024")) for _ in range(rng.randint(1, 60))) for _ in range(60)]
    texts += [None, "", " ", "  two  spaces ", "\n\n\t", "a▁b", "<|endoftext|> and <s> </s> <unk> <0x41>", "\x00 nul", "z" * 5000, "漢" * 700, "👩‍👩‍👧‍👦 🏳️‍🌈", "é ​ ﻿", "é" * 300 + "\r\n"]
    texts += [texts[3]] * 20 + ["".join(chr(rng.choice((rng.randrange(32, 127), rng.randrange(0xA0, 0x2FF), rng.randrange(0x4E00, 0x9FFF)))) for _ in range(80)) for _ in range(40)]
    return texts


@pytest.mark.parametrize("small", [False, True])
def test_alignment_agrees_with_the_plain_version(spark, tokenizers, monkeypatch, small):
    if small:  # many chunks
        for name, size in (("CHUNK_CHARS", 300), ("ALIGN_CHARS", 100)):
            monkeypatch.setattr(alignment, name, size)
    texts = odd_texts()
    docs = spark.createDataFrame([(k // 2 if k % 7 else None, t, 1, 2, "p") for k, t in enumerate(texts)], "doc_id long, text string, chunk int, at int, pairs string")
    found = alignment.aligned(docs.repartition(4)).collect()
    key = lambda row: tuple(str(x) for x in row)
    want = [(k // 2 if k % 7 else None, *x) for k, x in enumerate(plain(texts, *tokenizers))]
    assert sorted((tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in found), key=key) == sorted(want, key=key)


def test_links_in_slices_are_the_same(monkeypatch):
    both = alignment.sides(*alignment.default_vocabularies())
    plainly = alignment.align(odd_texts(), *both)
    monkeypatch.setattr(alignment, "LINKS", 7)
    for one, other in zip(alignment.align(odd_texts(), *both), plainly, strict=True):
        assert one[:5] == other[:5] and all(np.array_equal(x, y) for x, y in zip(one[5:], other[5:], strict=True))


def test_alignment_of_documents(spark, sf, tokenizers):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    want = {i: x for (i, _), x in zip(rows, plain([t for _, t in rows], *tokenizers), strict=True)}
    assert {r["doc_id"]: tuple(r[c] for c in COLUMNS) for r in alignment.aligned(docs).collect()} == want


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id string, text string")
    assert alignment.aligned(empty).collect() == []
    blank = spark.createDataFrame([("x", None), ("y", "")], "doc_id string, text string")
    assert sorted(tuple(r[c] for c in ("doc_id", *COLUMNS)) for r in alignment.aligned(blank).collect()) == [("x", *[0] * 6, ""), ("y", *[0] * 6, "")]


def test_overlaps_are_all_pairs_of_tokens_that_meet():
    rng = random.Random(1)
    for _ in range(50):
        total = rng.randint(1, 40)
        cuts = [sorted({*rng.sample(range(1, total), rng.randint(0, total - 1)), total}) if total > 1 else [1] for _ in range(2)]
        ends = tuple(np.array(c) for c in cuts)
        lengths = tuple(np.diff(c, prepend=0) for c in ends)
        doc = tuple(np.zeros(len(c), dtype=np.int64) for c in cuts)
        left, right = alignment.overlaps(doc, ends, lengths)
        want = [
            (i, j)
            for i, (e, n) in enumerate(zip(ends[0], lengths[0], strict=True))
            for j, (f, m) in enumerate(zip(ends[1], lengths[1], strict=True))
            if e - n < f and f - m < e
        ]
        assert sorted(zip(left.tolist(), right.tolist(), strict=True)) == want


def test_words_are_encoded_once_and_texts_keep_their_tokens(monkeypatch):
    a, b = alignment.sides(*alignment.default_vocabularies())
    seen = []

    def counting(side):
        encode = lambda text: seen.append(len(text)) or side.encode(text)
        return alignment.Side(encode, side.tokens, side.by_word)

    assert a.by_word and b.by_word
    once = ["the same words again " * 500, "again the same " * 500]
    found = alignment.align(once, counting(a), counting(b))
    assert sum(seen) < len(once[0]) / 10
    texts = once + odd_texts() + ["a  b \n c", " x y ", "don 't", "a \u2581 b", "tab\t x", "\u00a0 y", "x \x1c y", "1 \u0301 2"]
    spoiled = texts + ["good words and one \u2581 bad"]
    plain = [alignment.Side(side.encode, side.tokens) for side in (a, b)]  # every text as a whole
    monkeypatch.setattr(alignment, "KNOWN_WORDS", 3)
    for one, other in zip(alignment.align(spoiled, a, b), alignment.align(spoiled, *plain), strict=True):
        assert one[:5] == other[:5] and one[5].tolist() == other[5].tolist() and one[6].tolist() == other[6].tolist()
    assert found[0][:5] == alignment.align(once, *plain)[0][:5]
