"""Every operator against a plain version, over tables with nulls, empty and long texts, ties, copies and clashing names."""

from __future__ import annotations

import base64
import collections
import gzip
import hashlib
import math
import os
import random
import subprocess
import sys
import zlib
from fractions import Fraction
from pathlib import Path

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent))
import brute  # noqa: E402

from mercato.llm import fingerprints, langid, mixing, neardup, packing, pii, sharding, suffixes, topk, warc  # noqa: E402
from mercato.session import configure, scratch_path  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, uid long, part int, row string, letters int, n long, size long, key string, d int, node int"


@pytest.fixture(autouse=True)
def _configured(spark):
    configure(spark)


def words(rng: random.Random, n: int, pool: int = 4000) -> list[str]:
    return [f"w{rng.randrange(pool)}" for _ in range(n)]


def texts() -> list[tuple[int | None, str | None]]:
    """Clean texts, exact and near copies, shared passages, short, empty, null and very long ones, and repeated rows."""
    rng = random.Random(3)
    rows: list[tuple[int | None, str | None]] = [(i, " ".join(words(rng, rng.randint(1, 150)))) for i in range(60)]
    base = words(rng, 120)
    passage = " ".join(words(rng, 70))
    for i in range(60, 100):
        near = list(base)
        for _ in range(rng.randint(0, 4)):
            near[rng.randrange(len(near))] = f"x{rng.randrange(999)}"
        rows.append((i, " ".join(near)))
    rows += [(i, " ".join([*words(rng, 20), passage, *words(rng, 20)])) for i in range(100, 120)]
    rows += [(i, rows[5][1]) for i in range(120, 150)]
    rows += [(150, None), (151, ""), (152, " \n\t "), (153, "one"), (154, "ONE"), (155, "a b c"), (156, "é"), (157, "12 34 !!"), (158, None)]
    rows += [(159, " ".join(words(rng, 20_000))), (160, "z" * 30_000), (160, "z" * 30_000), (161, "ab " * 9000)]
    rows += [(162, "tab\tsep\x0bvertical\x0cfeed\xa0nbsp"), (None, "no id at all but some words in it"), (None, rows[5][1])]
    return rows


@pytest.fixture(scope="module")
def rows():
    return texts()


def table(spark, rows):
    langs, sources = ("en", "de", None), ("a", "b", "é", None, "c")
    full = [(i, t, langs[k % 3], sources[0 if k % 3 else k % 5], None, 7, 1, "r", 2, 3, 4, "k", 5, 6) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(full, SCHEMA).repartition(5)


@pytest.fixture(scope="module")
def docs(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("docs") / "documents.parquet")
    table(spark, rows).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def empty(spark, docs):
    return docs.where("false")


# ---- sharding


def test_shards_hold_equal_bytes(docs, rows):
    out = sharding.kd_shards(docs, shards=4).collect()
    assert sorted((r["id"] is None, r["id"] or 0, r["size"]) for r in out) == sorted((i is None, i or 0, len((t or "").encode()) + 1) for i, t in rows)
    sizes = collections.Counter()
    for r in out:
        sizes[r["shard"]] += r["size"]
    largest = max(r["size"] for r in out)
    assert set(sizes) == {0, 1, 2, 3} and max(sizes.values()) - min(sizes.values()) <= 2 * largest
    for s in sizes:
        assert sorted(r["slot"] for r in out if r["shard"] == s) == list(range(sum(r["shard"] == s for r in out)))
    assert all(r["crc"] in {zlib.crc32((t or "").encode()) for i, t in rows if i == r["id"]} for r in out)


def test_shards_split_a_hot_value_and_follow_the_target(spark):
    same = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("x" * 9).alias("text"), F.lit("one").alias("source"))
    out = sharding.kd_shards(same, target_bytes=8000, dimensions=("source",)).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert len(out) == 5 and all(abs(r["n"] - 8000) < 200 for r in out)


def test_shards_of_nothing(empty):
    assert sharding.kd_shards(empty, shards=16).count() == 0


def test_more_shards_than_rows(spark):
    out = sharding.kd_shards(spark.createDataFrame([(1, "a", "s")], "doc_id long, text string, source string"), shards=16, dimensions=("source", "doc_id"))
    assert out.count() == 1


# ---- mixing


def test_mix_meets_its_targets(docs, rows):
    out = mixing.mix(docs, block_words=8).collect()
    again = mixing.mix(docs.repartition(3), block_words=8).collect()
    key = lambda r: (r["doc_id"] is None, r["doc_id"] or 0, r["size"], r["source_size"], r["taken"])
    assert len(out) == len(rows) and sorted(map(key, out)) == sorted(map(key, again))
    count = lambda t: len(__import__("re").findall(r"[^\x20\x09-\x0D]+", t or ""))
    assert sorted(r["size"] for r in out) == sorted(count(t) for _, t in rows)
    sizes = collections.Counter()
    for r in docs.select("source", "text").collect():
        sizes[r["source"]] += count(r["text"])
    wanted = brute.water_filled(dict(sizes))
    by_target = collections.Counter()
    for r in out:
        by_target[round(r["target"], 6), r["source_size"]] += r["taken"]
        assert 0 <= r["taken"] <= 2 * r["size"]
    for source, target in wanted.items():
        assert abs(by_target[round(target, 6), sizes[source]] - target) <= 1


def test_mix_is_its_schedule(docs):
    """The words slots take are the first target words of every source's stream, counted over its repeats."""
    sizes = mixing.sized(docs)
    plan = mixing.store(mixing.targets(sizes), "t")
    got = {r["uid"]: r["n"] for r in mixing.mixed_pieces(sizes, plan, block_words=16).groupBy("uid").agg(F.sum("words").alias("n")).collect()}
    words_of = {r["sid"]: (int(r["target"] + 0.5), r["source_size"]) for r in plan.collect()}
    for r in mixing._streams(sizes, plan).collect():
        target, size = words_of[r["sid"]]
        want = sum(max(0, min(r["start"] + r["size"] + p * size, target) - (r["start"] + p * size)) for p in (0, 1))
        assert got.get(r["uid"], 0) == want


def _plain_slots(plan, block):
    """Slots of every source in turn, walked one by one."""
    sources = sorted(plan, key=lambda r: r["sid"])
    everything, upto, shares = sum(r["target"] for r in sources), 0.0, []
    for r in sources:
        upto += r["target"]
        shares.append([r["sid"], (upto - r["target"]) / everything, upto / everything, r["target"]])
    shares = [x for x in shares if x[3] > 0]
    shares[-1][2] = 1.0
    need = {}
    for r in sources:
        size, words = max(1, r["source_size"]), int(r["target"] + 0.5)
        blocks = -(-size // block)
        need[r["sid"]] = words // size * blocks + -(-(words % size) // block)
    n = sum(math.ceil(r["target"] / block) for r in sources) + 1
    turns = {r["sid"]: [] for r in sources}
    for k in range(n):
        u = k * mixing.GOLDEN % mixing.PERIOD / mixing.PERIOD
        turns[next(sid for sid, lo, hi, _ in shares if lo <= u < hi)].append(k)
    return {sid: t[: need[sid]] + [n + r for r in range(len(t), need[sid])] for sid, t in turns.items()}


def test_mix_tells_the_slots_of_every_document(docs):
    """How many slots take words of a document, the first and the last, against a schedule walked slot by slot."""
    block = 16
    sizes = mixing.sized(docs)
    plan = mixing.store(mixing.targets(sizes), "t")
    plain = plan.collect()
    turns, of = _plain_slots(plain, block), {r["sid"]: r for r in plain}
    starts = {r["uid"]: (r["sid"], r["start"]) for r in mixing._streams(sizes, plan).collect()}
    want = []
    for r in sizes.collect():
        took = []
        if r["uid"] in starts:
            sid, start = starts[r["uid"]]
            size, words = of[sid]["source_size"], int(of[sid]["target"] + 0.5)
            blocks = -(-size // block)
            for rank, slot in enumerate(turns[sid]):
                lap, b = divmod(rank, blocks)
                lo, hi = b * block, min((b + 1) * block, size, words - lap * size)
                if min(hi, start + r["size"]) > max(lo, start):
                    took.append(slot)
        want.append((r["doc_id"], r["size"], len(took), min(took, default=None), max(took, default=None)))
    got = [(r["doc_id"], r["size"], r["slots"], r["first_slot"], r["last_slot"]) for r in mixing.mix(docs, block_words=block).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_mix_schedule_is_even(docs):
    sizes = mixing.sized(docs)
    plan = mixing.store(mixing.targets(sizes), "t")
    slots = sorted((r["slot"], r["sid"]) for r in mixing.schedule(plan, block_words=8).collect())
    share = {r["sid"]: r["target"] for r in plan.collect()}
    total, seen = sum(share.values()), collections.Counter()
    for k, (_, sid) in enumerate(slots[: len(slots) // 2], 1):
        seen[sid] += 1
        assert all(abs(seen[s] - k * t / total) < 8 for s, t in share.items())


def test_mixed_documents_keep_their_columns(docs):
    out = mixing.mixed_documents(docs, block_words=8)
    assert out.dtypes == docs.dtypes
    texts_of = {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = out.where("doc_id is not null and doc_id <> 160").collect()
    assert rows and all(texts_of[r["doc_id"]].lstrip().startswith(r["text"].strip()[:40]) and r["n_chars"] == len(r["text"]) for r in rows)


def test_mix_of_nothing(empty, spark):
    assert mixing.mix(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0
    blank = spark.createDataFrame([(1, None, None), (2, "", "a")], "doc_id long, text string, source string")
    assert sorted((r["doc_id"], r["size"], r["target"], r["taken"]) for r in mixing.mix(blank).collect()) == [(1, 0, 0.0, 0), (2, 0, 0.0, 0)]


def test_mix_is_native(docs):
    plan = mixing.mix(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


# ---- packing


def test_plan_is_best_fit_decreasing():
    rng = random.Random(5)
    for _ in range(60):
        capacity = rng.choice([10, 37, 2048])
        histogram = collections.Counter(rng.randint(1, capacity) for _ in range(rng.randint(0, 300)))
        places, n = packing.plan_places(histogram, capacity)
        bins: list[int] = []
        for length in sorted(histogram.elements(), reverse=True):
            fitting = [(room, k) for k, room in enumerate(bins) if room >= length]
            if fitting:
                bins[min(fitting)[1]] -= length
            else:
                bins.append(capacity - length)
        assert n == len(bins)
        assert sum(p.last - p.first for p in places) == sum(histogram.values())


def test_pack_round_trip(docs, rows):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0], dtype="<u4")
        edges = packing.cut(len(ids), 256)
        for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)):
            want[i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())] += 1
    out = packing.pack(docs, capacity=256, with_ids=True).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    sequences = collections.defaultdict(list)
    for r in out:
        sequences[r["sequence_id"]].append((r["offset"], r["length"], len(r["ids"])))
    total = 0
    for pieces in sequences.values():
        at = 0
        for offset, length, ids in sorted(pieces):
            assert offset == at and length == ids
            at += length
        assert at <= 256
        total += at
    assert len(sequences) <= 1.05 * total / 256 + 1


def test_added_tokens_in_text_are_their_ids(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    end = "<|endoftext|>"
    rows = list(enumerate([f"a {end} b", end, end * 3, f"x  {end}  y\n", f"\n\n {end}", f"{end[:-1]} {end}don't{end}é", f"w {end} " * 300, "<|endoftext", "none"]))
    want = collections.Counter()
    for i, t in rows:
        ids = np.array([*tokenizer.encode(t, add_special_tokens=False).ids, 0], dtype="<u4")
        edges = packing.cut(len(ids), 256)
        want.update((i, n, a, b - a, zlib.crc32(ids[a:b].tobytes())) for n, (a, b) in enumerate(zip(edges, edges[1:], strict=False)))
    out = packing.pack(spark.createDataFrame(rows, "doc_id long, text string"), capacity=256).collect()
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in out) == want
    assert packing.encoder(packing.default_vocabulary())(f"a {end} b") == [64, 220, 50256, 275]


def test_pack_of_nothing(empty):
    assert packing.pack(empty).count() == 0


# ---- language


def test_language_is_learned_and_unknown_where_there_is_none(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    out = langid.identify(docs, langid.fit(docs)).join(docs, "doc_id").withColumn("held", langid.held_out())
    right = out.where("held").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("double"))).first()[0]
    assert right > 0.95
    rows = out.collect()
    assert all(r["held"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) and 0 <= r["score"] <= 1 for r in rows)


def test_language_edge_rows(docs, empty):
    model = langid.fit(docs)
    out = {r["doc_id"]: r for r in langid.identify(docs, model).where("doc_id is not null").collect()}
    for i in (150, 151, 152, 157):
        assert (out[i]["lang_pred"], out[i]["score"]) == ("und", 0.0)
    assert all(out[i]["lang_pred"] in ("en", "de") for i in (0, 153, 156, 159, 160))
    assert langid.fit(empty) is None and langid.identify(docs, None).where("lang_pred <> 'und' or score <> 0").count() == 0
    assert langid.identify(empty, model).count() == 0
    kept = langid.identified(docs)
    assert kept.dtypes == docs.dtypes and kept.count() == docs.count() - 5


def test_unlabelled_tables_keep_their_rows(docs, spark):
    clean = lambda t: sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"]) for r in t.where(F.col("text").rlike(r"\p{L}")).collect())
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert clean(langid.identified(unlabelled)) == clean(docs) and langid.identified(unlabelled).count() == docs.count() - 5
    in_fold = docs.where(langid.held_out())
    assert langid.fit(in_fold) is None and clean(langid.identified(in_fold)) == clean(in_fold) != []
    named = docs.withColumn("lang", F.lit(langid.UNKNOWN))
    assert clean(langid.identified(named)) == clean(docs)


def test_network_gradient_learns_and_windows_cover_all():
    assert langid.windows_of(b"").shape == (1, langid.WINDOW) and langid.windows_of(b"a" * 257).shape == (2, langid.WINDOW)
    rng = random.Random(1)
    make = lambda pool: " ".join("".join(rng.choice(pool) for _ in range(4)) for _ in range(60)).encode()
    data = [(make("abcd"), 0) for _ in range(40)] + [(make("efgd"), 1) for _ in range(40)]
    x = np.concatenate([langid.windows_of(t)[:1] for t, _ in data])
    model = langid.train(x, np.array([y for _, y in data]), ["p", "q"], epochs=4)
    picks, scores = langid.predict(model, [make("abcd") * 5, make("efgd"), b"x"])
    assert picks[:2] == [0, 1] and all(0 <= s <= 1 for s in scores)


def test_language_sample_is_bounded_by_rows(spark, monkeypatch):
    """However many rows share an id or repeat, training sees at most the documented windows."""
    docs = spark.range(20_000).select(F.lit(7).alias("doc_id"), F.concat(F.lit("some words "), F.col("id") % 9000).alias("text"), F.lit("en").alias("lang"))
    seen = []
    monkeypatch.setattr(langid, "train", lambda x, y, labels: seen.append(len(x)))
    langid.fit(docs, sample_docs=100)
    langid.fit(docs.withColumn("text", F.lit("always the same")), sample_docs=100)
    assert seen == [100, 1]


def test_language_gradient_agrees_with_differences(monkeypatch):
    """One step of the first batch, seen through Adam's first moment, against the loss at shifted parameters."""
    rng = np.random.default_rng(3)
    x = np.stack([langid.windows_of(bytes(rng.integers(97, 105, 200, dtype=np.uint8)))[0] for _ in range(6)])
    y = np.array([0, 1, 2, 0, 1, 2])
    labels = ["a", "b", "c"]
    monkeypatch.setattr(langid, "RATE", 0.0)  # parameters stay at their start
    start = langid.train(x, y, labels, epochs=1)
    params = [start.embed, *start.filters, start.bias, start.weight, start.offset]

    def loss() -> float:
        pooled, _ = langid._pooled(langid.Model(labels, params[0], params[1:-3], *params[-3:]).tables(), params[-3], x)
        return float(-np.log(langid._softmax((pooled @ params[-2] + params[-1]).astype(np.float64))[np.arange(6), y]).mean())

    # Adam's first step moves every parameter by the rate against the sign of its gradient
    monkeypatch.setattr(langid, "RATE", 1e-6)
    moved = langid.train(x, y, labels, epochs=1)
    checked = 0
    for p, q in zip(params, [moved.embed, *moved.filters, moved.bias, moved.weight, moved.offset], strict=True):
        step = (q - p).ravel()
        for i in rng.permutation(p.size)[:40]:
            flat, old = p.reshape(-1), p.reshape(-1)[i]
            flat[i] = old + 1e-2
            up = loss()
            flat[i] = old - 1e-2
            slope = (up - loss()) / 2e-2
            flat[i] = old
            if abs(slope) > 2e-3:
                checked += 1
                assert np.sign(step[i]) == -np.sign(slope)
    assert checked > 40


# ---- personal data


def test_base_spans_agree_with_the_patterns():
    rng = random.Random(9)
    parts = ["a@b.c", "x.y@z", "@", "@@", ".", "-", " ", "1.2.3.4", "999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "+49 (30) 123456", "+1", "12", "a.b", "é", "٠", "1.2.3.4.5", "\n", "u@v.w.x@y.z", "+", "0001.02.3.255", "7" * 40]
    for _ in range(4000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 9)))
        got = [f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in pii.base_spans(text)]
        assert got == brute.personal(text), repr(text)


def test_base_spans_stay_linear():
    for text in ("1" * 200_000, "a" * 200_000, "a@" * 100_000, "+1" * 100_000, "1." * 100_000, "a-" * 100_000 + "@" + "b-" * 100_000):
        pii.base_spans(text)


def personal_docs(spark):
    rng = random.Random(4)
    rows = [(i, " ".join(words(rng, 30, 50))) for i in range(60)]
    rows += [(i, f"{' '.join(words(rng, 8, 50))} madame Quibberly mail quib@erly.org today {' '.join(words(rng, 8, 50))}") for i in range(60, 70)]
    rows += [(70, "Quibberly was here"), (71, None), (72, ""), (73, "call +49 30 123456 now"), (73, "call +49 30 123456 now")]
    return spark.createDataFrame([(*r, 1, "k") for r in rows], "doc_id long, text string, uid int, n_chars string").drop("n_chars").repartition(4), rows


def test_disclosing_terms_are_found(spark):
    docs, rows = personal_docs(spark)
    out = pii.find_personal_data(docs, generalise_bits=0.15).collect()
    texts_of = dict(rows)
    assert len(out) == len(rows)
    flagged = collections.Counter()
    for r in out:
        base = brute.personal(texts_of[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(",".join(base).encode()).hexdigest()
        spans = r["spans"].split(",") if r["spans"] else []
        assert spans[: len(base)] == base and len(spans) == len(base) + r["n_term"]
        for s in spans[len(base) :]:
            kind, a, b = s.split(":")
            assert kind == "term"
            flagged[texts_of[r["doc_id"]][int(a) : int(b)].lower()] += 1
    # 10 of the 11 documents with the name hold the address: -log2(10/11) = 0.14 bits are left
    assert flagged == {"quibberly": 11, "madame": 10, "mail": 10, "today": 10}
    clean = pii.sanitise(docs)
    assert clean.dtypes == docs.dtypes and clean.count() == docs.count()
    by_id = {r["doc_id"]: r["text"] for r in clean.collect()}
    assert by_id[70] == "[TERM] was here" and by_id[71] is None and by_id[73] == "call [PHONE] now" and by_id[0] == texts_of[0]


def flagged_terms(spark, lines, **options) -> collections.Counter:
    table = spark.createDataFrame(list(enumerate(lines)), "doc_id long, text string").repartition(3)
    flagged = collections.Counter()
    for r in pii.find_personal_data(table, **options).collect():
        for kind, a, b in (s.split(":") for s in r["spans"].split(",") if s):
            flagged[lines[r["doc_id"]][int(a) : int(b)].lower()] += kind == "term"
    return +flagged


def test_terms_anywhere_in_a_document_disclose(spark):
    filler = [" ".join(words(random.Random(k), 20, 50)) for k in range(300)]
    card = "Jane Quibberly, Department of Neurology, second floor, left wing, email: j.q@erly.org, other@erly.org"
    common = "department of neurology second floor left wing email"
    found = flagged_terms(spark, filler + [card] * 10 + [common] * 20)
    assert found == {"jane": 10, "quibberly": 10}
    far = "Zebulon " + "w " * 500 + "z@erly.org, y@erly.org, x@erly.org"
    assert flagged_terms(spark, [*filler, *[far] * 6]) == {"zebulon": 6}


def test_few_documents_are_evidence_in_a_large_corpus(spark):
    filler = [" ".join(words(random.Random(k), 20, 50)) for k in range(300)]
    for n in (2, 3, 4):
        assert flagged_terms(spark, [*filler, *["Quibberly q@erly.org"] * n]) == {"quibberly": n}
    assert flagged_terms(spark, [*filler, "Quibberly q@erly.org"]) == {}
    assert flagged_terms(spark, [*filler[:20], *["Quibberly q@erly.org"] * 2]) == {}


def test_names_inside_addresses_are_no_occurrences(spark):
    filler = [" ".join(words(random.Random(k), 20, 50)) for k in range(60)]
    named = ["Quibberly quibberly@erly.org"] * 10 + ["w quibberly@erly.org w"] * 10
    assert flagged_terms(spark, filler + named) == {"quibberly": 10}
    table = spark.createDataFrame(list(enumerate(filler + named)), "doc_id long, text string")
    assert not any("uibberly" in r["text"] for r in pii.sanitise(table).collect())


def test_personal_data_of_odd_tables(docs, rows, empty):
    assert pii.find_personal_data(empty).count() == 0 and pii.sanitise(empty).count() == 0
    assert pii.find_personal_data(docs).count() == len(rows)
    out = pii.sanitise(docs)
    assert out.dtypes == docs.dtypes and out.count() == len(rows)

def test_filters_hold_every_name_and_few_others(spark):
    for n in (1, 3000, 2_000_000):
        bits = pii._filter_of(spark.range(n).select(F.concat(F.lit("name "), F.col("id")).alias("name")))
        assert len(bits) == max(4096, 1 << ((n * pii.NAME_BITS - 1).bit_length() - 3))
        assert all(pii._in_filter(bits, f"name {i}") for i in range(0, n, max(1, n // 3000)))
        assert sum(pii._in_filter(bits, f"other {i}") for i in range(3000)) < 60
    assert pii._filter_of(spark.range(0).select(F.lit("x").alias("name"))) == b""


def test_pruning_loses_no_disclosing_term(spark, monkeypatch):
    """Frequent and rare addresses, terms of all frequencies: what filters and classes leave out discloses nothing."""
    rng = random.Random(8)
    people = [(f"p{i}@x.org", f"Name{''.join(rng.choices('abcdefghij', k=5))}", rng.choice((2, 3, 5, 8, 30))) for i in range(60)]
    lines = [f"{name} {mail} {' '.join(words_of_letters(rng, 6))}" for mail, name, n in people for _ in range(n)]
    lines += [f"{name} {' '.join(words_of_letters(rng, 6))}" for _, name, n in people[::3] for _ in range(n // 10)]
    lines += [f"list@x.org {' '.join(words_of_letters(rng, 9))}" for _ in range(120)] + [" ".join(words_of_letters(rng, 9)) for _ in range(300)]
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(lines)], "doc_id long, text string")
    pruned = sorted(tuple(r) for r in pii.find_personal_data(docs).collect())
    monkeypatch.setattr(pii, "_filter_of", lambda names: b"\xff" * 4096)  # lets every name and every class through
    everything = sorted(tuple(r) for r in pii.find_personal_data(docs).collect())
    assert pruned == everything and sum(r[5] for r in pruned) > 200


def words_of_letters(rng: random.Random, n: int) -> list[str]:
    return ["".join(rng.choices("klmnopqrst", k=rng.choice((2, 3)))) for _ in range(n)]


# ---- near duplicates


def test_near_duplicates_agree_with_all_pairs(docs, rows):
    for width in (4, 5):
        want = brute.components([(i, t) for i, t in rows if i is not None], width)
        out = neardup.near_duplicates(docs, width=width).collect()
        assert len(out) == len(rows)
        for r in out:
            if r["doc_id"] is None:
                assert r["component_id"] is None and not r["kept"]
            else:
                text = next(t for i, t in rows if i == r["doc_id"])
                assert (r["n_shingles"], r["component_id"], r["kept"]) == (len(brute.shingles(text, width)), want[r["doc_id"]], want[r["doc_id"]] == r["doc_id"])
    assert sum(want[i] != i for i in want) > 50


def test_near_duplicates_in_blocks(docs, rows, monkeypatch):
    monkeypatch.setattr(neardup, "BUCKET_BLOCK", 4)
    monkeypatch.setattr(neardup, "CLUSTER_BLOCK", 3)
    want = brute.components([(i, t) for i, t in rows if i is not None], 4)
    out = neardup.near_duplicates(docs, width=4).where("doc_id is not null").collect()
    assert {r["doc_id"]: r["component_id"] for r in out} == want


def test_one_document_of_each_group_stays(docs, rows, empty):
    want = brute.components([(i, t) for i, t in rows if i is not None], 5)
    out = neardup.without_near_duplicates(docs)
    assert out.dtypes == docs.dtypes
    assert {r["doc_id"] for r in out.collect()} == {i for i in want if want[i] == i} | {None}
    assert neardup.near_duplicates(empty).count() == 0 and neardup.without_near_duplicates(empty).count() == 0


def test_one_row_of_each_group_stays(spark):
    rng = random.Random(12)
    a, b, c, d, e = (" ".join(words(rng, 120)) for _ in range(5))
    near = b.rsplit(" ", 1)[0] + " changed"
    rows = [(1, a), (1, a), (None, a), (5, c), (5, b), (3, near), (None, d), (None, d), (8, e), (9, e.upper()), (9, e), (7, None), (7, None), (7, "")]
    table = spark.createDataFrame([(*r, k, "k") for k, r in enumerate(rows)], "doc_id long, text string, uid long, row string").repartition(4)
    out = neardup.without_near_duplicates(table)
    assert out.dtypes == table.dtypes
    got = collections.Counter((r["doc_id"], r["text"]) for r in out.collect())
    assert got == collections.Counter([(1, a), (5, c), (3, near), (None, d), (8, e), (7, None), (7, None), (7, "")])


def test_posterior_bounds():
    least = neardup.least_matches(0.8, 160)
    assert least == sorted(least) and 0 < least[0] < 32 * 0.8 and least[-1] < 160 * 0.8
    rng = np.random.default_rng(2)
    hits = (rng.random((200_000, 160)) < 0.8).cumsum(axis=1)[:, 31::32]
    assert (hits < np.array(least)).any(axis=1).mean() < 1e-4
    assert ((rng.random((2000, 160)) < 0.4).cumsum(axis=1)[:, 31::32] < np.array(least)).any(axis=1).all()


def test_components_of_a_long_chain(spark):
    edges = [(i, i + 1) for i in range(0, 300)] + [(1000, 1001), (1001, 1002), (1000, 1002)]
    random.Random(1).shuffle(edges)
    out = {r["uid"]: r["root"] for r in neardup.components(spark.createDataFrame(edges, "uid long, low long")).collect()}
    assert out == {**{i: 0 for i in range(1, 301)}, 1001: 1000, 1002: 1000}


# ---- web archives


def test_archives_round_trip(spark, tmp_path):
    pages = [(5, "http://a/ b", "same"), (3, "http://c", "same"), (9, None, "same"), (1, "u", None), (2, "u", ""), (4, "u", "é" * 50_000), (6, "u", "WARC/1.1\r\n\r\n0\r\n\r\nWARC/1.1\r\n")]
    pages += [(7, "u", "x" * 100_000), (7, "u", "x" * 100_000), (None, "u", "same"), (None, "u", "alone")]
    path = str(tmp_path / "pages")
    spark.createDataFrame([(*p, 1, "k") for p in pages], "page_id long, url string, html string, uid int, record string").repartition(3).write.parquet(path)
    table = spark.read.parquet(path)
    for least, segment in ((0, 1000), (5, 1 << 20)):
        out_path = scratch_path(spark, "warc")
        warc.write_archives(table, out_path, min_revisit_bytes=least, segment_bytes=segment, file_records=50)
        out = warc.read_archives(spark, out_path).collect()
        assert len(out) == len(pages) and all(r["status"] == "ok" for r in out)
        seen = collections.Counter()
        for r in out:
            body = [(h or "").encode() for p, _, h in pages if p == r["page_id"]]
            if r["record_type"] == "response":
                assert bytes(r["payload"]) in body and r["refers_to"] is None
                body = [bytes(r["payload"])]
            assert (r["payload_bytes"], r["payload_digest"]) in {(len(b), base64.b32encode(hashlib.sha1(b).digest()).decode()) for b in body}
            seen[r["page_id"], r["record_type"], r["refers_to"]] += 1
        assert seen[7, "response", None] == 1 and seen[7, "revisit", 7] == 1
        if least == 0:
            assert seen[3, "response", None] == 1 and seen[5, "revisit", 3] == 1 and seen[9, "revisit", 3] == 1 and seen[None, "revisit", 3] == 1
            assert seen[1, "response", None] == 1 and seen[2, "revisit", 1] == 1 and seen[None, "response", None] == 1
        else:
            assert seen[1, "response", None] == seen[2, "response", None] == seen[5, "response", None] == 1


def test_broken_archives_are_told(spark, tmp_path):
    path = tmp_path / "broken"
    path.mkdir()
    part = lambda kind, rid, extra, block: warc._record(kind, rid, "u", "d", block, extra) + warc.END
    body = warc._HTTP + warc.frame_chunks(b"hello world")
    records = part("response", "<urn:page:1:0>", ["WARC-Segment-Number: 1"], body[:50]) + part("continuation", "<x>", ["WARC-Segment-Origin-ID: <urn:page:1:0>", "WARC-Segment-Number: 3", f"WARC-Segment-Total-Length: {len(body)}"], body[60:])
    records += part("response", "<urn:page:2:0>", [], warc._HTTP + b"5\r\nhel") + part("revisit", "<urn:page:3:0>", ["WARC-Refers-To: <urn:page:8:0>"], warc._HTTP) + part("warcinfo", "<y>", [], b"made by hand")
    (path / "a.gz").write_bytes(gzip.compress(records))
    out = {r["page_id"]: (r["status"], r["payload"]) for r in warc.read_archives(spark, str(path)).collect()}
    assert out == {1: ("incomplete", None), 2: ("chunk cut short", None), 3: ("response missing", None)}


def test_archives_of_nothing(spark):
    path = scratch_path(spark, "warc")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.read_archives(spark, path).count() == 0


def test_chunk_framing():
    for n in (0, 1, 8191, 8192, 30_000):
        data = bytes(i % 251 for i in range(n))
        assert warc.unframe_chunks(warc.frame_chunks(data)) == data
    for bad in (b"", b"5\r\nhel", b"zz\r\n"):
        with pytest.raises(ValueError):
            warc.unframe_chunks(bad)


# ---- fingerprints


def test_fingerprints(docs, rows, empty, spark):
    known = [(i, t or "") for i, t in rows if i is not None]
    out = fingerprints.fingerprinted(docs.where("doc_id is not null and doc_id <> 160"))
    known = sorted(((i, t) for i, t in known if i != 160), reverse=True)
    got = {r["doc_id"]: r for r in out.collect()}
    assert len(got) == len(known)
    prints = collections.defaultdict(set)
    for (i, t), (_, following) in zip(known, known[1:] + known[:1], strict=True):
        changed = t[: len(t) - len(t) // 3] + following[: len(t) // 3]
        r = got[i]
        assert (r["n_chars"], r["edited_sha256"]) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
        prints[t].add(r["fingerprint"])
        if t == following:
            assert r["near_next"] == 1
    assert all(len(p) == 1 for p in prints.values())
    assert fingerprints.fingerprinted(docs).count() == len(rows) and fingerprints.fingerprinted(empty).count() == 0
    one = fingerprints.fingerprinted(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def test_near_pairs_are_verified(spark):
    rng = random.Random(6)
    base = words(rng, 200)
    rows = [(i, " ".join(words(rng, 100))) for i in range(30)] + [(30 + i, " ".join([*base[:-i], "y"] if i else base)) for i in range(10)]
    out = fingerprints.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert {r["b"] for r in out} == set(range(31, 40)) and all(30 <= r["a"] < r["b"] and r["jaccard"] >= 0.8 for r in out)


def test_near_pairs_in_a_template_are_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(fingerprints, "BUCKET_BLOCK", 16)
    rng = random.Random(21)
    template = words(rng, 200, 10**6)
    texts = []
    for _ in range(60):  # alike at about 0.7, below the threshold
        texts.append([*template, *words(rng, 40, 10**6)])
    for k in range(50, 60):  # near copies of the last, above it
        texts.append([*texts[k][:-8], *words(rng, 8, 10**6)])
    rows = list(enumerate([" ".join(t) for t in texts])) + [(100, " ".join(texts[7])), (101, " ".join(texts[7]))]
    sets = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in rows for w in [t.split()]}
    sims = {(a, b): len(sets[a] & sets[b]) / len(sets[a] | sets[b]) for a in sets for b in sets if a < b}
    want = {p: s for p, s in sims.items() if s >= 0.8 and p != (100, 101)}
    out = fingerprints.near_pairs(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(want) == 12 and {(r["a"], r["b"]): r["jaccard"] for r in out} == pytest.approx(want) and len(out) == len(want)


# ---- repeated bytes


def test_repeats_agree_with_all_windows(docs, rows, empty):
    for length in (50, 30):
        want = collections.Counter((i, len(k), n, s, hashlib.sha256(k).hexdigest()) for i, k, n, s in brute.removed(rows, length))
        out = suffixes.remove_repeats(docs, length=length, with_text=True).collect()
        assert collections.Counter((r["doc_id"], len(r["kept"]), r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want
        assert all(r["n_bytes"] == len(r["kept"]) + r["n_removed"] for r in out)
    assert suffixes.remove_repeats(empty).count() == 0


def test_long_repeats_have_wide_surroundings(docs, rows):
    data = [(i, t) for i, t in rows if i != 159]
    for length in (138, 200):
        want = collections.Counter((i, n, s, hashlib.sha256(k).hexdigest()) for i, k, n, s in brute.removed(data, length))
        out = suffixes.remove_repeats(docs.where("doc_id is null or doc_id <> 159"), length=length).collect()
        assert collections.Counter((r["doc_id"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want


def test_shards_merge_at_their_borders(docs, rows, monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD", 500)
    data = [(i, t) for i, t in rows if i != 159]
    out = suffixes.remove_repeats(docs.where("doc_id is null or doc_id <> 159")).collect()
    want = collections.Counter((i, n, s, hashlib.sha256(k).hexdigest()) for i, k, n, s in brute.removed(data, 50))
    assert collections.Counter((r["doc_id"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want


def test_surroundings_of_hot_anchors_are_cut(docs, rows):
    for hot, length in ((0, 50), (3, 50), (3, 30), (0, 22)):
        want = collections.Counter((i, n, s, hashlib.sha256(k).hexdigest()) for i, k, n, s in brute.removed(rows, length))
        out = suffixes.remove_repeats(docs, length=length, hot=hot).collect()
        assert collections.Counter((r["doc_id"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in out) == want


def test_equal_surroundings_leave_a_home_once():
    """A run of one byte has an anchor at every place, and a passage stands in many documents."""
    rng = random.Random(5)
    passage = " ".join(words(rng, 12))
    texts = ["z" * 20_000, *[f"{rng.random()} {passage} {rng.random()}" for _ in range(300)]]
    table = pa.table({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": texts, "d": pa.array([0] * len(texts), pa.int32())})
    keys = np.unique(suffixes.anchors([t.encode() for t in texts])[0] >> np.uint64(32 - 3))
    for hot in (keys[:0], keys):
        shared = pa.table({"d": pa.array([0], pa.int32()), "keys": [keys.tobytes()], "hot": [hot.tobytes()], "copies": pa.array([None], pa.list_(pa.int64()))})
        out = suffixes._surroundings(3, 50)(table, shared)
        # each place of the run would send 80 bytes
        assert 0 < sum(map(len, out.column("text").to_pylist())) < 20_000 * 80 / 2


def test_windows_of_one_anchor_are_merged_in_parts(monkeypatch):
    monkeypatch.setattr(suffixes, "SHARD", 300)
    monkeypatch.setattr(suffixes, "MERGED", 7)
    rng = random.Random(6)
    parts = sorted({"".join(rng.choice("ab") * rng.randint(1, 9) for _ in range(16)).encode() for _ in range(60)})
    docs = np.array(rng.sample(range(1000), len(parts)))
    owner, offset, least = suffixes.smallest_holders(np.zeros(len(parts), dtype=np.int64), docs, docs + 2000, parts, 22)
    holders = collections.defaultdict(lambda: 9999)
    for p, doc in zip(parts, docs.tolist(), strict=True):
        for k in range(len(p) - 21):
            holders[p[k : k + 22]] = min(holders[p[k : k + 22]], doc)
    want = {(i, k): holders[p[k : k + 22]] for i, p in enumerate(parts) for k in range(len(p) - 21)}
    assert dict(zip(zip(owner.tolist(), offset.tolist(), strict=True), least.tolist(), strict=True)) == want


def test_suffix_array_and_prefixes():
    rng = random.Random(1)
    for _ in range(80):
        n = rng.randint(1, 300)
        data = np.array([rng.choice(rng.choice([b"ab", b"a", b"abc "])) for _ in range(n)], dtype=np.uint8)
        b = data.tobytes()
        order, _ = suffixes.suffix_array(data, 512)
        assert order.tolist() == sorted(range(n), key=lambda i: b[i:])
        shared = suffixes.common_prefixes(data, order, np.array([0]), 1024)
        for k in range(1, n):
            x, y = b[order[k - 1] :], b[order[k] :]
            assert shared[k] == next((i for i, (p, q) in enumerate(zip(x, y, strict=False)) if p != q), min(len(x), len(y)))


# ---- top k


def test_top_k_is_exact(spark, monkeypatch):
    monkeypatch.setattr(topk, "QUERY_BLOCK", 3)
    rng = np.random.default_rng(8)
    vectors = [(i, rng.integers(-3, 4, 8).astype(float).tolist()) for i in range(900)] + [(i, [1.0] * 8) for i in range(900, 1000)]
    odd = [(1000, None), (1100, []), (1200, [float("nan")] * 8), (1300, [1.0, None] * 4), (1400, [float("inf")] * 8), (1500, [1.0, 2.0]), (None, [1.0] * 8), (1600, [0.0] * 8)]
    table = spark.createDataFrame([(i, v, 1, 2) for i, v in vectors + odd], "vec_id long, embedding array<double>, part int, id int").repartition(7)
    fine = [(i, np.array([*np.floor(1024 * np.array(v)), *[0] * (8 - len(v))], dtype=np.int64)) for i, v in vectors + odd if i in (1100, 1500, 1600) or (i is not None and i < 1000)]
    want = set()
    for i, q in fine:
        if i % 100 == 0:
            best = sorted(((-int(q @ v), j) for j, v in fine if j != i))[:10]
            want |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(best)}
    got = {(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(table).collect()}
    assert got == want
    assert topk.top_k(table.where("false")).count() == 0
    assert topk.top_k(table.where("vec_id = 100")).count() == 0
    assert topk.top_k(table.where("vec_id in (100, 101)")).count() == 1


def best_of(rows: list[tuple[int, list[float]]], k: int = 10) -> set[tuple[int, int, int, int]]:
    whole = [(i, [math.floor(Fraction(x) * 1024) for x in v]) for i, v in rows]
    out = set()
    for i, q in whole:
        if i % 100 == 0:
            best = sorted((-sum(a * b for a, b in zip(q, v, strict=False)), j) for j, v in whole if j != i)[:k]
            out |= {(i, n + 1, j, -s) for n, (s, j) in enumerate(best)}
    return out


def test_top_k_of_large_components(spark):
    """Components up to 2^40, whose floats round, and products near the ends of 64 bits."""
    rng = random.Random(12)
    rows = [(i, [float(rng.choice((0, 1, -1)) * rng.choice((0.5, 3.25, 2.0**20 + 0.001, 2.0**19 / 3))) for _ in range(4)]) for i in range(300)]
    rows += [(302, [-(2.0**-3), 7.0]), (400, []), (500, [0.0, 0.0, 2.0**10]), (501, [0.0, 0.0, 0.0, 0.0, -(2.0**33)])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>").repartition(5)
    assert {tuple(r) for r in topk.top_k(table).collect()} == best_of(rows)
    huge = [(100, [2.0**40, 0.0]), (1, [0.5, 2.0**300]), (2, [0.0, -1e305]), (3, [-0.25]), (4, [])]
    assert {tuple(r) for r in topk.top_k(spark.createDataFrame(huge, "vec_id long, embedding array<double>")).collect()} == best_of(huge)


def test_top_k_says_when_a_score_does_not_fit(spark):
    for other in (2.0**30, -(2.0**30)):
        rows = [(100, [2.0**25, 2.0**25]), (1, [other, other])]
        with pytest.raises(Exception, match="does not fit into 64 bits"):
            topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    # a score too low to fit matters only where it is among the best
    rows = [(100, [2.0**25, 2.0**25]), (1, [-(2.0**30), 0.0]), *[(i, [float(-i), 0.0]) for i in range(2, 13)]]
    got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect()
    assert {tuple(r) for r in got} == best_of(rows)


def test_top_k_of_repeated_ids(spark):
    rows = [(100, [1.0, 2.0]), (100, [1.0, 2.0]), (100, [2.0, 1.0]), (7, [3.0, 0.0]), (7, [3.0, 0.0]), (8, [0.0, 1.0])]
    got = sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).collect())
    scores = sorted((-1048576 * (a * c + b * d), j) for a, b in ((1, 2), (2, 1)) for j, (c, d) in ((7, (3, 0)), (7, (3, 0)), (8, (0, 1))))
    assert got == [(100, n + 1, j, -s) for n, (s, j) in enumerate(scores)]


# ---- executors without the package


def test_operators_travel_to_executors(tmp_path):
    """The package is on the driver's path alone, and the working folder is another one."""
    script = tmp_path / "elsewhere.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(Path(__file__).resolve().parents[2])!r})\n"
        "from mercato.session import build_session\n"
        f"spark = build_session('x', 'local[2]', **{{'spark.ui.enabled': 'false', 'spark.sql.shuffle.partitions': '2', 'spark.checkpoint.dir': {str(tmp_path / 'shared')!r}}})\n"
        "from mercato.llm import neardup, topk\n"
        "v = spark.createDataFrame([(100, [1.0]), (1, [2.0])], 'vec_id long, embedding array<double>')\n"
        "d = spark.createDataFrame([(1, 'a b c d e'), (2, 'a b c d e')], 'doc_id long, text string')\n"
        "print('found', [tuple(r) for r in topk.top_k(v).collect()], neardup.near_duplicates(d, width=4).where('kept').count())\n"
    )
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(script)], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=300)
    assert "found [(100, 1, 1, 2097152)] 1" in done.stdout, done.stderr[-2000:]
