"""Personal data by pattern, and terms that give it away by co-occurrence.

Patterns find emails, IP addresses, card and phone numbers: the protected entities. A term in a document of an entity
discloses it when knowing the term leaves little uncertainty about the entity: -log2 P(entity | term), with probabilities
counted in documents over the whole corpus. Terms below the thresholds are generalised or removed wherever they stand.
Words inside pattern matches are no occurrences of a term, in no count.
"""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import store, text_of

KINDS = ("email", "ip", "card", "phone", "term")
MIN_DOCS = 5  # documents of a term and an entity that are evidence enough in any corpus
CHANCE = 1e-4  # fewer, but at least two, are when documents without a link share them with at most this probability
REMOVE_BITS, GENERALISE_BITS = 0.01, 0.15  # uncertainty left about the entity, at most
NAME_BITS, PROBES = 16, 3  # room of a name in a filter sent to tasks, and the bits it sets there
FILTER_LIMIT = 29  # log2 of the bits a filter has at most (64 MB); beyond 2^25 names it lets more through, which costs time only
CLASSES = 48  # frequencies are told apart by their power of two
CACHE_TERMS = 500_000
LABELS = {"email": "[EMAIL]", "ip": "[IP]", "card": "[CARD]", "phone": "[PHONE]", "generalise": "[TERM]", "remove": ""}

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_DIGIT = re.compile(r"[0-9]")
# A digit run fails or matches alike from each of its digits, so only its first is tried.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_TERM = re.compile(r"[^\W\d_]+")

Span = tuple[int, int, int]  # number of the kind, start, end


def _emails(text: str) -> Iterator[tuple[int, int]]:
    floor, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            yield start, m.end()
            floor = m.end()
        at = text.find("@", max(at + 1, floor))


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Pattern matches by kind, then start; offsets are code points, ends exclusive."""
    out: list[Span] = [(0, a, b) for a, b in _emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return out
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) < 4 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16:
            digits = m[0].replace(" ", "").replace("-", "")
            if 16 <= len(digits) <= 19 and _luhn(digits):
                out.append((2, *m.span()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(c.isdigit() for c in m[0]) <= 15:
                out.append((3, *m.span()))
    return out


def _entity(text: str, span: Span) -> str:
    """Kind and normalised value, hashed: the statistics never hold the value itself."""
    value = text[span[1] : span[2]].lower()
    if span[0] >= 2:
        value = "".join(c for c in value if c.isdigit())
    return hashlib.sha256(f"{span[0]}:{value}".encode()).hexdigest()[:24]


def _outside(text: str, spans: list[Span]) -> Iterator[re.Match]:
    """Terms of the text that lie in no span, in order."""
    taken, at = sorted((a, b) for _, a, b in spans), 0
    reach = -1  # end of the spans that begin before the term ends
    for m in _TERM.finditer(text):
        while at < len(taken) and taken[at][0] < m.end():
            reach = max(reach, taken[at][1])
            at += 1
        if reach <= m.start():
            yield m


def _words(text: str, spans: list[Span]) -> set[str]:
    """Words outside the spans, as they stand."""
    return {m[0] for m in _outside(text, spans)} if spans else set(_TERM.findall(text))


def _summed(held: Counter, names: tuple[str, str], kind: pa.DataType) -> pa.RecordBatch:
    first, second = list(zip(*held, strict=True)) or ([], [])
    return pa.RecordBatch.from_arrays([pa.array(first, kind), pa.array(second, pa.string()), pa.array(list(held.values()), pa.int64())], names=[*names, "n"])


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(entity, name, n, beside): documents of every entity and of every term, and how many of a term's hold any entity,
    added up within the task before anything is shuffled."""
    held, beside = Counter(), Counter()

    def summed() -> pa.RecordBatch:
        batch = _summed(held, ("entity", "name"), pa.bool_())
        return batch.append_column("beside", pa.array([beside[name] for name in held], pa.int64()))

    for batch in batches:
        for cell in batch.column("text"):
            text = cell.as_py()
            spans = base_spans(text)
            terms = {(False, w.lower()) for w in _words(text, spans) if len(w) > 1}
            held.update(terms)
            if spans:
                beside.update(terms)
                held.update({(True, _entity(text, s)) for s in spans})
            if len(held) > CACHE_TERMS:
                yield summed()
                held, beside = Counter(), Counter()
    yield summed()


def _pairs(entity_bits: bytes, term_bits: bytes, reach: int):
    """(entity, term, n): documents that hold both, of those the filters let through, added up within the task.

    A term of class c (2^c to 2^(c+1) - 1 documents) can disclose only entities of class c - ``reach`` and above. A filter
    may name several classes for a name; the one that keeps more pairs is taken.
    """
    names = ("entity", "term")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, held = _passing(term_bits), Counter()
        for batch in batches:
            for cell in batch.column("text"):
                text = cell.as_py()
                spans = base_spans(text)
                found = sorted(e for e in {_entity(text, s) for s in spans} if _in_filter(entity_bits, e))
                terms = {w.lower() for w in passing(_words(text, spans)) if len(w) > 1} if found else ()
                by_class: dict[int, list[str]] = {}
                for t in terms:
                    by_class.setdefault(min(_classes_in(term_bits, t), default=0), []).append(t)
                for entity in found:
                    highest = max(_classes_in(entity_bits, entity), default=CLASSES) + reach
                    for c, some in by_class.items():
                        if c <= highest:
                            held.update((entity, t) for t in some)
                    if len(held) > CACHE_TERMS:
                        yield _summed(held, names, pa.string())
                        held = Counter()
        yield _summed(held, names, pa.string())

    return run


_HITS = pa.list_(pa.struct([("term", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
_SPANS = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("stop", pa.int64())]))


def _in_filter(bits: bytes, name: str) -> bool:
    if not bits:
        return False
    value, mask = xxhash.xxh64_intdigest(name.encode(), seed=42), 8 * len(bits) - 1  # the same as Spark's xxhash64
    start, step = value & 0xFFFFFFFF, value >> 32 | 1
    return all(bits[code >> 3] >> (code & 7) & 1 for code in (start + i * step & mask for i in range(PROBES)))


def _classes_in(bits: bytes, name: str) -> list[int]:
    """The frequency classes that the filter names for a name it holds: its own, and by chance others."""
    return [c for c in range(CLASSES) if _in_filter(bits, f"{name} {c}")]


def _passing(bits: bytes):
    """Those of some words, as they stand, whose lower-case form the filter lets through."""
    seen: dict[str, bool] = {}

    def wanted(words: set[str]) -> set[str]:
        if len(seen) > CACHE_TERMS:
            seen.clear()
        out = set()
        for word in words if bits else ():
            if (ok := seen.get(word)) is None:
                ok = seen[word] = _in_filter(bits, word.lower())
            if ok:
                out.add(word)
        return out

    return wanted


def _marker(bits: bytes):
    """Base spans of every document, and its occurrences of terms that the filter lets through."""

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = _passing(bits)
        for batch in batches:
            all_spans, all_hits = [], []
            for cell in batch.column("text"):
                text = cell.as_py()
                spans, words = base_spans(text), wanted(set(_TERM.findall(text)) if bits else set())
                hits = [
                    {"term": m[0].lower(), "start": m.start(), "stop": m.end()}
                    for m in (_outside(text, spans) if words else ())
                    if m[0] in words
                ]
                all_spans.append([{"kind": k, "start": a, "stop": b} for k, a, b in spans])
                all_hits.append(hits)
            rest = [batch.column(i) for i, n in enumerate(batch.schema.names) if n != "text"]
            names = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*rest, pa.array(all_spans, _SPANS), pa.array(all_hits, _HITS)], names=[*names, "spans", "hits"])

    return mark


def _filter_of(names: DataFrame) -> bytes:
    """Bits set for the strings of ``name``, NAME_BITS for each and 2^FILTER_LIMIT at most.

    Bits are set in Spark, 32768 to a row; what reaches the driver is the filter, however many names there are.
    """
    n = names.count()
    if not n:
        return b""
    size = min(FILTER_LIMIT, max(15, (n * NAME_BITS - 1).bit_length()))
    value = F.xxhash64("name")
    start, step = value.bitwiseAND(F.lit(0xFFFFFFFF)), F.shiftrightunsigned(value, 32).bitwiseOR(F.lit(1).cast("long"))
    codes = F.array(*[(start + F.lit(i).cast("long") * step).bitwiseAND(F.lit((1 << size) - 1)) for i in range(PROBES)])
    code = names.select(F.explode(codes).alias("code")).select((F.col("code") + 1).alias("code"))  # from 1 on, as are buckets
    rows = code.groupBy(F.bitmap_bucket_number("code").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))
    bits = bytearray(1 << (size - 3))
    for r in rows.toLocalIterator():
        at = (r["bucket"] - 1) << 12
        bits[at : at + 4096] = r["bits"]
    return bytes(bits)


def _classed(names: DataFrame, count: str) -> DataFrame:
    """Every name as it is and with the class of its frequency, as ``_in_filter`` and ``_classes_in`` look for them."""
    c = F.least(F.floor(F.log2(F.col(count) + F.lit(0.5))), F.lit(CLASSES - 1)).cast("string")
    return names.select(F.explode(F.array(F.col("name"), F.concat_ws(" ", "name", c))).alias("name"))


def _spans_and_terms(rows: DataFrame, *, min_docs: int, generalise_bits: float, remove_bits: float) -> tuple[DataFrame, DataFrame]:
    """``rows`` (id columns and text) with base spans and possible terms, stored; and the disclosing terms with their action."""
    context = rows.sparkSession.sparkContext
    texts = rows.select("text")
    seen = texts.mapInArrow(_occurrences, "entity boolean, name string, n long, beside long")
    counts = store(seen.groupBy("entity", "name").agg(F.sum("n").alias("n"), F.sum("beside").alias("beside")).where("n > 1"), "pii-counts")
    entities = counts.where("entity").select("name", F.col("n").alias("held"))
    # of the documents of a term that discloses an entity, that share and more hold it: few terms are so often beside any
    docs_of = counts.where(~F.col("entity") & (F.col("beside") >= 2) & (F.col("beside") >= F.col("n") * 2**-generalise_bits))
    docs_of = docs_of.select("name", F.col("n").alias("docs"))
    possible = context.broadcast((_filter_of(_classed(entities, "held")), _filter_of(_classed(docs_of, "docs"))))
    entities, docs_of = entities.withColumnRenamed("name", "entity"), docs_of.withColumnRenamed("name", "term")
    reach = max(1, math.ceil(generalise_bits))
    pairs = texts.mapInArrow(lambda it: _pairs(*possible.value, reach)(it), "entity string, term string, n long")
    joint = pairs.groupBy("entity", "term").agg(F.sum("n").alias("joint")).where("joint > 1")
    left = -F.log2(F.col("joint") / F.col("docs"))  # bits about the entity that the term leaves open
    close = store(joint.join(docs_of, "term").select("entity", "term", "joint", "docs", left.alias("bits")).where(F.col("bits") <= generalise_bits), "pii-pairs")
    many, few = close.where(F.col("joint") >= min_docs), close.where(F.col("joint") < min_docs).join(entities, "entity")
    known = many.select("term", "bits").unionByName(few.where(_by_chance(texts.count()) <= CHANCE).select("term", "bits"))
    least = known.groupBy("term").agg(F.min("bits").alias("bits"))
    action = F.when(F.col("bits") <= remove_bits, F.lit("remove")).when(F.col("bits") <= generalise_bits, F.lit("generalise"))
    terms = store(least.withColumn("action", action).where("action is not null"), "pii-terms")
    disclosing = context.broadcast(_filter_of(terms.select(F.col("term").alias("name"))))
    ids = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name != "text")
    found = "spans array<struct<kind:int,start:bigint,stop:bigint>>, hits array<struct<term:string,start:bigint,stop:bigint>>"
    marked = rows.mapInArrow(lambda it: _marker(disclosing.value)(it), f"{ids}, {found}")
    return store(marked.withColumn("uid", F.monotonically_increasing_id()), "pii-marked"), terms


def _by_chance(total: int) -> Column:
    """At most how probable it is that ``joint`` of a term's ``docs`` documents hold an entity that ``held`` of all hold.

    Chernoff's bound of the binomial tail: below it, the lower confidence bound on P(entity | term) is above P(entity).
    """
    n, k, p = F.col("docs"), F.col("joint"), F.col("held") / F.lit(float(max(total, 1)))
    others = F.when(n > k, (n - k) * F.log((n - k) / (n * F.greatest(1 - p, F.lit(1e-12))))).otherwise(F.lit(0.0))
    return F.when(k / n <= p, F.lit(1.0)).otherwise(F.exp(-(k * F.log(k / (n * p)) + others)))


def _term_spans(marked: DataFrame, terms: DataFrame) -> DataFrame:
    """(uid, found): occurrences of disclosing terms, with their action."""
    hits = marked.where(F.size("hits") > 0).select("uid", F.inline("hits"))
    return hits.join(terms.select("term", "action"), "term").groupBy("uid").agg(F.collect_list(F.struct("start", "stop", "action")).alias("found"))


def _listed(spans: Column) -> Column:
    """kind:start:end, comma-joined, by kind as listed and start."""
    names = F.array(*[F.lit(k) for k in KINDS])
    one = lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["stop"])
    return F.array_join(F.transform(F.array_sort(spans), one), ",")


def find_personal_data(
    docs: DataFrame, *, min_docs: int = MIN_DOCS, generalise_bits: float = GENERALISE_BITS, remove_bits: float = REMOVE_BITS
) -> DataFrame:
    """doc_id, n_email, n_ip, n_card, n_phone, n_term, base_sha256, spans for every row of ``docs``.

    ``spans`` lists the pattern matches and after them the disclosing terms. A term is a run of letters, in lower case,
    that leaves at most ``generalise_bits`` open about an entity of its documents, wherever in them the two stand. They
    share at least ``min_docs`` documents, or fewer, from two on, that chance does not explain in a corpus of this size.
    Null and empty texts have no spans; repeated rows are counted and reported as documents of their own.
    """
    rows = docs.select("doc_id", text_of().alias("text"))
    marked, terms = _spans_and_terms(rows, min_docs=min_docs, generalise_bits=generalise_bits, remove_bits=remove_bits)
    more = F.coalesce(F.transform("found", lambda s: F.struct(F.lit(4).alias("kind"), s["start"].alias("start"), s["stop"].alias("stop"))), F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>"))
    full = marked.join(_term_spans(marked, terms), "uid", "left").withColumn("more", more)
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long")
    return full.select(
        "doc_id", *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS[:4])], F.size("more").cast("long").alias("n_term"),
        F.sha2(_listed(F.col("spans")), 256).alias("base_sha256"), _listed(F.concat("spans", "more")).alias("spans"),
    )


def _redact(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for text, spans in zip(batch.column("row").field("text"), batch.column("found"), strict=True):
            text = text.as_py()
            if text is not None:
                cuts = [(s["start"], s["stop"], LABELS[s["action"]]) for s in spans.as_py() or []]
                cuts += [(a, b, LABELS[KINDS[k]]) for k, a, b in base_spans(text)]
                out, at = [], 0
                for a, b, label in sorted(cuts):
                    if a >= at:
                        out += [text[at:a], label]
                    at = max(at, b)
                text = "".join([*out, text[at:]]) if cuts else text
            texts.append(text)
        row = batch.column("row")
        fields = list(row.type)
        parts = [pa.array(texts, pa.string()) if f.name == "text" else row.field(i) for i, f in enumerate(fields)]
        yield pa.RecordBatch.from_arrays([pa.StructArray.from_arrays(parts, fields=fields)], names=["row"])


def sanitise(
    docs: DataFrame, *, min_docs: int = MIN_DOCS, generalise_bits: float = GENERALISE_BITS, remove_bits: float = REMOVE_BITS
) -> DataFrame:
    """``docs`` with personal data replaced: matches by their kind, disclosing terms by a general label or nothing.

    Null texts stay null. ``n_chars``, where there is one, follows the text; all other columns stay as they are.
    """
    print_of = F.struct(F.sha2("text", 256), F.octet_length("text")).alias("print")
    rows = docs.select(print_of, text_of().alias("text"))
    marked, terms = _spans_and_terms(rows, min_docs=min_docs, generalise_bits=generalise_bits, remove_bits=remove_bits)
    # equal texts have equal spans, so a text's print is key enough; one row per print, however many copies
    found = marked.where(F.size("hits") > 0).join(_term_spans(marked, terms), "uid").groupBy("print").agg(F.first("found").alias("found"))
    wide = docs.select(print_of, F.struct(*docs.columns).alias("row")).join(found, "print", "left").select("row", "found")
    out = wide.mapInArrow(_redact, f"row {wide.schema['row'].dataType.simpleString()}").select("row.*")
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.char_length("text").cast(docs.schema["n_chars"].dataType))
    return out
