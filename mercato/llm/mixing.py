"""Mixing sources to target weights with a low-discrepancy schedule, in DataFrame operations only.

Every source's documents stand in hash order and form one stream of words, cut into equal blocks. Slot k of the mix is
the golden-ratio point frac(k * phi); the cumulative target weights say whose slot it is, and the r-th slot of a source
takes the source's r-th block, starting over when the blocks are used up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from mercato.llm.common import WORD, store

WEIGHTS = (3, 1, 2)
BLOCK_WORDS = 256
CHUNK_SLOTS = 1 << 16  # slots ranked together by one task
BUCKET_ROWS = 1 << 12  # documents put in order together by one task
GRID = 1024  # cells of the unit interval by which points find their source
# The golden ratio's fraction times 2^31, odd: k * GOLDEN mod 2^31 is exact at any k and visits every point once a period.
GOLDEN, PERIOD = 1327217885, 1 << 31


def sized(docs: DataFrame, uid: Column | None = None) -> DataFrame:
    """(uid, doc_id, source, size), stored; size is the number of words, 0 for null text."""
    size = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(WORD)), F.lit(0)).cast("long")
    uid = F.monotonically_increasing_id() if uid is None else uid
    source = F.col("source").cast("string")
    return store(docs.select(uid.alias("uid"), "doc_id", source.alias("source"), size.alias("size")), "mix-sizes")


def targets(sizes: DataFrame, *, total_share: float = 1.5, most_times: float = 2.0, weights: tuple = WEIGHTS) -> DataFrame:
    """(source, sid, source_size, target): ``total_share`` of all words dealt by weight, no source above its limit.

    Sources by code point, null last, weigh ``weights`` in turn. Dealing the excess of capped sources again by weight
    until none is above ends where target = min(limit, level * weight) with one level for all, so the level is found
    from prefix sums over the sources ordered by limit / weight. One row per source: the windows hold sources only.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    ranked = totals.withColumn("sid", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("sid") % len(weights) + 1).cast("int"))
    ranked = ranked.withColumn("weight", weight).withColumn("limit", F.col("source_size") * F.lit(float(most_times)))
    everything = Window.partitionBy()
    earlier = Window.orderBy(F.col("limit") / F.col("weight"), "sid").rowsBetween(Window.unboundedPreceding, -1)
    levels = (
        ranked.withColumn("goal", F.sum("source_size").over(everything) * F.lit(float(total_share)))
        .withColumn("spent", F.coalesce(F.sum("limit").over(earlier), F.lit(0.0)))
        .withColumn("open", F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(earlier), F.lit(0.0)))
        .withColumn("level", (F.col("goal") - F.col("spent")) / F.col("open"))
        # the first source that stays below its limit fixes the level; the ones before it are capped
        .withColumn("place", F.struct(F.col("limit") / F.col("weight"), "sid", "level"))
        .withColumn("level", F.min(F.when(F.col("level") * F.col("weight") <= F.col("limit"), F.col("place"))).over(everything)["level"])
    )
    target = F.least(F.col("limit"), F.coalesce(F.col("level") * F.col("weight"), F.col("limit")))
    return levels.select("source", "sid", "source_size", target.alias("target"))


def _needs(plan: DataFrame, block: int) -> DataFrame:
    """Blocks a source has, words it owes and slots it needs for them; a source of no words needs none."""
    some = F.col("source_size") > 0
    size = F.greatest(F.col("source_size"), F.lit(1))
    words = F.round("target").cast("long")
    passes = F.floor(F.col("words") / size)
    rest = F.col("words") - passes * size
    return (
        plan.withColumn("words", F.when(some, words).otherwise(F.lit(0)))
        .withColumn("blocks", F.ceil(size / F.lit(block)))
        .withColumn("needed", (passes * F.col("blocks") + F.ceil(rest / F.lit(block))).cast("long"))
    )


def schedule(plan: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(sid, rank, slot): whose turn each slot is, and the how-manieth; ``plan`` is a stored ``targets`` table.

    A source gets the slots its target needs. Slots past that are dropped; the few that the sequence leaves a source
    short of, a number that grows with the logarithm of the slots, follow at the end.
    """
    needs = _needs(plan, block_words)
    n = (plan.agg(F.sum(F.ceil(F.col("target") / block_words))).first()[0] or 0) + 1
    upto = Window.orderBy("sid")
    share = needs.withColumn("hi", F.sum("target").over(upto)).withColumn("all", F.sum("target").over(Window.partitionBy()))
    share = share.where("target > 0").select("sid", ((F.col("hi") - F.col("target")) / F.col("all")).alias("lo"), (F.col("hi") / F.col("all")).alias("hi"))
    last = F.max("hi").over(Window.partitionBy())  # rounding must not leave a gap below 1
    share = share.withColumn("hi", F.when(F.col("hi") == last, F.lit(1.0)).otherwise(F.col("hi")))
    cells = share.withColumn("cell", F.explode(F.sequence(F.floor(F.col("lo") * GRID), F.least(F.floor(F.col("hi") * GRID), F.lit(GRID - 1)))))
    point = (F.pmod(F.col("id"), F.lit(PERIOD)) * F.lit(GOLDEN)) % F.lit(PERIOD) / F.lit(float(PERIOD))
    slots = plan.sparkSession.range(n).select(F.col("id").alias("slot"), point.alias("u"))
    slots = slots.withColumn("cell", F.floor(F.col("u") * GRID)).join(cells, "cell").where("u >= lo and u < hi")
    slots = slots.select("sid", "slot", F.expr(f"slot div {CHUNK_SLOTS}").alias("chunk"))
    counts = slots.groupBy("sid", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("sid").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.withColumn("shift", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("sid", "chunk").orderBy("slot")) - 1 + F.col("shift")
    dealt = slots.join(shifts, ["sid", "chunk"]).select("sid", rank.alias("rank"), "slot")
    dealt = dealt.join(needs.select("sid", "needed"), "sid").where("rank < needed").drop("needed")
    got = counts.groupBy("sid").agg(F.sum("n").alias("got"))
    short = needs.join(got, "sid", "left").withColumn("got", F.coalesce("got", F.lit(0))).where("got < needed")
    closing = short.select("sid", F.explode(F.sequence(F.col("got"), F.col("needed") - 1)).alias("rank"))
    return dealt.unionByName(closing.withColumn("slot", F.lit(n) + F.col("rank")))


def _streams(sizes: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document's place in its source's stream: sid, start; documents without words take no place."""
    buckets = max(1, sizes.count() // BUCKET_ROWS)
    h = F.xxhash64(F.lit(17), "doc_id", "size")
    rows = (
        sizes.where("size > 0")
        .join(plan.select("source", "sid"), sizes["source"].eqNullSafe(plan["source"]))
        .select("uid", "doc_id", "sid", "size", h.alias("h"), F.pmod(F.xxhash64(h), F.lit(buckets)).alias("bucket"))
    )
    sums = rows.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sums.select("sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "uid").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("shift") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    return rows.join(shifts, ["sid", "bucket"]).select("uid", "sid", "size", start.alias("start"))


def mixed_pieces(sizes: DataFrame, plan: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """(uid, slot, pass, first, words): the words of a document that a slot takes; ``first`` counts from 0 within it."""
    b = F.lit(block_words)
    pieces = (
        _streams(sizes, plan)
        .withColumn("end", F.col("start") + F.col("size"))
        .withColumn("block", F.explode(F.sequence(F.expr(f"start div {block_words}"), F.expr(f"(end - 1) div {block_words}"))))
        .withColumn("from", F.greatest(F.col("start") - F.col("block") * b, F.lit(0)))
        .withColumn("to", F.least(F.col("end") - F.col("block") * b, b))
    )
    needs = _needs(plan, block_words).select("sid", "blocks", "words", "source_size")
    slots = (
        schedule(plan, block_words=block_words)
        .join(needs, "sid")
        .select(
            "sid", "slot", F.expr("rank div blocks").alias("pass"), (F.col("rank") % F.col("blocks")).alias("block"), "words", "source_size"
        )
        # the slot that reaches the target ends there
        .withColumn("limit", F.least(b, F.col("words") - F.col("pass") * F.col("source_size") - F.col("block") * b))
        .drop("words", "source_size")
    )
    taken = F.least(F.col("to"), F.col("limit")) - F.col("from")
    return (
        pieces.join(slots, ["sid", "block"])
        .where(taken > 0)
        .select("uid", "slot", "pass", (F.col("block") * b + F.col("from") - F.col("start")).alias("first"), taken.alias("words"))
    )


def mix(docs: DataFrame, *, block_words: int = BLOCK_WORDS, total_share: float = 1.5, most_times: float = 2.0) -> DataFrame:
    """Words the mix takes from every row of ``docs``: doc_id, size, source_size, target, taken (repeats counted), and its
    place in the schedule: slots (how many take words of it), first_slot and last_slot (null where none does).

    Every source gives its target, rounded to a word; no document is taken more than ``most_times`` times. Documents
    without words, and null texts, have size and taken 0. Null sources form a source of their own, which is last in the
    weight order. Repeated rows are separate documents. Reruns agree: the order is a hash of doc_id and size.
    """
    sizes = sized(docs)
    plan = store(targets(sizes, total_share=total_share, most_times=most_times), "mix-plan")
    pieces = mixed_pieces(sizes, plan, block_words=block_words).select(
        "uid",
        F.lit(None).cast(sizes.schema["doc_id"].dataType).alias("doc_id"),
        F.lit(None).cast("string").alias("source"),
        F.lit(None).cast("long").alias("size"),
        "words",
        "slot",
    )
    rows = sizes.select("uid", "doc_id", "source", "size", F.lit(0).cast("long").alias("words"), F.lit(None).cast("long").alias("slot"))
    taken = (
        rows.unionByName(pieces)
        .groupBy("uid")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.max("source").alias("source"),
            F.max("size").alias("size"),
            F.sum("words").alias("taken"),
            F.count("slot").alias("slots"),
            F.min("slot").alias("first_slot"),
            F.max("slot").alias("last_slot"),
        )
    )
    by_source = plan.select(F.col("source").alias("name"), "source_size", "target")
    named = taken.join(by_source, taken["source"].eqNullSafe(by_source["name"]))
    return named.select("doc_id", "size", "source_size", "target", "taken", "slots", "first_slot", "last_slot")


def _leading_words(text: Column, n: Column) -> Column:
    """The first ``n`` words with the white space between them."""
    parts = F.regexp_extract_all(text, F.lit(rf"([\x20\x09-\x0D]*{WORD})"), F.lit(1))
    return F.array_join(F.slice(parts, F.lit(1), n.cast("int")), "")


def mixed_documents(docs: DataFrame, *, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The mix as rows of ``docs``: a row per document and pass, its text cut after the last word taken.

    A pass takes a document's leading words, all of them but where a source's target ends. ``n_chars`` follows the text.
    """
    kept = store(docs.select(F.struct(*docs.columns).alias("row"), F.monotonically_increasing_id().alias("uid")), "mix-docs")
    sizes = sized(kept.select("uid", "row.doc_id", "row.source", "row.text"), F.col("uid"))
    plan = store(targets(sizes), "mix-plan")
    passes = mixed_pieces(sizes, plan, block_words=block_words).groupBy("uid", "pass").agg(F.sum("words").alias("taken"))
    passes = passes.join(sizes.select("uid", F.col("size").alias("whole")), "uid")
    full = F.col("row.text")
    text = F.when(F.col("taken") < F.col("whole"), _leading_words(full, F.col("taken"))).otherwise(full)
    new = {"text": text, "n_chars": F.char_length(text)}
    cells = [new[c].cast(docs.schema[c].dataType) if c in new else F.col(f"row.`{c}`") for c in docs.columns]
    return kept.join(passes, "uid").select(*[cell.alias(c) for cell, c in zip(cells, docs.columns, strict=True)])
