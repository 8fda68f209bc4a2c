"""What filters do to a corpus in every order they can run in, by higher-order folds over counted failure masks.

A document is reduced to the set of filters it fails, so a part of the corpus is at most 2^filters cells for each mark.
Every cell folds the orders, a literal array that goes to all tasks with the plan, into one structure per order and step,
weighted by its count; the cells of a part are then added up place by place.
"""

from __future__ import annotations

import itertools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.llm.common import WORD, text_of

COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
SALTS = 1 << 16


def text_filters(text: Column) -> dict[str, Column]:
    """Failure conditions that read the text alone; words are compared case-sensitively."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    n, different = F.size(words), F.size(F.array_distinct(words))
    return {
        "A": n < 100,
        "B": 100 * different.cast("long") < 80 * n.cast("long"),
        "C": 100 * F.regexp_count(text, F.lit("[A-Z]")).cast("long") > 10 * F.char_length(text).cast("long"),
        "D": text.rlike("[#$%&*|]"),
    }


def failure_cells(
    docs: DataFrame, labels: DataFrame, *, filters: Mapping[str, Column] | None = None, copies: str | None = "E", part: str = "lang"
) -> DataFrame:
    """(part, mask, good, toxic, n): documents by part of the corpus, failed filters (bit i: filter i) and labels.

    ``filters`` (default: ``text_filters``) are failure conditions over the columns of ``docs`` with ``text`` not null;
    a null condition is no failure. ``copies`` names one more filter, the last bit: documents whose text stands under a
    smaller doc_id. Rows without doc_id are no copies and have no labels, rows that repeat a doc_id are documents of
    their own, and of labels that repeat one any 1 counts.

    Texts are compared by their SHA-256. Copies agree in all other filters, so the rows of a text are counted before
    they meet and no text, id or source is gathered in one task.
    """
    rows = docs.withColumn("text", text_of())
    failed = dict(filters if filters is not None else text_filters(F.col("text")))
    bits = [F.when(condition, F.lit(1 << i)).otherwise(F.lit(0)) for i, condition in enumerate(failed.values())]
    mask = sum(bits[1:], bits[0]) if bits else F.lit(0)
    # the salt spreads rows without id, which meet no label
    salt = F.when(F.col("id").isNull(), F.pmod(F.xxhash64("print"), F.lit(SALTS))).otherwise(F.lit(0).cast("long"))
    narrow = rows.select(
        F.col("doc_id").alias("id"), F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), mask.alias("mask"),
        F.unhex(F.sha2(F.col("text").cast("binary"), 256)).alias("print"),
    )
    one = lambda c: F.max(F.coalesce(F.col(c) == 1, F.lit(False))).alias(c)
    known = labels.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).agg(one("quality"), one("toxic"))
    marked = narrow.withColumn("salt", salt).join(known.withColumn("salt", F.lit(0).cast("long")), ["id", "salt"], "left")
    marks = [F.coalesce("quality", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic")]
    same_id = marked.select("id", "part", "mask", "print", *marks).groupBy("id", "part", "mask", "print", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))
    keys = ["part", "mask", "good", "toxic"]
    if copies is None:
        return same_id.groupBy(*keys).agg(F.sum("n").alias("n"))
    # a text has a row per part and mark: its smallest id there, how many rows carry that id, rows with any id, rows with none
    by_text = same_id.groupBy("print", *keys).agg(
        F.min("id").alias("least"), F.min_by("n", "id").alias("first"),
        F.sum(F.when(F.col("id").isNotNull(), F.col("n")).otherwise(0)).alias("named"),
        F.sum(F.when(F.col("id").isNull(), F.col("n")).otherwise(0)).alias("nameless"),
    )
    least_of_all = by_text.groupBy("print").agg(F.min("least").alias("least_of_all"))
    originals = F.when(F.col("least") == F.col("least_of_all"), F.col("first")).otherwise(F.lit(0).cast("long"))
    split = by_text.join(least_of_all, "print").withColumn("originals", F.coalesce(originals, F.lit(0).cast("long")))
    copied = F.lit(1 << len(failed))
    counted = split.select(
        "part", "good", "toxic",
        F.inline(F.array(
            F.struct(F.col("mask").alias("mask"), (F.col("originals") + F.col("nameless")).alias("n")),
            F.struct(F.col("mask").bitwiseOR(copied).alias("mask"), (F.col("named") - F.col("originals")).alias("n")),
        )),
    )
    return counted.where("n > 0").groupBy(*keys).agg(F.sum("n").alias("n"))


def _folded(orders: Column) -> Column:
    """For one cell: per order a fold over its steps, all of them in one array of structures."""
    zero = F.lit(0).cast("long")
    counted = lambda condition: F.when(condition, F.col("n")).otherwise(zero)

    def step(state: Column, f: Column) -> Column:
        bit = F.call_function("shiftleft", F.lit(1), f)
        fails = F.col("mask").bitwiseAND(bit) != 0
        here = state["alive"] & fails
        row = F.struct(
            f.alias("f"),
            counted(state["alive"] & ~fails).alias("kept"),
            counted(here).alias("removed"),
            counted(~state["alive"] & fails).alias("redundant"),
            counted(F.col("mask") == bit).alias("unique_fails"),
            counted(here & F.col("good")).alias("good_lost"),
            counted(here & F.col("toxic")).alias("toxic_lost"),
        )
        return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["steps"], F.array(row)).alias("steps"))

    kind = "array<struct<f:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">>"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(kind).alias("steps"))
    return F.flatten(F.transform(orders, lambda order: F.aggregate(order, start, step, lambda state: state["steps"])))


def audit_orders(cells: DataFrame, names: Sequence[str]) -> DataFrame:
    """part, filter_order, step and the counts of every order of ``names`` (bit i of a mask: ``names[i]``), zeros included.

    kept: documents that pass up to this step; removed: those it removes; redundant: those that fail its filter but were
    removed before; unique_fails: those that fail its filter alone; good_lost and toxic_lost: labelled ones among removed;
    shapley: what the step's filter removes, summed over all orders. There is a row per part of ``cells``, order and
    step; no cells give no rows. All orders are tried, so their number is the factorial of the filters': seven at most.
    """
    if not 1 <= len(names) <= 7:
        raise ValueError(f"{len(names)} filters: between one and seven can be put in all orders")
    tried = list(itertools.permutations(range(len(names))))
    steps = len(names)
    orders = F.array(*[F.array(*[F.lit(f) for f in order]) for order in tried])
    folded = cells.select("part", _folded(orders).alias("steps"))
    add = lambda a, b: F.struct(a["f"].alias("f"), *[(a[c] + b[c]).alias(c) for c in COUNTS])
    merged = folded.groupBy("part").agg(F.collect_list("steps").alias("every"))  # as many as a part has cells: 2^filters marks apart
    total = F.aggregate(F.slice("every", 2, F.greatest(F.size("every") - 1, F.lit(0))), F.element_at("every", 1), lambda a, b: F.zip_with(a, b, add))
    sums = merged.select("part", total.alias("steps"))
    removed_of = lambda f: F.aggregate("steps", F.lit(0).cast("long"), lambda a, s: a + F.when(s["f"] == f, s["removed"]).otherwise(0))
    shares = sums.withColumn("shapley", F.array(*[removed_of(f) for f in range(steps)]))
    flat = shares.select("part", "shapley", F.posexplode("steps").alias("place", "s"))
    texts = F.array(*[F.lit("".join(names[f] for f in order)) for order in tried])
    return flat.select(
        "part", F.get(texts, F.expr(f"cast(place div {steps} as int)")).alias("filter_order"), (F.col("place") % steps + 1).cast("int").alias("step"),
        *[F.col(f"s.{c}").alias(c) for c in COUNTS], F.get("shapley", F.col("s.f")).alias("shapley"),
    )
