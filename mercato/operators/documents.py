"""Keyed document tables as DataFrames, and the nested read models built from the source tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mercato.functions.scalar import delay_days, money
from mercato.operators.quality import unique_violations
from mercato.operators.skew import skew_join
from mercato.schemas import READ_MODELS

# --- table operations --------------------------------------------------------------------------------------------


def insert(table: DataFrame, rows: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Append rows; columns absent on one side are null. With ``keys``, a key stored twice is an error."""
    merged = table.unionByName(rows, allowMissingColumns=True)
    if keys and not unique_violations(merged, keys).isEmpty():
        raise ValueError(f"duplicate key in {keys}")
    return merged


def _first_match(df: DataFrame, predicate: Column, first_by: list[str]) -> Column:
    """True on the row that comes first among the matches; ``first_by`` must identify a row."""
    first = df.filter(predicate).agg(F.min(F.struct(*first_by))).scalar()
    return F.coalesce(predicate & F.struct(*first_by).eqNullSafe(first), F.lit(False))


def update(df: DataFrame, predicate: Column, sets: dict[str, Column], first_by: list[str] | None = None) -> DataFrame:
    """Set fields on every match, or on the first one in the order of ``first_by``. New fields are added."""
    hit = _first_match(df, predicate, first_by) if first_by else F.coalesce(predicate, F.lit(False))
    return df.withColumns(
        {c: F.when(hit, v).otherwise(F.col(c)) if c in df.columns else F.when(hit, v) for c, v in sets.items()}
    )


def delete(df: DataFrame, predicate: Column, first_by: list[str] | None = None) -> DataFrame:
    """Remove every match, or the first one. A predicate that is unknown for a row does not match it."""
    hit = _first_match(df, predicate, first_by) if first_by else F.coalesce(predicate, F.lit(False))
    return df.filter(~hit)


def _merge_frame(table: DataFrame, rows: DataFrame, keys: list[str], seq: str | None, given: str | None) -> DataFrame:
    """Fold the incoming rows per key, field by field, and put them beside the stored document."""
    fields = [c for c in rows.columns if c not in keys and c not in (seq, given)]
    # rows that tie, or have no order at all, are ranked by hashes of the whole row, once per row: values of two rows are
    # not mixed, and a maximum holds 12 bytes beside its sequence and value, however wide the row is
    whole = F.to_json(F.struct(*rows.columns))
    rows = rows.withColumn("_rank", F.struct((F.col(seq) if seq else F.lit(0)).alias("s"), F.xxhash64(whole).alias("x"), F.hash(whole).alias("h")))
    order = F.col("_rank")
    aggregates = [F.count(F.lit(1)).alias("_ops")]
    for c in fields:
        present = F.array_contains(given, c) if given else F.lit(True)
        # nulls sort first in a struct, so the value is wrapped: an explicit null still wins by its sequence
        last = F.max(F.when(present, F.struct(order.alias("s"), F.col(c).alias("v"))))
        aggregates += [last["v"].alias(f"_n_{c}"), (F.count_if(present) > 0).alias(f"_p_{c}")]
    keyed = rows.filter(reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys]))
    folded = keyed.groupBy(*keys).agg(*aggregates)
    stored = table.withColumn("_stored", F.lit(True))
    return stored.join(folded, keys, "full_outer")


def upsert(
    table: DataFrame, rows: DataFrame, keys: list[str], seq: str | None = None, given: str | None = None
) -> tuple[DataFrame, DataFrame] | None:
    """Bulk upsert with merge: a field named by a row overwrites, also with null; other fields survive.

    ``seq`` orders rows of the same key (later wins per field); of rows that tie, or without ``seq``, one is taken whole,
    the same on every run. ``given`` is an optional array column with the names of
    the fields a row carries; without it a row carries all its columns. Rows that lack a key are rejected, as their
    query would match an arbitrary document. No rows at all give None.

    Returns (table, stats); stats counts ``matched`` operations, ``upserted`` documents, ``modified`` documents (ones
    whose content changed, each once) and ``rejected`` rows.
    """
    if rows.isEmpty():
        return None
    fields = [c for c in rows.columns if c not in keys and c not in (seq, given)]
    frame = _merge_frame(table, rows, keys, seq, given)
    all_columns = [*table.columns, *[c for c in fields if c not in table.columns]]

    def merged(c: str) -> Column:
        if c in keys or c not in fields:
            return F.col(c)
        old = F.col(c) if c in table.columns else F.lit(None).cast(rows.schema[c].dataType)
        return F.when(F.coalesce(F.col(f"_p_{c}"), F.lit(False)), F.col(f"_n_{c}")).otherwise(old)

    result = frame.select(*[merged(c).alias(c) for c in all_columns])

    def changes(c: str) -> Column:
        before = F.col(c) if c in table.columns else F.lit(None).cast(rows.schema[c].dataType)
        return F.coalesce(F.col(f"_p_{c}"), F.lit(False)) & ~F.col(f"_n_{c}").eqNullSafe(before)

    touched = F.col("_ops").isNotNull()
    known = F.col("_stored").isNotNull()
    changed = reduce(lambda a, b: a | b, [changes(c) for c in fields], F.lit(False))
    no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    stats = frame.agg(
        F.coalesce(F.sum(F.when(touched, F.col("_ops") - F.when(known, 0).otherwise(1))), F.lit(0)).alias("matched"),
        F.count_if(touched & ~known).alias("upserted"),
        F.count_if(touched & known & changed).alias("modified"),
    ).withColumn("rejected", rows.agg(F.count_if(no_key)).scalar())
    return result, stats


# --- read models -------------------------------------------------------------------------------------------------

PART_ITEMS = 10_000  # item numbers that share a document


def part_of(number: Column | str, part_items: int = PART_ITEMS) -> Column:
    """The part of a document that the child with this number (from 1) is in: one rule, whatever the document's size."""
    number = F.col(number) if isinstance(number, str) else number
    return F.coalesce(F.floor((number - 1) / F.lit(part_items)), F.lit(0)).cast("int")


def embed(
    df: DataFrame,
    key: str,
    element: Column,
    order: list[str],
    name: str,
    number: Column | str,
    part_items: int = PART_ITEMS,
    **sums: Column,
) -> DataFrame:
    """Sorted array of child structs per key and part, with aggregates of the same rows on request.

    A document store refuses unlimited documents and a task cannot hold an unlimited group, so children numbered 1 to
    ``part_items`` are in part 0, the next ones in part 1, and so on. Every child is kept; the part follows from its
    number alone, so it is the same on every partitioning.
    """
    placed = F.struct(*[F.col(o).alias(f"_o{i}") for i, o in enumerate(order)], element.alias("e"))
    return (
        df.withColumn("part", part_of(number, part_items))
        .groupBy(key, "part")
        .agg(F.sort_array(F.collect_list(placed)).alias("_a"), *[c.alias(n) for n, c in sums.items()])
        .select(key, "part", F.transform("_a", lambda x: x["e"]).alias(name), *sums)
    )


def payment_summary(payments: DataFrame) -> DataFrame:
    """Per order: total paid and the type of the largest payment (ties by type name)."""
    return payments.groupBy("order_id").agg(
        F.sum(money("payment_value")).alias("total_payment_value"),
        F.max(F.struct("payment_value", "payment_type"))["payment_type"].alias("primary_payment_type"),
    )


def order_analytics(
    orders: DataFrame,
    customers: DataFrame,
    lines: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    number: str = "item_no",
) -> DataFrame:
    """Order analytics documents, one row per order (and part, for an order with very many items).

    The totals of an order stand on its first part only, so that a sum over documents counts them once.

    Every child table is reduced to one row per order before it is joined, so items and payments do not multiply each
    other. ``lines``: order_id, product_id, category, seller_id, price, freight; ``orders`` also has status, order_date,
    estimated and actual.
    """
    item = F.struct(
        F.col("product_id").alias("productId"),
        F.col("category").alias("categoryName"),
        F.col("category").alias("categoryNameEnglish"),
        F.col("seller_id").alias("sellerId"),
        F.col("price"),
        F.col("freight").alias("freightValue"),
    )
    items = embed(
        lines, "order_id", item, ["product_id", "seller_id", "price", "freight"], "items", number,
        value=F.sum(money("price")), n=F.count(F.lit(1)),
    )
    totals = items.groupBy("order_id").agg(
        F.min("part").alias("head"), F.sum("value").alias("total_item_value"), F.sum("n").cast("int").alias("item_count")
    )
    score = reviews.groupBy("order_id").agg(F.max("score").alias("review_score"))
    totalled = ("total_item_value", "item_count", "total_payment_value")
    return (
        skew_join(orders, customers.select("customer_id", "customer_state", "customer_city"), ["customer_id"], "left", spread_by=["order_id"])
        .join(totals, "order_id", "left")
        .join(payment_summary(payments), "order_id", "left")
        .join(score, "order_id", "left")
        .join(items.drop("value", "n"), "order_id", "left")
        .withColumn("part", F.coalesce("part", F.lit(0)))
        .withColumns({c: F.when(F.coalesce(F.col("part") == F.col("head"), F.lit(True)), F.col(c)) for c in totalled})
        .withColumn("delivery_delay_days", delay_days("estimated", "actual"))
        .select(
            F.col("order_id").alias("orderId"),
            "part",
            F.col("customer_id").alias("customerId"),
            F.col("customer_state").alias("customerState"),
            F.col("customer_city").alias("customerCity"),
            F.col("status").alias("orderStatus"),
            F.col("order_date").alias("purchaseTimestamp"),
            F.col("actual").alias("deliveredDate"),
            F.col("estimated").alias("estimatedDeliveryDate"),
            "items",
            F.col("total_payment_value").alias("totalPaymentValue"),
            F.col("primary_payment_type").alias("primaryPaymentType"),
            F.col("review_score").alias("reviewScore"),
            F.col("delivery_delay_days").alias("deliveryDelayDays"),
            F.col("total_item_value").alias("totalItemValue"),
            F.col("item_count").alias("itemCount"),
        )
    )


def order_documents(docs: DataFrame) -> DataFrame:
    """The documents of ``order_analytics`` as the read model stores them: its fields and types, exact money, no ``part``.

    Further parts of an order with very many items are documents of their own, with ``#`` and the part after the order's
    id. An amount that the model's type cannot hold is null.
    """
    fields = {f.name: f.dataType for f in READ_MODELS["order_analytics"].fields}
    key = F.col("orderId").cast("string")
    numbered = F.when(F.col("part") == 0, key).otherwise(F.concat_ws("#", key, "part"))
    sums = {c: F.col(c).try_cast(fields[c]) for c in ("totalPaymentValue", "totalItemValue")}
    return as_read_model(docs, "order_analytics", orderId=numbered, items=F.col("items").try_cast(fields["items"]), **sums)


def find_embedded(
    children: DataFrame, key: str, predicate: Column, element: Column, order: list[str], name: str, number: Column | str
) -> DataFrame:
    """Documents with an embedded child that matches; see ``embed``.

    The children are filtered by themselves first, so only documents that are found are built.
    """
    hits = children.filter(predicate).select(key).distinct()
    return embed(skew_join(children, hits, [key], "left_semi"), key, element, order, name, number)


def order_doc(
    orders: DataFrame,
    items: DataFrame,
    payments: DataFrame,
    reviews: DataFrame,
    item_fields: list[str],
    payment_fields: list[str],
    review_fields: list[str],
) -> DataFrame:
    """Order documents with embedded items[], payments[] and the latest review (review fields order by the first).

    The first item field and the first payment field are the numbers within the order, from 1.
    """
    items_part = embed(items, "order_id", F.struct(*item_fields), item_fields, "items", item_fields[0])
    pays = embed(payments, "order_id", F.struct(*payment_fields), payment_fields, "payments", payment_fields[0])
    review = reviews.groupBy("order_id").agg(F.max(F.struct(*review_fields)).alias("review"))
    # items and payments meet part by part; a part present on one side only keeps the other array null
    children = items_part.join(pays, ["order_id", "part"], "full_outer")
    return (
        orders.join(children, "order_id", "left")
        .join(review, "order_id", "left")
        .withColumn("part", F.coalesce("part", F.lit(0)))
    )


def as_read_model(df: DataFrame, model: str, names: dict[str, str] | None = None, **given: Column) -> DataFrame:
    """``df`` with the fields, order and types of a read model.

    A field is a column of its own name, of the name that ``names`` maps it to, or an expression in ``given``, such as
    ``lastUpdated=as_of``.
    """
    names = names or {}
    fields = READ_MODELS[model].fields
    return df.select(*[given.get(f.name, F.col(names.get(f.name, f.name))).cast(f.dataType).alias(f.name) for f in fields])


SELLER_NAMES = {
    "sellerId": "seller_id", "sellerCity": "seller_city", "sellerState": "seller_state", "totalOrders": "total_orders", "totalRevenue": "total_revenue",
    "avgReviewScore": "avg_review_score", "totalProductsSold": "total_products_sold", "onTimeDeliveryRate": "on_time_delivery_rate",
}


def explode_items(docs: DataFrame, key: str, array: str = "items") -> DataFrame:
    """Back from embedded arrays to one row per element."""
    return docs.select(key, F.inline(array))
