"""Change feed to read model: decode envelopes, set bad messages aside, fold changes per key."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.scalar import image_field, micros_to_timestamp
from mercato.schemas import CHANGE_ENVELOPE

_PARSE = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}


def decode_cdc(df: DataFrame, column: str = "value") -> DataFrame:
    """Add ``payload`` (before, after, op, ts_ms) and ``_corrupt_record`` from the JSON text; the text stays.

    Unknown fields are ignored. Row images are maps of strings, so a number keeps its digits whatever its size.
    """
    schema = T.StructType([*CHANGE_ENVELOPE.fields, T.StructField("_corrupt_record", T.StringType())])
    parsed = F.from_json(F.col(column).cast("string"), schema, _PARSE)
    # generated columns: a later filter on them is not pushed below, where it would parse the text a second time
    return df.select("*", F.inline(F.array(parsed)))


def valid_cdc(decoded: DataFrame) -> DataFrame:
    """Messages that carry a row image after the change; deletes carry none and are dropped here."""
    return decoded.filter(F.col("payload.after").isNotNull() & (F.size("payload.after") > 0))


def bad_reason(key: str, timestamp_field: str | None = None) -> Column:
    """Why a message cannot be applied, or null: malformed, missing_key, wrong_type."""
    after = F.col("payload.after")
    has_image = after.isNotNull() & (F.size(after) > 0)
    reason = F.when(F.col("_corrupt_record").isNotNull(), "malformed").when(
        has_image & image_field(after, key).isNull(), "missing_key"
    )
    if timestamp_field:
        raw = image_field(after, timestamp_field)
        reason = reason.when(has_image & raw.isNotNull() & raw.try_cast("bigint").isNull(), "wrong_type")
    return reason


def split_bad(
    decoded: DataFrame, key: str = "order_id", timestamp_field: str | None = "order_purchase_timestamp"
) -> tuple[DataFrame, DataFrame]:
    """(usable messages, dead letters with a reason). A message without a payload is neither: it is just skipped."""
    return split_tagged(tag_bad(decoded, key, timestamp_field))


def tag_bad(decoded: DataFrame, key: str = "order_id", timestamp_field: str | None = "order_purchase_timestamp") -> DataFrame:
    """Add ``reason``, null where a message can be applied."""
    return decoded.withColumn("reason", bad_reason(key, timestamp_field))


def split_tagged(tagged: DataFrame) -> tuple[DataFrame, DataFrame]:
    ok = tagged.filter(F.col("reason").isNull() & F.col("payload").isNotNull()).drop("reason", "_corrupt_record")
    return ok, tagged.filter(F.col("reason").isNotNull())


def order_changes(ok: DataFrame, seq: list[str], keep: tuple[Column, ...] = ()) -> DataFrame:
    """Typed order changes: order_id, op, customer_id, order_status, purchase_ts, seq (struct of ``seq`` columns), ``keep``."""
    after, before = F.col("payload.after"), F.col("payload.before")
    return ok.select(
        F.coalesce(image_field(after, "order_id"), image_field(before, "order_id")).alias("order_id"),
        F.col("payload.op").alias("op"),
        (after.isNotNull() & (F.size(after) > 0)).alias("has_image"),
        image_field(after, "customer_id").alias("customer_id"),
        image_field(after, "order_status").alias("order_status"),
        micros_to_timestamp(image_field(after, "order_purchase_timestamp", "bigint")).alias("purchase_ts"),
        image_field(before, "order_status").alias("old_status"),
        F.struct(*seq).alias("seq"),
        *keep,
    )


MESSAGES_PER_TASK = 200_000


def tagged_changes(batch: DataFrame, offset: str = "kafka_offset") -> DataFrame:
    """Typed changes, and dead letters with a ``reason`` and their text ``value``, of a micro-batch: small rows to be stored.

    Text and row images, some 700 bytes a message, are not kept of what can be applied, and a task has at most about
    ``MESSAGES_PER_TASK`` messages however large the files are that a batch consists of.
    """
    parts = math.ceil(batch.count() / MESSAGES_PER_TASK)
    dealt = batch.repartition(max(parts, batch.sparkSession.sparkContext.defaultParallelism)) if parts > 1 else batch
    tagged = tag_bad(decode_cdc(dealt)).filter(F.col("reason").isNotNull() | F.col("payload").isNotNull())
    text = F.when(F.col("reason").isNotNull(), F.col("value")).alias("value")
    return order_changes(tagged.withColumn("ts_ms", F.col("payload.ts_ms")), ["ts_ms", offset], (F.col("reason"), text))


def fold_changes(changes: DataFrame) -> DataFrame:
    """One row per order: customer and status of the last change (null included), the last known purchase time.

    Both are struct maxima over the sequence, which combine map-side: an order changed a billion times is no hot group.
    """
    last = F.max(F.struct("seq", "customer_id", "order_status"))
    last_ts = F.max(F.when(F.col("purchase_ts").isNotNull(), F.struct("seq", "purchase_ts")))
    return changes.groupBy("order_id").agg(
        last["customer_id"].alias("customer_id"),
        last["order_status"].alias("order_status"),
        last_ts["purchase_ts"].alias("purchase_ts"),
    )


def change_rows(changes: DataFrame) -> DataFrame:
    """Changes as rows of a keyed table that ``merge_changes`` folds: every field beside the sequence it comes from."""
    return changes.select("order_id", "seq", "customer_id", "order_status", F.when(F.col("purchase_ts").isNotNull(), F.col("seq")).alias("ts_seq"), "purchase_ts")


def merge_changes(rows: DataFrame) -> DataFrame:
    """One row per order, as ``fold_changes`` keeps it, that later rows can be merged into; replays change nothing."""
    last = F.max(F.struct("seq", "customer_id", "order_status"))
    known = F.max(F.when(F.col("ts_seq").isNotNull(), F.struct("ts_seq", "purchase_ts")))
    folded = rows.groupBy("order_id").agg(last.alias("_last"), known.alias("_known"), F.max("_batch").alias("_batch"))
    return folded.select("order_id", "_last.*", F.col("_known.ts_seq"), F.col("_known.purchase_ts"), "_batch")


def apply_cdc(state: DataFrame, changes: DataFrame, deletes: str = "ignore") -> DataFrame:
    """Upsert order changes into the read model (order_id, customer_id, order_status, purchase_ts, other fields).

    Customer and status are overwritten even with null, the purchase time only by a known one; other fields of the
    stored document stay. ``deletes="ignore"`` keeps deleted orders; ``"apply"`` removes them, and a later change starts
    a new document.
    """
    writes = changes.filter(F.col("has_image"))
    if deletes == "apply":
        gone = (
            changes.filter((F.col("op") == "d") & F.col("order_id").isNotNull())
            .groupBy("order_id")
            .agg(F.max("seq").alias("_deleted"))
        )
        state = state.join(gone, "order_id", "left_anti")
        writes = (
            writes.join(gone, "order_id", "left")
            .filter(F.col("_deleted").isNull() | (F.col("seq") > F.col("_deleted")))
            .drop("_deleted")
        )
    folded = fold_changes(writes).select(
        "order_id",
        F.col("customer_id").alias("_customer"),
        F.col("order_status").alias("_status"),
        F.col("purchase_ts").alias("_ts"),
        F.lit(True).alias("_changed"),
    )
    changed = F.coalesce("_changed", F.lit(False))
    rest = [c for c in state.columns if c not in ("order_id", "customer_id", "order_status", "purchase_ts")]
    return state.join(folded, "order_id", "full_outer").select(
        "order_id",
        F.when(changed, F.col("_customer")).otherwise(F.col("customer_id")).alias("customer_id"),
        F.when(changed, F.col("_status")).otherwise(F.col("order_status")).alias("order_status"),
        F.coalesce("_ts", "purchase_ts").alias("purchase_ts"),
        *rest,
    )


# Schema of an empty order read model.
ORDER_STATE = "order_id string, customer_id string, order_status string, purchase_ts timestamp"


def order_events(changes: DataFrame) -> DataFrame:
    """Domain events: ORDER_CREATED, ORDER_DELIVERED when the status first becomes delivered, else ORDER_UPDATED.

    Event ids are hashes of key and sequence, so replaying a feed gives the same ids.
    """
    delivered = (F.col("order_status") == "delivered") & ~F.col("old_status").eqNullSafe(F.lit("delivered"))
    kind = (
        F.when(F.col("op") == "c", "ORDER_CREATED")
        .when((F.col("op") == "u") & delivered, "ORDER_DELIVERED")
        .when(F.col("op") == "u", "ORDER_UPDATED")
    )
    return (
        changes.filter(F.col("has_image"))
        .select(
            F.sha2(F.concat_ws("|", "order_id", F.to_json("seq")), 256).alias("eventId"),
            kind.alias("eventType"),
            F.col("order_id").alias("orderId"),
            F.col("customer_id").alias("customerId"),
            F.col("order_status").alias("orderStatus"),
            F.timestamp_millis(F.col("seq.ts_ms")).alias("eventTimestamp"),
            F.create_map(
                F.lit("old_status"), F.col("old_status"), F.lit("new_status"), F.col("order_status")
            ).alias("payload"),
        )
        .filter(F.col("eventType").isNotNull())
    )
