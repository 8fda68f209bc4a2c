"""Change feed and document table queries. The feed is derived from the orders table by Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from mercato.operators import cdc, documents
from mercato.plans import tables as t
from mercato.plans.registry import query, total
from mercato.sources.external import route

# Per order: a create; an update to the final status with no purchase time; for every third order an update that
# empties the customer; for every seventh a delete; for every eleventh broken text; for every thirteenth an image
# without a key; for every seventeenth a message with no payload; for every nineteenth an unreadable time.


def _message(op: str, after: Column | None, before: Column | None, ts_ms: Column) -> Column:
    image = F.lit(None).cast("map<string,string>")
    payload = F.struct(
        (before if before is not None else image).alias("before"),
        (after if after is not None else image).alias("after"),
        F.lit(op).alias("op"),
        ts_ms.alias("ts_ms"),
        F.lit("ignored").alias("source"),
    )
    return F.to_json(F.struct(payload.alias("payload")), {"ignoreNullFields": "false"})


def _image(customer: Column, status: Column, micros: Column, key: Column) -> Column:
    return F.create_map(
        F.lit("order_id"),
        key,
        F.lit("customer_id"),
        customer,
        F.lit("order_status"),
        status,
        F.lit("order_purchase_timestamp"),
        micros,
    )


def order_feed(spark: SparkSession, sf: str) -> DataFrame:
    """(topic, kafka_offset, value): change messages for every order, partitioned by key as a topic is."""
    df = t.orders(spark, sf).select("order_id", "customer_id", "status", "order_date").repartition("order_id")
    key, customer, none = F.col("order_id").cast("string"), F.col("customer_id").cast("string"), F.lit(None).cast("string")
    micros = (F.unix_micros(F.col("order_date").cast("timestamp")) + 123456).cast("string")
    at = F.unix_millis(F.col("order_date").cast("timestamp"))
    final = F.when(F.col("status") == "F", "delivered").when(F.col("status") == "O", "shipped").otherwise("processing")
    created = _image(customer, F.lit("created"), micros, key)
    updated = _image(customer, final, none, key)
    emptied = _image(none, final, none, key)

    def every(n: int, message: Column) -> Column:
        return F.when(F.col("order_id") % n == 0, message)

    steps = [
        _message("c", created, None, at),
        _message("u", updated, created, at + 1),
        every(3, _message("u", emptied, updated, at + 2)),
        every(7, _message("d", None, updated, at + 3)),
        every(11, F.concat(F.lit("junk "), key)),
        every(13, _message("u", F.create_map(F.lit("order_status"), F.lit("lost")), None, at)),
        every(17, F.to_json(F.struct(key.alias("order_id")))),
        every(19, _message("u", _image(customer, F.lit("lost"), F.lit("soon"), key), None, at)),
    ]
    numbered = F.array(*[F.struct(F.lit(i).alias("step"), m.alias("value")) for i, m in enumerate(steps)])
    return (
        df.select("order_id", F.explode(numbered).alias("m"))
        .filter(F.col("m.value").isNotNull())
        .select(
            F.lit("orders_raw").alias("topic"),
            (F.col("order_id") * 8 + F.col("m.step")).alias("kafka_offset"),
            F.col("m.value").alias("value"),
        )
    )


def _changes(spark: SparkSession, sf: str) -> DataFrame:
    ok, _ = cdc.split_bad(cdc.decode_cdc(order_feed(spark, sf)))
    return cdc.order_changes(
        ok.withColumn("ts_ms", F.col("payload.ts_ms")), ["ts_ms", "kafka_offset"]
    )


_FINAL = "CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped' ELSE 'processing' END"
_AT = "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') || '.123'"


def _state_text(df: DataFrame) -> DataFrame:
    return df.withColumn("purchase_ts", F.date_format("purchase_ts", "yyyy-MM-dd HH:mm:ss.SSS"))


@query(
    f"""
    SELECT o_orderkey * 8 + s AS kafka_offset, s IN (0, 1, 2, 5, 7) AS has_image, s = 4 AS malformed FROM orders, range(8) r(s)
    WHERE s < 2 OR o_orderkey % CAST([1, 1, 3, 7, 11, 13, 17, 19][s + 1] AS BIGINT) = 0
    """
)
def cdc1_decode(spark: SparkSession, sf: str) -> DataFrame:
    decoded = cdc.decode_cdc(order_feed(spark, sf))
    after = F.col("payload.after")
    return decoded.select(
        "kafka_offset",
        F.coalesce(F.size(after) > 0, F.lit(False)).alias("has_image"),
        F.col("_corrupt_record").isNotNull().alias("malformed"),
    )


@query(
    """
    SELECT CASE WHEN s < 2 THEN s WHEN s IN (2, 5, 7) THEN s END AS step, count(*) AS n FROM orders, range(8) r(s)
    WHERE s IN (0, 1) OR (s = 2 AND o_orderkey % 3 = 0) OR (s = 5 AND o_orderkey % 13 = 0) OR (s = 7 AND o_orderkey % 19 = 0) GROUP BY 1
    """
)
def flt4_valid_messages(spark: SparkSession, sf: str) -> DataFrame:
    valid = cdc.valid_cdc(cdc.decode_cdc(order_feed(spark, sf)))
    return valid.groupBy((F.col("kafka_offset") % 8).alias("step")).agg(F.count(F.lit(1)).alias("n"))


_STATE = f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS customer_id, {_FINAL} AS order_status, {_AT} AS purchase_ts FROM orders"


@query(_STATE)
def cdc2_deletes_ignored(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], cdc.ORDER_STATE)
    return _state_text(cdc.apply_cdc(empty, _changes(spark, sf)))


@query(f"{_STATE} WHERE o_orderkey % 7 <> 0")
def cdc2_deletes_applied(spark: SparkSession, sf: str) -> DataFrame:
    empty = spark.createDataFrame([], cdc.ORDER_STATE)
    return _state_text(cdc.apply_cdc(empty, _changes(spark, sf), deletes="apply"))


@query(
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS order_id, CASE WHEN o_orderkey % 3 <> 0 OR o_orderstatus = 'P' THEN CAST(o_custkey AS VARCHAR) END AS customer_id,
      CASE WHEN o_orderstatus = 'P' THEN 'stored' ELSE {_FINAL} END AS order_status,
      CASE WHEN o_orderstatus = 'P' THEN '1990-01-01 00:00:00.000' ELSE {_AT} END AS purchase_ts, o_totalprice AS total FROM orders
    """
)
def cdc3_upsert_into_state(spark: SparkSession, sf: str) -> DataFrame:
    """All orders are stored with one more field; the feed holds only orders that are not pending."""
    stored = t.orders(spark, sf).select(
        F.col("order_id").cast("string").alias("order_id"),
        F.col("customer_id").cast("string").alias("customer_id"),
        F.lit("stored").alias("order_status"),
        F.lit("1990-01-01").cast("timestamp").alias("purchase_ts"),
        "total",
    )
    open_orders = t.orders(spark, sf).filter("status <> 'P'").select(F.col("order_id").cast("string").alias("order_id"))
    fed = _changes(spark, sf).join(open_orders, "order_id", "left_semi")
    return _state_text(cdc.apply_cdc(stored, fed))


@query(
    """
    SELECT reason, count(*) AS n FROM (SELECT 'malformed' AS reason FROM orders WHERE o_orderkey % 11 = 0
      UNION ALL SELECT 'missing_key' FROM orders WHERE o_orderkey % 13 = 0
      UNION ALL SELECT 'wrong_type' FROM orders WHERE o_orderkey % 19 = 0) GROUP BY 1
    """
)
def cdc4_dead_letters(spark: SparkSession, sf: str) -> DataFrame:
    _, bad = cdc.split_bad(cdc.decode_cdc(order_feed(spark, sf)))
    return bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(f"SELECT CAST(o_orderkey AS VARCHAR) AS order_id, {_FINAL} AS order_status FROM orders")
def cdc5_out_of_order_arrival(spark: SparkSession, sf: str) -> DataFrame:
    """Messages shuffled over partitions still fold by (ts_ms, offset)."""
    shuffled = _changes(spark, sf).repartition(F.reverse("order_id"))
    return cdc.fold_changes(shuffled.filter("has_image")).select("order_id", "order_status")


@query(
    """
    WITH m AS (SELECT count(*) AS n FROM orders, range(8) r(s) WHERE s < 2 OR o_orderkey % CAST([1, 1, 3, 7, 11, 13, 17, 19][s + 1] AS BIGINT) = 0)
    SELECT 'orders_raw' AS topic, n FROM m UNION ALL SELECT 'payments_raw', n FROM m
    """
)
def cdc7_topic_routing(spark: SparkSession, sf: str) -> DataFrame:
    feed = order_feed(spark, sf)
    both = feed.unionByName(feed.withColumn("topic", F.lit("payments_raw")))
    parts = [route(both, name).groupBy("topic").agg(F.count(F.lit(1)).alias("n")) for name in ("orders_raw", "payments_raw")]
    return parts[0].unionByName(parts[1])


@query(
    f"""
    SELECT CAST(o_orderkey AS VARCHAR) AS "orderId", s AS step, CASE WHEN s = 0 THEN 'ORDER_CREATED' WHEN s = 1 AND o_orderstatus = 'F' THEN 'ORDER_DELIVERED'
      ELSE 'ORDER_UPDATED' END AS "eventType", CASE WHEN s = 0 THEN 'created' ELSE {_FINAL} END AS "orderStatus",
      CASE s WHEN 1 THEN 'created' WHEN 2 THEN {_FINAL} END AS old_status FROM orders, range(3) r(s) WHERE s < 2 OR o_orderkey % 3 = 0
    """
)
def cdc8_order_events(spark: SparkSession, sf: str) -> DataFrame:
    events = cdc.order_events(_changes(spark, sf))
    step = F.unix_millis("eventTimestamp") % 1000
    return events.select(
        "orderId", step.alias("step"), "eventType", "orderStatus", F.col("payload")["old_status"].alias("old_status")
    )


# --- document tables ---------------------------------------------------------------------------------------------


def _docs(spark: SparkSession, sf: str) -> DataFrame:
    return t.orders(spark, sf).select("order_id", "status", "total")


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total, NULL::VARCHAR AS note FROM orders WHERE o_orderstatus <> 'P' "
       "UNION ALL SELECT o_orderkey, o_orderstatus, NULL, 'late' FROM orders WHERE o_orderstatus = 'P'")
def doc1_insert(spark: SparkSession, sf: str) -> DataFrame:
    df = _docs(spark, sf)
    late = df.filter("status = 'P'").select("order_id", "status", F.lit("late").alias("note"))
    return documents.insert(df.filter("status <> 'P'"), late, ["order_id"])


@query(
    """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderstatus = 'P' THEN 'processing' ELSE o_orderstatus END AS status,
      CASE WHEN o_orderstatus = 'P' THEN o_totalprice * 2 ELSE o_totalprice END AS total, CASE WHEN o_orderstatus = 'P' THEN 'checked' END AS note FROM orders
    """
)
def doc2_update_many(spark: SparkSession, sf: str) -> DataFrame:
    sets = {"status": F.lit("processing"), "total": F.col("total") * 2, "note": F.lit("checked")}
    return documents.update(_docs(spark, sf), F.col("status") == "P", sets)


@query(
    """
    WITH f AS (SELECT o_orderkey AS k FROM orders WHERE o_orderstatus = 'P' ORDER BY o_totalprice, o_orderkey LIMIT 1)
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey = k THEN 'first' ELSE o_orderstatus END AS status, o_totalprice AS total FROM orders, f
    """
)
def doc3_update_one(spark: SparkSession, sf: str) -> DataFrame:
    return documents.update(_docs(spark, sf), F.col("status") == "P", {"status": F.lit("first")}, ["total", "order_id"])


@query("SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total FROM orders WHERE NOT (o_orderstatus = 'F' AND o_totalprice > 1000)")
def doc4_delete_many(spark: SparkSession, sf: str) -> DataFrame:
    return documents.delete(_docs(spark, sf), (F.col("status") == "F") & (F.col("total") > 1000))


@query(
    "SELECT o_orderkey AS order_id, o_orderstatus AS status, o_totalprice AS total FROM orders WHERE o_orderkey <> "
    "(SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F' ORDER BY o_totalprice, o_orderkey LIMIT 1)"
)
def doc4_delete_one(spark: SparkSession, sf: str) -> DataFrame:
    return documents.delete(_docs(spark, sf), F.col("status") == "F", ["total", "order_id"])


def _upsert_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Per customer order: two writes; the first names status and note, the second only the total. Orders of 1998 and
    later are new. Every ninth row lacks its key."""
    df = t.orders(spark, sf).select("order_id", "status", "total", "order_date")
    key = F.when(F.col("order_id") % 9 != 0, F.col("order_id"))
    first = df.select(key.alias("order_id"), F.lit("seen").alias("status"), F.lit(None).cast("double").alias("total"), F.col("status").alias("note"), F.lit(1).alias("seq"), F.array(F.lit("status"), F.lit("note")).alias("fields"))
    second = df.select(key.alias("order_id"), F.lit(None).cast("string").alias("status"), (F.col("total") + 1).alias("total"), F.lit(None).cast("string").alias("note"), F.lit(2).alias("seq"), F.array(F.lit("total")).alias("fields"))
    return first.unionByName(second)


_OLD = "o_orderdate < TIMESTAMP '1998-01-01'"


@query(
    f"""
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey % 9 <> 0 THEN 'seen' ELSE o_orderstatus END AS status,
      CASE WHEN o_orderkey % 9 <> 0 THEN o_totalprice + 1 ELSE o_totalprice END AS total, CASE WHEN o_orderkey % 9 <> 0 THEN o_orderstatus END AS note
    FROM orders WHERE {_OLD} OR o_orderkey % 9 <> 0
    """
)
def doc7_bulk_upsert(spark: SparkSession, sf: str) -> DataFrame:
    stored = t.orders(spark, sf).filter(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz")).select("order_id", "status", "total")
    table, _ = documents.upsert(stored, _upsert_rows(spark, sf), ["order_id"], "seq", "fields")
    return table


@query(
    f"""
    SELECT CAST(count(*) FILTER (WHERE {_OLD} AND o_orderkey % 9 <> 0) * 2 + count(*) FILTER (WHERE NOT {_OLD} AND o_orderkey % 9 <> 0) AS BIGINT) AS matched,
      count(*) FILTER (WHERE NOT {_OLD} AND o_orderkey % 9 <> 0) AS upserted, count(*) FILTER (WHERE {_OLD} AND o_orderkey % 9 <> 0) AS modified,
      CAST(count(*) FILTER (WHERE o_orderkey % 9 = 0) * 2 AS BIGINT) AS rejected FROM orders
    """
)
def doc8_upsert_counts(spark: SparkSession, sf: str) -> DataFrame:
    stored = t.orders(spark, sf).filter(F.col("order_date") < F.lit("1998-01-01").cast("timestamp_ntz")).select("order_id", "status", "total")
    _, stats = documents.upsert(stored, _upsert_rows(spark, sf), ["order_id"], "seq", "fields")
    return stats


@query(
    """
    SELECT o_orderkey AS order_id, CASE WHEN o_orderkey = (SELECT min(o_orderkey) FROM orders WHERE o_orderstatus = 'P') THEN 'one' ELSE o_orderstatus END AS status,
      o_totalprice AS total FROM orders
    """
)
def doc6_upsert_one(spark: SparkSession, sf: str) -> DataFrame:
    df = _docs(spark, sf)
    row = df.filter("status = 'P'").agg(F.min("order_id").alias("order_id")).withColumn("status", F.lit("one"))
    table, _ = documents.upsert(df, row, ["order_id"])
    return table


@query("SELECT o_orderkey AS order_id, l_partkey AS product_id, l_linenumber AS item_no FROM orders JOIN lineitem ON l_orderkey = o_orderkey")
def fn15_embed_and_explode(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents.embed(t.items(spark, sf), "order_id", F.struct("product_id", "item_no"), ["item_no", "product_id"], "items", "item_no")
    return documents.explode_items(docs, "order_id")
