"""Streaming queries: each runs a Structured Streaming query over files to completion and returns what it stored."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.operators import cdc, metrics
from mercato.operators.documents import as_read_model
from mercato.operators.joins import enrich
from mercato.operators.shaping import metric_id
from mercato.operators.skew import hot_keys
from mercato.plans import feeds
from mercato.plans import tables as t
from mercato.plans.registry import query, total
from mercato.session import scratch_path
from mercato.sources.external import StreamConfig, read_events
from mercato.streaming import monitor, sinks, state, windows
from mercato.streaming.enrich import enrich_stream
from mercato.streaming.keyed import KeyedTable


def event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events table as a stream of files, under marketplace names."""
    cfg = StreamConfig(fmt="parquet", path=sf, glob="events.parquet", schema=t.raw(spark, sf, "events").schema)
    return _named(read_events(spark, cfg))


def _named(df: DataFrame) -> DataFrame:
    named = df.select(
        "event_id", F.col("ts").alias("event_time"), F.col("user_id").alias("customer_id"), F.col("event_type").alias("category"), F.col("value").alias("price"),
    )
    return windows.event_time(named, "event_time")


# Rows per file with which dealing rows in turn leaves no file of an arrival empty.
ROWS_PER_FILE = 50

# Where the event files of a replayed stream are cut.
_CUTS = ["2024-01-01", "2024-01-09", "2024-01-17", "2024-01-25", "9999-01-01"]


def split_event_stream(spark: SparkSession, sf: str) -> DataFrame:
    """The events as four arrivals in time order, streamed one per micro-batch.

    Arrivals are written one after the other: a file source takes files by age, and the watermark of a later one would
    drop what an earlier one brings. Each is written by as many tasks, to as many files, as a micro-batch takes files; where
    one has too few rows to fill them all for certain, each is one file.
    """
    path, events = scratch_path(spark, "event-files"), t.raw(spark, sf, "events")
    ends = [F.lit(c).cast("timestamp_ntz") for c in _CUTS]
    parts = [events.filter((F.col("ts") >= lo) & (F.col("ts") < hi)) for lo, hi in zip(ends, ends[1:], strict=False)]
    least = min(events.agg(*[F.count_if((F.col("ts") >= lo) & (F.col("ts") < hi)) for lo, hi in zip(ends, ends[1:], strict=False)]).first())
    tasks = spark.sparkContext.defaultParallelism
    files = tasks if least >= tasks * ROWS_PER_FILE else 1
    for part in parts:
        part.repartition(files).write.mode("append").parquet(path)
    cfg = StreamConfig(fmt="parquet", path=path, schema=events.schema, max_per_trigger=files)
    return _named(read_events(spark, cfg))


def _files(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "stream-out")
    sinks.write_stream_files(df, path, scratch_path(spark, "checkpoint"), sinks.ONCE).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _upserted(spark: SparkSession, df: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    path = scratch_path(spark, "stream-table")
    sinks.upsert_sink(df, path, keys, scratch_path(spark, "checkpoint"), order=order).awaitTermination()
    return sinks.read_upserted(spark, path, keys)


def _complete(spark: SparkSession, df: DataFrame) -> DataFrame:
    path = scratch_path(spark, "stream-complete")

    def replace(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    sinks.write_stream_batch(df, replace, scratch_path(spark, "checkpoint"), "complete", sinks.ONCE).awaitTermination()
    return spark.read.schema(df.schema).parquet(path)


def _text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: t.stamp(c) for c in ("window_start", "window_end")})


def _revenue() -> list:
    return [metrics.total("price").alias("revenue"), F.count(F.lit(1)).alias("orders")]


def _stamp_sql(start: str, length: str) -> str:
    form = "'%Y-%m-%d %H:%M:%S'"
    return f"strftime({start}, {form}) AS window_start, strftime({start} + INTERVAL {length}, {form}) AS window_end"


_FIVE = "time_bucket(INTERVAL 5 MINUTE, ts)"
_TUMBLING = (
    f"SELECT {_stamp_sql(_FIVE, '5 MINUTE')}, event_type AS category, {total('value')} AS revenue, count(*) AS orders "
    "FROM events GROUP BY 1, 2, 3"
)


@query("SELECT event_type AS category, count(*) AS n FROM events GROUP BY 1")
def src6_stream_scan(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, event_stream(spark, sf)).groupBy("category").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT event_type AS category, count(*) AS n, 4::BIGINT AS batches FROM events GROUP BY 1")
def src7_rate_limited_scan(spark: SparkSession, sf: str) -> DataFrame:
    """Four arrivals, one per micro-batch, each written by many tasks."""
    df = split_event_stream(spark, sf)
    path = scratch_path(spark, "stream-table")
    stored = lambda batch, i: sinks.write_upserts(batch, i, path)
    sinks.write_stream_batch(df, stored, scratch_path(spark, "checkpoint"), trigger=sinks.ONCE).awaitTermination()
    rows = spark.read.option("recursiveFileLookup", True).parquet(path)
    batches = rows.agg(F.count_distinct("_batch")).scalar()
    return rows.groupBy("category").agg(F.count(F.lit(1)).alias("n")).withColumn("batches", batches)


@query("SELECT event_id, event_type AS category, value AS price FROM events")
def snk5_foreach_batch(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stream-table")

    table = KeyedTable(spark, path, ["event_id"])

    def store(batch: DataFrame, batch_id: int) -> None:
        table.upsert(batch.select("event_id", "category", "price"), batch_id)

    sinks.write_stream_batch(event_stream(spark, sf), store, scratch_path(spark, "checkpoint"), trigger=sinks.ONCE).awaitTermination()
    return table.read()


@query("SELECT event_id, user_id AS customer_id, value AS price FROM events")
def snk6_stream_to_files(spark: SparkSession, sf: str) -> DataFrame:
    return _files(spark, event_stream(spark, sf).select("event_id", "customer_id", "price"))


@query(f"SELECT user_id AS customer_id, {total('value')} AS spend, count(*) AS n FROM events GROUP BY 1")
def snk7_complete_mode(spark: SparkSession, sf: str) -> DataFrame:
    per = event_stream(spark, sf).groupBy("customer_id").agg(metrics.total("price").alias("spend"), F.count(F.lit(1)).alias("n"))
    return _complete(spark, per)


@query(_TUMBLING)
def snk9_keyed_upserts_compacted(spark: SparkSession, sf: str) -> DataFrame:
    """Windows cut by file boundaries are updated by later batches; half the buckets are compacted, the rest is merged by the reader."""
    df = split_event_stream(spark, sf)
    found = windows.tumbling(windows.with_lateness(df, "event_time"), "event_time", "5 minutes", ["category"], _revenue())
    path, keys = scratch_path(spark, "stream-table"), ["window_start", "category"]
    sinks.upsert_sink(found, path, keys, scratch_path(spark, "checkpoint")).awaitTermination()
    sinks.compact(spark, path, keys, most=KeyedTable(spark, path, keys).manifest().buckets // 2)
    return _text(sinks.read_upserted(spark, path, keys))


@query(_TUMBLING)
def str1_tumbling(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    found = windows.tumbling(df, "event_time", "5 minutes", ["category"], _revenue())
    return _text(_upserted(spark, found, ["window_start", "category"]))


@query(_TUMBLING)
def str1_tumbling_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _text(windows.tumbling(t.events(spark, sf), "event_time", "5 minutes", ["category"], _revenue()))


_SLIDE = "(time_bucket(INTERVAL 10 MINUTE, ts) - to_minutes(CAST(10 * i AS INTEGER)))"
_SLIDING = (
    f"SELECT {_stamp_sql(_SLIDE, '1 HOUR')}, event_type AS category, {total('value')} AS moving_revenue "
    "FROM events, range(6) r(i) GROUP BY 1, 2, 3"
)


@query(_SLIDING)
def str2_sliding(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    aggs = [metrics.total("price").alias("moving_revenue")]
    found = windows.sliding(df, "event_time", "1 hour", "10 minutes", ["category"], aggs)
    return _text(_upserted(spark, found, ["window_start", "category"]))


@query(_SLIDING)
def str2_sliding_batch(spark: SparkSession, sf: str) -> DataFrame:
    return _text(windows.sliding_sums(t.events(spark, sf), "event_time", 6, "10 minutes", ["category"], "price", "moving_revenue"))


def _session_sql(kinds: str = "", having: str = "", extra: str = "") -> str:
    return f"""
    WITH e AS (SELECT user_id, ts, value, event_type, CASE WHEN ts - lag(ts) OVER w <= INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens
      FROM events {kinds} WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, opens DESC ROWS UNBOUNDED PRECEDING) AS sid FROM e)
    SELECT strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS window_start, strftime(max(ts) + INTERVAL 30 MINUTE, '%Y-%m-%d %H:%M:%S') AS window_end,
      user_id AS customer_id, {extra} FROM s GROUP BY user_id, sid {having}
    """


_REVENUE = f"count(*) AS session_orders, {total('value')} AS session_revenue"
_SESSIONS = _session_sql(extra=_REVENUE)
# sessions that the watermark has passed
_CLOSED = "max(ts) + INTERVAL 30 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE"


@query(_session_sql(having=f"HAVING {_CLOSED}", extra=_REVENUE))
def str3_sessions(spark: SparkSession, sf: str) -> DataFrame:
    """Append output: a session is emitted, and its state dropped, when the watermark passes its end."""
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    aggs = [F.count("event_id").alias("session_orders"), metrics.total("price").alias("session_revenue")]
    return _text(_files(spark, windows.sessions(df, "event_time", "30 minutes", ["customer_id"], aggs)))


@query(_SESSIONS)
def str3_sessions_batch(spark: SparkSession, sf: str) -> DataFrame:
    sums = {"session_orders": F.lit(1), "session_revenue": F.col("price").cast("decimal(18,2)")}
    found = windows.batch_sessions(t.events(spark, sf), "event_time", 1800, ["customer_id"], sums)
    return _text(found).withColumn("session_revenue", F.col("session_revenue").cast("double"))


@query(
    f"""
    SELECT * FROM (SELECT {_stamp_sql(_FIVE, '5 MINUTE')}, event_type AS category, {total('value')} AS revenue, count(*) AS orders
      FROM events GROUP BY {_FIVE}, event_type HAVING {_FIVE} + INTERVAL 5 MINUTE <= (SELECT max(ts) FROM events) - INTERVAL 10 MINUTE)
    """
)
def str4_watermarked_append(spark: SparkSession, sf: str) -> DataFrame:
    """Append output holds back windows that the watermark has not passed."""
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    found = windows.tumbling(df, "event_time", "5 minutes", ["category"], _revenue())
    return _text(_files(spark, found))


_DELAYS = {"1 minute": 60, "10 minutes": 600, "1 hour": 3600}


@query(
    """
    WITH a AS (SELECT ts, max(ts) OVER (ORDER BY ts + to_seconds(CAST(hash_key % 7 AS INTEGER) * 300), event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS newest
      FROM (SELECT *, event_id % 7 AS hash_key FROM events))
    SELECT count(*) AS total, '1 minute' AS delay, count(*) FILTER (WHERE ts < newest - INTERVAL 1 MINUTE) AS dropped FROM a
    UNION ALL SELECT count(*), '10 minutes', count(*) FILTER (WHERE ts < newest - INTERVAL 10 MINUTE) FROM a
    UNION ALL SELECT count(*), '1 hour', count(*) FILTER (WHERE ts < newest - INTERVAL 1 HOUR) FROM a
    """
)
def str5_late_report(spark: SparkSession, sf: str) -> DataFrame:
    """Events arrive 0–30 minutes after they happen."""
    delay = F.make_dt_interval(secs=(F.col("event_id") % 7 * 300).cast("decimal(18,6)"))
    df = t.events(spark, sf).withColumn("arrival", F.col("event_time") + delay)
    return windows.late_report(df, "event_time", [F.col("arrival"), F.col("event_id")], _DELAYS)


@query(f"SELECT user_id AS customer_id, {total('value')} AS total_spend, count(*) AS order_count FROM events GROUP BY 1")
def str6_running_spend_state(spark: SparkSession, sf: str) -> DataFrame:
    """State carried over four micro-batches."""
    df = split_event_stream(spark, sf)
    totals = _upserted(spark, state.running_spend(df, "customer_id", "price"), ["customer_id"])
    return state.fold_spend(totals, "customer_id")


_QUIET_DAYS = 1
# An arrival meets the watermark that the arrivals before it have set.
_EPOCHS = f"""
    WITH a AS (SELECT user_id, ts, value, CASE {' '.join(f"WHEN ts < TIMESTAMP '{c}' THEN {i}" for i, c in enumerate(_CUTS[1:]))} END AS arrival FROM events),
    w AS (SELECT arrival, lag(newest) OVER (ORDER BY arrival) - INTERVAL 10 MINUTE AS mark
      FROM (SELECT arrival, max(max(ts)) OVER (ORDER BY arrival) AS newest FROM a GROUP BY arrival)),
    u AS (SELECT user_id, arrival, max(ts) AS last_seen FROM a GROUP BY 1, 2),
    e AS (SELECT user_id, coalesce(lag(last_seen) OVER (PARTITION BY user_id ORDER BY arrival) + INTERVAL {_QUIET_DAYS} DAY <= mark, true) AS fresh FROM u JOIN w USING (arrival))
    SELECT customer_id, total_spend, order_count, epochs FROM
      (SELECT user_id AS customer_id, {total('value')} AS total_spend, count(*) AS order_count FROM events GROUP BY 1)
      JOIN (SELECT user_id AS customer_id, count(*) FILTER (WHERE fresh) AS epochs FROM e GROUP BY 1) USING (customer_id)
"""


@query(_EPOCHS)
def str7_state_with_timeout(spark: SparkSession, sf: str) -> DataFrame:
    """Customers quiet for a day lose their state between two arrivals and start a new epoch when they come back."""
    df = windows.with_lateness(split_event_stream(spark, sf), "event_time")
    hot = hot_keys(t.events(spark, sf), ["customer_id"])
    with state.rocksdb(spark):
        timed = state.expiring_spend(df, "customer_id", "price", f"{_QUIET_DAYS} DAY", time="event_time", hot=hot)
        parts = _upserted(spark, timed, ["customer_id", *state.SPEND_KEYS], order=["orders"])
    epochs = parts.groupBy("customer_id").agg(F.count_distinct("epoch").alias("epochs"))
    return state.fold_spend(parts, "customer_id").join(epochs, "customer_id")


_FRAUD = f"""
    WITH w AS (SELECT time_bucket(INTERVAL 1 HOUR, ts) AS h, user_id, count(*) AS orders, {total('value')} AS spend FROM events GROUP BY 1, 2),
    a AS (SELECT *, 'many_orders' AS rule FROM w WHERE orders > 2 UNION ALL SELECT *, 'high_spend' FROM w WHERE spend > 60)
    SELECT {_stamp_sql('h', '1 HOUR')}, user_id AS customer_id, orders, spend, rule FROM a
"""


@query(_FRAUD)
def str8_fraud_alerts(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    found = windows.fraud_rules(df, "event_time", "customer_id", "price", max_orders=2, max_amount=60.0)
    return _text(_upserted(spark, found, ["window_start", "customer_id", "rule"]))


_CART_KINDS = "WHERE event_type IN ('view', 'click', 'purchase')"
_NOT_BOUGHT = "HAVING count(*) FILTER (WHERE event_type = 'purchase') = 0"
_STARTS = "count(*) FILTER (WHERE event_type <> 'purchase') AS starts"
_CARTS = _session_sql(_CART_KINDS, _NOT_BOUGHT, _STARTS)


@query(_CARTS)
def str9_cart_abandonment_batch(spark: SparkSession, sf: str) -> DataFrame:
    found = windows.batch_abandonment(
        t.events(spark, sf), "event_time", 1800, ["customer_id"], "category", ["view", "click"], "purchase"
    )
    return _text(found)


@query(_session_sql(_CART_KINDS, f"{_NOT_BOUGHT} AND {_CLOSED}", _STARTS))
def str9_cart_abandonment(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    found = windows.abandonment(df, "event_time", "30 minutes", ["customer_id"], "category", ["view", "click"], "purchase")
    return _text(_files(spark, found))


@query(_TUMBLING)
def str12_replayed_batches(spark: SparkSession, sf: str) -> DataFrame:
    """The stream runs twice from scratch into one keyed table, as after a lost checkpoint: nothing counts double."""
    path, keys = scratch_path(spark, "stream-table"), ["window_start", "category"]
    for _ in range(2):
        df = windows.with_lateness(event_stream(spark, sf), "event_time")
        found = windows.tumbling(df, "event_time", "5 minutes", ["category"], _revenue())
        sinks.upsert_sink(found, path, keys, scratch_path(spark, "checkpoint")).awaitTermination()
    return _text(sinks.read_upserted(spark, path, keys))


@query(_TUMBLING)
def str13_restart_from_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    """Half the files, stop, the other half arrives, restart from the same checkpoint."""
    events = t.raw(spark, sf, "events")
    turn = F.lit("2024-01-16").cast("timestamp_ntz")
    path, keys = scratch_path(spark, "stream-table"), ["window_start", "category"]
    inbox, checkpoint = scratch_path(spark, "event-files"), scratch_path(spark, "checkpoint")
    for part in (events.filter(F.col("ts") < turn), events.filter(F.col("ts") >= turn)):
        part.write.mode("append").parquet(inbox)
        cfg = StreamConfig(fmt="parquet", path=inbox, schema=events.schema)
        df = windows.with_lateness(_named(read_events(spark, cfg)), "event_time")
        found = windows.tumbling(df, "event_time", "5 minutes", ["category"], _revenue())
        sinks.upsert_sink(found, path, keys, checkpoint).awaitTermination()
    return _text(sinks.read_upserted(spark, path, keys))


_BATCHES = f"""
    WITH a AS (SELECT ts, event_type, CASE {' '.join(f"WHEN ts < TIMESTAMP '{c}' THEN {i}" for i, c in enumerate(_CUTS[1:]))} END AS batch_id FROM events),
    b AS (SELECT batch_id, count(*) AS num_input_rows, max(ts) AS newest FROM a GROUP BY 1),
    m AS (SELECT CAST(batch_id AS BIGINT) AS batch_id, num_input_rows, max(newest) OVER w - INTERVAL 10 MINUTE AS mark,
      sum(num_input_rows) OVER (ORDER BY batch_id) AS done FROM b
      WINDOW w AS (ORDER BY batch_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
    s AS (SELECT m.batch_id, count(DISTINCT ({_FIVE}, event_type)) AS state_rows FROM m JOIN a ON a.batch_id <= m.batch_id
      AND ({_FIVE} + INTERVAL 5 MINUTE > mark OR mark IS NULL) GROUP BY 1)
"""


def _reported(spark: SparkSession, sf: str) -> DataFrame:
    """The stored reports of a stream of tumbling windows over four arrivals; batches without rows left out."""
    df = windows.with_lateness(split_event_stream(spark, sf), "event_time")
    df = df.observe("arrival", F.count(F.lit(1)).alias("rows"), F.count("customer_id").alias("customers"))
    found = windows.tumbling(df, "event_time", "5 minutes", ["category"], _revenue())
    with monitor.ProgressTable(spark, scratch_path(spark, "progress")) as table:
        keys = ["window_start", "category"]
        stream = sinks.upsert_sink(found, scratch_path(spark, "stream-table"), keys, scratch_path(spark, "checkpoint"))
        stream.awaitTermination()
        table.wait(stream)
    return table.read().filter("num_input_rows > 0")


@query(
    f"""
    {_BATCHES} SELECT batch_id, num_input_rows, num_input_rows AS observed_rows, state_rows, CAST(0 AS BIGINT) AS dropped_by_watermark,
      coalesce(strftime(mark, '%Y-%m-%d %H:%M:%S'), '1970-01-01 00:00:00') AS watermark, true AS timed FROM m JOIN s USING (batch_id)
    """
)
def str14_progress_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rows, observed rows, state size, late rows and watermark of every batch; rates and times are positive and agree."""
    timed = (F.col("batch_ms") > 0) & (F.col("process_rate") > 0) & (F.col("process_rate") <= F.col("num_input_rows") * 1000.0)
    return _reported(spark, sf).select(
        "batch_id",
        "num_input_rows",
        F.col("observed")["arrival.rows"].cast("bigint").alias("observed_rows"),
        "state_rows",
        "dropped_by_watermark",
        t.stamp(F.to_timestamp("watermark")).alias("watermark"),
        timed.alias("timed"),
    )


@query(
    f"""
    {_BATCHES} SELECT batch_id, CAST(total - done AS BIGINT) AS lag, 'lag' AS rule FROM m, (SELECT count(*) AS total FROM events)
    WHERE total - done > 1000
    """
)
def str11_backlog_alerts(spark: SparkSession, sf: str) -> DataFrame:
    """The lag rule over the stored reports: events that have arrived and are not processed after each batch."""
    total = t.events(spark, sf).count()
    by_run = Window.partitionBy("run_id").orderBy("batch_id")
    behind = _reported(spark, sf).withColumn("lag", F.lit(total).cast("bigint") - F.sum("num_input_rows").over(by_run))
    return metrics.alerts(behind, metrics.standard_rules(lag="lag")).select("batch_id", "lag", "rule")


@query("SELECT 0::BIGINT AS batch_id, count(*) AS num_input_rows FROM events")
def str14_progress_rows(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "stream-out")
    stream = sinks.write_stream_files(event_stream(spark, sf), path, scratch_path(spark, "checkpoint"), sinks.ONCE)
    stream.awaitTermination()
    return monitor.progress_rows(spark, stream).filter("num_input_rows > 0").select("batch_id", "num_input_rows")


@query(
    f"""
    SELECT {_stamp_sql(_SLIDE, '1 HOUR')}, user_id AS customer_id, count(*) AS events, {total('value')} AS spend, max(value) AS max_amount,
      {total('value')} / count(*) AS avg_amount FROM events, range(6) r(i) GROUP BY 1, 2, 3
    """
)
def str15_stream_features(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    found = windows.stream_features(df, "event_time", "customer_id", "price")
    return _text(_upserted(spark, found, ["window_start", "customer_id"]))


@query("SELECT event_id, event_type AS category FROM events")
def set4_stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Every event is in the stream twice."""
    path = scratch_path(spark, "event-files")
    events = t.raw(spark, sf, "events")
    events.unionByName(events).write.parquet(path)
    df = _named(read_events(spark, StreamConfig(fmt="parquet", path=path, schema=events.schema)))
    return _files(spark, windows.dedup_stream(df, ["event_id"], "event_time").select("event_id", "category"))


@query("SELECT event_id, user_id AS customer_id, c_mktsegment AS market FROM events LEFT JOIN customer ON c_custkey = user_id")
def jn8_stream_enrichment(spark: SparkSession, sf: str) -> DataFrame:
    dim = t.raw(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("market"))
    found = enrich(event_stream(spark, sf), dim, ["customer_id"])
    return _files(spark, found.select("event_id", "customer_id", "market"))


@query("SELECT event_id, user_id AS customer_id, c_mktsegment AS market FROM events LEFT JOIN customer ON c_custkey = user_id")
def jn8_large_dimension(spark: SparkSession, sf: str) -> DataFrame:
    """The same over four arrivals, with the customers taken as too many to broadcast: keys that were hot in earlier
    arrivals are salted."""
    dim = t.raw(spark, sf, "customer").select(F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("market"))
    path, stream = scratch_path(spark, "enriched"), split_event_stream(spark, sf).select("event_id", "customer_id")

    def store(batch: DataFrame, batch_id: int) -> None:
        sinks.write_upserts(batch, batch_id, path)

    enrich_stream(stream, dim, ["customer_id"], store, scratch_path(spark, "checkpoint"), max_bytes=0).awaitTermination()
    return spark.read.parquet(path).select("event_id", "customer_id", "market")


@query(
    f"""
    SELECT strftime({_FIVE}, '%Y-%m-%dT%H:%M:%S') || '_' || event_type AS _id, event_type AS category, {total('value')} AS revenue, count(*) AS order_count,
      {total('value')} / count(*) AS avg_order_value, {_stamp_sql(_FIVE, '5 MINUTE')} FROM events GROUP BY {_FIVE}, event_type
    """
)
def agg21_revenue_metric_documents(spark: SparkSession, sf: str) -> DataFrame:
    df = windows.with_lateness(event_stream(spark, sf), "event_time")
    aggs = [metrics.total("price").alias("revenue"), F.count(F.lit(1)).alias("order_count")]
    found = windows.tumbling(df, "event_time", "5 minutes", ["category"], aggs).withColumn(
        "avg_order_value", F.try_divide("revenue", "order_count")
    )
    docs = found.withColumn("_id", metric_id("window_start", "category"))
    return _text(as_read_model(_upserted(spark, docs, ["_id"]), "revenue_metrics"))


@query(feeds._STATE)
def cdc6_feed_to_read_model(spark: SparkSession, sf: str) -> DataFrame:
    """The change feed as a stream, from the earliest message, folded per micro-batch into a keyed table.

    A batch is parsed once and serves both outputs. Its own changes are folded before they are stored, and the table merges
    them field by field: the purchase time is the last known one, whichever batch brought it.
    """
    inbox, path = scratch_path(spark, "feed"), scratch_path(spark, "stream-table")
    feed = feeds.order_feed(spark, sf)
    feed.repartitionByRange("kafka_offset").sortWithinPartitions("kafka_offset").write.parquet(inbox)
    source = read_events(spark, StreamConfig(fmt="parquet", path=inbox, schema=feed.schema, max_per_trigger=2))
    table = KeyedTable(spark, f"{path}/orders", ["order_id"], merge=cdc.merge_changes)

    def fold(batch: DataFrame, batch_id: int) -> None:
        tagged = cdc.tagged_changes(batch).persist()
        typed, bad = tagged.filter("reason IS NULL"), tagged.filter("reason IS NOT NULL")
        rows = cdc.change_rows(typed.filter("has_image")).withColumn("_batch", F.lit(batch_id).cast("bigint"))
        table.upsert(cdc.merge_changes(rows).drop("_batch"), batch_id)
        bad.select("value", "reason").write.mode("overwrite").parquet(f"{path}/dead/batch={batch_id}")
        tagged.unpersist()

    sinks.write_stream_batch(source, fold, scratch_path(spark, "checkpoint"), trigger=sinks.ONCE).awaitTermination()
    table.compact(most=table.buckets // 2)
    return feeds._state_text(table.read().select("order_id", "customer_id", "order_status", "purchase_ts"))
