"""Windowed aggregates that run unchanged on a stream or a batch, and batch twins for what a stream does with state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.functions.scalar import money
from mercato.operators.metrics import alerts
from mercato.operators.skew import running


def event_time(df: DataFrame, column: str) -> DataFrame:
    """A zone-less timestamp as an instant, which watermarks require (the session zone is UTC)."""
    if isinstance(df.schema[column].dataType, T.TimestampNTZType):
        return df.withColumn(column, F.col(column).cast("timestamp"))
    return df


def with_lateness(df: DataFrame, ts: str, delay: str = "10 minutes") -> DataFrame:
    """Watermark: state is kept, and rows accepted, up to ``delay`` behind the newest event of earlier batches.

    A batch frame passes through unchanged. In a stream a late row is judged by the
    watermark that the batch before started with.
    """
    df = event_time(df, ts)
    return df.withWatermark(ts, delay) if df.isStreaming else df


def _flat(df: DataFrame, window: str, keys: list[str]) -> DataFrame:
    rest = [c for c in df.columns if c not in (window, *keys)]
    return df.select(
        F.col(f"{window}.start").alias("window_start"), F.col(f"{window}.end").alias("window_end"), *keys, *rest
    )


def tumbling(df: DataFrame, ts: str, size: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per fixed window and key."""
    return _flat(df.groupBy(F.window(ts, size), *keys).agg(*aggs), "window", keys)


def sliding(df: DataFrame, ts: str, size: str, slide: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Aggregates per overlapping window.

    On a batch, rows are first reduced to one per slide step and key when ``size`` is a multiple of ``slide``; use
    ``sliding_sums`` for that. A stream keeps one state row per window.
    """
    return _flat(df.groupBy(F.window(ts, size, slide), *keys).agg(*aggs), "window", keys)


def sliding_sums(df: DataFrame, ts: str, steps: int, slide: str, keys: list[str], value: str, name: str) -> DataFrame:
    """Sliding sums over a batch: reduce to slide steps, then give each step to the ``steps`` windows that hold it.

    The replication applies to step totals and not to events.
    """
    per_step = df.groupBy(F.window(ts, slide).alias("w"), *keys).agg(F.sum(money(value)).alias("_v"))
    span = F.col("w.end").cast("timestamp") - F.col("w.start").cast("timestamp")
    placed = per_step.withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(steps - 1)))).select(
        (F.col("w.start") - span * F.col("_i")).alias("window_start"),
        (F.col("w.start") - span * F.col("_i") + span * steps).alias("window_end"),
        *keys,
        "_v",
    )
    return placed.groupBy("window_start", "window_end", *keys).agg(F.sum("_v").cast("double").alias(name))


def sessions(df: DataFrame, ts: str, gap: str, keys: list[str], aggs: list[Column]) -> DataFrame:
    """Session windows of a stream; append or complete output only. Sessions merge map-side before the shuffle."""
    return _flat(df.groupBy(F.session_window(ts, gap).alias("session"), *keys).agg(*aggs), "session", keys)


def batch_sessions(df: DataFrame, ts: str, gap_seconds: int, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sessions over a batch, equal to session windows, for keys with any number of events.

    Events in one gap-wide bucket always share a session, so they are summed first, map-side. Only bucket totals are put
    in order per key, and their number is bounded by the time range and not by the events. ``sums``: name → addend
    (``lit(1)`` counts).
    """
    gap = gap_seconds * 1_000_000
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    buckets = df.groupBy(*keys, F.floor(micros / F.lit(gap)).alias("_b")).agg(
        F.min(micros).alias("_lo"), F.max(micros).alias("_hi"), *[F.sum(v).alias(n) for n, v in sums.items()]
    )
    w = Window.partitionBy(*keys).orderBy("_b")
    opens = F.coalesce(F.col("_lo") - F.lag("_hi").over(w) > gap, F.lit(True)).cast("int")
    numbered = buckets.withColumn("_open", opens).withColumn("_s", F.sum("_open").over(w))
    return (
        numbered.groupBy(*keys, "_s")
        .agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"), *[F.sum(n).alias(n) for n in sums])
        .select(
            F.timestamp_micros("_lo").alias("window_start"),
            F.timestamp_micros(F.col("_hi") + gap).alias("window_end"),
            *keys,
            *sums,
        )
    )


def abandonment(df: DataFrame, ts: str, gap: str, keys: list[str], kind: str, start: list[str], finish: str) -> DataFrame:
    """Carts left behind: sessions of start and finish events that contain no finish. Stream version."""
    carts = sessions(
        df.filter(F.col(kind).isin([*start, finish])),
        ts,
        gap,
        keys,
        [F.count_if(F.col(kind) != finish).alias("starts"), F.count_if(F.col(kind) == finish).alias("finishes")],
    )
    return carts.filter("finishes = 0").drop("finishes")


def batch_abandonment(
    df: DataFrame, ts: str, gap_seconds: int, keys: list[str], kind: str, start: list[str], finish: str
) -> DataFrame:
    """Batch twin of ``abandonment``."""
    carts = batch_sessions(
        df.filter(F.col(kind).isin([*start, finish])),
        ts,
        gap_seconds,
        keys,
        {
            "starts": F.when(F.col(kind) != finish, 1).otherwise(0),
            "finishes": F.when(F.col(kind) == finish, 1).otherwise(0),
        },
    )
    return carts.filter("finishes = 0").drop("finishes")


def dedup_stream(df: DataFrame, keys: list[str], ts: str, delay: str = "10 minutes") -> DataFrame:
    """First row per key; a stream forgets keys once the watermark passes them."""
    if df.isStreaming:
        return event_time(df, ts).withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    return df.dropDuplicates(keys)


def late_report(df: DataFrame, ts: str, arrival: list[Column], delays: dict[str, int]) -> DataFrame:
    """How many rows each watermark delay (label → seconds) would drop, if rows came in the given order one by one.

    A row is late when its time is more than the delay behind the newest time before it. The running maximum is carried
    across range partitions, so nothing is sorted in one task.
    """
    micros = F.unix_micros(F.col(ts).cast("timestamp"))
    seen = running(df, [], arrival, {"_newest": ("max", micros)}, include_current=False)
    counted = seen.agg(
        F.count(F.lit(1)).alias("total"),
        *[
            F.count_if(micros < F.col("_newest") - seconds * 1_000_000).alias(label)
            for label, seconds in delays.items()
        ],
    )
    return counted.unpivot(["total"], list(delays), "delay", "dropped")


# Fixed values of ours: fraud thresholds per customer and hour.
FRAUD_ORDERS = 10
FRAUD_AMOUNT = 200.0


def fraud_rules(
    df: DataFrame,
    ts: str,
    customer: str,
    amount: str,
    size: str = "1 hour",
    max_orders: int = FRAUD_ORDERS,
    max_amount: float = FRAUD_AMOUNT,
) -> DataFrame:
    """Alerts for customers with too many orders, or too much spend, in one window; stream or batch."""
    activity = tumbling(
        df,
        ts,
        size,
        [customer],
        [F.count(F.lit(1)).alias("orders"), F.sum(money(amount)).cast("double").alias("spend")],
    )
    return alerts(
        activity, {"many_orders": F.col("orders") > max_orders, "high_spend": F.col("spend") > max_amount}
    )


def stream_features(df: DataFrame, ts: str, key: str, amount: str, size: str = "1 hour", slide: str = "10 minutes") -> DataFrame:
    """Rolling features per key: events, spend, mean and largest amount in each sliding window."""
    return sliding(
        df,
        ts,
        size,
        slide,
        [key],
        [
            F.count(F.lit(1)).alias("events"),
            F.sum(money(amount)).cast("double").alias("spend"),
            F.max(amount).alias("max_amount"),
        ],
    ).withColumn("avg_amount", F.try_divide("spend", "events"))
