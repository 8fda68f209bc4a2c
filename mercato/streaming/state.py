"""Running totals per key: a built-in streaming aggregate, and custom state where keys expire."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.stateful_processor import ExpiredTimerInfo, StatefulProcessor, StatefulProcessorHandle, TimerValues

# executors need not have this package installed
cloudpickle.register_pickle_by_value(sys.modules[__name__])

SPEND_KEYS = ("salt", "epoch")


def _cents(amount: str) -> Column:
    return F.round(F.coalesce(F.col(amount), F.lit(0.0)) * 100).cast("bigint")


def running_spend(df: DataFrame, key: str, amount: str) -> DataFrame:
    """Running spend and order count per key: (key, cents, orders) in update mode.

    A streaming aggregate: batches combine before the shuffle, so a customer with a third of all events costs one row per
    task. Amounts are whole cents, so order does not matter.
    """
    return df.select(F.col(key), _cents(amount).alias("cents")).groupBy(key).agg(
        F.sum("cents").alias("cents"), F.count(F.lit(1)).alias("orders")
    )


SLOTS = 2048


class _Spend(StatefulProcessor):
    """Totals of the keys of one slot, a row of state per (key, salt): read once and stored once for all rows of a batch.

    In event time one timer per slot, at the earliest end of a state, drops what has ended; in processing time the time
    to live drops a slot that was not stored for so long. A state that has ended counts no more, dropped or not.
    """

    def __init__(self, quiet_ms: int, event_time: bool):
        self.quiet_ms, self.event_time = quiet_ms, event_time

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        schema = "id string, salt int, cents bigint, orders bigint, epoch bigint, ends bigint"
        self.totals = handle.getListState("totals", schema, None if self.event_time else self.quiet_ms)

    def _clock(self, timerValues: TimerValues) -> int:  # noqa: N803
        return timerValues.getCurrentWatermarkInMs() if self.event_time else timerValues.getCurrentProcessingTimeInMs()

    def _store(self, totals: dict, timer: int | None) -> None:
        """``timer`` is the one that is set: the earliest end of what was stored before."""
        due = min((total[3] for total in totals.values()), default=None)
        if totals:
            self.totals.put([(*one, *total) for one, total in totals.items()])
        else:
            self.totals.clear()
        if self.event_time and due != timer:
            if timer is not None:
                self.handle.deleteTimer(timer)
            if due is not None:
                self.handle.registerTimer(due)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: TimerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        clock, batch = self._clock(timerValues), {}
        for part in rows:
            for one, salt, cents, at in zip(*(part[c].tolist() for c in ("id", "salt", "cents", "at")), strict=True):
                # a row without a time, which makes numbers of its Arrow batch floats, counts as of the watermark
                at = clock if at is None or at != at else int(at)
                seen = batch.get((one, salt))
                if seen is None:
                    batch[one, salt] = [cents, 1, at, at]
                else:
                    batch[one, salt] = [seen[0] + cents, seen[1] + 1, min(seen[2], at), max(seen[3], at)]
        stored = {(one, salt): tuple(total) for one, salt, *total in self.totals.get()}
        timer = min((total[3] for total in stored.values()), default=None)
        # a timer that is due has ended a state, whether or not it was called before these rows
        totals = {one: total for one, total in stored.items() if total[3] > clock}
        for one, (cents, orders, first, last) in batch.items():
            start, end = (first, last) if self.event_time else (clock, clock)
            before = totals.get(one, (0, 0, start, 0))
            totals[one] = (before[0] + cents, before[1] + orders, before[2], max(before[3], end + self.quiet_ms))
        self._store(totals, timer)
        found = [(*one, *totals[one][:3]) for one in batch]
        yield pd.DataFrame(found, columns=["id", "salt", "cents", "orders", "epoch"])[["id", "salt", "epoch", "cents", "orders"]]

    def handleExpiredTimer(self, key: tuple, timerValues: TimerValues, expiredTimerInfo: ExpiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        clock = self._clock(timerValues)
        # Spark deletes the timer that it has called
        self._store({(one, salt): tuple(total) for one, salt, *total in self.totals.get() if total[3] > clock}, None)
        return iter([])

    def close(self) -> None:
        pass


@contextmanager
def rocksdb(spark: SparkSession) -> Iterator[None]:
    """State in RocksDB for streams started inside: on local disk beside the heap, which timers and times to live need."""
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        spark.conf.set(key, before)


def expiring_spend(
    df: DataFrame, key: str, amount: str, quiet: str, *, time: str | None = None, hot: DataFrame | None = None, slots: int = SLOTS
) -> DataFrame:
    """The same totals as state that is dropped when a key stays quiet; start the stream inside ``rocksdb``.

    Returns (key, salt, epoch, cents, orders) in update mode. With ``time``, a column that has a watermark, a state ends
    by a timer ``quiet`` after its last event, so replays end it alike; without, it lives ``quiet`` of processing time after
    its last update. A state that starts, for the first time or after it was dropped, counts from 0 in an epoch of its
    own, its first event's time or the time it starts, so that what was stored before stays and ``fold_spend`` adds it.

    A call of the state costs milliseconds, so keys are dealt to ``slots`` by their hash, and a batch calls once for a
    slot that it has rows of, which stores the states of the slot anew. Slots are settled by a stream's first batch;
    choose them so that the keys of one are what a task can hold. A key has one state, salt 0. Only keys of ``hot`` (the key and ``_parts``, as ``hot_keys`` finds them in earlier data)
    are dealt to several partial states, by a hash of the row and its input partition, so that identical rows spread too.
    """
    spark = df.sparkSession
    quiet_ms = spark.range(1).select((F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {quiet}")) / 1000).cast("bigint")).first()[0]
    kind = df.schema[key].dataType.simpleString()
    at = F.unix_millis(F.col(time).cast("timestamp")) if time else F.lit(0).cast("bigint")
    columns = [F.col(key), _cents(amount).alias("cents"), at.alias("at"), *([F.col(time)] if time else [])]
    spot = F.xxhash64(*df.columns) + F.spark_partition_id()
    if hot is None:
        salted = df.select(*columns, F.lit(0).alias("salt"))
    else:
        parts = hot.select(F.col(key).alias("_hot"), "_parts")
        found = df.withColumn("_spot", spot).join(parts, F.col(key).eqNullSafe(F.col("_hot")), "left")
        salted = found.select(*columns, F.coalesce(F.pmod("_spot", F.col("_parts")), F.lit(0)).cast("int").alias("salt"))
    # keys go to Python as text, null as none: one null would make the numbers of its Arrow batch floats
    dealt = salted.select(
        F.pmod(F.xxhash64(key, "salt"), F.lit(slots)).cast("int").alias("slot"),
        F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("")).alias("id"),
        "salt", "cents", "at", *([time] if time else []),
    )
    found = dealt.groupBy("slot").transformWithStateInPandas(
        _Spend(quiet_ms, time is not None),
        "id string, salt int, epoch bigint, cents bigint, orders bigint",
        "update",
        "EventTime" if time else "ProcessingTime",
    )
    text = F.when(F.length("id") > 0, F.expr("substr(id, 2)"))
    return found.select(text.cast(kind).alias(key), *SPEND_KEYS, "cents", "orders")


def fold_spend(parts: DataFrame, key: str) -> DataFrame:
    """Add up stored totals, one row per key (and salt and epoch), to spend and orders per key."""
    return parts.groupBy(key).agg(
        (F.sum("cents") / 100.0).alias("total_spend"), F.sum("orders").alias("order_count")
    )
