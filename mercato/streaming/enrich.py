"""Streams joined with reference data that is too large to broadcast, without a hot key ending in one task."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from itertools import chain

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercato.operators.skew import BROADCAST_BYTES, ROWS_PER_TASK, fits
from mercato.streaming.sinks import ONCE, write_stream_batch

HOT_KEYS = 256  # keys a batch reports at most
TRACKED = 10_000  # counters of its sketch


class HotKeys:
    """The frequent keys of earlier batches, from a mergeable sketch of fixed size; at most ``HOT_KEYS`` numbers come back.

    Keys are told apart by a 64-bit hash. The sketch is approximate and two keys may share a hash: that moves rows to other
    tasks and changes no result. Keys beyond ``HOT_KEYS`` are left to adaptive execution, which splits skewed partitions.
    """

    def __init__(self, keys: list[str], rows_per_task: int = ROWS_PER_TASK) -> None:
        self.rows_per_task = rows_per_task
        self.hash = F.xxhash64(*keys)
        self.no_key = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
        self.rows: dict[int, float] | None = None

    def sketch(self) -> Column:
        known = F.when(~self.no_key, self.hash)
        return F.call_function("approx_top_k", known, F.lit(HOT_KEYS), F.lit(TRACKED)).alias("frequent")

    def learn(self, frequent: list | None) -> None:
        """Take a batch's report; what earlier ones reported counts half, so a key that cools down is forgotten."""
        rows = {h: n / 2 for h, n in (self.rows or {}).items()}
        for item in frequent or []:
            if item["item"] is not None:
                rows[item["item"]] = max(rows.get(item["item"], 0), item["count"])
        top = sorted(rows.items(), key=lambda x: (-x[1], x[0]))[:HOT_KEYS]
        self.rows = {h: n for h, n in top if n > self.rows_per_task / 2}

    def parts(self, most: int) -> Column:
        """Into how many parts a row's key is split, 1 for an ordinary one."""
        hot = {h: min(most, int(-(-n // self.rows_per_task))) for h, n in (self.rows or {}).items()}
        hot = {h: n for h, n in hot.items() if n > 1}
        if not hot:
            return F.lit(1)
        cells = chain.from_iterable((F.lit(h).cast("long"), F.lit(n)) for h, n in hot.items())
        return F.coalesce(F.try_element_at(F.create_map(*cells), self.hash), F.lit(1))


def salted_lookup(batch: DataFrame, dim: DataFrame, keys: list[str], hot: HotKeys) -> DataFrame:
    """Left join: rows of a hot key are dealt over parts, and its dimension rows stand in every part.

    Rows without a key match nothing and are dealt over all tasks.
    """
    most = int(batch.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = F.xxhash64(*batch.columns) + F.spark_partition_id()
    part = F.pmod(spread, F.when(hot.no_key, F.lit(most)).otherwise(hot.parts(most))).cast("int")
    copies = F.explode(F.sequence(F.lit(0), hot.parts(most) - 1))
    return batch.withColumn("_part", part).join(dim.withColumn("_part", copies), [*keys, "_part"], "left").drop("_part")


def enrich_stream(
    stream: DataFrame,
    dim: DataFrame,
    keys: list[str],
    store: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    rows_per_task: int = ROWS_PER_TASK,
    max_bytes: int = BROADCAST_BYTES,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Join every micro-batch with the dimension (left, one dimension row per key) and hand it to ``store(batch, id)``.

    A dimension known to be under ``max_bytes`` is broadcast. Otherwise the batch is joined by salted keys: a sketch that
    runs along with the join tells the next batch which keys are hot. The first batch after a start is sketched by
    itself beforehand. ``store`` must be idempotent and should write once: every action on its batch runs the join.
    Null keys, empty batches and keys without a dimension row keep their rows, with nulls.
    """
    if fits(dim, max_bytes):
        return write_stream_batch(stream, lambda b, i: store(b.join(F.broadcast(dim), keys, "left"), i), checkpoint, trigger=trigger or ONCE)
    hot = HotKeys(keys, rows_per_task)

    def join(batch: DataFrame, batch_id: int) -> None:
        if hot.rows is None:
            hot.learn(batch.agg(hot.sketch()).first()["frequent"])
        seen = Observation(f"keys-{batch_id}")
        store(salted_lookup(batch.observe(seen, hot.sketch()), dim, keys, hot).select(*batch.columns, *[c for c in dim.columns if c not in keys]), batch_id)
        hot.learn(seen.get["frequent"])

    return write_stream_batch(stream, join, checkpoint, trigger=trigger or ONCE)
