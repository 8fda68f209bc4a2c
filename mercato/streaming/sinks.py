"""Stream sinks, and an idempotent keyed sink on plain Parquet."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from mercato.operators.shaping import latest_by
from mercato.streaming.keyed import KeyedTable, Merge

# The trigger of the documented file sink, and one that takes what is there and ends.
EVERY_MINUTE = {"processingTime": "1 minute"}
ONCE = {"availableNow": True}


def write_stream_files(
    df: DataFrame, path: str, checkpoint: str, trigger: dict | None = None, fmt: str = "parquet"
) -> StreamingQuery:
    """Append to files; the checkpoint makes each row appear exactly once."""
    writer = df.writeStream.format(fmt).option("path", path).option("checkpointLocation", checkpoint)
    return writer.outputMode("append").trigger(**(trigger or EVERY_MINUTE)).start()


def write_stream_batch(
    df: DataFrame,
    fn: Callable[[DataFrame, int], None],
    checkpoint: str,
    mode: str = "append",
    trigger: dict | None = None,
) -> StreamingQuery:
    """Hand every micro-batch to ``fn(batch, batch_id)``. A batch may be replayed after a failure: make fn idempotent."""
    writer = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint)
    return writer.outputMode(mode).trigger(**(trigger or EVERY_MINUTE)).start()


def write_console(df: DataFrame, mode: str = "append", trigger: dict | None = None, rows: int = 20) -> StreamingQuery:
    """Print micro-batches, for trying things out."""
    writer = df.writeStream.format("console").option("numRows", rows).option("truncate", False)
    return writer.outputMode(mode).trigger(**(trigger or ONCE)).start()


# --- keyed upserts -----------------------------------------------------------------------------------------------


def write_upserts(batch: DataFrame, batch_id: int, path: str) -> None:
    """One micro-batch as a folder named after its id, so that a replayed batch replaces itself."""
    batch.withColumn("_batch", F.lit(batch_id).cast("bigint")).write.mode("overwrite").parquet(
        f"{path}/batch={batch_id}"
    )


def upsert_sink(
    df: DataFrame,
    path: str,
    keys: list[str],
    checkpoint: str,
    mode: str = "update",
    trigger: dict | None = None,
    order: list[str] | None = None,
    merge: Merge | None = None,
) -> StreamingQuery:
    """Exactly-once sink into a keyed table. ``order`` decides between rows of one key inside a batch when there can be several."""
    table = KeyedTable(df.sparkSession, path, keys, merge=merge)

    def store(batch: DataFrame, batch_id: int) -> None:
        table.upsert(latest_by(batch, keys, order) if order else batch, batch_id)

    return write_stream_batch(df, store, checkpoint, mode, trigger or ONCE)


def read_upserted(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """Current content of a keyed table: one row per key."""
    return KeyedTable(spark, path, keys).read()


def compact(spark: SparkSession, path: str, keys: list[str], most: int | None = None) -> list[int]:
    """Fold the deltas of a keyed table, of ``most`` buckets or of all; returns the buckets."""
    return KeyedTable(spark, path, keys).compact(most)
