"""Batch writes: layer tables, partitioned and bucketed layouts, exports, tiers, messages."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from mercato.session import configure

FORMATS = ("parquet", "orc", "csv", "json")


def write_layer(
    df: DataFrame,
    layer: str,
    name: str,
    root: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    fmt: str = "parquet",
) -> str:
    """Write a layer table with Snappy compression; returns its path.

    A partitioned write first rebalances on the partition columns: one partition's rows sit together, so few files
    come out, while the engine still splits a partition that is too big for one task.
    """
    path = f"{root.rstrip('/')}/{layer}/{name}"
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    writer = df.write.mode(mode).format(fmt)
    if fmt in ("parquet", "orc"):
        writer = writer.option("compression", "snappy")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


# Fixed value: the least number of buckets.
MIN_BUCKETS = 10
BUCKET_BYTES = 256 * 1024 * 1024


def bucket_count(df: DataFrame, bucket_bytes: int = BUCKET_BYTES) -> int:
    """Buckets for a table by its estimated size: at least 10, else so many that one holds about ``bucket_bytes``.

    A key with more rows than a bucket should hold stays in one bucket: such a table is not for bucketing.
    """
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(MIN_BUCKETS, -(-size // bucket_bytes))


def write_bucketed(
    df: DataFrame, name: str, n: int, keys: list[str], sort: list[str], path: str | None = None
) -> None:
    """Save a table hashed into ``n`` buckets and sorted in each, so joins and groupings on the keys need no shuffle.

    Rows are shuffled to their buckets first; otherwise every task would open a file per bucket.
    """
    writer = df.repartition(n, *keys).write.mode("overwrite").bucketBy(n, *keys).sortBy(*sort)
    if path:
        writer = writer.option("path", path)
    writer.saveAsTable(name)


def evolve(df: DataFrame, target: T.StructType) -> DataFrame:
    """Fit ``df`` to a newer schema: cast shared columns, add absent ones as null, keep extra ones at the end."""
    have = set(df.columns)
    fitted = [
        (F.col(f.name).cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name)
        for f in target.fields
    ]
    wanted = set(target.fieldNames())
    return df.select(*fitted, *[c for c in df.columns if c not in wanted])


def bulk_insert(df: DataFrame, path: str, fmt: str = "parquet") -> int:
    """Append and return how many rows were written.

    The count is observed while writing, so the input is scanned once. The write is all or nothing, and the count is
    of rows really stored (a client that adds 0 for a partly failed batch would report fewer).
    """
    spark, name = df.sparkSession, f"bulk_{uuid.uuid4().hex}"
    # a session that has observed anything can no longer ship closures that hold it, as some fitted models do; so the
    # observing is left to a side session
    df.createGlobalTempView(name)
    try:
        seen = Observation()
        rows = configure(spark.newSession()).table(f"global_temp.{name}")
        rows.observe(seen, F.count(F.lit(1)).alias("n")).write.mode("append").format(fmt).save(path)
        return seen.get["n"]
    finally:
        spark.catalog.dropGlobalTempView(name)


def messages(df: DataFrame, value: Column | str, key: Column | str | None = None) -> DataFrame:
    """(key, value) rows to publish; rows with one key go to one topic partition."""
    value = F.col(value) if isinstance(value, str) else value
    key = F.lit(None) if key is None else F.col(key) if isinstance(key, str) else key
    return df.select(key.cast("string").alias("key"), value.cast("string").alias("value"))


def json_messages(df: DataFrame, key: str | None = None) -> DataFrame:
    """Whole rows as JSON messages, null fields included."""
    return messages(df, F.to_json(F.struct("*"), {"ignoreNullFields": "false"}), key)


def publish(message_rows: DataFrame, topic: str, fmt: str = "kafka", path: str = "", **options: str) -> None:
    """Send message rows to a topic; a file format writes them under ``path/topic=…`` instead."""
    if fmt == "kafka":
        message_rows.write.format("kafka").options(topic=topic, **options).save()
    else:
        message_rows.write.mode("append").format(fmt).save(f"{path.rstrip('/')}/topic={topic}")


def export(
    df: DataFrame, path: str, fmt: str = "parquet", fraction: float | None = None, version: str = "1", seed: int = 42
) -> str:
    """Export for training under ``version=…``; ``fraction`` draws a seeded Bernoulli sample."""
    if fmt not in FORMATS:
        raise ValueError(f"cannot export {fmt}")
    if fraction is not None:
        df = df.sample(fraction=fraction, seed=seed)
    target = f"{path.rstrip('/')}/version={version}"
    writer = df.write.mode("overwrite").format(fmt)
    (writer.option("header", True) if fmt == "csv" else writer).save(target)
    return target


def tier_split(df: DataFrame, ts: str, cutoff: Column) -> tuple[DataFrame, DataFrame]:
    """(hot, cold): rows at or after the cutoff, and the rest. Rows without a timestamp stay hot."""
    is_cold = F.coalesce(F.col(ts) < cutoff, F.lit(False))
    return df.filter(~is_cold), df.filter(is_cold)


def write_tiers(df: DataFrame, ts: str, cutoff: Column, root: str) -> tuple[str, str]:
    """Write both tiers; returns their paths."""
    hot, cold = tier_split(df, ts, cutoff)
    paths = (f"{root.rstrip('/')}/tier=hot", f"{root.rstrip('/')}/tier=cold")
    hot.write.mode("overwrite").parquet(paths[0])
    cold.write.mode("overwrite").option("compression", "zstd").parquet(paths[1])
    return paths


def materialize(df: DataFrame, name: str, root: str, partition_by: list[str] | None = None) -> DataFrame:
    """Store a view's rows in the gold layer, (re)register its name, return the stored table.

    With partition columns only the partitions present in ``df`` are replaced.
    """
    path = f"{root.rstrip('/')}/gold/{name}"
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    writer.parquet(path)
    stored = df.sparkSession.read.parquet(path)
    stored.createOrReplaceTempView(name)
    return stored
