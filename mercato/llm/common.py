"""Helpers the training-data operators share: word pattern, stored tables, ranks without a global window."""

from __future__ import annotations

from collections.abc import Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from mercato.session import scratch_path

# Words are maximal runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` under the shared folder and read it back: no lineage, one evaluation, safe against lost executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    stored = spark.read.schema(df.schema).parquet(path)
    stored.stored_at = path
    return stored


def discard(stored: DataFrame) -> None:
    """Delete what ``store`` wrote, once a later table has replaced it."""
    spark = stored.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(stored.stored_at)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def text_of(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def only(df: DataFrame, *columns: str) -> DataFrame:
    """Just these columns, so that whatever else a table carries cannot clash with names made here."""
    return df.select(*columns)


def rank_within(df: DataFrame, keys: Sequence[str], order: Sequence[str | Column], rank: str, part: str = "part") -> DataFrame:
    """Add ``rank``, gapless from 0 within ``keys``; ``df`` must be stored and carry ``part``, a bounded chunk number.

    Ranks are made within (keys, part) and shifted by the counts of the earlier parts, so no task ever holds more than
    one part of a key, however large the key is. Keys must not be null.
    """
    counts = df.groupBy(*keys, part).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(*keys).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    shifts = counts.select(*keys, part, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_shift"))
    inside = Window.partitionBy(*keys, part).orderBy(*order)
    return (
        df.join(shifts, [*keys, part])
        .withColumn(rank, F.col("_shift") + F.row_number().over(inside) - 1)
        .drop("_shift")
    )


def small_table(spark: SparkSession, rows: list, schema: str) -> DataFrame:
    """A driver-made table whose size is bounded by the caller, marked for broadcast."""
    names = [field.split()[0] for field in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) or [[] for _ in names]
    return F.broadcast(spark.createDataFrame(pa.table([pa.array(c) for c in columns], names=names), schema))
