"""Streams joined with a dimension that is not broadcast: values, spread of a hot key, restart."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.session import scratch_path
from mercato.sources.external import StreamConfig, read_events
from mercato.streaming import sinks
from mercato.streaming.enrich import HotKeys, enrich_stream


@pytest.fixture
def shuffled(spark):
    """No automatic broadcast and no merging of small partitions: small tables are joined as large ones are."""
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def run(spark, inbox, out, checkpoint, rows_per_task):
    schema = spark.createDataFrame([], "n long, k long").schema
    stream = read_events(spark, StreamConfig(fmt="parquet", path=inbox, schema=schema, max_per_trigger=1))
    dim = spark.range(50).select(F.col("id").alias("k"), F.concat(F.lit("d"), "id").alias("name"))

    def store(batch, batch_id):
        sinks.write_upserts(batch.withColumn("task", F.spark_partition_id()), batch_id, out)

    enrich_stream(stream, dim, ["k"], store, checkpoint, rows_per_task=rows_per_task, max_bytes=0).awaitTermination()


def arrive(spark, inbox, first):
    """3,000 events: a third of key 7, some without a key, the others spread over 100 keys, half of them unknown."""
    n = F.col("id")
    key = F.when(n % 3 == 0, 7).when(n % 31 == 1, None).otherwise(n % 100)
    spark.range(first, first + 3000).select(n.alias("n"), key.cast("long").alias("k")).coalesce(1).write.mode("append").parquet(inbox)


@pytest.mark.parametrize("rows_per_task", [100, 10**6])
def test_a_hot_key_is_dealt_over_tasks(spark, shuffled, rows_per_task):
    inbox, out, checkpoint = (scratch_path(spark, x) for x in ("inbox", "out", "check"))
    arrive(spark, inbox, 0)
    run(spark, inbox, out, checkpoint, rows_per_task)
    arrive(spark, inbox, 3000)
    arrive(spark, inbox, 6000)
    run(spark, inbox, out, checkpoint, rows_per_task)
    found = spark.read.parquet(out)
    rows = {r["n"]: (r["k"], r["name"]) for r in found.collect()}
    assert found.count() == len(rows) == 9000
    for n, (k, name) in rows.items():
        assert k == (7 if n % 3 == 0 else None if n % 31 == 1 else n % 100)
        assert name == (None if k is None or k >= 50 else f"d{k}")
    tasks = {r["batch"]: r["n"] for r in found.where("k = 7").groupBy("batch").agg(F.count_distinct("task").alias("n")).collect()}
    assert len(tasks) == 3
    assert all(n >= 4 if rows_per_task == 100 else n == 1 for n in tasks.values()), tasks


def test_frequent_keys_cool_down():
    hot = HotKeys.__new__(HotKeys)
    hot.rows_per_task, hot.rows = 10, None
    hot.learn([{"item": 1, "count": 100}, {"item": 2, "count": 3}, {"item": None, "count": 900}])
    assert hot.rows == {1: 100}
    hot.learn([{"item": 3, "count": 11}])
    assert hot.rows == {1: 50, 3: 11}
    for _ in range(5):
        hot.learn(None)
    assert hot.rows == {}
