"""Streams over files: recovery, replay, compaction, lateness, timeouts."""

from __future__ import annotations

import time

import pytest
from pyspark.sql import functions as F

from mercato.session import scratch_path, shared_dir
from mercato.sources.external import StreamConfig, read_events
from mercato.streaming import monitor, sinks, state, windows

SCHEMA = "event_time timestamp, customer_id long, price double"


def arrive(spark, inbox: str, *rows) -> None:
    df = spark.createDataFrame([*rows], "t string, customer_id long, price double")
    df.select(F.col("t").cast("timestamp").alias("event_time"), "customer_id", "price").coalesce(1).write.mode(
        "append"
    ).parquet(inbox)


def stream(spark, inbox: str):
    schema = spark.createDataFrame([], SCHEMA).schema
    return read_events(spark, StreamConfig(fmt="parquet", path=inbox, schema=schema, max_per_trigger=1))


def folders(spark, n=3):
    return [scratch_path(spark, f"test{i}") for i in range(n)]


def test_late_events_are_dropped_between_batches(spark):
    inbox, out, check = folders(spark)
    # late rows are judged by the watermark that the batch before started with
    for t in ("12:00:00", "12:20:00", "12:20:30", "12:05:00", "12:15:00"):
        arrive(spark, inbox, (f"2024-01-01 {t}", 1, 1.0))
    df = windows.with_lateness(stream(spark, inbox), "event_time")
    found = windows.tumbling(df, "event_time", "1 minute", ["customer_id"], [F.count(F.lit(1)).alias("n")])
    query = sinks.upsert_sink(found, out, ["window_start", "customer_id"], check)
    query.awaitTermination()
    starts = sorted(r["window_start"].strftime("%H:%M") for r in sinks.read_upserted(spark, out, ["window_start", "customer_id"]).collect())
    assert starts == ["12:00", "12:15", "12:20"]
    progress = monitor.progress_rows(spark, query)
    assert progress.agg(F.sum("dropped_by_watermark")).first()[0] == 1
    assert progress.agg(F.sum("num_input_rows")).first()[0] == 5


def test_late_report_by_hand(spark):
    rows = [(i, f"2024-01-01 {t}") for i, t in enumerate(("12:00:00", "12:20:00", "12:05:00", "12:15:00"))]
    df = spark.createDataFrame(rows, "i int, t string").withColumn("ts", F.col("t").cast("timestamp"))
    report = windows.late_report(df, "ts", [F.col("i")], {"10m": 600, "1m": 60})
    assert {r["delay"]: r["dropped"] for r in report.collect()} == {"10m": 1, "1m": 2}


def test_restart_continues_and_replay_does_not_double(spark):
    inbox, out, check = folders(spark)
    arrive(spark, inbox, ("2024-01-01 12:00:00", 1, 2.0))
    keys = ["window_start", "customer_id"]

    def run(checkpoint):
        df = windows.with_lateness(stream(spark, inbox), "event_time")
        found = windows.tumbling(df, "event_time", "5 minutes", ["customer_id"], [F.sum("price").alias("revenue")])
        sinks.upsert_sink(found, out, keys, checkpoint).awaitTermination()
        return [r["revenue"] for r in sinks.read_upserted(spark, out, keys).collect()]

    assert run(check) == [2.0]
    arrive(spark, inbox, ("2024-01-01 12:01:00", 1, 3.0))
    assert run(check) == [5.0]
    assert run(check) == [5.0]
    sinks.compact(spark, out, keys)
    assert run(scratch_path(spark, "fresh-checkpoint")) == [5.0]


def test_running_spend_over_batches(spark):
    inbox, out, check = folders(spark)
    for i in range(3):
        arrive(spark, inbox, *[(f"2024-01-01 12:0{i}:00", 1, 0.1 * j) for j in range(20)], ("2024-01-01 12:00:00", 2, 1.5))
    sinks.upsert_sink(state.running_spend(stream(spark, inbox), "customer_id", "price"), out, ["customer_id"], check).awaitTermination()
    stored = sinks.read_upserted(spark, out, ["customer_id"])
    totals = {r["customer_id"]: (r["total_spend"], r["order_count"]) for r in state.fold_spend(stored, "customer_id").collect()}
    assert totals == {1: (57.0, 60), 2: (4.5, 3)}


def test_totals_survive_the_time_to_live(spark):
    """In processing time a key that expires and comes back keeps what it had: the second state is a second epoch."""
    inbox, out, check = folders(spark)
    keys = ["customer_id", *state.SPEND_KEYS]
    arrive(spark, inbox, ("2024-01-01 12:00:00", 1, 1.0))
    with state.rocksdb(spark):
        df = state.expiring_spend(stream(spark, inbox), "customer_id", "price", "1 SECOND")
        query = sinks.upsert_sink(df, out, keys, check, trigger={"processingTime": "0 seconds"}, order=["orders"])

    def wait(done):
        deadline = time.time() + 60
        while not done():
            assert time.time() < deadline and query.isActive
            time.sleep(0.2)

    try:
        wait(lambda: query.lastProgress and query.lastProgress.batchId >= 0 and query.lastProgress.numInputRows)
        time.sleep(1.5)
        arrive(spark, inbox, ("2024-01-01 12:30:00", 1, 2.5))
        wait(lambda: sinks.read_upserted(spark, out, keys).count() == 2)
    finally:
        query.stop()
    totals = state.fold_spend(sinks.read_upserted(spark, out, keys), "customer_id").collect()
    assert [(r["customer_id"], r["total_spend"], r["order_count"]) for r in totals] == [(1, 3.5, 2)]


def test_quiet_keys_leave_the_state_and_come_back(spark):
    """By event time: customer 1 is quiet for an hour, 2 is not, hot customer 3 has several partial states."""
    inbox, out, check = folders(spark)
    keys = ["customer_id", *state.SPEND_KEYS]
    hot = spark.createDataFrame([(3, 4)], "customer_id long, _parts int")
    seen = []

    def run():
        df = windows.with_lateness(stream(spark, inbox), "event_time")
        timed = state.expiring_spend(df, "customer_id", "price", "1 HOUR", time="event_time", hot=hot)
        query = sinks.upsert_sink(timed, out, keys, check, order=["orders"])
        query.awaitTermination()
        seen.append([p.stateOperators[0].numRowsTotal for p in query.recentProgress if p.stateOperators])

    with state.rocksdb(spark):
        hour = [("2024-01-01 12:00:00", 3, float(i)) for i in range(40)]
        for rows in (
            [("2024-01-01 12:00:00", 1, 1.0), ("2024-01-01 12:00:00", 2, 1.0), *hour],
            [("2024-01-01 12:50:00", 2, 2.0)],
            [("2024-01-01 13:40:00", 2, 4.0)],
            [("2024-01-01 13:45:00", 1, 8.0), ("2024-01-01 13:45:00", 3, 100.0)],
        ):
            arrive(spark, inbox, *rows)
            run()
    stored = sinks.read_upserted(spark, out, keys)
    epochs = {r["customer_id"]: r["n"] for r in stored.groupBy("customer_id").agg(F.count_distinct("epoch").alias("n")).collect()}
    assert epochs == {1: 2, 2: 1, 3: 2}
    salts = {r["customer_id"]: r["n"] for r in stored.groupBy("customer_id").agg(F.count_distinct("salt").alias("n")).collect()}
    assert salts[1] == salts[2] == 1 and salts[3] > 1
    totals = {r["customer_id"]: (r["total_spend"], r["order_count"]) for r in state.fold_spend(stored, "customer_id").collect()}
    assert totals == {1: (9.0, 2), 2: (7.0, 3), 3: (880.0, 41)}
    flat = [n for run in seen for n in run]
    assert min(flat[flat.index(max(flat)) :]) < max(flat)  # state rows fall when keys expire


@pytest.mark.parametrize("slots", [1, 64])
def test_keys_that_share_a_slot_end_one_by_one(spark, slots):
    """Whether in one slot or apart: customer 1 and those without a number are quiet for an hour, 2 never is."""
    inbox, out, check = folders(spark)
    keys = ["customer_id", *state.SPEND_KEYS]
    with state.rocksdb(spark):
        for rows in (
            [("2024-01-01 12:00:00", c, 1.0) for c in (1, 2, None, 1, None)],
            [("2024-01-01 12:50:00", 2, 2.0)],
            [("2024-01-01 13:40:00", 2, 4.0)],
            [("2024-01-01 13:45:00", c, 8.0) for c in (1, 2, None)],
        ):
            arrive(spark, inbox, *rows)
            df = windows.with_lateness(stream(spark, inbox), "event_time")
            timed = state.expiring_spend(df, "customer_id", "price", "1 HOUR", time="event_time", slots=slots)
            sinks.upsert_sink(timed, out, keys, check, order=["orders"]).awaitTermination()
    stored = sinks.read_upserted(spark, out, keys)
    epochs = {r["customer_id"]: r["n"] for r in stored.groupBy("customer_id").agg(F.count_distinct("epoch").alias("n")).collect()}
    assert epochs == {1: 2, 2: 1, None: 2}
    totals = {r["customer_id"]: (r["total_spend"], r["order_count"]) for r in state.fold_spend(stored, "customer_id").collect()}
    assert totals == {1: (10.0, 3), 2: (15.0, 4), None: (10.0, 3)}


def test_console_sink_and_complete_mode(spark):
    inbox, _, _ = folders(spark)
    arrive(spark, inbox, ("2024-01-01 12:00:00", 1, 1.0))
    query = sinks.write_console(stream(spark, inbox).groupBy("customer_id").count(), "complete")
    query.awaitTermination()
    assert query.exception() is None and query.lastProgress.numInputRows == 1


def test_shared_dir_is_the_sessions(spark):
    assert shared_dir(spark) == spark.sparkContext.getCheckpointDir().rsplit("/", 1)[0].replace("file:", "")


def test_arrivals_are_written_by_many_tasks(spark):
    """Every micro-batch is one arrival, read from as many files as there are tasks."""
    from mercato.plans import streams

    out, check = folders(spark, 2)
    named = streams.split_event_stream(spark, "/root/testdata/sf0.01").select("event_time", F.input_file_name().alias("file"))
    sinks.write_stream_batch(named, lambda b, i: sinks.write_upserts(b, i, out), check, trigger=sinks.ONCE).awaitTermination()
    per = spark.read.parquet(out).groupBy("batch").agg(F.count_distinct("file").alias("files"), F.min("event_time").alias("lo"), F.max("event_time").alias("hi"))
    found = per.orderBy("batch").collect()
    assert [r["files"] for r in found] == [spark.sparkContext.defaultParallelism] * 4
    assert all(a["hi"] < b["lo"] for a, b in zip(found, found[1:], strict=False))


def test_one_minute_trigger(spark):
    """The default trigger of the file sink: what comes after the first batch waits for the next full minute."""
    inbox, out, check = folders(spark)
    arrive(spark, inbox, ("2024-01-01 12:00:00", 1, 1.0))
    query = sinks.write_stream_files(stream(spark, inbox), out, check)
    try:
        end = time.time() + 150
        while not any(p["numInputRows"] for p in query.recentProgress) and time.time() < end:
            time.sleep(0.2)
        arrive(spark, inbox, ("2024-01-01 12:01:00", 2, 2.0))
        while sum(p["numInputRows"] for p in query.recentProgress) < 2 and time.time() < end:
            time.sleep(0.2)
        batches = [p for p in query.recentProgress if p["numInputRows"]]
    finally:
        query.stop()
    assert [(p["batchId"], p["numInputRows"]) for p in batches] == [(0, 1), (1, 1)]
    assert batches[1]["timestamp"][17:19] == "00"  # the second began on a full minute
    assert spark.read.parquet(out).count() == 2
