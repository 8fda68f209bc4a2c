"""Stored progress reports: none lost, none torn."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from mercato.plans import streams
from mercato.session import scratch_path
from mercato.streaming import monitor, sinks


def test_reports_outlive_the_engines_memory(spark, sf):
    """The engine is told to keep two reports at most; all four batches of two runs are in the table."""
    kept = "spark.sql.streaming.numRecentProgressUpdates"
    before = spark.conf.get(kept)
    spark.conf.set(kept, "2")
    try:
        with monitor.ProgressTable(spark, scratch_path(spark, "progress")) as table:
            runs = []
            for _ in range(2):
                df = streams.split_event_stream(spark, sf).observe("seen", F.count(F.lit(1)).alias("rows"))
                stream = sinks.write_stream_files(df, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), sinks.ONCE)
                stream.awaitTermination()
                table.wait(stream)
                runs.append(stream)
    finally:
        spark.conf.set(kept, before)
    assert len(runs[0].recentProgress) < 4
    rows = table.read().filter("num_input_rows > 0").collect()
    assert sorted((r["run_id"], r["batch_id"]) for r in rows) == sorted((str(q.runId), b) for q in runs for b in range(4))
    assert all(int(r["observed"]["seen.rows"]) == r["num_input_rows"] and r["batch_ms"] > 0 for r in rows)


def test_a_torn_report_is_not_read_and_a_failure_is_raised(spark, sf):
    table = monitor.ProgressTable(spark, scratch_path(spark, "progress"))
    out = table._fs.create(spark._jvm.org.apache.hadoop.fs.Path(f"{table.path}/_torn"), True)
    out.write(bytearray(b'{"batch_id": 1, "num'))
    out.close()
    assert table.read().collect() == []

    def broken(run, progress):
        raise OSError("no space")

    table._store = broken
    with table:
        df = streams.event_stream(spark, sf)
        stream = sinks.write_stream_files(df, scratch_path(spark, "out"), scratch_path(spark, "checkpoint"), sinks.ONCE)
        stream.awaitTermination()
        with pytest.raises(OSError, match="no space"):
            table.wait(stream)
