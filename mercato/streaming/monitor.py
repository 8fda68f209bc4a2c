"""Metrics of running streams as rows."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery, StreamingQueryListener

PROGRESS = (
    "batch_id bigint, num_input_rows bigint, input_rate double, process_rate double, batch_ms bigint, "
    "watermark string, state_rows bigint, dropped_by_watermark bigint, lag bigint"
)


def _progress_row(p) -> tuple:
    """The fields of ``PROGRESS`` in one report."""
    states = p.stateOperators or []
    lags = [s.metrics.get("maxOffsetsBehindLatest") for s in p.sources if s.metrics]
    known = [int(x) for x in lags if x is not None]
    return (
        p.batchId,
        p.numInputRows,
        float(p.inputRowsPerSecond or 0.0),
        float(p.processedRowsPerSecond or 0.0),
        p.durationMs.get("triggerExecution"),
        (p.eventTime or {}).get("watermark"),
        sum(s.numRowsTotal for s in states),
        sum(s.numRowsDroppedByWatermark for s in states),
        max(known) if known else None,
    )


def progress_rows(spark: SparkSession, query: StreamingQuery) -> DataFrame:
    """One row per recent micro-batch: rates, duration, watermark, state size, late rows and source lag.

    The engine keeps a bounded number of progress reports, so the driver holds little.
    """
    return spark.createDataFrame([_progress_row(p) for p in query.recentProgress], PROGRESS)


class ProgressTable(StreamingQueryListener):
    """Every progress report of every stream of the session as a row of a table, however many there are.

    The engine forgets all but the last reports; this listener stores each when it comes, as one small JSON file named
    after run and batch, written aside and renamed, so a torn write is never read. Observed metrics of the batch stand
    beside it. Use it as a context: ``with ProgressTable(spark, path) as table`` adds and removes the listener. Reports
    arrive after their batch; ``wait`` returns when all of a stream are stored and raises what went wrong in storing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        self._ended: dict[str, threading.Event] = {}
        self._failed: dict[str, Exception] = {}
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        self._fs = folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
        self._fs.mkdirs(folder)

    def __enter__(self) -> ProgressTable:
        self.spark.streams.addListener(self)
        return self

    def __exit__(self, *_: object) -> None:
        self.spark.streams.removeListener(self)

    def _end(self, run: str) -> threading.Event:
        return self._ended.setdefault(run, threading.Event())

    def onQueryStarted(self, event) -> None:
        self._end(str(event.runId))

    def onQueryProgress(self, event) -> None:
        run = str(event.progress.runId)
        try:
            self._store(run, event.progress)
        except Exception as e:  # noqa: BLE001 - the engine would only log it; wait() raises it
            self._failed[run] = e

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._end(str(event.runId)).set()

    def _store(self, run: str, p) -> None:
        names = [field.split()[0] for field in PROGRESS.split(", ")]
        row = {"query": p.name, "run_id": run, "at": p.timestamp, **dict(zip(names, _progress_row(p), strict=True))}
        row["observed"] = {f"{k}.{c}": str(v) for k, m in (p.observedMetrics or {}).items() for c, v in m.asDict().items()}
        place = self.spark._jvm.org.apache.hadoop.fs.Path
        aside, final = place(f"{self.path}/_{run}-{p.batchId}"), place(f"{self.path}/{run}-{p.batchId:012d}.json")
        out = self._fs.create(aside, True)
        out.write(bytearray(json.dumps(row).encode()))
        out.close()
        # an idle stream reports its last batch again
        if self._fs.exists(final):
            self._fs.delete(final, False)
        if not self._fs.rename(aside, final):
            raise OSError(f"cannot store {final}")

    def wait(self, query: StreamingQuery, seconds: float = 60.0) -> None:
        """Until every report of a stream that has ended is stored."""
        run = str(query.runId)
        if not self._end(run).wait(seconds):
            raise TimeoutError(f"no end of {run} was reported in {seconds} seconds")
        if run in self._failed:
            raise self._failed[run]

    def read(self) -> DataFrame:
        """The table: query, run_id, at, the columns of ``PROGRESS`` and ``observed`` (name.column → value)."""
        schema = f"query string, run_id string, at string, {PROGRESS}, observed map<string, string>"
        return self.spark.read.schema(schema).json(self.path)
