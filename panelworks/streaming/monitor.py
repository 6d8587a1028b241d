"""Counters of running flows, taken from the progress that Spark reports.

A listener notes one row per micro-batch below a folder: rows read, the observed records and
errors, rows held in open windows, messages that wait in the source, and failed writes.
The table outlives the query and the driver.
"""

from __future__ import annotations

import json
import threading
import time
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from panelworks.session import write_text

COUNTERS = ("messages", "records", "errors")
_SCHEMA = (
    "run string, batch_id bigint, at timestamp, input_rows bigint, messages bigint, "
    "records bigint, errors bigint, held_rows bigint, queue_depth bigint, write_errors bigint"
)


def _total(offset: str | None) -> int | None:
    """Messages up to an offset that counts them per partition; None for other offsets."""
    try:
        counts = json.loads(offset) if offset else None
    except ValueError:
        return None
    if not isinstance(counts, dict) or not all(isinstance(n, int) for n in counts.values()):
        return None
    return sum(counts.values())


class FlowMonitor(StreamingQueryListener):
    """Add it with ``spark.streams.addListener``; ``name`` is that of the observed counters."""

    def __init__(self, spark: SparkSession, path: str, name: str = "ingest"):
        self.spark, self.path, self.name = spark, path.rstrip("/"), name
        self._lock = threading.Lock()
        self._ended: dict[str, threading.Event] = defaultdict(threading.Event)
        self._fed: dict[str, float] = {}
        self._failed = 0

    def write_failed(self, *_) -> None:
        """Count a failed write; it shows up in the next row."""
        with self._lock:
            self._failed += 1

    def onQueryStarted(self, event) -> None:
        self._fed[str(event.runId)] = time.monotonic()

    def onQueryProgress(self, event) -> None:
        p = event.progress
        run = str(p.runId)
        if p.numInputRows:
            self._fed[run] = time.monotonic()
        seen = p.observedMetrics.get(self.name)
        counted = seen.asDict() if seen is not None else {}
        with self._lock:
            failed, self._failed = self._failed, 0
        # a trigger without new data reports the counters of the one before
        counted = counted if p.numInputRows else {}
        row = {
            "run": run,
            "batch_id": p.batchId,
            "at": p.timestamp,
            "input_rows": p.numInputRows,
            **{c: counted.get(c) for c in COUNTERS},
            "held_rows": sum(s.numRowsTotal for s in p.stateOperators),
            "queue_depth": self._waiting(p.sources),
            "write_errors": failed,
        }
        name = f"{run}-{p.batchId:012d}-{time.time_ns()}.json"
        write_text(self.spark, f"{self.path}/{name}", json.dumps(row))

    @staticmethod
    def _waiting(sources) -> int | None:
        """Messages between what was read and what is there, where the sources tell."""
        pairs = [(_total(s.endOffset), _total(s.latestOffset)) for s in sources]
        known = [there - read for read, there in pairs if read is not None and there is not None]
        return sum(known) if known else None

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        self._ended[str(event.runId)].set()

    def idle_seconds(self, query: StreamingQuery) -> float:
        """Seconds since the query has read anything."""
        return time.monotonic() - self._fed.get(str(query.runId), time.monotonic())

    def await_end(self, query: StreamingQuery, seconds: float = 60) -> bool:
        """Wait until all rows of a query that has ended are noted."""
        return self._ended[str(query.runId)].wait(seconds)

    def table(self) -> DataFrame:
        """The rows noted so far, by all queries."""
        return self.spark.read.schema(_SCHEMA).json(self.path)

    def totals(self) -> DataFrame:
        """messages, records, errors and write_errors of all queries."""
        return self.table().agg(
            *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in (*COUNTERS, "write_errors")]
        )
