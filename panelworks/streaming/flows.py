"""Streaming forms: ingest, windows, micro-batch flush and tee, metrics.

Every builder returns either a streaming frame or a started query.  Delivery is
governed by the checkpoint: offsets are committed after the sink, and each
micro-batch owns a folder named by its number, so a replay replaces its own
output instead of adding to it.
"""

from __future__ import annotations

import logging
import threading
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from panelworks.functions import (
    common_pane,
    interval_micros,
    micros_of,
    seconds_of,
    utc_instant,
)
from panelworks.operators.aggregate import run_stats
from panelworks.operators.ranking import HEAVY_ROWS
from panelworks.operators.windows import (
    hybrid_windows,
    pane_sums,
    top_per_window,
    window_sum,
)
from panelworks.schema import PanelSpec
from panelworks.session import remove
from panelworks.sinks.commits import (
    CommitLog,
    Record,
    batch_folder,
    commit_batch,
    commit_path,
    committed,
)
from panelworks.sinks.files import TIMES, aggregated_path, write_counted
from panelworks.streaming.monitor import FlowMonitor

log = logging.getLogger(__name__)


def _zoned(df: DataFrame, spec: PanelSpec) -> DataFrame:
    """Streaming refuses time stamps without zone; they are read as UTC."""
    if isinstance(df.schema[spec.at].dataType, T.TimestampNTZType):
        return df.withColumn(spec.at, utc_instant(F.col(spec.at)))
    return df


def with_event_time(
    df: DataFrame, delay: str = "0 seconds", spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """Zoned event time with a watermark."""
    return _zoned(df, spec).withWatermark(spec.at, delay)


WINDOW = ["window_start", "window_end"]


def closing_record(
    rows: DataFrame, ahead: str = "1000 days", spec: PanelSpec = PanelSpec()
) -> DataFrame:
    """One record far ahead of all others, for the end of a finite run.

    Fed to the stream as its last input it moves the watermark past every open window, so
    all of them are emitted; its own window stays open and is never seen.  ``rows`` is a batch
    frame of what the stream selects.
    """
    last = F.col(spec.at) + F.expr(f"INTERVAL {ahead}")
    return rows.orderBy(F.desc(spec.at)).limit(1).withColumn(spec.at, last)


def tumbling_runs(
    df: DataFrame,
    duration: str = "10 seconds",
    delay: str = "1 minute",
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Value counts by (window, entity, indicator, value), emitted when a window closes.

    The value is part of the key, so the state of a hot group is spread over all
    tasks instead of growing in one buffer.  Late rows are dropped.
    """
    slot = F.window(spec.at, duration).alias("w")
    return (
        with_event_time(df, delay, spec)
        .groupBy(slot, spec.entity, spec.indicator, spec.value)
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            spec.entity,
            spec.indicator,
            spec.value,
            "n",
        )
    )


def sliding_stream(
    df: DataFrame,
    indicator: str | None = None,
    duration: str = "5 minutes",
    slide: str = "30 seconds",
    delay: str = "1 minute",
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Mean and count by (sliding window, entity), emitted when a window closes.

    Rows are folded into panes first and panes into windows, as in the batch
    form: only pane sums are copied into the overlapping windows.
    """
    rows = with_event_time(df, delay, spec).where(F.col(spec.value).isNotNull())
    if indicator is not None:
        rows = rows.where(F.col(spec.indicator) == indicator)
    pane = F.window(spec.at, common_pane(duration, slide))
    panes = rows.groupBy(pane.alias("pane"), spec.entity).agg(*pane_sums(spec))
    return (
        panes.groupBy(F.window("pane", duration, slide).alias("w"), spec.entity)
        .agg(window_sum(spec).alias("s"), F.sum("n").alias("n"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            spec.entity,
            (F.col("s") / F.col("n").cast("double")).alias("avg_value"),
            "n",
        )
    )


def _writer(df: DataFrame, checkpoint: str, every: str | None) -> DataStreamWriter:
    writer = df.writeStream.option("checkpointLocation", checkpoint).outputMode("append")
    if every is None:
        return writer.trigger(availableNow=True)
    return writer.trigger(processingTime=every)


def to_parquet(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Append a streaming frame to a Parquet folder with the built-in exactly-once sink."""
    writer = _writer(df, checkpoint, every).format("parquet").option("compression", "zstd")
    return writer.option("path", path).start()


def for_each_batch(
    df: DataFrame,
    body: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
) -> StreamingQuery:
    return _writer(df, checkpoint, every).foreachBatch(body).start()


def emergency_path(path: str) -> str:
    """Sibling folder for batches whose Parquet write failed."""
    return f"{path.rstrip('/')}_emergency.ndjson"


def flush_batch(
    batch: DataFrame,
    batch_id: int,
    path: str,
    max_rows: int | None = None,
    write: Callable[[DataFrame, str], None] | None = None,
    on_failure: Callable[[], None] | None = None,
) -> str | None:
    """Write one micro-batch as zstd Parquet, at most ``max_rows`` per file.

    If that fails the same rows go to an emergency NDJSON folder.  Whichever folder a
    replay writes, the other one of that batch is removed.  An empty batch leaves
    nothing.  Returns the folder written.
    """

    def parquet(rows: DataFrame, target: str) -> None:
        writer = rows.write.mode("overwrite").option("compression", "zstd")
        if max_rows:
            writer = writer.option("maxRecordsPerFile", max_rows)
        writer.parquet(target)

    spark = batch.sparkSession
    target, other = batch_folder(path, batch_id), batch_folder(emergency_path(path), batch_id)
    try:
        n = write_counted(batch, lambda rows: (write or parquet)(rows, target))
    except Exception:  # whatever the cause, the rows must not be lost
        log.exception("parquet flush of batch %s failed; writing %s", batch_id, other)
        if on_failure is not None:
            on_failure()
        target, other = other, target
        n = write_counted(batch, lambda rows: rows.write.mode("overwrite").json(target))
    remove(spark, other)
    if n == 0:
        remove(spark, target)
        remove(spark, target.rpartition("/")[0], only_empty=True)
        return None
    return target


def flush_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    max_rows: int | None = None,
    every: str | None = None,
    monitor: FlowMonitor | None = None,
) -> StreamingQuery:
    """Flush each micro-batch to Parquet.

    The batch size is set by the trigger and the source's rate limit, whichever
    comes first.  ``max_rows`` caps the rows per file; leave it unset where many
    small files would hurt.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        failed = monitor.write_failed if monitor else None
        flush_batch(batch, batch_id, path, max_rows, on_failure=failed)

    return for_each_batch(df, body, checkpoint, every)


def _write_windows(windows: DataFrame, path: str, batch_id: int) -> None:
    """Write a batch's windows to its folder; no folder if there are none."""
    target = batch_folder(path, batch_id)
    if write_counted(windows, lambda rows: rows.write.mode("overwrite").parquet(target)) == 0:
        remove(windows.sparkSession, target)


def top_stream(
    means: DataFrame,
    path: str,
    checkpoint: str,
    n: int = 5,
    every: str | None = None,
    spec: PanelSpec = PanelSpec(),
) -> StreamingQuery:
    """Top ``n`` of each closed window.

    All groups of a window close in the same micro-batch, so ranking inside the
    batch is exact.
    """

    def body(batch: DataFrame, batch_id: int) -> None:
        _write_windows(top_per_window(batch, n, spec), path, batch_id)

    return for_each_batch(means, body, checkpoint, every)


def tumbling_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    duration: str = "10 seconds",
    delay: str = "1 minute",
    every: str | None = None,
    spec: PanelSpec = PanelSpec(),
    heavy_rows: int = HEAVY_ROWS,
) -> StreamingQuery:
    """Window statistics with the exact median by (window, entity, indicator).

    All value counts of a window arrive in the micro-batch that closes it, so
    each batch is turned into statistics by the batch code.
    """
    keys = [*WINDOW, spec.entity, spec.indicator]

    def body(batch: DataFrame, batch_id: int) -> None:
        stats = run_stats(batch, keys, "n", spec, heavy_rows=heavy_rows)
        _write_windows(stats, path, batch_id)

    return for_each_batch(tumbling_runs(df, duration, delay, spec), body, checkpoint, every)


def _ticks(rows: DataFrame, duration: str, spec: PanelSpec) -> Column:
    """Start of a row's tick in microseconds since 1970, whatever the session's time zone."""
    start = F.window(F.col(spec.at), duration).start
    return micros_of(start, rows.schema[spec.at].dataType)


def _form(path: str) -> str:
    return "json" if path.rstrip("/").endswith(".ndjson") else "parquet"


def _write_form(rows: DataFrame, folder: str, form: str) -> int:
    options = TIMES if form == "json" else {"compression": "zstd"}
    return write_counted(
        rows, lambda x: x.write.mode("overwrite").format(form).options(**options).save(folder)
    )


@dataclass(frozen=True)
class Tee:
    """How a tee lays out and windows its rows; the same for a run and for its end."""

    raw_path: str
    aggregate_path: str
    duration: str = "10 seconds"
    size: int = 50
    shard: Sequence[str] = ()
    spec: PanelSpec = PanelSpec()
    delay: str = "1 minute"
    # a run and its end may be called from two threads
    lock: threading.RLock = field(default_factory=threading.RLock, compare=False, repr=False)

    @property
    def log_path(self) -> str:
        return commit_path(self.raw_path)

    def _windows(self, rows: DataFrame) -> DataFrame:
        return hybrid_windows(rows, self.duration, self.size, self.shard, self.spec)

    def _close(
        self, spark: SparkSession, batch_id: int, schema: T.StructType, ticks: list[list[int]]
    ) -> int:
        """Window ticks, given as (batch, tick), reading just the folders they lie in."""
        if not ticks:
            remove(spark, batch_folder(self.aggregate_path, batch_id))
            return 0
        folders = [f"{batch_folder(self.raw_path, b)}/tick={t}" for b, t in ticks]
        rows = spark.read.schema(schema).parquet(*folders)
        target = batch_folder(self.aggregate_path, batch_id)
        return _write_form(self._windows(rows), target, _form(self.aggregate_path))

    def run_batch(self, batch: DataFrame, batch_id: int) -> None:
        """Write a batch's raw rows by tick and the windows that it closes, in one commit."""
        spark, schema = batch.sparkSession, T.StructType(batch.schema.fields)
        log, spec = CommitLog(spark, self.log_path), self.spec

        def write(last: Record | None) -> tuple[dict[str, int], dict]:
            state = last.state if last else {"open": [], "upto": None, "at": None}
            seen, raw = Observation(), batch_folder(self.raw_path, batch_id)
            ticked = batch.withColumn("tick", _ticks(batch, self.duration, spec))
            at = micros_of(F.col(spec.at), schema[spec.at].dataType)
            ticked.observe(
                seen,
                F.count(F.lit(1)).alias("n"),
                F.max(at).alias("at"),
                F.collect_set("tick").alias("ticks"),
            ).write.mode("overwrite").option("compression", "zstd").partitionBy("tick").parquet(raw)
            count = seen.get["n"]
            if count == 0:
                remove(spark, raw)
                return {}, state
            latest = max(x for x in (state["at"], seen.get["at"]) if x is not None)
            low = state["upto"]
            step = interval_micros(self.duration)
            high = (latest - interval_micros(self.delay)) // step * step
            high = high if low is None else max(low, high)
            # a row of a tick that is closed already is late: it stays in the raw output only
            fresh = [[batch_id, t] for t in sorted(seen.get["ticks"]) if low is None or t >= low]
            open_ = [*state["open"], *fresh]
            closing = [x for x in open_ if x[1] < high]
            done = self._close(spark, batch_id, schema, closing)
            left = [x for x in open_ if x[1] >= high]
            return {"raw": count, "windows": done}, {"open": left, "upto": high, "at": latest}

        with self.lock:
            commit_batch(log, batch_id, write)

    def finish(self, spark: SparkSession) -> None:
        """Window the ticks that are open; rows of these ticks that come later are late."""
        with self.lock:
            self._finish(spark)

    def _finish(self, spark: SparkSession) -> None:
        log = CommitLog(spark, self.log_path)
        last = log.latest()
        if last is None or not last.state["open"]:
            return
        batch, tick = last.state["open"][0]
        schema = spark.read.parquet(f"{batch_folder(self.raw_path, batch)}/tick={tick}").schema
        folder = -1 - last.seq  # of its own, which no batch replaces
        done = self._close(spark, folder, schema, last.state["open"])
        after = interval_micros(self.duration) + max(t for _, t in last.state["open"])
        state = last.state | {"open": [], "upto": max(after, last.state["upto"])}
        log.add(last.batch_id, {"windows": done}, state, folder)

    def raw(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Raw rows of committed batches."""
        return committed(spark, self.raw_path, schema, "raw", self.log_path)

    def windows(self, spark: SparkSession, schema: T.StructType) -> DataFrame:
        """Windows of committed batches, and of ends of runs; ``schema`` is that of raw rows."""
        shape = self._windows(spark.createDataFrame([], schema)).schema
        form = _form(self.aggregate_path)
        options = TIMES if form == "json" else None
        return committed(
            spark, self.aggregate_path, shape, "windows", self.log_path, form, options
        )


def tee_stream(
    df: DataFrame,
    raw_path: str,
    aggregate_path: str | None = None,
    checkpoint: str | None = None,
    duration: str = "10 seconds",
    size: int = 50,
    shard: Sequence[str] = (),
    every: str | None = None,
    spec: PanelSpec = PanelSpec(),
    delay: str = "1 minute",
) -> StreamingQuery:
    """Each micro-batch goes to the raw sink and, as window statistics, to a side output.

    Windows are those of the batch form, whatever the micro-batches: a tick is windowed once,
    when event time has passed its end by ``delay``.  Raw rows are laid out by tick, so
    closing a tick reads that tick's rows only.  Rows of a tick that is closed already stay in
    the raw output only.  Both outputs of a batch become visible by one commit; see
    :class:`Tee` for readers.  Without ``aggregate_path`` windows go to NDJSON next to the raw
    output.  :func:`finish_tee` closes what is open at the end of a run.
    """
    side = aggregate_path or aggregated_path(raw_path)
    tee = Tee(raw_path, side, duration, size, tuple(shard), spec, delay)
    return for_each_batch(df, tee.run_batch, checkpoint or f"{raw_path}_checkpoint", every)


def finish_tee(
    spark: SparkSession,
    raw_path: str,
    aggregate_path: str | None = None,
    duration: str = "10 seconds",
    size: int = 50,
    shard: Sequence[str] = (),
    spec: PanelSpec = PanelSpec(),
) -> None:
    """Window the ticks that are open when a run of :func:`tee_stream` has ended.

    A later run goes on after them: rows that still belong to these ticks count as late.
    """
    side = aggregate_path or aggregated_path(raw_path)
    Tee(raw_path, side, duration, size, tuple(shard), spec).finish(spark)


def await_tee(
    query: StreamingQuery,
    tee: Tee,
    spark: SparkSession,
    monitor: FlowMonitor | None = None,
    idle: float | None = None,
    poll: float = 1.0,
) -> None:
    """Wait for the end of a tee and window what is open then, also when it was cancelled.

    With a monitor and ``idle`` seconds without input, open ticks are windowed while the query
    goes on.  A query that failed is left as it is: its next run takes up the open ticks.
    """
    while not query.awaitTermination(poll):
        if monitor is not None and idle is not None and monitor.idle_seconds(query) >= idle:
            tee.finish(spark)
    tee.finish(spark)


def eviction_stream(
    df: DataFrame,
    duration: str = "5 minutes",
    step: str = "30 seconds",
    delay: str = "1 minute",
    spec: PanelSpec = PanelSpec(),
) -> DataFrame:
    """Per tick, how many rows a trailing window takes in and how many it evicts.

    A row is evicted by the first tick at which it is older than ``duration``; at the edge it
    stays.  So a row counts once at its own time and once ``duration`` later, and the state is
    two counters per open tick, however many rows the window holds.  Ticks without
    either are not listed.
    """
    rows = _zoned(df, spec).select(F.col(spec.at).alias("at"))
    later = F.col("at") + F.expr(f"INTERVAL {duration}")
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    entries = F.array(
        F.struct(F.col("at").alias("x"), one.alias("arrived"), none.alias("evicted")),
        F.struct(later.alias("x"), none.alias("arrived"), one.alias("evicted")),
    )
    wait = f"{seconds_of(delay) + seconds_of(duration)} seconds"
    return (
        rows.select(F.explode(entries).alias("e"))
        .select("e.x", "e.arrived", "e.evicted")
        .withWatermark("x", wait)
        .groupBy(F.window("x", step).alias("w"))
        .agg(F.sum("arrived").alias("arrived"), F.sum("evicted").alias("evicted"))
        .select(F.col("w.end").alias("tick"), "arrived", "evicted")
    )


def counters(parsed: DataFrame) -> list:
    """Counters of an ingest frame with a ``bad`` flag: records, errors."""
    return [
        F.count(F.lit(1)).alias("messages"),
        F.count_if(~F.col("bad")).alias("records"),
        F.count_if(F.col("bad")).alias("errors"),
    ]


def observed(parsed: DataFrame, name: str = "ingest") -> DataFrame:
    """Attach the counters to a frame; they show up in each query's progress."""
    return parsed.observe(name, *counters(parsed))
