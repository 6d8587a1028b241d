from panelworks.streaming.flows import (
    WINDOW,
    Tee,
    await_tee,
    closing_record,
    counters,
    emergency_path,
    eviction_stream,
    finish_tee,
    flush_batch,
    flush_stream,
    for_each_batch,
    observed,
    sliding_stream,
    tee_stream,
    to_parquet,
    top_stream,
    tumbling_runs,
    tumbling_stream,
    with_event_time,
)
from panelworks.streaming.monitor import FlowMonitor

__all__ = [
    "WINDOW",
    "FlowMonitor",
    "Tee",
    "await_tee",
    "closing_record",
    "counters",
    "emergency_path",
    "eviction_stream",
    "finish_tee",
    "flush_batch",
    "flush_stream",
    "for_each_batch",
    "observed",
    "sliding_stream",
    "tee_stream",
    "to_parquet",
    "top_stream",
    "tumbling_runs",
    "tumbling_stream",
    "with_event_time",
]
