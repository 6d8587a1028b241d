from panelworks.sources.datasets import empty_panel, latest_dataset, load_latest, read_panel
from panelworks.sources.fetch import fetch_from
from panelworks.sources.keyed_log import log_stream, partition_of, read_log, write_log
from panelworks.sources.messages import broker_options, broker_stream, parse_messages, text_stream
from panelworks.sources.ndjson import (
    first_records,
    lenient_records,
    load_raw,
    read_dimension,
    scan_lenient,
    with_input_order,
)

__all__ = [
    "broker_options",
    "broker_stream",
    "empty_panel",
    "fetch_from",
    "first_records",
    "latest_dataset",
    "lenient_records",
    "load_latest",
    "load_raw",
    "log_stream",
    "parse_messages",
    "partition_of",
    "read_dimension",
    "read_log",
    "read_panel",
    "scan_lenient",
    "text_stream",
    "with_input_order",
    "write_log",
]
