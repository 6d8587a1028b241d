from panelworks.sinks.commits import (
    CommitLog,
    Record,
    batch_folder,
    commit_batch,
    commit_path,
    committed,
)
from panelworks.sinks.files import (
    aggregated_path,
    append_aggregates,
    append_ndjson,
    committed_aggregates,
    write_by_indicator,
    write_parquet,
    write_rejected,
)
from panelworks.sinks.messages import (
    SinkSpec,
    broker_sink_options,
    message_columns,
    to_messages,
    write_to,
)

__all__ = [
    "CommitLog",
    "Record",
    "SinkSpec",
    "aggregated_path",
    "append_aggregates",
    "append_ndjson",
    "batch_folder",
    "broker_sink_options",
    "commit_batch",
    "commit_path",
    "committed",
    "committed_aggregates",
    "message_columns",
    "to_messages",
    "write_by_indicator",
    "write_parquet",
    "write_rejected",
    "write_to",
]
