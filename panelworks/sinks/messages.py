"""Message sink: one keyed JSON message per record, and the switchable sink."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelworks.functions import rfc3339
from panelworks.schema import MESSAGE_TOPIC, PanelSpec
from panelworks.sinks.files import append_ndjson
from panelworks.sources.keyed_log import write_log


def message_columns(
    df: DataFrame, spec: PanelSpec = PanelSpec(), columns: Sequence[str] | None = None
) -> dict[str, Column]:
    """The key and the value of a row's message."""
    fields = []
    for c in columns or spec.columns:
        is_time = isinstance(df.schema[c].dataType, (T.TimestampType, T.TimestampNTZType))
        fields.append((rfc3339(F.col(c)) if is_time else F.col(c)).alias(c))
    return {"key": F.col(spec.entity), "value": F.to_json(F.struct(*fields))}


def to_messages(
    df: DataFrame, spec: PanelSpec = PanelSpec(), columns: Sequence[str] | None = None
) -> DataFrame:
    """(key, value): the entity as key, the record as JSON with an RFC 3339 time.

    The broker hashes the key, so all records of an entity stay in one partition
    and in order.
    """
    return df.select(*[c.alias(n) for n, c in message_columns(df, spec, columns).items()])


@dataclass(frozen=True)
class SinkSpec:
    """Where records go: ``file`` (NDJSON folder), ``log`` (keyed log in a shared folder) or
    ``kafka`` (topic)."""

    kind: str = "file"
    path: str | None = None
    brokers: str = "localhost:9092"
    topic: str = MESSAGE_TOPIC


def broker_sink_options(sink: SinkSpec) -> dict[str, str]:
    """Leader acknowledgement only, as batches of up to 500 ms."""
    return {
        "kafka.bootstrap.servers": sink.brokers,
        "topic": sink.topic,
        "kafka.acks": "1",
        "kafka.linger.ms": "500",
    }


def write_to(df: DataFrame, sink: SinkSpec, spec: PanelSpec = PanelSpec()) -> None:
    """Write records to whichever sink is configured."""
    if sink.kind == "log":
        named = [c.alias(n) for n, c in message_columns(df, spec).items()]
        order = {f"order_{k}": F.col(c) for k, c in enumerate(spec.order) if c in df.columns}
        messages = df.select(*named, *[c.alias(n) for n, c in order.items()])
        write_log(messages, sink.path, list(order))
    elif sink.kind == "kafka":
        writer = to_messages(df, spec).write.format("kafka")
        writer.options(**broker_sink_options(sink)).save()
    elif sink.kind == "file":
        append_ndjson(df, sink.path)
    else:
        raise ValueError(f"unknown sink {sink.kind!r}")
