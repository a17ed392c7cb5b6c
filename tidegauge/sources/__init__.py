"""Where ticks come from: Kafka topics, files of JSON lines, event tables."""

from .kafka import kafka_reader_options, read_kafka
from .ticks import decode_ticks, normalise_ticks, read_json_lines, stream_events, table_events, ticks_from_events

__all__ = [
    "decode_ticks",
    "kafka_reader_options",
    "normalise_ticks",
    "read_json_lines",
    "read_kafka",
    "stream_events",
    "table_events",
    "ticks_from_events",
]
