"""The operators as Structured Streaming queries, and where results go."""

from .changes import compacted, stream_window_changes
from .lateness import BOUNDED, MONOTONOUS, RELAXED, judged_lateness, with_watermark
from .sinks import (
    JdbcTarget,
    changelog,
    fan_out,
    kafka_writer_options,
    print_rows,
    to_kafka_value,
    write_files,
    write_jdbc,
    write_kafka,
)
from .stateful import (
    averages_in_state,
    stream_adaptive_average,
    stream_inactive_keys,
    stream_latest_per_tick,
    stream_tick_advice,
    stream_window_advice,
)
from .windowed import stream_window_averages

__all__ = [
    "BOUNDED",
    "MONOTONOUS",
    "RELAXED",
    "JdbcTarget",
    "averages_in_state",
    "changelog",
    "compacted",
    "fan_out",
    "judged_lateness",
    "kafka_writer_options",
    "print_rows",
    "stream_adaptive_average",
    "stream_inactive_keys",
    "stream_latest_per_tick",
    "stream_tick_advice",
    "stream_window_advice",
    "stream_window_averages",
    "stream_window_changes",
    "to_kafka_value",
    "with_watermark",
    "write_files",
    "write_jdbc",
    "write_kafka",
]
