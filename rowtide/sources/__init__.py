"""Where change events and rows come from."""
from .changelog import (
    jdbc_options,
    kafka_source_options,
    read_changes,
    read_lines,
)
from .events_log import changes_from_events

__all__ = [
    "changes_from_events",
    "jdbc_options",
    "kafka_source_options",
    "read_changes",
    "read_lines",
]
