"""Change data at scale on Spark: encode, route, upsert and join by time."""

from .functions.envelope import (
    generic_rows,
    parse_envelope,
    parse_pairs,
    parse_rows,
    project_after,
    to_envelope,
)
from .operators.capture import (
    apply_changes,
    diff_changes,
    encode_changes,
    include_tables,
    snapshot_changes,
    start_changes,
)
from .operators.completeness import offset_faults
from .operators.digest_diff import (
    diff_in_ranges,
    differing_ranges,
    range_digests,
    row_count_changes,
)
from .operators.drift import field_drift
from .operators.routing import (
    Route,
    dim_rows,
    rejected_rows,
    route_changes,
    routed_rows,
    unrouted_rows,
)
from .operators.snapshot import (
    KeyRange,
    key_ranges,
    reconciled,
    snapshot_in_ranges,
    snapshot_marks,
    snapshot_rows,
)
from .operators.temporal import as_of, temporal_join, versioned
from .operators.upsert import latest_per_key, merge_upsert, stamp_partition
from .sinks.event_order import drop_tombstones, upsert_in_event_order
from .sinks.key_places import locate_keys, upsert_by_place
from .sinks.messages import (
    console,
    kafka_sink_options,
    to_kafka_columns,
    with_parallelism,
    with_partition_key,
)
from .sinks.shards import request_batches, shard_places, with_shard
from .sinks.tables import TableSpec, ensure_table, remove_old_versions, upsert_table
from .sinks.version_table import VersionSpec, stored_versions, update_versions
from .sources import changes_from_events, jdbc_options, kafka_source_options, read_changes, read_lines
from .streaming.fan_out import fan_out
from .streaming.once import batch_folder, finished_batches, first_of_each, once_per_batch, written_once
from .streaming.options import JobOptions, rocksdb_state, use_rocksdb_state
from .streaming.state_join import temporal_join_state
from .streaming.temporal import temporal_join_stream

__all__ = [n for n in dir() if not n.startswith("_")]
