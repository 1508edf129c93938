"""The jobs: capture to messages, messages to tables, streams with a dimension."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from ..functions.envelope import OP_DELETE, parse_envelope, parse_pairs, parse_rows
from ..operators.capture import diff_changes, encode_changes, include_tables, snapshot_changes, start_changes
from ..operators.routing import (
    REJECT,
    UNROUTED,
    Route,
    dim_rows,
    reject_null_keys,
    route_changes,
    routed_rows,
)
from ..operators.upsert import stamp_partition
from ..sinks.messages import to_kafka_columns, with_parallelism, with_partition_key
from ..sinks.tables import TableSpec, ensure_table, upsert_table
from ..streaming.fan_out import fan_out
from ..streaming.options import JobOptions, rocksdb_state
from ..streaming.temporal import temporal_join_stream


def capture_table(
    old: DataFrame | None,
    new: DataFrame,
    keys: Sequence[str],
    db: str,
    table: str,
    *,
    ts_ms: Column | None = None,
    decimal_mode: str = "string",
) -> DataFrame:
    """Change events of one table as ``value`` text.

    With no earlier version every row is a read event, otherwise the events
    are the differences between the versions.
    """
    if old is None:
        return snapshot_changes(new, db, table, ts_ms=ts_ms, decimal_mode=decimal_mode)
    changes = diff_changes(old, new, keys)
    return encode_changes(changes, db, table, ts_ms=ts_ms, decimal_mode=decimal_mode)


def select_changes(changes: DataFrame, dbs: str, tables: str) -> DataFrame:
    """Events whose database and table are on the include lists, as received."""
    parsed = parse_envelope(changes, ["_"])
    return include_tables(parsed, dbs, tables).select(*changes.columns)


def capture_to_topic(
    changes: DataFrame,
    parallel: int | None = None,
    key: Column | None = None,
    seq: str | None = None,
    rows: int = 0,
) -> DataFrame:
    """Events as Kafka message columns, spread over ``parallel`` writers if
    given. With a key its changes go through one writer, in the order of ``seq``.
    Of a log of about ``rows`` each writer takes its share in tasks of limited size."""
    spread = with_parallelism(changes, parallel, key, seq, rows) if parallel else changes
    return to_kafka_columns(spread, key)


def capture_to_shards(
    changes: DataFrame,
    parallel: int | None = None,
    columns: Sequence[str] = (),
    constant: str | None = None,
) -> DataFrame:
    """Events with the shard key of a partitioned stream, grouped by it only
    if ``parallel`` is given: a constant key then means a single writer."""
    return with_partition_key(changes, columns, constant, partitions=parallel)


def topic_to_tables(
    changes: DataFrame,
    routes: Sequence[Route],
    specs: Mapping[str, TableSpec],
    checkpoint: str,
    *,
    order: Sequence[str] = (),
    deletes: str = "ignore",
    stamp: Column | None = None,
    hour: str = "hh",
    dead_letters: str | None = None,
    name: str = "changes-to-tables",
    trigger: dict | None = None,
    parallel: int = 4,
) -> StreamingQuery:
    """Keep one partitioned table per route up to date from a change stream.

    ``order`` names stream columns that decide between equal precombine values
    (for Kafka: timestamp, partition, offset). ``dead_letters`` is a folder
    for unrouted and rejected changes, one subfolder per batch. Their counts are
    in each batch's progress, as the observed metrics ``not_stored``.
    """
    spark = changes.sparkSession
    for r in routes:
        ensure_table(spark, specs[r.dest])
    routed = route_changes(changes, routes, deletes=deletes)
    routed = reject_null_keys(routed, routes, {d: s.keys for d, s in specs.items()})
    kinds = {"unrouted": UNROUTED, "rejected": REJECT}
    counts = [F.count_if(F.col("dest") == dest).alias(kind) for kind, dest in kinds.items()]
    stamped = stamp_partition(routed, stamp, hour=hour).observe("not_stored", *counts)

    def table_writer(route: Route):
        spec = specs[route.dest]
        kept = [*order, *spec.partition_by]

        def write(rows: DataFrame, batch_id: int) -> None:
            if deletes == "apply":
                rows = rows.withColumn("_deleted", F.col("op") == OP_DELETE)
                typed = routed_rows(rows, route, keep=[*kept, "_deleted"])
                upsert_table(spec, typed, order, deleted="_deleted")
            else:
                upsert_table(spec, routed_rows(rows, route, keep=kept), order)

        return write

    def letters_writer(kind: str):
        def write(rows: DataFrame, batch_id: int) -> None:
            # One folder per batch: a repeated batch replaces its own letters.
            rows.select("value", "reject_reason").write.mode("overwrite").parquet(
                f"{dead_letters.rstrip('/')}/kind={kind}/batch={batch_id}"
            )

        return write

    writers = {r.dest: table_writer(r) for r in routes}
    if dead_letters:
        writers[UNROUTED] = letters_writer("unrouted")
        writers[REJECT] = letters_writer("reject")
    else:
        # What no writer reads is not kept either while they run.
        read = ["dest", "table", "op", "after", *order, *(c for r in routes for c in specs[r.dest].partition_by)]
        stamped = stamped.where(F.col("dest").isin([*writers])).select(*dict.fromkeys(read))
    return fan_out(stamped, writers, checkpoint, name=name, trigger=trigger, parallel=parallel)


def topic_with_dimension(
    facts: DataFrame,
    dim_changes: DataFrame,
    *,
    db: str,
    table: str,
    seq: str | Sequence[str],
    fact_columns: Sequence[str] = ("id", "name"),
    dim_columns: Sequence[str] = ("id", "name", "create_time", "modify_time"),
    key: str = "id",
    unmatched: str = "drop",
    errors: str = "reject",
    how: str = "inner",
    spread: int = 1,
) -> DataFrame:
    """JSON facts joined to the latest row of a captured dimension table.

    A fact that is no JSON object has null fields; ``errors="fail"`` stops the job.
    """
    kept = [seq] if isinstance(seq, str) else list(seq)
    dims = dim_rows(dim_changes, db, table, dim_columns, keep=kept, unmatched=unmatched, errors=errors)
    rows = parse_rows(facts, fact_columns, keep=kept, errors="fail" if errors == "fail" else "null")
    return temporal_join_stream(rows, dims, key, seq, how=how, spread=spread)


def lines_with_dimension(
    facts: DataFrame,
    dims: DataFrame,
    seq: str | Sequence[str],
    *,
    errors: str = "reject",
    how: str = "inner",
    spread: int = 1,
) -> DataFrame:
    """Two streams of ``id,name`` lines: facts joined to the latest dimension."""
    kept = [seq] if isinstance(seq, str) else list(seq)

    def pairs(lines: DataFrame) -> DataFrame:
        rows = parse_pairs(lines, keep=kept, errors=errors)
        return rows.where(F.col("parse_error").isNull()).drop("parse_error")

    return temporal_join_stream(pairs(facts), pairs(dims), "id", seq, how=how, spread=spread)


# The jobs driven by options; sources are opened by the caller --------------


def run_capture(
    options: JobOptions,
    log: DataFrame,
    snapshot: DataFrame | None = None,
    *,
    at: object = None,
    key: Column | None = None,
    seq: str = "seq",
) -> DataFrame:
    """Message columns of the changes on the include lists, from the options'
    position on, by their number of writers."""
    started = start_changes(snapshot, log, options.position, at, seq)
    chosen = select_changes(started, options.db_list, options.table_list)
    # Counted before decoding, which needs no column of most sources.
    rows = 0 if started.isStreaming else started.count()
    return capture_to_topic(chosen, options.parallel, key, None if key is None else seq, rows)


def run_tables(
    options: JobOptions,
    changes: DataFrame,
    routes: Sequence[Route],
    specs: Mapping[str, TableSpec],
    **more: object,
) -> StreamingQuery:
    """``topic_to_tables`` with the options' checkpoint, trigger, name and parallelism."""
    return topic_to_tables(
        changes,
        routes,
        specs,
        options.checkpoint_dir,
        name=options.name or "changes-to-tables",
        trigger=options.trigger,
        parallel=options.parallel,
        **more,
    )


def run_join(
    options: JobOptions, joined: DataFrame, sink: Callable[[DataStreamWriter], DataStreamWriter]
) -> StreamingQuery:
    """Start a joined stream with the options' checkpoint, trigger and name;
    ``sink`` adds the output to the writer. Keyed state is kept in RocksDB, by
    this query only."""
    writer = joined.writeStream.option("checkpointLocation", options.checkpoint_dir).trigger(**options.trigger)
    writer = sink(writer.queryName(options.name) if options.name else writer)
    with rocksdb_state(joined.sparkSession):
        return writer.start()
