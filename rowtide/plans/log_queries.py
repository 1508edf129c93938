"""Registered queries over running logs: snapshots, state, tombstones, versions.

Like those of ``queries``, each takes ``(spark, sf_dir)``; their SQL is in
``log_checks``.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.completeness import offset_faults
from ..operators.digest_diff import diff_in_ranges, row_count_changes
from ..operators.drift import field_drift
from ..operators.snapshot import (
    KeyRange,
    key_ranges,
    reconciled,
    snapshot_in_ranges,
    snapshot_marks,
    snapshot_rows,
)
from ..operators.upsert import latest_per_key, merge_upsert
from ..sinks.event_order import buried, upsert_in_event_order
from ..sinks.key_places import upsert_by_place
from ..sinks.shards import request_batches, shard_places, with_shard
from ..sinks.tables import TableSpec, ensure_table
from ..sinks.version_table import VersionSpec, stored_versions, update_versions
from ..sources.events_log import TIME_PATTERN
from ..storage import new_folder
from ..streaming.once import batch_folder, first_of_each, once_per_batch, written_once
from ..streaming.options import rocksdb_state
from ..streaming.state_join import temporal_join_state
from .queries import _dims, _facts, _in_slices, table

SNAPSHOT_PARTS = (2, 5)
ORDER_COLUMNS = ["o_orderkey", "o_orderstatus", "o_totalprice"]


def order_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log over ``orders``: each event sets the status and price of some order,
    known or new, and an ``error`` deletes it."""
    events = table(spark, sf_dir, "events")
    count = table(spark, sf_dir, "orders").agg(F.max("o_orderkey")).first()[0] // 4 + 50
    return events.select(
        (F.col("event_id") * 7919 % count * 4 + 1).alias("o_orderkey"),
        F.col("event_type").alias("o_orderstatus"),
        F.col("value").alias("o_totalprice"),
        F.col("event_id").alias("seq"),
        (F.col("event_type") == "error").alias("gone"),
    )


def _orders_at(orders: DataFrame, log: DataFrame, moment: int, part: KeyRange) -> DataFrame:
    """The rows of a range of ``orders`` as they are at a position of its log."""
    mine = part.holds(F.col("o_orderkey"))
    stored = orders.where(mine).select(*ORDER_COLUMNS)
    changes = log.where(mine & (F.col("seq") <= moment))
    return merge_upsert(stored, changes, ["o_orderkey"], "seq", deleted="gone")


def snapshot_with_running_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``orders`` read in ranges while its log goes on, stopped half-way and
    resumed, then brought up to date: once for each number of ranges."""
    orders, log = table(spark, sf_dir, "orders"), order_changes(spark, sf_dir)
    last = log.agg(F.max("seq")).first()[0]
    out = None
    for parts in SNAPSHOT_PARTS:
        folder = new_folder(spark, "snapshot")
        ranges = key_ranges(orders, "o_orderkey", parts)
        now = [0]

        def position() -> int:
            now[0] += last // (3 * parts + 3)
            return now[0]

        # The log moves on before, during and after each read.
        read = lambda part: _orders_at(orders, log, position(), part)
        while snapshot_in_ranges(spark, ranges, read, position, folder, at_most=parts // 2):
            pass
        rows = snapshot_rows(spark, folder, "o_orderkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE")
        whole = reconciled(
            rows.withColumn("gone", F.lit(False)), snapshot_marks(spark, folder), log, ranges, ["o_orderkey"]
        )
        final = latest_per_key(whole, ["o_orderkey"], ["seq"]).where(~F.col("gone"))
        final = final.select(F.lit(parts).alias("parts"), *ORDER_COLUMNS)
        out = final if out is None else out.unionByName(final)
    return out


def snapshot_splits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``customer`` read in ranges of a text key, each by its SQL predicate."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    out = None
    for part in key_ranges(customers, "c_name", 6):
        rows = customers.where(part.predicate("c_name"))
        out = rows if out is None else out.unionByName(rows)
    return out


FACT_SCHEMA = "id STRING, name STRING, seq BIGINT"
DIM_SCHEMA = "id STRING, name STRING, modify_time STRING, seq BIGINT"


def stream_state_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases joined to a dimension in typed state: the first slice of the
    dimension is a snapshot, the rest comes as a stream that is restarted twice."""
    folder = new_folder(spark, "state")
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    facts = _in_slices(_facts(spark, sf_dir), last, 4)[1:]
    snapshot, *dims = _in_slices(_dims(spark, sf_dir), last, 4)
    snapshot = latest_per_key(snapshot, ["id"], ["seq"]).select("id", "name", "modify_time", "seq")
    snapshot.write.parquet(f"{folder}/snapshot")
    for fact_part, dim_part in zip(facts, dims):
        fact_part.write.mode("append").parquet(f"{folder}/facts")
        dim_part.select("id", "name", "modify_time", "seq").write.mode("append").parquet(f"{folder}/dims")
        sides = [
            spark.readStream.schema(schema).parquet(f"{folder}/{name}")
            for name, schema in (("facts", FACT_SCHEMA), ("dims", DIM_SCHEMA))
        ]
        initial = spark.read.schema(DIM_SCHEMA).parquet(f"{folder}/snapshot")
        joined = temporal_join_state(*sides, "id", "seq", initial=initial, spread=2, held_facts=100)
        writer = (
            joined.writeStream.format("parquet")
            .option("path", f"{folder}/joined")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
        )
        with rocksdb_state(spark):
            query = writer.start()
        query.awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/joined")


def late_changes_after_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes and deletes in three batches that arrive in no order: the last
    event of a key counts, and a late change does not undo a delete."""
    folder = new_folder(spark, "order")
    time = F.date_format("ts", TIME_PATTERN)
    events = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        time.alias("modify_time"),
        F.substring(time, 1, 10).alias("logday"),
        (F.col("event_type") == "error").alias("deleted"),
        "event_id",
    )
    spec = TableSpec(
        f"by_event_{uuid.uuid4().hex[:12]}", f"{folder}/table", ("id", "name", "modify_time"), "modify_time",
        partition_by=("logday",), buckets=4,
    )
    ensure_table(spark, spec)
    for turn in (2, 0, 1):
        upsert_in_event_order(spec, events.where(F.col("event_id") * 7 % 11 % 3 == turn))
    rows = spark.table(spec.name).select("id", "name", "modify_time")
    gone = buried(spark, spec).join(rows.select("id"), "id", "left_anti")
    return rows.unionByName(gone.withColumn("name", F.lit(None).cast("string")))


def versions_kept_up(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension's versions stored batch by batch, late rows included."""
    folder = new_folder(spark, "versions")
    dims = _dims(spark, sf_dir).select("id", "name", "modify_time")
    # Decoded once, not once for each batch.
    dims.write.parquet(f"{folder}/dims")
    dims = spark.read.schema(dims.schema).parquet(f"{folder}/dims")
    spec = VersionSpec(
        f"versions_{uuid.uuid4().hex[:12]}", f"{folder}/table", ("id", "name", "modify_time"), ("id",),
        "modify_time", parts=4, period_length=9,
    )
    turn = F.pmod(F.xxhash64("modify_time"), F.lit(3))
    for n in (1, 2, 0):
        update_versions(spark, spec, dims.where(turn == n))
    return stored_versions(spark, spec)


def log_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log in three partitions with holes in it and some messages twice."""
    events = table(spark, sf_dir, "events")
    event = F.col("event_id")
    kept = events.where((event * 7919 % 101 >= 9) & ~((event % 1000).between(400, 520)))
    log = kept.unionByName(kept.where(event % 97 == 5)).select(
        (event % 3).alias("partition"), F.floor(event / 3).alias("offset")
    )
    return offset_faults(log, ["partition"], "offset", block=50)


def diff_orders_by_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences of two stored versions of ``orders``; few key ranges changed."""
    old = table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    near = F.pmod(key, F.lit(1024)) < 32
    later = old.where(~(near & (key % 5 == 0))).withColumn(
        "o_totalprice", F.when(near & (key % 7 == 0), price + 1).otherwise(price)
    )
    later = later.unionByName(old.where(key % 1024 < 4).withColumn("o_orderkey", -key - 1))
    folder = new_folder(spark, "later")
    later.write.parquet(folder)
    new = spark.read.schema(old.schema).parquet(folder)
    return diff_in_ranges(old, new, ["o_orderkey"], bits=(10, 4)).select(
        "o_orderkey",
        "op",
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
    )


def lineitem_count_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows without a key that a later version holds more or fewer times."""
    items = table(spark, sf_dir, "lineitem")
    rows = lambda df: df.select("l_orderkey", "l_returnflag", "l_quantity")
    later = rows(items.where(F.col("l_partkey") % 13 != 0)).unionAll(rows(items.where(F.col("l_suppkey") % 17 == 0)))
    return row_count_changes(rows(items), later)


SHARDS = range(5)
REQUEST_RECORDS, REQUEST_BYTES = 50, 600


def _skewed_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages of their user; a third of them have one key."""
    event = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        F.when(event % 3 == 0, F.lit(0)).otherwise(F.col("user_id")).alias("key"),
        "event_id",
        F.octet_length("props").cast("long").alias("size"),
    )


def keys_on_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages, bytes and shards of each key: one shard, however skewed."""
    messages = _skewed_messages(spark, sf_dir)
    places = shard_places(messages, F.col("key"), F.col("size"), SHARDS)
    return (
        with_shard(messages, F.col("key"), places)
        .groupBy("key")
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.sum("size").alias("bytes"),
            F.count_distinct("shard").alias("shards"),
        )
    )


def request_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages and bytes of all requests, and how many requests or shards
    break their bounds."""
    messages = _skewed_messages(spark, sf_dir)
    key, size = F.col("key"), F.col("size")
    places = shard_places(messages, key, size, SHARDS)
    requests = (
        request_batches(
            with_shard(messages, key, places), key, size, ["event_id"],
            max_records=REQUEST_RECORDS, max_bytes=REQUEST_BYTES,
        )
        .groupBy("shard", "lane", "batch")
        .agg(F.count(F.lit(1)).alias("records"), F.sum("size").alias("bytes"))
        .groupBy("shard")
        .agg(
            F.sum("records").alias("messages"),
            F.sum("bytes").alias("bytes"),
            F.count_if((F.col("records") > REQUEST_RECORDS) | (F.col("bytes") > REQUEST_BYTES)).alias("over_limit"),
        )
    )
    mean, heaviest = places.agg(F.sum("bytes") / len(SHARDS), F.max("bytes")).first()
    bound = max(1.1 * mean, mean + heaviest)
    return requests.agg(
        F.sum("messages").alias("messages"),
        F.sum("bytes").alias("bytes"),
        F.sum("over_limit").alias("requests_over_limit"),
        F.count_if(F.col("bytes") > bound).alias("shards_over_bound"),
    )


MESSAGE_SCHEMA = "seq BIGINT, partition BIGINT, offset BIGINT, name STRING, time TIMESTAMP"


def stream_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A log with repeats in and across batches, read by a stream that restarts
    and once fails after it wrote a batch: every message takes effect once."""
    folder = new_folder(spark, "once")
    event = F.col("event_id")
    messages = table(spark, sf_dir, "events").select(
        event.alias("seq"),
        (event % 3).alias("partition"),
        F.floor(event / 3).alias("offset"),
        F.col("event_type").alias("name"),
        F.timestamp_seconds(event + 86400).alias("time"),  # a stream drops times at or before its first watermark, 0
    )
    last = messages.agg(F.max("seq")).first()[0]
    failed = []
    store = batch_folder(f"{folder}/out")

    def write(batch: DataFrame, number: int) -> None:
        store(batch, number)
        if number == 1 and not failed:
            failed.append(number)
            raise RuntimeError("lost after the write")

    before = messages.limit(0)
    for part in _in_slices(messages, last, 3):
        repeats = part.unionByName(before).where(F.col("seq") % 97 == 5)
        part.unionByName(repeats).write.mode("append").parquet(f"{folder}/log")
        before = part
        for _ in range(2):  # started again after a failure
            log = spark.readStream.schema(MESSAGE_SCHEMA).parquet(f"{folder}/log")
            query = (
                first_of_each(log, ["partition", "offset"], "time", f"{last // 3 + 2} seconds")
                .writeStream.foreachBatch(once_per_batch(folder, "out", write))
                .option("checkpointLocation", f"{folder}/checkpoint")
                .trigger(availableNow=True)
                .start()
            )
            try:
                query.awaitTermination()
                break
            except StreamingQueryException:
                if failed != [1]:
                    raise
                failed.append("restarted")
    rows = written_once(spark, folder, "out", f"{folder}/out", MESSAGE_SCHEMA)
    return rows.select("seq", "partition", "offset", "name")


def fields_over_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields of a log whose rows gain one field, lose one and change a type."""
    events = table(spark, sf_dir, "events")
    half = events.agg(F.floor(F.max("event_id") / 2)).first()[0]
    event, late = F.col("event_id"), F.col("event_id") > half
    row = F.to_json(
        F.struct(
            event.alias("id"),
            F.when(~late, event % 2 == 0).alias("old"),
            F.when(late, F.col("event_type")).alias("note"),
        )
    )
    # The value of v is a number, later a word.
    value = F.when(late, F.concat(F.lit('"v'), event % 5, F.lit('"'))).otherwise((event % 5).cast("string"))
    text = F.concat(F.substr(row, F.lit(1), F.length(row) - 1), F.lit(',"v":'), value, F.lit("}"))
    text = F.when(event % 50 == 7, F.lit("{broken")).otherwise(text)
    log = events.select((F.col("user_id") % 3).alias("tb"), event.alias("seq"), text.alias("text"))
    return field_drift(log, ["tb"], "text", "seq")


def moved_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that move between partitions, upserted in three batches out of order
    with the help of a table of places."""
    folder = new_folder(spark, "places")
    rows = table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("id"),
        F.col("event_type").alias("name"),
        F.lpad(F.col("event_id").cast("string"), 18, "0").alias("place_in_log"),
        (F.col("event_id") % 7).cast("string").alias("part"),
        "event_id",
    )
    spec = TableSpec(
        f"moved_{uuid.uuid4().hex[:12]}", f"{folder}/table", ("id", "name", "place_in_log"), "place_in_log",
        partition_by=("part",), rule="greatest",
    )
    ensure_table(spark, spec)
    for turn in (2, 0, 1):
        upsert_by_place(spec, rows.where(F.col("event_id") * 7 % 11 % 3 == turn).drop("event_id"), buckets=4)
    return spark.table(spec.name)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        snapshot_with_running_log,
        snapshot_splits,
        stream_state_join,
        late_changes_after_deletes,
        versions_kept_up,
        log_completeness,
        diff_orders_by_range,
        lineitem_count_changes,
        keys_on_shards,
        request_limits,
        stream_once,
        fields_over_time,
        moved_keys,
    )
}
