"""Registered queries over the given tables, one per operator or job.

Each takes ``(spark, sf_dir)``. The change log is derived from ``events`` (see
``changes_from_events``); the SQL beside them in ``checks`` works on the base
tables only, so that encoding and decoding are checked independently.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..functions.envelope import generic_rows, parse_envelope, parse_pairs, parse_rows, project_after
from ..operators.capture import (
    apply_changes,
    diff_changes,
    encode_changes,
    include_tables,
    snapshot_changes,
    start_changes,
)
from ..operators.routing import (
    REJECT,
    UNROUTED,
    Route,
    dim_rows,
    reject_null_keys,
    route_changes,
    routed_rows,
)
from ..operators.temporal import as_of, temporal_join, versioned
from ..operators.upsert import latest_per_key, merge_upsert, stamp_partition
from ..sinks.messages import to_kafka_columns, with_parallelism, with_partition_key
from ..sinks.tables import TableSpec
from ..sources import changes_from_events, read_changes, read_lines
from ..storage import new_folder
from ..streaming.options import JobOptions
from .jobs import (
    capture_to_shards,
    lines_with_dimension,
    run_capture,
    run_join,
    run_tables,
    topic_to_tables,
    topic_with_dimension,
)

# The example tables and their columns.
UNION_COLUMNS = ("id", "name", "create_time", "modify_time")
NO_TIME_COLUMNS = ("id", "name")
DEV_COLUMNS = ("id", "name", "address", "create_time", "modify_time")
UNION = Route("cdc_test_db", ("test_tb_01", "test_tb_02"), "test_tb_union", UNION_COLUMNS)
NO_TIME = Route("cdc_test_db", ("test_tb_no_time",), "test_tb_no_time", NO_TIME_COLUMNS)
DEV = Route("cdc_dev_db", ("dev_tb_01",), "dev_tb_01", DEV_COLUMNS)
ROUTES = (UNION, NO_TIME, DEV)
PRECOMBINE = {"test_tb_union": "modify_time", "test_tb_no_time": "name", "dev_tb_01": "modify_time"}

STREAM_SLICES = 3
HOT_GROUP_ROWS = 4
ORDER_KEY_SHIFT = 10_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def change_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return changes_from_events(table(spark, sf_dir, "events"))


def union_rows(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] = ("seq",)) -> DataFrame:
    return routed_rows(route_changes(change_log(spark, sf_dir), ROUTES), UNION, keep=keep)


# Encode and decode ---------------------------------------------------------


def customer_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot of a table as envelopes, decoded again by name."""
    changes = snapshot_changes(table(spark, sf_dir, "customer"), "shop", "customer")
    fields = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]
    return project_after(parse_envelope(changes, fields), fields, keep=["db", "table", "op"])


def customer_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The message key and the exact text of snapshot events."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    changes = snapshot_changes(
        customers, "shop", "customer", ts_ms=F.lit(0).cast("bigint"), keep=["c_custkey"]
    )
    messages = to_kafka_columns(changes, F.concat_ws(".", F.lit("shop.customer"), "c_custkey"))
    return messages.select(
        F.decode("key", "UTF-8").alias("key"), F.decode("value", "UTF-8").alias("value")
    )


def decimal_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals travel as exact text."""
    items = table(spark, sf_dir, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").cast("decimal(14,2)").alias("price"),
        F.col("l_discount").cast("decimal(6,4)").alias("discount"),
    )
    fields = ["l_orderkey", "l_linenumber", "price", "discount"]
    return project_after(parse_envelope(snapshot_changes(items, "shop", "items"), fields), fields)


def decimal_bytes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Decimals travel as base64 of the unscaled integer."""
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.col("c_acctbal").cast("decimal(12,2)").alias("balance"),
        F.col("c_acctbal").cast("decimal(30,2)").alias("wide_balance"),
    )
    fields = ["c_custkey", "balance", "wide_balance"]
    changes = snapshot_changes(customers, "shop", "customer", decimal_mode="precise")
    return project_after(parse_envelope(changes, fields), fields)


def generic_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Any change as db, table and a map of its fields: one row per field."""
    rows = generic_rows(change_log(spark, sf_dir), keep=["seq"])
    return rows.select("seq", "db", "table", F.explode("fields").alias("field", "content"))


def flat_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat JSON facts without an envelope."""
    return parse_rows(_fact_texts(spark, sf_dir), ["id", "name"], keep=["seq"])


def line_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Comma-separated lines: two fields, extras ignored, short lines rejected."""
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.col("user_id"), F.lit(",")))
        .when(F.col("event_type") == "view", F.col("user_id").cast("string"))
        .when(F.col("event_type") == "click", F.concat_ws(",", "user_id", "event_type", "event_id"))
        .otherwise(F.concat_ws(",", "user_id", "event_type"))
    )
    lines = table(spark, sf_dir, "events").select(F.col("event_id").alias("seq"), text.alias("value"))
    return parse_pairs(lines, keep=["seq"])


# Select and route ----------------------------------------------------------


def include_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of the listed databases and table patterns."""
    parsed = parse_envelope(change_log(spark, sf_dir), ["id"])
    kept = include_tables(parsed, "cdc_test_db,other_db", "cdc_test_db.test_tb_0[12],OTHER_DB.x")
    return kept.select("seq", "db", "table", "op")


def start_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the changes after a sequence number."""
    log = change_log(spark, sf_dir)
    middle = log.agg(F.floor(F.max("seq") / 2)).first()[0]
    return generic_rows(start_changes(None, log, "latest", at=middle), keep=["seq"]).select(
        "seq", "db", "table"
    )


def start_initial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A snapshot of the current rows, then the log: events per table and op."""
    events = table(spark, sf_dir, "events")
    users = latest_per_key(events.select("user_id", "event_id", "event_type"), ["user_id"], ["event_id"])
    snapshot = snapshot_changes(
        users.withColumn("seq", F.lit(-1).cast("bigint")), "cdc_test_db", "users", keep=["seq"]
    )
    parsed = parse_envelope(start_changes(snapshot, change_log(spark, sf_dir), "initial"), ["id"])
    return parsed.groupBy("db", "table", "op").agg(F.count("*").alias("changes"))


def routing_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every change counted by destination and reject reason."""
    routed = route_changes(change_log(spark, sf_dir), ROUTES)
    return routed.groupBy("dest", "reject_reason").agg(F.count("*").alias("changes"))


def rejected_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unrouted and rejected changes as received, with every reject reason: some
    texts lose their table name, hold a nested name or a null id."""
    text, turn = F.col("value"), F.col("seq") % 60
    value = (
        F.when(turn == 11, F.regexp_replace(text, '"table":"[^"]*"', '"tables":""'))
        .when(turn == 12, F.regexp_replace(text, '"name":"[^"]*"', '"name":{"x":1}'))
        .when(turn == 13, F.regexp_replace(text, '"id":"[^"]*"', '"id":null'))
        .otherwise(text)
    )
    routed = route_changes(change_log(spark, sf_dir).select("seq", value.alias("value")), ROUTES)
    routed = reject_null_keys(routed, ROUTES, {r.dest: ["id"] for r in ROUTES})
    return routed.where(F.col("dest").isin(UNROUTED, REJECT)).select("seq", "dest", "reject_reason", "value")


def shard_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two shard tables as one, typed by name."""
    return union_rows(spark, sf_dir)


def shard_origin(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per shard and id when the shards' ids do not overlap."""
    route = Route(UNION.db, UNION.tables, UNION.dest, UNION.columns, shard_column="shard")
    rows = routed_rows(route_changes(change_log(spark, sf_dir), [route]), route, keep=["seq"])
    return latest_per_key(rows, ["shard", "id"], ["modify_time", "seq"])


def dimension_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of one table, every other table's change as a sentinel row."""
    return dim_rows(
        change_log(spark, sf_dir), "cdc_test_db", "test_tb_01", UNION_COLUMNS,
        keep=["seq"], unmatched="sentinel",
    )


def shard_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messages per shard key: keyed by table and id, and by one constant."""
    parsed = parse_envelope(change_log(spark, sf_dir), ["id"])
    rows = parsed.select("db", "table", F.col("after.id").alias("id"))
    keyed = with_partition_key(rows, ["db", "table", "id"])
    constant = capture_to_shards(change_log(spark, sf_dir), constant="0")
    counts = [
        df.groupBy("partition_key").agg(F.count("*").alias("messages")) for df in (keyed, constant)
    ]
    return counts[0].unionByName(counts[1])


def message_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each change's place among those of its key, as the writers send them."""
    log = change_log(spark, sf_dir)
    rows = parse_envelope(log, ["id"]).select("db", "table", F.col("after.id").alias("id"), "seq")
    keyed = with_partition_key(rows, ["db", "table", "id"])
    sent = with_parallelism(keyed, 16, F.col("partition_key"), "seq", log.count())
    sent = sent.withColumn("_sent", F.monotonically_increasing_id())
    place = F.row_number().over(Window.partitionBy("partition_key").orderBy("_sent"))
    return sent.select("partition_key", "seq", place.alias("place"))


# Latest row and upsert -----------------------------------------------------


def latest_union(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row per id of the shard union."""
    return latest_per_key(union_rows(spark, sf_dir), ["id"], ["modify_time", "seq"])


def latest_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table whose precombine column is the name: the greatest text wins."""
    routed = route_changes(change_log(spark, sf_dir), ROUTES)
    return latest_per_key(routed_rows(routed, NO_TIME, keep=["seq"]), ["id"], ["name", "seq"])


def latest_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Natural duplicates of a two-column key, ties decided by every column."""
    items = table(spark, sf_dir, "lineitem")
    keys = ["l_orderkey", "l_linenumber"]
    rest = [c for c in items.columns if c not in [*keys, "l_shipdate"]]
    return latest_per_key(items, keys, ["l_shipdate", *rest])


def _two_batches(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """The union rows as two batches that arrive out of order."""
    rows = union_rows(spark, sf_dir)
    even = F.col("seq") % 2 == 0
    first = latest_per_key(rows.where(~even), ["id"], ["modify_time", "seq"])
    return first, rows.where(even)


def upsert_incoming(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Second batch merged over the first: the incoming row wins."""
    first, second = _two_batches(spark, sf_dir)
    return merge_upsert(first, second, ["id"], "modify_time", order=["seq"])


def upsert_greatest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same batches, but late rows cannot take the table back."""
    first, second = _two_batches(spark, sf_dir)
    return merge_upsert(first, second, ["id"], "modify_time", rule="greatest", order=["seq"])


def upsert_in_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys that are unique within a day and 12-hour-clock hour."""
    events = stamp_partition(table(spark, sf_dir, "events"), F.col("ts"))
    late = F.col("event_type").isin("click", "purchase")
    keys = ["user_id", "logday", "hh"]
    first = latest_per_key(events.where(~late), keys, ["ts", "event_id"])
    return merge_upsert(first, events.where(late), keys, "ts", order=["event_id"])


def upsert_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored clicks and purchases, then views and errors: an error that is the
    user's newest event removes the user, an older one does not."""
    events = table(spark, sf_dir, "events")
    stored = F.col("event_type").isin("click", "purchase")
    first = latest_per_key(events.where(stored), ["user_id"], ["ts", "event_id"])
    second = events.where(~stored).withColumn("gone", F.col("event_type") == "error")
    return merge_upsert(
        first, second, ["user_id"], "ts", rule="greatest", order=["event_id"], deleted="gone"
    )


# Differences between table versions ----------------------------------------


def _orders_versions(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """``orders`` and a later version with rows removed, repriced and rekeyed."""
    old = table(spark, sf_dir, "orders")
    key, price = F.col("o_orderkey"), F.col("o_totalprice")
    new = old.where(key % 50 != 0).withColumns(
        {
            "o_totalprice": F.when(key % 7 == 0, price + 1).otherwise(price),
            "o_orderkey": F.when(key % 11 == 0, key + ORDER_KEY_SHIFT).otherwise(key),
        }
    )
    return old, new


def diff_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Creates, updates and deletes between two versions of a table."""
    old, new = _orders_versions(spark, sf_dir)
    return diff_changes(old, new, ["o_orderkey"]).select(
        "o_orderkey",
        "op",
        F.col("before.o_totalprice").alias("old_price"),
        F.col("after.o_totalprice").alias("new_price"),
    )


def diff_applied(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The old version with the differences applied is the new version."""
    old, new = _orders_versions(spark, sf_dir)
    return apply_changes(old, diff_changes(old, new, ["o_orderkey"]), ["o_orderkey"])


def captured_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Differences encoded as events and decoded again, deletes by before-image."""
    old, new = _orders_versions(spark, sf_dir)
    changes = encode_changes(diff_changes(old, new, ["o_orderkey"]), "shop", "orders")
    fields = ["o_orderkey", "o_orderstatus", "o_orderpriority"]
    return project_after(parse_envelope(changes, fields, before=True), fields, keep=["op"])


# Temporal ------------------------------------------------------------------


def _facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "events")
        .where(F.col("event_type") == "purchase")
        .select(
            F.col("user_id").cast("string").alias("id"),
            F.concat_ws("_", "event_type", F.col("event_id").cast("string")).alias("name"),
            F.col("event_id").alias("seq"),
        )
    )


def _fact_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _facts(spark, sf_dir).select("seq", F.to_json(F.struct("id", "name")).alias("value"))


def _dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = union_rows(spark, sf_dir)
    return rows.where(~F.col("name").startswith("purchase")).select("id", "name", "modify_time", "seq")


def purchase_temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each purchase with the newest dimension row at or before it."""
    return temporal_join(_facts(spark, sf_dir), _dims(spark, sf_dir), "id", "seq")


def purchase_temporal_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, keeping purchases without a dimension row."""
    return temporal_join(_facts(spark, sf_dir), _dims(spark, sf_dir), "id", "seq", how="left")


def error_temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each other event with the user's last error before it, by time."""
    events = table(spark, sf_dir, "events")
    is_error = F.col("event_type") == "error"
    facts = events.where(~is_error).select("user_id", "ts", "event_id")
    errors = events.where(is_error).select("user_id", "ts", F.col("event_id").alias("error_id"))
    return temporal_join(facts, errors, "user_id", "ts").select(
        "user_id", "ts", "event_id", "error_id"
    )


def hot_temporal_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The left join with a group limit that most keys exceed."""
    facts, dims = _facts(spark, sf_dir), _dims(spark, sf_dir)
    return temporal_join(facts, dims, "id", "seq", how="left", max_group_rows=HOT_GROUP_ROWS)


def hot_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Versions with a group limit that most keys exceed."""
    return versioned(_dims(spark, sf_dir), "id", "seq", max_group_rows=HOT_GROUP_ROWS)


def dimension_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every dimension row with the interval it is valid in."""
    return versioned(_dims(spark, sf_dir), "id", "seq")


def dimension_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The dimension as it was half-way through the log."""
    dims = _dims(spark, sf_dir)
    middle = table(spark, sf_dir, "events").agg(F.floor(F.max("event_id") / 2)).first()[0]
    return as_of(versioned(dims, "id", "seq"), middle)


# Streaming -----------------------------------------------------------------


def _in_slices(df: DataFrame, last_seq: int, slices: int = STREAM_SLICES) -> list[DataFrame]:
    """A log cut by sequence number into consecutive parts; together all of it."""
    part = F.floor(F.col("seq") * slices / (last_seq + 1))
    return [df.where(part == i) for i in range(slices)]


def _stream_tables(spark: SparkSession, sf_dir: str, deletes: str) -> DataFrame:
    run = uuid.uuid4().hex[:12]
    folder = new_folder(spark, "tables")
    log = change_log(spark, sf_dir)
    last = table(spark, sf_dir, "events").agg(F.max("event_id")).first()[0]
    specs = {
        r.dest: TableSpec(
            f"{r.dest}_{run}", f"{folder}/{r.dest}", r.columns, PRECOMBINE[r.dest]
        )
        for r in ROUTES
    }
    # Partitions by week of change, so that ids move on and old weeks empty.
    stamp = F.date_trunc("week", F.to_timestamp("after.modify_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    # One run per part: each continues from the checkpoint of the one before.
    for part in _in_slices(log, last):
        part.write.mode("append").parquet(f"{folder}/log")
        stream = read_changes(
            spark, f"{folder}/log", format="parquet", schema="seq BIGINT, value STRING", streaming=True
        )
        topic_to_tables(
            stream, ROUTES, specs, f"{folder}/checkpoint", order=["seq"], deletes=deletes,
            stamp=stamp, trigger={"availableNow": True},
        ).awaitTermination()
    out = None
    for r in ROUTES:
        rows = spark.table(specs[r.dest].name).withColumn("dest", F.lit(r.dest))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def stream_to_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One change stream into three partitioned tables, read back."""
    return _stream_tables(spark, sf_dir, "ignore")


def stream_to_tables_deletes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with deletes applied."""
    return _stream_tables(spark, sf_dir, "apply")


def _run_join(spark: SparkSession, folder: str, facts: list, dims: list, build: Callable) -> DataFrame:
    """Feed both sides part by part to a restarted stream, then read its output."""
    schema = "seq BIGINT, value STRING"
    for fact_part, dim_part in zip(facts, dims):
        fact_part.select("seq", "value").write.mode("append").parquet(f"{folder}/facts")
        dim_part.select("seq", "value").write.mode("append").parquet(f"{folder}/dims")
        sides = [
            read_changes(spark, f"{folder}/{n}", format="parquet", schema=schema, streaming=True)
            for n in ("facts", "dims")
        ]
        joined = build(*sides)
        (
            joined.writeStream.format("parquet")
            .option("path", f"{folder}/joined")
            .option("checkpointLocation", f"{folder}/checkpoint")
            .trigger(availableNow=True)
            .start()
            .awaitTermination()
        )
    return spark.read.schema(joined.schema).parquet(f"{folder}/joined")


def stream_temporal_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stream of facts with a captured dimension kept as keyed state."""
    log = change_log(spark, sf_dir)
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    # Purchases are the facts, so their changes are no dimension rows.
    name = F.coalesce(F.get_json_object("value", "$.after.name"), F.lit(""))
    dims = log.where(~name.startswith("purchase"))

    def build(facts: DataFrame, changes: DataFrame) -> DataFrame:
        return topic_with_dimension(
            facts, changes, db=UNION.db, table=UNION.tables[0], seq="seq", spread=4
        )

    return _run_join(
        spark,
        new_folder(spark, "join"),
        _in_slices(_fact_texts(spark, sf_dir), last),
        _in_slices(dims, last),
        build,
    )


def stream_lines_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams of comma-separated lines, joined the same way."""
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    lines = events.select(
        F.col("event_id").alias("seq"),
        "event_type",
        F.concat_ws(",", "user_id", "event_type", "event_id").alias("value"),
    )
    is_fact = F.col("event_type") == "purchase"
    return _run_join(
        spark,
        new_folder(spark, "lines"),
        _in_slices(lines.where(is_fact), last),
        _in_slices(lines.where(~is_fact), last),
        lambda facts, dims: lines_with_dimension(facts, dims, "seq"),
    )


def stream_text_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of text files joined by three hot keys; the order is that of two
    fields of the line, the first of which repeats."""
    folder = new_folder(spark, "text")
    events = table(spark, sf_dir, "events")
    last = events.agg(F.max("event_id")).first()[0]
    seq = F.col("event_id")
    line = F.concat_ws(",", F.col("user_id") % 3, "event_type", F.floor(seq / 4), seq)
    lines = events.select(seq.alias("seq"), (F.col("event_type") == "purchase").alias("fact"), line.alias("value"))
    options = JobOptions.for_job("lines_with_dimension", checkpoint_dir=f"{folder}/checkpoint", once=True)
    for part in _in_slices(lines, last):
        sides = []
        for name, chosen in (("facts", F.col("fact")), ("dims", ~F.col("fact"))):
            part.where(chosen).select("value").write.mode("append").text(f"{folder}/{name}")
            fields = F.split("value", ",")
            rows = read_lines(spark, f"{folder}/{name}", streaming=True)
            sides.append(rows.withColumns({n: fields[i].cast("bigint") for n, i in (("moment", 2), ("seq", 3))}))
        joined = lines_with_dimension(*sides, ["moment", "seq"], spread=4)
        sink = lambda writer: writer.format("parquet").option("path", f"{folder}/joined")
        run_join(options, joined, sink).awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/joined")


def captured_to_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Capture, a log of message files, then tables, driven by options alone."""
    folder = new_folder(spark, "captured")
    options = JobOptions(
        checkpoint_dir=f"{folder}/checkpoint", db_list="cdc_test_db", table_list=r"cdc_test_db\.test_tb_0[12]",
        position="initial", parallel=4, name="captured-to-tables", once=True,
    )
    key = F.regexp_extract("value", '"id":"([^"]*)"', 1)
    run_capture(options, change_log(spark, sf_dir), key=key).write.parquet(f"{folder}/log")
    stream = read_changes(
        spark, f"{folder}/log", format="parquet", schema="key BINARY, value BINARY", streaming=True
    ).select(F.col("value").cast("string").alias("value"))
    # The number in the name stands in for a message's offset.
    stream = stream.withColumn("offset", F.regexp_extract("value", r'_(\d+)"', 1).cast("bigint"))
    spec = TableSpec(
        f"{UNION.dest}_{uuid.uuid4().hex[:12]}", f"{folder}/table", UNION.columns, PRECOMBINE[UNION.dest]
    )
    run_tables(options, stream, [UNION], {UNION.dest: spec}, order=["offset"]).awaitTermination()
    return spark.table(spec.name).select(*UNION.columns)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        customer_round_trip,
        customer_messages,
        decimal_text,
        decimal_bytes,
        generic_fields,
        flat_facts,
        line_pairs,
        include_list,
        start_latest,
        start_initial,
        routing_outcomes,
        rejected_texts,
        shard_union,
        shard_origin,
        dimension_rows,
        shard_keys,
        message_order,
        latest_union,
        latest_by_name,
        latest_lineitem,
        upsert_incoming,
        upsert_greatest,
        upsert_in_partitions,
        upsert_deletes,
        diff_orders,
        diff_applied,
        captured_orders,
        purchase_temporal_join,
        purchase_temporal_left,
        error_temporal_join,
        dimension_versions,
        dimension_as_of,
        hot_temporal_left,
        hot_versions,
        stream_to_tables,
        stream_to_tables_deletes,
        stream_temporal_join,
        stream_lines_join,
        stream_text_lines,
        captured_to_tables,
    )
}
