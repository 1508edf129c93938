"""A change log derived from an event table, for examples and checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.envelope import OP_CREATE, OP_DELETE, envelope_text

TIME_PATTERN = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def changes_from_events(events: DataFrame) -> DataFrame:
    """One change per event row as (``seq``, ``value``).

    Users are spread over four tables in two databases; some events go to a
    database or table nobody asked for, ``error`` events are deletes, and some
    texts are not JSON at all, so every routing outcome occurs.
    """
    user = F.col("user_id")
    foreign = F.col("event_id") % 10 == 9
    unknown = F.col("event_id") % 10 == 8
    slot = user % 4
    time = F.date_format("ts", TIME_PATTERN)
    image = F.struct(
        user.cast("string").alias("id"),
        F.concat_ws("_", "event_type", F.col("event_id").cast("string")).alias("name"),
        time.alias("create_time"),
        time.alias("modify_time"),
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("address"),
    )
    is_delete = F.col("event_type") == "error"
    text = envelope_text(
        before=F.when(is_delete, image),
        after=F.when(~is_delete, image),
        db=F.when(foreign, "other_db").when(slot == 3, "cdc_dev_db").otherwise("cdc_test_db"),
        table=F.when(foreign, "x")
        .when(unknown, "unknown_tb")
        .when(slot == 0, "test_tb_01")
        .when(slot == 1, "test_tb_02")
        .when(slot == 2, "test_tb_no_time")
        .otherwise("dev_tb_01"),
        op=F.when(is_delete, OP_DELETE).otherwise(OP_CREATE),
        ts_ms=F.unix_millis(F.col("ts").cast("timestamp")),
    )
    return events.select(
        F.col("event_id").alias("seq"),
        F.when(F.col("event_id") % 50 == 7, "not json").otherwise(text).alias("value"),
    )
