"""Shape and write change events as messages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import DataStreamWriter

#: Rows of a task beyond which a writer's work is cut into several tasks.
ROWS_PER_TASK = 1 << 18


def to_kafka_columns(df: DataFrame, key: Column | None = None, value: str = "value") -> DataFrame:
    """Message columns: the UTF-8 bytes of the text, and a key if given.

    Without a key the changes of one row may land in different topic
    partitions and lose their order; key by table and record key to keep it.
    """
    body = F.encode(F.col(value), "UTF-8").alias("value")
    if key is None:
        return df.select(body)
    return df.select(F.encode(key.cast("string"), "UTF-8").alias("key"), body)


def kafka_sink_options(brokers: str, topic: str) -> dict[str, str]:
    """Options of Spark's Kafka sink. Delivery is at least once; the upsert
    side is idempotent, so a repeated message changes nothing there."""
    return {
        "kafka.bootstrap.servers": brokers,
        "topic": topic,
        "kafka.acks": "all",
        "kafka.enable.idempotence": "true",
    }


def with_partition_key(
    df: DataFrame,
    columns: Sequence[str] = (),
    constant: str | None = None,
    name: str = "partition_key",
    partitions: int | None = None,
) -> DataFrame:
    """Add the key that decides a message's shard, and optionally regroup.

    By ``columns`` the key is their text, which keeps the order per key and
    spreads the load. A ``constant`` puts everything on one shard; only with
    ``partitions`` do all its rows also go through one writer, so give that
    for small streams alone.
    """
    if (constant is None) == (not columns):
        raise ValueError("give either key columns or a constant")
    if constant is not None:
        key = F.lit(constant)
    else:
        key = F.concat_ws(".", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    keyed = df.withColumn(name, key)
    return keyed.repartition(partitions, name) if partitions else keyed


def with_parallelism(
    df: DataFrame, parallel: int, key: Column | None = None, seq: str | None = None, rows: int = 0
) -> DataFrame:
    """Spread rows over ``parallel`` writers: evenly, or by ``key``.

    ``rows`` is about how many there are, if known. A writer of more than
    ``ROWS_PER_TASK`` works in several tasks of about that many; task ``t``
    belongs to writer ``t % parallel``. Rows of one key share a task, so a hot
    key is not divided. ``seq`` sorts each task's rows, so that the changes of a
    key leave in that order; a stream cannot be sorted, so there the order
    within a batch is that of the source partitions.
    """
    if parallel < 1:
        raise ValueError("parallel must be at least 1")
    if seq is not None and key is None:
        raise ValueError("an order needs a key")
    tasks = parallel * max(1, -(-rows // (parallel * ROWS_PER_TASK)))
    if key is None:
        return df.repartition(tasks)
    spread = df.repartition(tasks, key)
    return spread if seq is None or df.isStreaming else spread.sortWithinPartitions(seq)


def console(df: DataFrame, name: str = "console") -> DataStreamWriter:
    """Print a stream's new rows as they arrive."""
    return df.writeStream.format("console").queryName(name).outputMode("append")
