"""Read change logs, lines and tables with Spark's own sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def kafka_source_options(
    brokers: str,
    topic: str,
    group_id: str = "",
    position: str = "latest",
    max_offsets_per_trigger: int | None = None,
) -> dict[str, str]:
    """Options of Spark's Kafka source for one topic.

    ``position`` applies to a new query only: a restarted one continues from
    its checkpoint. ``initial`` starts at the earliest record kept, ``latest``
    after the newest.
    """
    starts = {"initial": "earliest", "latest": "latest"}
    if position not in starts:
        raise ValueError(f"position must be 'initial' or 'latest', not {position!r}")
    options = {
        "kafka.bootstrap.servers": brokers,
        "subscribe": topic,
        "startingOffsets": starts[position],
    }
    if group_id:
        options["kafka.group.id"] = group_id
    if max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    return options


def read_changes(
    spark: SparkSession,
    path: str | None = None,
    *,
    format: str = "text",
    schema: str | None = None,
    options: dict[str, str] | None = None,
    streaming: bool = False,
) -> DataFrame:
    """A change log as rows with the envelope text in ``value``.

    Text files give ``value`` only. Files of another format need a ``schema``
    with a ``value`` column and may carry more, such as ``seq``. The Kafka
    format keeps topic, partition, offset and timestamp beside the text.
    """
    reader = (spark.readStream if streaming else spark.read).format(format)
    reader = reader.options(**(options or {}))
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.load(path) if path is not None else reader.load()
    if "value" not in df.columns:
        raise ValueError("a change log needs a 'value' column")
    if format == "kafka":
        return df.select(
            F.col("value").cast("string").alias("value"), "topic", "partition", "offset", "timestamp"
        )
    return df


def read_lines(
    spark: SparkSession, path: str, streaming: bool = False, options: dict[str, str] | None = None
) -> DataFrame:
    """Text lines in ``value``, from files."""
    return read_changes(spark, path, format="text", options=options, streaming=streaming)


def jdbc_options(
    url: str,
    table: str,
    user: str,
    password: str,
    *,
    partition_column: str,
    lower: int,
    upper: int,
    partitions: int,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """Options to snapshot a database table in parallel with Spark's JDBC source."""
    return {
        "url": url,
        "dbtable": table,
        "user": user,
        "password": password,
        "partitionColumn": partition_column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
        "fetchsize": str(fetch_size),
    }
