"""Options of the jobs, checked before anything starts."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field, fields

from pyspark.sql import SparkSession

ROCKSDB_PROVIDER = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

# The options each job cannot run without.
_CAPTURE = ("host", "username", "password", "db_list", "table_list")
REQUIRED = {
    "capture_to_topic": ("checkpoint_dir", "brokers", "sink_topic", *_CAPTURE),
    "capture_to_shards": ("checkpoint_dir", "stream_name", "stream_region", *_CAPTURE),
    "topic_to_tables": ("checkpoint_dir", "brokers", "source_topic", "group_id"),
    "topic_with_dimension": ("checkpoint_dir", "brokers", "source_topic", *_CAPTURE),
    "lines_with_dimension": ("checkpoint_dir",),
}


@dataclass(frozen=True)
class JobOptions:
    """Settings of one job; ``for_job`` names the missing ones.

    The password comes from the caller's secret store, never from a command
    line, and does not show in the representation.
    """

    checkpoint_dir: str = ""
    checkpoint_interval: int = 60
    brokers: str = ""
    sink_topic: str = ""
    source_topic: str = ""
    group_id: str = ""
    host: str = ""
    username: str = ""
    password: str = field(default="", repr=False)
    db_list: str = ""
    table_list: str = ""
    parallel: int = 1
    position: str = "initial"
    stream_name: str = ""
    stream_region: str = ""
    server_id: str = ""
    name: str = ""
    once: bool = False

    def __post_init__(self) -> None:
        if self.checkpoint_interval <= 0:
            raise ValueError("checkpoint_interval must be a positive number of seconds")
        if self.parallel < 1:
            raise ValueError("parallel must be at least 1")
        if self.position not in ("initial", "latest"):
            raise ValueError(f"position must be 'initial' or 'latest', not {self.position!r}")

    @classmethod
    def for_job(cls, job: str, **values: object) -> "JobOptions":
        """Options of a job; raises on unknown names and missing values."""
        if job not in REQUIRED:
            raise ValueError(f"unknown job {job!r}; one of {', '.join(REQUIRED)}")
        unknown = set(values) - {f.name for f in fields(cls)}
        if unknown:
            raise ValueError(f"unknown options: {', '.join(sorted(unknown))}")
        options = cls(**values)
        missing = [n for n in REQUIRED[job] if not getattr(options, n)]
        if missing:
            raise ValueError(f"{job} needs {', '.join(missing)}")
        return options

    @property
    def trigger(self) -> dict[str, object]:
        """One batch per interval; with ``once`` what is there, then the end."""
        if self.once:
            return {"availableNow": True}
        return {"processingTime": f"{self.checkpoint_interval} seconds"}


def use_rocksdb_state(spark: SparkSession) -> None:
    """Keep keyed state in RocksDB, on disk, with changelog checkpoints."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB_PROVIDER)
    spark.conf.set(
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled", "true"
    )


@contextmanager
def rocksdb_state(spark: SparkSession) -> Iterator[None]:
    """RocksDB state for the queries started inside, and for no others: a query
    keeps the settings of the moment it starts."""
    names = [
        "spark.sql.streaming.stateStore.providerClass",
        "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled",
    ]
    before = {n: spark.conf.get(n, None) for n in names}
    use_rocksdb_state(spark)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
