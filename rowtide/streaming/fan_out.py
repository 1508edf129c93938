"""One stream, read once, written to many destinations."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

Writer = Callable[[DataFrame, int], None]


@contextmanager
def adaptive_plans(spark: SparkSession) -> Iterator[None]:
    """Adaptive execution for the batch queries inside a micro-batch.

    A streaming query's session has it off, but the writes of a micro-batch
    are ordinary queries and want skew handling and sized partitions.
    """
    setting = "spark.sql.adaptive.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def fan_out(
    stream: DataFrame,
    writers: Mapping[str, Writer],
    checkpoint: str,
    *,
    name: str | None = None,
    trigger: dict | None = None,
    dest: str = "dest",
    parallel: int = 4,
) -> StreamingQuery:
    """Start one query that hands each destination its rows of every batch.

    The source is read and decoded once per batch; the batch is kept while
    up to ``parallel`` writers run. A writer gets ``(rows, batch_id)`` and must
    tolerate getting the same batch again after a failure. Stamp the time
    before this call, so that a repeated batch keeps its stamp.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        batch.persist()
        try:
            with adaptive_plans(session), ThreadPoolExecutor(max(1, parallel)) as pool:
                runs = [
                    pool.submit(
                        inheritable_thread_target(session)(writer),
                        batch.where(F.col(dest) == target),
                        batch_id,
                    )
                    for target, writer in writers.items()
                ]
                for run in runs:
                    run.result()
        finally:
            batch.unpersist()

    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    if name:
        query = query.queryName(name)
    return query.trigger(**(trigger or {"processingTime": "60 seconds"})).start()
