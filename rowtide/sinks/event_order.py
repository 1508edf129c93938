"""Upserts and deletes that take effect by event order, whatever order they arrive in.

A delete leaves a tombstone: its key and its place in the event order. A change
that comes after the delete but happened before it finds the tombstone and is
left out, so it cannot bring the key back. Tombstones are a table of their own,
partitioned by a hash of the key, and are dropped after a retention time.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.upsert import has_key, latest_per_key
from ..storage import checkpointed
from .tables import BUCKET, TableSpec, bucket_of, ensure_table, upsert_table

#: Partitions of a tombstone table whose target has no buckets.
TOMBSTONE_BUCKETS = 16


def tombstones_of(spec: TableSpec) -> TableSpec:
    """The table of a target's tombstones: keys and event order."""
    return replace(
        spec,
        name=f"{spec.name}_tombstones",
        location=f"{spec.location.rstrip('/')}_tombstones",
        columns=(*spec.keys, spec.precombine),
        partition_by=(),
        rule="greatest",
        buckets=spec.buckets or TOMBSTONE_BUCKETS,
    )


def upsert_in_event_order(
    spec: TableSpec,
    batch: DataFrame,
    order: Sequence[str] = (),
    deleted: str = "deleted",
    keep_after: str | None = None,
) -> None:
    """Merge stamped rows so that the last event of each key by ``precombine``
    counts, in whatever batches the events come.

    Of events with equal ``precombine`` a delete wins; between two changes the
    later arrival does. ``deleted`` names a boolean column. ``keep_after`` is
    the retention limit: events before it are left out, since their tombstones
    may be gone; pass the same limit to ``drop_tombstones``. A batch may be
    repeated. Tombstones are stored before the rows go, so a failure in between
    never brings a key back.
    """
    if spec.key_scope != "table":
        raise ValueError("event order needs keys that live once in the table")
    spark = batch.sparkSession
    stones = tombstones_of(spec)
    ensure_table(spark, stones)
    keys, place = list(spec.keys), F.col(spec.precombine)
    gone = F.coalesce(F.col(deleted), F.lit(False))
    rows = batch.where(has_key(keys) & place.isNotNull()).withColumn(deleted, gone)
    if keep_after is not None:
        rows = rows.where(place >= F.lit(keep_after))
    newest = latest_per_key(rows, keys, [spec.precombine, deleted, *order])
    newest = newest.withColumn(BUCKET, bucket_of(stones))
    used = [r[0] for r in newest.select(BUCKET).distinct().collect()]  # at most one per bucket
    buried = spark.table(stones.name).where(F.col(BUCKET).isin(used)).select(*keys, place.alias("_buried"))
    alive = newest.join(buried, keys, "left").where(F.col("_buried").isNull() | (place > F.col("_buried")))
    # Written before the tombstones change, so that a lost executor cannot see the new ones.
    alive = checkpointed(alive.drop("_buried", BUCKET))
    upsert_table(stones, alive.where(F.col(deleted)))
    upsert_table(replace(spec, rule="greatest"), alive, [deleted], deleted=deleted)


def drop_tombstones(spark: SparkSession, spec: TableSpec, before: str) -> None:
    """Forget deletes whose event order lies before the retention limit."""
    stones = tombstones_of(spec)
    ensure_table(spark, stones)
    old = spark.table(stones.name).where(F.col(spec.precombine) < F.lit(before))
    upsert_table(stones, old.drop(BUCKET).withColumn("_old", F.lit(True)), deleted="_old")


def buried(spark: SparkSession, spec: TableSpec) -> DataFrame:
    """Keys and event order of the tombstones."""
    return spark.table(tombstones_of(spec).name).drop(BUCKET)

