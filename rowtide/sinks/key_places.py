"""Upserts that find a key's partition in a table of places.

In a table that is not cut into buckets a key may lie in any partition, and an
upsert reads the key column of all of them to find it. The table of places
says where each key lies, partitioned by a hash of the key: a batch reads the
hash partitions of its keys and the table's partitions that it rewrites, however
large the table grows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.upsert import has_key
from .tables import BUCKET, TableSpec, _in_partitions, bucket_of, ensure_table, upsert_table

#: Hash partitions of a table of places; a batch reads those of its keys.
PLACE_BUCKETS = 64


def places_of(spec: TableSpec, buckets: int = PLACE_BUCKETS) -> TableSpec:
    """The table of a target's places: keys and partition values."""
    if spec.buckets or spec.key_scope != "table" or not spec.partition_by:
        raise ValueError("places serve partitioned tables without buckets whose keys live once")
    if set(spec.keys) & set(spec.partition_by):
        raise ValueError("a key column is a partition column already")
    return replace(
        spec,
        name=f"{spec.name}_places",
        location=f"{spec.location.rstrip('/')}_places",
        columns=(*spec.keys, *spec.partition_by),
        precombine=spec.partition_by[0],
        partition_by=(),
        rule="incoming",
        buckets=buckets,
    )


def locate_keys(spark: SparkSession, spec: TableSpec, buckets: int = PLACE_BUCKETS) -> None:
    """Fill the table of places from a table that has none yet."""
    places = places_of(spec, buckets)
    ensure_table(spark, places)
    upsert_table(places, spark.table(spec.name).select(*spec.keys, *spec.partition_by))


def upsert_by_place(
    spec: TableSpec,
    batch: DataFrame,
    order: Sequence[str] = (),
    deleted: str | None = None,
    buckets: int = PLACE_BUCKETS,
) -> None:
    """What ``upsert_table`` does, without a read of the whole key column.

    All upserts of the table must come this way, after ``locate_keys`` if it
    holds rows already, and with the same ``buckets``. Places follow once the
    table is published; after a failure in between the batch must be repeated,
    as a stream does, and mends them.
    """
    spark = batch.sparkSession
    places = places_of(spec, buckets)
    ensure_table(spark, places)
    keys, parts = list(spec.keys), list(spec.partition_by)
    mine = batch.where(has_key(keys)).select(*[F.col(k).cast("string").alias(k) for k in keys]).distinct()
    holding = known_places(spark, places, mine).select(*parts)
    touched = upsert_table(spec, batch, order, deleted, holding=holding)
    if not touched:
        return
    # Under the rule "greatest" a stored row may stay where it was: ask the table.
    now = spark.table(spec.name).where(_in_partitions(touched, parts)).select(*keys, *parts)
    placed = mine.join(now, keys, "left").withColumn("_gone", F.col(parts[0]).isNull())
    upsert_table(places, placed, deleted="_gone")


def known_places(spark: SparkSession, places: TableSpec, keys: DataFrame) -> DataFrame:
    """Places of the given keys, from their hash partitions alone."""
    used = [r[0] for r in keys.select(bucket_of(places).alias(BUCKET)).distinct().collect()]  # at most one per bucket
    stored = spark.table(places.name).where(F.col(BUCKET).isin(used))
    return stored.join(keys, list(places.keys), "left_semi").drop(BUCKET)
