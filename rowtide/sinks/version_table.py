"""A stored table of validity intervals, kept up to date batch by batch.

A row that arrives late falls into an interval that is already stored: that
interval ends earlier and the new row takes over the rest. Only keys of the
batch are looked at, only intervals that end after the batch's first moment are
read, and only partitions with a changed interval are rewritten.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators.temporal import versioned
from ..operators.upsert import has_key, latest_per_key
from ..storage import checkpointed
from .tables import TableSpec, ensure_table, upsert_table

PART, PERIOD = "key_part", "period"


@dataclass(frozen=True)
class VersionSpec:
    """A version table: text columns, key, and a ``time`` whose text sorts in order.

    It is partitioned by a hash of the key in ``parts`` and by the first
    ``period_length`` characters of ``valid_from`` (7: months of ISO dates).
    """

    name: str
    location: str
    columns: tuple[str, ...]
    keys: tuple[str, ...]
    time: str
    parts: int = 16
    period_length: int = 7

    @property
    def table(self) -> TableSpec:
        return TableSpec(
            self.name,
            self.location,
            (*self.columns, "valid_from", "valid_to"),
            precombine="valid_from",
            keys=(*self.keys, "valid_from"),
            partition_by=(PART, PERIOD),
            key_scope="partition",
        )


def update_versions(spark: SparkSession, spec: VersionSpec, batch: DataFrame, tie: Sequence[str] = ()) -> None:
    """Add the rows of a batch as versions of their keys, at any times.

    Of a batch's rows with one key and time the last by ``tie`` counts; a row
    with the key and time of a stored version replaces it. Rows without a key or
    time are left out. The result is that of ``versioned`` over all rows of all
    batches, and a repeated batch changes nothing.
    """
    table = spec.table
    ensure_table(spark, table)
    keys, versions = list(spec.keys), [*spec.keys, spec.time]
    rows = batch.where(has_key(versions))
    rows = latest_per_key(rows, versions, list(tie)) if tie else rows.dropDuplicates(versions)
    part = F.pmod(F.xxhash64(*keys), F.lit(spec.parts)).cast("string")
    rows = checkpointed(rows.select(*spec.columns, part.alias(PART)))
    used = rows.groupBy(PART).agg(F.min(spec.time).alias("first")).collect()  # at most one per part
    if not used:
        return
    first = min(r.first for r in used)
    stored = spark.table(table.name).where(
        F.col(PART).isin([r[PART] for r in used])
        & (F.col("valid_to").isNull() | (F.col("valid_to") >= F.lit(first)))
    )
    mine = stored.join(rows.select(*keys).distinct(), keys, "left_semi")
    both = mine.select(*spec.columns, PART, F.lit(0).alias("_new")).unionByName(rows.withColumn("_new", F.lit(1)))
    whole = latest_per_key(both, versions, ["_new"]).drop("_new")
    found = versioned(whole, keys, spec.time)
    names = [*spec.columns, PART, "valid_from", "valid_to"]
    before = mine.select(*[F.col(c).alias(f"_{c}") for c in names])
    same = F.lit(True)
    for c in names:
        equal = F.col(c) == F.col(f"_{c}") if c in (*keys, "valid_from") else F.col(c).eqNullSafe(F.col(f"_{c}"))
        same = same & equal
    changed = found.join(before, same, "left_anti")
    changed = checkpointed(changed.withColumn(PERIOD, F.substring("valid_from", 1, spec.period_length)))
    upsert_table(table, changed)


def stored_versions(spark: SparkSession, spec: VersionSpec) -> DataFrame:
    """All versions; ``as_of`` takes them."""
    return spark.table(spec.name).drop(PART, PERIOD)
