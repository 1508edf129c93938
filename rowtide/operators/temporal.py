"""Versioned tables and joins to the version valid at a moment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from .hot_keys import (
    CHUNK,
    MAX_GROUP_ROWS,
    Bounds,
    all_chunks,
    chunk_of,
    hot_key_bounds,
    null_safe_join,
    with_bounds,
)
from .upsert import has_key, latest_per_key


def _names(value: str | Sequence[str] | None) -> list[str]:
    if value is None:
        return []
    return [value] if isinstance(value, str) else list(value)


def versioned(
    df: DataFrame,
    key: str | Sequence[str],
    time: str,
    tie: str | Sequence[str] | None = None,
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each row as a version of its key, valid in ``[valid_from, valid_to)``.

    ``valid_to`` is the time of the key's next version, null for the current
    one. Of several rows of a key at one time only the last by ``tie`` is ever
    visible, so only that one is a version. Rows without a time are none;
    those without a key are versions of one key.
    """
    keys, ties = _names(key), _names(tie)
    rows = df.where(F.col(time).isNotNull())
    bounds = None
    if max_group_rows is not None:
        bounds = hot_key_bounds(
            rows.select(*keys, time), keys, F.struct(F.col(time)), max_group_rows
        )
    if bounds is None:
        later = Window.partitionBy(*keys).orderBy(time, *ties)
        return (
            rows.withColumn("valid_from", F.col(time))
            .withColumn("valid_to", F.lead(time).over(later))
            .where(F.col("valid_to").isNull() | (F.col("valid_to") > F.col("valid_from")))
        )

    columns = df.columns
    # Equal times collapse map-side here, so that no chunk is one single time.
    single = latest_per_key(rows, [*keys, time], ties) if ties else rows.dropDuplicates([*keys, time])
    chunked = (
        with_bounds(single, bounds, keys)
        .withColumn(CHUNK, chunk_of(F.struct(F.col(time)), F.col("bounds"), bounds.longest))
        .drop("bounds", "heavy")
    )
    # Every chunk of a hot key gets one end marker: the key's next time after it.
    starts = (
        with_bounds(rows.select(*keys, time), bounds, keys)
        .where(F.col("bounds").isNotNull())
        .withColumn(CHUNK, chunk_of(F.struct(F.col(time)), F.col("bounds"), bounds.longest))
        .groupBy(*keys, CHUNK)
        .agg(F.min(time).alias("_start"))
    )
    after = Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(1, Window.unboundedFollowing)
    markers = (
        null_safe_join(all_chunks(bounds, keys).select(*keys, CHUNK), starts, [*keys, CHUNK], "left")
        .withColumn(time, F.min("_start").over(after))
        .select(*keys, CHUNK, time, F.lit(True).alias("_marker"))
        .where(F.col(time).isNotNull())
    )
    both = chunked.withColumn("_marker", F.lit(False)).unionByName(markers, allowMissingColumns=True)
    later = Window.partitionBy(*keys, CHUNK).orderBy("_marker", time)
    return (
        both.withColumn("valid_from", F.col(time))
        .withColumn("valid_to", F.lead(time).over(later))
        .where(~F.col("_marker"))
        .select(*columns, "valid_from", "valid_to")
    )


def as_of(versions: DataFrame, at: object) -> DataFrame:
    """The version of each key valid at ``at`` (a value or a Column)."""
    moment = at if isinstance(at, Column) else F.lit(at)
    return versions.where(
        (F.col("valid_from") <= moment)
        & (F.col("valid_to").isNull() | (moment < F.col("valid_to")))
    )


def joined_names(facts: Sequence[str], dims: Sequence[str]) -> list[str]:
    """Names for the dimension columns: those that clash get the suffix ``0``."""
    taken = set(facts)
    names = []
    for c in dims:
        name = c
        while name in taken:
            name += "0"
        taken.add(name)
        names.append(name)
    return names


def temporal_join(
    facts: DataFrame,
    dims: DataFrame,
    key: str | Sequence[str],
    time: str,
    tie: str | Sequence[str] | None = None,
    how: str = "inner",
    max_group_rows: int | None = MAX_GROUP_ROWS,
) -> DataFrame:
    """Each fact with the newest dimension row of its key at or before it.

    At equal times the dimension row comes first; among dimension rows of one
    time the last by ``tie`` counts. Facts with no such row are dropped
    (``how="inner"``) or kept with nulls (``"left"``). A null key or time
    matches nothing. Result: the fact columns, then the dimension columns,
    clashing names suffixed ``0``.

    Both sides go through one shuffle and one sorted pass; there is no
    non-equi join. Keys with more than ``max_group_rows`` rows are cut into
    chunks first (a count per key runs when the join is built); ``None`` skips
    that check for keys known to be even.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    keys, ties = _names(key), _names(tie)
    fact_columns, dim_columns = facts.columns, dims.columns
    key_alias = [f"_k{i}" for i in range(len(keys))]
    tie_alias = [f"_tie{i}" for i in range(len(ties))]

    keyed = has_key(key_alias)
    fact_rows = facts.select(
        *[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
        F.col(time).alias("_time"),
        F.lit(1).alias("_side"),
        *[F.col(c).alias(f"_f{i}") for i, c in enumerate(fact_columns)],
    )
    if how == "inner":
        fact_rows = fact_rows.where(keyed)
    dim_rows = dims.select(
        *[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
        F.col(time).alias("_time"),
        F.lit(0).alias("_side"),
        *[F.col(t).alias(a) for t, a in zip(ties, tie_alias)],
        F.struct(*[F.col(c).alias(f"d{i}") for i, c in enumerate(dim_columns)]).alias("_dim"),
    ).where(keyed & F.col("_time").isNotNull())

    order = ["_time", "_side", *tie_alias]
    bounds = None
    if max_group_rows is not None:
        slim = [*key_alias, "_time", "_side"]
        all_rows = fact_rows.where(keyed).select(*slim).unionByName(dim_rows.select(*slim))
        bounds = hot_key_bounds(all_rows, key_alias, F.struct("_time", "_side"), max_group_rows)

    # Facts without a key meet no dimension row; the group only has to be small.
    keyless = F.lit(0)
    if how == "left":
        keyless = F.when(~keyed, F.spark_partition_id()).otherwise(0)
    if bounds is None:
        rows = fact_rows.withColumn("_spread", keyless).unionByName(
            dim_rows.withColumn("_spread", F.lit(0)), allowMissingColumns=True
        )
        group = [*key_alias, "_spread"]
    else:
        rows = _chunked_rows(fact_rows, dim_rows, bounds, key_alias, tie_alias, keyless)
        group = [*key_alias, CHUNK, "_spread"]

    upto_here = (
        Window.partitionBy(*group)
        .orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    matched = rows.withColumn("_match", F.last("_dim", ignorenulls=True).over(upto_here)).where(
        F.col("_side") == 1
    )
    if how == "inner":
        matched = matched.where(F.col("_match").isNotNull())
    return matched.select(
        *[F.col(f"_f{i}").alias(c) for i, c in enumerate(fact_columns)],
        *[
            F.col(f"_match.d{i}").alias(n)
            for i, n in enumerate(joined_names(fact_columns, dim_columns))
        ],
    )


def _chunked_rows(
    fact_rows: DataFrame,
    dim_rows: DataFrame,
    bounds: Bounds,
    keys: list[str],
    ties: list[str],
    keyless: Column,
) -> DataFrame:
    """Facts and dimension rows with the chunks of hot keys marked.

    Each chunk starts with a carried row: the newest dimension row of the
    chunks before it. Facts that share one heavy order value need nothing but
    that row, so they may lie in any of ``bounds.spread`` copies of the chunk.
    """
    position = F.struct("_time", "_side")

    def chunked(rows: DataFrame) -> DataFrame:
        return with_bounds(rows, bounds, keys).withColumn(CHUNK, chunk_of(position, F.col("bounds"), bounds.longest))

    at_heavy_bound = F.coalesce(
        F.get("heavy", F.col(CHUNK) - 1) & (F.get("bounds", F.col(CHUNK) - 1) == position),
        F.lit(False),
    )
    # The task number is the same when a task is run again.
    anywhere = F.spark_partition_id() % bounds.spread
    facts = (
        chunked(fact_rows)
        .withColumn("_spread", F.when(at_heavy_bound, anywhere).otherwise(keyless))
        .drop("bounds", "heavy")
    )
    # One dimension row per key and time is all a fact can see; equal times
    # collapse map-side before they can fill a group.
    visible = latest_per_key(dim_rows, [*keys, "_time"], ties or ["_side"])
    dims = chunked(visible).withColumn("_spread", F.lit(0))
    last_of_chunk = (
        dims.where(F.col("bounds").isNotNull())
        .groupBy(*keys, CHUNK)
        .agg(F.max_by("_dim", "_time").alias("_dim"))
    )
    before = (
        Window.partitionBy(*keys).orderBy(CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = (
        all_chunks(bounds, keys)
        .join(last_of_chunk, [*keys, CHUNK], "left")
        .withColumn("_dim", F.last("_dim", ignorenulls=True).over(before))
        .where(F.col("_dim").isNotNull())
        .select(
            *keys,
            CHUNK,
            F.col("_lower._time").alias("_time"),
            F.lit(-1).alias("_side"),
            "_dim",
            F.explode(
                F.when(F.col("_heavy"), F.sequence(F.lit(0), F.lit(bounds.spread - 1)))
                .otherwise(F.array(F.lit(0)))
            ).alias("_spread"),
        )
    )
    return facts.unionByName(dims.drop("bounds", "heavy"), allowMissingColumns=True).unionByName(
        carried, allowMissingColumns=True
    )
