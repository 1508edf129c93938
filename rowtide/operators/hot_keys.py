"""Cut the ordered rows of hot keys into chunks of bounded size.

Operators that walk the rows of a key in order (as-of join, validity
intervals) would put a key that holds a third of all rows into one task. Here
the few keys above a row limit get split points in their own order, taken from
a sample, so that each (key, chunk) is again a group of bounded size. What has
to cross a chunk border is summarised per chunk and passed on as extra rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..storage import checkpointed

MAX_GROUP_ROWS = 5_000_000
SAMPLES_PER_CHUNK = 32
CHUNK = "_chunk"
# Split points (some tens of bytes each) up to which a broadcast is asked for;
# beyond, Spark shuffles and splits the skewed partitions itself.
BROADCAST_POINTS = 500_000


@dataclass(frozen=True)
class Bounds:
    """Split points of the hot keys.

    ``rows`` holds the keys, ``bounds`` (ascending distinct order values) and
    ``heavy`` (whether a bound is one order value shared by a chunk's worth of
    rows); ``longest`` and ``total`` count the bounds of one key and of all,
    ``spread`` the groups that the rows of the largest key fill.
    """

    rows: DataFrame
    longest: int
    total: int
    spread: int


def hot_key_bounds(
    rows: DataFrame, keys: Sequence[str], order: Column, max_group_rows: int
) -> Bounds | None:
    """Split points of the keys above ``max_group_rows``, or None without any.

    Runs one count per key, with map-side combine, over the key columns only;
    the rest follows only if a key is hot, null keys included. The result is
    checkpointed: the sample must be the same for every reader of the bounds.
    """
    counts = rows.groupBy(*keys).agg(F.count("*").alias("_rows"))
    hot = checkpointed(counts.where(F.col("_rows") > max_group_rows))
    n_hot, most = hot.agg(F.count("*"), F.max("_rows")).first()
    if not n_hot:
        return None
    fraction = min(1.0, SAMPLES_PER_CHUNK / max_group_rows)
    every = max(1, round(fraction * max_group_rows))
    sample = rows.sample(fraction, seed=17).withColumn("_order", order)
    sample = null_safe_join(sample, _small(hot.select(*keys), n_hot), keys, "left_semi")
    in_order = Window.partitionBy(*keys).orderBy("_order")
    picked = sample.withColumn("_n", F.row_number().over(in_order)).where(F.col("_n") % every == 0)
    bounds = (
        picked.groupBy(*keys, "_order")
        .agg((F.count("*") > 1).alias("_heavy"))
        .groupBy(*keys)
        .agg(F.array_sort(F.collect_list(F.struct("_order", "_heavy"))).alias("_b"))
        .select(*keys, F.col("_b._order").alias("bounds"), F.col("_b._heavy").alias("heavy"))
    )
    saved = checkpointed(bounds)
    longest, total = saved.agg(F.max(F.size("bounds")), F.sum(F.size("bounds"))).first()
    return Bounds(saved, longest or 0, total or 0, -(-most // max_group_rows))


def _small(df: DataFrame, points: int) -> DataFrame:
    return F.broadcast(df) if points <= BROADCAST_POINTS else df


def null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """An equality join in which null keys match each other."""
    names = {k: f"_right{i}" for i, k in enumerate(keys)}
    renamed = right.withColumnsRenamed(names)
    same = F.lit(True)
    for k, name in names.items():
        same = same & F.col(k).eqNullSafe(F.col(name))
    return left.join(renamed, same, how).drop(*names.values())


def chunk_of(order: Column, bounds: Column, longest: int) -> Column:
    """How many of at most ``longest`` bounds are at or below ``order``: a
    binary search, 0 if there are none."""
    steps = F.array(*[F.lit(1 << b) for b in range(longest.bit_length(), -1, -1)])
    search = F.aggregate(
        steps,
        F.lit(0),
        lambda found, step: F.when(
            F.get(bounds, found + step - 1) <= order, found + step
        ).otherwise(found),
    )
    return F.when(bounds.isNotNull(), search).otherwise(0)


def with_bounds(rows: DataFrame, bounds: Bounds, keys: Sequence[str]) -> DataFrame:
    """Rows with the ``bounds`` and ``heavy`` of their key, null if not hot."""
    return null_safe_join(rows, _small(bounds.rows, bounds.total), keys, "left")


def all_chunks(bounds: Bounds, keys: Sequence[str]) -> DataFrame:
    """One row per hot key and chunk, with the chunk's lower bound."""
    return bounds.rows.select(
        *keys, "heavy", "bounds", F.explode(F.sequence(F.lit(0), F.size("bounds"))).alias(CHUNK)
    ).select(
        *keys,
        CHUNK,
        F.get("bounds", F.col(CHUNK) - 1).alias("_lower"),
        F.coalesce(F.get("heavy", F.col(CHUNK) - 1), F.lit(False)).alias("_heavy"),
    )
