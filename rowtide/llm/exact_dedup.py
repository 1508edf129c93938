"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries find the digests that may be frequent. Their counts are
verified on all rows, and the winners of frequent groups, at most ``k``, are
broadcast, so that copies are recognised on the map side. Only the remaining
digests, each with fewer than one row in ``k``, are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import saved, whole_text

#: Groups with at least one row in this many are frequent.
HEAVY_GROUPS = 1024


def _shrunk(counts: dict[bytes, int], k: int) -> dict[bytes, int]:
    """The Misra-Gries step: subtract the (k+1)-th largest count from all."""
    if len(counts) <= k:
        return counts
    cut = sorted(counts.values(), reverse=True)[k]
    return {d: n - cut for d, n in counts.items() if n > cut}


def frequent_candidates(digests: DataFrame, k: int = HEAVY_GROUPS) -> DataFrame:
    """At most ``k`` values of the column ``digest``, among them every value
    that more than one row in ``k`` + 1 holds. No rows give no candidates."""

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bytes, int] = {}
        for batch in batches:
            found = pc.value_counts(batch.column(0))
            for d, n in zip(found.field(0).to_pylist(), found.field(1).to_pylist()):
                counts[d] = counts.get(d, 0) + n
            counts = _shrunk(counts, k)
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())],
            names=["digest", "n"],
        )

    parts = digests.select("digest").mapInArrow(summary, "digest binary, n long")
    merged = parts.groupBy("digest").agg(F.sum("n").alias("n"))
    return merged.orderBy(F.desc("n"), "digest").limit(k).select("digest")


def _digests(docs: DataFrame) -> DataFrame:
    """doc_id and digest of each row's whole text."""
    return saved(docs.select("doc_id", _digest().alias("digest")), "digests")


def _digest() -> Column:
    return F.unhex(F.sha2(whole_text().cast("binary"), 256))


def frequent_winners(digests: DataFrame, k: int = HEAVY_GROUPS) -> DataFrame:
    """digest, keep_id, group_size of the groups with at least one row in
    ``k``, counted on all rows: at most k rows of about 50 bytes."""
    rows = digests.count()
    winners = (
        digests.join(F.broadcast(frequent_candidates(digests, k)), "digest")
        .groupBy("digest")
        .agg(F.max("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .where(F.col("group_size") * k >= rows)
    )
    return saved(winners, "winners")


def _other(digests: DataFrame, winners: DataFrame) -> DataFrame:
    """The rows of groups that are not frequent, with their group's winner and size."""
    same = Window.partitionBy("digest")
    return digests.join(F.broadcast(winners), "digest", "left_anti").select(
        "digest",
        "doc_id",
        F.max("doc_id").over(same).alias("keep_id"),
        F.count(F.lit(1)).over(same).alias("group_size"),
    )


def mark_copies(docs: DataFrame, k: int = HEAVY_GROUPS) -> DataFrame:
    """One row per row of ``docs`` (doc_id, text): doc_id, keep_id, group_size,
    kept, text_sha256.

    Texts are equal when they are identical; null counts as empty. The largest
    doc_id of a group stays. A null doc_id never wins against a number; in a
    group of null ids only, keep_id is null and kept is true. Rows that repeat
    both doc_id and text are all marked alike. Other columns are ignored.
    """
    digests = _digests(docs)
    winners = frequent_winners(digests, k)
    other = _other(digests, winners)
    frequent = digests.join(F.broadcast(winners), "digest")
    return frequent.select(*other.columns).unionByName(other).select(
        "doc_id",
        "keep_id",
        "group_size",
        F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def drop_copies(docs: DataFrame, k: int = HEAVY_GROUPS) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns; of rows that
    repeat doc_id and text, one.

    Copies of frequent groups go on the map side. Of the other rows only the
    ids and digests that go, or that repeat, are joined to the texts; Spark
    shuffles the texts only where those are too many for it to broadcast.
    """
    digests = _digests(docs)
    winners = frequent_winners(digests, k)
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    frequent = digests.join(F.broadcast(winners), "digest").where(stays)
    rows = frequent.select("digest", "doc_id", "keep_id").unionByName(
        _other(digests, winners).select("digest", "doc_id", "keep_id")
    )
    special = (
        rows.groupBy("digest", "doc_id", "keep_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("digest").alias("_digest"), F.col("doc_id").alias("_id"), stays.alias("_kept"), "n")
        .where("NOT _kept OR n > 1")
    )
    special = saved(special.select("_digest", "_id", "_kept"), "special")
    hot = F.broadcast(winners.select("digest", "keep_id", F.lit(True).alias("hot")))
    left = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), "doc_id", _digest().alias("digest"))
    left = left.join(hot, "digest", "left").where(F.col("hot").isNull() | stays).select("row", "doc_id", "digest")
    same = (F.col("digest") == F.col("_digest")) & F.col("doc_id").eqNullSafe(F.col("_id"))
    once = left.join(special, same, "left_anti").select("row.*")
    repeated = special.where("_kept")
    if repeated.isEmpty():
        return once
    # The first of each key, found before the shuffle and again after it.
    first = F.row_number().over(Window.partitionBy("digest", "doc_id").orderBy("digest"))
    repeats = left.join(repeated, same, "left_semi").withColumn("nr", first).where("nr = 1")
    return once.unionByName(repeats.select("row.*"))
