"""Keep the latest row per key and merge changes into a table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

# Fixed formats of the two partition columns; "hh" is the 12-hour clock.
DAY_PATTERN = "yyyy-MM-dd"
HOUR_PATTERN = "hh"
PARTITION_COLUMNS = ("logday", "hh")


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest by ``order``, nulls lowest.

    An aggregate rather than a window, so every task reduces its own rows
    before the shuffle and a hot key sends one row per task.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    best = F.max_by(F.struct(*rest), F.struct(*order)).alias("_row")
    return (
        df.groupBy(*keys).agg(best).select(*keys, "_row.*").select(*df.columns)
    )


def stamp_partition(
    df: DataFrame,
    ts: Column | None = None,
    day: str = DAY_PATTERN,
    hour: str = HOUR_PATTERN,
) -> DataFrame:
    """Add ``logday`` and ``hh`` from ``ts``, by default the current time.

    On a stream, stamp before ``foreachBatch``: there the current time is the
    batch time of the checkpoint, and a replayed batch gets the same stamp.
    The default hour pattern is the 12-hour clock, so 01:xx and 13:xx share a
    partition; ``hour="HH"`` separates them.
    """
    moment = F.current_timestamp() if ts is None else ts
    return df.withColumns(
        {"logday": F.date_format(moment, day), "hh": F.date_format(moment, hour)}
    )


def has_key(keys: Sequence[str]) -> Column:
    present = F.lit(True)
    for k in keys:
        present = present & F.col(k).isNotNull()
    return present


def merge_upsert(
    current: DataFrame,
    changes: DataFrame,
    keys: Sequence[str],
    precombine: str | None = None,
    *,
    rule: str = "incoming",
    order: Sequence[str] = (),
    deleted: str | None = None,
    deduplicated: bool = False,
) -> DataFrame:
    """The table after the changes; columns of ``current``.

    ``changes`` are first reduced to one row per key: greatest ``precombine``,
    then greatest ``order`` (for instance a sequence number). Then

    * ``rule="incoming"``: the change replaces the stored row;
    * ``rule="greatest"``: only if its ``precombine`` is not below the stored
      one, so that late rows cannot take the table back.

    ``deleted`` names a boolean column of ``changes``: a winning row with it
    set removes the key. Changes without a key are left out; see ``has_key``.
    ``deduplicated`` says that ``changes`` already hold one row per key.
    """
    if rule not in ("incoming", "greatest"):
        raise ValueError(f"rule must be 'incoming' or 'greatest', not {rule!r}")
    if rule == "greatest" and precombine is None:
        raise ValueError("rule 'greatest' needs a precombine column")
    keys = list(keys)
    ranking = [c for c in [precombine, *order] if c]
    incoming = changes.where(has_key(keys))
    if not deduplicated:
        if not ranking:
            raise ValueError("changes need a precombine or order column to pick one row per key")
        incoming = latest_per_key(incoming, keys, ranking)
    gone = F.coalesce(F.col(deleted), F.lit(False)) if deleted else F.lit(False)
    incoming = incoming.withColumn("_gone", gone)

    if rule == "incoming":
        # The anti side is one row per key; Spark broadcasts it if it is small.
        kept = current.join(incoming.select(*keys), keys, "left_anti")
        return kept.unionByName(incoming.where(~F.col("_gone")).select(*current.columns))

    stored = current.withColumns({"_gone": F.lit(False), "_new": F.lit(0)})
    arrived = incoming.select(*current.columns, "_gone").withColumn("_new", F.lit(1))
    both = stored.unionByName(arrived)
    return (
        latest_per_key(both, keys, [precombine, "_new"])
        .where(~F.col("_gone"))
        .select(*current.columns)
    )
