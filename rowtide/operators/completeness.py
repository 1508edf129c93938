"""What a log lacks or holds twice, as rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

#: Offsets that are looked at in one group.
BLOCK = 1_000_000


def offset_faults(log: DataFrame, by: Sequence[str], offset: str, block: int = BLOCK) -> DataFrame:
    """Ranges of offsets that are missing between those seen, and offsets seen
    more than once: the columns ``by``, kind (missing or repeated), first, last,
    and copies (0, or how often the offset occurs).

    Nothing is said before a partition's first offset or after its last, and
    rows without an offset are left out. A null in ``by`` is a partition too.
    Offsets are counted with map-side combine and cut into blocks of their
    values, so that one partition of the log, however large, is many groups;
    only each block's least and greatest offset meet in a group per partition.
    """
    by = list(by)
    seen = log.where(F.col(offset).isNotNull()).groupBy(*by, F.col(offset).cast("long").alias("last"))
    seen = seen.agg(F.count(F.lit(1)).alias("copies"))
    blocks = seen.withColumn("_block", F.floor(F.col("last") / block))
    in_block = Window.partitionBy(*by, "_block").orderBy("last")
    inside = blocks.select(*by, "last", F.lag("last").over(in_block).alias("before"))
    ends = blocks.groupBy(*by, "_block").agg(F.min("last").alias("last"), F.max("last").alias("_greatest"))
    over_blocks = Window.partitionBy(*by).orderBy("_block")
    across = ends.select(*by, "last", F.lag("_greatest").over(over_blocks).alias("before"))
    gaps = inside.unionByName(across).where(F.col("last") - F.col("before") > 1)
    missing = gaps.select(
        *by,
        F.lit("missing").alias("kind"),
        (F.col("before") + 1).alias("first"),
        (F.col("last") - 1).alias("last"),
        F.lit(0).cast("long").alias("copies"),
    )
    again = seen.where(F.col("copies") > 1)
    repeated = again.select(*by, F.lit("repeated").alias("kind"), F.col("last").alias("first"), "last", "copies")
    return missing.unionByName(repeated)
