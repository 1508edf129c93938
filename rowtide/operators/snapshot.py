"""A snapshot taken while the log runs.

The table is read in ranges of its key. The position of the log is noted before
and after each range is read: the low and the high mark. What was read holds
every change up to the low mark, and may or may not hold those up to the high
mark, so changes between the marks override it and later ones follow. The table
is never locked and the log never stops.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .hot_keys import chunk_of

#: Ranges are planned, read and looked up one by one; more are an error.
MAX_RANGES = 10_000
MARKS = "number INT, low BIGINT, high BIGINT"


@dataclass(frozen=True)
class KeyRange:
    """Keys from ``lower`` up to, not including, ``upper``; None is open. The
    range that is open below also holds null keys."""

    number: int
    lower: object = None
    upper: object = None

    def holds(self, key: Column) -> Column:
        """Whether a key lies in the range; the scan can push it down."""
        inside = F.lit(True) if self.upper is None else key < F.lit(self.upper)
        if self.lower is not None:
            return (key >= F.lit(self.lower)) & inside
        return inside if self.upper is None else inside | key.isNull()

    def predicate(self, key: str) -> str:
        """The same as SQL text, for ``predicates`` of Spark's JDBC reader.

        Numbers and text only; text compares as the database compares it, so use
        a column whose collation orders by code point.
        """

        def literal(value: object) -> str:
            if isinstance(value, bool) or not isinstance(value, (int, float, str)):
                raise TypeError(f"no SQL text for a bound of type {type(value).__name__}")
            return "'" + value.replace("'", "''") + "'" if isinstance(value, str) else str(value)

        inside = [] if self.lower is None else [f"{key} >= {literal(self.lower)}"]
        inside += [] if self.upper is None else [f"{key} < {literal(self.upper)}"]
        text = " AND ".join(inside) or "1 = 1"
        return f"({text} OR {key} IS NULL)" if self.lower is None and inside else text


def key_ranges(df: DataFrame, key: str, parts: int) -> list[KeyRange]:
    """At most ``parts`` ranges of a key of any ordered type, with about as many
    rows in each, however unevenly the values lie.

    Spark samples the keys and deals them out by range; only the least key of
    each range comes back. A single key is never split.
    """
    if not 1 <= parts <= MAX_RANGES:
        raise ValueError(f"parts must be between 1 and {MAX_RANGES}")
    keys = df.select(F.col(key).alias("k")).where(F.col("k").isNotNull())
    least = keys.repartitionByRange(parts, "k").groupBy(F.spark_partition_id().alias("part")).agg(F.min("k").alias("k"))
    lowers = [r.k for r in sorted(least.collect(), key=lambda r: r.part)][1:]
    return [KeyRange(n, a, b) for n, (a, b) in enumerate(zip([None, *lowers], [*lowers, None]))]


def range_number(key: Column, ranges: Sequence[KeyRange]) -> Column:
    """The number of the range that a key lies in, by binary search."""
    lowers = [r.lower for r in ranges[1:]]
    return chunk_of(key, F.array(*map(F.lit, lowers)), len(lowers)) if lowers else F.lit(0)


def _files(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def snapshot_marks(spark: SparkSession, folder: str) -> DataFrame:
    """number, low and high of the ranges that are read completely."""
    files, place = _files(spark, f"{folder}/marks")
    if not files.exists(place):
        return spark.createDataFrame([], MARKS)
    return spark.read.schema(MARKS).parquet(f"{folder}/marks/*")


def snapshot_in_ranges(
    spark: SparkSession,
    ranges: Sequence[KeyRange],
    read: Callable[[KeyRange], DataFrame],
    position: Callable[[], int],
    folder: str,
    at_most: int | None = None,
) -> int:
    """Read ranges that are not in ``folder`` yet, at most so many; returns how
    many are left.

    ``position`` gives the log's current position, ``read`` a range's rows as
    they are when Spark runs the read. A range counts once its marks are
    written, after its rows. Call it again after a failure: finished ranges are
    not read again, a half-written one is replaced.
    """
    done = {r.number for r in snapshot_marks(spark, folder).collect()}  # a row per range
    open_ranges = [r for r in ranges if r.number not in done]
    for r in open_ranges[:at_most]:
        low = position()
        read(r).write.mode("overwrite").parquet(f"{folder}/rows/range={r.number}")
        marks = spark.createDataFrame([(r.number, low, position())], MARKS)
        marks.coalesce(1).write.mode("overwrite").parquet(f"{folder}/marks/range={r.number}")
    return len(open_ranges[at_most:]) if at_most is not None else 0


def snapshot_rows(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All rows read so far, with the number of their range in ``range``."""
    files, place = _files(spark, f"{folder}/rows")
    if not files.exists(place):
        return spark.createDataFrame([], f"{schema}, range INT")
    return spark.read.schema(f"{schema}, range INT").parquet(f"{folder}/rows")


def reconciled(
    rows: DataFrame,
    marks: DataFrame,
    log: DataFrame,
    ranges: Sequence[KeyRange],
    keys: Sequence[str],
    seq: str = "seq",
) -> DataFrame:
    """One change log from the ranges read and the running log.

    ``rows`` are the ranges' rows with ``range``, ``log`` has the same other
    columns and ``seq``; the first of ``keys`` is the one the ranges cut. A
    range's rows come at its low mark, but those that the log changes between
    the marks; of the log, what came after the low mark of the key's range.
    Rows and changes of ranges that have no marks are left out: those ranges are
    read later. Changes without a key count to the first range.

    The changes between marks are matched by one equi-join that carries keys
    only; ranges and marks, a few numbers each, are literals of the plan.
    """
    found = {r.number: (r.low, r.high) for r in marks.collect()}  # a row per range
    low, high = (
        F.array(*[F.lit(found[r.number][i] if r.number in found else None).cast("bigint") for r in ranges])
        for i in (0, 1)
    )
    keys = list(keys)
    number = range_number(F.col(keys[0]), ranges)
    placed = log.withColumn("_range", F.when(F.col(keys[0]).isNull(), 0).otherwise(number))
    later = placed.where(F.col(seq) > F.get(low, F.col("_range")))
    between = later.where(F.col(seq) <= F.get(high, F.col("_range"))).select(*keys).distinct()
    read = rows.withColumn(seq, F.get(low, F.col("range"))).where(F.col(seq).isNotNull())
    untouched = read.join(between, keys, "left_anti")
    return untouched.select(*log.columns).unionByName(later.select(*log.columns))
