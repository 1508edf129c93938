"""Differences of very large tables: digests of key ranges first, rows second.

Every row goes into order-independent sums for the aligned range of its key, an
aggregate with map-side combine that shuffles one row per range. Ranges whose
sums differ are cut finer and summed again; only rows of the finest ranges that
differ are read and compared. Digests are data: store those of one version and
the next comparison need not read it whole.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType, LongType, MapType, ShortType, StructType, VariantType

from ..storage import checkpointed
from .capture import diff_changes

#: Ranges in one pushed-down filter; beyond, neighbours are read together.
MAX_RANGES = 64
#: Binary digits of the key inside a range, coarse to fine.
BITS = (20, 12)
NODE = "_range"
SUMS = ("rows", "sum_a", "sum_b", "sum_c", "sum_d")


def range_digests(df: DataFrame, key: str, bits: int = BITS[0]) -> DataFrame:
    """One row per key range that holds rows: its number, row count and sums.

    ``key`` is a whole-number column, and ``2**bits`` neighbouring values make a
    range; null keys are a range of their own. Equal tables have equal digests
    whatever their order; different ones agree with a chance of about 2**-96.
    """
    kind = df.schema[key].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise ValueError(f"{key} is no whole-number column; diff_changes takes keys of any type")
    parts = [p for f in df.schema.fields for p in _hashed(f.name, f.dataType)]
    first, second = F.xxhash64(F.lit(1), *parts), F.xxhash64(F.lit(2), *parts)
    piece = lambda h, shift: F.sum(F.shiftrightunsigned(h, shift).bitwiseAND(F.lit((1 << 24) - 1)))
    sums = [piece(first, 0), piece(first, 24), piece(second, 0), piece(second, 24)]
    return df.groupBy(_node(key, bits).alias(NODE)).agg(
        F.count(F.lit(1)).alias(SUMS[0]), *[s.alias(n) for s, n in zip(sums, SUMS[1:])]
    )


@dataclass(frozen=True)
class DifferingRanges:
    """Where two versions differ: ``of`` keeps a version's rows there."""

    key: str
    bits: int
    nodes: DataFrame
    ranges: tuple[tuple[int, int], ...]
    null_keys: bool
    #: Whether ``ranges`` hold only ranges that differ, or also some between.
    exact: bool

    def of(self, df: DataFrame) -> DataFrame:
        key = _column(self.key)
        tests = [key.between(lo << self.bits, ((hi + 1) << self.bits) - 1) for lo, hi in self.ranges]
        tests += [key.isNull()] * self.null_keys
        kept = df.where(_any(tests) if tests else F.lit(False))
        if self.exact:
            return kept
        same = _node(self.key, self.bits).eqNullSafe(self.nodes[NODE])
        return kept.join(self.nodes, same, "left_semi")


def differing_ranges(
    old: DataFrame,
    new: DataFrame,
    key: str,
    bits: Sequence[int] = BITS,
    old_digests: DataFrame | None = None,
) -> DifferingRanges:
    """The key ranges in which two versions differ, found level by level.

    ``bits`` fall from level to level; each level reads only what differed at
    the one before. ``old_digests`` are stored ``range_digests`` of ``old`` at
    the first level. At most ``MAX_RANGES`` rows come to the driver.
    """
    if not bits or any(a <= b for a, b in zip(bits, bits[1:])):
        raise ValueError("bits must fall from level to level")
    if set(old.columns) != set(new.columns):
        raise ValueError("both versions need the same columns")
    old = old.select(*[_column(c) for c in new.columns])
    found = None
    for level in bits:
        rows = (old, new) if found is None else (found.of(old), found.of(new))
        stored = old_digests if found is None else None
        before = range_digests(rows[0], key, level) if stored is None else stored
        negated = before.select(NODE, *[(-F.col(s)).alias(s) for s in SUMS])
        both = negated.unionByName(range_digests(rows[1], key, level))
        totals = both.groupBy(NODE).agg(*[F.sum(s).alias(s) for s in SUMS])
        nodes = checkpointed(totals.where(_any([F.col(s) != 0 for s in SUMS])).select(NODE))
        found = _covered(key, level, nodes)
    return found


def diff_in_ranges(
    old: DataFrame,
    new: DataFrame,
    keys: Sequence[str],
    *,
    bits: Sequence[int] = BITS,
    old_digests: DataFrame | None = None,
) -> DataFrame:
    """What ``diff_changes`` gives, comparing only ranges of the first key that
    differ. Both sides need unique keys; see ``row_count_changes`` for others."""
    where = differing_ranges(old, new, keys[0], bits, old_digests)
    return diff_changes(where.of(old), where.of(new), keys)


def row_count_changes(old: DataFrame, new: DataFrame, copies: str = "copies") -> DataFrame:
    """Rows that ``new`` holds more (``copies`` above 0) or fewer times than ``old``.

    Needs no key, and nulls equal each other, so it suits tables whose keys
    repeat. One aggregate over whole rows with map-side combine: a row that
    repeats a million times is shuffled once per task.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("both versions need the same columns")
    if copies in new.columns:
        raise ValueError(f"{copies} is a column already; give another name")
    columns = [_column(c) for c in new.columns]
    signed = old.select(*columns, F.lit(-1).alias(copies)).unionAll(new.select(*columns, F.lit(1).alias(copies)))
    return signed.groupBy(*columns).agg(F.sum(copies).alias(copies)).where(_column(copies) != 0)


def _covered(key: str, bits: int, nodes: DataFrame) -> DifferingRanges:
    """Few ranges that hold all nodes: each step joins the nodes under one parent."""
    spans = nodes.where(F.col(NODE).isNotNull()).select(
        F.col(NODE).alias("up"), F.col(NODE).alias("first"), F.col(NODE).alias("last")
    )
    exact = True
    while (rows := spans.limit(MAX_RANGES + 1).collect()) and len(rows) > MAX_RANGES:
        exact = False
        spans = spans.groupBy(F.shiftright("up", 3).alias("up")).agg(
            F.min("first").alias("first"), F.max("last").alias("last")
        )
    ranges: list[tuple[int, int]] = []
    for lo, hi in sorted((r["first"], r["last"]) for r in rows):
        if ranges and ranges[-1][1] + 1 == lo:
            ranges[-1] = (ranges[-1][0], hi)
        else:
            ranges.append((lo, hi))
    null_keys = not nodes.where(F.col(NODE).isNull()).isEmpty()
    return DifferingRanges(key, bits, nodes, tuple(ranges), null_keys, exact)


def _column(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def _node(key: str, bits: int) -> Column:
    return F.shiftright(_column(key).cast("long"), bits)


def _hashed(name: str, kind: object) -> list[Column]:
    """What the hash reads of a column. It skips nulls, so they are named."""
    column = _column(name)
    if isinstance(kind, (ArrayType, StructType, MapType, VariantType)):
        return [F.to_json(F.struct(column), {"ignoreNullFields": "false"})]
    return [column.isNull(), column]


def _any(tests: Sequence[Column]) -> Column:
    """Their disjunction as a tree of little depth."""
    tests = list(tests)
    while len(tests) > 1:
        tests = [reduce(lambda a, b: a | b, tests[i : i + 2]) for i in range(0, len(tests), 2)]
    return tests[0]
