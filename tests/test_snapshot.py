"""Snapshots in key ranges while a log runs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from rowtide.operators.snapshot import (
    KeyRange,
    key_ranges,
    range_number,
    reconciled,
    snapshot_in_ranges,
    snapshot_marks,
    snapshot_rows,
)
from rowtide.operators.upsert import latest_per_key
from rowtide.storage import new_folder


def held(df, key, ranges):
    return [df.where(r.holds(F.col(key))).count() for r in ranges]


def test_ranges_are_even_for_uneven_values(spark):
    # A quarter of the rows lie in the first thousandth of the span.
    keys = spark.range(40_000).select((F.pow(F.col("id"), 3) % 10**12).cast("long").alias("k"))
    ranges = key_ranges(keys, "k", 8)
    counts = held(keys, "k", ranges)
    assert len(ranges) == 8 and sum(counts) == 40_000
    assert max(counts) <= 1.5 * 40_000 / 8
    text = spark.range(8_000).select(F.concat(F.lit("é'"), F.sqrt("id").cast("string")).alias("k"))
    ranges = key_ranges(text, "k", 5)
    counts = held(text, "k", ranges)
    assert counts == [text.where(r.predicate("k")).count() for r in ranges]
    assert sum(counts) == 8_000 and max(counts) <= 1.5 * 8_000 / 5
    at = Counter(r.n for r in text.select(range_number(F.col("k"), ranges).alias("n")).collect())
    assert [at[r.number] for r in ranges] == counts


def test_ranges_of_few_equal_or_null_keys(spark):
    rows = spark.createDataFrame([(None,), (None,), (5,), (5,), (7,)], "k int")
    ranges = key_ranges(rows, "k", 4)
    assert sum(held(rows, "k", ranges)) == 5
    assert sum(rows.where(r.predicate("k")).count() for r in ranges) == 5
    assert key_ranges(rows.where("k is null"), "k", 4) == [KeyRange(0)]
    assert KeyRange(0).predicate("k") == "1 = 1"
    with pytest.raises(TypeError):
        KeyRange(0, upper=object()).predicate("k")
    with pytest.raises(ValueError):
        key_ranges(rows, "k", 0)


class Source:
    """A table of key and value, and the log that changes it, one change per tick."""

    def __init__(self, spark, seed):
        rng = random.Random(seed)
        self.spark = spark
        self.first = {k: f"old{k}" for k in range(0, 60, 2)}
        self.log = [(rng.randrange(64), f"new{s}", s, rng.random() < 0.3) for s in range(1, 301)]
        self.now = 0
        self.step = rng.choice([1, 7, 20])

    def position(self):
        self.now += self.step
        return self.now

    def state(self, moment):
        rows = dict(self.first)
        for key, value, seq, gone in self.log:
            if seq <= moment:
                rows.pop(key, None) if gone else rows.update({key: value})
        return rows

    def read(self, part):
        rows = list(self.state(self.position()).items())
        return self.spark.createDataFrame(rows, "id int, name string").where(part.holds(F.col("id")))

    def changes(self):
        return self.spark.createDataFrame(self.log, "id int, name string, seq bigint, gone boolean")


@pytest.mark.parametrize("seed, parts", [(1, 1), (2, 4), (3, 9)])
def test_snapshot_stopped_and_resumed_equals_the_final_state(spark, seed, parts):
    source, folder = Source(spark, seed), new_folder(spark, "snapshot")
    first = spark.createDataFrame(list(source.first.items()), "id int, name string")
    ranges = key_ranges(first, "id", parts)
    assert snapshot_marks(spark, folder).count() == 0
    assert snapshot_rows(spark, folder, "id INT, name STRING").count() == 0

    def result():
        rows = snapshot_rows(spark, folder, "id INT, name STRING").withColumn("gone", F.lit(False))
        whole = reconciled(rows, snapshot_marks(spark, folder), source.changes(), ranges, ["id"])
        kept = latest_per_key(whole, ["id"], ["seq"]).where(~F.col("gone"))
        return {r.id: r.name for r in kept.collect()}

    failing = [True]

    def read(part):
        rows = source.read(part)
        if failing[0] and part.number == len(ranges) // 2:
            failing[0] = False
            # A read that fails after its rows were written.
            rows.write.mode("overwrite").parquet(f"{folder}/rows/range={part.number}")
            raise OSError("lost")
        return rows

    with pytest.raises(OSError):
        snapshot_in_ranges(spark, ranges, read, source.position, folder)
    done = {r.number for r in snapshot_marks(spark, folder).collect()}
    final = source.state(300)
    finished = [r for r in ranges if r.number in done]
    inside = lambda k: any((r.lower is None or k >= r.lower) and (r.upper is None or k < r.upper) for r in finished)
    assert result() == {k: v for k, v in final.items() if inside(k)}
    assert snapshot_in_ranges(spark, ranges, read, source.position, folder, at_most=2) == max(0, len(ranges) - len(done) - 2)
    assert snapshot_in_ranges(spark, ranges, read, source.position, folder) == 0
    assert result() == final
    before = source.now
    assert snapshot_in_ranges(spark, ranges, read, source.position, folder) == 0 and source.now == before


def test_change_between_marks_overrides_what_was_read(spark):
    rows = spark.createDataFrame([(1, "read", False, 0), (2, "read", False, 0), (None, "read", False, 0)],
                                 "id int, name string, gone boolean, range int")
    marks = spark.createDataFrame([(0, 10, 20)], "number int, low bigint, high bigint")
    log = spark.createDataFrame(
        [(1, "in the read already", False, 9), (1, "between", False, 15), (2, "after", False, 25),
         (3, "at the low mark", False, 10), (9, "range not read", False, 30), (None, "no key", False, 12)],
        "id int, name string, gone boolean, seq bigint")
    got = reconciled(rows, marks, log, [KeyRange(0, None, 5), KeyRange(1, 5, None)], ["id"])
    assert sorted(got.collect(), key=repr) == sorted(
        [(2, "read", False, 10), (None, "read", False, 10), (1, "between", False, 15), (2, "after", False, 25),
         (None, "no key", False, 12)], key=repr)
