"""Differences found through digests against those of a whole comparison."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from rowtide import diff_changes, diff_in_ranges, differing_ranges, range_digests, row_count_changes
from rowtide.operators import digest_diff

SCHEMA = "k bigint, a string, b double, c array<int>, `odd name` int"


def rows(seed, keys):
    rng = random.Random(seed)
    return [
        (k, rng.choice(["x", "", None]), rng.choice([1.0, float("nan"), None]), rng.choice([[1, None], [None, 1]]), k % 3)
        for k in keys
    ]


def changed(old, seed):
    rng = random.Random(seed)
    new = [(k, "new", *rest) if rng.random() < 0.02 else (k, a, *rest) for k, a, *rest in old if rng.random() > 0.02]
    return new + [(10_000 + n * 977, None, None, None, None) for n in range(5)]


@pytest.mark.parametrize("cover", [3, 64])
def test_same_as_comparing_everything(spark, monkeypatch, cover):
    monkeypatch.setattr(digest_diff, "MAX_RANGES", cover)
    old = rows(1, [*range(-300, 900, 2), -(2**63), 2**63 - 1])
    sides = [spark.createDataFrame(r, SCHEMA) for r in (old, changed(old, 2))]
    want = diff_changes(*sides, ["k"]).collect()
    assert len(want) > 10
    got = diff_in_ranges(*sides, ["k"], bits=(8, 3)).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    stored = range_digests(sides[0], "k", 8)
    again = diff_in_ranges(*sides, ["k"], bits=(8, 3), old_digests=stored).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, want))


def test_only_changed_ranges_are_read(spark, tmp_path):
    old = spark.range(100_000).selectExpr("id k", "id % 7 v")
    new = old.selectExpr("k", "if(k = 70001, -1L, v) v")
    paths = [str(tmp_path / n) for n in ("old", "new")]
    for df, path in zip((old, new), paths):
        df.write.parquet(path)
    sides = [spark.read.parquet(p) for p in paths]
    where = differing_ranges(*sides, "k", (12, 6))
    assert where.exact and where.ranges == ((70001 >> 6, 70001 >> 6),)
    got = diff_in_ranges(*sides, ["k"], bits=(12, 6))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("GreaterThanOrEqual(k,69952)") == 2 and plan.count("LessThanOrEqual(k,70015)") == 2
    assert [(r.k, r.op) for r in got.collect()] == [(70001, "u")]


def test_equal_tables_and_swapped_nulls(spark):
    df = spark.createDataFrame([(1, None, 2), (None, 3, None)], "k int, a int, b int")
    assert differing_ranges(df, df.orderBy("a"), "k", (4,)).of(df).isEmpty()
    other = spark.createDataFrame([(1, 2, None), (None, 3, None)], "k int, a int, b int")
    assert [r.k for r in differing_ranges(df, other, "k", (4,)).of(df).collect()] == [1]
    nulls = spark.createDataFrame([(1, None, 2), (None, 4, None)], "k int, a int, b int")
    assert [r.k for r in differing_ranges(df, nulls, "k", (4,)).of(df).collect()] == [None]
    empty = df.limit(0)
    assert differing_ranges(empty, empty, "k").of(df).isEmpty()
    assert differing_ranges(empty, df, "k").of(df).count() == 2


def test_row_counts_equal_a_count(spark):
    rng = random.Random(5)
    sides = [[(rng.choice([1, 2, None]), rng.choice(["a", None])) for _ in range(n)] for n in (60, 75)]
    want = Counter(sides[1])
    want.subtract(Counter(sides[0]))
    got = row_count_changes(*[spark.createDataFrame(s, "k int, v string") for s in sides]).collect()
    assert {(r.k, r.v): r.copies for r in got} == {k: n for k, n in want.items() if n}


def test_wrong_input(spark):
    df = spark.createDataFrame([("a", 1)], "k string, copies int")
    with pytest.raises(ValueError):
        range_digests(df, "k")
    with pytest.raises(ValueError):
        row_count_changes(df, df)
    with pytest.raises(ValueError):
        differing_ranges(df, df, "k", (4, 4))
    assert row_count_changes(df, df, copies="more").isEmpty()
