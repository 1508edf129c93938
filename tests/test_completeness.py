"""Missing and repeated offsets against a walk over the sorted offsets."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from rowtide.operators.completeness import offset_faults


@pytest.mark.parametrize("block", [1, 7, 1_000_000])
def test_faults_equal_a_walk(spark, block):
    rng = random.Random(block)
    rows = [(p, o) for p in ("a", "b", None) for o in range(-30, 90) if rng.random() < 0.7]
    rows += rng.choices(rows, k=25) + [("b", 500), ("a", None), ("single", 4)]
    want = []
    for p in {r[0] for r in rows}:
        seen = Counter(o for q, o in rows if q == p and o is not None)
        at = sorted(seen)
        want += [(p, "missing", a + 1, b - 1, 0) for a, b in zip(at, at[1:]) if b - a > 1]
        want += [(p, "repeated", o, o, n) for o, n in seen.items() if n > 1]
    log = spark.createDataFrame(rows, "partition string, offset int")
    got = offset_faults(log, ["partition"], "offset", block)
    assert sorted(map(repr, map(tuple, got.collect()))) == sorted(map(repr, want))


def test_no_rows_no_faults(spark):
    assert offset_faults(spark.createDataFrame([], "p int, o bigint"), ["p"], "o").collect() == []
