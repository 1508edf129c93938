import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from rowtide import as_of, temporal_join, versioned
from rowtide.operators import hot_keys
from rowtide.operators.temporal import joined_names

FACT = "id string, t int, f int"
DIM = "id string, t int, tie int, name string"


def expected(facts, dims, how):
    out = []
    for key, t, f in facts:
        known = [d for d in dims if d[0] == key and key is not None and d[1] is not None
                 and t is not None and d[1] <= t]
        if known:
            out.append((f, *max(known, key=lambda d: (d[1], d[2]))))
        elif how == "left":
            out.append((f, None, None, None, None))
    return sorted(out, key=str)


def got(spark, facts, dims, how, limit):
    joined = temporal_join(
        spark.createDataFrame(facts, FACT), spark.createDataFrame(dims, DIM), "id", "t", "tie", how, limit
    )
    assert joined.columns == ["id", "t", "f", "id0", "t0", "tie", "name"]
    return sorted((tuple(r)[2:] for r in joined.collect()), key=str)


def case(name):
    rng = random.Random(name)
    if name == "even":
        facts = [(str(rng.randrange(9)), rng.randrange(40), i) for i in range(150)]
        dims = [(str(rng.randrange(9)), rng.randrange(40), i, f"d{i}") for i in range(60)]
    elif name == "hot":
        key = lambda: "h" if rng.random() < 0.8 else str(rng.randrange(5))
        facts = [(key(), rng.randrange(400), i) for i in range(500)]
        dims = [(key(), rng.randrange(400), i, f"d{i}") for i in range(300)]
    elif name == "one_time":  # a third of all facts at one moment of one key
        facts = [("h", 50, i) for i in range(300)] + [("h", rng.randrange(100), i) for i in range(300, 500)]
        dims = [("h", rng.randrange(100), i, f"d{i}") for i in range(60)]
    elif name == "one_dim_time":
        facts = [("h", rng.randrange(100), i) for i in range(100)]
        dims = [("h", 50, i, f"d{i}") for i in range(300)] + [("h", 20, 1, "early"), ("x", 1, 1, "x")]
    elif name == "copies":
        facts = [("h", 50, 7)] * 300 + [("h", 10, 8)] * 100 + [("g", 1, 1)]
        dims = [("h", 9, 1, "a"), ("h", 50, 1, "b"), ("h", 51, 1, "c")] + [("g", 1, 1, "same")]
    elif name == "no_dims":
        facts = [("h", i % 50, i) for i in range(200)]
        dims = [("other", 1, 1, "x")]
    else:
        facts = [(None, 1, 1), ("a", None, 2), ("a", 0, 3), ("a", 1, 4), ("b", 5, 5)] + [(None, 3, 9)] * 40
        dims = [(None, 0, 1, "n"), ("a", None, 1, "t"), ("a", 1, 1, "x"), ("a", 1, 2, "y"), ("a", 2, 1, None), ("b", 5, 1, None)]
    return facts, dims


@pytest.mark.parametrize("name", ["even", "hot", "one_time", "one_dim_time", "copies", "no_dims", "nulls"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_join_equals_brute_force(spark, name, how):
    facts, dims = case(name)
    want = expected(facts, dims, how)
    assert got(spark, facts, dims, how, None) == want
    assert got(spark, facts, dims, how, 20) == want


@pytest.mark.parametrize("name", ["even", "hot", "one_dim_time", "nulls"])
def test_versions_equal_brute_force(spark, name):
    dims = case(name)[1]
    df = spark.createDataFrame(dims, DIM)
    last = {}
    for d in dims:
        if d[1] is not None and (d[:2] not in last or d[2] > last[d[:2]][2]):
            last[d[:2]] = d
    want = []
    for key, t in last:
        later = [u for k, u in last if k == key and u > t]
        want.append((*last[key, t], t, min(later) if later else None))
    for limit in (None, 20):
        rows = versioned(df, "id", "t", "tie", max_group_rows=limit)
        assert sorted(map(tuple, rows.collect()), key=str) == sorted(want, key=str)


def test_a_hot_key_is_cut_evenly(spark):
    from pyspark.sql import functions as F

    rows = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").alias("t"),
    )
    bounds = hot_keys.hot_key_bounds(rows, ["k"], F.struct("t"), 500)
    assert [r.k for r in bounds.rows.collect()] == ["hot"] and bounds.spread == 14
    chunk = hot_keys.chunk_of(F.struct("t"), F.col("bounds"), bounds.longest)
    sizes = (
        hot_keys.with_bounds(rows, bounds, ["k"]).where("k = 'hot'")
        .groupBy(chunk.alias("c")).count().collect()
    )
    assert len(sizes) >= 10 and max(r["count"] for r in sizes) < 2_000
    assert hot_keys.hot_key_bounds(rows, ["k"], F.struct("t"), 10_000) is None


def test_hot_null_keys_are_cut_too(spark):
    df = spark.range(300).selectExpr("if(id % 2 = 0, null, id % 5) AS k", "pmod(hash(id), 200) AS t", "id AS tie")
    whole, cut = (versioned(df, "k", "t", "tie", max_group_rows=n) for n in (None, 20))
    assert hot_keys.hot_key_bounds(df, ["k"], F.struct("t"), 20).rows.where("k IS NULL").count() == 1
    assert sorted(map(tuple, cut.collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)


def test_chunk_is_the_number_of_bounds_at_or_below(spark):
    from pyspark.sql import functions as F

    bounds = sorted(random.Random(5).sample(range(1000), 137))
    df = spark.range(-1, 1001).withColumn("bounds", F.array(*[F.lit(b) for b in bounds]))
    for r in df.select("id", hot_keys.chunk_of(F.col("id"), F.col("bounds"), 137).alias("c")).collect():
        assert r.c == sum(b <= r.id for b in bounds)
    assert df.select(hot_keys.chunk_of(F.col("id"), F.lit(None).cast("array<int>"), 0).alias("c")).first().c == 0


def test_join_is_one_shuffle_and_no_pairs(spark):
    facts, dims = case("even")
    df = temporal_join(
        spark.createDataFrame(facts, FACT), spark.createDataFrame(dims, DIM), "id", "t", "tie", max_group_rows=None
    )
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert "Join" not in plan and "Cartesian" not in plan


def test_several_keys_and_timestamps(spark):
    at = lambda m: dt.datetime(2024, 1, 1, 0, m)
    facts = spark.createDataFrame([("a", 1, at(5)), ("a", 2, at(5))], "k1 string, k2 int, ts timestamp")
    dims = spark.createDataFrame([("a", 1, at(4), "x"), ("a", 1, at(6), "y")], "k1 string, k2 int, ts timestamp, v string")
    rows = temporal_join(facts, dims, ["k1", "k2"], "ts").collect()
    assert [(r.k2, r.v, r.ts0) for r in rows] == [(1, "x", at(4))]
    with pytest.raises(ValueError):
        temporal_join(facts, dims, "k1", "ts", how="outer")


def test_names_that_clash_get_a_suffix():
    assert joined_names(["id", "name", "proc_time"], ["id", "name", "create_time", "proc_time"]) == [
        "id0", "name0", "create_time", "proc_time0"]
    assert joined_names(["id", "id0"], ["id"]) == ["id00"]


def test_as_of(spark):
    df = spark.createDataFrame([("a", 1, 0, "x"), ("a", 5, 0, "y"), ("b", 3, 0, "z")], DIM)
    versions = versioned(df, "id", "t", "tie", max_group_rows=None)
    at = lambda t: sorted(r.name for r in as_of(versions, t).collect())
    assert (at(0), at(1), at(4), at(5), at(99)) == ([], ["x"], ["x", "z"], ["y", "z"], ["y", "z"])
