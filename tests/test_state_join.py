"""The streaming join on typed state."""

from __future__ import annotations

import datetime as dt
import decimal
import random

import pytest
from pyspark.sql import functions as F

from rowtide.storage import new_folder
from rowtide.streaming import state_join
from rowtide.streaming.options import rocksdb_state
from rowtide.streaming.state_join import temporal_join_state

FACTS = "id string, seq bigint, amount decimal(20,3), at timestamp"
DIMS = "id string, seq bigint, big bigint, tags array<string>"
NOON = dt.datetime(2024, 5, 1, 12)


def run(spark, folder, facts, dims, **options):
    """One restarted run per element; all rows joined so far."""
    for fact_rows, dim_rows in zip(facts, dims):
        for name, rows, schema in (("facts", fact_rows, FACTS), ("dims", dim_rows, DIMS)):
            spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
        sides = [spark.readStream.schema(s).parquet(f"{folder}/{n}") for n, s in (("facts", FACTS), ("dims", DIMS))]
        joined = temporal_join_state(*sides, "id", "seq", **options)
        writer = joined.writeStream.format("parquet").option("path", f"{folder}/out")
        with rocksdb_state(spark):
            query = writer.option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
        query.awaitTermination()
    return spark.read.schema(joined.schema).parquet(f"{folder}/out")


def expected(facts, dims, initial=(), left=False):
    out, state = [], {d[0]: d for d in initial}
    for fact_rows, dim_rows in zip(facts, dims):
        both = [(d[1], 0, d) for d in dim_rows if d[0] is not None] + [(f[1], 1, f) for f in fact_rows]
        for _, side, row in sorted(both, key=lambda r: r[:2]):
            if side == 0:
                state[row[0]] = row
            elif row[0] in state or left:
                out.append((*row, *state.get(row[0], (None,) * 4)))
    return sorted(map(repr, out))


def fact(key, seq):
    return (key, seq, decimal.Decimal(seq).scaleb(-3), NOON + dt.timedelta(microseconds=seq))


def dim(key, seq):
    return (key, seq, 2**60 + seq, [f"t{seq}", None])


@pytest.mark.parametrize("how, spread", [("inner", 1), ("left", 3)])
def test_state_join_from_a_snapshot_over_restarts(spark, how, spread):
    rng = random.Random(spread)
    keys = ["a", "b", "c", None]
    initial = [dim("a", -5), dim("z", -4)]
    facts, dims, seq = [], [], 0
    for _ in range(3):
        rows = [(rng.choice(keys), seq + i, rng.random() < 0.6) for i in range(40)]
        facts.append([fact(k, s) for k, s, is_fact in rows if is_fact])
        dims.append([dim(k, s) for k, s, is_fact in rows if not is_fact] + [dim("a", seq + 3)][: spread - 1])
        seq += 40
    folder = new_folder(spark, "state")
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    known = spark.createDataFrame([*initial, dim(None, -1)], DIMS)
    got = run(spark, folder, facts, dims, initial=known, how=how, spread=spread)
    assert got.columns == ["id", "seq", "amount", "at", "id0", "seq0", "big", "tags"]
    # Tags of two dimension rows at one moment are equal here, so either may win.
    assert sorted(repr(tuple(r)) for r in got.collect()) == expected(facts, dims, initial, how == "left")
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_facts_of_a_hot_key_wait_on_disk(spark):
    facts = [[fact("hot", i) for i in range(9_000)]]
    dims = [[dim("hot", i) for i in range(500, 9_000, 1_000)]]
    folder = new_folder(spark, "state")
    got = run(spark, folder, facts, dims, initial=spark.createDataFrame([dim("hot", -1)], DIMS), held_facts=10)
    assert got.count() == 9_000
    wrong = got.where(
        F.col("seq0") != F.when(F.col("seq") < 500, -1).otherwise(F.floor((F.col("seq") - 500) / 1000) * 1000 + 500)
    )
    assert wrong.count() == 0


def test_state_join_of_nothing_and_bad_options(spark):
    folder = new_folder(spark, "state")
    assert run(spark, folder, [[]], [[dim("a", 1)]]).collect() == []
    rows = spark.createDataFrame([], FACTS)
    with pytest.raises(ValueError):
        temporal_join_state(rows, rows, "id", "seq", how="right")
    with pytest.raises(ValueError):
        temporal_join_state(rows, rows, "id", "seq", spread=0)


def test_many_keys_share_few_groups(spark, monkeypatch):
    monkeypatch.setattr(state_join, "BUCKETS", 3)
    keys = [f"k{i}" for i in range(40)]
    fact = lambda seq, k: (k, seq, decimal.Decimal("1.000"), NOON)
    initial = [(k, 0, i, ["x"]) for i, k in enumerate(keys)]
    facts = [[fact(10 + i, k) for i, k in enumerate(keys)], [fact(200 + i, k) for i, k in enumerate(keys)]]
    dims = [[(k, 10, -i, None) for i, k in enumerate(keys) if i % 2], [(k, 200, 5, []) for k in keys[:3]]]
    folder = new_folder(spark, "many")
    start = spark.createDataFrame(initial, DIMS)
    got = run(spark, folder, facts, dims, initial=start, spread=2)
    big = {k: -i if i % 2 else i for i, k in enumerate(keys)}
    want = [(10 + i, k, big[k]) for i, k in enumerate(keys)]
    want += [(200 + i, k, 5 if i < 3 else big[k]) for i, k in enumerate(keys)]
    assert sorted((r.seq, r.id, r.big) for r in got.collect()) == sorted(want)
    stored = spark.read.format("statestore").option("stateVarName", "newest").load(f"{folder}/cp")
    assert stored.select("key").distinct().count() <= 6
