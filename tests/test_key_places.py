"""Upserts by places against the same upserts without, and what they read."""

from __future__ import annotations

import random
import uuid
from dataclasses import replace
from urllib.parse import unquote, urlparse

import pytest

from rowtide import TableSpec, ensure_table, locate_keys, upsert_by_place, upsert_table
from rowtide.sinks.key_places import places_of

SCHEMA = "id string, v string, at string, part string, gone boolean"


def spec_in(tmp_path, rule="incoming"):
    name = f"placed_{uuid.uuid4().hex[:10]}"
    return TableSpec(name, str(tmp_path / name), ("id", "v", "at"), "at", partition_by=("part",), rule=rule)


def batch(spark, seed, n=40):
    rng = random.Random(seed)
    rows = [
        (rng.choice([None, *map(str, range(25))]), f"{seed}-{i}", f"{rng.randrange(50):03d}-{seed}-{i}",
         rng.choice(["a", "b", "c", None, ""]), rng.random() < 0.2)
        for i in range(n)
    ]
    return spark.createDataFrame(rows, SCHEMA)


@pytest.mark.parametrize("rule", ["incoming", "greatest"])
def test_same_table_and_true_places(spark, tmp_path, rule):
    placed, plain = spec_in(tmp_path, rule), spec_in(tmp_path, rule)
    for spec in (placed, plain):
        ensure_table(spark, spec)
    for seed in (1, 2, 2, 3):  # one batch comes twice
        upsert_by_place(placed, batch(spark, seed), deleted="gone", buckets=4)
        upsert_table(plain, batch(spark, seed), deleted="gone")
    rows = [sorted(map(tuple, spark.table(s.name).collect())) for s in (placed, plain)]
    assert rows[0] == rows[1] and rows[0]
    known = spark.table(places_of(placed).name).select("id", "part").collect()
    assert sorted(map(tuple, known)) == sorted((r[0], r[3]) for r in rows[0])


def test_other_partitions_are_not_read(spark, tmp_path):
    spec = spec_in(tmp_path)
    ensure_table(spark, spec)
    start = spark.createDataFrame([(str(i), "v", "1", "abcd"[i % 4], False) for i in range(80)], SCHEMA)
    upsert_table(spec, start)
    locate_keys(spark, spec, buckets=8)
    for name in spark.table(spec.name).inputFiles():
        path = unquote(urlparse(name).path)
        if "part=c" in path or "part=d" in path:
            with open(path, "wb") as file:  # a read of these would fail
                file.write(b"damaged")
    moved = spark.createDataFrame([("4", "new", "2", "b", False), ("1", "x", "2", "b", True)], SCHEMA)
    upsert_by_place(spec, moved, deleted="gone", buckets=8)
    rows = {r.id: (r.v, r.part) for r in spark.table(spec.name).where("part in ('a', 'b')").collect()}
    assert rows["4"] == ("new", "b") and "1" not in rows and len(rows) == 39
    places = spark.table(places_of(spec).name).where("id in ('1', '4')").collect()
    assert [(r.id, r.part) for r in places] == [("4", "b")]


def test_tables_that_need_no_places(tmp_path):
    for other in ({"buckets": 4}, {"key_scope": "partition"}, {"partition_by": ("id",)}, {"partition_by": ()}):
        with pytest.raises(ValueError):
            places_of(replace(spec_in(tmp_path), **other))
