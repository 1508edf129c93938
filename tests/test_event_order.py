"""Tombstones and stored versions, against the result of all events at once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rowtide import TableSpec, ensure_table
from rowtide.operators.temporal import as_of
from rowtide.sinks.event_order import buried, drop_tombstones, upsert_in_event_order
from rowtide.sinks.version_table import VersionSpec, stored_versions, update_versions
from rowtide.storage import new_folder

EVENT = "id string, name string, t string, deleted boolean, day string"


def target(folder, **options):
    run = folder.rsplit("-", 1)[1]
    return TableSpec(f"order_{run}", f"{folder}/t", ("id", "name", "t"), "t", partition_by=("day",), **options)


def content(spark, spec):
    return sorted(tuple(r) for r in spark.table(spec.name).select("id", "name", "t").collect())


@pytest.mark.parametrize("seed, buckets", [(1, 0), (2, 3)])
def test_any_batch_order_gives_the_event_order(spark, seed, buckets):
    rng = random.Random(seed)
    events = [
        (f"k{rng.randrange(9)}", f"n{i}", f"{i:03}", rng.random() < 0.4, f"d{rng.randrange(3)}") for i in range(60)
    ]
    last = {}
    for e in events:
        last[e[0]] = e
    want = sorted(e[:3] for e in last.values() if not e[3])
    rng.shuffle(events)
    folder = new_folder(spark, "order")
    spec = target(folder, buckets=buckets)
    ensure_table(spark, spec)
    for at in range(0, 60, 20):
        batch = spark.createDataFrame(events[at : at + 20] + [(None, "no key", "999", False, "d0"), ("k1", "no time", None, False, "d0")], EVENT)
        upsert_in_event_order(spec, batch)
        upsert_in_event_order(spec, batch)
    assert content(spark, spec) == want
    upsert_in_event_order(spec, spark.createDataFrame([], EVENT))
    assert content(spark, spec) == want


def test_retention_of_tombstones(spark):
    folder = new_folder(spark, "order")
    spec = target(folder)
    ensure_table(spark, spec)
    rows = lambda *events: spark.createDataFrame(list(events), EVENT)
    upsert_in_event_order(spec, rows(("a", "x", "10", False, "d"), ("a", None, "20", True, "d"), ("b", None, "30", True, "d")))
    # A delete wins over a change of its own moment, before or after it.
    upsert_in_event_order(spec, rows(("a", "late", "15", False, "d"), ("b", "same moment", "30", False, "d")))
    assert content(spark, spec) == [] and sorted(r.id for r in buried(spark, spec).collect()) == ["a", "b"]
    drop_tombstones(spark, spec, "25")
    assert [r.id for r in buried(spark, spec).collect()] == ["b"]
    upsert_in_event_order(spec, rows(("a", "too late", "16", False, "d"), ("a", "new", "26", False, "d")), keep_after="25")
    upsert_in_event_order(spec, rows(("b", "again", "31", False, "e")), keep_after="25")
    assert content(spark, spec) == [("a", "new", "26"), ("b", "again", "31")]
    with pytest.raises(ValueError):
        upsert_in_event_order(target(folder, key_scope="partition"), rows())


def versions(rows):
    newest = {}
    for id_, name, t in rows:
        if id_ is not None and t is not None:
            newest[id_, t] = name
    out = []
    for (id_, t), name in newest.items():
        later = [u for i, u in newest if i == id_ and u > t]
        out.append((id_, name, t, t, min(later) if later else None))
    return sorted(map(repr, out))


ROW = "id string, name string, t string"


def version_spec(folder):
    return VersionSpec(f"v_{folder.rsplit('-', 1)[1]}", f"{folder}/v", ("id", "name", "t"), ("id",), "t", parts=3)


def test_late_rows_split_stored_versions(spark):
    rng = random.Random(4)
    spec = version_spec(new_folder(spark, "versions"))
    done = []
    for _ in range(4):
        batch = [
            (rng.choice(["a", "b", "c", None]), f"n{rng.random()}", f"2024-{rng.randint(1, 6):02}-{rng.randint(1, 9):02}")
            for _ in range(12)
        ]
        batch = list({(r[0], r[2]): r for r in batch}.values()) + [("a", "no time", None)]
        for _ in range(2):
            update_versions(spark, spec, spark.createDataFrame(batch, ROW))
        done += batch
        assert sorted(repr(tuple(r)) for r in stored_versions(spark, spec).collect()) == versions(done)
    at = as_of(stored_versions(spark, spec), "2024-04-01")
    assert at.groupBy("id").count().where("count > 1").count() == 0


def test_only_changed_partitions_are_rewritten(spark):
    spec = version_spec(new_folder(spark, "versions"))
    rows = [(k, f"{k}{m}", f"2024-{m:02}-05") for k in "abcdef" for m in range(1, 7)]
    update_versions(spark, spec, spark.createDataFrame(rows, ROW))

    def files():
        of = spark.table(spec.name).select("key_part", "period", F.input_file_name().alias("f")).distinct()
        return {(r.key_part, r.period): r.f for r in of.collect()}

    before = files()
    update_versions(spark, spec, spark.createDataFrame([("a", "late", "2024-03-20")], ROW))
    after = files()
    part = spark.table(spec.name).where("id = 'a'").first().key_part
    assert {p for p in after if after[p] != before.get(p)} == {(part, "2024-03")}
    update_versions(spark, spec, spark.createDataFrame([("a", "late", "2024-03-20")], ROW))
    assert files() == after
    got = spark.table(spec.name).where("id = 'a' AND period = '2024-03'").orderBy("valid_from")
    assert [(r.name, r.valid_to) for r in got.collect()] == [("a3", "2024-03-20"), ("late", "2024-04-05")]
