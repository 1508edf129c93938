import json
import os
import random
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from rowtide import (
    JobOptions,
    TableSpec,
    changes_from_events,
    fan_out,
    read_changes,
    read_lines,
    rocksdb_state,
    temporal_join,
    temporal_join_stream,
    use_rocksdb_state,
)
from rowtide.plans import jobs
from rowtide.plans.jobs import (
    lines_with_dimension,
    run_capture,
    run_join,
    run_tables,
    topic_to_tables,
    topic_with_dimension,
)
from rowtide.plans.queries import PRECOMBINE, ROUTES
from rowtide.storage import new_folder
from rowtide.streaming import temporal

NOW = {"availableNow": True}


def write(spark, folder, rows, schema="seq BIGINT, value STRING"):
    spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder, schema="seq BIGINT, value STRING", **options):
    return read_changes(spark, folder, format="parquet", schema=schema, streaming=True, options=options)


def change(after, table="test_tb_01", db="cdc_test_db", **more):
    return json.dumps({"after": after, "source": {"db": db, "table": table}, **more})


def specs_in(folder, **options):
    run = folder.rsplit("-", 1)[1]
    return {
        r.dest: TableSpec(f"{r.dest}_{run}", f"{folder}/{r.dest}", r.columns, PRECOMBINE[r.dest], **options)
        for r in ROUTES
    }


def stored(spark, spec, *columns):
    return sorted(tuple(r) for r in spark.table(spec.name).select(*columns).collect())


def test_read_changes_checks_columns(spark, tmp_path):
    (tmp_path / "a.txt").write_text('{"x":1}\nline two\n')
    assert [r.value for r in read_lines(spark, str(tmp_path)).collect()] == ['{"x":1}', "line two"]
    assert read_lines(spark, str(tmp_path), streaming=True).isStreaming
    write(spark, str(tmp_path / "p"), [(1, "x")])
    with pytest.raises(ValueError):
        read_changes(spark, str(tmp_path / "p"), format="parquet", schema="seq BIGINT")


def test_tables_restart_rejects_and_null_keys(spark):
    folder = new_folder(spark, "job")
    specs = specs_in(folder)
    run = lambda: topic_to_tables(
        stream(spark, f"{folder}/log"), ROUTES, specs, f"{folder}/cp", order=["seq"],
        dead_letters=f"{folder}/dead", trigger=NOW,
    ).awaitTermination()
    write(spark, f"{folder}/log", [
        (1, change({"id": "1", "name": "a", "modify_time": "1"})),
        (2, change({"id": "1", "name": "b", "modify_time": "2"}, table="test_tb_02")),
        (3, change({"id": "2", "name": "a"}, table="test_tb_no_time")),
        (4, change({"name": "no key"})),
        (5, "garbage"),
        (6, change({"id": "1"}, db="elsewhere")),
    ])
    query = topic_to_tables(
        stream(spark, f"{folder}/log"), ROUTES, specs, f"{folder}/cp", order=["seq"],
        dead_letters=f"{folder}/dead", trigger=NOW,
    )
    query.awaitTermination()
    counts = query.lastProgress.observedMetrics["not_stored"]
    assert (counts.unrouted, counts.rejected) == (1, 2)
    write(spark, f"{folder}/log", [
        (7, change({"id": "1", "name": "late", "modify_time": "0"})),
        (8, change({"id": "2", "name": "b"}, table="test_tb_no_time")),
        (9, change({"id": "2", "name": "ab"}, table="test_tb_no_time")),
    ])
    run()
    run()
    # The second batch replaces the stored row although its time is older.
    assert stored(spark, specs["test_tb_union"], "id", "name") == [("1", "late")]
    assert stored(spark, specs["test_tb_no_time"], "id", "name") == [("2", "b")]
    dead = spark.read.parquet(f"{folder}/dead")
    assert sorted((r.kind, r.reject_reason) for r in dead.collect()) == [
        ("reject", "malformed"), ("reject", "null_key"), ("unrouted", None)]


def test_deletes_in_the_stream(spark):
    folder = new_folder(spark, "job")
    specs = specs_in(folder, buckets=2)
    write(spark, f"{folder}/log", [
        (1, change({"id": "1", "name": "a", "modify_time": "1"})),
        (2, change({"id": "2", "name": "a", "modify_time": "1"})),
    ])
    run = lambda: topic_to_tables(
        stream(spark, f"{folder}/log"), ROUTES, specs, f"{folder}/cp", order=["seq"], deletes="apply", trigger=NOW
    ).awaitTermination()
    run()
    write(spark, f"{folder}/log", [
        (3, change(None, op="d", before={"id": "1", "name": "a", "modify_time": "1"}))])
    run()
    assert stored(spark, specs["test_tb_union"], "id") == [("2",)]


def test_stream_equals_one_batch_when_late_rows_lose(spark, sf_dir):
    folder = new_folder(spark, "job")
    specs = specs_in(folder, rule="greatest")
    log = changes_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    for part in log.randomSplit([1.0, 1.0, 1.0], seed=4):
        part.coalesce(1).write.mode("append").parquet(f"{folder}/log")
    topic_to_tables(
        stream(spark, f"{folder}/log", maxFilesPerTrigger="1"), ROUTES, specs, f"{folder}/cp", order=["seq"], trigger=NOW
    ).awaitTermination()
    # The same rows whatever the batches were: the latest per id.
    assert [spark.table(specs[r.dest].name).count() for r in ROUTES] == [8, 4, 3]
    from rowtide.plans.queries import latest_union

    assert stored(spark, specs["test_tb_union"], "id", "name") == sorted(
        (r.id, r.name) for r in latest_union(spark, sf_dir).collect())


def test_replayed_batch_keeps_its_stamp_and_is_adaptive(spark):
    folder = new_folder(spark, "fan")
    write(spark, f"{folder}/log", [(1, "a"), (2, "b")])
    seen, adaptive, fail = [], [], [True]

    def writer(rows, batch_id):
        adaptive.append(rows.sparkSession.conf.get("spark.sql.adaptive.enabled"))
        seen.append((batch_id, sorted((r.value, r.at) for r in rows.collect())))
        if fail:
            fail.pop()
            raise RuntimeError("lost")

    def run():
        rows = stream(spark, f"{folder}/log").withColumn("at", F.current_timestamp()).withColumn("dest", F.lit("x"))
        return fan_out(rows, {"x": writer, "y": lambda rows, _: seen.append(rows.count())}, f"{folder}/cp", trigger=NOW)

    with pytest.raises(Exception):
        run().awaitTermination()
    run().awaitTermination()
    batches = [s for s in seen if isinstance(s, tuple)]
    assert len(batches) == 2 and batches[0] == batches[1]
    assert set(adaptive) == {"true"}


def run_parts(spark, folder, build, parts):
    """Feed (facts, dims) parts one after the other, restarting in between."""
    out = []
    for facts, dims in parts:
        for name, rows in (("facts", facts), ("dims", dims)):
            write(spark, f"{folder}/{name}", rows)
        query = (
            build(stream(spark, f"{folder}/facts"), stream(spark, f"{folder}/dims"))
            .writeStream.format("parquet").option("path", f"{folder}/out")
            .option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def as_rows(df):
    return df.select(
        F.get_json_object("value", "$.id").alias("id"), F.get_json_object("value", "$.n").cast("long").alias("n"),
        F.get_json_object("value", "$.t").cast("timestamp").alias("t"), "seq")


def item(seq, key, n=None, t=None):
    return (seq, json.dumps({"id": key, "n": n, "t": t}))


@pytest.mark.parametrize("spread", [1, 3])
@pytest.mark.parametrize("rocksdb", [False, True])
def test_stream_join(spark, spread, rocksdb):
    setting = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(setting)
    if rocksdb:
        use_rocksdb_state(spark)
    big = 2**60 + 1
    parts = [
        ([item(1, "a", 1), item(5, "a", 2), item(5, "b", 3), item(9, None, 4)],
         [item(2, "a", big, "2024-01-01 00:00:00.123456"), item(5, "a", None), item(6, "b", 8), item(1, None, 9)]),
        ([item(10, "a", 5), item(10, "b", 6), item(14, "b", None)], [item(12, "b", 7)]),
        ([item(20, "a", 7)], [item(19, "c", 1)]),
    ]
    try:
        got = run_parts(
            spark, new_folder(spark, "join"),
            lambda f, d: temporal_join_stream(as_rows(f), as_rows(d), "id", "seq", spread=spread), parts,
        )
    finally:
        spark.conf.set(setting, before)
    assert got.columns == ["id", "n", "t", "seq", "id0", "n0", "t0", "seq0"]
    assert sorted((r.seq, r.id, r.n, r.n0, r.seq0) for r in got.collect()) == [
        (5, "a", 2, None, 5), (10, "a", 5, None, 5), (10, "b", 6, 8, 6), (14, "b", None, 7, 12), (20, "a", 7, None, 5)]


def test_many_keys_share_few_groups(spark, monkeypatch):
    monkeypatch.setattr(temporal, "BUCKETS", 3)
    monkeypatch.setattr(temporal, "SLICE", 4)
    monkeypatch.setattr(temporal, "PACKED", 5)
    folder, keys = new_folder(spark, "many"), [f"k{i}" for i in range(40)]
    parts = [
        ([item(2 * i + 1, k, i) for i, k in enumerate(keys)], [item(2 * i, k, -i) for i, k in enumerate(keys)]),
        ([item(100 + i, k, i) for i, k in enumerate(keys)], [item(100 + i, k, 7) for i, k in enumerate(keys) if i % 2]),
    ]
    for facts, dims in parts:
        for name, rows in (("facts", facts), ("dims", dims)):
            write(spark, f"{folder}/{name}", rows)
        sides = [as_rows(stream(spark, f"{folder}/{n}")) for n in ("facts", "dims")]
        joined = temporal_join_stream(*sides, "id", "seq")
        query = (
            joined.writeStream.format("parquet").option("path", f"{folder}/joined")
            .option("checkpointLocation", f"{folder}/checkpoint").trigger(availableNow=True).start()
        )
        query.awaitTermination()
        assert query.lastProgress.stateOperators[0].numRowsTotal <= 3
    got = spark.read.schema(joined.schema).parquet(f"{folder}/joined")
    first = {(2 * i + 1, k, -i) for i, k in enumerate(keys)}
    second = {(100 + i, k, 7 if i % 2 else -i) for i, k in enumerate(keys)}
    assert sorted((r.seq, r.id, r.n0) for r in got.collect()) == sorted(first | second)


def test_values_keep_their_type(spark):
    big = 2**60 + 1
    got = run_parts(
        spark, new_folder(spark, "join"),
        lambda f, d: temporal_join_stream(as_rows(f), as_rows(d), "id", "seq"),
        [([item(3, "a", None)], [item(2, "a", big, "2024-01-01 00:00:00.123456")])],
    ).first()
    assert (got.n, got.n0, str(got.t0)) == (None, big, "2024-01-01 00:00:00.123456")


def test_left_stream_join_keeps_unmatched(spark):
    got = run_parts(
        spark, new_folder(spark, "join"),
        lambda f, d: temporal_join_stream(as_rows(f), as_rows(d), "id", "seq", how="left"),
        [([item(1, "a"), item(3, "a"), item(1, None)], [item(2, "a", 5)])],
    )
    assert {(r.seq, r.id, r.n0) for r in got.collect()} == {(1, "a", None), (3, "a", 5), (1, None, None)}
    assert got.count() == 3


def test_state_expires(spark):
    folder = new_folder(spark, "ttl")
    write(spark, f"{folder}/facts", [item(1, "a")])
    write(spark, f"{folder}/dims", [item(0, "a", 5)])
    joined = temporal_join_stream(
        *(as_rows(stream(spark, f"{folder}/{n}")) for n in ("facts", "dims")),
        "id", "seq", how="left", state_ttl_ms=1,
    )
    query = (
        joined.writeStream.format("parquet").option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/cp").trigger(processingTime="1 second").start()
    )
    rows = lambda: spark.read.schema(joined.schema).parquet(f"{folder}/out").collect()

    def wait_for(done):
        deadline = time.time() + 40
        while not done() and time.time() < deadline and query.isActive:
            time.sleep(0.5)
        assert done()

    kept = lambda: sum(o.numRowsTotal for p in query.recentProgress[-1:] for o in p.stateOperators)
    try:
        wait_for(lambda: query.recentProgress and os.path.isdir(f"{folder}/out") and len(rows()) == 1)
        wait_for(lambda: query.lastProgress.batchId > 0 and kept() == 0)
        write(spark, f"{folder}/facts", [item(2, "a")])
        wait_for(lambda: len(rows()) == 2)
    finally:
        query.stop()
    assert sorted((r.seq, r.n0) for r in rows()) == [(1, 5), (2, None)]


def test_stream_join_equals_the_batch_join(spark):
    rng = random.Random(8)
    key = lambda: "hot" if rng.random() < 0.5 else str(rng.randrange(6))
    numbers = rng.sample(range(10_000), 240)  # no sequence number on both sides
    facts = sorted(item(n, key(), n) for n in numbers[:150])
    dims = sorted(item(n, key(), -n) for n in numbers[150:])
    cuts = [0, 2_500, 6_000, 10_000]
    inside = lambda rows, i: [r for r in rows if cuts[i] <= r[0] < cuts[i + 1]]
    got = run_parts(
        spark, new_folder(spark, "join"),
        lambda f, d: temporal_join_stream(as_rows(f), as_rows(d), "id", "seq", spread=2),
        [(inside(facts, i), inside(dims, i)) for i in range(3)],
    )
    frames = [as_rows(spark.createDataFrame(r, "seq BIGINT, value STRING")) for r in (facts, dims)]
    want = temporal_join(*frames, "id", "seq", max_group_rows=10)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect()))


def test_topic_with_dimension_and_sentinel(spark):
    fact = lambda seq, key: (seq, json.dumps({"id": key, "name": f"f{seq}"}))
    facts = [fact(3, "1"), fact(3, "null"), (3, "bad")]
    dims = [(1, change({"id": "1", "name": "a"})), (2, change({"id": "9"}, table="other"))]
    run = lambda **o: sorted(
        (r.name, r.name0) for r in run_parts(
            spark, new_folder(spark, "join"),
            lambda f, d: topic_with_dimension(f, d, db="cdc_test_db", table="test_tb_01", seq="seq", **o),
            [(facts, dims)],
        ).collect())
    assert run() == [("f3", "a")]
    assert run(unmatched="sentinel") == [("f3", "a"), ("f3", "null")]


def test_lines_with_dimension(spark):
    got = run_parts(
        spark, new_folder(spark, "lines"), lambda f, d: lines_with_dimension(f, d, "seq"),
        [([(1, "a,early"), (3, "a,x,extra"), (4, "short")], [(2, "a,dim"), (2, "b,")])],
    )
    assert got.columns == ["seq", "id", "name", "seq0", "id0", "name0"]
    assert [tuple(r) for r in got.collect()] == [(3, "a", "x", 2, "a", "dim")]


def test_bad_arguments(spark):
    df = spark.readStream.format("rate").load().select(F.lit("a").alias("id"), F.col("value").alias("seq"))
    with pytest.raises(ValueError):
        temporal_join_stream(df, df, "id", "seq", how="full")
    with pytest.raises(ValueError):
        temporal_join_stream(df, df, "id", "seq", spread=0)


def test_options_reach_the_queries(spark):
    folder = new_folder(spark, "options")
    options = JobOptions(checkpoint_dir=f"{folder}/cp", name="named", once=True, db_list="d", table_list="d.t", parallel=3)
    log = spark.createDataFrame([(i, change({"id": "1"}, t, "d")) for i, t in enumerate("tuttu")], "seq BIGINT, value STRING")
    sent = run_capture(options, log, key=F.lit("k"))
    assert sent.columns == ["key", "value"] and sent.count() == 3 and sent.rdd.getNumPartitions() == 3
    with pytest.raises(ValueError):
        run_capture(JobOptions(position="latest", db_list="d", table_list="d.t"), log)
    write(spark, f"{folder}/log", [(1, change({"id": "1"}))])
    query = run_tables(options, stream(spark, f"{folder}/log"), ROUTES, specs_in(folder))
    query.awaitTermination()
    assert query.name == "named" and os.path.exists(f"{folder}/cp/offsets/0")
    provider = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(provider)
    rows = stream(spark, f"{folder}/log").selectExpr("'a' AS id", "seq")
    during = []

    def sink(writer):
        during.append(spark.conf.get(provider))
        return writer.format("noop")

    query = run_join(JobOptions(checkpoint_dir=f"{folder}/cp2", once=True, name="join"), rows, sink)
    query.awaitTermination()
    # The query's own session has the setting, the caller's never kept it.
    assert query.name == "join" and spark.conf.get(provider) == before == during[0]
    with rocksdb_state(spark):
        assert "RocksDB" in spark.conf.get(provider)
    assert spark.conf.get(provider) == before


def test_texts_of_large_chunks_are_held_compressed():
    texts = pd.Series([json.dumps({"c0": str(i % 3), "c1": "click", "c2": i}) for i in range(10_000)] + [None])
    packed = temporal._packed(texts)
    assert len(packed) < sum(map(len, texts[:-1])) / 3
    assert temporal._unpacked(packed).to_pylist() == texts[:-1].tolist() + [None]


def test_batches_keep_only_what_writers_read(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(jobs, "fan_out", lambda rows, *a, **k: seen.append(rows.columns))
    folder = new_folder(spark, "columns")
    write(spark, f"{folder}/log", [(1, change({"id": "1"}))])
    for letters in (None, f"{folder}/letters"):
        topic_to_tables(
            stream(spark, f"{folder}/log"), ROUTES, specs_in(folder), f"{folder}/cp", order=["seq"], dead_letters=letters
        )
    assert seen[0] == ["dest", "table", "op", "after", "seq", "logday", "hh"]
    assert {"value", "reject_reason"} <= set(seen[1])
