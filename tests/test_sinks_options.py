from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rowtide import (
    JobOptions,
    jdbc_options,
    kafka_sink_options,
    kafka_source_options,
    to_kafka_columns,
    with_parallelism,
    with_partition_key,
)
from rowtide.plans.jobs import capture_table, capture_to_shards, capture_to_topic
from rowtide.streaming.options import REQUIRED


def test_message_columns(spark):
    df = spark.createDataFrame([("1", "wörld")], "id string, value string")
    assert to_kafka_columns(df).columns == ["value"]
    row = to_kafka_columns(df, F.col("id")).first()
    assert (bytes(row.key), bytes(row.value).decode("utf-8")) == (b"1", "wörld")


def test_partition_keys(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 3)], "id string, n int")
    assert [r.partition_key for r in with_partition_key(df, ["id", "n"]).collect()] == ["a.1", "a.2", ".3"]
    one = with_partition_key(df, constant="0", partitions=4)
    assert {r.partition_key for r in one.collect()} == {"0"}
    assert one.select(F.spark_partition_id()).distinct().count() == 1
    with pytest.raises(ValueError):
        with_partition_key(df)
    with pytest.raises(ValueError):
        with_partition_key(df, ["id"], constant="0")


def test_parallelism(spark):
    assert with_parallelism(spark.range(10), 3).rdd.getNumPartitions() == 3
    mixed = spark.range(100).selectExpr("id % 7 AS k", "pmod(hash(id), 1000) AS seq").repartition(5)
    sent = with_parallelism(mixed, 3, F.col("k"), "seq").select("k", "seq", F.spark_partition_id().alias("p")).collect()
    for k in range(7):
        own = [(r.p, r.seq) for r in sent if r.k == k]
        assert len({p for p, _ in own}) == 1 and own == sorted(own)
    with pytest.raises(ValueError):
        with_parallelism(mixed, 3, seq="seq")
    with pytest.raises(ValueError):
        with_parallelism(spark.range(10), 0)


def test_a_writers_tasks_grow_with_the_log(spark, monkeypatch):
    """A quarter of the log went through one task, however long the log."""
    from rowtide.plans.jobs import run_capture

    monkeypatch.setattr("rowtide.sinks.messages.ROWS_PER_TASK", 50)
    options = JobOptions(db_list="d", table_list="d.t", parallel=4)
    for n, tasks in ((150, 4), (2000, 40)):
        log = spark.range(n).selectExpr(
            "id AS seq",
            """concat('{"source":{"db":"d","table":"t"},"op":"c","after":{"id":"', id % 1000, '","n":"', id, '"}}') AS value""",
        )
        key = F.regexp_extract("value", '"id":"([^"]*)"', 1)
        sent = run_capture(options, log, key=key)
        assert sent.rdd.getNumPartitions() == tasks
        rows = sent.selectExpr("string(key) AS k", """regexp_extract(string(value), '"n":"([0-9]+)"', 1) AS n""")
        rows = rows.withColumn("t", F.spark_partition_id()).collect()
        assert sorted(int(r.n) for r in rows) == list(range(n))
        share, order = Counter(r.t for r in rows), defaultdict(list)
        for r in rows:
            order[r.k].append((r.t, int(r.n)))
        assert max(share.values()) <= 100 and all(v == sorted(v) for v in order.values())
        assert all(len({t for t, _ in v}) == 1 for v in order.values())
    writer = lambda df: {r.k: r.t % 4 for r in df.select("k", F.spark_partition_id().alias("t")).collect()}
    keys = spark.range(1000).withColumnRenamed("id", "k")
    assert writer(with_parallelism(keys, 4, F.col("k"))) == writer(with_parallelism(keys, 4, F.col("k"), rows=1000))


def test_console_prints_new_rows(spark, tmp_path):
    from rowtide import console, read_lines

    (tmp_path / "a.txt").write_text("one\n")
    query = console(read_lines(spark, str(tmp_path), streaming=True), "shown").trigger(availableNow=True).start()
    query.awaitTermination(60)
    assert query.exception() is None and query.name == "shown"


def test_capture_jobs(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    new = spark.createDataFrame([(1, "a"), (2, "c")], "k int, v string")
    assert capture_table(None, old, ["k"], "d", "t").count() == 2
    events = capture_table(old, new, ["k"], "d", "t")
    assert events.count() == 1
    assert capture_to_topic(events, 2).columns == ["value"]
    assert capture_to_shards(events, 2, constant="0").first().partition_key == "0"


def test_source_and_sink_options():
    options = kafka_source_options("b:9092", "t", "g", "initial", 500)
    assert options["startingOffsets"] == "earliest" and options["maxOffsetsPerTrigger"] == "500"
    assert options["kafka.group.id"] == "g"
    assert kafka_source_options("b:9092", "t")["startingOffsets"] == "latest"
    with pytest.raises(ValueError):
        kafka_source_options("b", "t", position="earliest")
    assert kafka_sink_options("b:9092", "t")["topic"] == "t"
    jdbc = jdbc_options("jdbc:x", "t", "u", "p", partition_column="id", lower=0, upper=9, partitions=3)
    assert jdbc["numPartitions"] == "3"


VALUES = {
    "checkpoint_dir": "/c", "brokers": "b:1", "sink_topic": "t", "source_topic": "s", "group_id": "g",
    "host": "h:1", "username": "u", "password": "secret", "db_list": "d", "table_list": "d.t",
    "stream_name": "n", "stream_region": "r",
}


@pytest.mark.parametrize("job", REQUIRED)
def test_required_options(job):
    full = {n: VALUES[n] for n in REQUIRED[job]}
    assert JobOptions.for_job(job, **full).checkpoint_interval == 60
    for name in full:
        with pytest.raises(ValueError, match=name):
            JobOptions.for_job(job, **{**full, name: ""})


def test_option_checks():
    options = JobOptions(checkpoint_interval=300, password="secret")
    assert options.trigger == {"processingTime": "300 seconds"}
    assert "secret" not in repr(options)
    for bad in ({"position": "Latest"}, {"parallel": 0}, {"checkpoint_interval": 0}):
        with pytest.raises(ValueError):
            JobOptions(**bad)
    with pytest.raises(ValueError):
        JobOptions.for_job("topic_to_tables", nonsense=1)
    with pytest.raises(ValueError):
        JobOptions.for_job("unknown")
