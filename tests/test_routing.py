import json

import pytest
from pyspark.errors import PySparkException

from rowtide import (
    Route,
    changes_from_events,
    dim_rows,
    include_tables,
    rejected_rows,
    route_changes,
    routed_rows,
    unrouted_rows,
)
from rowtide.operators.routing import reject_null_keys
from rowtide.plans.jobs import select_changes
from rowtide.plans.queries import ROUTES

PAIR = Route("db", ("t1", "t2"), "both", ("id", "name"))
WIDE = Route("db", ("t3",), "wide", ("id", "extra"))
OTHER = Route("db2", ("t1",), "other", ("id",))


def change(after, db="db", table="t1", **more):
    return json.dumps({"after": after, "source": {"db": db, "table": table}, **more})


def outcome(spark, text, **options):
    df = spark.createDataFrame([(text,)], "value string")
    row = route_changes(df, [PAIR, WIDE, OTHER], **options).first()
    return row.dest, row.reject_reason


@pytest.mark.parametrize(
    "text, dest, reason",
    [
        (change({"id": 1}), "both", None),
        (change({"id": 1}, table="t2"), "both", None),
        (change({}), "both", None),
        (change({"id": 1}, table="t3"), "wide", None),
        (change({"id": 1}, db="db2"), "other", None),
        (change({"id": 1}, db="db2", table="t2"), "_reject", "table_unmatched"),
        (change({"id": 1}, table="T1"), "_reject", "table_unmatched"),
        (change({"id": 1}, db="DB"), "_unrouted", None),
        (change({"id": 1}, db="nobody"), "_unrouted", None),
        (change(None, db="nobody"), "_reject", "after_null"),
        (change(None, op="d"), "_reject", "after_null"),
        ("oops", "_reject", "malformed"),
        (json.dumps({"after": {"id": 1}}), "_reject", "source_missing"),
        (change({"id": {"a": 1}}), "_reject", "projection"),
        (change({"id": [1]}), "_reject", "projection"),
        (change({"id": 1, "extra": [1]}), "both", None),
        (change({"id": 1, "extra": [1]}, table="t3"), "_reject", "projection"),
        (change({"id": {"a": 1}}, db="nobody"), "_unrouted", None),
        (change({"id": {"a": 1}}, table="unknown"), "_reject", "table_unmatched"),
    ],
)
def test_outcomes(spark, text, dest, reason):
    assert outcome(spark, text) == (dest, reason)


def test_operation_is_not_consulted(spark):
    for op in ("r", "c", "u", "whatever"):
        assert outcome(spark, change({"id": 1}, op=op)) == ("both", None)


def test_deletes_by_before_image(spark):
    text = change(None, op="d", before={"id": 4})
    assert outcome(spark, text, deletes="apply") == ("both", None)
    assert outcome(spark, change(None, op="d"), deletes="apply") == ("_reject", "after_null")
    assert outcome(spark, change(None, op="d", before={"id": 4}, db="x"), deletes="apply") == (
        "_unrouted",
        None,
    )
    with pytest.raises(ValueError):
        outcome(spark, text, deletes="maybe")


def test_conflicting_routes():
    df = None
    with pytest.raises(ValueError):
        route_changes(df, [PAIR, Route("db", ("t2",), "again", ("id",))])
    with pytest.raises(ValueError):
        route_changes(df, [Route("db", ("t",), "_reject", ("id",))])


def test_every_row_has_one_destination(spark, sf_dir):
    log = changes_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
    routed = route_changes(log, ROUTES)
    counts = {(r.dest, r.reject_reason): r["count"] for r in routed.groupBy("dest", "reject_reason").count().collect()}
    assert counts == {
        ("_reject", "malformed"): 20,
        ("_reject", "after_null"): 199,
        ("_unrouted", None): 84,
        ("_reject", "table_unmatched"): 77,
        ("test_tb_union", None): 310,
        ("test_tb_no_time", None): 183,
        ("dev_tb_01", None): 127,
    }
    parts = sum(routed_rows(routed, r).count() for r in ROUTES)
    assert parts + unrouted_rows(routed).count() + rejected_rows(routed).count() == log.count()


def test_unrouted_keeps_the_text(spark):
    text = change({"id": 1}, db="nobody")
    df = spark.createDataFrame([(text,)], "value string")
    assert unrouted_rows(route_changes(df, [PAIR])).first().value == text


def test_shard_column(spark):
    route = Route("db", ("t1", "t2"), "both", ("id",), shard_column="shard")
    df = spark.createDataFrame([(change({"id": 1}),), (change({"id": 1}, table="t2"),)], "value string")
    rows = routed_rows(route_changes(df, [route]), route).collect()
    assert sorted(tuple(r) for r in rows) == [("t1", "1"), ("t2", "1")]


def test_null_keys_become_rejects(spark):
    df = spark.createDataFrame([(change({}),), (change({"id": 1}),)], "value string")
    routed = reject_null_keys(route_changes(df, [PAIR]), [PAIR], {"both": ("id",)})
    assert sorted((r.dest, r.reject_reason) for r in routed.collect()) == [
        ("_reject", "null_key"),
        ("both", None),
    ]


def test_include_lists(spark):
    df = spark.createDataFrame([("db1", "tb"), ("db1", "tx"), ("DB2", "TBB"), ("db3", "t")], "db string, table string")
    names = lambda d, t: sorted((r.db, r.table) for r in include_tables(df, d, t).collect())
    assert names("db1,db2", "db1.*,db2.tb*") == [("DB2", "TBB"), ("db1", "tb"), ("db1", "tx")]
    assert names("db.", "db1.tb*,db3.tb*") == [("db1", "tb"), ("db3", "t")]
    assert names("db", "db1.*") == []  # matched whole
    assert names(["db1"], ["db1xtb", "db1.t[a-b]"]) == [("db1", "tb")]
    with pytest.raises(ValueError):
        include_tables(df, " , ", "x")


def test_select_changes_returns_the_text(spark):
    texts = [change({"id": 1}), change({"id": 1}, db="x"), change(None, op="d")]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    assert {r.value for r in select_changes(df, "db", "db.t1").collect()} == {texts[0], texts[2]}


def test_dimension_rows(spark):
    texts = [change({"id": 1, "name": "a"}), change({"id": 2}, table="t2"), change(None), "bad", change({"id": [1]})]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, value string")
    rows = lambda **o: sorted(tuple(r) for r in dim_rows(df, "db", "t1", ["id", "name"], keep=["seq"], **o).collect())
    assert rows() == [(0, "1", "a")]
    assert rows(unmatched="sentinel") == [(0, "1", "a"), (1, "null", "null")]
    with pytest.raises(PySparkException):
        rows(errors="fail")
    clean = df.where("seq < 2")
    got = dim_rows(clean, "db", "t1", ["id"], unmatched="sentinel", errors="fail").collect()
    assert sorted(r.id for r in got) == ["1", "null"]
