import pytest

from rowtide import apply_changes, diff_changes, encode_changes, parse_envelope, start_changes

SCHEMA = "k int, a string, b double"
OLD = [(1, "x", 1.0), (2, "y", None), (3, "z", 3.0), (4, None, None)]
NEW = [(1, "x", 1.0), (2, "y", 2.0), (4, None, None), (5, "n", float("nan"))]


def test_differences(spark):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    got = {r.k: (r.op, r.before and tuple(r.before), r.after and tuple(r.after)[:2])
           for r in diff_changes(old, new, ["k"]).collect()}
    assert got == {
        2: ("u", (2, "y", None), (2, "y")),
        3: ("d", (3, "z", 3.0), None),
        5: ("c", None, (5, "n")),
    }


def test_applying_differences_gives_the_new_version(spark):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    after = apply_changes(old, diff_changes(old, new, ["k"]), ["k"])
    assert sorted(map(str, after.collect())) == sorted(map(str, new.collect()))
    assert diff_changes(new, after, ["k"]).isEmpty()


def test_same_version_has_no_differences(spark):
    df = spark.createDataFrame(NEW, SCHEMA)
    assert diff_changes(df, df, ["k"]).isEmpty()
    with pytest.raises(ValueError):
        diff_changes(df, df.drop("b"), ["k"])


def test_differences_join_once_on_the_key(spark):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    plan = diff_changes(old, new, ["k"])._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "Cartesian" not in plan


def test_encoded_differences(spark):
    old, new = (spark.createDataFrame(r, SCHEMA) for r in (OLD, NEW))
    events = encode_changes(diff_changes(old, new, ["k"]), "d", "t")
    rows = {r.after.k: r.op for r in parse_envelope(events, ["k"], before=True).collect()}
    assert rows == {"2": "u", "3": "d", "5": "c"}


def test_start_position(spark):
    log = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "seq int, value string")
    snapshot = spark.createDataFrame([(0, "s")], "seq int, value string")
    values = lambda df: sorted(r.value for r in df.collect())
    assert values(start_changes(snapshot, log)) == ["a", "b", "c", "s"]
    assert values(start_changes(None, log, "initial")) == ["a", "b", "c"]
    assert values(start_changes(snapshot, log, "latest", at=2)) == ["c"]
    for bad in ("Latest", "earliest", ""):
        with pytest.raises(ValueError):
            start_changes(snapshot, log, bad, at=1)
    with pytest.raises(ValueError):
        start_changes(snapshot, log, "latest")
