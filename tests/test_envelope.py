import base64
import json
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from rowtide import (
    encode_changes,
    generic_rows,
    parse_envelope,
    parse_pairs,
    parse_rows,
    project_after,
    snapshot_changes,
    to_envelope,
)

COLUMNS = ["id", "name"]


def envelope(after, db="d", table="t", **more):
    return json.dumps({"after": after, "source": {"db": db, "table": table}, **more})


def decode(spark, text, **options):
    df = spark.createDataFrame([(text,)], "value string")
    return parse_envelope(df, COLUMNS, **options).first()


@pytest.mark.parametrize(
    "text, error",
    [
        (None, "malformed"),
        ("", "malformed"),
        ("garbage", "malformed"),
        ("[1]", "malformed"),
        ("null", "malformed"),
        ('{"source":{"db":"d","table":"t"},"after":{"id":"1"}', "malformed"),
        ("{}", "source_missing"),
        ('{"after":{"id":"1"}}', "source_missing"),
        ('{"source":{"table":"t"},"after":{}}', "source_missing"),
        ('{"source":{"db":"d"},"after":{}}', "source_missing"),
        ('{"source":{"db":null,"table":"t"},"after":{}}', "source_missing"),
        ('{"source":{"db":{"x":1},"table":"t"},"after":{}}', "source_missing"),
        ('{"source":{"db":"d","table":"t"}}', "after_null"),
        ('{"source":{"db":"d","table":"t"},"after":null}', "after_null"),
        ('{"source":{"db":"d","table":"t"},"after":"x"}', "after_null"),
        ('{"source":{"db":"d","table":"t"},"after":{}}', None),
        ('{"source":{"db":5,"table":"t"},"after":{"id":"1"}}', None),
        ('{"source":{"db":"d","table":"t"},"after":{"id":"1"}} trailing', None),
        ("{'source':{db:'d',table:'t'},after:{id:1}}", None),
    ],
)
def test_parse_errors(spark, text, error):
    assert decode(spark, text).parse_error == error


@pytest.mark.parametrize(
    "field, text",
    [
        ('"x"', "x"),
        ("null", None),
        ("7", "7"),
        ("true", "true"),
        ("1.10", "1.1"),
        ("12345678901234567890.10", "12345678901234567890.1"),
        ("12345678.5", "12345678.5"),
        ("0.1234567890123456789", "0.1234567890123456789"),
        ("12345678901234567890", "12345678901234567890"),
        ('"1E5"', "1E5"),
        ('"{not json"', "{not json"),
        ('"[1]"', "[1]"),
        ('"  spaced "', "  spaced "),
        ('"\\u00fc\\n"', "ü\n"),
    ],
)
def test_field_text(spark, field, text):
    row = decode(spark, '{"source":{"db":"d","table":"t"},"after":{"id":%s}}' % field)
    assert row.after.id == text
    assert row.parse_error is None and not row.nested


@pytest.mark.parametrize("field", ['{"a":1}', "[1,2]", "{}", "[]"])
def test_nested_field_is_marked(spark, field):
    row = decode(spark, '{"source":{"db":"d","table":"t"},"after":{"id":%s,"name":"{"}}' % field)
    assert row.nested == ["id"]


def test_nested_field_with_repeated_names(spark):
    row = decode(spark, '{"source":{"db":"d","table":"t"},"after":{"id":{"a":1,"a":2},"name":"x"}}')
    assert row.nested == ["id"]


def test_last_duplicate_and_unknown_fields(spark):
    row = decode(
        spark,
        '{"source":{"db":"a","table":"t"},"source":{"db":"d","table":"t"},'
        '"after":{"id":1,"id":2,"other":{"q":1,"q":2}}}',
    )
    assert (row.db, row.after.id, row.after.name, row.nested) == ("d", "2", None, None)


def test_before_image_of_a_delete(spark):
    text = json.dumps(
        {"before": {"id": 3, "name": "x"}, "after": None, "op": "d", "source": {"db": "d", "table": "t"}}
    )
    row = decode(spark, text, before=True)
    assert (row.after.id, row.op, row.parse_error) == ("3", "d", None)
    assert decode(spark, text).parse_error == "after_null"
    assert decode(spark, text.replace('"d", "source"', '"u", "source"'), before=True).parse_error == (
        "after_null"
    )


def test_encode_then_decode_is_identity_on_text(spark):
    rows = [("1", 'quote " and \\'), ("2", None), (None, "ü,{}\n"), ("{", "[x")]
    df = spark.createDataFrame(rows, "id string, name string")
    parsed = parse_envelope(snapshot_changes(df, "d", "t"), COLUMNS)
    assert sorted(project_after(parsed, COLUMNS).collect(), key=str) == sorted(df.collect(), key=str)
    assert {(r.db, r.table, r.op) for r in parsed.collect()} == {("d", "t", "r")}


def test_nulls_stay_in_the_text(spark):
    df = spark.createDataFrame([("1", None)], "id string, name string")
    kept = to_envelope(df, columns=COLUMNS, db="d", table="t", op="d", ts_ms=F.lit(9), keep=["id"])
    row = kept.first()
    assert row.id == "1"
    assert json.loads(row.value) == {
        "before": {"id": "1", "name": None},
        "after": None,
        "source": {"db": "d", "table": "t"},
        "op": "d",
        "ts_ms": 9,
    }


NUMBERS = ["0.00", "0.01", "-0.01", "1.27", "1.28", "-1.28", "-1.29", "123.45", "-327.68", "92233720368547.75"]


@pytest.mark.parametrize(
    "kind, numbers",
    [
        ("decimal(16,2)", NUMBERS),
        ("decimal(38,2)", [*NUMBERS, "9" * 36 + ".99", "-" + "9" * 36 + ".99", str(2**63) + ".00",
                           str(2**64) + ".00", "-184467440737095516.16", "-184467440737095516.17"]),
    ],
)
def test_decimal_modes(spark, kind, numbers):
    df = spark.createDataFrame([(Decimal(n),) for n in numbers], f"id {kind}")
    text = project_after(parse_envelope(snapshot_changes(df, "d", "t"), ["id"]), ["id"])
    assert [r.id for r in text.collect()] == numbers
    precise = snapshot_changes(df, "d", "t", decimal_mode="precise")
    got = [r.id for r in project_after(parse_envelope(precise, ["id"]), ["id"]).collect()]

    def shortest(n):
        u = int(Decimal(n).scaleb(2).to_integral_value())
        size = 1
        while not -(1 << (8 * size - 1)) <= u < 1 << (8 * size - 1):
            size += 1
        return base64.b64encode(u.to_bytes(size, "big", signed=True)).decode()

    import decimal

    with decimal.localcontext() as context:
        context.prec = 60
        assert got == [shortest(n) for n in numbers]


def test_known_decimal_bytes_and_bad_mode(spark):
    df = spark.createDataFrame([(Decimal("123.45"),)], "id decimal(10,2)")
    value = snapshot_changes(df, "d", "t", decimal_mode="precise").first().value
    assert json.loads(value)["after"]["id"] == "MDk="
    with pytest.raises(ValueError):
        snapshot_changes(df, "d", "t", decimal_mode="double")


def test_decimals_in_differences(spark):
    df = spark.createDataFrame(
        [(1, "u", (Decimal("1.10"),), (Decimal("2.00"),)), (2, "d", (Decimal("3.00"),), None)],
        "k int, op string, before struct<p: decimal(9,2)>, after struct<p: decimal(9,2)>",
    )
    texts = [json.loads(r.value) for r in encode_changes(df, "d", "t", keep=["k"]).orderBy("k").collect()]
    assert [t["before"] for t in texts] == [{"p": "1.10"}, {"p": "3.00"}]
    assert [t["after"] for t in texts] == [{"p": "2.00"}, None]


def test_generic_rows(spark):
    texts = [
        envelope({"id": 1, "name": "a", "deep": {"x": [1]}, "none": None}),
        '{"source":{"db":"d","table":"t"},"after":{"id":1,"id":2,"b":true}}',
        envelope(None),
        "garbage",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "seq int, value string")
    rows = {r.seq: r for r in generic_rows(df, keep=["seq"]).collect()}
    assert set(rows) == {0, 1}
    assert rows[0].fields == {"id": "1", "name": "a", "deep": '{"x":[1]}', "none": None}
    assert rows[1].fields == {"id": "2", "b": "true"}


def test_flat_rows(spark):
    df = spark.createDataFrame([('{"id":"1","name":"n","x":2}',), ("bad",), ('{"id":5}',)], "value string")
    assert [tuple(r) for r in parse_rows(df, COLUMNS).collect()] == [("1", "n"), (None, None), ("5", None)]


def test_pairs(spark):
    lines = ["a,b", "a,b,c", "a", "a,", ",b", "", " a , b ", "a,,c", "a,,", None]
    df = spark.createDataFrame([(t,) for t in lines], "value string")
    got = [tuple(r) for r in parse_pairs(df).collect()]
    bad = (None, None, "malformed")
    assert got == [
        ("a", "b", None), ("a", "b", None), bad, bad, ("", "b", None), bad,
        (" a ", " b ", None), ("a", "", None), bad, bad,
    ]
    good = df.where("value = 'a,b'")
    assert parse_pairs(good, errors="fail").first().name == "b"
    with pytest.raises(PySparkException):
        parse_pairs(df, errors="fail").select("id").collect()


def test_flat_rows_reject_or_fail(spark):
    texts = ['{"id":"1","name":"n"}', "bad", '{"id":"1"', None, "{}"]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    rows = parse_rows(df, COLUMNS, errors="reject").collect()
    assert [r.parse_error for r in rows] == [None, "malformed", "malformed", "malformed", None]
    assert [r[0] for r in rows] == ["1", None, None, None, None]
    assert parse_rows(df.where("value = '{}'"), COLUMNS, errors="fail").count() == 1
    with pytest.raises(PySparkException):
        parse_rows(df, COLUMNS, errors="fail").collect()
    with pytest.raises(ValueError):
        parse_rows(df, COLUMNS, errors="skip")


def test_names_that_look_nested_are_judged_by_their_type(spark):
    texts = [json.dumps({"source": {"db": db, "table": "t"}, "after": {"id": "1"}}) for db in ("[x", {"a": 1}, "d")]
    df = spark.createDataFrame([(t,) for t in texts], "value string")
    parsed = parse_envelope(df, ["id"]).collect()
    assert [(r.db, r.parse_error) for r in parsed] == [("[x", None), (None, "source_missing"), ("d", None)]
    assert [r.db for r in generic_rows(df).collect()] == ["[x", "d"]
