"""Change envelopes as JSON text: encode, decode, project by name.

An envelope is one JSON object per row change::

    {"before": {...}|null, "after": {...}|null,
     "source": {"db": "...", "table": "..."}, "op": "r|c|u|d", "ts_ms": 0}

Only ``source.db``, ``source.table`` and ``after`` are needed to decode.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .decimals import encode_decimal

# Fixed values of the change-event format.
OP_READ, OP_CREATE, OP_UPDATE, OP_DELETE = "r", "c", "u", "d"

MALFORMED = "malformed"
SOURCE_MISSING = "source_missing"
AFTER_NULL = "after_null"

LENIENT_JSON = {"allowSingleQuotes": "true", "allowUnquotedFieldNames": "true"}
CORRUPT = "_corrupt"
FIELD_GAP = "\x01"
# A field that starts like an object or array, or is a fraction that needs an
# exponent or more digits than a double holds.
INEXACT_TEXT = FIELD_GAP + r"(?:[{\[]|-?\d+\.\d+E|-?(?=[\d.]{17})\d+\.\d)"


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def envelope_text(
    *,
    before: Column,
    after: Column,
    db: Column,
    table: Column,
    op: Column,
    ts_ms: Column | None = None,
) -> Column:
    """The JSON text of one change. Null images are written as ``null``."""
    if ts_ms is None:
        ts_ms = F.unix_millis(F.current_timestamp())
    body = F.struct(
        before.alias("before"),
        after.alias("after"),
        F.struct(db.alias("db"), table.alias("table")).alias("source"),
        op.alias("op"),
        ts_ms.alias("ts_ms"),
    )
    return F.to_json(body, {"ignoreNullFields": "false"})


def to_envelope(
    df: DataFrame,
    *,
    columns: Sequence[str],
    db: str | Column,
    table: str | Column,
    op: str | Column = OP_READ,
    ts_ms: Column | None = None,
    decimal_mode: str = "string",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Encode each row as an envelope; returns ``keep`` columns plus ``value``.

    The row image goes to ``after``, or to ``before`` when ``op`` is a delete.
    """
    as_column = lambda v: v if isinstance(v, Column) else F.lit(v)
    op = as_column(op)
    image = F.struct(
        *[
            encode_decimal(F.col(_quoted(c)), df.schema[c].dataType, decimal_mode).alias(c)
            for c in columns
        ]
    )
    deleted = op == OP_DELETE
    value = envelope_text(
        before=F.when(deleted, image),
        after=F.when(~deleted, image),
        db=as_column(db),
        table=as_column(table),
        op=op,
        ts_ms=ts_ms,
    )
    return df.select(*keep, value.alias("value"))


def computed_once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Add a column whose expression is evaluated once per row.

    A filter on a plain column would be pushed below it with the expression
    copied into every place the filter reads, so JSON would be parsed many
    times. A filter on the output of explode stays above it.
    """
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_envelope(
    df: DataFrame, columns: Sequence[str], value: str = "value", before: bool = False
) -> DataFrame:
    """Add ``db``, ``table``, ``op``, ``after``, ``nested`` and ``parse_error``.

    ``after`` is a struct of the named columns as text (JSON null and missing
    fields are NULL, numbers and booleans their text) and ``nested`` lists the
    columns where the JSON holds an object or array, which no text column
    takes; it is null for most rows. Other fields are not materialised.
    ``before=True`` uses the before-image where a delete has no after-image.
    ``parse_error`` is null, ``malformed``, ``source_missing`` or
    ``after_null``, in that order of precedence.

    Fields are read as text in one pass. Only rows where that text may hide a
    nested value or a rounded number are read again as variants, which keep
    both the JSON type and up to 38 digits.
    """
    # Read again only for a name that looks like an object or array.
    typed_source = F.from_json(F.col(value), "source STRUCT<db: VARIANT, `table`: VARIANT>", LENIENT_JSON)["source"]

    def decoded(event: Column) -> Column:
        source, row = event["source"], _image(event, before)
        db, table = (
            F.when(_looks_nested(source[c]), _plain_text(typed_source[c])).otherwise(source[c])
            for c in ("db", "table")
        )
        not_an_object = event.isNull() | (
            event[CORRUPT].isNotNull() & source.isNull() & row.isNull()
        )
        error = (
            F.when(not_an_object, MALFORMED)
            .when(db.isNull() | table.isNull(), SOURCE_MISSING)
            .when(row.isNull(), AFTER_NULL)
        )
        plain = F.struct(row.alias("after"), F.lit(None).cast("array<string>").alias("nested"))
        inexact = F.concat_ws(FIELD_GAP, F.lit(""), *[row[c] for c in columns]).rlike(INEXACT_TEXT)
        return F.struct(
            db.alias("db"),
            table.alias("table"),
            event["op"].alias("op"),
            F.when(inexact, _exact_fields(value, columns, row, before)).otherwise(plain).alias("image"),
            error.alias("parse_error"),
        )

    event = _from_json(value, columns, "STRING", before)
    df = df.select("*", F.explode(F.transform(F.array(event), decoded)).alias("_decoded"))
    return df.withColumns(
        {
            "db": F.col("_decoded.db"),
            "table": F.col("_decoded.table"),
            "op": F.col("_decoded.op"),
            "after": F.col("_decoded.image.after"),
            "nested": F.col("_decoded.image.nested"),
            "parse_error": F.col("_decoded.parse_error"),
        }
    ).drop("_decoded")


def _exact_fields(value: str, columns: Sequence[str], rough: Column, before: bool) -> Column:
    """``after`` and ``nested`` from variants; from the text where those fail,
    as they do for a nested value with repeated names."""

    def typed(event: Column) -> Column:
        row = _image(event, before)
        texts = [F.coalesce(row[c].cast("string"), rough[c]).alias(c) for c in columns]
        kinds = [
            F.when(row[c].isNull() & _looks_nested(rough[c]), c).when(
                F.schema_of_variant(row[c]).rlike("^(OBJECT|ARRAY)"), c
            )
            for c in columns
        ]
        return F.struct(
            F.struct(*texts).alias("after"),
            F.array_compact(F.array(*kinds)).alias("nested"),
        )

    return F.transform(F.array(_from_json(value, columns, "VARIANT", before)), typed)[0]


def _plain_text(value: Column) -> Column:
    """The text of a variant, NULL for an object or array."""
    return F.when(~F.schema_of_variant(value).rlike("^(OBJECT|ARRAY)"), value.cast("string"))


def _looks_nested(text: Column) -> Column:
    return text.startswith("{") | text.startswith("[")


def _from_json(value: str, columns: Sequence[str], kind: str, before: bool) -> Column:
    image = "STRUCT<" + ", ".join(f"{_quoted(c)}: {kind}" for c in columns) + ">"
    fields = ["source STRUCT<db: STRING, `table`: STRING>", f"after {image}", "op STRING"]
    if before:
        fields.append(f"before {image}")
    fields.append(f"{CORRUPT} STRING")
    return F.from_json(
        F.col(value), ", ".join(fields), {**LENIENT_JSON, "columnNameOfCorruptRecord": CORRUPT}
    )


def _image(event: Column, before: bool) -> Column:
    """The after-image; with ``before``, a delete's before-image in its place."""
    after = event["after"]
    if not before:
        return after
    return F.when(after.isNull() & (event["op"] == OP_DELETE), event["before"]).otherwise(after)


def project_after(df: DataFrame, columns: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Typed projection by name: ``keep`` columns, then each field as STRING."""
    return df.select(*keep, *[F.col(f"after.{_quoted(c)}").alias(c) for c in columns])


def any_nested(columns: Sequence[str]) -> Column:
    """True when one of these fields of a parsed envelope is an object or array."""
    names = F.array(*[F.lit(c) for c in columns])
    return F.coalesce(F.arrays_overlap("nested", names), F.lit(False))


def generic_rows(df: DataFrame, value: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Any envelope as ``db``, ``table`` and a map of all its after-fields.

    Rows that cannot be decoded are left out, as are changes with no
    after-image. With duplicate field names the last one wins.
    """
    parsed = F.from_json(
        F.col(value),
        "source STRUCT<db: VARIANT, `table`: VARIANT>, after MAP<STRING, STRING>",
        LENIENT_JSON,
    )
    entries = F.map_entries("_event.after")
    names = F.reverse(F.transform(entries, lambda e: e["key"]))
    last_only = F.filter(
        entries, lambda e, i: F.array_position(names, e["key"]) == F.size(entries) - i
    )
    unique = F.size(F.array_distinct(names)) == F.size(names)
    return (
        computed_once(df, "_event", parsed)
        .select(
            *keep,
            _plain_text(F.col("_event.source.db")).alias("db"),
            _plain_text(F.col("_event.source.table")).alias("table"),
            F.when(unique, F.col("_event.after")).otherwise(F.map_from_entries(last_only)).alias("fields"),
        )
        .where("db IS NOT NULL AND `table` IS NOT NULL AND fields IS NOT NULL")
    )


def parse_rows(
    df: DataFrame,
    columns: Sequence[str],
    value: str = "value",
    keep: Sequence[str] = (),
    errors: str = "null",
) -> DataFrame:
    """Flat JSON objects (no envelope) as text columns.

    Text that is no JSON object, null too, gives nulls. ``errors="reject"``
    also adds ``parse_error``, ``malformed`` for such rows and else null;
    ``errors="fail"`` stops the job at the first of them.
    """
    if errors not in ("null", "reject", "fail"):
        raise ValueError(f"errors must be 'null', 'reject' or 'fail', not {errors!r}")
    schema = ", ".join(f"{_quoted(c)} STRING" for c in [*columns, CORRUPT])
    parsed = F.from_json(F.col(value), schema, {**LENIENT_JSON, "columnNameOfCorruptRecord": CORRUPT})
    rows = computed_once(df, "_row", parsed)
    bad = F.col("_row").isNull() | F.col(f"_row.{CORRUPT}").isNotNull()
    fields = [F.when(~bad, F.col(f"_row.{_quoted(c)}")) for c in columns]
    if errors == "fail":
        stop = F.raise_error(F.concat(F.lit("not a JSON object: "), F.coalesce(F.col(value), F.lit("NULL"))))
        fields = [f.otherwise(stop.cast("string")) for f in fields]
    error = [F.when(bad, MALFORMED).alias("parse_error")] if errors == "reject" else []
    return rows.select(*keep, *[f.alias(c) for f, c in zip(fields, columns)], *error)


def parse_pairs(
    df: DataFrame,
    value: str = "value",
    columns: tuple[str, str] = ("id", "name"),
    keep: Sequence[str] = (),
    errors: str = "reject",
) -> DataFrame:
    """Comma-separated lines as their first two fields, untrimmed.

    A line with fewer than two fields is invalid, and empty fields at the end
    of a line do not count. ``errors="reject"`` keeps such lines with
    ``parse_error`` set and null fields; ``errors="fail"`` stops the job.
    """
    if errors not in ("reject", "fail"):
        raise ValueError(f"errors must be 'reject' or 'fail', not {errors!r}")
    line = F.col(value)
    parts = F.split(F.regexp_replace(line, r",+\z", ""), ",")
    valid = F.coalesce(F.size(parts) >= 2, F.lit(False))
    if errors == "fail":
        stop = F.raise_error(F.concat(F.lit("line with fewer than two fields: "), F.coalesce(line, F.lit("NULL"))))
        first, second = (F.when(valid, parts[i]).otherwise(stop.cast("string")) for i in (0, 1))
    else:
        first, second = (F.when(valid, parts[i]) for i in (0, 1))
    return df.select(
        *keep,
        first.alias(columns[0]),
        second.alias(columns[1]),
        F.when(~valid, MALFORMED).alias("parse_error"),
    )
