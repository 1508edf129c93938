"""Route change events to target tables by database and table name."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.envelope import any_nested, parse_envelope, project_after

UNROUTED = "_unrouted"
REJECT = "_reject"
TABLE_UNMATCHED = "table_unmatched"
PROJECTION = "projection"
NULL_KEY = "null_key"


@dataclass(frozen=True)
class Route:
    """Changes of ``tables`` in ``db`` go to ``dest`` with these text columns.

    Several tables in one route form one shard union. ``shard_column`` adds the
    table of origin as a column, for shards whose ids overlap.
    """

    db: str
    tables: tuple[str, ...]
    dest: str
    columns: tuple[str, ...]
    shard_column: str | None = None

    def matches(self) -> Column:
        return (F.col("db") == self.db) & F.col("table").isin(list(self.tables))


def _check(routes: Sequence[Route]) -> None:
    seen: set[tuple[str, str]] = set()
    for r in routes:
        if r.dest in (UNROUTED, REJECT):
            raise ValueError(f"{r.dest!r} is a reserved destination")
        for t in r.tables:
            if (r.db, t) in seen:
                raise ValueError(f"two routes take {r.db}.{t}")
            seen.add((r.db, t))


def route_columns(routes: Sequence[Route]) -> list[str]:
    """Every column any route needs, once."""
    return list(dict.fromkeys(c for r in routes for c in r.columns))


def route_changes(
    df: DataFrame,
    routes: Sequence[Route],
    value: str = "value",
    deletes: str = "ignore",
) -> DataFrame:
    """Decode envelopes and add ``dest`` and ``reject_reason``; no row is lost.

    ``dest`` is a route's destination, ``_unrouted`` for a database no route
    names, or ``_reject`` with one of the reasons ``malformed``,
    ``source_missing``, ``after_null``, ``table_unmatched``, ``projection``.
    Names match exactly. The row image stays in ``after`` (see ``routed_rows``).

    ``deletes="ignore"`` rejects deletes as ``after_null`` since they carry no
    after-image. ``deletes="apply"`` routes them by their before-image.
    """
    if deletes not in ("ignore", "apply"):
        raise ValueError(f"deletes must be 'ignore' or 'apply', not {deletes!r}")
    _check(routes)
    parsed = parse_envelope(df, route_columns(routes), value, before=deletes == "apply")
    error = F.col("parse_error")
    known_dbs = sorted({r.db for r in routes})
    dest = F.when(error.isNotNull(), REJECT).when(~F.col("db").isin(known_dbs), UNROUTED)
    reason = F.when(error.isNotNull(), error).when(~F.col("db").isin(known_dbs), F.lit(None))
    for r in routes:
        # Only the columns of the matched route can fail its projection.
        nested = any_nested(r.columns)
        dest = dest.when(r.matches() & nested, REJECT).when(r.matches(), r.dest)
        reason = reason.when(r.matches() & nested, PROJECTION).when(r.matches(), F.lit(None))
    return parsed.withColumns(
        {"dest": dest.otherwise(REJECT), "reject_reason": reason.otherwise(TABLE_UNMATCHED)}
    ).drop("parse_error", "nested")


def reject_null_keys(
    routed: DataFrame, routes: Sequence[Route], keys: Mapping[str, Sequence[str]]
) -> DataFrame:
    """Turn routed rows with a null key column into rejects (``null_key``).

    ``keys`` gives the key columns per destination. An all-null row is a valid
    projection, but no table can take a row without a key.
    """
    keyless = F.lit(False)
    for r in routes:
        for k in keys[r.dest]:
            if k != r.shard_column:
                keyless = keyless | ((F.col("dest") == r.dest) & F.col(f"after.`{k}`").isNull())
    return routed.withColumns(
        {
            "dest": F.when(keyless, REJECT).otherwise(F.col("dest")),
            "reject_reason": F.when(keyless, NULL_KEY).otherwise(F.col("reject_reason")),
        }
    )


def routed_rows(routed: DataFrame, route: Route, keep: Sequence[str] = ()) -> DataFrame:
    """The rows of one route as its typed columns, after ``keep``."""
    shard = [route.shard_column] if route.shard_column else []
    rows = routed.where(F.col("dest") == route.dest)
    if shard:
        rows = rows.withColumn(route.shard_column, F.col("table"))
    return project_after(rows, route.columns, keep=[*keep, *shard])


def unrouted_rows(routed: DataFrame, keep: Sequence[str] = ("value",)) -> DataFrame:
    """Changes of databases that no route names, as received."""
    return routed.where(F.col("dest") == UNROUTED).select(*keep)


def rejected_rows(routed: DataFrame, keep: Sequence[str] = ("value",)) -> DataFrame:
    """Rejected changes as received, with the reason: a dead-letter table."""
    return routed.where(F.col("dest") == REJECT).select(*keep, "reject_reason")


def dim_rows(
    df: DataFrame,
    db: str,
    table: str,
    columns: Sequence[str],
    *,
    value: str = "value",
    keep: Sequence[str] = (),
    unmatched: str = "drop",
    errors: str = "reject",
) -> DataFrame:
    """Dimension rows from the changes of one table.

    ``unmatched="sentinel"`` turns every change of another table into a row of
    the text ``"null"`` in each column instead of dropping it. ``errors="fail"``
    stops the job on text that cannot be decoded or has no after-image, and on
    a nested value in a column of the table; ``"reject"`` leaves such rows out.
    """
    if unmatched not in ("drop", "sentinel"):
        raise ValueError(f"unmatched must be 'drop' or 'sentinel', not {unmatched!r}")
    if errors not in ("reject", "fail"):
        raise ValueError(f"errors must be 'reject' or 'fail', not {errors!r}")
    parsed = parse_envelope(df, columns, value)
    matched = (F.col("db") == db) & (F.col("table") == table)
    problem = F.coalesce(F.col("parse_error"), F.when(matched & any_nested(columns), PROJECTION))
    # One flag column, so that the failing check cannot be pruned or reordered
    # away from the filter that reads it.
    if errors == "fail":
        usable = F.when(
            problem.isNotNull(),
            F.raise_error(F.concat(F.lit("dimension change: "), problem)).cast("boolean"),
        ).otherwise(True)
    else:
        usable = problem.isNull()
    if unmatched == "drop":
        usable = usable & matched
    rows = parsed.where(usable)
    if unmatched == "drop":
        return project_after(rows, columns, keep)
    fields = [F.when(matched, F.col(f"after.`{c}`")).otherwise("null").alias(c) for c in columns]
    return rows.select(*keep, *fields)
