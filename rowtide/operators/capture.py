"""Produce and select change events from tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.decimals import encode_decimal
from ..functions.envelope import (
    OP_CREATE,
    OP_DELETE,
    OP_READ,
    OP_UPDATE,
    envelope_text,
    to_envelope,
)


def snapshot_changes(
    df: DataFrame,
    db: str,
    table: str,
    *,
    columns: Sequence[str] | None = None,
    ts_ms: Column | None = None,
    decimal_mode: str = "string",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Every existing row as a read event (``op="r"``, no before-image)."""
    return to_envelope(
        df,
        columns=columns or df.columns,
        db=db,
        table=table,
        op=OP_READ,
        ts_ms=ts_ms,
        decimal_mode=decimal_mode,
        keep=keep,
    )


def diff_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes that turn ``old`` into ``new``, one per changed key.

    Both sides need the same columns and unique, non-null ``keys``. Returns the
    key columns, ``op`` (c, u or d) and the ``before`` and ``after`` images.
    One equi-join on the keys: inputs bucketed on them need no shuffle.
    """
    if set(old.columns) != set(new.columns):
        raise ValueError("both versions need the same columns")
    columns = new.columns
    key_alias = [f"_k{i}" for i in range(len(keys))]

    def image(df: DataFrame, name: str) -> DataFrame:
        return df.select(
            *[F.col(k).alias(a) for k, a in zip(keys, key_alias)],
            F.struct(*columns).alias(name),
        )

    joined = image(old, "before").join(image(new, "after"), key_alias, "full_outer")
    before, after = F.col("before"), F.col("after")
    op = (
        F.when(before.isNull(), OP_CREATE)
        .when(after.isNull(), OP_DELETE)
        .otherwise(OP_UPDATE)
    )
    return joined.where(~before.eqNullSafe(after)).select(
        *[F.col(a).alias(k) for a, k in zip(key_alias, keys)],
        op.alias("op"),
        before,
        after,
    )


def encode_changes(
    changes: DataFrame,
    db: str,
    table: str,
    *,
    ts_ms: Column | None = None,
    decimal_mode: str = "string",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Envelope text for rows of ``diff_changes``."""

    def image_column(name: str) -> Column:
        fields = [
            encode_decimal(F.col(f"{name}.`{f.name}`"), f.dataType, decimal_mode).alias(f.name)
            for f in changes.schema[name].dataType.fields
        ]
        return F.when(F.col(name).isNotNull(), F.struct(*fields))

    value = envelope_text(
        before=image_column("before"),
        after=image_column("after"),
        db=F.lit(db),
        table=F.lit(table),
        op=F.col("op"),
        ts_ms=ts_ms,
    )
    return changes.select(*keep, value.alias("value"))


def apply_changes(old: DataFrame, changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inverse of ``diff_changes``: the table after the changes."""
    kept = old.join(changes.select(*keys), list(keys), "left_anti")
    added = changes.where(F.col("op") != OP_DELETE).select("after.*")
    return kept.unionByName(added)


def _pattern_list(patterns: str | Sequence[str]) -> str:
    items = patterns.split(",") if isinstance(patterns, str) else list(patterns)
    items = [p.strip() for p in items if p.strip()]
    if not items:
        raise ValueError("an include list must name at least one pattern")
    return "^(?i:" + "|".join(f"(?:{p})" for p in items) + ")$"


def include_tables(
    df: DataFrame,
    dbs: str | Sequence[str],
    tables: str | Sequence[str],
    db: str = "db",
    table: str = "table",
) -> DataFrame:
    """Keep rows whose database and ``db.table`` are both on the include lists.

    Patterns are regular expressions, matched whole and ignoring case. A dot is
    a regex dot and ``tb*`` means ``t`` and any number of ``b``.
    """
    full_name = F.concat_ws(".", F.col(db), F.col(table))
    return df.where(
        F.col(db).rlike(_pattern_list(dbs)) & full_name.rlike(_pattern_list(tables))
    )


def start_changes(
    snapshot: DataFrame | None,
    log: DataFrame,
    position: str = "initial",
    at: object = None,
    seq: str = "seq",
) -> DataFrame:
    """Where reading starts.

    ``initial``: the snapshot, then the whole log. ``latest``: only log rows
    with ``seq`` above ``at``. Any other value is an error.
    """
    if position == "latest":
        if at is None:
            raise ValueError("position 'latest' needs the sequence number to start after")
        return log.where(F.col(seq) > F.lit(at))
    if position == "initial":
        return log if snapshot is None else snapshot.unionByName(log)
    raise ValueError(f"position must be 'initial' or 'latest', not {position!r}")
