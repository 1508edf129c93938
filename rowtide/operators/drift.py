"""How the fields of logged rows change over time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F


def field_drift(log: DataFrame, by: Sequence[str], text: str, seq: str) -> DataFrame:
    """One row per table (the columns ``by``) and field of its JSON rows.

    ``type`` holds every value seen (``VARIANT`` where kinds do not mix, such as
    a number and a word), ``first`` and ``last`` the sequence numbers of the
    field's first and last row, ``rows`` how many have it, ``added`` whether the
    table has rows before the first, ``gone`` whether it has rows after the
    last. A null value is a value; texts that are no JSON object count nowhere.
    Aggregates with map-side combine: what is shuffled is a row per table and
    field of each task, whatever the share of one table.
    """
    by = list(by)
    clash = {"field", "type", "first", "last", "rows", "added", "gone"} & set(by)
    if clash:
        raise ValueError(f"rename the columns {sorted(clash)}")
    parsed = log.select(*by, F.col(seq).alias("_seq"), F.try_parse_json(text).alias("_row"))
    objects = parsed.where(F.schema_of_variant("_row").startswith("OBJECT"))
    named = objects.select(*by, "_seq", F.expr("try_variant_get(_row, '$', 'map<string, variant>')").alias("_fields"))
    tables = named.groupBy(*by).agg(F.min("_seq").alias("_start"), F.max("_seq").alias("_end"))
    fields = (
        named.select(*by, "_seq", F.explode("_fields").alias("field", "_value"))
        .groupBy(*by, "field")
        .agg(
            F.schema_of_variant_agg("_value").alias("type"),
            F.min("_seq").alias("first"),
            F.max("_seq").alias("last"),
            F.count(F.lit(1)).alias("rows"),
        )
    )
    same = [fields[c].eqNullSafe(tables[c]) for c in by]
    joined = fields.join(tables, same) if by else fields.join(F.broadcast(tables))
    return joined.select(
        *[fields[c] for c in by],
        "field",
        "type",
        "first",
        "last",
        "rows",
        (F.col("first") > F.col("_start")).alias("added"),
        (F.col("last") < F.col("_end")).alias("gone"),
    )
