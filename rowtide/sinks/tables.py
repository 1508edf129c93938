"""Keyed upsert into partitioned Parquet tables of Spark's catalog."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ..operators.upsert import PARTITION_COLUMNS, has_key, latest_per_key, merge_upsert

BUCKET = "key_bucket"
PARTITIONS_PER_STATEMENT = 200
#: Partition of rows whose partition value is null or empty.
NO_VALUE = "none"
GAINS = "_gains"


@dataclass(frozen=True)
class TableSpec:
    """A target table: text columns, record key, precombine, partitioning.

    ``key_scope="table"``: a key lives once in the table and moves when it
    arrives in another partition. ``"partition"``: once in each partition.

    ``buckets`` adds a partition column, a hash of the key, below the others.
    A batch then reads and rewrites only the buckets its keys fall into, which
    is what keeps upserts into large partitions affordable.
    """

    name: str
    location: str
    columns: tuple[str, ...]
    precombine: str
    keys: tuple[str, ...] = ("id",)
    partition_by: tuple[str, ...] = PARTITION_COLUMNS
    key_scope: str = "table"
    rule: str = "incoming"
    buckets: int = 0

    def __post_init__(self) -> None:
        if self.key_scope not in ("table", "partition"):
            raise ValueError(f"key_scope must be 'table' or 'partition', not {self.key_scope!r}")
        missing = {*self.keys, self.precombine} - set(self.columns)
        if missing:
            raise ValueError(f"not columns of {self.name}: {sorted(missing)}")

    @property
    def partition_columns(self) -> list[str]:
        return [*self.partition_by, *([BUCKET] if self.buckets else [])]

    @property
    def merge_keys(self) -> list[str]:
        return [*self.keys] if self.key_scope == "table" else [*self.keys, *self.partition_by]

    @property
    def ddl(self) -> str:
        fields = [f"`{c}` STRING" for c in [*self.columns, *self.partition_by]]
        return ", ".join([*fields, f"{BUCKET} INT"] if self.buckets else fields)


def ensure_table(spark: SparkSession, spec: TableSpec) -> None:
    """Create the partitioned table unless it is in the catalog."""
    parts = ", ".join(f"`{c}`" for c in spec.partition_columns)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {spec.name} ({spec.ddl}) USING parquet "
        f"PARTITIONED BY ({parts}) LOCATION {_literal(spec.location)}"
    )


def upsert_table(
    spec: TableSpec,
    batch: DataFrame,
    order: Sequence[str] = (),
    deleted: str | None = None,
    holding: DataFrame | None = None,
) -> list[Row]:
    """Merge stamped rows into the table by copy-on-write of whole partitions.

    The partitions that hold a key of the batch or receive one are rewritten
    into a new folder; then the catalog is pointed at it partition by
    partition, receivers before the partitions that only lose rows. The old
    files stay until then, and running the same batch again gives the same
    table. The catalog has no transaction over several partitions: a reader
    in between, or after a crash without a repeat, may see a moved key twice,
    and, if two partitions exchange keys, a key of the later one not at all;
    a repeated batch mends both.

    Rows without a key are left out; see ``has_key``. A null or empty
    partition value becomes the text ``none``. ``holding`` gives the partitions
    that hold the batch's keys, where they are known without a read of the
    table. Returns the partitions that were rewritten.
    """
    spark = batch.sparkSession
    parts = spec.partition_columns
    rows = batch.where(has_key(spec.keys)).withColumns(
        {c: F.coalesce(F.nullif(F.col(c).cast("string"), F.lit("")), F.lit(NO_VALUE)) for c in spec.partition_by}
    )
    if spec.buckets:
        rows = rows.withColumn(BUCKET, bucket_of(spec))
    changes = latest_per_key(rows, spec.merge_keys, [spec.precombine, *order]).persist()
    try:
        touched = _touched_partitions(spark.table(spec.name), spec, changes, deleted, holding)
        if not touched:
            return touched
        current = spark.table(spec.name).where(_in_partitions(touched, parts))
        merged = merge_upsert(
            current,
            changes,
            spec.merge_keys,
            spec.precombine,
            rule=spec.rule,
            deleted=deleted,
            deduplicated=True,
        )
        folder = f"{spec.location.rstrip('/')}/version-{uuid.uuid4().hex}"
        # Rebalancing lets Spark split a large partition over several tasks and
        # keeps small ones together; sorted keys make row-group filters work.
        (
            merged.hint("rebalance", *parts)
            .sortWithinPartitions(*parts, *spec.keys)
            .write.partitionBy(*parts)
            .parquet(folder)
        )
        _publish(spark, spec, folder, touched)
        return touched
    finally:
        changes.unpersist()


def remove_old_versions(spark: SparkSession, spec: TableSpec, older_than_hours: float = 24.0) -> int:
    """Delete replaced partition folders; returns how many.

    A folder goes only if the catalog's table reads no file in it and it is
    older than the given age, which must exceed the longest query on the table
    and the longest write to it. Works on folder names, never on rows.
    """
    levels = "/*=*" * len(spec.partition_columns)
    pattern = spark._jvm.org.apache.hadoop.fs.Path(f"{spec.location.rstrip('/')}/version-*{levels}")
    files = pattern.getFileSystem(spark._jsc.hadoopConfiguration())
    used = {
        unquote(urlparse(f).path).rsplit("/", 1)[0] for f in spark.table(spec.name).inputFiles()
    }
    oldest = (time.time() - older_than_hours * 3600) * 1000
    removed = 0
    for status in files.globStatus(pattern) or []:
        folder = status.getPath().toUri().getPath()
        if folder not in used and status.getModificationTime() <= oldest:
            removed += bool(files.delete(status.getPath(), True))
    return removed


def bucket_of(spec: TableSpec) -> Column:
    return F.pmod(F.xxhash64(*spec.keys), F.lit(spec.buckets)).cast("int")


def _touched_partitions(
    table: DataFrame, spec: TableSpec, changes: DataFrame, deleted: str | None, holding: DataFrame | None
) -> list[Row]:
    """Partition values to rewrite and whether rows arrive there: metadata, at
    most one row per partition."""
    parts = spec.partition_columns
    if deleted:
        arriving = changes.where(~F.coalesce(F.col(deleted), F.lit(False)))
    else:
        arriving = changes
    touched = arriving.select(*parts, F.lit(True).alias(GAINS))
    if holding is not None:
        touched = touched.unionByName(holding.select(*parts, F.lit(False).alias(GAINS)))
    elif spec.key_scope == "table":
        stored = table.select(*spec.keys, *parts)
        if spec.buckets:
            used = [r[0] for r in changes.select(BUCKET).distinct().collect()]
            stored = stored.where(F.col(BUCKET).isin(used))
        holding = stored.join(changes.select(*spec.keys), list(spec.keys), "left_semi")
        touched = touched.unionByName(holding.select(*parts, F.lit(False).alias(GAINS)))
    elif deleted:
        touched = touched.unionByName(changes.select(*parts, F.lit(False).alias(GAINS)))
    return touched.groupBy(*parts).agg(F.max(GAINS).alias(GAINS)).collect()


def _in_partitions(partitions: Sequence[Row], parts: Sequence[str]) -> Column:
    """A filter the catalog can prune by: the first column alone, which a
    metastore understands, then one set of whole partitions. Its plan has the
    same depth however many partitions there are."""
    place = F.concat_ws("\x01", *[F.col(c).cast("string") for c in parts])
    first = {p[parts[0]] for p in partitions}
    whole = {"\x01".join(str(p[c]) for c in parts) for p in partitions}
    return F.col(parts[0]).isin(sorted(first)) & place.isin(sorted(whole))


def _literal(value: object) -> str:
    if isinstance(value, int):
        return str(value)
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


def _partition_spec(parts: Sequence[str], values: Sequence[object]) -> str:
    return "PARTITION (" + ", ".join(f"`{c}`={_literal(v)}" for c, v in zip(parts, values)) + ")"


def _existing(spark: SparkSession, spec: TableSpec) -> set[tuple[str, ...]]:
    names = [r[0] for r in spark.sql(f"SHOW PARTITIONS {spec.name}").collect()]
    return {tuple(unquote(p.split("=", 1)[1]) for p in name.split("/")) for name in names}


def _written(spark: SparkSession, spec: TableSpec, folder: str) -> dict[tuple, str]:
    """Partition values and folders of a finished write, from folder names."""
    parts = spec.partition_columns
    pattern = spark._jvm.org.apache.hadoop.fs.Path(folder + "/*=*" * len(parts))
    places = {}
    for status in pattern.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(pattern) or []:
        place = status.getPath().toString()
        texts = [unquote(n.split("=", 1)[1]) for n in place.split("/")[-len(parts) :]]
        places[tuple(int(t) if c == BUCKET else t for c, t in zip(parts, texts))] = place
    return places


def _publish(spark: SparkSession, spec: TableSpec, folder: str, touched: Sequence[Row]) -> None:
    """Point the catalog at the new folder: gains first, emptied ones last."""
    parts = spec.partition_columns
    places = _written(spark, spec, folder)
    existing = _existing(spark, spec)
    as_text = lambda values: tuple(str(v) for v in values)
    new = [p for p in places if as_text(p) not in existing]
    for i in range(0, len(new), PARTITIONS_PER_STATEMENT):
        specs = " ".join(
            f"{_partition_spec(parts, p)} LOCATION {_literal(places[p])}"
            for p in new[i : i + PARTITIONS_PER_STATEMENT]
        )
        spark.sql(f"ALTER TABLE {spec.name} ADD IF NOT EXISTS {specs}")
    values = lambda row: tuple(row[c] for c in parts)
    gains = {values(p) for p in touched if p[GAINS]}
    for p in sorted(places, key=lambda p: p not in gains):
        if as_text(p) in existing:
            spark.sql(
                f"ALTER TABLE {spec.name} {_partition_spec(parts, p)} "
                f"SET LOCATION {_literal(places[p])}"
            )
    emptied = [p for p in map(values, touched) if p not in places and as_text(p) in existing]
    for i in range(0, len(emptied), PARTITIONS_PER_STATEMENT):
        specs = ", ".join(_partition_spec(parts, p) for p in emptied[i : i + PARTITIONS_PER_STATEMENT])
        spark.sql(f"ALTER TABLE {spec.name} DROP IF EXISTS {specs}")
    spark.catalog.refreshTable(spec.name)
