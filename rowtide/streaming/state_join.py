"""Temporal join of two streams with the dimension as typed state of each key."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, Row, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.temporal import joined_names
from .temporal import BUCKETS

#: Facts of one key and batch held in memory; more wait in the state store.
HELD_FACTS = 50_000
#: Facts handed to the state store at once.
SLICE = 2_000


def _renamed(df: DataFrame, prefix: str) -> T.StructType:
    """The columns as nullable fields ``<prefix>0``, ``<prefix>1``, ..."""
    return T.StructType([T.StructField(f"{prefix}{i}", f.dataType) for i, f in enumerate(df.schema.fields)])


class NewestDimension(StatefulProcessor):
    """Keeps the newest dimension row of each key of a group and joins facts to them.

    Facts are matched after all rows of the batch are read, so that their order
    within the group does not matter. Only the batch's dimension rows of the group
    are held for that; facts beyond ``held`` wait in a list state, on disk. The
    state is read and written once per group, as each call costs about as much
    as many rows.
    """

    def __init__(
        self,
        orders: int,
        key: T.DataType,
        facts: T.StructType,
        dims: T.StructType,
        left: bool,
        ttl_ms: int | None,
        held: int,
    ) -> None:
        self.orders, self.key, self.facts, self.dims = orders, T.StructField("k", key), facts, dims
        self.left, self.ttl_ms, self.held = left, ttl_ms, held

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.newest = handle.getListState("newest", T.StructType([self.key, *self.dims.fields]), self.ttl_ms)
        places = [T.StructField(f"o{i}", T.LongType()) for i in range(self.orders)]
        self.waiting = handle.getListState("waiting", T.StructType([self.key, *places, *self.facts.fields]))

    def handleInitialState(self, key: tuple, initialState: Row, timerValues: object) -> None:
        names = ["_key", *self.dims.names]
        self.newest.put([tuple(row[n] for n in names) for row in initialState["_rows"]])

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known: dict[object, list[tuple[tuple, tuple]]] = {}
        facts: list[tuple] = []
        waiting = False
        first_fact, first_dim = 1 + self.orders, 1 + self.orders + len(self.facts)
        for row in rows:
            side, *values = tuple(row)[-1 - first_dim - len(self.dims) :]
            if side == 0:
                known.setdefault(values[0], []).append((tuple(values[1:first_fact]), tuple(values[first_dim:])))
            else:
                facts.append(tuple(values[:first_dim]))
                if len(facts) >= self.held + SLICE:
                    self.waiting.appendList(facts[self.held :])
                    del facts[self.held :]
                    waiting = True
        places = {}
        for k, several in known.items():
            several.sort(key=lambda d: d[0])
            places[k] = [d[0] for d in several]
        stored = {d[0]: tuple(d[1:]) for d in self.newest.get()}
        nothing = (None,) * len(self.dims)
        joined = Row(*[f.name for f in [*self.facts.fields, *self.dims.fields]])

        def matched(several: Iterator[tuple]) -> Iterator[Row]:
            for fact in several:
                k = fact[0]
                at = bisect_right(places[k], tuple(fact[1:first_fact])) if k in places else 0
                dim = known[k][at - 1][1] if at else stored.get(k)
                if dim is not None or self.left:
                    yield joined(*fact[first_fact:], *(nothing if dim is None else dim))

        yield from matched(iter(facts))
        if waiting:
            yield from matched(self.waiting.get())
            self.waiting.clear()
        if known:
            stored.update((k, several[-1][1]) for k, several in known.items())
            self.newest.put([(k, *dim) for k, dim in stored.items()])


def temporal_join_state(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    seq: str | Sequence[str],
    *,
    initial: DataFrame | None = None,
    how: str = "inner",
    spread: int = 1,
    state_ttl_ms: int | None = None,
    held_facts: int = HELD_FACTS,
) -> DataFrame:
    """Each fact with the dimension row of its key known when it arrives.

    As ``temporal_join_stream``, with Spark's typed state: columns keep their
    types on the way through Python and in the state. ``seq`` names whole
    numbers, not null. ``initial``, a batch table with the columns of ``dims``
    and one row per key, is what is known before the first batch (a snapshot);
    a restarted query continues from its checkpoint instead. A key's facts of
    one batch may be any number; beyond ``held_facts`` they wait on disk. Keys are
    taken together in ``BUCKETS`` groups; of a group's dimension rows each batch's
    must fit in memory.

    ``state_ttl_ms`` drops a dimension row that long after it came, and each key
    is a group of its own; use a processing-time trigger with it. The state store must be RocksDB, see
    ``rocksdb_state``. Null keys match nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if spread < 1:
        raise ValueError("spread must be at least 1")
    order = [seq] if isinstance(seq, str) else list(seq)
    fact_type, dim_type = _renamed(facts, "f"), _renamed(dims, "d")

    def tagged(df: DataFrame, side: int, group: Column) -> DataFrame:
        own, prefix = (fact_type, "f") if side else (dim_type, "d")
        other = dim_type if side else fact_type
        columns = {f.name: F.lit(None).cast(f.dataType) for f in other.fields}
        columns |= {f"{prefix}{i}": F.col(c) for i, c in enumerate(df.columns)}
        names = [f.name for f in [*fact_type.fields, *dim_type.fields]]
        return df.select(
            group.alias("_group"),
            F.lit(side).alias("_side"),
            F.col(key).alias("_key"),
            *[F.col(c).cast("long").alias(f"_o{i}") for i, c in enumerate(order)],
            *[columns[n].alias(n) for n in names],
        )

    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    # Any group is right for a fact; the task number separates exact copies.
    mixed = F.xxhash64(*[F.col(c) for c in facts.columns]) + F.spark_partition_id()
    slots = F.when(F.col(key).isNull(), 256).otherwise(spread)
    fact_rows = tagged(facts, 1, F.pmod(mixed, slots).cast("int"))
    if how == "inner":
        fact_rows = fact_rows.where(F.col("_key").isNotNull())
    rows = fact_rows.unionByName(tagged(dims.where(F.col(key).isNotNull()), 0, copies))
    key_type = rows.schema["_key"].dataType

    def bucket(own_key: Column) -> Column:
        return own_key if state_ttl_ms is not None else F.pmod(F.xxhash64(own_key), F.lit(BUCKETS)).cast("int")

    start = None
    if initial is not None:
        known = initial.where(F.col(key).isNotNull()).withColumn("_key", F.col(key).cast(key_type))
        row = F.struct("_key", *[F.col(c).alias(f"d{i}") for i, c in enumerate(dims.columns)])
        # One row per group, so that its state is written by one call.
        start = (
            known.select(bucket(F.col("_key")).alias("_bucket"), copies.alias("_group"), row.alias("_row"))
            .groupBy("_bucket", "_group")
            .agg(F.collect_list("_row").alias("_rows"))
            .groupBy("_bucket", "_group")
        )
    names = [*facts.columns, *joined_names(facts.columns, dims.columns)]
    out = T.StructType([*fact_type.fields, *dim_type.fields])
    return (
        rows.select(bucket(F.col("_key")).alias("_bucket"), "*")
        .groupBy("_bucket", "_group")
        .transformWithState(
            NewestDimension(len(order), key_type, fact_type, dim_type, how == "left", state_ttl_ms, held_facts),
            out,
            "Append",
            "None" if state_ttl_ms is None else "ProcessingTime",
            start,
        )
        .toDF(*names)
    )
