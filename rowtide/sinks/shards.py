"""Messages dealt to shards by load, and cut into requests of limited size.

A key's messages stay on one shard, so that they keep their order. Keys that
carry much of the load are placed one by one, all others in hash slots; what is
placed is at most ``SLOTS`` slots and ``HEAVY_PER_SHARD`` keys per shard,
however large the log. Each prefers shards in an order of its own, so a new
shard takes little from the others.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import LongType, StructField, StructType

#: Groups of keys that carry little each.
SLOTS = 4096
#: A key is placed by itself from 1 / (HEAVY_PER_SHARD * shards) of all bytes on.
HEAVY_PER_SHARD = 8
PLACES = "kind string, item long, bytes long, shard int"


def shard_places(
    messages: DataFrame, key: Column, size: Column, shards: Sequence[int], slack: float = 0.1
) -> DataFrame:
    """Which shard takes which heavy key and which slot: kind (key or slot), item
    (hash of the key, or slot), bytes, shard.

    A shard holds at most ``1 + slack`` times the mean load, or the mean and the
    heaviest single item where that is more. Sizes that are null count as 0.
    """
    if not shards or len(set(shards)) != len(shards):
        raise ValueError("give each shard once")
    spark = messages.sparkSession
    loads = messages.groupBy(_key_hash(key).alias("item")).agg(
        F.sum(F.coalesce(size.cast("long"), F.lit(0))).alias("bytes")
    )
    total = loads.agg(F.coalesce(F.sum("bytes"), F.lit(0))).first()[0]
    heavy = (F.col("bytes") * F.lit(HEAVY_PER_SHARD * len(shards)) >= total) & (F.col("bytes") > 0)
    items = loads.select(
        F.when(heavy, "key").otherwise("slot").alias("kind"),
        F.when(heavy, F.col("item")).otherwise(_slot(F.col("item"))).alias("item"),
        "bytes",
    )
    items = items.groupBy("kind", "item").agg(F.sum("bytes").alias("bytes")).collect()
    loads_of = {(r.kind, r.item): r.bytes for r in items}
    rows = [("key", i) for k, i in loads_of if k == "key"] + [("slot", i) for i in range(SLOTS)]
    weights = np.array([loads_of.get(r, 0) for r in rows], dtype=np.int64)
    dealt = _dealt(np.array([i for _, i in rows], dtype=np.int64), weights, list(shards), slack)
    placed = [(k, i, int(w), s) for (k, i), w, s in zip(rows, weights, dealt)]
    return spark.createDataFrame(placed, PLACES)


def with_shard(messages: DataFrame, key: Column, places: DataFrame, name: str = "shard") -> DataFrame:
    """Add the shard of each message. Null keys are a key; keys that ``places``
    has not seen go where their slot goes. Both broadcasts are bounded by the
    number of slots and shards."""
    if name in messages.columns:
        raise ValueError(f"{name} is a column already; give another name")
    place = lambda kind: F.broadcast(
        places.where(F.col("kind") == kind).select(F.col("item").alias(f"_{kind}"), F.col("shard").alias(f"_{kind}_shard"))
    )
    packed = messages.select(F.struct(*messages.columns).alias("_row"), _key_hash(key).alias("_hash"))
    joined = packed.join(place("key"), F.col("_hash") == F.col("_key"), "left")
    joined = joined.join(place("slot"), _slot(F.col("_hash")) == F.col("_slot"), "left")
    return joined.select("_row.*", F.coalesce("_key_shard", "_slot_shard").alias(name))


def request_batches(
    messages: DataFrame,
    key: Column,
    size: Column,
    order: Sequence[str],
    *,
    shard: str = "shard",
    max_records: int = 500,
    max_bytes: int = 5 << 20,
    lanes: int = 4,
    partitions: int | None = None,
) -> DataFrame:
    """Add ``lane`` and ``batch``: the messages of one shard, lane and batch are
    one request, at most ``max_records`` of at most ``max_bytes`` together.

    A shard's keys are divided over ``lanes`` writers; in a lane the messages
    are in ``order`` and requests count up from 0, so a key's messages keep
    their order. Requests are filled while rows stream past, nothing is held
    back. A message above the byte limit is a request of its own.
    """
    if max_records < 1 or max_bytes < 1 or lanes < 1:
        raise ValueError("limits and lanes must be at least 1")
    clash = {"lane", "batch", "_size"} & set(messages.columns)
    if clash:
        raise ValueError(f"columns already: {sorted(clash)}")
    rows = messages.withColumns(
        {
            "_size": F.coalesce(size.cast("long"), F.lit(0)),
            "lane": F.pmod(F.shiftright(_key_hash(key), 17), F.lit(lanes)).cast("int"),
        }
    )
    count = [partitions] if partitions else []
    rows = rows.repartition(*count, shard, "lane").sortWithinPartitions(shard, "lane", *order)
    schema = StructType([*rows.schema.fields, StructField("batch", LongType())])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, number, records, filled = None, 0, 0, 0
        for batch in batches:
            numbers = []
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in (shard, "lane", "_size")]
            for at_shard, lane, weight in zip(*columns):
                if (at_shard, lane) != place:
                    place, number, records, filled = (at_shard, lane), 0, 0, 0
                elif records == max_records or filled + weight > max_bytes:
                    number, records, filled = number + 1, 0, 0
                records, filled = records + 1, filled + weight
                numbers.append(number)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(numbers, pa.int64())], names=[*batch.schema.names, "batch"]
            )

    return rows.mapInArrow(cut, schema).drop("_size")


def _key_hash(key: Column) -> Column:
    return F.xxhash64(key.isNull(), key)


def _slot(hashed: Column) -> Column:
    return F.pmod(hashed, F.lit(SLOTS)).cast("long")


def _dealt(items: np.ndarray, weights: np.ndarray, shards: list[int], slack: float) -> list[int]:
    """Heaviest first, each to the shard it prefers among those with room, else
    to the least loaded."""
    limit = (1 + slack) * weights.sum() / len(shards)
    load = np.zeros(len(shards))
    numbers = np.array(shards, dtype=np.uint64)
    chosen = np.empty(len(items), dtype=np.int64)
    for at in np.lexsort((items, -weights)):
        liking = _mixed(items[at : at + 1].astype(np.uint64) ^ _mixed(numbers))
        room = load + weights[at] <= limit
        best = int(np.argmax(np.where(room, liking, 0))) if room.any() else int(np.argmin(load))
        load[best] += weights[at]
        chosen[at] = shards[best]
    return [int(s) for s in chosen]


def _mixed(values: np.ndarray) -> np.ndarray:
    """Spread 64-bit numbers evenly, the same on every machine."""
    with np.errstate(over="ignore"):
        values = (values ^ (values >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
        values = (values ^ (values >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
        return (values ^ (values >> np.uint64(32))) | np.uint64(1)
