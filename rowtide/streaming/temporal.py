"""Temporal join of two streams with the dimension kept as keyed state."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from ..operators.temporal import joined_names

# Rows cross to Python as JSON text, so that no column type changes there.
JSON_TIMES = {
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}
# Facts without a key match nothing and only have to lie apart.
KEYLESS_SLOTS = 256
#: Groups of keys; a call of Python, some milliseconds, is made for each instead of each key.
BUCKETS = 512
#: Facts that leave a group at once.
SLICE = 10_000
#: Texts of a group's chunk from which on they are held compressed.
PACKED = 1000


def temporal_join_stream(
    facts: DataFrame,
    dims: DataFrame,
    key: str,
    seq: str | Sequence[str],
    *,
    how: str = "inner",
    spread: int = 1,
    state_ttl_ms: int | None = None,
) -> DataFrame:
    """Each fact with the dimension row of its key known when it arrives.

    State holds the latest dimension row per key; facts are not kept. A fact
    that comes before its dimension row matches nothing, ever, and a later
    dimension row changes no earlier result, so output is append-only. Within
    a micro-batch rows are taken by ``seq``, one or several non-null columns of
    both sides (for Kafka: timestamp, partition, offset), dimension rows first.
    Columns are those of ``temporal_join``. Null keys match nothing.

    ``spread`` > 1 divides the facts of every key over that many groups, each
    with its own copy of the dimension state: for keys too hot for one task.
    Bound the batch size at the sources: a group's rows of one batch are held,
    their texts compressed. Keys are taken together in ``BUCKETS`` groups, whose state
    is a map of their keys.

    ``state_ttl_ms`` drops state that no row touched for that long, and each key
    is a group of its own; by default state is kept. With it, use a
    processing-time trigger: an available-now query would not end, since Spark
    goes on starting empty batches to look for expired state.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', not {how!r}")
    if spread < 1:
        raise ValueError("spread must be at least 1")
    order = [seq] if isinstance(seq, str) else list(seq)
    places = [f"_seq{i}" for i in range(len(order))]
    text_key = F.col(key).cast("string")
    bucket = F.pmod(F.xxhash64(text_key), F.lit(BUCKETS)).cast("string") if state_ttl_ms is None else text_key

    def tagged(df: DataFrame, side: int, group: Column) -> DataFrame:
        return df.select(
            bucket.alias("_bucket"),
            group.alias("_group"),
            text_key.alias("_key"),
            *[F.col(c).alias(p) for c, p in zip(order, places)],
            F.lit(side).alias("_side"),
            F.to_json(
                F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(df.columns)]), JSON_TIMES
            ).alias("_row"),
        )

    # Any slot is right for a fact; the task number separates exact copies.
    mixed = F.xxhash64(*[F.col(c) for c in facts.columns]) + F.spark_partition_id()
    slots = F.when(F.col(key).isNull(), KEYLESS_SLOTS).otherwise(spread)
    slot = F.pmod(mixed, slots).cast("int")
    copies = F.explode(F.sequence(F.lit(0), F.lit(spread - 1)))
    fact_rows = tagged(facts, 1, slot)
    if how == "inner":
        fact_rows = fact_rows.where(F.col("_key").isNotNull())
    dim_rows = tagged(dims.where(F.col(key).isNotNull()), 0, copies)
    rows = fact_rows.unionByName(dim_rows)

    keep_unmatched = how == "left"
    with_ttl = state_ttl_ms is not None

    def match(
        keys: tuple, chunks: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        # A group's rows may come in several chunks, in no order. Each is packed
        # at once and copied, as its columns are views of a whole Arrow batch.
        numbers: dict[str | None, int] = {}
        codes, texts = [], []
        columns: dict[str, list[pd.Series]] = {c: [] for c in (*places, "_side")}
        for chunk in chunks:
            for c, parts in columns.items():
                parts.append(pd.Series(chunk[c].to_numpy(copy=True)))
            codes.append(np.array([numbers.setdefault(k, len(numbers)) for k in chunk["_key"]], np.int32))
            texts.append(_packed(chunk["_row"]))
            del chunk
        ends = np.cumsum([len(c) for c in codes])
        code = np.concatenate(codes)
        ranks = [_sortable(pd.concat(columns.pop(c), ignore_index=True)) for c in (*places, "_side")]
        del codes
        small = np.int32 if len(code) < 1 << 31 else np.int64
        line = np.lexsort((*ranks[::-1], code)).astype(small)
        code, is_dim = code[line], ranks[-1][line] == 0
        del ranks
        # For each row the place of its key's newest dimension row up to it, or -1.
        at = np.arange(len(line), dtype=small)
        first = np.concatenate([[True], code[1:] != code[:-1]])
        newest = np.maximum.accumulate(np.where(is_dim, at, small(-1)))
        newest[newest < np.maximum.accumulate(np.where(first, at, small(0)))] = -1
        del at
        facts = np.flatnonzero(~is_dim)
        last = np.flatnonzero(np.append(first[1:], True) & (newest >= 0))
        # Only facts, the dimension rows they meet, and the last ones are unpacked.
        met = newest[facts]
        used = np.unique(np.concatenate([line[facts], line[met[met >= 0]], line[newest[last]]]))
        taken = []
        for i, stop in enumerate(ends):
            start = ends[i - 1] if i else 0
            low, high = np.searchsorted(used, [start, stop])
            taken.append(_unpacked(texts[i]).take(pa.array(used[low:high] - start)))
            texts[i] = None
        text = pa.concat_arrays(taken)
        del taken

        def texts_of(rows: np.ndarray) -> np.ndarray:
            found = text.take(pa.array(np.searchsorted(used, line[rows])))
            return np.array(found.to_pylist(), object)

        stored = state.get[0] if state.exists else {}
        keys = list(numbers)
        if len(last):
            new = dict(zip([keys[c] for c in code[last]], texts_of(newest[last])))
            state.update(({**stored, **new},))
        if with_ttl and state.exists:
            state.setTimeoutDuration(state_ttl_ms)
        for start in range(0, len(facts), SLICE):
            some = facts[start : start + SLICE]
            found = newest[some] >= 0
            dims_of = np.array([stored.get(keys[c]) for c in code[some]], object)
            dims_of[found] = texts_of(newest[some[found]])
            wanted = np.ones(len(some), bool) if keep_unmatched else dims_of != None  # noqa: E711
            yield pd.DataFrame({"_fact": texts_of(some[wanted]), "_dim": dims_of[wanted]})

    joined = rows.groupBy("_bucket", "_group").applyInPandasWithState(
        match,
        outputStructType="_fact STRING, _dim STRING",
        stateStructType="rows MAP<STRING, STRING>",
        outputMode="append",
        timeoutConf=GroupStateTimeout.ProcessingTimeTimeout
        if with_ttl
        else GroupStateTimeout.NoTimeout,
    )
    fact_type, dim_type = _numbered(facts.schema), _numbered(dims.schema)
    decoded = joined.select(
        F.from_json("_fact", fact_type, JSON_TIMES).alias("_f"),
        F.from_json("_dim", dim_type, JSON_TIMES).alias("_d"),
    )
    return decoded.select(
        *[F.col(f"_f.c{i}").alias(c) for i, c in enumerate(facts.columns)],
        *[
            F.col(f"_d.c{i}").alias(n)
            for i, n in enumerate(joined_names(facts.columns, dims.columns))
        ],
    )


def _numbered(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(schema.fields)])


def _packed(texts: pd.Series) -> pa.Array | bytes:
    """Texts as an Arrow column, compressed if they are many."""
    column = pa.array(texts, pa.large_string(), from_pandas=True)
    if len(column) < PACKED:
        return column
    rows, out = pa.record_batch([column], ["text"]), pa.BufferOutputStream()
    with pa.ipc.new_stream(out, rows.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as writer:
        writer.write_batch(rows)
    return out.getvalue().to_pybytes()


def _unpacked(packed: pa.Array | bytes) -> pa.Array:
    return packed if isinstance(packed, pa.Array) else pa.ipc.open_stream(packed).read_next_batch().column(0)


def _sortable(column: pd.Series) -> np.ndarray:
    """The column as an array that NumPy sorts, nulls last."""
    if column.dtype != object:
        return column.to_numpy()
    ranks, distinct = pd.factorize(column, sort=True)
    return np.where(ranks < 0, len(distinct), ranks)
