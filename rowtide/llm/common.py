"""Small helpers shared by the operators."""

from __future__ import annotations

import gc
from collections.abc import Callable, Iterator
from typing import TypeVar

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..storage import new_folder

T = TypeVar("T")

#: Bytes of text that operators over Arrow batches handle together.
PART_BYTES = 2 << 20
#: Bits of one of Spark's bitmaps. A filter has FILTER_BITS bits for each id, in
#: FILTER_BITMAPS bitmaps (8 MB) at most.
BITMAP_BITS = 32768
FILTER_BITS, FILTER_BITMAPS = 16, 2048


def saved(df: DataFrame, name: str, group_bytes: int | None = None) -> DataFrame:
    """Write to the shared folder and read back: cuts lineage, survives lost executors.

    ``group_bytes`` limits the row groups of the files, about.
    """
    spark = df.sparkSession
    path = new_folder(spark, name)
    options = {} if group_bytes is None else {"parquet.block.size": str(group_bytes)}
    df.write.options(**options).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def maybe_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """All rows of ``df`` whose whole number ``column`` is in ``ids`` (one
    column, saved), and few others: about one in 16 up to four million ids,
    more beyond.

    Nothing of ``df`` is shuffled; its tasks get a bitmap of hashed ids. Placed
    before an exact join with the same ids it leaves the result as it is.
    """
    bitmaps = min(FILTER_BITMAPS, 1 + ids.count() * FILTER_BITS // BITMAP_BITS)

    def place(name: str) -> Column:
        return F.pmod(F.xxhash64(F.col(name).cast("long")), F.lit(bitmaps * BITMAP_BITS))

    marks = ids.select(place(ids.columns[0]).alias("_place")).select(
        F.floor(F.col("_place") / BITMAP_BITS).alias("_part"), (F.col("_place") % BITMAP_BITS).alias("_bit")
    )
    marks = marks.repartition("_part").groupBy("_part").agg(F.bitmap_construct_agg("_bit").alias("_bits"))
    bit = place(column) % BITMAP_BITS
    byte = F.conv(F.hex(F.substring("_bits", F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    same_part = F.floor(place(column) / BITMAP_BITS) == F.col("_part")
    # At most 8 MB, whatever the number of ids.
    return df.join(F.broadcast(marks), same_part & (F.getbit(byte, (bit % 8).cast("int")) == 1), "left_semi")


_kept: dict[tuple, object] = {}


def kept_by_worker(key: tuple, build: Callable[[], T]) -> T:
    """What ``build`` gives, kept while a worker works for one operator.

    Workers outlive tasks. What another operator left behind, its tokenizer and
    the words it remembered, is dropped first, so a worker holds those of one
    operator, the first part of the key, at a time.
    """
    if key not in _kept:
        for other in [k for k in _kept if k[0] != key[0]]:
            del _kept[other]
        gc.collect()
        _kept[key] = build()
    return _kept[key]


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def text_parts(batch: pa.RecordBatch, column: str, part_bytes: int = PART_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``part_bytes`` of text each, one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(lengths, dtype=np.int64)
    start = 0
    while start < batch.num_rows:
        before = int(total[start - 1]) if start else 0
        stop = max(start + 1, int(np.searchsorted(total, before + part_bytes, "right")))
        yield batch.slice(start, stop - start)
        start = stop
